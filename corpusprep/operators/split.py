"""Exact, seeded splits without a sort or a window.

``exact_split`` puts exactly ``ceil(ratio * T)`` rows on the inside, the
rows with the smallest ``md5(seed:purpose:key)`` (ties by key).  A histogram of
the next 16 bits of the hash finds the bucket the cut falls in, again and
again until a bucket is small enough to read; that gives the last hash and key
inside, and every row is labelled by one comparison, in place.  The driver
sees at most 65,536 counts or ``CUT_ROWS`` keys at a time.
"""

from __future__ import annotations

from decimal import ROUND_CEILING, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.draws import draw_hash


def n_inside(ratio, total: int) -> int:
    """``ceil(ratio * total)`` in decimal arithmetic (0.07*100 is 7, not 8)."""
    d = Decimal(str(ratio))
    if d < 0 or d > 1:
        raise ValueError(f"split ratio out of [0, 1]: {ratio}")
    return int((d * total).to_integral_value(rounding=ROUND_CEILING))


#: A bucket of at most this many keys is read; a larger one is divided by the next 16 bits of the hash.
CUT_ROWS = 20_000


def cut_point(df: DataFrame, key: str, ratio, seed: int, purpose: str) -> tuple[str, object] | None:
    """(hash, key) of the last row inside; None if no row is inside."""
    h = df.select(draw_hash(seed, purpose, key).alias("_h"), F.col(key).alias("_k"))
    bits = lambda at: F.substring("_h", 4 * at + 1, 4)  # noqa: E731  16 bits of the hash, as text
    counts = dict(h.groupBy(bits(0).alias("b")).count().collect())  # at most 65,536 rows
    want = n_inside(ratio, sum(counts.values()))
    if want == 0:
        return None
    prefix, depth = "", 0
    while True:
        for b in sorted(counts):
            if counts[b] >= want:
                break
            want -= counts[b]
        prefix, size, depth = prefix + b, counts[b], depth + 1
        inside = h.filter(F.col("_h").startswith(prefix))
        if size <= CUT_ROWS or depth == 8:
            return tuple(sorted((r[0], r[1]) for r in inside.collect())[want - 1])
        counts = dict(inside.groupBy(bits(depth).alias("b")).count().collect())


def is_inside(key: str, cut: tuple[str, object] | None, seed: int, purpose: str) -> Column:
    """Whether a row is at or before the cut."""
    if cut is None:
        return F.lit(False)
    h = draw_hash(seed, purpose, key)
    return (h < F.lit(cut[0])) | ((h == F.lit(cut[0])) & (F.col(key) <= F.lit(cut[1])))


def exact_split(
    df: DataFrame,
    key: str,
    ratio,
    seed: int = 42,
    purpose: str = "split",
    name: str = "split",
    inside: str = "test",
    outside: str = "train",
) -> DataFrame:
    """Label each row ``inside`` / ``outside``; ``key`` must be unique per row."""
    cut = cut_point(df, key, ratio, seed, purpose)
    return df.withColumn(name, F.when(is_inside(key, cut, seed, purpose), F.lit(inside)).otherwise(F.lit(outside)))


def three_way_split(
    df: DataFrame,
    key: str,
    test_ratio=0.005,
    valid_ratio=0.1,
    seed: int = 42,
    name: str = "split",
) -> DataFrame:
    """train / test / valid: split off ``test_ratio``, then ``valid_ratio`` of that becomes valid."""
    test = is_inside(key, cut_point(df, key, test_ratio, seed, "split"), seed, "split")
    valid = is_inside(key, cut_point(df.filter(test), key, valid_ratio, seed, "valid"), seed, "valid")
    return df.withColumn(name, F.when(~test, F.lit("train")).when(valid, F.lit("valid")).otherwise(F.lit("test")))


def leakage(labelled: DataFrame, origin: str, name: str = "split") -> DataFrame:
    """Origins whose copies land on more than one side (one-row count)."""
    sides = labelled.select(origin, name).distinct()  # partial aggregation first: hot origins collapse map-side
    both = sides.groupBy(origin).agg(F.count(F.lit(1)).alias("_sides")).filter(F.col("_sides") > 1)
    return both.agg(F.count(F.lit(1)).alias("n_leaked_origins"))
