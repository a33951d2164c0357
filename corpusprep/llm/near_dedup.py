"""Near-duplicate documents by ProbMinHash over weighted word shingles.

The shingles of a text are its runs of five words with their number of occurrences as
weight (a shorter text is one shingle). Every shingle is a Poisson process of arrivals
with its weight as rate; each arrival picks one of ``REGISTERS`` registers, which keeps
its earliest arrival. A shingle stops once its next arrival is later than every
register's (early termination). Two signatures agree in a register with the
probability Jaccard similarity of the texts. Bands of registers give candidates, which
are verified by the exact probability Jaccard similarity. Texts that are equal word for
word are one node from the start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import bucket_classes, row_key, shared_buckets, stored, unused
from corpusprep.llm.words import mix, odd_numbers, slices, window_hashes, words_of

SHINGLE = 5
SIMILARITY = 0.8
ROWS = 5
BANDS = 20
REGISTERS = ROWS * BANDS


def weighted_shingles(texts: list[str | None], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, occurrences), by text, then hash."""
    w = words_of(texts)
    hashes = w.hashes()
    count = w.count
    owner = w.text_of()
    runs = window_hashes(hashes, size)
    inside = np.arange(len(runs)) + size <= np.repeat(w.bounds[1:], count)[: len(runs)]
    owners, values = [owner[: len(runs)][inside]], [runs[inside]]
    for n in range(1, size):  # texts of fewer words
        short = np.flatnonzero(count == n)
        if len(short):
            total = np.zeros(len(short), dtype=np.uint64)
            for j in range(n):
                total += hashes[w.bounds[short] + j] * odd_numbers(64, 400 + n)[j]
            owners.append(short)
            values.append(mix(total))
    owner, value = np.concatenate(owners), np.concatenate(values)
    if not len(owner):
        return owner, value, np.zeros(0, dtype=np.int64)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])])
    head = np.flatnonzero(new)
    return owner[head], value[head], np.diff(np.append(head, len(owner)))


def prob_minhash(owner: np.ndarray, value: np.ndarray, weight: np.ndarray, n: int, registers: int = REGISTERS, seed: int = 0) -> np.ndarray:
    """Signatures n x registers: the shingle with the earliest arrival in each register (0: no shingles)."""
    early = np.full(n * registers, np.inf)
    winner = np.zeros(n * registers, dtype=np.uint64)
    time = np.zeros(len(owner))
    live = np.arange(len(owner))
    step = seed << 32  # another seed is another process
    while len(live):
        step += 1
        random = mix(value[live] + np.uint64(step * 0x9E3779B97F4A7C15 % 2**64))
        unit = ((random >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
        time[live] -= np.log(unit) / weight[live]
        at = owner[live] * registers + (mix(random) % np.uint64(registers)).astype(np.int64)
        soon = time[live] < early[at]
        hit, when, who = at[soon], time[live][soon], value[live][soon]
        np.minimum.at(early, hit, when)
        first = when == early[hit]
        winner[hit[first]] = who[first]
        latest = early.reshape(n, registers).max(axis=1)
        live = live[time[live] < latest[owner[live]]]
    return winner.reshape(n, registers)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact similarity of two (sorted hashes, weights): sum over common shingles d of 1 / sum_x max(a_x / a_d, b_x / b_d)."""
    (ha, wa), (hb, wb) = a, b
    common, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    both_a, both_b = wa[ia].astype(np.float64), wb[ib].astype(np.float64)
    only_a, only_b = wa.sum() - both_a.sum(), wb.sum() - both_b.sum()
    ratio = both_b / both_a
    order = np.argsort(ratio, kind="stable")
    sa, sb = np.concatenate([[0.0], np.cumsum(both_a[order])]), np.concatenate([[0.0], np.cumsum(both_b[order])])
    cut = np.searchsorted(ratio[order], ratio, side="right")  # shingles x up to cut have b_x / a_x <= b_d / a_d: a_x / a_d is larger
    total = (sa[cut] + only_a) / both_a + (sb[-1] - sb[cut] + only_b) / both_b
    return float((1 / total).sum())


def _sizes(texts: pa.Array) -> np.ndarray:
    return texts.cast(pa.large_string()).to_pandas().str.len().fillna(0).to_numpy()


def _signatures():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(_sizes(batch.column(1))):
                texts = batch.column(1).slice(lo, hi - lo).to_pylist()
                owner, value, weight = weighted_shingles(texts)
                sig = prob_minhash(owner, value, weight, hi - lo)
                mixed = (sig * odd_numbers(128, 500)[:REGISTERS]).reshape(hi - lo, BANDS, ROWS).sum(axis=2) + np.arange(BANDS, dtype=np.uint64)
                keys = mix(mixed).view(np.int64)
                some = np.bincount(owner, minlength=hi - lo) > 0
                same = [hashlib.sha256(b" ".join(t.encode("utf-8", "surrogatepass").split())).hexdigest() if s else None for t, s in zip(texts, some)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(same, pa.string()),
                        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some * BANDS)]), pa.int32()), pa.array(keys[some].ravel())),
                    ],
                    names=["rk", "words_sha256", "bands"],
                )

    return run


def _weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, token, w): every shingle of every text with its number of occurrences."""
    for batch in batches:
        for lo, hi in slices(_sizes(batch.column(1))):
            owner, value, weight = weighted_shingles(batch.column(1).slice(lo, hi - lo).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo).take(pa.array(owner)), pa.array(value.view(np.int64)), pa.array(weight.astype(np.float64))], names=["node", "token", "w"]
            )


def _verify(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def bag(owner, value, weight, i):
            lo, hi = np.searchsorted(owner, [i, i + 1])
            return value[lo:hi], weight[lo:hi]

        for batch in batches:
            for lo, hi in slices(_sizes(batch.column(2)) + _sizes(batch.column(3))):
                one = weighted_shingles(batch.column(2).slice(lo, hi - lo).to_pylist())
                two = weighted_shingles(batch.column(3).slice(lo, hi - lo).to_pylist())
                near = [probability_jaccard(bag(*one, i), bag(*two, i)) >= similarity - 1e-9 for i in range(hi - lo)]
                keep = pa.array(near, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(j).slice(lo, hi - lo).filter(keep) for j in (0, 1)], names=["a", "b"])

    return run


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(rk, id, class_id): every row's class; ``class_id`` is the least id in the component.

    Texts without a word (null, empty, blanks) are compared with nothing: their class is
    their own id. Repeated rows are equal texts, so of one class. Ties of ids are one
    document; null ids come after all others; an empty table gives no rows. Long texts
    are compared whole.
    """
    src = docs.select(row_key(id_col, text_col).alias("rk"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sigs = stored(src.select("rk", "text").mapInArrow(_signatures(), "rk long, words_sha256 string, bands array<long>"), "op2-signatures")
    filled = sigs.where("words_sha256 is not null")
    # written, so that the join splits the rows of a text with very many copies
    heads = stored(filled.groupBy("words_sha256").agg(F.min("rk").alias("node")), "op2-heads")
    nodes = stored(filled.select("rk", "words_sha256").join(heads, "words_sha256").select("rk", "node").distinct(), "op2-nodes")
    buckets = filled.select("rk", "bands").join(nodes.where("rk = node"), "rk").select("node", F.explode("bands").alias("key"))

    def payload(wanted: DataFrame) -> DataFrame:
        # both sides are shuffled whatever their size: the work grows evenly with the input
        return src.select(F.col("rk").alias("node"), "text").join(wanted.hint("merge"), "node", "left_semi").dropDuplicates(["node"])

    def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
        one = texts.toDF("a", "ta").hint("merge")
        two = texts.toDF("b", "tb").hint("merge")
        return pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb").mapInArrow(_verify(similarity), "a long, b long")

    def weights(texts: DataFrame) -> DataFrame:
        return texts.select("node", "text").mapInArrow(_weights, "node long, token long, w double")

    roots = bucket_classes(shared_buckets(buckets), payload, verify, weights, similarity).withColumnRenamed("node", "n2")
    of = nodes.join(roots, F.col("node") == F.col("n2"), "left").select("rk", F.coalesce("root", "node").alias("root"))
    rows = stored(src.select("rk", "id").join(of.withColumnRenamed("rk", "k2"), F.col("rk") == F.col("k2"), "left").select("rk", "id", "root"), "op2-rows")
    least = rows.where("root is not null").groupBy("root").agg(F.min("id").alias("class_id"))
    grouped = rows.join(least, "root").select("rk", "id", "class_id")
    return grouped.unionByName(rows.where("root is null").select("rk", "id", F.col("id").alias("class_id")))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each class: the row whose id is the class id. All columns stay.

    Repeated rows of that document are reduced to one; rows of other classes with null
    ids stay, as nothing names them.
    """
    classes = near_classes(docs, id_col, text_col, similarity)
    own, other, copies = unused(docs, "own_key", "kept_key", "copies")
    keep = classes.where(F.col("id").eqNullSafe(F.col("class_id"))).groupBy(F.col("rk").alias(other)).agg(F.count("*").alias(copies))
    joined = docs.withColumn(own, row_key(id_col, text_col)).join(keep, F.col(own) == F.col(other))
    once = joined.where(F.col(copies) == 1).select(*docs.columns)
    many = joined.where(F.col(copies) > 1).dropDuplicates([own]).select(*docs.columns)
    return once.unionByName(many)
