"""Fuzzy line deduplication by MinHash, in DataFrame functions only.

A line is compared by its set of character shingles (``SHINGLE`` code points; a
shorter line is one shingle). One hash per shingle feeds a one-permutation MinHash:
the hash names a bin and the least hash of each bin is the signature, over all shingles
of a line however long it is. Bins are banded by threes; two lines of similarity
``SIMILARITY`` share no band with a probability of about (1 - 0.8 ** 3) ** 16 = 1e-5;
candidates that agree in ``AGREE`` of all bins (of lines of similarity ``SIMILARITY`` one pair in 10 ** 9 does not, were bins independent)
are verified by the Jaccard similarity of their sets of 64-bit shingle hashes, linked
lines become components by distributed union-find, and the first line of each
component in order of (id, line number) stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm.common import bucket_classes, row_key, shared_buckets, shuffle_partitions, stored, unused

SHINGLE = 10
SIMILARITY = 0.8
BINS = 48
ROWS = 3
#: A hash is at most this, and ends in four bits for one of the 16 bands and 16 bits for the place in it.
LARGEST = 9223372036854775807
PLACES = 1 << 16
#: Columns of a line's signature; bins in which two lines must agree before their shingles are compared.
SKETCH = [f"f{k}" for k in range(BINS // 8)]
AGREE = 20


def small_tasks(spark: SparkSession) -> dict[str, str]:
    """Settings for the step that hashes every line: the groups of a task, some 15 a line, are kept in its fastest map if there are few
    of them, so a task has an eighth of the lines of others, as far as that makes 4,000 tasks at most."""
    n = shuffle_partitions(spark)
    return {"spark.sql.shuffle.partitions": str(max(n, min(8 * n, 4000))), "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rk, id, line_no, line): every line; ``line`` is stripped of spaces, tabs and carriage returns."""
    src = docs.select(row_key(id_col, text_col).alias("rk"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return src.select("rk", "id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")).select(
        "rk", "id", F.col("line_no").cast("long").alias("line_no"), F.expr("trim(BOTH ' \t\r' FROM line)").alias("line")
    )


def minima(lines: DataFrame) -> DataFrame:
    """(lk, band, m0, ...): for every line of (lk, line) and band of ``ROWS`` bins of which one is filled, the least hash of each bin, null if it has none.

    Rows of one line stay together where they are dealt by ``lk``, so nothing is exchanged. A group is
    a band, not a bin: the minima of a band are updated in one row.
    """
    points = lines.select("lk", F.encode("line", "UTF-32").alias("points"))
    each = points.selectExpr("lk", "points", f"explode({_starts('points')}) as i")
    hashed = each.selectExpr("lk", f"xxhash64(substring(points, i, {4 * SHINGLE})) & {LARGEST}L as h")
    # the lowest bits name the band, the next 16 the bin in it
    placed = hashed.selectExpr("lk", f"int(h & {BINS // ROWS - 1}L) as band", f"shiftright(h, 4) & {PLACES - 1}L as place", "h")
    ends = [PLACES * i // ROWS for i in range(ROWS + 1)]
    least = [f"min(if(place >= {ends[i]} and place < {ends[i + 1]}, h, {LARGEST}L))" for i in range(ROWS)]
    return placed.groupBy("lk", "band").agg(*[F.expr(f"nullif({e}, {LARGEST}L)").alias(f"m{i}") for i, e in enumerate(least)])


def bands(lines: DataFrame) -> DataFrame:
    """(node, key): one key for each band of ``ROWS`` bins of which at least one is filled."""
    same = ", ".join(f"m{i}, m{i} is null" for i in range(ROWS))
    return minima(lines).selectExpr("lk as node", f"xxhash64(band, {same}) as key")


def signatures(lines: DataFrame) -> DataFrame:
    """(lk, f0, ...): eight bits of the least hash of each bin of a line, eight bins in a long; an empty bin is zero."""
    half = BINS // ROWS // 8  # longs that the bins of one place in a band fill
    part = lambda k: f"if(band div 8 = {k % half}, shiftleft(coalesce(shiftright(m{k // half}, 20) & 255L, 0L), int(8 * (band % 8))), 0L)"
    return minima(lines).groupBy("lk").agg(*[F.expr(f"bit_or({part(k)})").alias(c) for k, c in enumerate(SKETCH)])


def alike(a: str, b: str, similarity: float = SIMILARITY) -> str:
    """SQL: whether lines a and b, in columns that start so, have shingle sets of like sizes ``n`` and ``signatures`` that agree in ``AGREE``
    bins or more; any signatures, where less than ``SIMILARITY`` is asked for."""
    low, top = 0x3F3F3F3F3F3F3F3F, 0x4040404040404040
    differ = []
    for c in SKETCH:
        bits = f"({a}{c} ^ {b}{c})"
        half = f"shiftrightunsigned({bits}, 1)"  # so that the sum stays in its byte and in a long
        differ.append(f"bit_count((({half} & {low}L) + {low}L | {half} | shiftleft({bits}, 6)) & {top}L)")  # one bit for each byte that differs
    sizes = f"least({a}n, {b}n) >= {similarity} * greatest({a}n, {b}n)"  # sets whose sizes differ too much cannot be similar
    return f"{sizes} and {' + '.join(differ)} <= {BINS - (AGREE if similarity >= SIMILARITY else 0)}"


def _starts(points: str) -> str:
    """SQL for the first byte of every shingle of a line in UTF-32."""
    return f"sequence(1, greatest(1, length({points}) - {4 * SHINGLE - 1}), 4)"


def shingles(line: str) -> str:
    """SQL for a line's shingles, as 64-bit hashes, in order and as often as they stand there."""
    return f"flatten(transform(array(encode({line}, 'UTF-32')), p -> transform({_starts('p')}, i -> xxhash64(substring(p, i, {4 * SHINGLE})))))"


def shingle_set(line: str) -> str:
    """SQL for the set of a line's shingles, as 64-bit hashes."""
    return f"array_distinct({shingles(line)})"


def verified(pairs: DataFrame, lines: DataFrame, similarity: float) -> DataFrame:
    """The (a, b) pairs of line keys whose shingle sets have Jaccard similarity ``similarity`` or more."""
    one, two = (lines.select(F.col("node").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in ("line", "n", *SKETCH)]).hint("merge") for x in "ab")
    near = pairs.join(one, "a").join(two, "b").where(alike("a_", "b_", similarity))
    common = f"size(array_intersect({shingles('a_line')}, {shingles('b_line')}))"  # a set
    return near.where(f"{common} * (1 + {similarity}) >= {similarity} * (a_n + b_n)").select("a", "b")


def line_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per line: (rk, id, line_no, class_id, class_line, kept).

    ``class_id``, ``class_line``: id and number of the line that stays for this line's
    component (the first by id, then number; null ids first). A blank line has a null
    class and is kept. Null texts have no lines; an empty text is one blank line;
    repeated rows are told apart only by which is kept: their equal lines are all but
    one removed through (id, line number), so exact row copies keep the same lines.
    Long lines are compared whole. Empty tables give no rows; other columns are ignored.
    """
    lines = _lines(docs, id_col, text_col)
    texts = lines.where("line <> ''").select(F.xxhash64("line").alias("lk"), "line")

    def payload(wanted: DataFrame) -> DataFrame:
        # both sides are shuffled whatever their size: the work grows evenly with the input
        own = texts.select(F.col("lk").alias("node"), "line").join(wanted.hint("merge"), "node", "left_semi")
        one_each = stored(own.groupBy("node").agg(F.min("line").alias("line")), "op4-texts").repartition(2 * shuffle_partitions(docs.sparkSession), "node")
        signed = signatures(one_each.select(F.col("node").alias("lk"), "line")).withColumnRenamed("lk", "node")
        return one_each.selectExpr("node", "line", f"size({shingle_set('line')}) as n").join(signed.hint("merge"), "node")

    def tokens(lines: DataFrame) -> DataFrame:
        return lines.selectExpr("node", "n", f"explode({shingle_set('line')}) as token")

    # equal lines are one from here on; their rows are dealt by line, which the signatures need
    distinct = texts.groupBy("lk").agg(F.first("line").alias("line"))
    roots = bucket_classes(
        shared_buckets(bands(distinct), small_tasks(docs.sparkSession)), payload, lambda pairs, lines: verified(pairs, lines, similarity), tokens, similarity,
        counted=True, sketch=(*SKETCH, "n"), alike=alike("a_", "b_", similarity),
    )
    # a blank line has a key of its own: null keys would all go to one task
    rows = lines.select("rk", "id", "line_no", F.when(F.col("line") != "", F.xxhash64("line")).alias("lk"), F.xxhash64("rk", "line_no").alias("alone"))
    where = rows.join(roots, F.coalesce("lk", "alone") == F.col("node"), "left")
    where = stored(where.select("rk", "id", "line_no", F.when(F.col("lk").isNotNull(), F.coalesce("root", "lk")).alias("root")), "op4-where")
    first = where.where("root is not null").groupBy("root").agg(F.min(F.struct("id", "line_no")).alias("first"))
    judged = where.join(first, "root").select(
        "rk", "id", "line_no",
        F.col("first.id").alias("class_id"),
        F.col("first.line_no").alias("class_line"),
        (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("line_no") == F.col("first.line_no"))).alias("kept"),
    )
    blank = where.where("root is null").select("rk", "id", "line_no")
    id_type = docs.schema[id_col].dataType
    return judged.unionByName(
        blank.select("*", F.lit(None).cast(id_type).alias("class_id"), F.lit(None).cast("long").alias("class_line"), F.lit(True).alias("kept"))
    )


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with every line removed that is not the one kept of its component; all columns stay.

    A text that loses all its lines becomes empty; a text that loses none is unchanged,
    byte for byte; a null text stays null. See ``line_classes`` for ties and odd rows.
    """
    own, other, gone = unused(docs, "own_key", "lost_key", "lost_lines")
    lost = line_classes(docs, id_col, text_col, similarity).where("not kept").groupBy("rk").agg(F.collect_set("line_no").alias(gone))
    keyed = docs.withColumn(own, row_key(id_col, text_col))
    text = F.col(text_col)
    kept = F.array_join(
        F.transform(
            F.filter(F.arrays_zip(F.split(text, "\n", -1).alias("line"), F.sequence(F.lit(0).cast("long"), (F.size(F.split(text, "\n", -1)) - 1).cast("long")).alias("no")), lambda x: ~F.array_contains(F.col(gone), x["no"])),
            lambda x: x["line"],
        ),
        "\n",
    )
    out = keyed.join(lost.withColumnRenamed("rk", other), F.col(own) == F.col(other), "left")
    return out.select(*[F.when(F.col(gone).isNull(), text).otherwise(kept).alias(c) if c == text_col else F.col(c) for c in docs.columns])
