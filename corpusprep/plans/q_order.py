"""Ordering and sizing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.functions.draws import sql_draw, sql_draw_hash
from corpusprep.operators import order as od
from corpusprep.operators.shard import estimate_bytes, shard_count
from corpusprep.operators.split import three_way_split
from corpusprep.plans import fixtures as fx
from corpusprep.plans.catalog import query
from corpusprep.plans.q_mix import SEED, TEST_RATIO, VALID_RATIO, _sql_mixed, _sql_split, mixed
from corpusprep.operators.index import hash_block
from corpusprep.sources.sinks import shard_layout

BUFFER = 20  # fixed value: default shuffle buffer of the streaming reader
EVAL_ROWS = 2048  # fixed value: evaluation row cap of the launchers
WORLD = 4
MAX_SAMPLES = 2048
SMALL_SHARD = 262144  # shard limit small enough to cut test-sized splits


@query(
    "full_shuffle",
    f"SELECT doc_id, row_number() OVER (ORDER BY {sql_draw_hash(SEED, 'shuffle', '0', 'doc_id')}, doc_id) - 1 AS pos FROM documents",
)
def q_full_shuffle(spark, sf_dir):
    return od.full_shuffle(fx.table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SEED, 0)


def _sql_buffered(epoch: int) -> str:
    key = f"CAST(idx AS HUGEINT) * 4294967296 + {BUFFER} * {sql_draw(SEED, 'buffer', str(epoch), 'idx')}"
    return f"""SELECT doc_id, CAST({epoch} AS INTEGER) AS epoch, idx, row_number() OVER (ORDER BY {key}, idx) - 1 AS pos
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents) d"""


def _indexed(spark, sf_dir):
    from corpusprep.operators.index import dense_index

    return dense_index(fx.table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"])


def _buffered(d, epoch):
    return od.buffered_shuffle(d, "idx", BUFFER, SEED, epoch).select("doc_id", F.lit(epoch).alias("epoch"), "idx", "pos")


@query("buffered_shuffle", _sql_buffered(0))
def q_buffered(spark, sf_dir):
    return _buffered(_indexed(spark, sf_dir), 0)


@query("epoch_reshuffle", "\nUNION ALL\n".join(_sql_buffered(e) for e in (0, 1, 2)))
def q_epochs(spark, sf_dir):
    out, d = None, _indexed(spark, sf_dir)  # one checkpointed index for every epoch
    for e in (0, 1, 2):
        b = _buffered(d, e)
        out = b if out is None else out.unionByName(b)
    return out


SLICE = 512  # rows of one replacement buffer in the query, so that every table has several


def _sql_replacement() -> str:
    """The buffer step by step: every step of the recursion takes one arrival of each slice."""
    slot = f"CAST({sql_draw(SEED, 'slot', '0', 'd.slice', 'd.k')} % {BUFFER} AS INTEGER)"
    return f"""WITH RECURSIVE d0 AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents),
d AS MATERIALIZED (SELECT doc_id, idx, idx // {SLICE} AS slice, idx % {SLICE} AS k FROM d0),
st AS (SELECT slice, CAST({BUFFER} AS BIGINT) AS t, list(idx ORDER BY k) AS buf, CAST(NULL AS BIGINT) AS leaves FROM d WHERE k < {BUFFER} GROUP BY slice
  UNION ALL SELECT st.slice, t + 1, list_concat(list_concat(buf[1:{slot}], [d.idx]), buf[{slot} + 2:]), buf[{slot} + 1]
  FROM st JOIN d ON d.slice = st.slice AND d.k = st.t),
ends AS (SELECT slice, unnest(arg_max(buf, t)) AS idx, generate_subscripts(arg_max(buf, t), 1) - 1 AS slot, greatest((SELECT count(*) FROM d WHERE d.slice = st.slice) - {BUFFER}, 0) AS gone FROM st GROUP BY slice),
o AS (SELECT leaves AS idx, slice * {SLICE} + t - 1 - {BUFFER} AS pos FROM st WHERE leaves IS NOT NULL
  UNION ALL SELECT idx, slice * {SLICE} + gone + row_number() OVER (PARTITION BY slice ORDER BY {sql_draw_hash(SEED, 'rest', '0', 'slice', 'slot')}, slot) - 1 FROM ends)
SELECT doc_id, idx, CAST(pos AS BIGINT) AS pos FROM o JOIN d USING (idx)"""


@query("replacement_shuffle", _sql_replacement())
def q_replacement(spark, sf_dir):
    """Shuffle by a buffer whose drawn row is replaced by the next arrival."""
    return od.replacement_shuffle(_indexed(spark, sf_dir), "idx", BUFFER, SEED, 0, slice_rows=SLICE).select("doc_id", "idx", "pos")


FEED_FILES = 10


@query(
    "file_order_shuffle",
    f"""WITH f AS (SELECT doc_id, doc_id % {FEED_FILES} AS part FROM documents),
o AS (SELECT doc_id, row_number() OVER (ORDER BY {sql_draw_hash(SEED, 'files', '0', "concat('part=', part)")}, part, doc_id) - 1 AS idx FROM f)
SELECT doc_id, row_number() OVER (ORDER BY CAST(idx AS HUGEINT) * 4294967296 + {BUFFER} * {sql_draw(SEED, 'buffer', '0', 'idx')}, idx) - 1 AS pos FROM o""",
)
def q_file_order(spark, sf_dir):
    """Documents written as 10 files, one per folder, then shuffled by file and buffer."""
    from corpusprep.session import scratch_path

    path = scratch_path(spark, "file-order")
    d = fx.table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % FEED_FILES).alias("part"))
    d.repartition(FEED_FILES, "part").sortWithinPartitions("part", "doc_id").write.partitionBy("part").parquet(path)
    return od.file_order_shuffle(spark.read.parquet(path), path, BUFFER, SEED, 0).select("doc_id", "pos")


@query(
    "take_first",
    "WITH" + _sql_mixed("max") + f"\nSELECT slot, doc_id, source_id FROM m ORDER BY slot LIMIT {EVAL_ROWS}",
    ("v_sources",),
)
def q_take_first(spark, sf_dir):
    few = mixed(spark, sf_dir, "all_exhausted", first=EVAL_ROWS)
    return od.take_first(few, EVAL_ROWS, "slot").select("slot", "doc_id", "source_id")


@query(
    "rank_shard",
    f"""SELECT doc_id, CAST((row_number() OVER (ORDER BY source_id, k) - 1) % {WORLD} AS INTEGER) AS rank FROM v_sources""",
    ("v_sources",),
)
def q_rank_shard(spark, sf_dir):
    from corpusprep.operators.index import dense_index

    # (source, k) is unique; block = source * 2^32 + k div 65536 is non-decreasing in it
    blk = F.col("source_id").cast("bigint") * F.lit(1 << 32) + F.floor(F.col("k") / 65536).cast("bigint")
    d = dense_index(fx.v_sources(spark, sf_dir), ["source_id", "k"], block=blk)
    return od.rank_shard(d, "idx", WORLD).select("doc_id", "rank")


@query(
    "sample_counts",
    "WITH" + _sql_split("v_sources", "doc_id") + f"""
SELECT split, count(*) AS n_rows, least(count(*), {MAX_SAMPLES}) AS n_samples FROM g GROUP BY split""",
    ("v_sources",),
)
def q_sample_counts(spark, sf_dir):
    s = three_way_split(fx.v_sources(spark, sf_dir), "doc_id", TEST_RATIO, VALID_RATIO, SEED)
    c = s.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
    return c.withColumn("n_samples", F.least(F.col("n_rows"), F.lit(MAX_SAMPLES).cast("bigint")))


DOC_BYTES_SQL = "(8 + coalesce(strlen(text), 0) + coalesce(strlen(lang), 0) + coalesce(strlen(source), 0) + 8)"


@query("estimate_bytes", f"SELECT count(*) AS n_rows, CAST(sum({DOC_BYTES_SQL}) AS BIGINT) AS nbytes FROM documents")
def q_estimate_bytes(spark, sf_dir):
    return estimate_bytes(fx.table(spark, sf_dir, "documents"))


def _doc_split(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents")
    return three_way_split(d, "doc_id", TEST_RATIO, VALID_RATIO, SEED)


_SQL_DOC_SPLIT = "WITH" + _sql_split("documents", "doc_id")


@query(
    "shard_count",
    _SQL_DOC_SPLIT
    + f"""
SELECT split, count(*) AS n_rows, CAST(sum({DOC_BYTES_SQL}) AS BIGINT) AS nbytes,
 CAST(greatest(sum({DOC_BYTES_SQL}) // 2000000000 + 1, 1) AS BIGINT) AS n_shards,
 CAST(greatest(sum({DOC_BYTES_SQL}) // {SMALL_SHARD} + 1, 1) AS BIGINT) AS n_shards_small
FROM g JOIN documents USING (doc_id) GROUP BY split""",
)
def q_shard_count(spark, sf_dir):
    s = _doc_split(spark, sf_dir)
    e = estimate_bytes(s, "split")
    return e.select("split", "n_rows", "nbytes", shard_count("nbytes").alias("n_shards"), shard_count("nbytes", SMALL_SHARD).alias("n_shards_small"))


def _sql_shards() -> str:
    h = sql_draw_hash(SEED, "order", "doc_id")
    return (
        _SQL_DOC_SPLIT
        + f""",
x AS (SELECT g.split, doc_id, {DOC_BYTES_SQL} AS b, row_number() OVER (PARTITION BY g.split ORDER BY {h}, doc_id) - 1 AS idx
      FROM g JOIN documents USING (doc_id)),
sz AS (SELECT split, count(*) AS n, least(greatest(sum(b) // {SMALL_SHARD} + 1, 1), count(*)) AS s FROM x GROUP BY split),
y AS (SELECT x.split, doc_id, idx, n, s, n // s AS q, n % s AS r FROM x JOIN sz USING (split)),
sh AS (SELECT split, doc_id, idx, CAST(CASE WHEN idx < r * (q + 1) THEN idx // (q + 1) ELSE r + (idx - r * (q + 1)) // q END AS BIGINT) AS shard FROM y)"""
    )


def sharded(spark, sf_dir):
    """(doc_id, split, idx, shard, part) computed on keys and row sizes only, and the plan of the write."""
    from corpusprep.functions.draws import draw_hash
    from corpusprep.operators.shard import row_bytes

    d = fx.table(spark, sf_dir, "documents")
    keys = d.select("doc_id", row_bytes(d).alias("_bytes"))
    s = three_way_split(keys, "doc_id", TEST_RATIO, VALID_RATIO, SEED)
    h = draw_hash(SEED, "order", "doc_id")
    laid, plan = shard_layout(s, [h, "doc_id"], "split", SMALL_SHARD, bytes_col="_bytes", block=hash_block(h), blocks_bound=65536)
    return laid.drop("_bytes"), plan


@query("contiguous_shard", _sql_shards() + "\nSELECT split, doc_id, idx, shard FROM sh")
def q_contiguous(spark, sf_dir):
    return sharded(spark, sf_dir)[0].select("split", "doc_id", "idx", "shard")


@query(
    "write_sharded",
    _sql_shards()
    + "\nSELECT split, shard, count(*) AS n_rows, min(idx) AS first_idx, max(idx) AS last_idx, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM sh JOIN documents USING (doc_id) GROUP BY split, shard",
)
def q_write_sharded(spark, sf_dir):
    """Write the split documents as contiguous shards, read the folder back, describe each shard."""
    back = spark.read.parquet(_written(spark, sf_dir))
    return back.groupBy("split", F.col("shard").cast("bigint").alias("shard")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"), F.sum("n_chars").alias("n_chars")
    )


def _written(spark, sf_dir):
    from corpusprep.session import scratch_path
    from corpusprep.sources.sinks import write_sharded

    path = scratch_path(spark, "sharded")
    keys, plan = sharded(spark, sf_dir)
    payload = fx.table(spark, sf_dir, "documents")
    write_sharded(keys.join(payload, "doc_id"), path, plan=plan)  # payload joined once, at the write
    return path


@query(
    "row_groups",
    _sql_shards()
    + """
SELECT split, shard, count(*) AS n_rows, (count(*) + 127) // 128 AS n_groups, least(count(*), 128) AS longest,
 count(*) - 128 * ((count(*) - 1) // 128) AS last_rows FROM sh GROUP BY split, shard""",
)
def q_row_groups(spark, sf_dir):
    """The row groups of the written shards, from the footers of their files: 128 rows each, but for the last of a shard."""
    from corpusprep.sources.files import row_groups

    groups = row_groups(spark, _written(spark, sf_dir))
    folder = F.url_decode("file")
    each = groups.select(
        F.regexp_extract(folder, "split=([^/]*)/", 1).alias("split"), F.regexp_extract(folder, "shard=([0-9]+)/", 1).cast("bigint").alias("shard"), "file", "group", "n_rows"
    )
    return each.groupBy("split", "shard").agg(
        F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_groups"), F.max("n_rows").alias("longest"), F.max_by("n_rows", F.struct("file", "group")).alias("last_rows")
    )
