"""Mixing, splitting, ordering and sizing queries over the eight-source fixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions.draws import ladder, sql_bucket, sql_draw, sql_draw_hash
from corpusprep.operators import mix as mx
from corpusprep.operators.split import exact_split, leakage, three_way_split
from corpusprep.plans import fixtures as fx
from corpusprep.plans.catalog import query

SEED = 42
# Default split ratios of the mixing job.
TEST_RATIO = "0.005"
VALID_RATIO = "0.1"


def mixed(spark: SparkSession, sf_dir: str, stop: str, first: int | None = None) -> DataFrame:
    keys = fx.v_sources(spark, sf_dir)
    return mx.mix(keys, fx.WEIGHT_LIST, SEED, stop, first=first).select("slot", "doc_id", "source_id", "occ", "k")


def _sql_mixed(agg: str) -> str:
    weights = mx.parse_weights(fx.WEIGHT_LIST)
    thr = ladder(weights)
    rows = ", ".join(f"({i}, {float(w)!r}::DOUBLE)" for i, w in enumerate(weights))
    return f"""
n AS (SELECT source_id, count(*) AS n FROM v_sources GROUP BY source_id),
far AS (SELECT CAST({agg}(n / w + 10 * sqrt(n) / w) + 2000 AS BIGINT) AS slots FROM n JOIN (VALUES {rows}) w(source_id, w) USING (source_id)),
b AS (SELECT id AS slot, {sql_bucket(sql_draw(SEED, 'mix', 'id'), thr)} AS source_id FROM (SELECT unnest(range(0, slots)) AS id FROM far) t),
o AS (SELECT slot, source_id, row_number() OVER (PARTITION BY source_id ORDER BY slot) - 1 AS occ FROM b),
stop AS (SELECT {agg}(slot) AS last FROM o JOIN n USING (source_id) WHERE occ = n - 1),
m AS (SELECT o.slot, s.doc_id, o.source_id, o.occ, s.k FROM o JOIN n USING (source_id) CROSS JOIN stop
      JOIN v_sources s ON s.source_id = o.source_id AND s.k = o.occ % n.n WHERE o.slot <= stop.last)"""


@query("mix_all_exhausted", "WITH" + _sql_mixed("max") + "\nSELECT * FROM m", ("v_sources",))
def q_mix_all(spark, sf_dir):
    return mixed(spark, sf_dir, mx.ALL_EXHAUSTED)


@query("mix_first_exhausted", "WITH" + _sql_mixed("min") + "\nSELECT * FROM m", ("v_sources",))
def q_mix_first(spark, sf_dir):
    return mixed(spark, sf_dir, mx.FIRST_EXHAUSTED)


def _sql_weights() -> str:
    w = mx.parse_weights(fx.SOURCE_WEIGHTS, names=fx.SOURCE_NAMES)
    thr = ladder(w)
    rows = ", ".join(
        f"({i}, '{fx.SOURCE_NAMES[i]}', {float(w[i])!r}, {thr[i - 1] if i else 0}, {thr[i]})" for i in range(len(w))
    )
    return f"""SELECT CAST(source_id AS INTEGER) AS source_id, name, CAST(weight AS DOUBLE) AS weight, CAST(lo AS BIGINT) AS lo, CAST(hi AS BIGINT) AS hi,
 CAST(n_rows AS BIGINT) AS n_rows
FROM (VALUES {rows}) w(source_id, name, weight, lo, hi)
JOIN (SELECT source_id, count(*) AS n_rows FROM v_sources GROUP BY source_id) c USING (source_id)"""


@query("mix_weights", _sql_weights(), ("v_sources",))
def q_mix_weights(spark, sf_dir):
    """Parsed weights as integer draw intervals, beside each source's row count."""
    w = mx.weights_frame(spark, fx.SOURCE_WEIGHTS, fx.SOURCE_NAMES)
    n = fx.v_sources(spark, sf_dir).groupBy("source_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return w.join(F.broadcast(n), "source_id")


def _sql_split(src: str, key: str) -> str:
    h = sql_draw_hash(SEED, "split", key)
    v = sql_draw_hash(SEED, "valid", key)
    return f"""
d1 AS (SELECT {key}, row_number() OVER (ORDER BY {h}, {key}) - 1 AS r, count(*) OVER () AS t FROM {src}),
s1 AS (SELECT {key}, CASE WHEN r < ceil({TEST_RATIO} * t) THEN 'test' ELSE 'train' END AS split FROM d1),
d2 AS (SELECT {key}, row_number() OVER (ORDER BY {v}, {key}) - 1 AS r, count(*) OVER () AS t FROM s1 WHERE split = 'test'),
g AS (SELECT {key}, split FROM s1 WHERE split = 'train'
      UNION ALL SELECT {key}, CASE WHEN r < ceil({VALID_RATIO} * t) THEN 'valid' ELSE 'test' END FROM d2)"""


_FLAGSHIP_SQL = (
    "WITH"
    + _sql_mixed("max")
    + ",\norig AS (SELECT DISTINCT doc_id FROM m),"
    + _sql_split("orig", "doc_id")
    + """
SELECT split, source_id, count(*) AS n_rows, count(DISTINCT m.doc_id) AS n_origins,
       min(slot) AS first_slot, max(slot) AS last_slot
FROM m JOIN g USING (doc_id) GROUP BY split, source_id"""
)


def flagship_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole mixing job on the documents (payload included), summarised from the written shards."""
    from corpusprep.plans.jobs import interleave_job
    from corpusprep.session import scratch_path
    from corpusprep.sources.files import tag_sources

    docs = tag_sources(fx.table(spark, sf_dir, "documents"), "source", fx.SOURCE_NAMES)
    out = scratch_path(spark, "interleaved")
    interleave_job(docs, fx.WEIGHT_LIST, out, SEED, mx.ALL_EXHAUSTED, TEST_RATIO, VALID_RATIO)
    m = spark.read.parquet(out)
    return m.groupBy("split", "source_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("doc_id").alias("n_origins"),
        F.min("slot").alias("first_slot"),
        F.max("slot").alias("last_slot"),
    )


query("mixed_then_split", _FLAGSHIP_SQL, ("v_sources",))(flagship_summary)


@query(
    "exact_split",
    f"""WITH d1 AS (SELECT doc_id, row_number() OVER (ORDER BY {sql_draw_hash(SEED, 'split', 'doc_id')}, doc_id) - 1 AS r,
  count(*) OVER () AS t FROM v_sources)
SELECT doc_id, source_id, CASE WHEN r < ceil({TEST_RATIO} * t) THEN 'test' ELSE 'train' END AS split FROM d1 JOIN v_sources USING (doc_id)""",
    ("v_sources",),
)
def q_exact_split(spark, sf_dir):
    keys = fx.v_sources(spark, sf_dir).select("doc_id", "source_id")
    return exact_split(keys, "doc_id", TEST_RATIO, SEED)


@query(
    "three_way_split",
    "WITH" + _sql_split("v_sources", "doc_id") + "\nSELECT doc_id, source_id, split FROM g JOIN v_sources USING (doc_id)",
    ("v_sources",),
)
def q_three_way(spark, sf_dir):
    keys = fx.v_sources(spark, sf_dir).select("doc_id", "source_id")
    return three_way_split(keys, "doc_id", TEST_RATIO, VALID_RATIO, SEED)


@query(
    "split_leakage",
    "WITH"
    + _sql_mixed("max")
    + ",\nmm AS (SELECT slot, doc_id FROM m),"
    + _sql_split("mm", "slot")
    + """
SELECT count(*) AS n_leaked_origins FROM (
  SELECT doc_id FROM (SELECT DISTINCT mm.doc_id, g.split FROM mm JOIN g USING (slot)) x GROUP BY doc_id HAVING count(*) > 1) y""",
    ("v_sources",),
)
def q_split_leakage(spark, sf_dir):
    """Compat split (by output slot) and the number of origins it leaks across sides."""
    m = mixed(spark, sf_dir, mx.ALL_EXHAUSTED).select("slot", "doc_id")
    return leakage(three_way_split(m, "slot", TEST_RATIO, VALID_RATIO, SEED), "doc_id")
