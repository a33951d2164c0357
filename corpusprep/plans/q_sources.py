"""Source and sink queries: listing, named splits, split folders, guarded and materialised writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.functions import text as tx
from corpusprep.plans import fixtures as fx
from corpusprep.plans.catalog import query
from corpusprep.plans.q_text import MAX_SECONDS, MIN_SECONDS, SAMPLE_RATE, length_ok
from corpusprep.session import scratch_path
from corpusprep.sources import files as fs
from corpusprep.sources import sinks as sk


TABLES = (
    "benchmark conversations customer documents embeddings events labels lineitem nation orders pages part region supplier"
).split()


_SQL_FILES = " UNION ALL ".join(f"SELECT CAST({i} AS BIGINT) AS position, '{t}.parquet' AS name, count(*) AS n_rows FROM {t}" for i, t in enumerate(TABLES))


@query("list_files", _SQL_FILES)
def q_list_files(spark, sf_dir):
    """The files of the table folder in path order, with the rows that their footers count."""
    files = fs.list_files(spark, sf_dir)
    rows = fs.row_groups(spark, sf_dir).groupBy("file").agg(F.sum("n_rows").alias("n_rows"))
    return files.join(rows, files.path == rows.file).select("position", F.regexp_extract("path", "[^/]*$", 0).alias("name"), "n_rows")


def _named(spark, sf_dir):
    return fs.read_named_splits(
        spark, {"train": f"{sf_dir}/documents.parquet", "eval": f"{sf_dir}/benchmark.parquet"}
    ).select("split", "doc_id", "item_id", "text")


_SQL_NAMED = """SELECT 'train' AS split, doc_id, CAST(NULL AS BIGINT) AS item_id, text FROM documents
UNION ALL SELECT 'eval' AS split, CAST(NULL AS BIGINT) AS doc_id, item_id, text FROM benchmark"""


@query("scan_named_splits", _SQL_NAMED)
def q_named_splits(spark, sf_dir):
    return _named(spark, sf_dir)


@query("scan_split_dir", "SELECT item_id, text, 'eval' AS split FROM benchmark")
def q_split_dir(spark, sf_dir):
    """Named splits written one plain folder per split; one split read back alone."""
    path = scratch_path(spark, "split-dir")
    for split in ("train", "eval"):
        _named(spark, sf_dir).filter(F.col("split") == split).drop("split").write.parquet(f"{path}/{split}")
    return fs.read_split(spark, path, "eval").select("item_id", "text", "split")


@query("split_layout", "SELECT split, count(*) AS n_rows, count(doc_id) AS n_documents, count(item_id) AS n_items FROM (" + _SQL_NAMED + ") t GROUP BY split")
def q_split_layout(spark, sf_dir):
    """Writer and reader agree on the layout: every split comes back whole."""
    path = scratch_path(spark, "layout")
    _named(spark, sf_dir).write.partitionBy("split").parquet(path)
    back = spark.read.parquet(path)
    return back.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("doc_id").alias("n_documents"), F.count("item_id").alias("n_items")
    )


@query(
    "source_registry",
    """SELECT doc_id, source, CAST(substr(source, 4) AS INT) AS source_id FROM documents
WHERE source IN (""" + ", ".join(f"'{n}'" for n in fx.SOURCE_NAMES) + ")",
)
def q_source_registry(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents").select("doc_id", "source")
    return fs.tag_sources(d, "source", fx.SOURCE_NAMES)


@query(
    "scan_sources",
    "SELECT doc_id, text, CAST(substr(source, 4) AS INT) AS source_id, source AS source_name FROM documents WHERE source IN (" + ", ".join(f"'{n}'" for n in fx.SOURCE_NAMES) + ")",
)
def q_scan_sources(spark, sf_dir):
    """A folder for each named source, read in registry order under a declared schema."""
    root = scratch_path(spark, "sources")
    d = fx.table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    d.write.partitionBy("source").parquet(root)
    folders = {n: f"{root}/source={n}" for n in fx.SOURCE_NAMES if fs.has_files(spark, f"{root}/source={n}")}
    found = fs.read_sources(spark, folders, d.drop("source").schema, ["doc_id", "text"])
    # a small table may lack a source: ids are places in the whole registry
    return found.withColumn("source_id", F.substring("source_name", 4, 9).cast("int"))


@query("overwrite_guard", "SELECT doc_id, true AS refused_second_write FROM documents")
def q_overwrite_guard(spark, sf_dir):
    """First write succeeds; a second one into the same folder without overwrite is refused."""
    path = scratch_path(spark, "guard")
    d = fx.table(spark, sf_dir, "documents").select("doc_id")
    sk.guarded_write(d, path)
    try:
        sk.guarded_write(d, path)
        refused = False
    except FileExistsError:
        refused = True
    return spark.read.parquet(path).withColumn("refused_second_write", F.lit(refused))


_SQL_PREPARED = f"""SELECT sample_id, {tx.sql_clean_target('text')} AS target, duration FROM v_samples
WHERE duration * {SAMPLE_RATE} > {MIN_SECONDS * SAMPLE_RATE} AND duration * {SAMPLE_RATE} < {MAX_SECONDS * SAMPLE_RATE}"""


def _prepared(spark, sf_dir):
    s = fx.v_samples(spark, sf_dir, previous=False, flags=False)
    return s.filter(length_ok(F.col("duration") * SAMPLE_RATE)).select("sample_id", tx.clean_target("text").alias("target"), "duration")


@query("materialise", _SQL_PREPARED, ("v_samples",))
def q_materialise(spark, sf_dir):
    """Preprocess only: write the prepared rows and continue from the written table."""
    return sk.materialise(_prepared(spark, sf_dir), scratch_path(spark, "prepared"))


@query("scan_saved_dir", _SQL_PREPARED, ("v_samples",))
def q_saved_dir(spark, sf_dir):
    """A saved dataset read whole (the training side of the pair)."""
    path = scratch_path(spark, "saved")
    sk.guarded_write(_prepared(spark, sf_dir), path)
    import warnings

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        train, _ = fs.read_saved(spark, path)
    return train


@query("scan_saved_eval", f"WITH p AS ({_SQL_PREPARED}) SELECT 'same' AS side, sample_id, target FROM p UNION ALL SELECT 'eval', item_id, text FROM benchmark", ("v_samples",))
def q_saved_eval(spark, sf_dir):
    """The evaluation side of a saved dataset: a folder of its own, and the training folder where none is given."""
    import warnings

    train, other = scratch_path(spark, "saved-train"), scratch_path(spark, "saved-eval")
    sk.guarded_write(_prepared(spark, sf_dir), train)
    sk.guarded_write(fx.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("sample_id"), F.col("text").alias("target")), other)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        _, same = fs.read_saved(spark, train)
    _, own = fs.read_saved(spark, train, other)
    side = lambda df, name: df.select(F.lit(name).alias("side"), "sample_id", "target")
    return side(same, "same").unionByName(side(own, "eval"))
