"""Projection, schema, string and filter queries over the sample and document fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.functions import text as tx
from corpusprep.operators import schema as sc
from corpusprep.plans import fixtures as fx
from corpusprep.plans.catalog import query

SAMPLE_RATE = 16000
MIN_SECONDS, MAX_SECONDS = 0.0, 30.0  # fixed values: length range of the prepare step


@query("scan_inferred", "SELECT * FROM documents")
def q_scan_inferred(spark, sf_dir):
    from corpusprep.sources.files import read_inferred

    return read_inferred(spark, f"{sf_dir}/documents.parquet")


DOC_SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@query("scan_declared", "SELECT doc_id, source, n_chars FROM documents")
def q_scan_declared(spark, sf_dir):
    from pyspark.sql.types import _parse_datatype_string

    from corpusprep.sources.files import read_declared

    return read_declared(spark, f"{sf_dir}/documents.parquet", _parse_datatype_string(DOC_SCHEMA), ["doc_id", "source", "n_chars"])


@query("project_columns", "SELECT vec_id, label FROM embeddings")
def q_project(spark, sf_dir):
    return fx.table(spark, sf_dir, "embeddings").select("vec_id", "label")


@query(
    "drop_columns",
    "SELECT sample_id, text, text_timestamps, previous_text, stage2_whisper_timestamps FROM v_samples",
    ("v_samples",),
)
def q_drop(spark, sf_dir):
    return sc.drop_metadata(fx.v_samples(spark, sf_dir))


@query(
    "replace_all_columns",
    "SELECT embedding AS input_features, CAST(len(embedding) AS INTEGER) AS input_length FROM embeddings",
)
def q_replace_all(spark, sf_dir):
    e = fx.table(spark, sf_dir, "embeddings")
    return e.select(F.col("embedding").alias("input_features"), F.size("embedding").alias("input_length"))


@query(
    "conform_schema",
    """SELECT CAST([duration, sample_id, sample_id, duration] AS FLOAT[]) AS input_features, CAST([1, 0] AS INTEGER[]) AS attention_mask,
 CAST([sample_id] AS INTEGER[]) AS labels, CAST([sample_id, 1] AS INTEGER[]) AS labels_timestamps,
 text, text_timestamps, previous_text, CAST(duration AS FLOAT) AS duration,
 concat('audio/', CAST(sample_id AS VARCHAR), '.wav') AS audio_path, is_silence, stage2_whisper_timestamps, data_source FROM v_samples""",
    ("v_samples",),
)
def q_conform(spark, sf_dir):
    """All declared fields; the features come as a 2 x 2 matrix and leave flat."""
    s = fx.v_samples(spark, sf_dir).withColumn("audio_path", F.concat(F.lit("audio/"), F.col("sample_id").cast("string"), F.lit(".wav")))
    number = F.col("sample_id").cast("double")
    s = s.withColumns(
        {
            "input_features": F.array(F.array("duration", number), F.array(number, "duration")),
            "attention_mask": F.array(F.lit(1).cast("long"), F.lit(0).cast("long")),
            "labels": F.array("sample_id"),
            "labels_timestamps": F.array(F.col("sample_id"), F.lit(1).cast("long")),
        }
    )
    return sc.conform(s, sc.SAMPLE_SCHEMA, feature_shape=(2, 2))


@query(
    "numeric_view",
    "SELECT vec_id, CAST(embedding AS FLOAT[]) AS input_features, CAST([label] AS INTEGER[]) AS labels, label FROM embeddings",
)
def q_numeric_view(spark, sf_dir):
    e = fx.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").alias("input_features"), F.array(F.col("label").cast("bigint")).alias("labels"), "label"
    )
    return sc.numeric_view(e)


@query(
    "flatten_structs",
    """SELECT o_orderkey AS "o_orderkey", o_custkey AS "info.o_custkey", o_totalprice AS "info.o_totalprice",
 o_orderstatus AS "info.status.o_orderstatus", o_orderpriority AS "info.status.o_orderpriority" FROM orders""",
)
def q_flatten(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    nested = o.select(
        "o_orderkey",
        F.struct("o_custkey", "o_totalprice", F.struct("o_orderstatus", "o_orderpriority").alias("status")).alias("info"),
    )
    return sc.flatten(nested)


@query("require_columns", "SELECT sample_id, text, duration FROM v_samples", ("v_samples",))
def q_require(spark, sf_dir):
    s = sc.require_columns(fx.v_samples(spark, sf_dir, previous=False, flags=False), ["text", "duration"])
    return s.select("sample_id", "text", "duration")


@query(
    "clean_target",
    f"SELECT sample_id, {tx.sql_clean_target('text')} AS target FROM v_samples",
    ("v_samples",),
)
def q_clean_target(spark, sf_dir):
    return fx.v_samples(spark, sf_dir, previous=False, flags=False).select("sample_id", tx.clean_target("text").alias("target"))


@query(
    "rename_marker",
    f"""SELECT sample_id, {tx.sql_rename_marker('text')} AS text, {tx.sql_rename_marker('text_timestamps')} AS text_timestamps,
 {tx.sql_rename_marker('previous_text')} AS previous_text FROM v_samples""",
    ("v_samples",),
)
def q_rename_marker(spark, sf_dir):
    s = fx.v_samples(spark, sf_dir, flags=False)
    return s.select("sample_id", *[tx.rename_marker(c).alias(c) for c in ("text", "text_timestamps", "previous_text")])


@query("strip_text", f"SELECT sample_id, {tx.sql_strip('text')} AS text FROM v_samples", ("v_samples",))
def q_strip(spark, sf_dir):
    return fx.v_samples(spark, sf_dir, previous=False, flags=False).select("sample_id", tx.strip("text").alias("text"))


@query("null_text_to_empty", "SELECT sample_id, coalesce(previous_text, '') AS previous_text FROM v_samples", ("v_samples",))
def q_null_to_empty(spark, sf_dir):
    return fx.v_samples(spark, sf_dir, flags=False).select("sample_id", tx.null_to_empty("previous_text").alias("previous_text"))


@query(
    "row_map",
    f"""SELECT sample_id, {tx.sql_clean_target('text')} AS target, CAST(floor(duration * {SAMPLE_RATE}) AS BIGINT) AS input_length,
 CAST(len({tx.sql_words(tx.sql_clean_target('text'))}) AS INTEGER) AS n_words FROM v_samples""",
    ("v_samples",),
)
def q_row_map(spark, sf_dir):
    """The prepare step as one projection: target text, sample count, word count."""
    s = fx.v_samples(spark, sf_dir, previous=False, flags=False)
    target = tx.clean_target("text")
    return s.select(
        "sample_id",
        target.alias("target"),
        F.floor(F.col("duration") * SAMPLE_RATE).cast("bigint").alias("input_length"),
        F.size(tx.words(target)).alias("n_words"),
    )


def length_ok(length, rate: int = SAMPLE_RATE, lo: float = MIN_SECONDS, hi: float = MAX_SECONDS):
    """Strict on both sides, as the reference filter: lo*rate < length < hi*rate."""
    return (length > F.lit(lo * rate)) & (length < F.lit(hi * rate))


@query(
    "length_filter",
    f"SELECT sample_id, duration FROM v_samples WHERE duration * {SAMPLE_RATE} > {MIN_SECONDS * SAMPLE_RATE} AND duration * {SAMPLE_RATE} < {MAX_SECONDS * SAMPLE_RATE}",
    ("v_samples",),
)
def q_length_filter(spark, sf_dir):
    s = fx.v_samples(spark, sf_dir, previous=False, flags=False)
    return s.filter(length_ok(F.col("duration") * SAMPLE_RATE)).select("sample_id", "duration")


@query("input_length", "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS input_length FROM embeddings")
def q_input_length(spark, sf_dir):
    return fx.table(spark, sf_dir, "embeddings").select("vec_id", F.size("embedding").alias("input_length"))


@query(
    "eligible_flag",
    "SELECT sample_id, stage2_whisper_timestamps AS eligible, CASE WHEN stage2_whisper_timestamps THEN text_timestamps ELSE text END AS target FROM v_samples",
    ("v_samples",),
)
def q_eligible(spark, sf_dir):
    s = fx.v_samples(spark, sf_dir, previous=False)
    flag = F.col("stage2_whisper_timestamps")
    return s.select("sample_id", flag.alias("eligible"), F.when(flag, F.col("text_timestamps")).otherwise(F.col("text")).alias("target"))


@query("normalise_eval", f"SELECT doc_id, {tx.sql_normalise('text')} AS norm FROM documents")
def q_normalise(spark, sf_dir):
    return fx.table(spark, sf_dir, "documents").select("doc_id", tx.normalise("text").alias("norm"))


@query(
    "split_words",
    f"SELECT doc_id, {tx.sql_words(tx.sql_normalise('text'))} AS words FROM documents",
)
def q_split_words(spark, sf_dir):
    return fx.table(spark, sf_dir, "documents").select("doc_id", tx.words(tx.normalise("text")).alias("words"))
