"""Corpus pipeline: five operators of ``corpusprep.llm`` in a row over the documents table.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of
documents. ``run`` writes each stage's result
as Parquet in the shared checkpoint folder and reads it back as the next one's input.

Odd rows, the same in every stage: a null or empty text has no letter, so the first stage drops it, and the later
ones treat it as a text without words or lines. Null ids are kept apart from all others. Repeated rows are
judged alike until the near-duplicate stage leaves one of them; ties there go to the least id. Texts
of any length are read whole. Columns beyond those of documents stay, whatever their names; an
empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm.common import stored, table, unused
from corpusprep.llm.decontaminate import decontaminate
from corpusprep.llm.language_id import UNKNOWN, held_out, predict, train
from corpusprep.llm.line_dedup import line_dedup
from corpusprep.llm.mixing import mix_to_targets
from corpusprep.llm.near_dedup import near_dedup

#: Least posterior of the predicted language that keeps a document.
MIN_SCORE = 0.5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose language is doubtful; learns as operator 5 does."""
    own = docs.select(F.col("doc_id").alias("key"), held_out("doc_id").alias("held_out"), "text", "lang")
    found, score = unused(docs, "lang_found", "score")
    judged = predict(docs, train(own.where("not held_out")), "text", docs.columns, (found, score))
    return judged.where((F.col(found) != UNKNOWN) & (F.col(score) >= MIN_SCORE)).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated lines; a document left without any word goes, and ``n_chars`` follows the new text."""
    out = line_dedup(docs).where(F.regexp_like(F.col("text"), F.lit(r"[^\x20\x09-\x0D]")))
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate class."""
    return near_dedup(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents to the target weights of source, language and topic."""
    (drawn_id,) = unused(docs, "drawn_id")
    drawn = mix_to_targets(docs).where("kept").select(F.col("doc_id").alias(drawn_id)).distinct()
    return docs.join(drawn, F.col("doc_id").eqNullSafe(F.col(drawn_id)), "left_semi")


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("decontaminate", benchmark_stage),
    ("mixing", mixing_stage),
]

#: Language scores, MinHash candidates and tilings cannot be said in SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


__all__ = ["ORACLE_SQL", "STAGES", "run"]
