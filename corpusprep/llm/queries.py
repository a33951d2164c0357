"""Queries of this subpackage: each operator over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm.chat_format import chat_digest, chat_examples
from corpusprep.llm.common import table
from corpusprep.llm.decontaminate import contaminated_pairs
from corpusprep.llm.html_extract import html_main_text
from corpusprep.llm.language_id import language_id
from corpusprep.llm.license_scan import license_scan
from corpusprep.llm.line_dedup import line_classes
from corpusprep.llm.mixing import mix_to_targets
from corpusprep.llm.near_dedup import near_classes
from corpusprep.llm.oracle import SQL
from corpusprep.llm.prefix_trie import prefix_trie
from corpusprep.llm.quality_rules import quality_rules
from corpusprep.llm.secret_scan import secret_digest, secret_spans
from corpusprep.llm.substring_dedup import substring_dedup
from corpusprep.llm.whitening import whiten_embeddings


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "class_id", F.col("id").eqNullSafe(F.col("class_id")).alias("kept")
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_classes(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "line_no", "class_id", "class_line", "kept")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return pairs.select(F.col("id").alias("doc_id"), "item_id", "n_tiles", "n_tokens", "coverage")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(marked).alias("text"),
    )
    return chat_digest(chat_examples(turns.unionByName(extra)))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_to_targets(table(spark, sf_dir, "documents"))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main_text(table(spark, sf_dir, "pages"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(secret_spans(table(spark, sf_dir, "documents")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten_embeddings(table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_near_dedup,
        op3_license_scan,
        op4_line_dedup,
        op5_language_id,
        op6_decontaminate,
        op7_chat_format,
        op8_quality_rules,
        op9_mixing,
        op10_html_extract,
        op11_secret_scan,
        op12_whitening,
        op13_prefix_trie,
    )
}
ORACLE_SQL: dict[str, str] = SQL
