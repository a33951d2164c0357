"""Collation queries over the label fixture (batches of 16 by position)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.operators import collate as co
from corpusprep.operators.index import dense_index, key_block
from corpusprep.operators.tokens import IGNORE
from corpusprep.plans import fixtures as fx
from corpusprep.plans.catalog import query

B = 16  # fixed value: per-device batch size of the launchers
V = ("v_labels",)
BYTES = fx.SUBWORD_RESERVED
PAD, SOT, EOT = BYTES.pad, BYTES.sot, BYTES.eot  # of the vocabulary that made the labels


def labels(spark, sf_dir):
    return fx.v_labels(spark, sf_dir).withColumnRenamed("ids", "labels")


SQL_BATCH = f"""b AS (SELECT idx, ids AS labels, idx // {B} AS batch_id, CAST(idx % {B} AS INTEGER) AS pos FROM v_labels),
m AS (SELECT *, max(len(labels)) OVER (PARTITION BY batch_id) AS longest FROM b)"""


def sql_pad(arr: str, fill: int) -> str:
    return f"CAST(list_resize({arr}, longest, {fill}) AS INTEGER[])"


def sql_shift() -> str:
    return f"""p AS (SELECT idx, batch_id, {sql_pad('labels', PAD)} AS padded, len(labels) AS n FROM m),
s AS (SELECT idx, batch_id, padded[1:len(padded) - 1] AS decoder_input_ids, padded[2:] AS labels, n - 1 AS n FROM p)"""


def sql_mask_after_end(a: str) -> str:
    """Nothing past the row's own ``n`` labels is a target, nor what follows its first end marker."""
    last = f"least(n, coalesce(nullif(list_position({a}[1:n], {EOT}), 0), n))"
    return f"list_transform({a}, lambda x, i: CASE WHEN i > {last} THEN {IGNORE} ELSE x END)"


def sql_mask_prompt(a: str) -> str:
    return f"list_transform({a}, lambda x, i: CASE WHEN i < coalesce(list_position({a}, {SOT}), 0) THEN {IGNORE} ELSE x END)"


@query("assign_batches", "WITH " + SQL_BATCH + "\nSELECT idx, batch_id, pos FROM b", V)
def q_assign(spark, sf_dir):
    return co.assign_batches(labels(spark, sf_dir)).select("idx", "batch_id", "pos")


@query("pad_labels", "WITH " + SQL_BATCH + f"\nSELECT idx, batch_id, {sql_pad('labels', PAD)} AS labels FROM m", V)
def q_pad(spark, sf_dir):
    return co.pad_labels(co.assign_batches(labels(spark, sf_dir)), fill=PAD).select("idx", "batch_id", "labels")


SQL_MASKED = f"""mp AS (SELECT idx, batch_id, {sql_pad('labels', IGNORE)} AS labels,
  CAST(list_resize(list_transform(labels, lambda x: 1), longest, 0) AS INTEGER[]) AS attention_mask FROM m)"""


@query("mask_padding", "WITH " + SQL_BATCH + ",\n" + SQL_MASKED + "\nSELECT idx, labels, attention_mask FROM mp", V)
def q_mask_padding(spark, sf_dir):
    return co.mask_padding(co.assign_batches(labels(spark, sf_dir))).select("idx", "labels", "attention_mask")


@query(
    "strip_shared_start",
    "WITH "
    + SQL_BATCH
    + ",\n"
    + SQL_MASKED
    + f""",
st AS (SELECT *, min(CASE WHEN labels[1] = {SOT} THEN 1 ELSE 0 END) OVER (PARTITION BY batch_id) AS every FROM mp)
SELECT idx, CASE WHEN every = 1 THEN labels[2:] ELSE labels END AS labels FROM st""",
    V,
)
def q_strip_start(spark, sf_dir):
    return co.collate_plain(labels(spark, sf_dir), reserved=BYTES).select("idx", "labels")


@query("shift_labels", "WITH " + SQL_BATCH + ",\n" + sql_shift() + "\nSELECT idx, decoder_input_ids, labels FROM s", V)
def q_shift(spark, sf_dir):
    b = co.pad_labels(co.assign_batches(labels(spark, sf_dir)), fill=PAD)
    return co.shift_labels(b).select("idx", "decoder_input_ids", "labels")


@query(
    "mask_after_end",
    "WITH " + SQL_BATCH + ",\n" + sql_shift() + f"\nSELECT idx, CAST({sql_mask_after_end('labels')} AS INTEGER[]) AS labels FROM s",
    V,
)
def q_mask_after_end(spark, sf_dir):
    b = co.assign_batches(labels(spark, sf_dir)).withColumn("real", F.size("labels") - 1)
    b = co.shift_labels(co.pad_labels(b, fill=PAD))
    return b.select("idx", co.mask_after_end("labels", EOT, "real").alias("labels"))


@query(
    "mask_prompt",
    "WITH " + SQL_BATCH + ",\n" + sql_shift() + f"\nSELECT idx, CAST({sql_mask_prompt('labels')} AS INTEGER[]) AS labels FROM s",
    V,
)
def q_mask_prompt(spark, sf_dir):
    b = co.shift_labels(co.pad_labels(co.assign_batches(labels(spark, sf_dir)), fill=PAD))
    return b.select("idx", co.mask_prompt("labels", SOT).alias("labels"))


SQL_COLLATE = (
    "WITH "
    + SQL_BATCH
    + ",\n"
    + sql_shift()
    + f""",
ma AS (SELECT idx, batch_id, decoder_input_ids, CAST({sql_mask_after_end('labels')} AS INTEGER[]) AS l1 FROM s)
SELECT idx, batch_id, CAST(decoder_input_ids AS INTEGER[]) AS decoder_input_ids, CAST({sql_mask_prompt('l1')} AS INTEGER[]) AS labels FROM ma"""
)


@query("collate", SQL_COLLATE, V)
def q_collate(spark, sf_dir):
    return co.collate(labels(spark, sf_dir), batch_size=B, reserved=BYTES).select("idx", "batch_id", "decoder_input_ids", "labels")


def _features(spark, sf_dir):
    e = fx.table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("input_features"))
    return co.assign_batches(dense_index(e, ["vec_id"], block=key_block("vec_id")), "idx", B)


SQL_FEAT = f"""fb AS (SELECT vec_id, embedding AS input_features, (row_number() OVER (ORDER BY vec_id) - 1) // {B} AS batch_id FROM embeddings),
fm AS (SELECT *, max(len(input_features)) OVER (PARTITION BY batch_id) AS longest FROM fb)"""


@query(
    "pad_features",
    "WITH " + SQL_FEAT + "\nSELECT vec_id, batch_id, CAST(list_resize(input_features, longest, 0.0) AS FLOAT[]) AS input_features FROM fm",
    (),
)
def q_pad_features(spark, sf_dir):
    return co.pad_features(_features(spark, sf_dir)).select("vec_id", "batch_id", "input_features")


@query(
    "forward_mask",
    "SELECT vec_id, embedding AS input_features, CAST(list_transform(embedding, lambda x: 1) AS INTEGER[]) AS attention_mask FROM embeddings",
)
def q_forward_mask(spark, sf_dir):
    e = fx.table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("input_features"))
    return co.forward_mask(e)
