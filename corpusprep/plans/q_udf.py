"""User-function surface queries: each passes user pandas code that restates a listed operator,
so the SQL twin of that operator checks it."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from corpusprep.operators import collate as co
from corpusprep.operators import udf as ud
from corpusprep.operators.tokens import IGNORE
from corpusprep.plans import fixtures as fx
from corpusprep.plans.catalog import query
from corpusprep.plans.q_collate import EOT, PAD, SOT, SQL_COLLATE
from corpusprep.plans.q_text import MAX_SECONDS, MIN_SECONDS, SAMPLE_RATE
from corpusprep.functions import text as tx


def user_prepare(b: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"sample_id": b["sample_id"], "target": b["text"].str.replace("\n", " ", regex=False).str.lower()})


@query("udf_row", f"SELECT sample_id, {tx.sql_clean_target('text')} AS target FROM v_samples", ("v_samples",))
def q_udf_row(spark, sf_dir):
    s = fx.v_samples(spark, sf_dir, previous=False, flags=False).select("sample_id", "text")
    return ud.map_rows(s, user_prepare, "sample_id long, target string")


def user_in_range(duration: pd.Series) -> pd.Series:
    n = duration * SAMPLE_RATE
    return (n > MIN_SECONDS * SAMPLE_RATE) & (n < MAX_SECONDS * SAMPLE_RATE)


@query(
    "udf_predicate",
    f"SELECT sample_id, duration FROM v_samples WHERE duration * {SAMPLE_RATE} > {MIN_SECONDS * SAMPLE_RATE} AND duration * {SAMPLE_RATE} < {MAX_SECONDS * SAMPLE_RATE}",
    ("v_samples",),
)
def q_udf_predicate(spark, sf_dir):
    keep = ud.predicate(user_in_range)
    return fx.v_samples(spark, sf_dir, previous=False, flags=False).filter(keep(F.col("duration"))).select("sample_id", "duration")


def user_collate(b: pd.DataFrame) -> pd.DataFrame:
    """A user collator over one batch: pad, shift, mask after the end marker and before the start."""
    rows = [list(x) for x in b["labels"]]
    longest = max(len(x) for x in rows)
    padded = [x + [PAD] * (longest - len(x)) for x in rows]
    decoder, targets = [x[:-1] for x in padded], []
    for t, own in zip((x[1:] for x in padded), rows):
        real = len(own) - 1
        e = t.index(EOT) if EOT in t[:real] else real - 1
        t = [v if i <= e else IGNORE for i, v in enumerate(t)]
        if SOT in t:
            s = t.index(SOT)
            t = [IGNORE if i < s else v for i, v in enumerate(t)]
        targets.append(t)
    return pd.DataFrame({"idx": b["idx"], "batch_id": b["batch_id"], "decoder_input_ids": decoder, "labels": targets})


@query("udf_batch", SQL_COLLATE, ("v_labels",))
def q_udf_batch(spark, sf_dir):
    lab = co.assign_batches(fx.v_labels(spark, sf_dir).withColumnRenamed("ids", "labels"))
    return ud.map_batches(
        lab.select("idx", "batch_id", "labels"),
        user_collate,
        "idx long, batch_id long, decoder_input_ids array<int>, labels array<int>",
    )
