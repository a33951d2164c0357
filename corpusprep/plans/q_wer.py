"""Scoring queries over the prediction/reference pair fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.functions import text as tx
from corpusprep.operators import subword as sw
from corpusprep.operators import tokens as tk
from corpusprep.operators import udf as ud
from corpusprep.operators import wer as wr
from corpusprep.plans import fixtures as fx
from corpusprep.plans.catalog import query

MARKER = wr.MARKER


def sql_edits(src: str) -> str:
    """CTEs e0, ed, e2 adding ref_words, hyp_words, edits to ``src`` (columns pair_id, ref, hyp).

    The distance is the usual table, one row of it per step of the recursion: what the
    row above allows, then the running minimum along the row.
    """
    return f"""e0 AS (SELECT *, {tx.sql_words('ref')} AS rw, {tx.sql_words('hyp')} AS hw FROM {src}),
ed AS (
  SELECT pair_id, 0 AS i, range(0, len(rw) + 1) AS d FROM e0
  UNION ALL
  SELECT pair_id, i + 1, list(m + j ORDER BY j) FROM (
    SELECT pair_id, i, j, min(t - j) OVER (PARTITION BY pair_id ORDER BY j) AS m FROM (
      SELECT pair_id, i, j, least(d[j + 1] + 1, CASE WHEN j = 0 THEN d[1] + 1 WHEN rw[j] = hw[i + 1] THEN d[j] ELSE d[j] + 1 END) AS t
      FROM (SELECT pair_id, ed.i, ed.d, e0.rw, e0.hw, unnest(range(0, len(e0.rw) + 1)) AS j FROM ed JOIN e0 USING (pair_id) WHERE ed.i < len(e0.hw)) x) y) z
  GROUP BY pair_id, i),
e2 AS (SELECT e0.* EXCLUDE (rw, hw), CAST(len(rw) AS BIGINT) AS ref_words, CAST(len(hw) AS BIGINT) AS hyp_words,
  CAST(ed.d[len(rw) + 1] AS BIGINT) AS edits FROM e0 JOIN ed USING (pair_id) WHERE ed.i = len(hw))"""


SQL_STAGES = f"""p AS (SELECT pair_id, data_source, contains(ref, '{MARKER}') AS mk, {tx.sql_normalise('ref')} AS ref, {tx.sql_normalise('hyp')} AS hyp FROM v_pairs),
s1 AS (SELECT * FROM p WHERE {tx.sql_strip('hyp')} <> ''),
s2 AS (SELECT * FROM s1 WHERE {tx.sql_strip('ref')} <> ''),
s3 AS (SELECT pair_id, data_source, ref, hyp FROM s2 WHERE NOT mk)"""


def sql_wer(src: str, by: str | None = None) -> str:
    sel = f"{by}, " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    ok = "FILTER (ref_words > 0)"
    return f"""SELECT {sel}count(*) {ok} AS n_pairs, count(*) FILTER (ref_words = 0) AS n_dropped, CAST(sum(edits) {ok} AS BIGINT) AS errors,
 CAST(sum(ref_words) {ok} AS BIGINT) AS ref_words, 100.0::DOUBLE * CAST(sum(edits) {ok} AS DOUBLE) / CAST(sum(ref_words) {ok} AS DOUBLE) AS wer FROM {src}{grp}"""


@query("edit_distance", "WITH RECURSIVE " + sql_edits("v_pairs") + "\nSELECT pair_id, ref_words, hyp_words, edits FROM e2", ("v_pairs",))
def q_edit_distance(spark, sf_dir):
    return wr.pair_edits(fx.v_pairs(spark, sf_dir)).select("pair_id", "ref_words", "hyp_words", "edits")


@query("wer", "WITH RECURSIVE " + sql_edits("v_pairs") + "\n" + sql_wer("e2"), ("v_pairs",))
def q_wer(spark, sf_dir):
    """Corpus rate on the raw strings (every pair with a non-empty reference)."""
    return wr.corpus_wer(wr.pair_edits(fx.v_pairs(spark, sf_dir)))


@query("wer_filtered", "WITH RECURSIVE " + SQL_STAGES + ",\n" + sql_edits("s3") + "\n" + sql_wer("e2"), ("v_pairs",))
def q_wer_filtered(spark, sf_dir):
    return wr.wer_filtered(fx.v_pairs(spark, sf_dir))


@query("wer_from_ids", "WITH RECURSIVE " + SQL_STAGES + ",\n" + sql_edits("s3") + "\n" + sql_wer("e2", "data_source"), ("v_pairs",))
def q_wer_from_ids(spark, sf_dir):
    """The whole evaluation from label ids (framed, padded with the ignore mark) and predicted ids, per data source."""
    ranks, own = fx.ranks(spark), fx.SUBWORD_RESERVED
    ref, hyp = sw.encode_all(["ref", "hyp"], ranks)
    framed = lambda ids: tk.with_specials(ids, max_length=None, reserved=own)
    ids = fx.v_pairs(spark, sf_dir).select(
        "data_source", F.concat(framed(ref), F.array(F.lit(tk.IGNORE), F.lit(tk.IGNORE))).alias("labels"), F.concat(framed(hyp), F.array(F.lit(own.pad))).alias("predictions")
    )
    return wr.wer_from_ids(ids, "labels", "predictions", ranks, own, by="data_source")


@query("drop_empty_pairs", "WITH " + SQL_STAGES + "\nSELECT pair_id, ref, hyp FROM s2", ("v_pairs",))
def q_drop_empty(spark, sf_dir):
    return wr.filter_pairs(fx.v_pairs(spark, sf_dir))["non_empty_ref"].select("pair_id", "ref", "hyp")


@query("drop_marker_pairs", f"SELECT pair_id, ref, hyp FROM v_pairs WHERE NOT contains(ref, '{MARKER}')", ("v_pairs",))
def q_drop_marker(spark, sf_dir):
    return wr.without_marker(fx.v_pairs(spark, sf_dir)).select("pair_id", "ref", "hyp")


@query(
    "pair_counts",
    "WITH "
    + SQL_STAGES
    + """
SELECT (SELECT count(*) FROM v_pairs) AS n_input, (SELECT count(*) FROM s1) AS n_non_empty_pred,
 (SELECT count(*) FROM s2) AS n_non_empty_ref, (SELECT count(*) FROM s3) AS n_scored""",
    ("v_pairs",),
)
def q_pair_counts(spark, sf_dir):
    """Rows left after each filter, in one pass: every stage is a flag, counted by one aggregate."""
    p = fx.v_pairs(spark, sf_dir)
    pred_ok = tx.strip(tx.normalise("hyp")) != ""
    ref_ok = tx.strip(tx.normalise("ref")) != ""
    no_mark = ~F.col("ref").contains(MARKER)
    cnt = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    return p.agg(
        F.count(F.lit(1)).alias("n_input"),
        cnt(pred_ok).alias("n_non_empty_pred"),
        cnt(pred_ok & ref_ok).alias("n_non_empty_ref"),
        cnt(pred_ok & ref_ok & no_mark).alias("n_scored"),
    )


@query("udaf_metric", "WITH RECURSIVE " + SQL_STAGES + ",\n" + sql_edits("s3") + "\n" + sql_wer("e2", "data_source"), ("v_pairs",))
def q_udaf_metric(spark, sf_dir):
    """The metric as a grouped aggregate: one rate per data source."""
    return wr.wer_filtered(fx.v_pairs(spark, sf_dir), by="data_source")


def user_start():
    return {"n_pairs": 0, "n_dropped": 0, "errors": 0, "ref_words": 0}


def user_fold(state, rows):
    """User code over some rows of a group: adds what they count."""
    scored = rows[rows["ref_words"] > 0]
    add = {"n_pairs": len(scored), "n_dropped": len(rows) - len(scored), "errors": int(scored["edits"].sum()), "ref_words": int(scored["ref_words"].sum())}
    return {k: state[k] + v for k, v in add.items()}


def user_merge(a, b):
    return {k: a[k] + b[k] for k in a}


def user_finish(state):
    return {**state, "wer": 100.0 * state["errors"] / state["ref_words"] if state["ref_words"] else None}


@query("udaf_user", "WITH RECURSIVE " + SQL_STAGES + ",\n" + sql_edits("s3") + "\n" + sql_wer("e2", "data_source"), ("v_pairs",))
def q_udaf_user(spark, sf_dir):
    """The same metric as user code: a state per task and group, merged in a tree, then finished."""
    kept = wr.filter_pairs(fx.v_pairs(spark, sf_dir))["no_marker"]
    edited = wr.pair_edits(kept).select("data_source", "ref_words", "edits")
    state = "n_pairs long, n_dropped long, errors long, ref_words long"
    return ud.user_aggregate(edited, "data_source", user_start, user_fold, user_merge, user_finish, state, state + ", wer double")
