"""Mixing to target weights by iterative proportional fitting.

Token counts are summed by cell (source, language, topic). Cell weights are raked
until each of the three margins meets its target, then every document is drawn with
the probability its cell was given. A cell gives at most the tokens it has: one that is
used up stays at probability 1 and the others of its margin value take the rest, so a
small cell changes its own probability and not the size of the sample. The cell table has one row per combination that
occurs, whatever the number of documents. Up to ``DRIVER_CELLS`` rows are raked in numpy on the
driver; more stay a DataFrame in every round. Texts are only touched by DataFrame functions.
"""

from __future__ import annotations

import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import stored

LOG = logging.getLogger(__name__)

MARGINS = ("source", "lang", "topic")
#: Exponent of a margin's natural token share in its target share (1 keeps the natural mix, 0 levels it).
TEMPER = {"source": 0.7, "lang": 0.7, "topic": 1.0}
#: Tokens to sample, as a share of all tokens.
BUDGET = 0.6
#: Rounds at most; raking ends earlier when the margins are met or, if they contradict each other, nothing moves any more.
ROUNDS = 2000
#: Tables of at most so many cells are raked on the driver; larger ones stay DataFrames, one written table a round.
DRIVER_CELLS = 200_000
TOLERANCE = 1e-3
SEED = 17
#: Shares below count as none where they would be divided by.
LEAST = 1e-290

#: Topics by surface pattern, first match wins (fixed rules; the last is the default).
TOPICS = (
    ("legal", "(?i)licen[sc]e|copyright"),
    ("contact", "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+"),
    ("markup", "[{}<>]|&&&|###|%%%"),
    ("prose", ""),
)


def topic_of(text: Column) -> Column:
    out = F.lit(TOPICS[-1][0])
    for name, pattern in reversed(TOPICS[:-1]):
        out = F.when(F.regexp_like(text, F.lit(pattern)), F.lit(name)).otherwise(out)
    return out


def token_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def tokens_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, source, lang, topic, n_tokens); null source or language is the value ``none``."""
    none = F.lit("none")
    return docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col("source").cast("string"), none).alias("source"),
        F.coalesce(F.col("lang").cast("string"), none).alias("lang"),
        F.coalesce(topic_of(F.col(text_col)), none).alias("topic"),
        token_count(F.col(text_col)).alias("n_tokens"),
    )


def target_shares(cells: DataFrame, temper: dict[str, float] = TEMPER, budget: float | None = None, weights: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Target share of each margin value: its weight in the table that ``weights`` has for the margin, else its natural
    share to the power ``temper``; normalised over the values that occur.

    A table has the margin's name as its first column and a ``weight`` of 0 or more; a value without
    one is not wanted (weight 0), repeated values add up, null stands for ``none``.

    With a ``budget`` (tokens to sample over all tokens) no target is above what its
    value has; the values that have more share the rest in proportion.
    """
    out = {}
    for m in MARGINS:
        sums = cells.groupBy(m).agg(F.sum("tokens").alias("s")).where("s > 0")
        if weights and m in weights:
            table = weights[m].select(F.coalesce(F.col(m).cast("string"), F.lit("none")).alias(m), F.col("weight").cast("double").alias("t"))
            table = table.groupBy(m).agg(F.sum(F.greatest("t", F.lit(0.0))).alias("t"))
            sums = sums.join(table, m, "left").select(m, "s", F.coalesce("t", F.lit(0.0)).alias("t"))
        else:
            sums = sums.select(m, "s", F.pow("s", F.lit(temper[m])).alias("t"))
        sums = stored(sums, "op9-targets")
        total, all_tokens = sums.agg(F.sum("t"), F.sum("s")).head()
        if not total:
            out[m] = sums.select(m, F.lit(0.0).alias("target"))
            continue
        supply = F.col("s") / F.lit(float(all_tokens * budget)) if budget else F.lit(float("inf"))
        lift, used_up = 1 / total, -1
        while budget:  # every pass uses up more values or is the last
            full = F.col("t") * F.lit(lift) >= supply
            n, held, free = sums.agg(F.count(F.when(full, 1)), F.coalesce(F.sum(F.when(full, supply)), F.lit(0.0)), F.sum(F.when(~full, F.col("t")))).head()
            if n == used_up or not free:
                break
            used_up, lift = n, (1 - held) / free
        out[m] = sums.select(m, F.least(F.col("t") * F.lit(lift), supply).alias("target"))
    return out


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, tolerance: float = TOLERANCE, budget: float | None = None, report: dict | None = None, driver_cells: int = DRIVER_CELLS) -> DataFrame:
    """Cells (source, lang, topic, tokens) with ``share``: raked shares that meet the targets of all margins.

    Each round scales the shares to one margin after the other; rounds end when no
    factor is further than ``tolerance`` from 1. With a ``budget`` a share is at most the
    cell's tokens over the tokens asked for; cells at that bound are left out when a margin
    value is scaled up. Margins that contradict each other never meet: rounds then end
    when a round changes no share by more than a tenth of ``tolerance``. ``report`` gets
    ``rounds``, ``met`` and ``off``, the largest distance of a factor from 1 by margin in
    the last round. Targets of values that no cell has are
    left out; cells whose value has no target get share 0; an empty table stays empty.
    """
    now = cells.where("tokens > 0")
    total = now.agg(F.sum("tokens")).head()[0] or 1
    most = F.col("tokens") / F.lit(float(total * budget)) if budget else F.lit(float("inf"))
    now = now.withColumn("share", F.col("tokens") / F.lit(float(total)))
    report = {} if report is None else report
    first = now.limit(driver_cells + 1).toArrow() if driver_cells else None
    if first is not None and 0 < first.num_rows <= driver_cells:
        return _rake_on_driver(now, first, targets, rounds, tolerance, total * budget if budget else None, report)
    for k in range(rounds):
        now = now.withColumn("__was", F.col("share"))
        for m in MARGINS:
            full = F.col("share") >= most
            sums = now.groupBy(m).agg(
                F.sum("share").alias("__sum"), F.coalesce(F.sum(F.when(full, F.col("share"))), F.lit(0.0)).alias("__held"), F.sum(F.when(~full, F.col("share"))).alias("__free")
            )
            goal = F.coalesce("target", F.lit(0.0))
            factor = sums.join(targets[m], m, "left").select(
                m,
                F.when(F.col("__sum") > 0, goal / F.col("__sum")).otherwise(F.when(goal > 0, F.lit(0.0)).otherwise(F.lit(1.0))).alias("__f"),
                F.when(F.col("__free") > LEAST, (goal - F.col("__held")) / F.col("__free")).otherwise(F.lit(1.0)).alias("__up"),
            )
            now = now.join(factor, m)
            # scaled down all together; scaled up those that have tokens left
            now = now.withColumn("share", F.when(F.col("__f") <= 1, F.col("share") * F.col("__f")).when(full, F.col("share")).otherwise(F.least(F.col("share") * F.col("__up"), most)))
            now = now.withColumn(f"__f_{m}", F.col("__f")).drop("__f", "__up")
        now = stored(now, "op9-shares")
        moved = F.max(F.abs(F.col("share") - F.col("__was")) / F.greatest("share", "__was"))
        *off, step = now.agg(*[F.max(F.abs(F.col(f"__f_{m}") - 1)).alias(m) for m in MARGINS], moved).head()
        now = now.drop(*[f"__f_{m}" for m in MARGINS], "__was")
        met = all(v is None or v <= tolerance for v in off)
        report |= {"rounds": k + 1, "met": met, "off": dict(zip(MARGINS, off))}
        if met or step is None or step <= tolerance / 10:
            break
    return now


def _rake_on_driver(cells: DataFrame, rows: pa.Table, targets: dict[str, DataFrame], rounds: int, tolerance: float, asked: float | None, report: dict) -> DataFrame:
    """``rake`` for the few ``rows`` of ``cells``: the same rounds in numpy."""
    share, tokens = (np.array(rows.column(c).to_pylist(), dtype=np.float64) for c in ("share", "tokens"))
    most = tokens / asked if asked else np.full(len(tokens), np.inf)
    codes, goals = {}, {}
    for m in MARGINS:
        encoded = rows.column(m).combine_chunks().dictionary_encode()
        codes[m] = np.array(encoded.indices.to_pylist(), dtype=np.int64)
        wanted = targets[m].join(cells.select(m).distinct(), m, "left_semi").toArrow().to_pydict()
        goal = dict(zip(wanted[m], wanted["target"]))
        goals[m] = np.array([goal.get(v) or 0.0 for v in encoded.dictionary.to_pylist()])
    for k in range(rounds):
        was, off = share, {}
        for m in MARGINS:
            code, goal, full = codes[m], goals[m], share >= most
            sums, held = (np.bincount(code, w, len(goal)) for w in (share, share * full))
            free = np.bincount(code, share * ~full, len(goal))
            factor = np.where(sums > 0, goal / np.where(sums > 0, sums, 1), np.where(goal > 0, 0.0, 1.0))
            up = np.where(free > LEAST, (goal - held) / np.where(free > LEAST, free, 1), 1.0)
            # scaled down all together; scaled up those that have tokens left
            share = np.where(factor[code] <= 1, share * factor[code], np.where(full, share, np.minimum(share * up[code], most)))
            off[m] = float(np.abs(factor - 1).max())
        met = all(v <= tolerance for v in off.values())
        report |= {"rounds": k + 1, "met": met, "off": off}
        largest = np.maximum(share, was)
        if met or (np.abs(share - was) <= tolerance / 10 * largest).all():
            break
    out = rows.set_column(rows.schema.get_field_index("share"), "share", pa.array(share))
    return cells.sparkSession.createDataFrame(out, schema=cells.schema)


def margins_reached(raked: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """(margin, value, tokens, target, share): the target of every margin value and the share it reached."""
    out = None
    for m in MARGINS:
        sums = raked.groupBy(m).agg(F.sum("tokens").alias("tokens"), F.sum("share").alias("share"))
        rows = sums.join(targets[m], m, "left").select(F.lit(m).alias("margin"), F.col(m).alias("value"), "tokens", F.coalesce("target", F.lit(0.0)).alias("target"), "share")
        out = rows if out is None else out.unionByName(rows)
    return out


def draw(key: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) from the row's key: the first 52 bits of an md5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string"))), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def mix_to_targets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    budget: float = BUDGET,
    seed: int = SEED,
    temper: dict[str, float] = TEMPER,
    weights: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """One row per document: (id, source, lang, topic, n_tokens, probability, kept).

    ``weights`` gives target weights by margin (``source``, ``lang``, ``topic``) as tables of value and
    weight; a margin without a table is levelled by ``temper``.

    ``probability`` is the raked share of the document's cell times the tokens asked
    for, over the tokens the cell has, and at most 1: targets are capped at what their
    value has, cells that are used up leave the rest to others, and no document is taken
    twice. The token share and the margins reached are logged, as a warning if some
    margin is off. ``kept`` compares the probability with a draw from (seed, id): repeated rows
    share a draw. Documents of no words have probability 0 and are not kept; null
    source, language or text count as the value ``none``; an empty table gives no rows.
    """
    rows = stored(tokens_table(docs, id_col, text_col), "op9-tokens")  # texts are read once, what follows is narrow
    cells = stored(rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")), "op9-cells")
    targets = target_shares(cells, temper, budget, weights)
    report: dict = {}
    raked = rake(cells, targets, budget=budget, report=report)
    total, reached = raked.agg(F.sum("tokens"), F.sum("share")).head()
    asked = (total or 0) * budget
    if total:
        message = f"mixing: {reached * budget:.4f} of the tokens asked at {budget:.4f}; {report['rounds']} rounds, margins off by at most {report['off']}"
        if report["met"]:
            LOG.info(message)
        else:
            worst = margins_reached(raked, targets).orderBy(F.abs(F.col("share") - F.col("target")).desc()).limit(10).collect()
            LOG.warning("%s; targets cannot all be met, furthest off: %s", message, [(r.margin, r.value, round(r.target, 6), round(r.share, 6)) for r in worst])
    chance = raked.select(*MARGINS, F.least(F.col("share") * F.lit(float(asked)) / F.col("tokens"), F.lit(1.0)).alias("probability"))
    p = F.coalesce(F.when(F.col("n_tokens") > 0, F.col("probability")), F.lit(0.0))
    return rows.join(chance, list(MARGINS), "left").select(
        F.col("id").alias(id_col), *MARGINS, "n_tokens", F.round(p, 9).alias("probability"), (draw(F.coalesce(F.col("id").cast("string"), F.lit("null")), seed) < F.round(p, 9)).alias("kept")
    )
