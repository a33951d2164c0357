"""User-function surface: row maps, predicates, batch functions, user aggregates.

Built-in column expressions are always preferred; these wrappers are for
user code that cannot be written that way.  All of them are Arrow-batched
(pandas), never row-at-a-time Python UDFs, a batch of rows is bounded in bytes, and a batch
function only ever sees one bounded batch.  A user aggregate never sees a group: a task folds its
rows of each group into a state, and states are merged in two steps.
"""

from __future__ import annotations

from typing import Any, Callable, Iterator, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.session import small_batches


def map_rows(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply ``fn`` to Arrow batches of rows (the dataset ``map``)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield fn(b)

    small_batches(df.sparkSession)
    return df.mapInPandas(run, schema)


def predicate(fn: Callable[[pd.Series], pd.Series]) -> Callable[[Column], Column]:
    """Turn a vectorised pandas predicate into a column predicate (the dataset ``filter``)."""
    udf = F.pandas_udf(fn, T.BooleanType())
    return lambda c: udf(c)


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, batch: str = "batch_id") -> DataFrame:
    """Apply ``fn`` to each batch (all rows sharing ``batch``; bounded by the batch size)."""
    small_batches(df.sparkSession)
    return df.groupBy(batch).applyInPandas(fn, schema)


#: Groups whose states a task keeps at once; more are passed on and begun anew.
OPEN_GROUPS = 10_000
#: Shares into which the states of a group are dealt for the first merge.
MERGE_SHARES = 64

State = dict[str, Any]


def user_aggregate(
    df: DataFrame,
    by: str | Sequence[str],
    start: Callable[[], State],
    fold: Callable[[State, pd.DataFrame], State],
    merge: Callable[[State, State], State],
    finish: Callable[[State], State],
    state: str,
    out: str,
) -> DataFrame:
    """Aggregate with user code: ``by`` and the columns ``out`` that ``finish`` makes, a row for each group.

    A task folds Arrow batches into one state a group (``fold`` gets some rows of one group),
    so a group of any size leaves one small row a task. These are merged first within
    ``MERGE_SHARES`` shares of each group, then across them, so a merge sees a small part
    of the tasks. ``merge`` must not depend on order. ``state`` and ``out`` declare the
    fields of a state and of a result; a null key is a group of its own.
    """
    by = [by] if isinstance(by, str) else list(by)
    names = T.StructType.fromDDL(state).names
    keys = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in by)

    def folded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        states: dict[tuple, tuple[tuple, State]] = {}
        share = TaskContext.get().partitionId() % MERGE_SHARES

        def passed_on() -> pd.DataFrame:
            rows = [(*key, share, *(s[n] for n in names)) for key, s in states.values()]
            states.clear()
            return pd.DataFrame(rows, columns=[*by, "_share", *names]).astype({"_share": "int32"})

        for b in batches:
            for key, rows in b.groupby(by, dropna=False, sort=False):
                named = tuple(None if pd.isna(k) else k for k in key)
                states[named] = (named, fold(states[named][1] if named in states else start(), rows))
            if len(states) > OPEN_GROUPS:
                yield passed_on()
        yield passed_on()

    def merged(rows: pd.DataFrame) -> State:
        whole = None
        for row in rows[names].to_dict("records"):
            whole = row if whole is None else merge(whole, row)
        return whole

    def share_merged(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(*key, *merged(rows).values())], columns=[*by, "_share", *names])

    def group_finished(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        done = finish(merged(rows))
        return pd.DataFrame([(*key, *done.values())], columns=[*by, *done])

    small_batches(df.sparkSession)
    partial = df.mapInPandas(folded, f"{keys}, _share int, {state}")
    shares = partial.groupBy(*by, "_share").applyInPandas(share_merged, f"{keys}, _share int, {state}")
    return shares.groupBy(*by).applyInPandas(group_finished, f"{keys}, {out}")
