"""Registry of named queries: a Spark builder and, where SQL can say it, a DuckDB twin."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusprep.plans.fixtures import with_views

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def query(key: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key`` with its oracle SQL."""

    def deco(fn: Builder) -> Builder:
        if key in REGISTRY:
            raise ValueError(f"query {key!r} registered twice")
        REGISTRY[key] = (fn, with_views(sql, *views) if sql is not None else None)
        return fn

    return deco


def load_all() -> dict[str, tuple[Builder, str | None]]:
    from corpusprep.plans import (  # noqa: F401  (registration side effects)
        q_collate,
        q_mix,
        q_order,
        q_sources,
        q_stream,
        q_text,
        q_tokens,
        q_udf,
        q_wer,
    )

    return REGISTRY
