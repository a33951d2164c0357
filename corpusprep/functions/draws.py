"""Seeded, partition-independent random draws.

A draw is the first 32 bits of ``md5("<seed>:<purpose>:<key>[:<key>...]")``,
an integer in [0, 2^32).  The same text gives the same number in Spark and in
any SQL engine with ``md5``, so every random choice can be checked.
Probabilities become integer thresholds so comparisons never touch doubles.
"""

from __future__ import annotations

from decimal import ROUND_FLOOR, Decimal
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = 1 << 32


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def draw_text(seed: int, purpose: str, *keys) -> Column:
    parts = [_col(k).cast("string") for k in keys]
    return F.concat(F.lit(f"{seed}:{purpose}:"), F.concat_ws(":", *parts))


def draw_hash(seed: int, purpose: str, *keys) -> Column:
    """Full md5 hex of the draw text (used as a sort key)."""
    return F.md5(draw_text(seed, purpose, *keys))


def draw(seed: int, purpose: str, *keys) -> Column:
    """Integer draw in [0, 2^32)."""
    return F.conv(F.substring(draw_hash(seed, purpose, *keys), 1, 8), 16, 10).cast("bigint")


def threshold(p) -> int:
    """Integer cut so that ``draw < threshold(p)`` happens with probability p."""
    d = Decimal(str(p))
    if d < 0 or d > 1:
        raise ValueError(f"probability out of [0, 1]: {p}")
    return int((d * SPACE).to_integral_value(rounding=ROUND_FLOOR))


def ladder(weights: Sequence) -> list[int]:
    """Cumulative integer thresholds for a weight list; the last is 2^32."""
    cum = Decimal(0)
    out = []
    for w in weights:
        cum += Decimal(str(w))
        out.append(int((cum * SPACE).to_integral_value(rounding=ROUND_FLOOR)))
    out[-1] = SPACE
    return out


def bucket(u: Column, thresholds: Sequence[int]) -> Column:
    """Index of the first threshold above ``u`` (weighted choice)."""
    expr = F.lit(len(thresholds) - 1)
    for i in range(len(thresholds) - 2, -1, -1):
        expr = F.when(u < F.lit(thresholds[i]), F.lit(i)).otherwise(expr)
    return expr.cast("int")


# --- SQL twins (DuckDB dialect) used by the oracle ---------------------------

def sql_draw_text(seed: int, purpose: str, *keys: str) -> str:
    parts = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"concat('{seed}:{purpose}:', concat_ws(':', {parts}))"


def sql_draw_hash(seed: int, purpose: str, *keys: str) -> str:
    return f"md5({sql_draw_text(seed, purpose, *keys)})"


def sql_draw(seed: int, purpose: str, *keys: str) -> str:
    return f"CAST(('0x' || substr({sql_draw_hash(seed, purpose, *keys)}, 1, 8)) AS BIGINT)"


def sql_bucket(u: str, thresholds: Sequence[int]) -> str:
    arms = " ".join(f"WHEN {u} < {t} THEN {i}" for i, t in enumerate(thresholds[:-1]))
    return f"CAST(CASE {arms} ELSE {len(thresholds) - 1} END AS INTEGER)"
