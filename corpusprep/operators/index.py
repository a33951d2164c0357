"""Dense row positions without a single-task window.

``row_number() OVER (PARTITION BY g ORDER BY k)`` puts a whole group in one
task; a source holding a third of the corpus would then sit on one executor.
Instead rows are range-partitioned on (g, k) so every task holds a slice of
bounded size, sorted inside the task.  A per-(task, group) count table — at
most partitions + groups rows — is prefix-summed and joined back, which turns
the local position into the global one.  No data row crosses the network
except in the one range shuffle.

The range-partitioned, id-stamped rows are written once with a reliable
``checkpoint()`` to the shared ``spark.checkpoint.dir``: the count branch and
the row branch then read the very same rows, and a lost executor cannot make
a recomputed slice disagree with its offsets.  Index narrow key frames and
join wide payloads afterwards.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Offsets tables at most this many rows are broadcast; larger ones are joined
# on (slice, group), a key that cannot be skewed because slices are bounded.
BROADCAST_ROWS = 200_000


def _names(cols) -> list:
    if cols is None:
        return []
    if isinstance(cols, (str, Column)):
        return [cols]
    return list(cols)


def dense_index(
    df: DataFrame,
    order: Sequence,
    by: Sequence | str | None = None,
    name: str = "idx",
    partitions: int | None = None,
    groups_bound: int | None = None,
    block: Column | None = None,
    blocks_bound: int | None = None,
) -> DataFrame:
    """Add ``name`` = 0-based position of each row in ``order`` (inside ``by``).

    ``order`` must be a total order (append a unique key if needed) so the
    result is the same on every run and every partitioning.
    ``groups_bound``: caller's proven upper bound on distinct ``by`` values;
    with it (or with no ``by``) the offsets table is broadcast.

    ``block``: optional integer expression, non-decreasing in ``order``, that
    cuts the rows into bounded slices (e.g. the first 16 bits of a uniform
    hash, or a position div 65,536).  Then each slice is ranked by a window
    over (group, block) and no range sampling or checkpoint is needed: every
    value is a function of the data alone.  ``blocks_bound`` bounds the
    number of blocks (for the broadcast decision).
    """
    by = _names(by)
    order = _names(order)
    if block is not None:
        return _blocked_index(df, order, by, name, block, groups_bound, blocks_bound)
    keys = by + order
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    from corpusprep.session import checkpoint_dir

    checkpoint_dir(spark)
    s = (
        df.repartitionByRange(n_parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_blk", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    ).checkpoint(eager=True)
    g = ["_blk"] + by
    counts = s.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    w = Window.partitionBy(*by).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*g, "_m0", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    offsets = offsets.select([F.col(c).alias(f"_o{i}") for i, c in enumerate(g)] + ["_m0", "_off"])
    if not by or (groups_bound is not None and n_parts + groups_bound <= BROADCAST_ROWS):
        offsets = F.broadcast(offsets)
    # null-safe on the group columns: a null group is a group like any other
    cond = [s[c].eqNullSafe(offsets[f"_o{i}"]) for i, c in enumerate(g)]
    out = s.join(offsets, cond).withColumn(name, (F.col("_off") + F.col("_mid") - F.col("_m0")).cast("bigint"))
    return out.drop("_blk", "_mid", "_m0", "_off", *[f"_o{i}" for i in range(len(g))])


def _blocked_index(df, order, by, name, block, groups_bound, blocks_bound) -> DataFrame:
    s = df.withColumn("_blk", block)
    g = by + ["_blk"]
    counts = s.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*by).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*g, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    offsets = offsets.select([F.col(c).alias(f"_o{i}") for i, c in enumerate(g)] + ["_off"])
    bound = (groups_bound if by else 1) if (groups_bound is not None or not by) else None
    if bound is not None and blocks_bound is not None and bound * blocks_bound <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    local = F.row_number().over(Window.partitionBy(*g).orderBy(*order)) - 1
    ranked = s.withColumn("_loc", local)
    cond = [ranked[c].eqNullSafe(offsets[f"_o{i}"]) for i, c in enumerate(g)]
    out = ranked.join(offsets, cond).withColumn(name, (F.col("_off") + F.col("_loc")).cast("bigint"))
    return out.drop("_blk", "_loc", "_off", *[f"_o{i}" for i in range(len(g))])


def key_block(key, width: int = 65536) -> Column:
    """Block of a unique integer key: ``key div width``.

    Non-decreasing in the key; a block holds at most ``width`` rows of a
    group (or ``width`` keys' worth of rows), whatever the group sizes.
    """
    k = F.col(key) if isinstance(key, str) else key
    return F.floor(k / F.lit(int(width))).cast("bigint")


def hash_block(hex_hash, bits: int = 16) -> Column:
    """Block of a hex hash string: its first ``bits`` bits (non-decreasing in the string)."""
    h = F.col(hex_hash) if isinstance(hex_hash, str) else hex_hash
    return F.conv(F.substring(h, 1, bits // 4), 16, 10).cast("int")


def lag_in_order(
    df: DataFrame,
    by: Sequence | str,
    order: Sequence,
    col: str,
    name: str,
    groups_bound: int | None = None,
    block: Column | None = None,
) -> DataFrame:
    """``lag(col) OVER (PARTITION BY by ORDER BY order)`` that survives a hot group.

    Rows are numbered with :func:`dense_index` (``block`` as there), then
    joined to their predecessor on (group, position): an equi-join whose key
    never repeats.
    """
    by = _names(by)
    indexed = dense_index(df, order, by, name="_pos", groups_bound=groups_bound, block=block)
    prev = indexed.select(*by, (F.col("_pos") + 1).alias("_pos"), F.col(col).alias(name))
    prev = prev.select([F.col(c).alias(f"_p{i}") for i, c in enumerate(by)] + ["_pos", name]).withColumnRenamed("_pos", "_ppos")
    cond = [indexed[c].eqNullSafe(prev[f"_p{i}"]) for i, c in enumerate(by)] + [indexed["_pos"] == prev["_ppos"]]
    return indexed.join(prev, cond, "left").drop("_pos", "_ppos", *[f"_p{i}" for i in range(len(by))])


def block_rank(
    df: DataFrame,
    pos: str,
    by: Sequence | str,
    name: str = "occ",
    block: int = 65536,
    groups_bound: int | None = None,
    positions_bound: int | None = None,
) -> DataFrame:
    """Rank rows inside each ``by`` group by an integer position ``pos``.

    For positions that are already spread evenly (slot numbers of
    ``spark.range``) the slices are fixed blocks ``pos div block``: every
    window holds at most ``block`` rows whatever the group sizes, and the
    per-(group, block) count table is prefix-summed to give the offsets.
    That table has at most groups × blocks rows; it is broadcast only when
    both bounds are given and the product is small, otherwise joined on
    (group, block), a key no larger than one block.
    """
    by = _names(by)
    b = F.expr(f"`{pos}` div {int(block)}")
    s = df.withColumn("_blk", b)
    counts = s.groupBy(*by, "_blk").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*by).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "_blk", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    if groups_bound is not None and positions_bound is not None:
        if groups_bound * (positions_bound // block + 1) <= BROADCAST_ROWS:
            offsets = F.broadcast(offsets)
    local = F.row_number().over(Window.partitionBy(*by, "_blk").orderBy(pos)) - 1
    ranked = s.withColumn("_loc", local)
    out = ranked.join(offsets, by + ["_blk"]).withColumn(name, (F.col("_off") + F.col("_loc")).cast("bigint"))
    return out.drop("_blk", "_loc", "_off")
