"""Seeded orderings: full shuffle, bounded-displacement shuffle, file-order shuffle, take, rank sharding.

Every order is a sort on a hash of (seed, purpose, epoch, key), so a new
epoch gives a new order and the same epoch always gives the same one,
whatever the partitioning.  Positions come from :func:`dense_index`
(range-partitioned, no single-task window).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.functions.draws import draw, draw_hash
from corpusprep.operators.index import dense_index, hash_block

SPACE = 1 << 32
# The random id a Parquet writer puts into the names of its files.
RUN_ID = "-[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}"
#: Rows of one hash block, on average; more rows mean more blocks.
BLOCK_ROWS = 65_536


def hash_bits(rows: int) -> int:
    """Bits of a hash (a multiple of 4, 16 at least) whose blocks hold about ``BLOCK_ROWS`` rows."""
    bits = 16
    while rows >> bits > BLOCK_ROWS:
        bits += 4
    return bits


def full_shuffle(df: DataFrame, key: str, seed: int = 42, epoch: int = 0, name: str = "pos") -> DataFrame:
    """Random permutation: position = rank of md5(seed:shuffle:epoch:key), ties by key."""
    h = df.withColumn("_h", draw_hash(seed, "shuffle", F.lit(epoch), key))
    bits = hash_bits(df.count())
    return dense_index(h, ["_h", key], name=name, block=hash_block("_h", bits), blocks_bound=1 << bits).drop("_h")


def buffer_key(idx: str, buffer: int, seed: int, epoch: int) -> Column:
    """``idx * 2^32 + buffer * u`` as an exact decimal: the row moves by less than ``buffer``."""
    u = draw(seed, "buffer", F.lit(epoch), idx)
    return F.col(idx).cast("decimal(38,0)") * F.lit(SPACE) + F.lit(int(buffer)) * u.cast("decimal(38,0)")


def buffered_shuffle(df: DataFrame, idx: str, buffer: int = 20, seed: int = 42, epoch: int = 0, name: str = "pos") -> DataFrame:
    """Approximate shuffle with a bounded window: |new position - idx| < buffer."""
    if buffer < 1:
        raise ValueError("buffer must be at least 1")
    k = df.withColumn("_bk", buffer_key(idx, buffer, seed, epoch))
    # block = key div 2^48 = floor((idx + buffer*u/2^32) / 65536): non-decreasing in the key
    blk = F.floor(F.col("_bk") / F.lit(1 << 48).cast("decimal(38,0)")).cast("bigint")
    return dense_index(k, ["_bk", idx], name=name, block=blk).drop("_bk")


#: Rows that one replacement buffer runs over.
SLICE_ROWS = 65_536


def replacement_shuffle(df: DataFrame, idx: str, buffer: int = 20, seed: int = 42, epoch: int = 0, name: str = "pos", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Shuffle through a buffer of ``buffer`` rows, as a streaming reader does: rows fill the buffer, then every
    arrival takes the place of a drawn row, which leaves; what the buffer holds at the end leaves in drawn order.

    A row can stay behind for as long as its slot is not drawn, so its way is not bounded as
    in :func:`buffered_shuffle`. There is one buffer for each slice of ``slice_rows``
    positions of ``idx`` (dense, from 0). Nothing is simulated row by row: row k sits in
    the slot it drew (its own number while the buffer fills) and leaves when that slot is
    drawn next, which is a ``lead`` over (slice, slot).
    """
    if buffer < 1 or slice_rows < 1:
        raise ValueError("buffer and slice_rows must be at least 1")
    b = F.lit(int(buffer)).cast("bigint")
    s = df.withColumns({"_slice": F.expr(f"`{idx}` div {int(slice_rows)}"), "_k": F.col(idx) % slice_rows})
    u = draw(seed, "slot", F.lit(epoch), "_slice", "_k")
    s = s.withColumn("_slot", F.when(F.col("_k") < b, F.col("_k")).otherwise(u % b))
    s = s.withColumn("_next", F.lead("_k").over(Window.partitionBy("_slice", "_slot").orderBy("_k")))
    left = F.col("_next").isNull()
    # rows that stay to the end: at most ``buffer`` a slice, in the order of their draws after those that left
    rest = Window.partitionBy("_slice").orderBy(F.when(left, 0).otherwise(1), draw_hash(seed, "rest", F.lit(epoch), "_slice", "_slot"), "_slot")
    whole = Window.partitionBy("_slice")
    s = s.withColumns({"_n": F.count(F.lit(1)).over(whole), "_rest": F.row_number().over(rest) - 1})
    place = F.when(left, F.greatest(F.col("_n") - b, F.lit(0)) + F.col("_rest")).otherwise(F.col("_next") - b)
    return s.withColumn(name, (F.col("_slice") * slice_rows + place).cast("bigint")).drop("_slice", "_k", "_slot", "_next", "_n", "_rest")


def file_order_shuffle(df: DataFrame, root: str, buffer: int = 20, seed: int = 42, epoch: int = 0, name: str = "pos") -> DataFrame:
    """Streaming-style shuffle: files in hashed order, rows in file order, then a buffered shuffle.

    ``df`` must come straight from a scan of the folder ``root`` (uses the hidden
    ``_metadata`` column).  What is hashed is the file's folder below ``root``, or its
    name without the writer's random run id where it lies in ``root`` itself, so the
    same files written elsewhere or again have the same order.
    """
    last = re.escape(root.rstrip("/").rsplit("/", 1)[-1])
    m = df.withColumn("_path", F.regexp_extract(F.url_decode(F.col("_metadata.file_path")), f"/{last}/(.*)$", 1))
    m = m.withColumn("_path", F.regexp_replace("_path", RUN_ID, "")).withColumn("_row", F.col("_metadata.row_index"))
    folder = F.regexp_extract("_path", "^(.*)/[^/]*$", 1)
    m = m.withColumn("_fh", draw_hash(seed, "files", F.lit(epoch), F.when(folder == "", F.col("_path")).otherwise(folder)))
    ordered = dense_index(m, ["_fh", "_path", "_row"], name="_fidx")
    return buffered_shuffle(ordered, "_fidx", buffer, seed, epoch, name).drop("_path", "_row", "_fh", "_fidx")


def take_first(df: DataFrame, n: int, order, strict: bool = False) -> DataFrame:
    """First ``n`` rows in ``order`` (a top-k, no full sort); ``strict`` fails when fewer exist."""
    order = [order] if isinstance(order, (str, Column)) else list(order)
    if strict:
        have = df.count()
        if have < n:
            raise ValueError(f"asked for {n} rows, only {have} exist")
    return df.orderBy(*order).limit(n)


def rank_shard(df: DataFrame, idx: str, world_size: int, name: str = "rank") -> DataFrame:
    """Deal rows to ``world_size`` workers round-robin by position."""
    if world_size < 1:
        raise ValueError("world_size must be at least 1")
    return df.withColumn(name, (F.col(idx) % F.lit(world_size)).cast("int"))
