"""Sinks: sharded split writer, output guard, materialised preprocessing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.operators.index import dense_index
from corpusprep.operators.shard import SHARD_LIMIT, contiguous_shard, estimate_bytes, shard_count
from corpusprep.session import session_settings
from corpusprep.sources.files import has_files

ROWS_PER_GROUP = 128  # fixed value: rows per Parquet row group of the writer
#: Bytes (as estimated) that one write task takes of a shard.
TASK_BYTES = 256 * 10**6
#: Write tasks of a pass for every 8 that can run at once, and passes at most; a pass deletes its shuffle files before the next one begins.
PASS_TASKS = 8
PASSES = 16


@dataclass(frozen=True)
class ShardPlan:
    """Where every row of a split goes: split → (rows, shards, rows of a write task, first partition), and all partitions.

    A shard is cut into write tasks of whole row groups, so its last row group alone can
    be short; partitions are numbered along (split, shard, position).
    """

    splits: dict
    parts: int

    @classmethod
    def of(cls, indexed: DataFrame, split: str, limit: int = SHARD_LIMIT, bytes_col: str | None = None, rows_per_group: int = ROWS_PER_GROUP) -> ShardPlan:
        """From the row count and bytes of each split (one row a split reaches the driver)."""
        if bytes_col:
            sized = indexed.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(bytes_col).cast("bigint").alias("nbytes"))
        else:
            sized = estimate_bytes(indexed.drop("idx"), split)
        sized = sized.withColumn("n_shards", F.least(shard_count("nbytes", limit), F.col("n_rows")))
        rows = sorted(sized.collect(), key=lambda r: str(r[split]))
        total = sum(r.n_rows for r in rows)
        tasks = indexed.sparkSession.sparkContext.defaultParallelism
        splits, parts = {}, 0
        for r in rows:
            by_bytes = TASK_BYTES * r.n_rows // max(r.nbytes, 1)
            groups = max(1, -(-min(by_bytes, -(-total // tasks)) // rows_per_group))
            chunk = groups * rows_per_group
            splits[r[split]] = (r.n_rows, r.n_shards, chunk, parts)
            parts += r.n_shards * -(-(-(-r.n_rows // r.n_shards)) // chunk)
        return cls(splits, max(parts, 1))

    def passes(self, at_once: int = 1) -> list[tuple[int, int]]:
        """Ranges of partitions to write one after the other, a pass of some ``at_once``: rows on their way take the disk of one of them, 1 / ``PASSES`` for a large job."""
        n = max(1, min(PASSES, -(-self.parts // (PASS_TASKS * max(1, at_once // 8)))))
        return [(k * self.parts // n, (k + 1) * self.parts // n) for k in range(n)]

    def _of(self, split: str, k: int) -> Column:
        if not self.splits:
            return F.lit(None).cast("bigint")
        return F.element_at(F.create_map(*[x for s, v in self.splits.items() for x in (F.lit(s), F.lit(v[k]).cast("bigint"))]), F.col(split))

    def shard(self, split: str = "split", idx: str = "idx") -> Column:
        return contiguous_shard(idx, self._of(split, 0), self._of(split, 1))

    def part(self, split: str = "split", idx: str = "idx", shard: str = "shard") -> Column:
        """Partition of a row, from the position in its shard."""
        n, shards, chunk, first = (self._of(split, k) for k in range(4))
        small = F.floor(n / shards).cast("bigint")
        begin = F.col(shard) * small + F.least(F.col(shard), n % shards)
        chunks = F.ceil(F.ceil(n / shards) / chunk).cast("bigint")
        return (first + F.col(shard) * chunks + F.floor((F.col(idx) - begin) / chunk)).cast("int")


def shard_layout(
    df: DataFrame,
    order,
    split: str = "split",
    limit: int = SHARD_LIMIT,
    splits_bound: int = 16,
    bytes_col: str | None = None,
    block=None,
    blocks_bound: int | None = None,
) -> tuple[DataFrame, ShardPlan]:
    """Add ``idx`` (position inside its split, in ``order``), contiguous ``shard`` and write partition ``part``.

    Pass a narrow key frame with a per-row ``bytes_col`` (see ``row_bytes``) to
    index keys only and join the wide payload once, at the write.
    """
    indexed = dense_index(df, order, split, name="idx", groups_bound=splits_bound, block=block, blocks_bound=blocks_bound)
    plan = ShardPlan.of(indexed, split, limit, bytes_col)
    return indexed.withColumn("shard", plan.shard(split)).withColumn("part", plan.part(split)), plan


def with_shards(df: DataFrame, order, split: str = "split", limit: int = SHARD_LIMIT, **how) -> DataFrame:
    """``idx`` and ``shard`` of :func:`shard_layout`."""
    return shard_layout(df, order, split, limit, **how)[0].drop("part")


def write_sharded(
    df: DataFrame, path: str, split: str = "split", mode: str = "errorifexists", rows_per_group: int = ROWS_PER_GROUP, plan: ShardPlan | None = None, **options: str
) -> None:
    """One folder per (split, shard), rows in index order, row groups of exactly ``rows_per_group`` rows.

    The layout is ``<path>/split=<s>/shard=<i>/part-*.parquet`` so a reader can
    prune by split and by shard.  Every row goes to the write task that ``plan`` numbers
    for its place (``part`` where the frame has it), so nothing is sampled, a large
    shard is written by several tasks at once and its part files, in name
    order, are in position order. Without a ``plan`` one is made of the frame's own positions.
    The writer closes a row group by its number of rows, whatever their width; only the
    last one of a shard can be shorter.
    """
    plan = plan or _plan_of_shards(df, split, rows_per_group)
    placed = df if "part" in df.columns else df.withColumn("part", plan.part(split))
    ordered = placed.repartitionById(plan.parts, F.col("part")).sortWithinPartitions(split, "shard", "idx").drop("part")
    writer = ordered.write.mode(mode).option("compression", "zstd").options(**options).partitionBy(split, "shard")
    # a payload that is joined here may be far wider than Spark takes it to be: it is not sent to all tasks unless the caller says so
    with session_settings(df.sparkSession, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        # the byte limit must not close a group first
        writer.option("parquet.block.row.count.limit", rows_per_group).option("parquet.block.size", 2**31 - 1).parquet(path)


def _plan_of_shards(df: DataFrame, split: str, rows_per_group: int) -> ShardPlan:
    """A plan for rows that already have ``idx`` and ``shard``: rows and shards counted, one write task for ``rows_per_group`` x 64 rows."""
    sized = df.groupBy(split).agg(F.count(F.lit(1)).alias("n"), (F.max("shard") + 1).alias("shards")).collect()  # one row a split
    splits, parts, chunk = {}, 0, rows_per_group * 64
    for r in sorted(sized, key=lambda r: str(r[split])):
        splits[r[split]] = (r.n, r.shards, chunk, parts)
        parts += r.shards * -(-(-(-r.n // r.shards)) // chunk)
    return ShardPlan(splits, max(parts, 1))


def guarded_write(df: DataFrame, path: str, overwrite: bool = False, **opts) -> None:
    """Refuse a non-empty output folder unless ``overwrite`` is set; an empty one is written to."""
    if not overwrite and has_files(df.sparkSession, path):
        raise FileExistsError(f"{path} is not empty")
    writer = df.write.mode("overwrite")
    for k, v in opts.items():
        writer = writer.option(k, v)
    writer.parquet(path)


def materialise(df: DataFrame, path: str, overwrite: bool = False) -> DataFrame:
    """Write prepared rows once and hand back a frame reading them (cuts lineage)."""
    guarded_write(df, path, overwrite=overwrite)
    spark: SparkSession = df.sparkSession
    return spark.read.parquet(path)
