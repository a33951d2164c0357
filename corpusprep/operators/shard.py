"""Sizing and contiguous sharding of a split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GB = 10**9
SHARD_LIMIT = 2 * GB  # fixed value: shard size limit of the mixing job


# Bytes of the fixed-width types in memory.
WIDTHS = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4,
    T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8, T.DayTimeIntervalType: 8, T.YearMonthIntervalType: 4,
}


def _width(dtype: T.DataType) -> int | None:
    if isinstance(dtype, T.DecimalType):
        return 8 if dtype.precision <= 18 else 16
    if isinstance(dtype, T.NullType):
        return 0
    return WIDTHS.get(type(dtype))


def value_bytes(c: Column, dtype: T.DataType) -> Column:
    """In-memory size of one value, through arrays, maps and structs; null counts as its fixed width or 0."""
    zero = F.lit(0).cast("bigint")
    if _width(dtype) is not None:
        return F.lit(_width(dtype)).cast("bigint")
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c).cast("bigint"), zero)
    if isinstance(dtype, T.ArrayType):
        if _width(dtype.elementType) is not None:
            return F.coalesce(F.size(c).cast("bigint"), zero) * _width(dtype.elementType)
        if isinstance(dtype.elementType, T.StringType):
            return F.coalesce(F.octet_length(F.array_join(c, "")).cast("bigint"), zero)
        return F.coalesce(F.aggregate(c, zero, lambda acc, x: acc + value_bytes(x, dtype.elementType)), zero)
    if isinstance(dtype, T.MapType):
        return value_bytes(F.map_keys(c), T.ArrayType(dtype.keyType)) + value_bytes(F.map_values(c), T.ArrayType(dtype.valueType))
    if isinstance(dtype, T.StructType):
        total = zero
        for f in dtype.fields:
            total = total + value_bytes(c.getField(f.name), f.dataType)
        return total
    raise TypeError(f"no size rule for type {dtype.simpleString()}")


def row_bytes(df: DataFrame, exclude=()) -> Column:
    """In-memory size of one row, by the declared types of its columns."""
    total = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        if f.name not in exclude:
            total = total + value_bytes(F.col(f"`{f.name}`"), f.dataType)
    return total


def estimate_bytes(df: DataFrame, by=None) -> DataFrame:
    """Total estimated bytes (per group if ``by``), a partial + final aggregate."""
    b = row_bytes(df, exclude=[by] if isinstance(by, str) else list(by or []))
    agg = [F.count(F.lit(1)).alias("n_rows"), F.sum(b).cast("bigint").alias("nbytes")]
    return df.groupBy(by).agg(*agg) if by else df.agg(*agg)


def shard_count(nbytes, limit: int = SHARD_LIMIT) -> Column:
    """``nbytes div limit + 1``, at least one."""
    n = F.col(nbytes) if isinstance(nbytes, str) else nbytes
    return F.greatest(F.floor(n.cast("bigint") / F.lit(int(limit))).cast("bigint") + 1, F.lit(1).cast("bigint"))


def contiguous_shard(idx, n, shards) -> Column:
    """Shard of position ``idx`` when ``n`` rows are cut into ``shards`` consecutive runs.

    The first ``n mod shards`` runs hold one row more; sizes differ by at most one.
    """
    i = F.col(idx) if isinstance(idx, str) else idx
    n = F.col(n) if isinstance(n, str) else n
    s = F.col(shards) if isinstance(shards, str) else shards
    q = F.floor(n / s).cast("bigint")
    r = (n % s).cast("bigint")
    big = r * (q + 1)
    return F.when(i < big, F.floor(i / (q + 1))).otherwise(r + F.floor((i - big) / q)).cast("bigint")
