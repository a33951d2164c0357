import pytest
from pyspark.sql import functions as F

from corpusprep.operators import order as od
from corpusprep.operators.index import dense_index
from corpusprep.operators.shard import contiguous_shard, estimate_bytes, shard_count
from corpusprep.session import scratch_path
from corpusprep.sources.sinks import with_shards, write_sharded


def _idx(spark, n=700):
    return dense_index(spark.range(n).withColumnRenamed("id", "key"), ["key"])


def test_full_shuffle_is_permutation_and_epoch_dependent(spark):
    df = spark.range(500).withColumnRenamed("id", "key")
    a = {r.key: r.pos for r in od.full_shuffle(df, "key", 1, 0).collect()}
    b = {r.key: r.pos for r in od.full_shuffle(df, "key", 1, 1).collect()}
    assert sorted(a.values()) == list(range(500)) and a != b
    assert a == {r.key: r.pos for r in od.full_shuffle(df.repartition(7), "key", 1, 0).collect()}


@pytest.mark.parametrize("buffer", [1, 8, 20, 50])
def test_buffered_shuffle_bounded_displacement(spark, buffer):
    out = od.buffered_shuffle(_idx(spark), "idx", buffer, 3, 0).collect()
    assert sorted(r.pos for r in out) == list(range(700))
    assert max(abs(r.pos - r.idx) for r in out) < buffer
    if buffer > 1:
        assert any(r.pos != r.idx for r in out)


def test_epoch_changes_buffered_order(spark):
    d = _idx(spark)
    e0 = [r.key for r in od.buffered_shuffle(d, "idx", 20, 3, 0).orderBy("pos").collect()]
    e1 = [r.key for r in od.buffered_shuffle(d, "idx", 20, 3, 1).orderBy("pos").collect()]
    assert e0 != e1 and sorted(e0) == sorted(e1)


def test_hash_blocks_grow_with_the_rows():
    assert od.hash_bits(10) == 16 and od.hash_bits(10**12) == 24


def test_file_order_is_the_same_for_the_same_files(spark):
    orders = []
    for n in (1, 2):
        path = scratch_path(spark, f"t-again{n}")
        d = spark.range(100).withColumn("part", F.col("id") % 4)
        d.repartition(4, "part").sortWithinPartitions("part", "id").write.partitionBy("part").parquet(path)
        orders.append([r.id for r in od.file_order_shuffle(spark.read.parquet(path), path, 10, 1, 0).orderBy("pos").collect()])
    assert orders[0] == orders[1]


def test_file_order_shuffle_keeps_rows(spark):
    path = scratch_path(spark, "t-files")
    spark.range(300).repartition(5).write.parquet(path)
    out = od.file_order_shuffle(spark.read.parquet(path), path, 10, 1, 0)
    assert sorted(r.id for r in out.collect()) == list(range(300))
    assert sorted(r.pos for r in out.collect()) == list(range(300))


def test_take_first_and_rank_shard(spark):
    d = _idx(spark, 50)
    assert [r.idx for r in od.take_first(d, 5, "idx").collect()] == [0, 1, 2, 3, 4]
    assert od.take_first(d, 80, "idx").count() == 50
    with pytest.raises(ValueError):
        od.take_first(d, 80, "idx", strict=True)
    ranks = od.rank_shard(d, "idx", 4).groupBy("rank").count().collect()
    assert sorted(r["count"] for r in ranks) == [12, 12, 13, 13]


@pytest.mark.parametrize("n,s", [(10, 3), (7, 7), (100, 1), (11, 4)])
def test_contiguous_shard_sizes(spark, n, s):
    df = spark.range(n).select(F.col("id").alias("idx"), F.lit(n).alias("n"), F.lit(s).alias("s"))
    shards = [r.sh for r in df.select(contiguous_shard("idx", "n", "s").alias("sh")).orderBy("idx").collect()]
    assert shards == sorted(shards) and set(shards) == set(range(s))
    sizes = [shards.count(i) for i in range(s)]
    assert max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)


def test_shard_count_and_bytes(spark):
    df = spark.createDataFrame([("ab", [1.0, 2.0], 3)], "t string, a array<float>, n bigint")
    assert estimate_bytes(df).first().nbytes == 2 + 8 + 8
    nested = spark.range(1).selectExpr(
        "array_repeat(array_repeat(float(1), 3000), 80) m", "array(repeat('x', 1000)) s", "binary('abc') b", "map('k', 1) p",
        "named_struct('a', 1, 'c', 'zz') t", "decimal(1) d", "array(array('ab', 'c'), null) n", "cast(null as array<string>) z",
    )
    sizes = {c: estimate_bytes(nested.select(c)).first().nbytes for c in nested.columns}
    assert sizes == {"m": 960_000, "s": 1000, "b": 3, "p": 5, "t": 6, "d": 8, "n": 3, "z": 0}
    with pytest.raises(TypeError):
        estimate_bytes(spark.range(1).selectExpr("parse_json('1') v"))
    r = spark.range(1).select(shard_count(F.lit(0), 10).alias("a"), shard_count(F.lit(10), 10).alias("b"), shard_count(F.lit(25), 10).alias("c")).first()
    assert (r.a, r.b, r.c) == (1, 2, 3)


def test_write_sharded_round_trip(spark):
    df = spark.range(200).select(F.col("id").alias("key"), F.when(F.col("id") < 150, "train").otherwise("test").alias("split"), F.repeat(F.lit("x"), 100).alias("payload"))
    sh = with_shards(df, ["key"], "split", limit=5000)
    path = scratch_path(spark, "t-shards")
    write_sharded(sh, path)
    back = spark.read.parquet(path)
    assert back.count() == 200
    per = back.groupBy("split", "shard").agg(F.min("idx").alias("a"), F.max("idx").alias("b"), F.count("*").alias("n")).collect()
    for r in per:
        assert r.b - r.a + 1 == r.n  # contiguous
    with pytest.raises(Exception):
        write_sharded(sh, path)  # output guard


def test_row_groups_of_any_width(spark):
    """Groups close at 128 rows whether rows are narrow or a megabyte wide in memory; files are in position order."""
    from corpusprep.sources.files import row_groups
    from corpusprep.sources.sinks import shard_layout

    for n, width in ((1000, 1), (300, 40_000)):
        df = spark.range(n).select(F.col("id").alias("key"), F.lit("train").alias("split"), F.transform(F.sequence(F.lit(1), F.lit(width)), lambda x: F.xxhash64("id", x)).alias("payload"))
        keys, plan = shard_layout(df.select("key", "split", F.lit(8 * width).cast("long").alias("b")), ["key"], "split", limit=8 * width * n // 2, bytes_col="b")
        path = scratch_path(spark, "t-groups")
        write_sharded(keys.drop("b").join(df.drop("split"), "key"), path, plan=plan)
        groups = row_groups(spark, path).orderBy("file", "group").collect()
        shards = {}
        for g in groups:
            shards.setdefault(g.file.split("shard=")[1][0], []).append(g.n_rows)
        assert len(shards) == 3 and sum(g.n_rows for g in groups) == n
        assert all(r == 128 for rows in shards.values() for r in rows[:-1])
        read = spark.read.parquet(path).select("idx", "shard", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i")).collect()
        ordered = sorted(read, key=lambda r: (r.shard, r.f, r.i))
        assert [r.idx for r in ordered] == list(range(n))


@pytest.mark.parametrize("n,limit", [(1, 10), (129, 10**9), (1000, 700), (777, 3000)])
def test_every_row_has_its_own_place(spark, n, limit):
    from corpusprep.sources.sinks import shard_layout

    df = spark.range(n).select("id", F.when(F.col("id") % 5 == 0, "test").otherwise("train").alias("split"), F.lit(10).cast("long").alias("b"))
    laid, plan = shard_layout(df, ["id"], "split", limit=limit, bytes_col="b")
    rows = sorted(laid.collect(), key=lambda r: (r.split, r.idx))
    parts = [r.part for r in rows]
    assert parts == sorted(parts) and parts[0] == 0 and parts[-1] < plan.parts
    assert len({(r.split, r.shard, r.part) for r in rows}) == len(set(parts))  # a write task takes rows of one shard


def test_placement_is_not_sampled(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    seen = []
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, **kw: seen.append(self._df))
    df = spark.range(500).select("id", F.lit("train").alias("split"))
    write_sharded(with_shards(df, ["id"], "split", block=F.floor(F.col("id") / 65536)), "unused")
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
