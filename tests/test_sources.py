import os
import warnings

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.session import scratch_path
from corpusprep.sources import files as fs
from corpusprep.sources import sinks as sk


def test_list_files(spark):
    path = scratch_path(spark, "t-list")
    spark.range(30).repartition(3).write.parquet(path)
    got = fs.list_files(spark, path).collect()
    assert len(got) == 3 and all(r.bytes > 0 and r.path.endswith(".parquet") for r in got)
    nested = scratch_path(spark, "t-list-nested")
    spark.range(10).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(nested)
    spark.range(5).coalesce(1).write.mode("append").parquet(nested)
    assert fs.list_files(spark, nested).count() == 1  # sub-folder files are not listed
    same = scratch_path(spark, "t-same")
    spark.range(4).coalesce(1).write.parquet(f"{same}{same}")  # a nested folder whose path ends like the listed one
    spark.range(6).repartition(2).write.mode("append").parquet(same)
    got = fs.list_files(spark, same).orderBy("position").collect()
    assert [r.position for r in got] == [0, 1] and [r.path for r in got] == sorted(r.path for r in got)


def test_row_groups_reads_footers_alone(spark, tmp_path, monkeypatch):
    """A file of more bytes than one array can hold, a footer longer than the first read, and more groups than the driver holds."""
    small = scratch_path(spark, "t-footers")
    spark.range(1000).coalesce(1).write.option("parquet.block.row.count.limit", "300").parquet(small)
    whole = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(small).first().content
    large = tmp_path / "large file.parquet"
    with large.open("wb") as f:  # a hole of 2.5 GB that takes no disk
        f.write(whole[:4])
        f.seek(5 << 29)
        f.write(whole[4:])
    (tmp_path / "below").mkdir()
    (tmp_path / "below" / "b.parquet").write_bytes(whole)
    (tmp_path / "note.txt").write_text("not a table")
    monkeypatch.setattr(fs, "TAIL_BYTES", 64)
    monkeypatch.setattr(fs, "FOOTER_ROWS", 3)
    got = sorted((r.file.rsplit("/", 1)[1], r.group, r.n_rows) for r in fs.row_groups(spark, f"file://{tmp_path}").collect())
    assert got == [(n, k, r) for n in ("b.parquet", "large file.parquet") for k, r in enumerate([300, 300, 300, 100])]
    empty = tmp_path / "none"
    empty.mkdir()
    assert fs.row_groups(spark, f"file://{empty}").collect() == []
    (empty / "bad.parquet").write_bytes(b"PAR1 is not all of it")
    with pytest.raises(ValueError, match="bad.parquet"):
        fs.row_groups(spark, f"file://{empty}")


def test_declared_and_named_splits(spark):
    a, b = scratch_path(spark, "t-a"), scratch_path(spark, "t-b")
    spark.range(5).select(F.col("id").alias("k"), F.lit("x").alias("t")).write.parquet(a)
    spark.range(3).select(F.col("id").alias("k")).write.parquet(b)
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("t", T.StringType())])
    assert fs.read_declared(spark, a, schema, ["k"]).columns == ["k"]
    both = fs.read_named_splits(spark, {"train": a, "eval": b})
    assert {r.split: r["count"] for r in both.groupBy("split").count().collect()} == {"train": 5, "eval": 3}
    assert both.filter("split = 'eval'").filter(F.col("t").isNotNull()).count() == 0


def test_split_folder_and_saved(spark):
    root = scratch_path(spark, "t-splits")
    spark.range(10).withColumn("split", F.when(F.col("id") < 7, "train").otherwise("test")).write.partitionBy("split").parquet(root)
    assert fs.read_split(spark, root, "test").count() == 3
    plain = scratch_path(spark, "t-plain")
    spark.range(4).write.parquet(f"{plain}/valid")
    assert [(r.id, r.split) for r in fs.read_split(spark, plain, "valid").orderBy("id").collect()] == [(i, "valid") for i in range(4)]
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        tr, ev = fs.read_saved(spark, root)
        assert tr is ev and any("same" in str(x.message) or "training folder" in str(x.message) for x in w)


def test_registry_order_and_guard(spark):
    a, b = scratch_path(spark, "t-s1"), scratch_path(spark, "t-s2")
    spark.range(4).write.parquet(a)
    spark.range(2).write.parquet(b)
    u = fs.read_sources(spark, {"big": a, "small": b})
    assert {(r.source_id, r.source_name, r["count"]) for r in u.groupBy("source_id", "source_name").count().collect()} == {(0, "big", 4), (1, "small", 2)}
    df = spark.createDataFrame([("s1",), ("s2",), ("s9",)], "source string")
    tagged = {r.source: r.source_id for r in fs.tag_sources(df, "source", ["s2", "s1"]).collect()}
    assert tagged == {"s2": 0, "s1": 1}
    out = scratch_path(spark, "t-guard")
    sk.guarded_write(spark.range(2), out)
    with pytest.raises(FileExistsError):
        sk.guarded_write(spark.range(2), out)
    with pytest.raises(FileExistsError):
        sk.materialise(spark.range(2), out)
    empty = scratch_path(spark, "t-empty")
    os.makedirs(empty)
    sk.guarded_write(spark.range(2), empty)
    assert spark.read.parquet(empty).count() == 2
    sk.guarded_write(spark.range(3), out, overwrite=True)
    assert spark.read.parquet(out).count() == 3
    m = sk.materialise(spark.range(4), scratch_path(spark, "t-mat"))
    assert m.count() == 4
