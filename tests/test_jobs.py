from pyspark.sql import functions as F

from corpusprep.operators import mix as mx
from corpusprep.plans.jobs import interleave_job
from corpusprep.session import scratch_path


def test_interleave_job_writes_whole_payload(spark):
    rows = spark.createDataFrame(
        [(s * 100 + i, s, f"text-{s}-{i}", [float(i)] * 3) for s, n in enumerate([20, 3, 9]) for i in range(n)],
        "doc_id long, source_id int, text string, feats array<float>",
    )
    out = scratch_path(spark, "t-job")
    interleave_job(rows, ["0.5", "0.3", "0.2"], out, seed=4, test_ratio="0.2", valid_ratio="0.5", shard_limit=600)
    back = spark.read.parquet(out)
    n = back.count()
    assert back.select("slot").distinct().count() == n and back.agg(F.max("slot")).first()[0] == n - 1
    # payload matches its origin row
    bad = back.join(rows.select("doc_id", F.col("text").alias("t0")), "doc_id").filter(F.col("text") != F.col("t0")).count()
    assert bad == 0 and back.select("doc_id").distinct().count() == 32
    # origins never straddle splits; positions dense per split; shards contiguous
    assert back.groupBy("doc_id").agg(F.countDistinct("split").alias("c")).filter("c > 1").count() == 0
    for r in back.groupBy("split").agg(F.count("*").alias("n"), F.min("idx").alias("a"), F.max("idx").alias("b"), F.countDistinct("idx").alias("d")).collect():
        assert r.a == 0 and r.b == r.n - 1 and r.d == r.n
    per = back.groupBy("split", "shard").agg(F.min("idx").alias("a"), F.max("idx").alias("b"), F.count("*").alias("n")).collect()
    assert all(r.b - r.a + 1 == r.n for r in per) and len(per) > 3


def test_interleave_job_same_with_salted_join(spark, monkeypatch):
    rows = spark.createDataFrame([(s * 100 + i, s, f"t{s}{i}") for s, n in enumerate([15, 2]) for i in range(n)], "doc_id long, source_id int, text string")
    a, b = scratch_path(spark, "t-job-a"), scratch_path(spark, "t-job-b")
    interleave_job(rows, ["0.7", "0.3"], a, seed=2, test_ratio="0.2")
    monkeypatch.setattr(mx, "SLOTS_PER_KEY", 2)
    interleave_job(rows, ["0.7", "0.3"], b, seed=2, test_ratio="0.2")
    cols = ["slot", "doc_id", "text", "split", "idx", "shard"]
    ra = sorted(tuple(r) for r in spark.read.parquet(a).select(*cols).collect())
    rb = sorted(tuple(r) for r in spark.read.parquet(b).select(*cols).collect())
    assert ra == rb and len(ra) > 17


def test_interleave_job_slot_split_leaks(spark):
    from corpusprep.operators.split import leakage

    rows = spark.createDataFrame([(s * 100 + i, s, f"t{s}{i}") for s, n in enumerate([30, 4]) for i in range(n)], "doc_id long, source_id int, text string")
    a, b = scratch_path(spark, "t-orig"), scratch_path(spark, "t-slot")
    interleave_job(rows, ["0.5", "0.5"], a, seed=3, test_ratio="0.3")
    interleave_job(rows, ["0.5", "0.5"], b, seed=3, test_ratio="0.3", split_by="slot")
    assert leakage(spark.read.parquet(a), "doc_id").first()[0] == 0
    assert leakage(spark.read.parquet(b), "doc_id").first()[0] > 0
    assert spark.read.parquet(a).count() == spark.read.parquet(b).count()


def _files_in_order(path):
    import glob
    import os

    import pyarrow.parquet as pq

    last = {}
    for f in sorted(glob.glob(f"{path}/split=*/shard=*/*.parquet")):
        idx = pq.read_table(f, columns=["idx"]).column("idx").to_pylist()
        if not idx:
            continue
        if any(b != a + 1 for a, b in zip(idx, idx[1:])):
            return False
        folder = os.path.dirname(f)
        if folder in last and idx[0] != last[folder] + 1:
            return False
        last[folder] = idx[-1]
    return True


def test_written_shards_are_in_position_order(spark, monkeypatch):
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        rows = spark.createDataFrame([(s * 1000 + i, s, f"x{i}" * 20) for s, n in enumerate([300, 40]) for i in range(n)], "doc_id long, source_id int, text string")
        a, b = scratch_path(spark, "t-ord-a"), scratch_path(spark, "t-ord-b")
        interleave_job(rows, ["0.6", "0.4"], a, seed=1, test_ratio="0.1", shard_limit=20000)
        monkeypatch.setattr(mx, "SLOTS_PER_KEY", 2)
        interleave_job(rows, ["0.6", "0.4"], b, seed=1, test_ratio="0.1", shard_limit=20000)
        assert _files_in_order(a) and _files_in_order(b)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_usage_path_from_source_folders(spark):
    from corpusprep.sources.files import read_sources

    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    paths = {}
    for name in ["src0", "src1", "src2"]:
        paths[name] = scratch_path(spark, f"t-{name}")
        d.filter(F.col("source") == name).write.parquet(paths[name])
    rows = read_sources(spark, paths).withColumn("origin", F.col("doc_id"))
    out = scratch_path(spark, "t-usage")
    interleave_job(rows, "0.5,0.3,0.2", out, seed=42, origin="origin", test_ratio="0.1", valid_ratio="0.5")
    back = spark.read.parquet(out)
    sizes = {r.source_name: r["count"] for r in d.filter(F.col("source").isin(list(paths))).groupBy(F.col("source").alias("source_name")).count().collect()}
    seen = {r.source_name: r.n for r in back.groupBy("source_name").agg(F.countDistinct("doc_id").alias("n")).collect()}
    assert seen == sizes  # every source fully read
    assert _files_in_order(out)


def test_interleave_job_string_origin(spark):
    rows = spark.createDataFrame([(f"a/{s}/{i}.wav", s, i) for s, n in enumerate([12, 5]) for i in range(n)], "audio_path string, source_id int, n int")
    out = scratch_path(spark, "t-str")
    interleave_job(rows, ["0.6", "0.4"], out, seed=8, origin="audio_path", test_ratio="0.25")
    back = spark.read.parquet(out)
    assert back.select("audio_path").distinct().count() == 17
    assert back.groupBy("audio_path").agg(F.countDistinct("split").alias("c")).filter("c > 1").count() == 0
    assert _files_in_order(out)


def test_repeated_origin_is_refused(spark):
    import pytest

    rows = spark.createDataFrame([(1, 0, "a"), (1, 0, "b"), (2, 1, "c")], "doc_id long, source_id int, text string")
    with pytest.raises(ValueError, match="repeats"):
        interleave_job(rows, ["0.5", "0.5"], scratch_path(spark, "t-rep"))
