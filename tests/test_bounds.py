"""Disk and memory that must not grow with the input: shuffle files, passes of a write, batches sent to Python."""

import glob
import os

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusprep.llm.common import stored
from corpusprep.operators import subword as sw
from corpusprep.operators import udf as ud
from corpusprep.operators import wer as wr
from corpusprep.plans import jobs
from corpusprep.session import BATCH_BYTES
from corpusprep.sources import sinks


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    df = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, set_to = shuffle_files(spark), spark.conf.get(key)
    table = stored(df, "bounds")
    assert table.count() == 7
    assert spark.conf.get(key) == set_to
    table = stored(df, "bounds")
    assert not shuffle_files(spark) - before - shuffle_files_of_count(spark, before)


def shuffle_files_of_count(spark, before):
    """What other queries of the session, run without the setting, have left meanwhile: none are larger than the counts of a row."""
    return {f for f in shuffle_files(spark) - before if os.path.getsize(f) < 200}


@pytest.mark.parametrize("mode", ["errorifexists", "overwrite"])
def test_passes_write_what_one_pass_writes(spark, tmp_path, monkeypatch, mode):
    rows = spark.createDataFrame([(i, i % 2, f"text {i}") for i in range(300)], "doc_id long, source_id int, text string")
    outs = []
    for name, per_pass in (("one", 10**6), ("many", 1)):
        monkeypatch.setattr(sinks, "PASS_TASKS", per_pass)
        calls = []
        monkeypatch.setattr(jobs, "write_sharded", lambda *a, f=sinks_write, **k: calls.append(1) or f(*a, **k))
        out = str(tmp_path / name)
        jobs.interleave_job(rows, "0.9,0.1", out, test_ratio="0.1", shard_limit=20_000, mode=mode)
        assert len(calls) == 1 if name == "one" else 1 < len(calls) <= sinks.PASSES
        assert os.path.exists(f"{out}/_SUCCESS")
        files = sorted(glob.glob(f"{out}/*/*/part-*.parquet"))
        outs.append([(os.path.dirname(f).removeprefix(out), os.path.basename(f)[:10], [tuple(r) for r in pd.read_parquet(f, columns=["slot", "doc_id", "text", "idx"]).itertuples(index=False)]) for f in files])
    assert outs[0] == outs[1]


sinks_write = sinks.write_sharded


def test_batches_sent_to_python_are_bounded_in_bytes(spark):
    long = spark.range(2000).coalesce(1).select("id", F.repeat(F.lit("x"), 10_000).alias("text"))
    size = lambda b: pd.DataFrame({"id": b["id"], "bytes": [int(b["text"].str.len().sum())] * len(b)})
    found = ud.map_rows(long, size, "id long, bytes long")
    assert found.agg(F.count("id"), F.max("bytes") <= 2 * BATCH_BYTES).head() == (2000, True)


def test_ids_are_python_objects_for_some_rows_at_a_time():
    batch = pa.array(["a"] * (2 * sw.ROWS_AT_ONCE + 1))
    assert [len(x) for x in sw._some_rows(iter([batch]))] == [sw.ROWS_AT_ONCE, sw.ROWS_AT_ONCE, 1]


def test_wer_from_ids_decodes_once(spark):
    vocab = spark.createDataFrame([(bytearray([b]), b) for b in range(256)], "token binary, id int")
    ids = lambda t: list(t.encode())
    df = spark.createDataFrame([(ids("a b c"), ids("a x c")), (ids("a"), ids("a"))], "labels array<int>, predictions array<int>")
    found = wr.wer_from_ids(df, "labels", "predictions", sw.share(vocab), wr.Reserved(eot=300, pad=301, unk=302, sot=303, sop=304, no_timestamps=305, no_speech=306))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert [found.head()[k] for k in ("n_pairs", "errors", "ref_words")] == [2, 1, 4]


def test_a_pass_is_one_wave_of_write_tasks():
    """2 GB of rows are on their way where 8 tasks run at once, not 16; a large job has ``PASSES`` of them, and every task is in one pass."""
    for parts, at_once, most in ((40, 8, 8), (40, 6, 8), (40, 32, 32), (7, 8, 8), (4000, 8, 250), (1, 1, 1)):
        passes = sinks.ShardPlan({}, parts).passes(at_once)
        assert [p for lo, hi in passes for p in range(lo, hi)] == list(range(parts))
        assert max(hi - lo for lo, hi in passes) <= most and len(passes) <= sinks.PASSES
