"""Physical-plan properties the scale design relies on (checked with explain, not timing)."""

import pytest

import __spark_entry__ as E
from corpusprep.plans.catalog import load_all
from tests.conftest import SF_SMALL

OWN = set(load_all())
STREAMING = {k for k in OWN if k.startswith("stream_")}


def plan(spark, key):
    df = E.queries()[key](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("key", sorted(OWN - STREAMING))
def test_no_pairs_and_no_row_udfs(spark, key):
    p = plan(spark, key)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in p, f"{key}: {bad}"


def _read_schema(spark, key):
    s = E.queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    return s.split("ReadSchema: ")[1].split("\n")[0].split(",", 0)[0]


def test_scan_prunes_columns(spark):
    assert _read_schema(spark, "project_columns").startswith("struct<vec_id:bigint,label:int>")
    assert _read_schema(spark, "scan_declared").startswith("struct<doc_id:bigint,source:string,n_chars:bigint>")


def test_split_folder_pruned(spark):
    from corpusprep.session import scratch_path
    from corpusprep.sources.files import read_split

    path = scratch_path(spark, "t-pruned")
    spark.range(9).selectExpr("id", "concat('s', id % 3) as split").write.partitionBy("split").parquet(path)
    s = read_split(spark, path, "s1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in s and "(split" in s
    plain = E.queries()["scan_split_dir"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "/eval]" in plain  # only the split's own folder is read


def test_vocabulary_join_is_broadcast(spark):
    s = E.queries()["encode_words"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in s


def test_metric_is_native(spark):
    s = plan(spark, "wer_filtered")
    assert "Python" not in s and "SortMergeJoin" not in s


def test_interleave_write_plan(spark, monkeypatch):
    from corpusprep.plans import fixtures as fx
    from corpusprep.plans import jobs
    from corpusprep.sources.files import tag_sources

    captured = {}
    monkeypatch.setattr(jobs, "write_sharded", lambda df, out, **kw: captured.setdefault("df", df))
    docs = tag_sources(fx.table(spark, SF_SMALL, "documents"), "source", fx.SOURCE_NAMES)
    jobs.interleave_job(docs, fx.WEIGHT_LIST, "unused")
    p = captured["df"]._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert bad not in p
    # the wide text column is read by exactly two scans: row sizes and the final payload join
    assert p.count("ReadSchema: struct<doc_id:bigint,text:string") <= 2


def _executed(spark, key):
    return E.queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def test_length_filter_is_one_filtered_scan(spark):
    s = _executed(spark, "length_filter")
    assert s.count("FileScan parquet") == 1 and "Exchange" not in s and "Join" not in s and "Filter" in s


def test_splits_scan_once(spark):
    for key in ("exact_split", "three_way_split"):
        s = _executed(spark, key)
        assert "Union" not in s


def test_words_are_not_shuffled(spark):
    """No exchange above the exploded words: rows are partitioned by key before."""
    for key in ("encode_words", "decode_words"):
        lines = _executed(spark, key).split("\n")
        above = lines[: next(i for i, x in enumerate(lines) if "posexplode" in x)]
        first = next(i for i, x in enumerate(lines) if "posexplode" in x)
        depth = lines[first].index("Generate")
        ancestors, d = [], depth
        for x in reversed(above):
            at = len(x) - len(x.lstrip(" :+-*|"))
            if at < d:
                ancestors.append(x)
                d = at
        assert not any("Exchange hashpartitioning" in x for x in ancestors if "BroadcastExchange" not in x), key


def test_subwords_need_no_shuffle_and_one_pass(spark):
    for key in ("encode_text", "decode_ids", "encode_subword_dropout"):
        plan = _executed(spark, key)
        assert "Exchange" not in plan and "Join" not in plan
    # texts, prompts and stamped texts of a row go through Python together
    assert _executed(spark, "attach_prompt").count("ArrowEvalPython") == 1
