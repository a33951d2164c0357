import pytest
from pyspark.sql import functions as F

from corpusprep.operators import mix as mx
from corpusprep.operators.split import exact_split, leakage, n_inside, three_way_split
from corpusprep.plans import fixtures as fx
from tests.conftest import SF_SMALL


def _sources(spark, sizes):
    rows = [(s * 1000 + k, s, k) for s, n in enumerate(sizes) for k in range(n)]
    return spark.createDataFrame(rows, "doc_id long, source_id int, k long")


def test_all_exhausted_covers_every_source(spark):
    df = _sources(spark, [30, 5, 12])
    out = mx.mix(df, ["0.6", "0.3", "0.1"], seed=3)
    per = {r.source_id: (r.n, r.d) for r in out.groupBy("source_id").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("d")).collect()}
    assert {s: d for s, (_, d) in per.items()} == {0: 30, 1: 5, 2: 12}
    assert per[1][0] > 5  # the small source repeats
    slots = [r.slot for r in out.select("slot").collect()]
    assert sorted(slots) == list(range(len(slots)))  # every slot up to the stop is filled
    # the source exhausted last finishes exactly at the stop slot
    last = out.orderBy(F.col("slot").desc()).first()
    assert last.occ == {0: 30, 1: 5, 2: 12}[last.source_id] - 1


def test_first_exhausted_stops_at_first(spark):
    df = _sources(spark, [30, 5, 12])
    out = mx.mix(df, ["0.6", "0.3", "0.1"], seed=3, stop=mx.FIRST_EXHAUSTED)
    per = {r.source_id: r.d for r in out.groupBy("source_id").agg(F.countDistinct("doc_id").alias("d")).collect()}
    sizes = {0: 30, 1: 5, 2: 12}
    assert sum(per.get(s, 0) == n for s, n in sizes.items()) == 1  # exactly one source fully read
    assert out.groupBy("doc_id").count().filter("count > 1").count() == 0  # nothing repeats


def test_mix_is_partition_independent(spark):
    df = _sources(spark, [40, 9, 17])
    a = mx.mix(df.repartition(1), ["0.5", "0.25", "0.25"], 9).select("slot", "doc_id")
    b = mx.mix(df.repartition(13), ["0.5", "0.25", "0.25"], 9).select("slot", "doc_id")
    assert sorted(a.collect()) == sorted(b.collect())


def test_mix_rejects_bad_inputs(spark):
    df = _sources(spark, [3, 3])
    with pytest.raises(ValueError):
        mx.mix(df, ["1.0"], 1)
    with pytest.raises(ValueError):
        mx.mix(df, ["0.5", "0.5"], 1, stop="never")


def test_salting_keeps_results(spark, monkeypatch):
    df = _sources(spark, [50, 1])
    base = sorted(mx.mix(df, ["0.5", "0.5"], 5).select("slot", "doc_id").collect())
    monkeypatch.setattr(mx, "SLOTS_PER_KEY", 4)
    salted = sorted(mx.mix(df, ["0.5", "0.5"], 5).select("slot", "doc_id").collect())
    assert base == salted


def test_weights_by_name_follow_the_registry():
    assert mx.parse_weights({"b": "0.7", "a": "0.3"}, names=["a", "b"]) == mx.parse_weights("0.3,0.7")
    with pytest.raises(ValueError):
        mx.parse_weights({"a": "1"}, names=["a", "b"])
    with pytest.raises(ValueError):
        mx.parse_weights({"a": "1"})


def test_first_exhausted_draws_few_slots():
    w = mx.parse_weights(["0.9", "0.1"])
    assert mx._first_guess({0: 10_000, 1: 10_000}, w, mx.FIRST_EXHAUSTED) < 13_000 < mx._first_guess({0: 10_000, 1: 10_000}, w, mx.ALL_EXHAUSTED)


def test_n_inside_is_decimal():
    assert n_inside(0.07, 100) == 7
    assert n_inside("0.005", 400) == 2
    assert n_inside(0, 10) == 0 and n_inside(1, 10) == 10


@pytest.mark.parametrize("ratio", ["0", "0.013", "0.5", "1"])
def test_exact_split_sizes(spark, ratio):
    df = spark.range(1234).withColumnRenamed("id", "key")
    out = exact_split(df, "key", ratio, 7)
    assert out.filter("split = 'test'").count() == n_inside(ratio, 1234)
    assert out.count() == 1234


def test_exact_split_divides_large_buckets(spark, monkeypatch):
    from corpusprep.operators import split as sp

    df = spark.range(500).withColumnRenamed("id", "key")
    want = sorted(exact_split(df, "key", "0.31", 7).filter("split = 'test'").collect())
    monkeypatch.setattr(sp, "CUT_ROWS", 0)
    assert sorted(exact_split(df, "key", "0.31", 7).filter("split = 'test'").collect()) == want
    plan = three_way_split(df, "key", "0.2", "0.25", 42)._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and "Window" not in plan and "Exchange" not in plan


def test_exact_split_partition_independent(spark):
    df = spark.range(999).withColumnRenamed("id", "key")
    a = exact_split(df.repartition(1), "key", "0.1", 3).filter("split='test'").select("key").collect()
    b = exact_split(df.repartition(11), "key", "0.1", 3).filter("split='test'").select("key").collect()
    assert sorted(a) == sorted(b)


def test_three_way_and_leakage(spark):
    keys = fx.v_sources(spark, SF_SMALL)
    s = three_way_split(keys, "doc_id", "0.2", "0.25", 42)
    c = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    t = keys.count()
    n_test = n_inside("0.2", t)
    assert c["valid"] == n_inside("0.25", n_test) and c["test"] + c["valid"] == n_test
    # origin split never leaks; slot split of the mixed rows does
    m = mx.mix(keys, fx.WEIGHT_LIST, 42).select("slot", "doc_id")
    by_origin = three_way_split(m.select("doc_id").distinct(), "doc_id", "0.2", "0.25", 42)
    assert leakage(m.join(by_origin, "doc_id"), "doc_id").first()[0] == 0
    assert leakage(three_way_split(m, "slot", "0.2", "0.25", 42), "doc_id").first()[0] > 0


def test_flagship_same_at_any_partition_count(spark):
    from corpusprep.plans.q_mix import flagship_summary

    def run(n):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            return sorted(tuple(r) for r in flagship_summary(spark, SF_SMALL).collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")

    assert run(1) == run(4) == run(13)
