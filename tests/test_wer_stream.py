import pytest
from pyspark.sql import functions as F

from corpusprep.operators import wer as wr
from corpusprep.session import scratch_path
from corpusprep.streaming import file_order as fo
from corpusprep.streaming import stream as st


def lev(a, b):
    prev = list(range(len(a) + 1))
    for j, y in enumerate(b, 1):
        cur = [j]
        for i, x in enumerate(a, 1):
            cur.append(min(cur[i - 1] + 1, prev[i] + 1, prev[i - 1] + (x != y)))
        prev = cur
    return prev[-1]


def test_edit_distance_matches_python(spark):
    import random

    random.seed(5)
    rows = []
    for i in range(200):
        a = " ".join(random.choice("abcdef") for _ in range(random.randint(0, 15)))
        b = " ".join(random.choice("abcdefg") for _ in range(random.randint(0, 15)))
        rows.append((i, a, b))
    df = spark.createDataFrame(rows, "pair_id int, ref string, hyp string")
    got = {r.pair_id: r.edits for r in wr.pair_edits(df).collect()}
    assert got == {i: lev(a.split(), b.split()) for i, a, b in rows}


def test_edit_distance_with_more_words_than_one_plane_of_han(spark):
    ref = [f"r{i}" for i in range(11_000)]
    hyp = ref[:5_000] + [f"h{i}" for i in range(11_000)]
    df = spark.createDataFrame([(1, " ".join(ref), " ".join(hyp)), (2, "", ""), (3, "a\u00a0b", "a b")], "pair_id int, ref string, hyp string")
    got = {r.pair_id: r.edits for r in wr.pair_edits(df).collect()}
    assert got == {1: 11_000, 2: 0, 3: 0}


def test_corpus_rate_is_ratio_of_sums(spark):
    df = spark.createDataFrame([(1, "a b c d", "a b c d"), (2, "x", "y")], "pair_id int, ref string, hyp string")
    r = wr.corpus_wer(wr.pair_edits(df)).first()
    assert (r.errors, r.ref_words) == (1, 5) and abs(r.wer - 20.0) < 1e-9  # mean of row rates would be 50


def test_filters_and_empty_result(spark):
    df = spark.createDataFrame(
        [(1, "Hello there", ""), (2, "", "x"), (3, "a <|nospeech|>", "a"), (4, "Keep, me.", "keep me")],
        "pair_id int, ref string, hyp string",
    )
    st_ = wr.filter_pairs(df)
    assert st_["non_empty_pred"].count() == 3 and st_["non_empty_ref"].count() == 2
    assert [r.pair_id for r in st_["no_marker"].collect()] == [4]
    assert wr.filter_pairs(df, marker_first=False)["no_marker"].count() == 2  # literal order: marker already gone
    r = wr.wer_filtered(df).first()
    assert r.wer == 0.0
    none = wr.wer_filtered(df.filter("pair_id = 2")).first()
    assert none.n_pairs == 0 and none.wer is None


def test_stream_equals_batch_and_resumes(spark):
    src = spark.range(600).select(F.col("id").alias("event_id"), (F.col("id") * 3).alias("v"), (F.col("id") % 6).alias("part"))
    path = scratch_path(spark, "t-feed")
    st.write_feed(src.filter("part < 3"), path, "part", 6, "event_id")
    schema = spark.read.parquet(path).schema
    sink, ck = scratch_path(spark, "t-sink"), scratch_path(spark, "t-ckpt")
    keep = lambda b, i: b.select("event_id", "v")
    st.run_available(st.read_stream(spark, path, schema, 1), sink, ck, keep)
    assert st.read_sink(spark, sink).select("batch").distinct().count() == 3  # one file per trigger
    st.write_feed(src.filter("part >= 3"), path, "part", 6, "event_id")
    st.run_available(st.read_stream(spark, path, schema, 2), sink, ck, keep)
    got = st.read_sink(spark, sink)
    assert got.count() == 600 and got.select("event_id").distinct().count() == 600
    assert sorted(tuple(r) for r in got.select("event_id", "v").collect()) == sorted(tuple(r) for r in src.select("event_id", "v").collect())


def test_take_writer_is_idempotent(spark):
    sink, state = scratch_path(spark, "t-take"), scratch_path(spark, "t-take-state")
    w = st.take_writer(sink, state, 5, ["x"])
    a = spark.range(3).withColumnRenamed("id", "x")
    b = spark.range(10, 14).withColumnRenamed("id", "x")
    w(a, 0)
    w(b, 1)
    w(b, 1)  # replay of batch 1
    w(b, 2)  # after the limit: nothing written
    got = sorted(r.x for r in st.read_sink(spark, sink).collect())
    assert got == [0, 1, 2, 10, 11]
    assert st.read_mark(spark, state, 2) == {"kept": 5} and st.read_mark(spark, state, 7) == {}


def test_take_stops_the_stream(spark):
    src = spark.range(500).select(F.col("id").alias("event_id"), (F.col("id") % 5).alias("part"))
    path = scratch_path(spark, "t-stop")
    st.write_feed(src, path, "part", 5, "event_id")
    sink, state, ck = (scratch_path(spark, f"t-stop-{x}") for x in ("sink", "state", "ck"))
    st.run_take(st.read_stream(spark, path, "event_id BIGINT, part BIGINT"), sink, state, ck, 150, ["file", "row_in_file"])
    got = sorted(r.event_id for r in st.read_sink(spark, sink).collect())
    want = sorted([r for r in range(500) if r % 5 == 0] + [r for r in range(500) if r % 5 == 1][:50])
    assert got == want


FEED = "event_id BIGINT, part BIGINT"


@pytest.fixture(scope="module")
def feed(spark):
    """500 events in ten files, and the order in which a batch job lays them out."""
    from corpusprep.functions.draws import draw_hash

    src = spark.range(500).select(F.col("id").alias("event_id"), (F.col("id") % 10).alias("part"))
    path = scratch_path(spark, "t-ordered")
    st.write_feed(src, path, "part", 10, "event_id")
    rows = spark.read.schema(FEED).parquet(path).select("event_id", *[draw_hash(42, "files", F.lit(e), F.concat(F.lit("part="), "part")).alias(f"h{e}") for e in range(3)]).collect()
    order = [[r.event_id for r in sorted(rows, key=lambda r: (r[f"h{e}"], r.event_id))] for e in range(3)]
    return path, order


def _ordered(spark, path, step, files, untils=(None,), epochs=1, replay=False):
    sink, state, ck = (scratch_path(spark, f"t-ord-{x}") for x in ("sink", "state", "ck"))
    write = st.carried_writer(sink, state, step, fo.in_file_order)

    def twice(rows, batch_id):
        write(rows, batch_id)
        if replay:
            write(rows, batch_id)  # as after a lost commit

    for until in untils:
        fo.run_in_order(spark, path, FEED, ck, twice, 42, epochs, files, until)
    st.finish_carried(spark, sink, state, step)
    return st.read_sink(spark, sink)


def test_file_order_stream_over_epochs_and_restarts(spark, feed):
    path, order = feed
    step = lambda pool, arrived, emitted, last: (pool, pool.limit(0))
    got = _ordered(spark, path, step, 4, (3, 3, 13, None), epochs=3).orderBy("idx").collect()
    assert [r.idx for r in got] == list(range(1500))
    assert [r.event_id for r in got] == order[0] + order[1] + order[2]
    assert [r.epoch for r in got] == [0] * 500 + [1] * 500 + [2] * 500


def test_file_order_is_that_of_the_batch_shuffle(spark, feed):
    from corpusprep.operators.order import file_order_shuffle

    path, order = feed
    batch = file_order_shuffle(spark.read.parquet(path), path, 1, 42, 0).orderBy("pos").collect()  # a buffer of one moves nothing
    assert [r.event_id for r in batch] == order[0]
    files = spark.read.parquet(path).inputFiles()
    named = [f.split("part=")[1][0] for f in fo.file_order(sorted(files), path, 42, 1)]
    assert named == [str(e % 10) for e in order[1][::50]]


@pytest.mark.parametrize("files", [1, 3, 10])
def test_stream_shuffle_is_the_batch_shuffle(spark, feed, files):
    from corpusprep.operators.order import file_order_shuffle

    path, _ = feed
    want = {r.event_id: r.pos for r in file_order_shuffle(spark.read.parquet(path), path, 70, 42, 0).collect()}
    got = _ordered(spark, path, st.shuffle_step(70, 42), files, replay=files == 3)
    assert {r.event_id: r.pos for r in got.collect()} == want and got.count() == 500
    assert {r.batch for r in got.select("batch").distinct().collect()} == set(range(-(-10 // files) + 1))


@pytest.mark.parametrize("files", [1, 3, 10])
def test_batches_are_formed_on_arrival(spark, feed, files):
    from corpusprep.operators import collate as co

    path, order = feed
    step = st.batch_step(16, lambda b: co.assign_batches(b, batch_size=16))
    got = _ordered(spark, path, step, files, (2, None), replay=files == 1).collect()
    assert {r.event_id: (r.batch_id, r.pos) for r in got} == {e: (k // 16, k % 16) for k, e in enumerate(order[0])}
    assert len(got) == 500


def test_an_empty_stream_ends(spark):
    path = scratch_path(spark, "t-none")
    spark.range(0).select(F.col("id").alias("event_id"), F.col("id").alias("part")).write.parquet(path)
    step = st.shuffle_step(5, 42)
    sink, state, ck = (scratch_path(spark, f"t-none-{x}") for x in ("sink", "state", "ck"))
    fo.run_in_order(spark, path, FEED, ck, st.carried_writer(sink, state, step, fo.in_file_order))
    st.finish_carried(spark, sink, state, step)
    assert st.read_sink(spark, sink).count() == 0


def test_replacement_shuffle_is_the_buffer(spark):
    from corpusprep.functions.draws import draw, draw_hash
    from corpusprep.operators.order import replacement_shuffle

    for n, buffer, cut in ((100, 7, 30), (5, 20, 1000), (64, 1, 64), (90, 30, 30)):
        d = spark.range(n).withColumnRenamed("id", "idx")
        s, k = F.floor(F.col("idx") / cut), F.col("idx") % cut
        draws = {r.idx: r for r in d.select("idx", draw(42, "slot", F.lit(0), s, k).alias("u")).collect()}
        rest = {r.slot: r for r in spark.range(buffer).select(F.col("id").alias("slot"), *[draw_hash(42, "rest", F.lit(0), F.lit(c), "id").alias(f"c{c}") for c in range(-(-n // cut))]).collect()}
        want = []
        for c in range(-(-n // cut)):
            rows, held = list(range(c * cut, min(n, (c + 1) * cut))), []
            for i in rows:
                if len(held) < buffer:
                    held.append(i)
                else:
                    slot = draws[i].u % buffer
                    want.append(held[slot])
                    held[slot] = i
            want += [held[slot] for slot in sorted(range(len(held)), key=lambda slot: rest[slot][f"c{c}"])]
        got = replacement_shuffle(d, "idx", buffer, slice_rows=cut).orderBy("pos").collect()
        assert [r.idx for r in got] == want and [r.pos for r in got] == list(range(n))


def words_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(diagonal + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def test_banded_distance_is_brute_force(spark, monkeypatch):
    import random

    rng = random.Random(11)
    rows = []
    for k in range(60):
        a = [f"w{rng.randrange(30)}" for _ in range(rng.randrange(1, 120))]
        b = [w for w in a if rng.random() < 0.9] if k % 2 else [f"w{rng.randrange(30)}" for _ in range(rng.randrange(0, 90))]
        for _ in range(rng.randrange(6)):
            b.insert(rng.randrange(len(b) + 1), rng.choice(["new", "\U0001f600", "w1"]))
        rows.append((k, " ".join(a), " ".join(b)))
    df = spark.createDataFrame(rows, "pair_id int, ref string, hyp string")
    want = {k: words_distance(a.split(), b.split()) for k, a, b in rows}
    assert max(want.values()) > 64  # several bands are needed
    assert {r.pair_id: r.edits for r in wr.pair_edits(df).collect()} == want
    monkeypatch.setattr(wr, "SYMBOLS", 8)  # words of a pair share hashes: numbers from the dictionary
    assert {r.pair_id: r.edits for r in wr.pair_edits(df).collect()} == want


def test_a_pair_of_twenty_thousand_words(spark):
    words = [f"word{k % 15_000}" for k in range(20_000)]
    other = [w for k, w in enumerate(words) if k % 500] + ["more"] * 7
    df = spark.createDataFrame([(1, " ".join(words), " ".join(other))], "pair_id int, ref string, hyp string")
    r = wr.pair_edits(df).first()
    assert (r.ref_words, r.edits) == (20_000, 40 + 7)


def test_pairs_without_reference_are_counted(spark):
    df = spark.createDataFrame([(1, "a b", "a"), (2, "", "x"), (3, " ", "")], "pair_id int, ref string, hyp string")
    r = wr.corpus_wer(wr.pair_edits(df)).first()
    assert (r.n_pairs, r.n_dropped, r.errors, r.ref_words) == (1, 2, 1, 2)


def test_user_aggregate_folds_merges_and_finishes(spark, monkeypatch):
    from corpusprep.operators import udf as ud

    monkeypatch.setattr(ud, "OPEN_GROUPS", 3)  # states are passed on early
    df = spark.range(5000).selectExpr("if(id % 7 = 3, null, id % 7) as k", "concat('s', id % 2) as name", "id as v").repartition(9)

    def spread(state):
        return {"n": state["n"], "width": state["hi"] - state["lo"]}

    got = ud.user_aggregate(
        df,
        ["k", "name"],
        lambda: {"n": 0, "lo": 1 << 40, "hi": -1},
        lambda s, rows: {"n": s["n"] + len(rows), "lo": min(s["lo"], int(rows["v"].min())), "hi": max(s["hi"], int(rows["v"].max()))},
        lambda a, b: {"n": a["n"] + b["n"], "lo": min(a["lo"], b["lo"]), "hi": max(a["hi"], b["hi"])},
        spread,
        "n long, lo long, hi long",
        "n long, width long",
    )
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapGroupsInPandas") == 2 and "MapInPandas" in plan
    want = df.groupBy("k", "name").agg(F.count("*").alias("n"), (F.max("v") - F.min("v")).alias("width"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    empty = ud.user_aggregate(df.where("v < 0"), "name", dict, lambda s, r: s, lambda a, b: a, spread, "n long, lo long, hi long", "n long, width long")
    assert empty.collect() == []
