"""Lossless subword ids: round trips, a public implementation of the same merges, dropout, long words."""

import base64
import random

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import collate as co
from corpusprep.operators import labels as lb
from corpusprep.operators import subword as sw
from corpusprep.operators import tokens as tk
from corpusprep.plans import fixtures as fx
from tests.conftest import SF_SMALL

ODD = [
    None, "", " ", "\n\n  x\t y  ", "don't we'll", "ÅÄÖ åäö ñ", "日本語 テキスト 12３", "emoji \U0001f600\U0001f468‍\U0001f469  　x",
    "<|nospeech|> <|endoftext|>", "a\x00b\x1f\x85c", "   ", "\U0010fffe", "x" * 5000, "#$%&" * 50, "Ⅷ ½ ٣",
]


@pytest.fixture(scope="module")
def ranks(spark):
    return fx.ranks(spark)


@pytest.fixture(scope="module")
def small(spark):
    """A byte alphabet and a few merges, ranked by id."""
    tokens = [bytes([b]) for b in range(256)] + [b"he", b"ll", b"hell", b"lo", b"hello", b" w"]
    return sw.share(spark.createDataFrame([(bytearray(t), i) for i, t in enumerate(tokens)], "token binary, id int"))


def test_every_text_decodes_to_itself(spark, ranks):
    rng = random.Random(8)
    texts = ODD + ["".join(chr(rng.choice([32, 10, 65, 0x301, 0x4E00, 0x1F600]) + rng.randrange(60)) for _ in range(rng.randrange(80))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string").repartition(4)
    for ids in (sw.encode("text", ranks), sw.encode_dropout("text", ["k"], ranks, 0.4)):
        back = df.select("k", sw.decode(ids, ranks).alias("t")).collect()
        assert {r.k: r.t for r in back} == {k: t or "" for k, t in enumerate(texts)}


def test_same_ids_as_a_public_encoder(spark, ranks):
    import tiktoken

    with open(fx.RANKS, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    public = tiktoken.Encoding("own", pat_str=sw.SPLIT, mergeable_ranks=table, special_tokens={})
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-k, t) for k, t in enumerate(ODD) if t], "doc_id long, text string"))
    for r in docs.select("text", sw.encode("text", ranks).alias("ids")).collect():
        assert r.ids == public.encode_ordinary(r.text)


def test_merges_by_rank_then_place(small):
    assert sw.merge_word(b"hello", small.value) == [260]
    assert sw.merge_word(b"hehello", small.value) == [256, 260]
    assert sw.merge_word(b"lll", small.value) == [257, ord("l")]  # the leftmost of equal ranks
    assert sw.merge_word(b"", small.value) == [] and sw.merge_word(b"z", small.value) == [ord("z")]


def brute_merge(word, ranks, drop):
    parts, step = [bytes([b]) for b in word], 0
    while True:
        found = []
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and not drop(step, sum(map(len, parts[:i]))):
                found.append((rank, i))
        if not found:
            return [ranks[p] for p in parts]
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        step += 1


def test_queue_is_step_by_step_merging(ranks):
    rng = random.Random(4)
    for k in range(300):
        word = "".join(rng.choice("abehlonrstu é") for _ in range(rng.randrange(1, 40))).encode()
        drop = lambda step, at, k=k: random.Random(f"{k}:{step}:{at}").random() < 0.3
        assert sw.merge_word(word, ranks.value, drop) == brute_merge(word, ranks.value, drop)
        assert sw.merge_word(word, ranks.value) == brute_merge(word, ranks.value, lambda *_: False)


def test_a_very_long_word(spark, ranks):
    rng = random.Random(5)
    word = "".join(rng.choice("abcdefghij") for _ in range(100_000))
    df = spark.createDataFrame([(1, word), (2, "x" * 300_000)], "k int, text string")
    rows = df.select("text", sw.encode("text", ranks).alias("i"), sw.encode_dropout("text", ["k"], ranks, 0.2).alias("d"))
    for r in rows.select("*", sw.decode("i", ranks).alias("ti"), sw.decode("d", ranks).alias("td")).collect():
        assert r.ti == r.td == r.text and len(r.d) > len(r.i)


def test_dropout_does_not_depend_on_partitions_and_varies(spark, ranks):
    df = spark.createDataFrame([(i, "the same words in every row") for i in range(60)], "k int, text string")
    ids = lambda d, **kw: {r.k: r.ids for r in d.select("k", sw.encode_dropout("text", ["k"], ranks, 0.3, **kw).alias("ids")).collect()}
    once = ids(df.repartition(5))
    assert once == ids(df.coalesce(1))
    assert len({tuple(v) for v in once.values()}) > 20
    assert once != ids(df, epoch=1) and once != ids(df, seed=1)
    plain = df.select(sw.encode("text", ranks).alias("ids")).first().ids
    assert {tuple(r.ids) for r in df.select(sw.encode_dropout("text", ["k"], ranks, 0.0).alias("ids")).collect()} == {tuple(plain)}
    whole = df.limit(1).select(sw.encode_dropout("text", ["k"], ranks, 1.0).alias("ids")).first().ids
    assert len(whole) == len("the same words in every row")


def test_markers_and_cut_characters(spark, small):
    marks = {"<|nospeech|>": 400, "<|x|>": 401}
    df = spark.createDataFrame([(1, "hello<|x|> <|nospeech|>"), (2, "ü")], "k int, text string")
    rows = {r.k: r.ids for r in df.select("k", sw.encode("text", small, marks).alias("ids")).collect()}
    assert rows[1] == [260, 401, 32, 400] and len(rows[2]) == 2
    cut = df.where("k = 2").select(sw.decode(F.slice(sw.encode("text", small), 1, 1), small).alias("t"))
    assert cut.first().t == "�"
    kept = spark.createDataFrame([([260, -100, 400, 32], ), (None,)], "ids array<int>").select(sw.decode("ids", small, [400]).alias("t"))
    assert sorted(r.t for r in kept.collect()) == ["", "hello "]


def test_vocabularies_that_are_refused(spark, monkeypatch):
    rows = [(bytearray([b]), b) for b in range(256)]
    make = lambda r: spark.createDataFrame(r, "token binary, id int")
    with pytest.raises(ValueError, match="every byte"):
        sw.share(make(rows[:-1]))
    with pytest.raises(ValueError, match="unique"):
        sw.share(make(rows + [(bytearray(b"ab"), 255)]))
    monkeypatch.setattr(sw, "MAX_VOCABULARY_BYTES", 100)
    with pytest.raises(ValueError, match="too large"):
        sw.share(make(rows))


def test_a_pattern_that_leaves_text_out_is_refused(spark, small):
    df = spark.createDataFrame([("a b",)], "text string")
    with pytest.raises(Exception, match="leaves out"):
        df.select(sw.encode("text", small, pattern=r"\w+")).collect()


def test_labels_and_collation_of_another_vocabulary(spark):
    """Prompt, target and collator follow the reserved ids of the vocabulary, none of them the default ones."""
    own = fx.SUBWORD_RESERVED
    ids = lambda *v: F.array(*[F.lit(i) for i in v])
    zero = F.lit(0).cast("bigint")
    one = spark.range(1)
    prompt = lb.prompt_ids(ids(7, 8), reserved=own)
    target = tk.with_specials(ids(1, 2, 3), reserved=own)
    (row,) = one.select(lb.attach_prompt(prompt, target, zero, reserved=own).alias("labels")).collect()
    assert row.labels == [own.sop, 7, 8, own.sot, 50263, 50264, own.no_timestamps, 1, 2, 3, own.eot]
    silent = lb.prompt_ids(ids(own.no_speech), reserved=own)
    assert one.select(lb.attach_prompt(silent, target, zero, reserved=own).alias("l")).first().l[0] == own.sot
    batch = spark.createDataFrame([(0, row.labels), (1, row.labels[3:])], "idx long, labels array<int>")
    got = {r.idx: r for r in co.collate(batch, batch_size=2, reserved=own).collect()}
    assert got[0].labels == [tk.IGNORE] * 2 + row.labels[3:] and got[0].decoder_input_ids == row.labels[:-1]
    assert got[1].labels == row.labels[4:] + [tk.IGNORE] * 3 and got[1].decoder_input_ids[-2:] == [own.pad] * 2
    plain = {r.idx: r.labels for r in co.collate_plain(batch.where("idx = 1"), batch_size=2, reserved=own).collect()}
    assert plain[1] == row.labels[4:]
