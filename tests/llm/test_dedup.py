"""Substring, near-duplicate and line deduplication against brute force, and odd inputs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusprep.llm.common import components
from corpusprep.llm.line_dedup import line_classes, line_dedup
from corpusprep.llm.near_dedup import near_classes, near_dedup, prob_minhash, probability_jaccard, weighted_shingles
from corpusprep.llm.substring_dedup import substring_dedup
from corpusprep.session import session_settings
from tests.llm import brute
from tests.llm.conftest import odd_texts, sentence


def test_substring_dedup_is_brute_force(spark, odd):
    rows = odd_texts()
    want = sorted((str(i), *x) for (i, _), x in zip(rows, brute.substring_dedup([t for _, t in rows])))
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(odd).collect())
    assert got == want
    assert any(x[2] for x in want) and any(0 < x[2] < x[1] for x in want)


def test_substring_dedup_short_windows_and_documents(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(40))) for _ in range(60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for window in (5, 8):
        want = brute.substring_dedup(texts, window)
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(df, window=window).collect()}
        assert [got[i] for i in range(len(texts))] == want


def test_near_classes_are_brute_force(spark, odd):
    rows = [(i, t) for i, t in odd_texts() if i is not None]
    want = brute.near_classes(list(dict.fromkeys(rows)))
    got = {r.id: r.class_id for r in near_classes(odd).collect() if r.id is not None}
    assert got == want
    assert got[102] == 0 and got[101] == 3 and got[200] == 200


def test_near_dedup_keeps_one_of_each_class_and_all_columns(spark, odd):
    kept = near_dedup(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(400) == 1 and 102 not in ids and 0 in ids and 100 not in ids and 201 in ids


def test_probability_jaccard_and_its_estimate():
    rng = random.Random(2)
    a = sentence(rng, 400, 30)
    b = " ".join(w if rng.random() > 0.03 else "other" for w in a.split())
    owner, value, weight = weighted_shingles([a, b])
    bags = [(value[owner == i], weight[owner == i]) for i in (0, 1)]
    exact = brute.probability_jaccard(brute.shingles(a), brute.shingles(b))
    assert abs(probability_jaccard(*bags) - exact) < 1e-9
    sig = prob_minhash(owner, value, weight, 2, 2000)
    assert abs(float(np.mean(sig[0] == sig[1])) - exact) < 0.05


def test_large_group_of_near_copies_is_one_class(spark):
    rng = random.Random(5)
    base = sentence(rng, 200).split()
    rows = []
    for i in range(300):
        own = list(base)
        own[rng.randrange(200)] = f"edit{i}"
        rows.append((i, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.class_id for r in near_classes(df).collect()} == {0}


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == brute.components(sorted({x for e in links for x in e}), links)


def test_line_classes_are_brute_force(spark):
    rng = random.Random(9)
    lines = [sentence(rng, rng.randrange(1, 30)) for _ in range(40)]
    docs = []
    for i in range(60):
        own = [rng.choice(lines) for _ in range(4)] + ["", "  "]
        if i % 4 == 0:
            own.append(rng.choice(lines) + " tail")
        docs.append((i, "\n".join(own)))
    docs.append((900, None))
    want = brute.line_classes(docs)
    got = {(r.id, r.line_no): r for r in line_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert set(got) == set(want)
    assert [k for k in want if got[k].class_id is not None and (got[k].class_id, got[k].class_line) != want[k]] == []
    assert all(got[k].kept == (want[k] == k) for k in want)


def test_line_dedup_of_odd_rows(spark, odd):
    out = line_dedup(odd)
    assert out.columns == odd.columns
    by = {}
    for r in out.collect():
        by.setdefault(r.doc_id, []).append(r.text)
    assert by[200] == [None] and by[201] == [""] and by[202] == [" \n\t "] and by[203] == ["one"]
    assert by[303][0].count("\n") == 0 and by[100] == [""]
    assert by[500] == ["Zeile eins\r\nZeile zwei\u00a0\u3000"]
    assert len(by[None]) == 2


def test_empty_tables(spark, none):
    assert substring_dedup(none).collect() == []
    assert near_classes(none).collect() == []
    assert line_classes(none).collect() == []
    assert near_dedup(none).columns == none.columns and line_dedup(none).count() == 0


def test_long_repetitive_lines_meet(spark):
    units = [f"unit {i:04d} of a ruler that goes on {i * i:08d}"[:40] for i in range(20)]
    docs = []
    for i, unit in enumerate(units):
        line = unit * 500
        docs += [(2 * i, line), (2 * i + 1, line + "!")]
    got = {r.id: r.class_id for r in line_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(len(brute.char_shingles(docs[2 * i][1]) & brute.char_shingles(docs[2 * i + 1][1])) >= 0.8 * 41 for i in range(len(units)))
    assert got == {i: i - i % 2 for i in range(2 * len(units))}


def test_line_pairs_just_above_the_threshold_all_meet(spark):
    rng = random.Random(21)
    docs, similar = [], []
    for i in range(800):
        line = [rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(198)]
        line = ["x", *line, "x"]
        other = list(line)
        for at in (60, 140):
            other[at] = "#"
        docs += [(2 * i, "".join(line)), (2 * i + 1, "".join(other))]
        a, b = brute.char_shingles(docs[-2][1]), brute.char_shingles(docs[-1][1])
        similar.append(len(a & b) / len(a | b))
    assert 0.80 <= min(similar) and max(similar) <= 0.85
    got = {r.id: r.class_id for r in line_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i in range(1600)}


def test_columns_of_any_name_stay(spark):
    from corpusprep.llm.decontaminate import decontaminate

    text = sentence(random.Random(1), 40)
    names = ["own_key", "_own_key", "kept_key", "copies", "bad_key", "lost_key", "lost_lines", "rk", "node", "root"]
    rows = [(k, t, *([f"{k}"] * len(names))) for k, t in enumerate([text, text, "other words\nother words", None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    items = spark.createDataFrame([(1, "nothing of this kind at all is there")], "item_id long, text string")
    for out, ids in ((near_dedup(docs), {0, 2, 3}), (line_dedup(docs), {0, 1, 2, 3}), (decontaminate(docs, items), {0, 1, 2, 3})):
        got = out.collect()
        assert out.columns == docs.columns and {r.doc_id for r in got} == ids
        assert all(r[n] == str(r.doc_id) for r in got for n in names)


def test_pairs_that_share_a_passage_meet_their_likes(spark):
    """Texts of one long passage and unlike ends are not alike; those with like ends still find each other."""
    rng = random.Random(31)
    passage = sentence(rng, 60)
    docs, want = [], {}
    for k in range(40):
        end = sentence(rng, 60)
        for j in range(2):
            docs.append((2 * k + j, f"{passage} {end}" + (" more" if j else "")))
            want[2 * k + j] = 2 * k
    got = {r.id: r.class_id for r in near_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == want


def test_unlike_lines_that_share_buckets_are_not_compared(spark, monkeypatch):
    """Long lines of few words share bands by chance: whole signatures, not shingle sets, tell them apart."""
    import corpusprep.llm.line_dedup as module

    rng = random.Random(8)
    base = [" ".join(rng.choice(["abcde", "fghij", "klmno", "pqrst", "uvwxy", "zabcd"]) + rng.choice("0123456789") for _ in range(60)) for _ in range(400)]
    near = [x[:-1] + "!" for x in base[:20]]
    compared, real = [], module.verified
    count = lambda pairs, lines, similarity: (compared.append(pairs.count()), real(pairs, lines, similarity))[1]
    monkeypatch.setattr(module, "verified", count)
    docs = spark.createDataFrame([(k, x) for k, x in enumerate(base + near)], "doc_id long, text string")
    rows = {r.id: r.class_id for r in line_classes(docs).collect()}
    assert rows == {k: k - 400 if k >= 400 else k for k in range(420)}
    assert sum(compared[-4:]) <= 40


@pytest.mark.parametrize("pairwise", [1, 64])
def test_links_do_not_depend_on_the_size_of_buckets(spark, monkeypatch, pairwise):
    """Lines around one passage, each with a near copy: every bucket size gives the classes of brute force."""
    from corpusprep.llm import common

    monkeypatch.setattr(common, "PAIRWISE", pairwise)
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    passage = word(120)
    own = [passage + word(rng.randrange(60, 200)) + "." for _ in range(60)]
    lines = own + [x[:-1] + word(rng.randrange(1, 60)) for x in own]
    sets = [{x[i : i + 10] for i in range(len(x) - 9)} for x in lines]
    least = list(range(len(lines)))
    for a in range(len(lines)):
        for b in range(a + 1, len(lines)):
            if least[a] != least[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                lo, hi = sorted((least[a], least[b]))
                least = [lo if x == hi else x for x in least]
    assert 60 < len(set(least)) < len(lines)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert {r.id: r.class_id for r in line_classes(docs).collect()} == dict(enumerate(least))


def test_a_pair_of_many_common_rare_tokens_is_seldom_made_twice(spark):
    """Rows of the join on rare tokens, with and without witnesses: the same pairs, but not one row for each common token."""
    from corpusprep.llm import common

    rng = random.Random(12)
    rows = []
    for node in range(60):
        kept = [t for t in range(100, 140) if rng.random() < 0.9] + [t for t in range(200, 900) if rng.random() < 0.01]
        rows += [(node, 1_000_003 * t, i / 400) for i, t in enumerate(sorted(kept))]
    rare = spark.createDataFrame(rows, "node long, key long, before double")
    seen = common._witnessed(rare)
    assert seen.count() == len(rows)
    one, two = (seen.selectExpr("key", f"node as {x}", *[f"{w} as {w}_{x}" for w in common.WITNESSES]) for x in "ab")
    every = one.join(two, "key").where("a < b")
    few = every.where(common._met_here())
    assert set(few.select("a", "b").collect()) == set(every.select("a", "b").collect())
    assert few.count() < 3 * 60 * 59 / 2 < every.count() / 8


def test_signatures_hold_the_least_hash_of_every_bin(spark):
    from corpusprep.llm import line_dedup as module

    rng = random.Random(13)
    lines = spark.createDataFrame([(k, sentence(rng, k)) for k in (1, 3, 20, 200)], "lk long, line string")
    least = {(r.lk, r.band): [r.m0, r.m1, r.m2] for r in module.minima(lines).collect()}
    for r in module.signatures(lines).collect():
        bins = sorted(f >> s & 255 for f in r[1:] for s in range(0, 64, 8))
        want = [((m or 0) >> 20) & 255 for band in range(16) for m in least.get((r.lk, band), [None] * 3)]
        assert bins == sorted(want)
    assert module.bands(lines).count() == len(least)


def test_conditions_of_pairs_are_small_enough_to_be_compiled(spark, monkeypatch, capsys):
    """The JVM interprets methods of more than 8000 bytes, which made looking at a pair several times as slow."""
    from corpusprep.llm import common, line_dedup

    monkeypatch.setattr(common, "stored", lambda df, name: df)
    sketch = (*line_dedup.SKETCH, "n")
    met = line_dedup.alike("a_", "b_")
    rows = spark.range(10).selectExpr("id as node", "id % 2 as key", "id as root", *[f"if(id > 0, id, null) as {c}" for c in sketch])
    columns = lambda x: common._sketched(x, sketch)
    with session_settings(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        common._meet(rows, columns, met).explain("codegen")
    plan = capsys.readouterr().out
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", plan)]
    assert "SortMergeJoin" in plan and sizes and max(sizes) < 8000


@pytest.mark.parametrize("differing", range(0, 9))
def test_bytes_that_differ_are_counted(spark, differing):
    """Any bits of a byte count once, whatever the other bytes are."""
    from corpusprep.llm import line_dedup

    rng = random.Random(differing)
    rows = []
    for _ in range(200):
        a = [rng.randrange(256) for _ in range(48)]
        b = list(a)
        for at in rng.sample(range(48), 6 * differing):
            b[at] ^= 1 << rng.randrange(8) | rng.randrange(256)
        both = [int.from_bytes(bytes(x[8 * k : 8 * k + 8]), "big", signed=True) for x in (a, b) for k in range(6)]
        rows.append((*both, 10, 10, sum(x == y for x, y in zip(a, b)) >= line_dedup.AGREE))
    names = [f"{x}_{c}" for x in "ab" for c in line_dedup.SKETCH]
    pairs = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in names) + ", a_n int, b_n int, want boolean")
    assert pairs.where(f"({line_dedup.alike('a_', 'b_')}) <> want").count() == 0


def test_buckets_of_some_hundred_lines_need_no_tokens(spark, monkeypatch):
    """100 lines around one passage, with a near copy each: all pairs of signatures are looked at, which costs less than their tokens."""
    from corpusprep.llm import common

    used, real = [], common.counted_prefixes
    monkeypatch.setattr(common, "counted_prefixes", lambda tokens, similarity: (used.append(tokens.count()), real(tokens, similarity))[1])
    rng = random.Random(10)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    passage = word(120)
    own = [passage + word(100) + "." for _ in range(100)]
    docs = spark.createDataFrame(list(enumerate(own + [x[:-1] + "!" for x in own])), "doc_id long, text string")
    assert {r.id: r.class_id for r in line_classes(docs).collect()} == {k: k % 100 for k in range(200)}
    assert sum(used) == 0


def test_settings_of_a_step_are_put_back(spark):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.some.key")}
    with pytest.raises(ValueError):
        with session_settings(spark, dict.fromkeys(before, "7") | {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "7"
            raise ValueError
    assert {k: spark.conf.get(k, None) for k in before} == before


def test_blank_lines_are_kept_and_have_no_class(spark):
    docs = spark.createDataFrame([(1, "\n \none\n"), (2, ""), (None, "\none"), (3, None), (2, "")], "doc_id long, text string")
    got = sorted(((r.id or 0, r.line_no, r.class_id, r.class_line, r.kept) for r in line_classes(docs).collect()), key=str)
    blank = [(i, n, None, None, True) for i, n in ((1, 0), (1, 1), (1, 3), (2, 0), (2, 0), (0, 0))]
    assert got == sorted([*blank, (0, 1, None, 1, True), (1, 2, None, 1, False)], key=str)
