"""Language, licences, decontamination, quality rules and mixing against plain Python, and odd inputs."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from corpusprep.llm import license_scan as lic
from corpusprep.llm.decontaminate import contaminated_pairs, decontaminate, tiles
from corpusprep.llm.language_id import language_id, predict, shares, train
from corpusprep.llm.mixing import MARGINS, mix_to_targets, rake
from corpusprep.llm.quality_rules import quality_rules
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import odd_texts, sentence


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.doc_id: r for r in language_id(docs).collect()}
    rows = docs.select("doc_id", "lang").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(got) == len(rows) and held
    assert all(got[r.doc_id].held_out == (r in held) for r in rows)
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_id_odd_rows(spark, odd, none):
    got = [(r.doc_id, r.lang_pred) for r in language_id(odd).collect()]
    assert len(got) == len(odd_texts())
    assert {p for i, p in got if i in (200, 201, 202, 502)} == {"und"}
    assert language_id(none).collect() == []
    assert {r.lang_pred for r in language_id(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_license_scan_is_brute_force(spark):
    rng = random.Random(4)
    mit, apache = lic.TEMPLATES["MIT"], lic.TEMPLATES["Apache-2.0-notice"]
    wrapped = mit.replace(". ", ".\n")
    texts = {
        1: mit, 2: sentence(rng, 50) + "\n" + wrapped + "\n" + sentence(rng, 50), 3: sentence(rng, 30) + "\nreleased under the MIT license",
        4: "\n\n".join([apache, mit]), 5: sentence(rng, 200), 6: None, 7: "", 8: mit.replace("Software", "Program"), 9: "Licensed",
    }
    df = spark.createDataFrame(list(texts.items()) + [(3, texts[3])], "doc_id long, text string")
    got = [(r.doc_id, r.license) for r in lic.license_scan(df).collect()]
    sets = {k: lic.bigrams(lic.normal(v).split()) for k, v in lic.TEMPLATES.items()}

    def every_unit(text):
        lines = [x.split() for x in lic.normal(text).split("\n")]
        for name, s in sets.items():
            units = [sum(lines[i : j + 1], []) for i in range(len(lines)) for j in range(i, len(lines))]
            if max((lic.dice(lic.bigrams(u), s) for u in units), default=0) >= lic.DICE:
                yield name

    want = [(i, name) for i, t in [*texts.items(), (3, texts[3])] if t for name in every_unit(t)]
    assert sorted(got) == sorted(want)
    assert {(1, "MIT"), (2, "MIT"), (3, "MIT-line"), (4, "MIT"), (4, "Apache-2.0-notice")} <= set(got)


def test_license_scan_odd_rows(spark, odd, none):
    assert lic.license_scan(odd).collect() == [] and lic.license_scan(none).collect() == []


def test_tiles_are_greedy():
    rng = random.Random(6)
    for _ in range(150):
        a = [rng.randrange(1, 5) for _ in range(rng.randrange(1, 30))]
        b = [rng.randrange(1, 5) for _ in range(rng.randrange(1, 60))]
        got = tiles(a, b, 3)
        used_a = [x for i, _, n in got for x in range(i, i + n)]
        used_b = [x for _, j, n in got for x in range(j, j + n)]
        assert len(set(used_a)) == len(used_a) and len(set(used_b)) == len(used_b)
        assert all(a[i : i + n] == b[j : j + n] and n >= 3 for i, j, n in got)
        assert max((n for *_, n in got), default=0) == max((n for n in range(3, 31) if any(a[i : i + n] == b[j : j + n] for i in range(len(a) - n + 1) for j in range(len(b) - n + 1))), default=0)
        if len(set(a)) == len(a):
            assert sum(n for *_, n in got) == brute.greedy_tiles(a, b, 3)


def test_decontamination_finds_reordered_passages(spark):
    rng = random.Random(8)
    items = [(i, sentence(rng, 40)) for i in range(20)] + [(50, "two words"), (51, ""), (52, None)]
    docs = []
    for i in range(60):
        own = sentence(rng, 150)
        if i % 3 == 0:
            words = items[i % 20][1].split()
            own += " " + " ".join(words[20:] + words[:20]).upper() + ", " + sentence(rng, 20)
        if i % 7 == 0:
            own += " " + " ".join(items[(i + 1) % 20][1].split()[:12])  # under half of an item
        docs.append((i, own))
    docs += [(900, None), (901, ""), (902, "so: Two, WORDS"), (3, docs[3][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.id, r.item_id, r.coverage) for r in contaminated_pairs(d, b).collect())
    want = []
    for i, t in docs:
        for k, item in items:
            a, x = (item or "").split(), (t or "").lower().replace(",", "").replace(":", "").split()
            if a and brute.greedy_tiles(a, x, min(5, len(a))) >= 0.5 * len(a):
                want.append((i, k, 1.0))
    assert got == sorted(want)
    clean = {r.doc_id for r in decontaminate(d, b).collect()}
    assert clean == {i for i, _ in docs} - {i for i, _, _ in want}
    assert contaminated_pairs(d, b.where("item_id > 50")).count() == 0
    assert contaminated_pairs(d.limit(0), b).count() == 0


def test_quality_base_counts_are_brute_force(spark, odd):
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality_rules(odd).collect())
    assert got == sorted((str(i), *brute.base_counts(t)) for i, t in odd_texts())


def test_quality_rules_drop_symbols_and_keep_prose(spark, none):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    # a few documents, so that they are not what their language's reference is made of
    junk = docs.where("n_chars between 600 and 3000 and lang = 'en'").orderBy("doc_id").limit(3)
    junk = junk.select((F.col("doc_id") + 10_000).alias("doc_id"), F.regexp_replace("text", " ", "### ").alias("text"), "lang")
    rows = quality_rules(docs.select("doc_id", "text", "lang").unionByName(junk)).collect()
    assert all(not r.kept for r in rows if r.doc_id >= 10_000)
    assert sum(r.kept for r in rows if r.doc_id < 10_000 and not r.base_failed) >= 0.9 * sum(not r.base_failed for r in rows if r.doc_id < 10_000)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in rows)
    assert quality_rules(none).collect() == []


def test_raking_meets_all_margins(spark):
    rng = random.Random(3)
    cells = {(s, l, t): rng.randrange(1, 500) for s in "abc" for l in "xy" for t in "pq"}
    targets = [{"a": 0.2, "b": 0.3, "c": 0.5}, {"x": 0.6, "y": 0.4}, {"p": 0.1, "q": 0.9}]
    df = spark.createDataFrame([(*c, n) for c, n in cells.items()], "source string, lang string, topic string, tokens long")
    frames = {m: spark.createDataFrame(list(t.items()), f"{m} string, target double") for m, t in zip(MARGINS, targets)}
    got = {(r.source, r.lang, r.topic): r.share for r in rake(df, frames, rounds=30, tolerance=1e-7).collect()}
    want = brute.rake(cells, targets)
    assert got.keys() == want.keys() and all(abs(got[c] - want[c]) < 1e-5 for c in want)


def test_mixing_probabilities(spark, odd, none):
    rows = mix_to_targets(odd).collect()
    assert len(rows) == len(odd_texts()) and all(0 <= r.probability <= 1 for r in rows)
    assert all(r.probability == 0 and not r.kept for r in rows if r.n_tokens == 0)
    twice = [r.kept for r in rows if r.doc_id == 400]
    assert len(set(twice)) == 1
    assert mix_to_targets(none).collect() == []
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = mix_to_targets(docs).collect()
    expected = sum(r.probability * r.n_tokens for r in rows)
    share = {s: sum(r.probability * r.n_tokens for r in rows if r.source == s) / expected for s in {r.source for r in rows}}
    natural = {s: sum(r.n_tokens for r in rows if r.source == s) ** 0.7 for s in share}
    assert all(share[s] == pytest.approx(natural[s] / sum(natural.values()), rel=0.02) for s in share)


def test_a_small_cell_does_not_shrink_the_sample(spark):
    rows = [(i, "word " * 200, ("a", "b", "c")[i % 3], ("en", "de")[i % 2]) for i in range(600)]
    rows.append((999, "rare words here " * 7, "tiny", "xx"))
    got = mix_to_targets(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")).collect()
    total = sum(r.n_tokens for r in got)
    assert sum(r.probability * r.n_tokens for r in got) == pytest.approx(0.6 * total, rel=0.005)
    assert all(0 <= r.probability <= 1 for r in got)
    assert [r.probability for r in got if r.doc_id == 999] == [pytest.approx(1, abs=0.01)]


def test_used_up_cells_leave_the_rest_and_contradictions_are_reported(spark):
    cells = [("a", "en", "x", 1000), ("a", "de", "x", 20), ("b", "en", "x", 100), ("b", "de", "x", 1000)]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")

    def shares(m, values):
        return spark.createDataFrame(list(values.items()), f"{m} string, target double")

    targets = {"source": shares("source", {"a": 0.5, "b": 0.5}), "lang": shares("lang", {"en": 0.55, "de": 0.45}), "topic": shares("topic", {"x": 1.0})}
    report = {}
    got = {(r.source, r.lang): r for r in rake(df, targets, budget=0.8, report=report).collect()}
    assert report["met"] and all(r.share * 0.8 * 2120 <= r.tokens * (1 + 1e-9) for r in got.values())
    as_frames = {(r.source, r.lang): r.share for r in rake(df, targets, rounds=3, budget=0.8, driver_cells=0).collect()}
    on_driver = {(r.source, r.lang): r.share for r in rake(df, targets, rounds=3, budget=0.8).collect()}
    assert as_frames == {c: pytest.approx(v, rel=1e-9) for c, v in on_driver.items()}
    assert got["a", "en"].share + got["a", "de"].share == pytest.approx(0.5, abs=0.002)
    assert got["a", "en"].share + got["b", "en"].share == pytest.approx(0.55, abs=0.002)
    targets["lang"] = shares("lang", {"en": 0.2, "de": 0.8})
    rake(df, targets, budget=0.8, report=report)
    assert not report["met"] and max(report["off"].values()) > 0.1


def test_license_inside_a_longer_line(spark):
    rng = random.Random(6)
    mit, line = lic.TEMPLATES["MIT"], lic.TEMPLATES["CC-BY-4.0-line"]
    edited = mit.replace("sublicense", "lend")
    texts = {
        1: f"{sentence(rng, 300)} {mit} {sentence(rng, 100)}", 2: f"{sentence(rng, 30)} {line} {sentence(rng, 30)}\n{sentence(rng, 9)} {edited[:600]}\n{edited[600:]} {sentence(rng, 90)}",
        3: f"{sentence(rng, 50)} {lic.TEMPLATES['Apache-2.0-notice']} {sentence(rng, 50)}", 4: sentence(rng, 100) + mit[: len(mit) // 2],
    }
    got = {(r.doc_id, r.license): (r.dice, r.first_line, r.last_line) for r in lic.license_scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert set(got) == {(1, "MIT"), (2, "MIT"), (2, "CC-BY-4.0-line"), (3, "Apache-2.0-notice")}
    assert got[1, "MIT"] == (1.0, 0, 0) and got[2, "CC-BY-4.0-line"] == (1.0, 0, 0) and got[2, "MIT"][0] > 0.95 and got[2, "MIT"][1:] == (1, 2)


def test_license_windows_are_the_best_of_all():
    rng = random.Random(8)
    for _ in range(300):
        template = set(zip(*[iter(rng.choices("abcdef", k=12))] * 2))
        words = rng.choices("abcdefgh", k=40)
        pairs = list(zip(words, words[1:]))
        every = max(lic.dice(set(pairs[i : j + 1]), template) for i in range(len(pairs)) for j in range(i, len(pairs)))
        found = max((d for d, _, _ in lic.windows(pairs, template, 0.5)), default=0)
        assert found == pytest.approx(every if every >= 0.5 else 0)


def test_full_license_texts_and_a_template_table(spark):
    full = lic.full_texts()
    assert {"Apache-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "BSD-3-Clause", "CC0-1.0"} <= set(full)
    docs = spark.createDataFrame([(n, t.replace("\n", " ")) for n, t in full.items()], "doc_id string, text string")
    got = {(r.doc_id, r.license) for r in lic.license_scan(docs).collect()}
    assert {(n, n) for n in full} <= got
    table = spark.createDataFrame([("own", "a licence of seven words or more")], "license string, text string")
    only = spark.createDataFrame([(1, "x A licence of seven words, or more. y")], "doc_id long, text string")
    assert [(r.license, r.dice) for r in lic.license_scan(only, templates=table).collect()] == [("own", 1.0)]


def test_small_languages_are_learnt_above_the_bound(spark):
    assert shares([2, 1000, 3, 1000], 105) == [1.0, 0.05, 1.0, 0.05] and shares([5, 5], 20) == [1.0, 1.0]
    rng = random.Random(12)
    first = {"el": 0x3B1, "ru": 0x430, "he": 0x5D0, "ka": 0x10D0, "hi": 0x915}

    def text(lang):
        return " ".join("".join(chr(first.get(lang, 97) + rng.randrange(20)) for _ in range(5)) for _ in range(60))

    rows = [(i, text("en"), "en") for i in range(600)] + [(1000 + 10 * k + j, text(x), x) for k, x in enumerate(first) for j in range(2)]
    model = train(spark.createDataFrame(rows, "key long, text string, lang string"), train_docs=60)
    ask = spark.createDataFrame([(x, text(x)) for x in ("en", *first)], "want string, text string")
    assert all(r.want == r.lang_pred for r in predict(ask, model).collect())


def test_quality_counts_a_repeated_row_once(spark):
    """Equal rows get what one of them gets; rows that differ in language alone are judged apart."""
    text = "the of and " * 20 + "house tree river " * 3
    schema = "doc_id long, text string, lang string"
    other = [(k, "the of to was " * 9 + f"w{k}", "en") for k in range(2, 9)]
    rows = {n: quality_rules(spark.createDataFrame([(1, text, "en")] * n + [(1, text, None), (1, text, "fr")] + other, schema)).where("doc_id = 1").collect() for n in (1, 3)}
    for n, found in rows.items():
        assert sorted(r.n_common for r in found) == [0, 0] + [60] * n
        assert len({tuple(r) for r in found if r.n_common}) == 1
    assert {r.n_words for r in rows[3]} == {69}


def test_mixing_meets_given_weights(spark):
    rng = random.Random(12)
    rows = [(i, sentence(rng, 40), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "d"]), i) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, weight long")
    source = spark.createDataFrame([("a", 6.0), ("b", 1.0), ("c", 0.5), ("c", 1.5), ("nowhere", 9.0)], "source string, weight double")
    lang = spark.createDataFrame([("en", 1), ("de", 1), (None, 2)], "lang string, weight int")
    out = mix_to_targets(docs, budget=0.2, weights={"source": source, "lang": lang}).collect()
    asked = 0.2 * sum(r.n_tokens for r in out)
    share = lambda m, v: sum(r.n_tokens * r.probability for r in out if getattr(r, m) == v) / asked
    for m, v, want in (("source", "a", 6 / 9), ("source", "b", 1 / 9), ("source", "c", 2 / 9), ("source", "d", 0), ("lang", "en", 0.25), ("lang", "none", 0.5)):
        assert abs(share(m, v) - want) < 0.002, (m, v)
    assert not any(r.kept for r in out if r.source == "d")
    kept = sum(r.n_tokens for r in out if r.kept) / asked
    assert 0.9 < kept < 1.1


def _grams(text):
    """Grams of a text in plain Python, as places of the model."""
    mask = 2**64 - 1

    def place(x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask
        return (x ^ (x >> 31)) & (2**14 - 1)

    low, codes = text.lower() + "\n", []
    for i, c in enumerate(low):
        if c.isalpha():
            codes.append(ord(c))
        elif i == 0 or low[i - 1].isalpha():
            codes.append(32)
    two = [a * 0x110000 + b for a, b in zip(codes, codes[1:])]
    three = [(x * 0x110000 + c + 2**63) & mask for x, c in zip(two, codes[2:])]
    return [place(x) for x in two + three]


def test_language_id_is_brute_force(spark, odd):
    """Predicted languages and posteriors against naive Bayes counted in dictionaries."""
    import math
    from collections import Counter

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.unionByName(odd.select((F.col("doc_id") + 100_000).alias("doc_id"), "text", F.when(F.col("rk") % 2 == 0, "en").alias("lang")))
    rows = docs.collect()
    learn = [r for r in rows if (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 4 != 2) and r.lang is not None and r.text is not None]
    langs = sorted({r.lang for r in learn})
    counts, n_docs = {x: Counter() for x in langs}, Counter(r.lang for r in learn)
    for r in learn:
        counts[r.lang].update(_grams(r.text))
    sums = {x: sum(c.values()) for x, c in counts.items()}
    wanted = []
    for r in rows:
        text = r.text or ""
        if not any(c.isalpha() for c in text):
            wanted.append((str(r.doc_id), "und", 0.0))
            continue
        own = Counter(_grams(text))
        logs = [
            math.log((n_docs[x] + 1) / (len(learn) + len(langs))) + sum(n * math.log((counts[x][g] + 0.5) / (sums[x] + 0.5 * 2**14)) for g, n in own.items()) for x in langs
        ]
        best = max(range(len(langs)), key=lambda k: logs[k])
        wanted.append((str(r.doc_id), langs[best], 1 / sum(math.exp(v - logs[best]) for v in logs)))
    got = sorted((str(r.doc_id), r.lang_pred, r.score) for r in language_id(docs).collect())
    wanted.sort()
    assert [g[:2] for g in got] == [w[:2] for w in wanted]
    assert all(abs(g[2] - w[2]) < 1e-6 for g, w in zip(got, wanted))
