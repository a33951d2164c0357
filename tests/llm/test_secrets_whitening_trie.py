"""Secret scan, whitening and prefix trie against plain Python, and odd inputs."""

import hashlib
import random
import re
import string
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.llm import prefix_trie as trie
from corpusprep.llm import secret_scan as sec
from corpusprep.llm import whitening as wh
from tests.llm.conftest import odd_texts

# --- secrets ----------------------------------------------------------------------------


def base_of(text):
    """The three base patterns as the contract words them."""
    found = []
    keyed = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found += [(m.start(), 0, m.end()) for m in keyed.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found)]


def random_key(rng, n, letters=string.ascii_letters + string.digits + "+/"):
    return "".join(rng.choice(letters) for _ in range(n))


def secret_texts():
    rng = random.Random(9)
    rows = odd_texts()
    rows += [(600, "Password : 'abc-def' and password=ab token=\"token\" = \"abcdef"), (601, "api_key=KEY12345 APIKEY: x.y=z"), (602, "AKIA" + "A" * 15)]
    rows += [(603, "xAKIA" + "B" * 16 + "AKIAAKIA" + "C" * 20), (604, "é" + "f" * 24 + "\U0001f600 " + "0" * 23 + " secret=Key123"), (605, "deadbeef" * 5000)]
    rows += [(606, "token = " + "00ff" * 16), (607, "password" + " " * 5000 + ":" + " " * 5000 + "abcdef")]
    rows += [(700 + k, "die " + random_key(rng, 40) + " und") for k in range(20)]
    return rows


def test_secret_base_is_brute_force(spark):
    rows = secret_texts()
    got = sec.secret_digest(sec.secret_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))).collect()
    spell = lambda t: base_of(t or "")
    want = sorted((str(i), [sum(s.startswith(k) for s in spell(t)) for k in ("assign", "access", "hex")], hashlib.sha256(",".join(spell(t)).encode()).hexdigest()) for i, t in rows)
    assert sorted((str(r.doc_id), [r.n_assign, r.n_access, r.n_hex], r.base_sha256) for r in got) == want
    for r in got:
        assert [s for s in r.spans.split(",") if s and not s.startswith("token")] == sorted(
            [s for s in r.spans.split(",") if s and not s.startswith("token")], key=lambda s: (int(s.split(":")[1]), sec.KINDS.index(s.split(":")[0]))
        )
    found = {r.doc_id: r.spans for r in got}
    assert sum(found[700 + k] == "token:4:44" for k in range(20)) >= 19


@pytest.mark.parametrize(
    "text",
    [
        "sha256-47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU=",
        "SHA1: 2jmj7l5rSw0yVb/vlWAYkK/YBwk=",
        "D41D8CD98F00B204E9800998ECF8427E",
        "550e8400-e29b-41d4-a716-446655440000",
        "01ARZ3NDEKTSV4RRFFQ69G5FAV",
        "2024-03-01T12-30-59Z0000000"[:20] + " +49-30-1234567-8901234-55",
        "DONAUDAMPFSCHIFFFAHRTSGESELLSCHAFT Kraftfahrzeughaftpflichtversicherung",
        "usr/lib/python3/dist-packages/my_module_name",
        "=" * 400 + "-" * 400 + "/" * 30,
        "",
    ],
)
def test_digests_and_identifiers_are_no_secrets(spark, text):
    (row,) = sec.secret_spans(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [s for s in row.spans if s.kind == "token"] == []


def test_secret_runs_of_any_length_and_inside_base(spark):
    rng = random.Random(2)
    long = random_key(rng, 300_000)
    inside = "secret=" + random_key(rng, 40, string.ascii_letters + string.digits)
    rows = [(1, long), (2, inside), (3, "ä" + random_key(rng, 30)), (4, "x " * 200_000)]
    got = {r.doc_id: r.spans for r in sec.secret_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(s.kind, s.start, s.end) for s in got[1]][0][:1] == ("token",) and got[1][0].end - got[1][0].start == 300_000
    assert got[1][0].chars_per_token < sec.MAX_RATIO
    assert [s.kind for s in got[2]] == ["assign"]  # nothing is added inside a base span
    assert got[3] == [] and got[4] == []  # a run beside a letter is part of a word


def test_secret_odd_tables(spark, odd, none):
    got = sec.secret_digest(sec.secret_spans(odd.withColumn("spans", F.lit("x")))).collect()
    assert len(got) == len(odd_texts())
    assert {(r.n_assign, r.n_access, r.n_hex, r.spans) for r in got if r.doc_id in (200, 201, 202)} == {(0, 0, 0, "")}
    assert sec.secret_spans(none).collect() == []


# --- whitening --------------------------------------------------------------------------

VEC = "vec_id long, embedding array<float>, component string, n string"


def whitened_by_numpy(vectors, k):
    x = np.floor(1024 * np.array(vectors, dtype=np.float32).astype(float)) + 100000
    z = x - x.mean(axis=0)
    values, turn = np.linalg.eigh(z.T @ z / len(x))
    values, turn = values[::-1][:k], turn[:, ::-1][:, :k]
    return z @ turn / np.sqrt(values), values / (z * z).sum() * len(x), [sum((len(x) * int(v) - int(s)) ** 2 for v, s in zip(row, x.sum(axis=0))) for row in x]


@pytest.mark.parametrize("rank", [None, 9])
def test_whitening_is_numpy(spark, rank):
    rng = np.random.default_rng(1)
    scale = 2.0 ** -np.arange(12)
    vectors = (rng.normal(size=(600, 12)) * scale).tolist()
    vectors += [vectors[5]] * 200  # a hot vector
    rows = [(i if i % 50 else None, v, "c", "n") for i, v in enumerate(vectors)]
    got = wh.whiten_embeddings(spark.createDataFrame(rows, VEC).repartition(11), rank=rank)
    got = got.orderBy("deviation", "component").collect()
    want, explained, far = whitened_by_numpy(vectors, 8)
    by_far = {}
    for r in got:
        by_far.setdefault((r.deviation, r.component), []).append(r.whitened)
    mine = np.array([[by_far[d, c + 1][0] for c in range(8)] for d in far])
    signs = np.sign((mine * want).sum(axis=0))
    assert np.abs(mine * signs - want).max() < 1e-8
    assert len(got) == 8 * 800 and {r.n for r in got} == {800}
    assert all(abs(r.explained - explained[r.component - 1]) < 1e-9 for r in got)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10


def test_whitening_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None), (2, []), (3, [1.0, None, 2.0]), (4, [nan, 1.0, 2.0]), (5, [inf, 0.0, 0.0]), (6, [1.0, 2.0])]
    good = [(10, [1.0, 0.0, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [-1.0, 0.5, 0.0]), (None, [0.0, -0.5, 0.0])]
    make = lambda rows: spark.createDataFrame([(i, v, "x", "y") for i, v in rows], VEC)
    got = wh.whiten_embeddings(make(bad + good)).collect()
    assert len(got) == 3 * 4 and {r.vec_id for r in got} == {10, 11, None}
    assert {r.whitened for r in got if r.component == 3} == {None}  # the third dimension never varies
    assert sum(r.explained for r in got if r.vec_id == 11) == pytest.approx(1)
    assert got[0].identity_error < 1e-12
    assert wh.whiten_embeddings(make([])).collect() == []
    assert wh.whiten_embeddings(make(bad[:5])).collect() == []
    one = wh.whiten_embeddings(make([(1, [3.0, 4.0])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained) for r in one] == [(1, 1, 0, None, 0.0), (2, 1, 0, None, 0.0)]
    huge = wh.whiten_embeddings(make([(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 0.0])])).collect()
    assert {r.deviation for r in huge if r.vec_id == 1} == {None} and all(r.n == 3 for r in huge)


def test_rank_one_updates_are_exact():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 40):
        d = np.sort(rng.integers(0, 9, n).astype(float))  # ties
        z = rng.normal(size=n) * (rng.random(n) < 0.8)
        values, turn = wh.update_diagonal(d, z)
        assert np.abs(turn * values @ turn.T - np.diag(d) - np.outer(z, z)).max() < 1e-12 * (1 + d.max() + z @ z)
        assert np.abs(turn.T @ turn - np.eye(n)).max() < 1e-13 and (np.diff(values) >= 0).all()


def test_spectra_combine_to_the_whole(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(400, 10)) * 50) + 1000
    parts = []
    for piece in np.split(x, [30, 31, 200]):
        s = wh.Spectrum.empty(10, 10)
        for v in piece:
            s.add(v, 1)
        parts.append(wh.Spectrum.read(s.row(), 10))
    whole = parts[0]
    for p in parts[1:]:
        whole.combine(p)
    z = x - x.mean(axis=0)
    assert np.allclose(whole.basis * whole.values @ whole.basis.T, z.T @ z, rtol=0, atol=1e-9 * (z * z).sum())
    assert np.allclose(whole.mean, x.mean(axis=0)) and whole.n == 400


# --- prefix trie ------------------------------------------------------------------------

TURNS = T.StructType([T.StructField(n, t) for n, t in (("conv_id", T.LongType()), ("turn", T.LongType()), ("role", T.StringType()), ("text", T.StringType()), ("depth", T.StringType()), ("conv", T.StringType()))])


def trie_by_hand(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            r, t = role or "", text or ""
            own.setdefault(c, []).append(((turn is not None, turn or 0), r, hashlib.md5(f"{len(r)}:{r}{t}".encode()).digest(), t))
    own = {c: [(r, t) for _, r, _, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        built[c] = own.get(base, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    kids = {k: 0 for k in nodes}
    leaves, saved = dict(kids), dict(kids)
    for k, members in nodes.items():
        if k:
            kids[k[:-1]] += 1
    for k, members in nodes.items():
        value = (len(members) - 1) * len(k[-1][1].encode()) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += value
            leaves[k[:d]] += kids[k] == 0
    for k, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if len(built[c]) == len(k)))
        out.append((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), kids[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie_rows(rng):
    shared = [("user", f"text {k}") for k in range(9)]
    rows = []
    for c in range(-12, 260):
        kind = rng.randrange(5)
        if kind == 0:
            turns = shared  # a hot conversation
        elif kind == 1:
            turns = shared[: rng.randrange(9)] + [("user", f"é{rng.randrange(3)}")]
        elif kind == 2:
            turns = [("user", "same first")] + [(rng.choice(["user", None]), rng.choice([None, "", "ü", f"own {c}"])) for _ in range(rng.randrange(12))]
        elif kind == 3:
            turns = [("assistant", f"{c} {k}") for k in range(rng.randrange(1, 4))]  # may be rebuilt without a turn
        else:
            continue
        rows += [(c, k if k else None, r, t) for k, (r, t) in enumerate(turns)]
    rows += rows[:20]  # repeated rows
    rows += [(7, 3, "user", "tie a"), (7, 3, "user", "tie b"), (7, 3, "agent", "tie a"), (None, 1, "user", "no id"), (None, None, None, None)]
    rows += [(c, k, "user", f"long {min(k, 900 + c)}") for c in (2000, 2005) for k in range(1100)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("bits", [22, 5])
def test_trie_is_brute_force(spark, bits, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 256)  # the long conversations take several blocks
    monkeypatch.setattr(trie, "IDS", 4)
    rows = trie_rows(random.Random(5))
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS).repartition(6)
    got = trie.prefix_trie(table, sketch_bits=bits).collect()
    assert sorted((tuple(r) for r in got), key=str) == trie_by_hand(rows)


def test_trie_of_nothing(spark):
    assert trie.prefix_trie(spark.createDataFrame([], TURNS)).collect() == []
    got = trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x", "", "")], TURNS)).collect()
    assert got == []


def test_a_sketch_estimate_of_one_is_right(spark):
    rng = np.random.default_rng(6)
    keys = rng.integers(-(2**62), 2**62, size=(500, 2))
    rows = np.vstack([keys, keys[:100]]).tolist()
    table = spark.createDataFrame(rows, "p1 long, p2 long").repartition(7)
    for bits in (3, 12, 20):
        twice = trie.sketch(table, bits)
        hit = np.ones(500, dtype=bool)
        for row, at in zip(twice, trie.cells(keys[:, 0], keys[:, 1], bits)):
            hit &= np.unpackbits(row)[at] == 1
        assert hit[:100].all()
        assert bits < 20 or not hit[100:].any()
