"""Secrets in texts: three patterns, and a token-efficiency test for random strings.

A vocabulary learnt from text spells words in few tokens and random strings in many.
Every run of 20 or more characters of the alphabet of keys that mixes character
classes is encoded with a tiktoken vocabulary; at 1.75 characters a token or fewer it
counts as random. Known digests (by their lengths) and identifiers (numbers, UUIDs,
ULIDs, times, words in one case) are excluded first. The patterns are the base: their
spans always stay, and a random run inside one of them adds nothing.
"""

from __future__ import annotations

import base64
import re
from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.words import slices

#: Rank file of the vocabulary; read on the driver and sent to the tasks (835 kB, refused over ``MAX_VOCABULARY``).
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MAX_VOCABULARY = 16 << 20
#: The pattern that splits text before the merges of that vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Characters a token at or under which a run is random.
MAX_RATIO = 1.75
#: Least characters of a run that is tested.
MIN_RUN = 20
#: A run is encoded in pieces of so many characters, since merging takes time in the square of a piece.
PIECE = 256

#: The three base patterns, the group whose length counts, and its least length.
KINDS = ("assign", "access", "hex", "token")
BASE = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
#: Hex characters of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGEST_CHARS = {32, 40, 56, 64, 96, 128}
#: Names before a digest in base64, and its characters there.
DIGEST_NAMES = {"sha1": 28, "sha256": 44, "sha384": 64, "sha512": 88}
IDENTIFIERS = (
    r"[0-9_+/-]+",  # numbers, dates, telephone numbers
    r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",  # UUID
    r"[0-7][0-9A-HJKMNP-TV-Z]{25}",  # ULID
    r"[0-9]{4}-?[0-9]{2}-?[0-9]{2}T[0-9-]+Z?",  # time
)


def _base_pattern(kind: str) -> re.Pattern:
    pattern, group, least = BASE[kind]
    if group == 0:
        # a run that is too short holds no longer one, so the least length can stand in the pattern
        head, _, _ = pattern.rpartition("[")
        pattern = f"{pattern[:-1]}{{{least - len(head)},}}"
    return re.compile(pattern, re.ASCII | (re.IGNORECASE if kind == "assign" else 0))


def _run_pattern(least: int) -> re.Pattern:
    # whole runs only: no letter, digit or sign of the alphabet on either side
    return re.compile(rf"(?<![\w+/-])[A-Za-z0-9+/_-]{{{least},}}+={{0,2}}(?![\w+/=-])")


def base_spans(text: str, patterns: dict[str, re.Pattern]) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, leftmost and non-overlapping for each kind."""
    out = []
    for kind, pattern in patterns.items():
        _, group, least = BASE[kind]
        out += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return out


def is_known(run: str, before: str) -> bool:
    """Whether a run is a digest or an identifier; ``before`` is the text just before it."""
    bare = run.rstrip("=")
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", bare) and len(bare) in DIGEST_CHARS:
        return True
    name = re.search(r"(sha1|sha256|sha384|sha512)[:=-]?\x20?$", before, re.IGNORECASE)
    if name and len(run) == DIGEST_NAMES[name.group(1).lower()]:
        return True
    name = re.match(r"(sha1|sha256|sha384|sha512)-", run, re.IGNORECASE)
    if name and len(run) - name.end() == DIGEST_NAMES[name.group(1).lower()]:
        return True
    if any(re.fullmatch(p, bare) for p in IDENTIFIERS):
        return True
    # every part is a word (one case, or a capital first) or a number: names, paths, compounds
    return all(re.fullmatch(r"[A-Z]?[a-z]*|[A-Z]+|[0-9]*", part) for part in re.split(r"[+/_-]", bare))


def ratio(run: str, encode) -> float:
    """Characters a token of the whole run."""
    return len(run) / sum(len(encode(run[k : k + PIECE])) for k in range(0, len(run), PIECE))


def spans_of(text: str, patterns: dict[str, re.Pattern], runs: re.Pattern, encode, most: float) -> list[tuple[str, int, int, float | None]]:
    """(kind, start, end, ratio) by start, then kind as listed; the ratio is null for the base."""
    base = base_spans(text, patterns)
    out = [(a, KINDS.index(kind), b, None) for a, b, kind in base]
    for m in runs.finditer(text):
        a, b = m.span()
        if any(lo <= a and b <= hi for lo, hi, _ in base) or is_known(m.group(), text[max(0, a - 9) : a]):
            continue
        r = ratio(m.group(), encode)
        if r <= most:
            out.append((a, KINDS.index("token"), b, r))
    return [(KINDS[k], a, b, r) for a, k, b, r in sorted(out, key=lambda x: x[:3])]


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("chars_per_token", pa.float64())]))


def encoder(ranks: bytes):
    """``text -> token ids`` of a tiktoken rank file."""
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
    return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=table, special_tokens={}).encode_ordinary


def _scan(ranks, most: float, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks.value)
        patterns, runs = {k: _base_pattern(k) for k in BASE}, _run_pattern(least)
        for batch in batches:
            texts = batch.column(1)
            for lo, hi in slices(texts.cast(pa.large_string()).to_pandas().str.len().fillna(0).to_numpy()):
                found = [spans_of(t or "", patterns, runs, encode, most) for t in texts.slice(lo, hi - lo).to_pylist()]
                rows = [[dict(zip(("kind", "start", "end", "chars_per_token"), s)) for s in spans] for spans in found]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(rows, _SPAN)], names=["id", "spans"])

    return run


def secret_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, max_ratio: float = MAX_RATIO, min_run: int = MIN_RUN
) -> DataFrame:
    """(id, spans) for every row: ``spans`` has kind, start, end (code points, end exclusive) and characters a token.

    Null and empty texts have no spans; repeated rows each have a row of their own, null
    ids too; texts of any length are scanned whole; spans that start together stand in
    the order of ``KINDS``; an empty table gives an empty result; other columns are
    ignored, whatever their names. ``vocabulary`` is a rank file that the driver reads.
    """
    with open(vocabulary, "rb") as f:
        ranks = f.read(MAX_VOCABULARY + 1)
    if len(ranks) > MAX_VOCABULARY:
        raise ValueError(f"{vocabulary} is larger than {MAX_VOCABULARY} bytes")
    id_type = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    spans = "array<struct<kind:string,start:bigint,end:bigint,chars_per_token:double>>"
    return own.mapInArrow(_scan(shared, max_ratio, min_run), f"id {id_type}, spans {spans}").withColumnRenamed("id", id_col)


def _named(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of each kind, digest of the base spans and all spans as text, from ``secret_spans``."""
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "token")
    return found.select(id_col, count("assign"), count("access"), count("hex"), F.sha2(_named(base), 256).alias("base_sha256"), _named(F.col("spans")).alias("spans"), count("token"))


__all__ = ["BASE", "KINDS", "MAX_RATIO", "MIN_RUN", "VOCABULARY", "secret_digest", "secret_spans"]
