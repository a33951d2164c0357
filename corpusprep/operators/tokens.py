"""Token ids from a vocabulary table, as Spark joins (no tokenizer library).

Encoding partitions the rows by key, explodes each text into (row, position,
word), joins the words to the vocabulary (broadcast where its size is checked,
salted otherwise) and gathers the ids back in position order, where they are.  Decoding is the mirror
image.  Both are exact for whole texts of any length.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions import text as tx

# The test vocabulary's reserved ids, and marker strings of transcripts.
PAD, UNK, SOT, EOT, SOP, LANG, TASK, NOTS, NOSPEECH = 0, 1, 2, 3, 4, 5, 6, 7, 8
FIRST_WORD_ID = 10
IGNORE = -100
MAX_LENGTH = 448
MAX_PROMPT_LENGTH = 192
#: Most bytes of a word table (words and 16 bytes of each row) that is broadcast.
VOCAB_BROADCAST_BYTES = 64 << 20
#: Copies of a vocabulary too large to broadcast: rows of one frequent word are dealt over so many join keys.
VOCAB_SALTS = 32


@dataclass(frozen=True)
class Reserved:
    """Reserved ids of a vocabulary; every id that is not reserved is a word."""

    pad: int = PAD
    unk: int = UNK
    sot: int = SOT
    eot: int = EOT
    sop: int = SOP
    no_timestamps: int = NOTS
    no_speech: int = NOSPEECH
    languages: Mapping[str, int] = field(default_factory=lambda: {"default": LANG})
    tasks: Mapping[str, int] = field(default_factory=lambda: {"default": TASK})

    def ids(self) -> list[int]:
        own = [self.pad, self.unk, self.sot, self.eot, self.sop, self.no_timestamps, self.no_speech]
        return sorted({*own, *self.languages.values(), *self.tasks.values()})

    def markers(self) -> dict[str, int]:
        return {
            "<|startoftranscript|>": self.sot,
            "<|endoftext|>": self.eot,
            "<|startofprev|>": self.sop,
            "<|nospeech|>": self.no_speech,
            "<|nocaptions|>": self.no_speech,
        }


RESERVED = Reserved()
MARKERS = RESERVED.markers()


def empty_ids() -> Column:
    return F.array().cast("array<int>")


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def vocab_bytes(vocab: DataFrame) -> int:
    """Bytes of a (token, id) table: the bound that decides whether it is broadcast."""
    return vocab.agg(F.coalesce(F.sum(F.octet_length("token") + 16), F.lit(0))).head()[0]


def _with_vocab(occurrences: DataFrame, vocab: DataFrame, on: str, how: str, bound: int | None) -> DataFrame:
    """Join word occurrences to the vocabulary on ``on``.

    The vocabulary is broadcast when ``bound`` (its bytes, measured here where the caller has
    not) allows; a larger one is copied ``VOCAB_SALTS`` times and joined on
    (word, salt), so a very frequent word is no single join key.
    """
    size = bound if bound is not None else vocab_bytes(vocab)
    if size <= VOCAB_BROADCAST_BYTES:
        return occurrences.join(F.broadcast(vocab), on, how)
    salted = vocab.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(VOCAB_SALTS - 1))))
    return occurrences.withColumn("_salt", (F.col("_pos") % VOCAB_SALTS).cast("int")).join(salted, [on, "_salt"], how).drop("_salt")


def marker_id(token: Column, reserved: Reserved = RESERVED) -> Column:
    expr = None
    for m, i in reserved.markers().items():
        expr = F.when(token == m, F.lit(i)) if expr is None else expr.when(token == m, F.lit(i))
    return expr


def encode(
    df: DataFrame, keys, text: str, vocab: DataFrame, name: str = "ids", lower: bool = True, vocab_bound: int | None = None, reserved: Reserved = RESERVED
) -> DataFrame:
    """Add ``name``: ids of the words of ``text`` (markers → reserved ids, unknown → UNK).

    ``keys`` must identify a row.  Rows are partitioned by ``keys`` before their
    words are exploded, so gathering the ids again needs no exchange of words.
    No special tokens are added here.
    """
    keys = _keys(keys)
    t = F.lower(F.col(text)) if lower else F.col(text)
    rows = df.select(*keys, t.alias("_t")).repartition(*keys)
    w = rows.select(*keys, F.posexplode(tx.words("_t")).alias("_pos", "token"))
    j = _with_vocab(w, vocab.select("token", "id"), "token", "left", vocab_bound)
    ident = F.coalesce(marker_id(F.col("token"), reserved), F.col("id"), F.lit(reserved.unk)).cast("int")
    g = j.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("_pos"), ident.alias("id")))).alias("_p"))
    ids = g.select(*keys, F.transform("_p", lambda s: s["id"]).alias(name))
    return df.join(ids, keys, "left").withColumn(name, F.coalesce(F.col(name), empty_ids()))


def prefix_ids(timestamps: bool = False, language: str = "default", task: str = "default", reserved: Reserved = RESERVED) -> list[int]:
    return [reserved.sot, reserved.languages[language], reserved.tasks[task]] + ([] if timestamps else [reserved.no_timestamps])


def with_specials(
    ids, timestamps: bool = False, max_length: int | None = MAX_LENGTH, language: str = "default", task: str = "default", reserved: Reserved = RESERVED
) -> Column:
    """Start, language, task, no-timestamps (unless timestamps) + ids + end; head kept on truncation."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    pre = prefix_ids(timestamps, language, task, reserved)
    body = ids if max_length is None else F.slice(ids, 1, max_length - len(pre) - 1)
    return F.concat(F.array(*[F.lit(i) for i in pre]), body, F.array(F.lit(reserved.eot)))


def decode(df: DataFrame, keys, ids: str, vocab: DataFrame, name: str = "decoded", vocab_bound: int | None = None, reserved: Reserved = RESERVED) -> DataFrame:
    """Ids → text: ignore marks and reserved ids dropped, words joined by blanks."""
    keys = _keys(keys)
    special = [IGNORE, *reserved.ids()]
    rows = df.select(*keys, F.col(ids).alias("_ids")).repartition(*keys)
    e = rows.select(*keys, F.posexplode("_ids").alias("_pos", "id")).where(~F.col("id").isin(special))
    j = _with_vocab(e, vocab.select("token", "id"), "id", "inner", vocab_bound)  # ids outside the vocabulary are dropped
    g = j.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_pos", "token"))).alias("_p"))
    txt = g.select(*keys, F.array_join(F.transform("_p", lambda s: s["token"]), " ").alias(name))
    return df.join(txt, keys, "left").withColumn(name, F.coalesce(F.col(name), F.lit("")))


# --- SQL twins (DuckDB) ----------------------------------------------------------------

def sql_encode(src: str, keys: Sequence[str], text: str, name: str = "ids", cte: str = "enc") -> str:
    """CTEs ``{cte}_w``, ``{cte}`` producing (keys, name) for every row of ``src``."""
    k = ", ".join(keys)
    marker = " ".join(f"WHEN token = '{m}' THEN {i}" for m, i in MARKERS.items())
    return f"""{cte}_x AS (SELECT {k}, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM (SELECT {k}, {tx.sql_words(f'lower({text})')} AS w FROM {src}) q),
{cte}_g AS (SELECT {k}, list(CAST(coalesce(CASE {marker} END, v.id, {UNK}) AS INTEGER) ORDER BY pos) AS ids FROM {cte}_x LEFT JOIN v_vocab v USING (token) GROUP BY {k}),
{cte} AS (SELECT {k}, coalesce({cte}_g.ids, CAST([] AS INTEGER[])) AS {name} FROM {src} LEFT JOIN {cte}_g USING ({k}))"""


def sql_with_specials(ids: str, timestamps: bool = False, max_length: int = MAX_LENGTH, reserved: Reserved = RESERVED) -> str:
    pre = prefix_ids(timestamps, reserved=reserved)
    return f"CAST(list_concat(list_concat({pre}, {ids}[1:{max_length - len(pre) - 1}]), [{reserved.eot}]) AS INTEGER[])"
