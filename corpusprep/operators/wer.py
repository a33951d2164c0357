"""Word edit distance and corpus word error rate as native column expressions.

Each word of a pair is replaced by one code point of the supplementary planes; the
built-in ``levenshtein`` on the two strings, which counts code points, is then the
word-level distance. The code point is a hash of the word where the words of the pair have
different hashes, else (long pairs) its number in the pair's sorted dictionary. The
planes hold over a million symbols, more distinct words than a
pair of any length that can be aligned.  The distance is first looked for in a narrow band
around the diagonal, which is then widened fourfold until the distance fits (Ukkonen 1985),
so a pair of n words at distance d takes time n times d.  The corpus rate is
``sum(edits) / sum(reference words)`` — a partial + final aggregate, never the
mean of per-pair rates.
"""

from __future__ import annotations

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions import text as tx
from corpusprep.operators import subword as sw
from corpusprep.operators.tokens import RESERVED, Reserved

# Alphabet rule: symbol n of a pair is the code point FIRST_SYMBOL + n, n below SYMBOLS.
FIRST_SYMBOL, SYMBOLS = 0x10000, 0x100000
#: Distances that are tried one after the other, before the whole table.
BANDS = [16 << (2 * k) for k in range(8)]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _hashed(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(SYMBOLS))


def _symbols(words: Column, number) -> Column:
    """Each word → the symbol of ``number(word)``, through one UTF-32 decoding."""
    points = F.transform(words, lambda w: F.lpad(F.hex(F.lit(FIRST_SYMBOL) + number(w)), 8, "0"))
    return F.decode(F.unhex(F.array_join(points, "")), "UTF-32")


def symbol_strings(ref_words, hyp_words, vocab) -> tuple[Column, Column]:
    """Both sides as strings of one symbol a word; ``vocab`` is the sorted column of both sides' distinct words.

    ``vocab`` must be a column of its own: written inline it would be computed again for every word.
    """
    v = _c(vocab)
    apart = F.size(F.array_distinct(F.transform(v, _hashed))) == F.size(v)
    place = lambda w: F.array_position(v, w)
    r, h = (F.when(apart, _symbols(_c(x), _hashed)).otherwise(_symbols(_c(x), place)) for x in (ref_words, hyp_words))
    return r, h


def banded_distance(a, b) -> Column:
    """Levenshtein distance of two strings by bands that widen until it fits."""
    a, b = _c(a), _c(b)
    tries = [F.nullif(F.levenshtein(a, b, band), F.lit(-1)) for band in BANDS]
    return F.coalesce(*tries, F.levenshtein(a, b)).cast("bigint")


def pair_edits(df: DataFrame, ref: str = "ref", hyp: str = "hyp") -> DataFrame:
    """Add ``ref_words``, ``hyp_words`` counts and ``edits`` per pair."""
    words = df.withColumns({"_rw": tx.words(ref), "_hw": tx.words(hyp)})
    words = words.withColumn("_v", F.array_sort(F.array_distinct(F.concat("_rw", "_hw"))))
    r, h = symbol_strings("_rw", "_hw", "_v")
    return words.withColumns({"_r": r, "_h": h}).select(
        *df.columns,
        F.size("_rw").cast("bigint").alias("ref_words"),
        F.size("_hw").cast("bigint").alias("hyp_words"),
        banded_distance("_r", "_h").alias("edits"),
    )


def corpus_wer(edited: DataFrame, by=None, scale: float = 100.0) -> DataFrame:
    """Σ edits / Σ reference words (× scale) over pairs with a non-empty reference; ``n_dropped`` counts the others."""
    scored = F.col("ref_words") > 0
    agg = [
        F.count_if(scored).alias("n_pairs"),
        F.count_if(~scored).alias("n_dropped"),
        F.sum(F.when(scored, F.col("edits"))).cast("bigint").alias("errors"),
        F.sum(F.when(scored, F.col("ref_words"))).cast("bigint").alias("ref_words"),
    ]
    g = edited.groupBy(by).agg(*agg) if by else edited.agg(*agg)
    return g.withColumn("wer", F.lit(float(scale)) * F.col("errors").cast("double") / F.col("ref_words").cast("double"))


MARKER = " " + tx.NOSPEECH


def without_marker(df: DataFrame, ref: str = "ref", marker: str = MARKER) -> DataFrame:
    """Pairs whose reference does not hold the silence marker."""
    return df.filter(~F.col(ref).contains(marker))


def filter_pairs(df: DataFrame, ref: str = "ref", hyp: str = "hyp", marker: str = MARKER, marker_first: bool = True) -> dict[str, DataFrame]:
    """The evaluation filters in order; returns every stage (for counts).

    Normalise both sides, drop empty predictions, then empty references, then
    references with the silence marker.  ``marker_first`` tests the marker on
    the raw reference (normalisation removes ``<...>`` spans, so testing it
    afterwards, as the reference order does, never drops anything).
    """
    stages = {"input": df}
    x = df.withColumn("_raw", F.col(ref))
    x = x.withColumn(ref, tx.normalise(ref)).withColumn(hyp, tx.normalise(hyp))
    x = x.filter(tx.strip(hyp) != "")
    stages["non_empty_pred"] = x.drop("_raw")
    x = x.filter(tx.strip(ref) != "")
    stages["non_empty_ref"] = x.drop("_raw")
    stages["no_marker"] = without_marker(x, "_raw" if marker_first else ref, marker).drop("_raw")
    return stages


def wer_filtered(df: DataFrame, ref: str = "ref", hyp: str = "hyp", by=None, marker_first: bool = True) -> DataFrame:
    kept = filter_pairs(df, ref, hyp, marker_first=marker_first)["no_marker"]
    return corpus_wer(pair_edits(kept, ref, hyp), by)


def wer_from_ids(df: DataFrame, labels: str, predictions: str, ranks: Broadcast, reserved: Reserved = RESERVED, by=None, marker_first: bool = True) -> DataFrame:
    """Evaluation from ids: decode labels and predictions, normalise, filter and score.

    Ignored positions and reserved ids are left out on both sides; both are decoded in
    one pass through Python. The texts are a column of their own that no filter or
    expression is pushed through, else each of their uses would decode (and make) the ids again.
    """
    keys = [by] if isinstance(by, str) else list(by or [])
    decoded = df.select(*keys, sw.decode_together([predictions, labels], ranks, reserved.ids(), once=True).alias("_texts"))
    texts = decoded.select(*keys, F.get("_texts", F.lit(1)).alias("ref"), F.get("_texts", F.lit(0)).alias("hyp"))
    return wer_filtered(texts, by=by, marker_first=marker_first)
