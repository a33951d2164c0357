"""Quality rules by distribution divergence, in DataFrame functions only.

A document's histogram of character classes and its histogram of common words are
compared with references of its language by Jensen-Shannon distance (base 2, so 0 to
1). References are sums over all documents of the language. Short documents are
exempt from a histogram they cannot fill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import row_key, stored

WORD = r"[^\x20\x09-\x0D]+"
BARE_WORD = r"\p{L}+"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Characters a text needs before its class histogram is judged, and common words before theirs is.
MIN_CHARS = 200
MIN_COMMON = 30
MAX_CLASS_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.6

#: Frequent function words of the languages judged.
COMMON = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht", "ein", "eine"],
    "en": ["the", "of", "and", "to", "a", "in", "is", "that", "it", "was", "for", "on", "are", "as", "with", "be", "at", "this"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su", "para"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "au", "sur"],
}
CLASSES = {
    "lower": "[a-z]+",
    "blank": "[\\x20\\x09-\\x0D]+",
    "upper": "[A-Z]+",
    "letter": "\\p{L}+",
    "digit": "\\p{N}+",
    "point": "[.,;:!?'\"()\\-]+",
}


def _sql(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    # rows that share a key are equal in everything that is judged, the language too
    key = F.xxhash64(row_key(id_col, text_col), lang, lang.isNull())
    return docs.select(key.alias("rk"), F.col(id_col).alias("id"), lang.alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _repeated_words(d: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words in three-word windows that occur twice or more in ``words``.

    Windows are (hash, place) packed in one number and sorted, so equal windows are
    neighbours; neighbours with one hash are compared word by word. Every array is the
    size of the document's own words.
    """
    d = d.selectExpr("*", "int(ceil(log2(greatest(2, n)))) as bits")
    d = d.selectExpr(
        "*",
        """if(n < 4, cast(array() as array<bigint>), sort_array(transform(sequence(0, n - 3),
           i -> shiftleft(xxhash64(words[i], words[i + 1], words[i + 2]), bits) | i))) as packed""",
    )
    d = d.selectExpr(
        "*",
        """if(n < 4, cast(array() as array<int>), filter(sequence(0, n - 4), i ->
           shiftright(packed[i], bits) = shiftright(packed[i + 1], bits)
           and slice(words, int(packed[i] & (shiftleft(1L, bits) - 1)) + 1, 3) = slice(words, int(packed[i + 1] & (shiftleft(1L, bits) - 1)) + 1, 3))) as same""",
    )
    d = d.selectExpr(
        "*",
        "sort_array(array_distinct(flatten(transform(same, i -> array(packed[i] & (shiftleft(1L, bits) - 1), packed[i + 1] & (shiftleft(1L, bits) - 1)))))) as places",
    )
    return d.selectExpr(
        "*",
        """if(size(places) = 0, 0L, aggregate(places, named_struct('sum', 0L, 'to', -1L),
           (a, p) -> named_struct('sum', a.sum + 3L - greatest(0L, least(3L, a.to - p + 1L)), 'to', p + 2L), a -> a.sum)) as n_repeat_words""",
    )


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rk, id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_chars, one count per character class)."""
    word = _sql(WORD)
    d = _source(docs, id_col, text_col).selectExpr("*", f"regexp_extract_all(text, '{word}', 0) as words", "char_length(text) as n_chars")
    d = d.selectExpr("*", "size(words) as n", f"filter(split(text, '\\n', -1), x -> x rlike '{word}') as full_lines")
    rest = "text"
    for name, pattern in CLASSES.items():
        d = d.selectExpr("*", f"regexp_replace({rest}, '{_sql(pattern)}', '') as not_{name}")
        d = d.selectExpr("*", f"cast(char_length({rest}) - char_length(not_{name}) as bigint) as c_{name}")
        rest = f"not_{name}"
    d = _repeated_words(d)
    return d.selectExpr(
        "rk", "id", "lang", "cast(n as bigint) as n_words",
        "cast(char_length(array_join(words, '')) as bigint) as word_chars",
        "cast(n_chars - char_length(regexp_replace(text, '[#*$%&|<>]+', '')) as bigint) as n_symbols",
        "cast(size(full_lines) - size(array_distinct(full_lines)) as bigint) as n_dup_lines",
        "n_repeat_words", "cast(n_chars as bigint) as n_chars",
        *[f"c_{name}" for name in CLASSES], f"cast(char_length({rest}) as bigint) as c_sign",
    )


def _term(p: Column, q: Column) -> Column:
    """One bin's part of twice the Jensen-Shannon divergence."""
    part = lambda x, y: F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))
    return part(p, q) + part(q, p)


def _class_distance(counts: DataFrame) -> DataFrame:
    names = [f"c_{n}" for n in (*CLASSES, "sign")]
    known = list(COMMON)
    group = F.when(F.col("lang").isin(known), F.col("lang")).otherwise(F.lit("other"))
    d = counts.withColumn("ref", group)
    # at most one row per judged language and one for the others
    refs = d.groupBy("ref").agg(F.sum("n_chars").alias("all"), *[F.sum(n).alias(f"r_{n}") for n in names])
    d = d.join(F.broadcast(refs), "ref")
    total = sum((_term(F.col(n) / F.col("n_chars"), F.col(f"r_{n}") / F.col("all")) for n in names[1:]), _term(F.col(names[0]) / F.col("n_chars"), F.col(f"r_{names[0]}") / F.col("all")))
    return d.withColumn("class_distance", F.when(F.col("n_chars") > 0, F.round(F.sqrt(F.greatest(F.lit(0.0), total / 2)), 6))).drop("all", "ref", *[f"r_{n}" for n in names])


def _word_distance(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rk, n_common, word_distance) of documents with a common word of their language."""
    own = _source(docs, id_col, text_col).where(F.col("lang").isin(list(COMMON)))
    # an empty word for each row counts how many rows share a key
    words = own.selectExpr("rk", "lang", f"explode(concat(array(''), regexp_extract_all(lower(text), '{_sql(BARE_WORD)}', 0))) as word")
    pairs = [f"{lang} {w}" for lang, ws in COMMON.items() for w in ws]
    hits = words.withColumn("bin", F.concat_ws(" ", "lang", "word")).where(F.col("bin").isin(pairs) | (F.col("word") == ""))
    hits = hits.select("rk", "lang", F.when(F.col("word") == "", "").otherwise(F.col("bin")).alias("bin"))
    counted = stored(hits.groupBy("rk", "lang", "bin").agg(F.count("*").alias("c")), "op8-common")
    found, rows = counted.where("bin <> ''"), counted.where("bin = ''").select("rk", F.col("c").alias("rows"))
    # one row per fixed (language, word) pair at most
    refs = found.groupBy("lang", "bin").agg(F.sum("c").alias("r"))
    refs = refs.join(F.broadcast(refs.groupBy("lang").agg(F.sum("r").alias("all"))), "lang").select("bin", (F.col("r") / F.col("all")).alias("q"))
    # references count every row, a document's own histogram one of the rows that are equal to it
    found = found.join(rows, "rk").select("rk", "bin", (F.col("c") / F.col("rows")).cast("long").alias("c"))
    sums = found.groupBy("rk").agg(F.sum("c").alias("n_common"))
    terms = found.join(F.broadcast(refs), "bin").join(sums, "rk")
    out = terms.groupBy("rk").agg(F.first("n_common").alias("n_common"), F.sum(_term(F.col("c") / F.col("n_common"), F.col("q"))).alias("t"), F.sum("q").alias("met"))
    return out.select("rk", "n_common", F.round(F.sqrt(F.greatest(F.lit(0.0), (F.col("t") + 1 - F.col("met")) / 2)), 6).alias("word_distance"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base counts, both distances, ``base_failed`` and ``kept``.

    The base rule fails documents under 50 words, or with over half their words in
    repeated three-word windows. Of the others, one is dropped if its class histogram is
    further than ``MAX_CLASS_DISTANCE`` from its language's (from that of all other
    documents for a null or unlisted language), given ``MIN_CHARS`` characters, or its
    common-word histogram further than ``MAX_WORD_DISTANCE``, given ``MIN_COMMON``
    common words. A null text counts as empty; repeated rows get equal rows; an empty
    table gives no rows; other columns, but for ``lang``, are ignored.
    """
    counts = _class_distance(base_counts(docs, id_col, text_col))
    words = _word_distance(docs, id_col, text_col).withColumnRenamed("rk", "rk2")
    d = counts.join(words, F.col("rk") == F.col("rk2"), "left").withColumn("n_common", F.coalesce("n_common", F.lit(0)).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    odd_classes = (F.col("n_chars") >= MIN_CHARS) & (F.col("class_distance") > MAX_CLASS_DISTANCE)
    odd_words = (F.col("n_common") >= MIN_COMMON) & (F.coalesce("word_distance", F.lit(0.0)) > MAX_WORD_DISTANCE)
    return d.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), "class_distance", "n_common", "word_distance", (~failed & ~odd_classes & ~odd_words).alias("kept"),
    )
