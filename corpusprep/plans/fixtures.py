"""Stand-in inputs built from the driver tables (see FIXTURES.md).

Each view exists twice: as a Spark DataFrame built with the library's own
operators, and as DuckDB SQL for the independent oracle.  Both must give the
same rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions import text as tx
from corpusprep.operators import labels as lb
from corpusprep.operators import subword as sw
from corpusprep.operators import tokens as tk
from corpusprep.operators.index import dense_index, key_block, lag_in_order

# The eight weights of the mixing launcher, in launcher order.
LAUNCHER_WEIGHTS = ["0.126", "0.157", "0.167", "0.151", "0.282", "0.102", "0.014", "0.001"]

# Every source of the documents table is registered. The first sixteen share the launcher
# weights, two sources to a weight (42 percent each); the other four share what is left.
SOURCE_NAMES = [f"src{i}" for i in range(20)]
SOURCE_WEIGHTS = {
    n: str(Decimal(LAUNCHER_WEIGHTS[i % 8]) * Decimal("0.42") if i < 16 else Decimal("0.04")) for i, n in enumerate(SOURCE_NAMES)
}
WEIGHT_LIST = [SOURCE_WEIGHTS[n] for n in SOURCE_NAMES]

#: Of 256 hash values of a word, those below are in the test vocabulary; the others show unknown words.
KNOWN_WORDS = 250


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def v_samples(spark: SparkSession, sf_dir: str, previous: bool = True, flags: bool = True) -> DataFrame:
    """Samples from documents; without ``previous`` (the text before) or ``flags`` (from labels) it is one plain scan."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "text", "n_chars")
    if previous:
        d = lag_in_order(d, "source", ["doc_id"], "text", "previous_text", block=key_block("doc_id"))
    else:
        d = d.withColumn("previous_text", F.lit(None).cast("string"))
    if flags:
        d = d.join(table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), "doc_id", "left")
    else:
        d = d.withColumns({"quality": F.lit(0), "toxic": F.lit(0)})
    return d.select(
        F.col("doc_id").alias("sample_id"),
        F.col("source").alias("data_source"),
        F.when(F.col("doc_id") % 25 == 0, F.lit("<|nospeech|>")).otherwise(F.col("text")).alias("text"),
        F.concat(F.lit("<|0.00|> "), F.col("text"), F.lit(" <|30.00|>")).alias("text_timestamps"),
        "previous_text",
        (F.coalesce("quality", F.lit(0)) == 1).alias("stage2_whisper_timestamps"),
        (F.coalesce("toxic", F.lit(0)) == 1).alias("is_silence"),
        (F.col("n_chars").cast("double") / 80).alias("duration"),
    )


def v_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return lag_in_order(c, "conv_id", ["turn"], "text", "previous_text", block=key_block("turn"))


def v_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusprep.sources.files import tag_sources

    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    tagged = tag_sources(d, "source", SOURCE_NAMES)
    return dense_index(tagged, ["doc_id"], "source_id", name="k", groups_bound=len(SOURCE_NAMES), block=key_block("doc_id")).select(
        "doc_id", "source_id", "k"
    )


def v_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", tx.words(F.lower("text")).alias("w"))


def v_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the conversations by falling frequency, but for a gap chosen by hash; written once."""
    from corpusprep.session import scratch_path

    counts = v_words(spark, sf_dir).select(F.explode("w").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    known = counts.filter(F.conv(F.substring(F.md5("token"), 1, 2), 16, 10).cast("int") < KNOWN_WORDS)
    ranked = dense_index(known.withColumn("less", -F.col("n")), ["less", "token"], name="rank")
    path = scratch_path(spark, "vocab")
    ranked.select("token", (F.col("rank") + tk.FIRST_WORD_ID).cast("int").alias("id")).write.parquet(path)
    return spark.read.parquet(path)


#: Rank file of the byte-level vocabulary of the subword queries, and the ids after its own that are reserved.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SUBWORD_RESERVED = tk.Reserved(
    eot=50256, pad=50257, unk=50258, sot=50259, sop=50260, no_timestamps=50261, no_speech=50262, languages={"default": 50263}, tasks={"default": 50264}
)


def ranks(spark: SparkSession):
    """The byte-level vocabulary, checked and shared with the tasks."""
    return sw.share(sw.read_ranks(spark, f"file://{RANKS}"))


TURN_KEYS = ["conv_id", "turn"]


def stamped(text) -> Column:
    """The time-stamped transcript of a turn: the text between a first and a last stamp."""
    return F.concat(F.lit("<|0.00|> "), F.col(text), F.lit(" <|30.00|>"))


def v_encoded(spark: SparkSession, sf_dir: str, previous: bool = True, stamps: bool = False) -> DataFrame:
    """Turns with the ids of their text and, as asked for, of the text before and of the stamped text: one pass for all."""
    shared, marks = ranks(spark), SUBWORD_RESERVED.markers()
    if previous:
        t = v_turns(spark, sf_dir).withColumn("previous_text", tx.rename_marker(tx.null_to_empty("previous_text")))
    else:
        t = table(spark, sf_dir, "conversations")
    texts = {"ids": "text"} | ({"prev_ids": "previous_text"} if previous else {}) | ({"stamped_ids": stamped("text")} if stamps else {})
    ids = sw.encode_all(list(texts.values()), shared, marks)
    return t.select(*TURN_KEYS, "role", *[c.alias(n) for c, n in zip(ids, texts)])


def v_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label rows: prompt of the text before (but for first turns) + the text's ids; one row in 17 has no end marker."""
    e = v_encoded(spark, sf_dir)
    body = tk.with_specials("ids", reserved=SUBWORD_RESERVED)
    body = F.when((F.col("conv_id") * 10 + F.col("turn")) % 17 == 0, F.slice(body, 1, F.size(body) - 1)).otherwise(body)
    ids = F.concat(F.when(F.col("turn") > 0, lb.prompt_ids("prev_ids", reserved=SUBWORD_RESERVED)).otherwise(tk.empty_ids()), body)
    # a conversation has few turns, so conv_id div 8192 bounds every block
    return dense_index(e.select(*TURN_KEYS, ids.alias("ids")), TURN_KEYS, block=key_block("conv_id", 8192)).select("idx", "ids")


def v_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = v_words(spark, sf_dir).select(
        (F.col("conv_id") * 10 + F.col("turn")).alias("pair_id"),
        F.when(F.col("turn") % 2 == 0, "even").otherwise("odd").alias("data_source"),
        F.col("w").alias("r"),
    )
    ref = (
        F.when(F.col("pair_id") % 70 == 0, F.lit(""))
        .when(F.col("pair_id") % 30 == 1, F.concat(F.array_join("r", " "), F.lit(" <|nospeech|>")))
        .otherwise(F.array_join("r", " "))
    )
    kept = F.filter(
        F.transform("r", lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: s["i"] % 7 != 3
    )
    hyp = F.when(F.col("pair_id") % 50 == 0, F.lit("")).otherwise(
        F.array_join(F.transform(kept, lambda s: F.when(s["i"] % 5 == 2, F.reverse(s["x"])).otherwise(s["x"])), " ")
    )
    return w.select("pair_id", "data_source", ref.alias("ref"), hyp.alias("hyp"))


# --- DuckDB twins -------------------------------------------------------------

SQL = {
    "v_ranks": sw.sql_ranks(RANKS),
    # every word of every turn, in order, as the byte-level vocabulary splits it
    "v_pieces": f"""SELECT conv_id, turn, unnest(ws) AS word, CAST(generate_subscripts(ws, 1) - 1 AS BIGINT) AS pos
FROM (SELECT conv_id, turn, {sw.sql_split("coalesce(text, '')")} AS ws FROM conversations) x""",
    "v_samples": """SELECT d.doc_id AS sample_id, d.source AS data_source,
 CASE WHEN d.doc_id % 25 = 0 THEN '<|nospeech|>' ELSE d.text END AS text,
 concat('<|0.00|> ', d.text, ' <|30.00|>') AS text_timestamps,
 lag(d.text) OVER (PARTITION BY d.source ORDER BY d.doc_id) AS previous_text,
 coalesce(l.quality, 0) = 1 AS stage2_whisper_timestamps, coalesce(l.toxic, 0) = 1 AS is_silence,
 CAST(d.n_chars AS DOUBLE) / 80 AS duration
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "v_turns": """SELECT conv_id, turn, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS previous_text FROM conversations""",
    "v_sources": """SELECT doc_id, CAST(substr(source, 4) AS INT) AS source_id,
 row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS k
FROM documents WHERE source IN (""" + ", ".join(f"'{n}'" for n in SOURCE_NAMES) + """)""",
    "v_words": f"SELECT conv_id, turn, {tx.sql_words('lower(text)')} AS w FROM conversations",
    "v_vocab": f"""SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + {tk.FIRST_WORD_ID - 1} AS INT) AS id
FROM (SELECT token, count(*) AS n FROM (SELECT unnest(w) AS token FROM v_words) t GROUP BY token) q
WHERE CAST(concat('0x', substr(md5(token), 1, 2)) AS INT) < {KNOWN_WORDS}""",
    "v_encoded": f"""WITH RECURSIVE tt AS (SELECT v.conv_id, v.turn, c.role, v.text, {tx.sql_rename_marker("coalesce(v.previous_text, '')")} AS previous_text
  FROM v_turns v JOIN conversations c USING (conv_id, turn)),
{sw.sql_encoded("tt", "conv_id, turn", {"ids": "coalesce(text, '')", "prev_ids": "previous_text", "stamped_ids": "concat('<|0.00|> ', text, ' <|30.00|>')"}, SUBWORD_RESERVED.markers())}
SELECT conv_id, turn, role, ids, prev_ids, stamped_ids FROM en""",
    "v_labels": f"""SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS idx,
 CAST(list_concat(CASE WHEN turn > 0 THEN list_concat([{SUBWORD_RESERVED.sop}], prev_ids[greatest(len(prev_ids) - {tk.MAX_PROMPT_LENGTH - 2}, 1):]) ELSE [] END,
  CASE WHEN (conv_id*10+turn) % 17 = 0 THEN b[1:len(b) - 1] ELSE b END) AS INTEGER[]) AS ids
FROM (SELECT *, {tk.sql_with_specials('ids', reserved=SUBWORD_RESERVED)} AS b FROM v_encoded) x""",
    "v_pairs": """SELECT pair_id, data_source, CASE WHEN pair_id % 70 = 0 THEN '' WHEN pair_id % 30 = 1 THEN concat(array_to_string(r,' '), ' <|nospeech|>') ELSE array_to_string(r,' ') END AS ref,
 CASE WHEN pair_id % 50 = 0 THEN '' ELSE array_to_string(list_transform(list_filter(list_transform(r, lambda x, i: {'x': x, 'i': i-1}), lambda s: s.i % 7 <> 3),
   lambda s: CASE WHEN s.i % 5 = 2 THEN reverse(s.x) ELSE s.x END), ' ') END AS hyp
FROM (SELECT conv_id*10+turn AS pair_id, CASE WHEN turn % 2 = 0 THEN 'even' ELSE 'odd' END AS data_source, w AS r FROM v_words) t""",
}

DEPENDS = {"v_vocab": ["v_words"], "v_encoded": ["v_turns", "v_ranks"], "v_labels": ["v_encoded"], "v_pairs": ["v_words"]}


def with_views(body: str, *views: str) -> str:
    """Prefix ``body`` with the CTEs for ``views`` (dependencies first)."""
    order: list[str] = []

    def add(v):
        for dep in DEPENDS.get(v, []):
            add(dep)
        if v not in order:
            order.append(v)

    for v in views:
        add(v)
    if not order:
        return body
    ctes = ",\n".join(f"{v} AS ({SQL[v]})" for v in order)
    body = body.strip()
    for lead in ("WITH RECURSIVE", "WITH"):
        if body.upper().startswith(lead) and body[len(lead) : len(lead) + 1].isspace():
            return f"{lead} {ctes},\n{body[len(lead) + 1:]}"
    return f"WITH {ctes}\n{body}"
