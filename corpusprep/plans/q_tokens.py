"""Token and label queries over the turn fixture and the test vocabulary."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.functions.draws import sql_draw, threshold
from corpusprep.operators import labels as lb
from corpusprep.operators import subword as sw
from corpusprep.operators import tokens as tk
from corpusprep.plans import fixtures as fx
from corpusprep.plans.catalog import query

SEED = 42
EPOCH = 0
KEYS = ["conv_id", "turn"]
ELIGIBLE = "role = 'assistant'"  # rows whose timestamp target exists


BYTES = fx.SUBWORD_RESERVED
V = ("v_encoded",)


# --- words against a table ---------------------------------------------------------------

SQL_WORDS = "tt AS (SELECT conv_id, turn, text FROM conversations),\n" + tk.sql_encode("tt", KEYS, "text", "ids", "e1")


def words_encoded(spark, sf_dir, vocab):
    t = fx.table(spark, sf_dir, "conversations").select(*KEYS, "text")
    return tk.encode(t, KEYS, "text", vocab, "ids", vocab_bound=tk.vocab_bytes(vocab))


@query("encode_words", f"WITH {SQL_WORDS}\nSELECT conv_id, turn, {tk.sql_with_specials('ids')} AS labels FROM e1", ("v_vocab",))
def q_encode_words(spark, sf_dir):
    """Whole words against the word table of the fixtures; unknown words share one id."""
    return words_encoded(spark, sf_dir, fx.v_vocab(spark, sf_dir)).select(*KEYS, tk.with_specials("ids").alias("labels"))


@query(
    "decode_words",
    f"""WITH {SQL_WORDS},
dx AS (SELECT conv_id, turn, unnest(l) AS id, generate_subscripts(l, 1) AS pos
  FROM (SELECT conv_id, turn, list_filter(list_concat({tk.sql_with_specials('ids')}, [-100, -100]), lambda x: x >= {tk.FIRST_WORD_ID}) AS l FROM e1) q),
dg AS (SELECT conv_id, turn, array_to_string(list(v.token ORDER BY pos), ' ') AS decoded FROM dx JOIN v_vocab v USING (id) GROUP BY conv_id, turn)
SELECT conv_id, turn, coalesce(dg.decoded, '') AS decoded FROM e1 LEFT JOIN dg USING (conv_id, turn)""",
    ("v_vocab",),
)
def q_decode_words(spark, sf_dir):
    """Label ids (with specials and -100 padding) back to words."""
    vocab = fx.v_vocab(spark, sf_dir)
    e = words_encoded(spark, sf_dir, vocab).select(*KEYS, F.concat(tk.with_specials("ids"), F.array(F.lit(-100), F.lit(-100))).alias("labels"))
    return tk.decode(e, KEYS, "labels", vocab, vocab_bound=tk.vocab_bytes(vocab)).select(*KEYS, "decoded")


# --- labels ------------------------------------------------------------------------------


@query("prefix_tokens", f"SELECT conv_id, turn, {tk.sql_with_specials('ids', reserved=BYTES)} AS plain, {tk.sql_with_specials('ids', True, reserved=BYTES)} AS stamped FROM v_encoded", V)
def q_prefix(spark, sf_dir):
    e = fx.v_encoded(spark, sf_dir, previous=False)
    return e.select(*KEYS, tk.with_specials("ids", reserved=BYTES).alias("plain"), tk.with_specials("ids", True, reserved=BYTES).alias("stamped"))


def _sql_prompt(ids: str) -> str:
    keep = tk.MAX_PROMPT_LENGTH - 1
    return f"CAST(list_concat([{BYTES.sop}], {ids}[greatest(len({ids}) - {keep - 1}, 1):]) AS INTEGER[])"


@query("prompt_ids", f"SELECT conv_id, turn, {_sql_prompt('prev_ids')} AS prompt FROM v_encoded", V)
def q_prompt(spark, sf_dir):
    return fx.v_encoded(spark, sf_dir).select(*KEYS, lb.prompt_ids("prev_ids", reserved=BYTES).alias("prompt"))


def _sql_target() -> str:
    u = sql_draw(SEED, "timestamp", str(EPOCH), "conv_id", "turn")
    plain, stamped = tk.sql_with_specials("ids", reserved=BYTES), tk.sql_with_specials("stamped_ids", True, reserved=BYTES)
    return f"CASE WHEN {u} < {threshold(lb.TIMESTAMP_PROBABILITY)} AND {ELIGIBLE} THEN {stamped} ELSE {plain} END"


def chosen(spark, sf_dir, previous=False):
    e = fx.v_encoded(spark, sf_dir, previous, stamps=True)
    u = lb.row_draw(SEED, "timestamp", EPOCH, "conv_id", "turn")
    target = lb.choose_target(tk.with_specials("ids", reserved=BYTES), tk.with_specials("stamped_ids", True, reserved=BYTES), F.expr(ELIGIBLE), u)
    return e.withColumn("target", target)


@query("choose_target", f"SELECT conv_id, turn, {_sql_target()} AS target FROM v_encoded", V)
def q_choose(spark, sf_dir):
    return chosen(spark, sf_dir).select(*KEYS, "target")


def _sql_attach() -> str:
    u = sql_draw(SEED, "prompt", str(EPOCH), "conv_id", "turn")
    return f"""WITH pt AS (SELECT conv_id, turn, {_sql_target()} AS target, {_sql_prompt('prev_ids')} AS prompt, {u} AS u FROM v_encoded)
SELECT conv_id, turn, CAST(CASE WHEN len(prompt) + len(target) <= {tk.MAX_LENGTH} AND u < {threshold(lb.PROMPT_PROBABILITY)}
  AND len(prompt) > 1 AND NOT coalesce(prompt[2] = {BYTES.no_speech}, false) THEN list_concat(prompt, target) ELSE target END AS INTEGER[]) AS labels
FROM pt"""


@query("attach_prompt", _sql_attach(), V)
def q_attach(spark, sf_dir):
    c = chosen(spark, sf_dir, previous=True)
    u = lb.row_draw(SEED, "prompt", EPOCH, "conv_id", "turn")
    prompt = lb.prompt_ids("prev_ids", reserved=BYTES)
    return c.select(*KEYS, lb.attach_prompt(prompt, "target", u, reserved=BYTES).alias("labels"))


# --- subwords ----------------------------------------------------------------------------

DROPOUT_RATE = 0.2  # fixed value: merge dropout of the launchers

def _sql_subwords(words: str, keys: str, passed_over: str = "false") -> str:
    """CTE ``ids`` (conv_id, turn, ids): the pieces of ``words`` (keys, word) laid along every turn."""
    return f"""WITH RECURSIVE wd AS MATERIALIZED ({words}),
{sw.sql_merge("wd", keys, passed_over)},
ids AS (SELECT c.conv_id, c.turn, coalesce(g.ids, CAST([] AS INTEGER[])) AS ids FROM conversations c LEFT JOIN (
  SELECT conv_id, turn, flatten(list(mg.ids ORDER BY pos)) AS ids FROM v_pieces JOIN mg USING ({keys}) GROUP BY conv_id, turn) g USING (conv_id, turn))"""


def _texts(spark, sf_dir):
    return fx.table(spark, sf_dir, "conversations").select(*KEYS, "text")


@query(
    "encode_text",
    _sql_subwords("SELECT DISTINCT word FROM v_pieces", "word") + f"\nSELECT conv_id, turn, {tk.sql_with_specials('ids', reserved=BYTES)} AS labels FROM ids",
    ("v_ranks", "v_pieces"),
)
def q_encode(spark, sf_dir):
    """Subword ids of every turn, between the ids that frame a target."""
    ids = sw.encode("text", fx.ranks(spark))
    return _texts(spark, sf_dir).select(*KEYS, tk.with_specials(ids, reserved=BYTES).alias("labels"))


@query("decode_ids", "SELECT conv_id, turn, text AS decoded, true AS same FROM conversations")
def q_decode(spark, sf_dir):
    """Whole turns encoded, framed and padded, and read back from the ids alone."""
    ranks = fx.ranks(spark)
    framed = tk.with_specials(sw.encode("text", ranks), max_length=None, reserved=BYTES)
    labels = F.concat(framed, F.array(F.lit(tk.IGNORE), F.lit(BYTES.pad), F.lit(tk.IGNORE)))
    back = _texts(spark, sf_dir).select(*KEYS, "text", sw.decode(labels, ranks, BYTES.ids()).alias("decoded"))
    return back.select(*KEYS, "decoded", (F.col("decoded") == F.col("text")).alias("same"))


_SQL_PASSED_OVER = f"""{sql_draw(SEED, "dropout", str(EPOCH), "conv_id", "turn", "pos", "step", '"offset"')} < {threshold(DROPOUT_RATE)}"""


@query(
    "encode_subword_dropout",
    _sql_subwords("SELECT conv_id, turn, pos, word FROM v_pieces", "conv_id, turn, pos", _SQL_PASSED_OVER) + "\nSELECT conv_id, turn, ids FROM ids",
    ("v_ranks", "v_pieces"),
)
def q_dropout(spark, sf_dir):
    """Subword ids of every turn with merge dropout (rate 0.2)."""
    return _texts(spark, sf_dir).select(*KEYS, sw.encode_dropout("text", KEYS, fx.ranks(spark), DROPOUT_RATE, SEED, EPOCH).alias("ids"))
