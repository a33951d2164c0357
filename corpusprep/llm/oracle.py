"""DuckDB SQL for the queries of this subpackage that SQL can express on whole tables."""

from __future__ import annotations

from corpusprep.llm import quality_rules as qr
from corpusprep.llm.chat_format import CONTROL, MARKS, OTHER, TARGET
from corpusprep.llm.prefix_trie import GROUP as TRIE_GROUP
from corpusprep.llm.prefix_trie import HEADS as TRIE_HEADS
from corpusprep.llm.substring_dedup import WINDOW

BLANKS = "[^\\x20\\x09-\\x0D]+"

SUBSTRING = f"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{BLANKS}') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w) x),
rep AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
gone AS (SELECT doc_id, list(DISTINCT j) AS js FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS j FROM win JOIN rep USING (k)) x GROUP BY doc_id),
kept AS (SELECT w.doc_id, len(ws) AS n_words, coalesce(len(js), 0) AS n_removed,
  CASE WHEN js IS NULL THEN ws ELSE list_transform(list_sort(list_filter(range(1, len(ws) + 1), lambda i: NOT list_contains(js, i))), lambda i: ws[i]) END AS ks
  FROM w LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(ks, ' ')) AS kept_sha256 FROM kept"""


def _escaped(text: str) -> str:
    marks = "|".join("".join(f"\\{c}" if c in "[]<>/" else c for c in m) for m in CONTROL)
    return f"regexp_replace({text}, '(\\\\*)({marks})', '\\\\\\1\\2', 'g')"


def _chat() -> str:
    body = _escaped("text")
    own = " ".join(f"WHEN '{role}' THEN {len(a) + len(b) + 2}" for role, (a, b) in MARKS.items())
    other = f"{2 * len(OTHER[0]) + len(OTHER[1]) + 4} + length({_escaped('role')})"
    mark = "</s>[INST] ok [/INST]"
    return f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{mark}' UNION ALL SELECT -7, 1, '{TARGET}', '{mark}'),
s AS (SELECT *, sum(length({body}) + CASE role {own} ELSE {other} END) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS so_far,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS from_end FROM t)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = '{TARGET}'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = '{TARGET}'), '')) AS loss_sha256,
  CAST(sum(CASE WHEN role = '{TARGET}' OR from_end = 1 THEN so_far ELSE 0 END) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id"""


def _quality() -> str:
    chain, rest, names = [], "text", []
    for name, pattern in qr.CLASSES.items():
        p = pattern.replace("'", "''")
        chain.append((name, rest, f"regexp_replace({rest}, '{p}', '', 'g')"))
        rest = f"not_{name}"
        names.append(f"c_{name}")
    steps, source = [], "base"
    for k, (name, before, after) in enumerate(chain):
        steps.append(f"k{k} AS (SELECT *, {after} AS not_{name}, length({before}) - length({after}) AS c_{name} FROM {source})")
        source = f"k{k}"
    names.append("c_sign")
    group = f"CASE WHEN lang IN ({', '.join(repr(x) for x in qr.COMMON)}) THEN lang ELSE 'other' END"
    term = lambda p, q: f"(CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END + CASE WHEN {q} > 0 THEN {q} * log2(2 * {q} / ({p} + {q})) ELSE 0 END)"
    classes = " + ".join(term(f"({n}::DOUBLE / n_chars)", f"(r_{n}::DOUBLE / r_all)") for n in names)
    bins = ", ".join(f"('{lang}', '{w}')" for lang, ws in qr.COMMON.items() for w in ws)
    p, q = "(c::DOUBLE / n_common)", "q"
    return f"""WITH base AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars, regexp_extract_all(coalesce(text, ''), '{BLANKS}') AS ws FROM documents),
{', '.join(steps)},
counted AS (SELECT *, length({rest}) AS c_sign, {group} AS ref, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{BLANKS}')) AS full_lines FROM {source}),
tri AS (SELECT rid, i, ws[i:i + 2] AS k FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM base) x),
twice AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM tri),
covered AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM twice WHERE c > 1) x GROUP BY rid),
refs AS (SELECT ref, sum(n_chars) AS r_all, {', '.join(f'sum({n}) AS r_{n}' for n in names)} FROM counted GROUP BY ref),
hits AS (SELECT rid, lang, word, count(*) AS c FROM (SELECT rid, lang, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS word FROM base) x
  WHERE (lang, word) IN ({bins}) GROUP BY rid, lang, word),
wrefs AS (SELECT lang, word, sum(c)::DOUBLE / sum(sum(c)) OVER (PARTITION BY lang) AS q FROM hits GROUP BY lang, word),
tot AS (SELECT rid, sum(c) AS n_common FROM hits GROUP BY rid),
wd AS (SELECT rid, any_value(n_common) AS n_common, round(sqrt(greatest(0, (sum({term(p, q)}) + 1 - sum(q)) / 2)), 6) AS word_distance
  FROM hits JOIN wrefs USING (lang, word) JOIN tot USING (rid) GROUP BY rid),
d AS (SELECT counted.doc_id, n_chars, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
  CAST(n_chars - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(full_lines) - len(list_distinct(full_lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
  CASE WHEN n_chars > 0 THEN round(sqrt(greatest(0, ({classes}) / 2)), 6) END AS class_distance,
  CAST(coalesce(n_common, 0) AS BIGINT) AS n_common, word_distance
  FROM counted JOIN refs USING (ref) LEFT JOIN covered USING (rid) LEFT JOIN wd USING (rid)),
f AS (SELECT *, n_words < {qr.MIN_WORDS} OR 100 * n_repeat_words > {qr.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM d)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance, n_common, word_distance,
  NOT base_failed AND NOT (n_chars >= {qr.MIN_CHARS} AND class_distance > {qr.MAX_CLASS_DISTANCE})
  AND NOT (n_common >= {qr.MIN_COMMON} AND coalesce(word_distance, 0) > {qr.MAX_WORD_DISTANCE}) AS kept FROM f"""


def _trie() -> str:
    """Prefixes as lists of whole turns; crc32 of the decimal id is spelled out bit by bit."""
    bits = "list_reduce(list_prepend(xor(a, b), range(8)), lambda u, i: xor(u >> 1, 3988292384 * (u & 1)))"
    codes = "list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda a, b: {bits}), 4294967295)"
    return f"""WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT c, count(*) AS n FROM t GROUP BY c),
h AS (SELECT l.c, {crc} % {TRIE_HEADS} AS h, l.c - l.c % {TRIE_GROUP} AS base FROM l),
hb AS (SELECT h.*, least(h, coalesce(l.n, 0)) AS taken FROM h LEFT JOIN l ON l.c = h.base),
r AS (SELECT hb.c, t.pos AS d, role, text FROM hb JOIN t ON t.c = hb.base WHERE t.pos <= hb.taken
  UNION ALL SELECT hb.c, t.pos - h + taken, role, text FROM hb JOIN t ON t.c = hb.c WHERE t.pos > h),
size AS (SELECT hb.c, count(r.c) AS n FROM hb LEFT JOIN r ON r.c = hb.c GROUP BY hb.c),
p AS (SELECT c, d, strlen(text) AS bytes, list(concat(length(role), ':', role, text)) OVER (PARTITION BY c ORDER BY d) AS k FROM r
  UNION ALL SELECT c, 0, 0, CAST([] AS VARCHAR[]) FROM hb),
n AS (SELECT d, k, min(c) AS c, count(*) AS n, max(bytes) AS bytes, count(*) FILTER (d = size.n) AS n_ends,
  sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (d = size.n), '')) AS ends FROM p JOIN size USING (c) GROUP BY d, k),
up AS (SELECT a AS d, list_slice(k, 1, a) AS k, sum((n - 1) * bytes) AS saved, count(*) FILTER (n = n_ends) AS leaves FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM n) x GROUP BY ALL),
kids AS (SELECT d - 1 AS d, list_slice(k, 1, d - 1) AS k, count(*) AS kids FROM n WHERE d > 0 GROUP BY ALL)
SELECT CAST(n.c AS BIGINT) AS conv_id, CAST(n.d AS BIGINT) AS depth, CAST(m.c AS BIGINT) AS parent_conv_id, n.n AS n_convs, CAST(coalesce(kids, 0) AS BIGINT) AS n_children,
  leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM n JOIN up USING (d, k) LEFT JOIN kids USING (d, k) LEFT JOIN n m ON m.d = n.d - 1 AND m.k = list_slice(n.k, 1, n.d - 1)"""


SQL = {"op1_substring_dedup": SUBSTRING, "op7_chat_format": _chat(), "op8_quality_rules": _quality(), "op13_prefix_trie": _trie()}
