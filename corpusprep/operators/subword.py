"""Lossless subword ids: a byte alphabet and ranked merges, so no text has an unknown piece.

A vocabulary is a table (token binary, id int) that holds all 256 bytes; the id is also
the rank of the merge that makes the token. A text is split by a pattern that leaves
nothing out; in each word the neighbours whose join has the least rank are merged, the
leftmost first, until no two neighbours join to a token. With dropout (BPE-dropout,
Provilkov et al. 2020) every candidate is passed over with the given probability at every
step, and a word is done when all are. Whether one is passed over is an md5 draw of (seed, epoch, row keys, number of
the word, step, byte offset in the word), so neither partitioning nor the order in which
candidates are looked at matters.

Encoding and decoding need no shuffle: the vocabulary is broadcast, behind a check of its
size in bytes, and texts pass through Arrow batches. Words are merged with a queue over
a linked list of pieces, n log n in the length of a word; without dropout a task remembers
the ids of words it has seen.
"""

from __future__ import annotations

import hashlib
import heapq
from typing import Callable, Iterator, Mapping, Sequence, Tuple

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions.draws import threshold
from corpusprep.session import small_batches

# The pattern that splits text before the merges of the public byte-level vocabularies.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Most bytes of a vocabulary (tokens and 16 bytes of each entry) that is sent to the tasks.
MAX_VOCABULARY_BYTES = 64 << 20
#: Words whose ids a task remembers, none longer than so many characters.
REMEMBERED, REMEMBERED_CHARS = 1 << 15, 64
#: Rows whose ids or texts are Python objects at a time.
ROWS_AT_ONCE = 256

_IDS = pa.list_(pa.int32())


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    """(token, id) of a rank file: a token in base64, a blank and its rank on each line."""
    line = F.split("value", " ")
    return spark.read.text(path).where("value <> ''").select(F.unbase64(line[0]).alias("token"), line[1].cast("int").alias("id"))


def share(vocab: DataFrame) -> Broadcast:
    """The vocabulary as a broadcast mapping of token to id, once its size, bytes and ids have been checked."""
    size, distinct, n = vocab.agg(
        F.coalesce(F.sum(F.octet_length("token") + 16), F.lit(0)), F.count_distinct("token", "id"), F.count(F.lit(1))
    ).head()
    if size > MAX_VOCABULARY_BYTES:
        raise ValueError(f"a vocabulary of {size} bytes is too large to send to every task ({MAX_VOCABULARY_BYTES} at most)")
    table = vocab.select("token", "id").toArrow()
    ranks = dict(zip(table.column("token").to_pylist(), table.column("id").to_pylist()))
    if len(ranks) != n or distinct != n or len(set(ranks.values())) != n:
        raise ValueError("tokens and ids of a vocabulary must be unique")
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"a vocabulary needs every byte; {len(missing)} are missing, the first is {missing[0]}")
    small_batches(vocab.sparkSession)
    return vocab.sparkSession.sparkContext.broadcast(ranks)


def merge_word(word: bytes, ranks: Mapping[bytes, int], passed_over: Callable[[int, int], bool] | None = None) -> list[int]:
    """Ids of the pieces of a word; ``passed_over(step, offset)`` draws whether a candidate is skipped at a step."""
    n = len(word)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # a piece is named by its first byte
    alive = [True] * n
    queue: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        if 0 <= i and after[i] < n:
            end = after[after[i]]
            rank = ranks.get(word[i:end])
            if rank is not None:
                heapq.heappush(queue, (rank, i, end))

    for i in range(n - 1):
        offer(i)
    step = 0
    while queue:
        skipped, found = [], None
        while queue:
            best = heapq.heappop(queue)
            _, i, end = best
            if not alive[i] or after[i] >= n or after[after[i]] != end:
                continue  # one of the two pieces has been merged since
            if passed_over is not None and passed_over(step, i):
                skipped.append(best)
                continue
            found = i
            break
        if found is None:
            break
        gone = after[found]
        alive[gone] = False
        after[found] = after[gone]
        if after[found] < n:
            before[after[found]] = found
        for candidate in skipped:
            heapq.heappush(queue, candidate)
        offer(before[found])
        offer(found)
        step += 1
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : after[i]]])
        i = after[i]
    return out


def _splitter(pattern: str, markers: Mapping[str, int]):
    """``text -> words``: markers first, then the pattern on what lies between them."""
    import regex

    words = regex.compile(pattern).findall
    if not markers:
        return words
    around = regex.compile("(" + "|".join(regex.escape(m) for m in sorted(markers, key=len, reverse=True)) + ")").split
    return lambda text: [w for part in around(text) for w in ([part] if part in markers else words(part))]


def _words(text: str, split) -> list[str]:
    words = split(text)
    if sum(map(len, words)) != len(text):
        raise ValueError("the pattern leaves out some of the text, which could not be decoded again")
    return words


def encode_all(texts: Sequence[Column | str], ranks: Broadcast, markers: Mapping[str, int] | None = None, pattern: str = SPLIT) -> list[Column]:
    """Ids of several text columns of a row, all in one pass through Python; a null text has none.

    ``markers`` are strings that become one reserved id each. Without them every text, also
    one that spells a marker, decodes to itself.
    """
    own = dict(markers or {})

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        split, known = _splitter(pattern, own), {}

        def ids_of(text: str) -> list[int]:
            ids: list[int] = []
            for w in _words(text, split):
                if w in own:
                    ids.append(own[w])
                    continue
                pieces = known.get(w)
                if pieces is None:
                    pieces = merge_word(w.encode(), ranks.value)
                    if len(w) <= REMEMBERED_CHARS:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        known[w] = pieces
                ids += pieces
            return ids

        for rows in _some_rows(batches):
            yield pa.array([[ids_of(t or "") for t in row] for row in rows.to_pylist()], pa.list_(_IDS))

    together = _iterator_udf(run, "array<array<int>>")(F.array(*[_column(t) for t in texts]))
    return [F.get(together, k) for k in range(len(texts))]


def encode(text: Column | str, ranks: Broadcast, markers: Mapping[str, int] | None = None, pattern: str = SPLIT) -> Column:
    """Ids of one text column, as :func:`encode_all`."""
    return encode_all([text], ranks, markers, pattern)[0]


def _some_rows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for at in range(0, len(batch), ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _iterator_udf(run, returns: str = "array<int>", columns: int = 1):
    given = pa.Array if columns == 1 else Tuple[(pa.Array,) * columns]
    run.__annotations__ = {"batches": Iterator[given], "return": Iterator[pa.Array]}  # read by Spark
    return F.arrow_udf(run, returns)


def encode_dropout(
    text: Column | str, keys: Sequence[Column | str], ranks: Broadcast, rate: float, seed: int = 42, epoch: int = 0, pattern: str = SPLIT
) -> Column:
    """Ids of a text column with merge dropout; ``keys`` name the row in the draws."""
    cut, start = threshold(rate), f"{seed}:dropout:{epoch}:"

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        split = _splitter(pattern, {})
        for texts, names in batches:
            rows = []
            for t, name in zip(texts.to_pylist(), names.to_pylist()):
                ids: list[int] = []
                for pos, w in enumerate(_words(t or "", split)):
                    key = f"{start}{name}:{pos}:"

                    def passed_over(step: int, offset: int, key=key) -> bool:
                        return int(hashlib.md5(f"{key}{step}:{offset}".encode(), usedforsecurity=False).hexdigest()[:8], 16) < cut

                    ids += merge_word(w.encode(), ranks.value, passed_over if rate > 0 else None)
                rows.append(ids)
            yield pa.array(rows, _IDS)

    name = F.concat_ws(":", *[_column(k).cast("string") for k in keys])
    return _iterator_udf(run, columns=2)(_column(text), name)


def decode_together(ids: Sequence[Column | str], ranks: Broadcast, reserved: Sequence[int] = (), once: bool = False) -> Column:
    """An array of the texts of several id columns of a row: reserved and negative ids are left out, bytes
    joined, then read as UTF-8.

    A character that lost bytes (ids cut at a length) becomes U+FFFD; any other id that
    is no token is an error. Null ids have no text. With ``once`` the array is computed where it is
    selected and nowhere else, whatever is done with it later.
    """
    skip = frozenset(reserved)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = {i: t for t, i in ranks.value.items()}

        def text_of(row) -> str:
            return b"".join(tokens[i] for i in row or () if i >= 0 and i not in skip).decode("utf-8", "replace")

        for rows in _some_rows(batches):
            yield pa.array([[text_of(ids) for ids in row] for row in rows.to_pylist()], pa.list_(pa.string()))

    udf = _iterator_udf(run, "array<string>")
    return (udf.asNondeterministic() if once else udf)(F.array(*[_column(c) for c in ids]))


def decode_all(ids: Sequence[Column | str], ranks: Broadcast, reserved: Sequence[int] = ()) -> list[Column]:
    """The texts of several id columns of a row, in one pass, as :func:`decode_together`."""
    together = decode_together(ids, ranks, reserved)
    return [F.get(together, k) for k in range(len(ids))]


def decode(ids: Column | str, ranks: Broadcast, reserved: Sequence[int] = ()) -> Column:
    """The text of one id column, as :func:`decode_all`."""
    return decode_all([ids], ranks, reserved)[0]


# --- SQL twins (DuckDB) ----------------------------------------------------------------

#: Characters that ``\s`` stands for, as RE2 has them (its own ``\s`` has ASCII only).
SQL_BLANK = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: Marks the place before a blank that belongs to the next word; must not occur in the texts.
SQL_MARK = r"\x{10ffff}"


def sql_split(text: str, markers: Sequence[str] = ()) -> str:
    """Words of ``text``; in place of the look-ahead, the last of several blanks before a word is marked off, as are markers."""
    b, m, mark = SQL_BLANK, SQL_MARK, "chr(1114111)"
    named = "".join(x.replace("|", r"\|") + "|" for x in sorted(markers, key=len, reverse=True))
    pattern = rf"{named}''s|''t|''re|''ve|''m|''ll|''d| ?\p{{L}}+| ?\p{{N}}+| ?[^{b}\p{{L}}\p{{N}}{m}]+|[{b}]+"
    if markers:
        text = rf"regexp_replace({text}, '({named[:-1]})', concat({mark}, '\1', {mark}), 'g')"
    return rf"regexp_extract_all(regexp_replace({text}, '([{b}])([{b}][^{b}{m}])', concat('\1', {mark}, '\2'), 'g'), '{pattern}')"


def sql_ranks(path: str) -> str:
    columns = "columns = {'t': 'VARCHAR', 'id': 'INTEGER'}"
    return f"SELECT hex(from_base64(t)) AS h, id FROM read_csv('{path}', delim = ' ', header = false, quote = '', escape = '', {columns})"


def sql_merge(words: str, keys: str, passed_over: str = "false", cte: str = "mg") -> str:
    """CTEs ending in ``{cte}`` (keys, ids): every word (``keys``, ``word``) of ``words`` merged step by step.

    ``passed_over`` may use the keys, ``step`` and ``offset``.
    """
    k = keys
    return f"""{cte}_s AS (SELECT {k}, 0 AS step, regexp_extract_all(hex(encode(word)), '..') AS ps FROM {words}
  UNION ALL SELECT {k}, step + 1, list_concat(list_concat(ps[1:i - 1], [ps[i] || ps[i + 1]]), ps[i + 2:]) FROM (
    SELECT {k}, step, any_value(ps) AS ps, arg_min(i, (id, i)) AS i FROM (
      SELECT {k}, step, ps, i, CAST(len(array_to_string(ps[1:i - 1], '')) // 2 AS BIGINT) AS "offset" FROM (SELECT {k}, step, ps, unnest(range(1, len(ps))) AS i FROM {cte}_s) x) y
    JOIN v_ranks ON v_ranks.h = ps[i] || ps[i + 1] WHERE NOT ({passed_over}) GROUP BY {k}, step) z),
{cte}_l AS (SELECT {k}, arg_max(ps, step) AS ps FROM {cte}_s GROUP BY {k}),
{cte} AS (SELECT {k}, list(v_ranks.id ORDER BY j) AS ids FROM (SELECT {k}, unnest(ps) AS h, generate_subscripts(ps, 1) AS j FROM {cte}_l) x JOIN v_ranks USING (h) GROUP BY {k})"""


def sql_encoded(src: str, keys: str, texts: Mapping[str, str], markers: Mapping[str, int], cte: str = "en") -> str:
    """CTEs ending in ``{cte}``: the columns of ``src`` and, for each name of ``texts``, the ids of that expression."""
    each = " UNION ALL ".join(f"SELECT {keys}, '{n}' AS kind, {t} AS t FROM {src}" for n, t in texts.items())
    named = " UNION ALL ".join(f"SELECT '{m}', CAST([{i}] AS INTEGER[])" for m, i in markers.items())
    empty = "CAST([] AS INTEGER[])"
    picked = ", ".join(f"coalesce(any_value(ids) FILTER (kind = '{n}'), {empty}) AS {n}" for n in texts)
    return f"""{cte}_p AS (SELECT {keys}, kind, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM (SELECT {keys}, kind, {sql_split('t', list(markers))} AS ws FROM ({each}) x) y),
{cte}_w AS MATERIALIZED (SELECT DISTINCT word FROM {cte}_p),
{sql_merge(f"{cte}_w", "word", cte=f"{cte}_m")},
{cte}_k(word, ids) AS ({named}),
{cte}_i AS (SELECT word, coalesce({cte}_k.ids, {cte}_m.ids) AS ids FROM {cte}_m LEFT JOIN {cte}_k USING (word)),
{cte}_g AS (SELECT {keys}, kind, flatten(list(ids ORDER BY pos)) AS ids FROM {cte}_p JOIN {cte}_i USING (word) GROUP BY {keys}, kind),
{cte}_t AS (SELECT {keys}, {picked} FROM {cte}_g GROUP BY {keys}),
{cte} AS (SELECT {src}.*, {', '.join(f'coalesce({n}, {empty}) AS {n}' for n in texts)} FROM {src} LEFT JOIN {cte}_t USING ({keys}))"""
