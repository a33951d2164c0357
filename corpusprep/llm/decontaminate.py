"""Benchmark decontamination by greedy string tiling.

Words are lower-cased ``\\w+``. Seeds, runs of ``MIN_TILE`` words that a document shares
with a benchmark item, are joined by hash; a bitmap of the benchmark's seeds, of fixed
size, keeps other words out of the shuffle. A pair whose shared seeds could cover
enough of the item is tiled: the longest matches that do not overlap are marked, again
and again, by running Karp-Rabin search, so reordered passages count in full. The
document is contaminated if the tiles cover ``COVERAGE`` of the item or more.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import row_key, stored, unused
from corpusprep.llm.words import slices, whole_windows, window_hashes, words_of

MIN_TILE = 5
COVERAGE = 0.5
#: Bits of the seed bitmap, as a power of two (8 MB). More seeds only mean more rows that the join drops.
BITMAP_BITS = 26

_MARKS = re.compile(r"[^\w]+")
_BASE = 1_000_003
_MOD = (1 << 61) - 1


def plain(text: str | None) -> str:
    """Words ``\\w+`` of a text in lower case, one space between them."""
    return _MARKS.sub(" ", text.lower()) if text else ""


def seeds_of(texts: list[str], lengths: list[int]):
    """(words, hashes, {length: (seed hashes, which lie in one text)})."""
    w = words_of(texts)
    hashes = w.hashes()
    return w, hashes, {k: (window_hashes(hashes, k), whole_windows(w.bounds, k)) for k in lengths}


def tiles(item: list[int], text: list[int], shortest: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (item start, text start, length) of ``shortest`` words or more, by running Karp-Rabin."""
    used_a, used_b = [False] * len(item), [False] * len(text)
    out: list[tuple[int, int, int]] = []

    def runs(seq, used, s):
        """(start, rolling hash) of each unmarked run of s words."""
        top = pow(_BASE, s - 1, _MOD)
        h, free = 0, 0
        for i, x in enumerate(seq):
            if used[i]:
                h = free = 0
                continue
            if free >= s:
                h -= seq[i - s] * top
            h = (h * _BASE + x) % _MOD
            free += 1
            if free >= s:
                yield i - s + 1, h

    s = max(shortest, min(len(item), 20))
    while True:
        where: dict[int, list[int]] = {}
        for i, h in runs(item, used_a, s):
            where.setdefault(h, []).append(i)
        found, longest = [], 0
        for j, h in runs(text, used_b, s):
            for i in where.get(h, ()):
                if i and j and not used_a[i - 1] and not used_b[j - 1] and item[i - 1] == text[j - 1]:
                    continue  # inside a longer match that begins earlier
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] and not used_a[i + n] and not used_b[j + n]:
                    n += 1
                if n >= s:
                    found.append((n, i, j))
                    longest = max(longest, n)
        if longest > 2 * s:
            s = longest
            continue
        marked = False
        for n, i, j in sorted(found, key=lambda f: (-f[0], f[1], f[2])):
            if any(used_a[i : i + n]) or any(used_b[j : j + n]):
                continue
            used_a[i : i + n] = used_b[j : j + n] = [True] * n
            out.append((i, j, n))
            marked = True
        if marked:
            continue  # what is left of matches cut by a longer one
        if s == shortest:
            return out
        s = max(shortest, s // 2)


def _item_seeds(lengths_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            texts = [plain(t) for t in batch.column(1).to_pylist()]
            w = words_of(texts)
            hashes = w.hashes()
            take, seeds, tokens, sizes = [], [], [], []
            for i in range(len(texts)):
                own = hashes[w.bounds[i] : w.bounds[i + 1]]
                if len(own):
                    k = min(lengths_of, len(own))
                    take.append(i)
                    sizes.append(k)
                    seeds.append(window_hashes(own, k).view(np.int64))
                    tokens.append(own.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(take, pa.int64())), pa.array(sizes, pa.int64()), pa.array(seeds, pa.list_(pa.int64())), pa.array(tokens, pa.list_(pa.int64()))],
                names=["item_id", "k", "seeds", "tokens"],
            )

    return run


def _bitmap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The set bits of the seeds of each part, as (word of the bitmap, bits)."""
    for batch in batches:
        at = np.unique(batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - BITMAP_BITS))
        word, bit = (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
        head = np.flatnonzero(np.diff(word, prepend=-1))
        yield pa.RecordBatch.from_arrays([pa.array(word[head]), pa.array(np.bitwise_or.reduceat(bit, head).view(np.int64) if len(head) else bit.view(np.int64))], names=["word", "bits"])


def _hits(bitmap, lengths: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for batch in batches:
            keys, ids, column = batch.column(0), batch.column(1), batch.column(2)
            sizes = column.cast(pa.large_string()).to_pandas().str.len().fillna(0).to_numpy()
            for lo, hi in slices(sizes):
                # one substitution over many texts; a line feed is kept between them
                joined = re.sub(r"[^\w\x00]+", " ", "\x00".join((t or "").replace("\x00", " ").lower() for t in column.slice(lo, hi - lo).to_pylist()))
                w, hashes, found = seeds_of(joined.split("\x00"), lengths)
                total = len(hashes)
                cover = np.zeros(total + 1, dtype=np.int64)
                at_all, seed_all = [], []
                for k, (seed, whole) in found.items():
                    seed = seed[: len(whole)]
                    high = seed >> np.uint64(64 - BITMAP_BITS)
                    at = np.flatnonzero((bits[(high >> np.uint64(6)).astype(np.int64)] >> (high & np.uint64(63)) & np.uint64(1)).astype(bool) & whole)
                    cover[at] += 1
                    np.add.at(cover, at + k, -1)
                    at_all.append(at)
                    seed_all.append(seed[at])
                at, seed = np.concatenate(at_all), np.concatenate(seed_all)
                if not len(at):
                    continue
                inside = np.cumsum(cover)[:-1] > 0
                owner = w.text_of()
                rows, seeds, tokens = [], [], []
                for i in np.unique(owner[at]):
                    a, b = w.bounds[i], w.bounds[i + 1]
                    mine = np.flatnonzero(inside[a:b]) + a
                    gaps = np.flatnonzero(np.diff(mine) > 1) + 1
                    rows.append(i + lo)
                    seeds.append(np.unique(seed[owner[at] == i]).view(np.int64))
                    tokens.append(np.insert(hashes[mine], gaps, 0).view(np.int64))  # 0 parts regions that do not touch
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [keys.take(take), ids.take(take), pa.array(seeds, pa.list_(pa.int64())), pa.array(tokens, pa.list_(pa.int64()))],
                    names=["rk", "id", "seeds", "regions"],
                )

    return run


def _tile(coverage: float, min_tile: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, many, words, share = [], [], [], []
            for r, (regions, tokens) in enumerate(zip(batch.column(3), batch.column(4))):
                text = regions.values.to_numpy(zero_copy_only=False).tolist()
                item = tokens.values.to_numpy(zero_copy_only=False).tolist()
                text = [-(2**70) - i if x == 0 else x for i, x in enumerate(text)]
                found = tiles(item, text, min(min_tile, len(item)))
                n = sum(t[2] for t in found)
                if n >= coverage * len(item):
                    keep.append(r)
                    many.append(len(found))
                    words.append(n)
                    share.append(round(n / len(item), 6))
            take = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i).take(take) for i in range(3)], pa.array(many, pa.int64()), pa.array(words, pa.int64()), pa.array(share, pa.float64())],
                names=["rk", "id", "item_id", "n_tiles", "n_tokens", "coverage"],
            )

    return run


def contaminated_pairs(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_tile: int = MIN_TILE, coverage: float = COVERAGE
) -> DataFrame:
    """(rk, id, item_id, n_tiles, n_tokens, coverage) of document and item pairs at ``coverage`` or more.

    An item of fewer than ``min_tile`` words is one tile. Null or empty texts and items
    match nothing; repeated documents each have their rows, as have repeated items once;
    long texts are searched whole; empty tables give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    src = docs.select(row_key(id_col, text_col).alias("rk"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    id_type = src.schema["id"].dataType.simpleString()
    items = stored(
        benchmark.select("item_id", "text").distinct().mapInArrow(_item_seeds(min_tile), f"item_id {item_type}, k long, seeds array<long>, tokens array<long>"), "op6-items"
    ).withColumn("item_key", F.xxhash64("item_id", "tokens"))
    lengths = sorted(r.k for r in items.select("k").distinct().collect())  # at most min_tile numbers
    schema = f"rk long, id {id_type}, item_id {item_type}, n_tiles long, n_tokens long, coverage double"
    if not lengths:
        return spark.createDataFrame([], schema)
    bits = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.uint64)
    parts = items.select(F.explode("seeds").alias("s")).mapInArrow(_bitmap, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    found = parts.toArrow()  # the bitmap itself: 8 MB at most, whatever the benchmark's size
    bits[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    sent = spark.sparkContext.broadcast(bits)
    hits = stored(src.mapInArrow(_hits(sent, lengths), f"rk long, id {id_type}, seeds array<long>, regions array<long>"), "op6-hits")
    item_seeds = items.select("item_key", F.size("tokens").alias("n"), "k", F.posexplode("seeds").alias("at", "seed"))
    # one row per (document, item) with the item words that shared seeds could cover
    met = hits.select("rk", F.explode("seeds").alias("seed")).distinct().join(item_seeds, "seed")
    spread = met.groupBy("rk", "item_key").agg(F.max("n").alias("n"), F.max("k").alias("k"), F.sort_array(F.collect_set("at")).alias("ats"))
    reach = "aggregate(ats, named_struct('sum', 0L, 'to', -1L), (a, p) -> named_struct('sum', a.sum + k - greatest(0L, least(k, a.to - p + 1L)), 'to', p + k - 1L), a -> a.sum)"
    pairs = spread.where(f"{reach} >= {coverage} * n").select("rk", "item_key")
    ready = (
        pairs.join(hits.select("rk", "id", "regions"), "rk").join(items.select("item_key", "item_id", "tokens"), "item_key").select("rk", "id", "item_id", "regions", "tokens")
    )
    return ready.mapInArrow(_tile(coverage, min_tile), schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold an item of ``benchmark``; all columns stay."""
    own, other = unused(docs, "own_key", "bad_key")
    bad = contaminated_pairs(docs, benchmark, id_col, text_col).select(F.col("rk").alias(other)).distinct()
    keyed = docs.withColumn(own, row_key(id_col, text_col))
    return keyed.join(bad, F.col(own) == F.col(other), "left_anti").select(*docs.columns)
