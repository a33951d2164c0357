"""Substring deduplication by level-wise doubling of repeated word windows.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. The ladder of window lengths ends at
``window`` words and each length is twice the one before (18, then 35 for 35):

1. At the half length every ``window`` is represented by the window of half its
   length with the least hash inside it, so equal windows have equal
   representatives and about one word in ten has to be counted. Counts are summed
   before the shuffle.
2. Only windows whose representative occurs at two places or more are extended to
   the full length. Neighbouring windows with one representative are counted as one
   segment (128-bit keys). A segment that occurs twice settles all its windows; the
   windows of the other segments are counted one by one against one copy of each
   segment with the same representative.

No candidates are left beyond ``window``, the length asked for. Documents with the
same words are one class from the start: each of its windows starts elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import row_key, stored
from corpusprep.llm.words import mix, odd_numbers, slices, sliding, whole_windows, window_hashes, words_of

WINDOW = 35


def _texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, int, list[str | None]]]:
    texts = batch.column(batch.schema.get_field_index(column))
    sizes = texts.cast(pa.large_string()).to_pandas().str.len().fillna(0).to_numpy()
    for lo, hi in slices(sizes):
        yield lo, hi, texts.slice(lo, hi - lo).to_pylist()


def _representatives(hashes: np.ndarray, bounds: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all half windows; for each window its least one; which windows lie in one text."""
    half = (window + 1) // 2
    halves = window_hashes(hashes, half)
    whole = whole_windows(bounds, window)
    return halves, sliding(halves, window - half + 1)[: len(whole)], whole


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _half_level(window: int):
    half = (window + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            for lo, hi, texts in _texts(batch):
                w = words_of(texts)
                halves, least, whole = _representatives(w.hashes(), w.bounds, window)
                # a half window represents some window if the greatest minimum over the windows around it is its own hash
                reach = window - half
                floor = np.where(whole, least, 0)
                around = sliding(np.concatenate([np.zeros(reach, np.uint64), floor, np.zeros(reach, np.uint64)]), reach + 1, np.maximum)
                chosen = np.flatnonzero(around[: len(halves)] == halves)
                cuts = np.searchsorted(chosen, w.bounds)
                joined = [hashlib.sha256(b" ".join(t.encode("utf-8", "surrogatepass").split()) if t else b"").hexdigest() for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(lo, hi - lo),
                        pa.array(w.count, pa.int64()),
                        pa.array(joined, pa.string()),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(_signed(halves[chosen]), pa.int64())),
                    ],
                    names=["rk", "n_words", "words_sha256", "reps"],
                )

    return run


def _full_level(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids, weights = (batch.column(i) for i in (0, 1, 3))
            hits = batch.column(4)
            for lo, hi, texts in _texts(batch):
                w = words_of(texts)
                hashes = w.hashes()
                _, least, whole = _representatives(hashes, w.bounds, window)
                n = len(whole)
                text_of = w.text_of()[:n]
                repeated = [h.values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for h in hits.slice(lo, hi - lo)]
                alive = np.zeros(n, dtype=bool)
                for k, own in enumerate(repeated):
                    a, b = w.bounds[k], min(w.bounds[k + 1], n)
                    if b > a:
                        alive[a:b] = np.isin(least[a:b], own)
                at = np.flatnonzero(alive & whole)
                if not len(at):
                    continue
                first, second = window_hashes(hashes, window, 1)[at], window_hashes(w.hashes(1), window, 2)[at]
                new = np.ones(len(at), dtype=bool)
                new[1:] = (np.diff(at) > 1) | (least[at[1:]] != least[at[:-1]]) | (text_of[at[1:]] != text_of[at[:-1]])
                head = np.flatnonzero(new)
                size = np.diff(np.append(head, len(at)))
                place = np.arange(len(at)) - np.repeat(head, size)
                f = odd_numbers(int(2 ** np.ceil(np.log2(size.max() + 1))), 300)[place]
                key1 = mix(np.add.reduceat(first * f, head) + size.astype(np.uint64))
                key2 = mix(np.add.reduceat(second * f, head) + size.astype(np.uint64))
                text = text_of[at[head]]
                cuts = pa.array(np.append(head, len(at)), pa.int32())
                take = pa.array(text + lo)
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(take),
                        ids.take(take),
                        weights.take(take),
                        pa.array(_signed(least[at[head]])),
                        pa.array(_signed(key1)),
                        pa.array(_signed(key2)),
                        pa.array(at[head] - w.bounds[text], pa.int64()),
                        pa.array(size, pa.int64()),
                        pa.ListArray.from_arrays(cuts, pa.array(_signed(first))),
                        pa.ListArray.from_arrays(cuts, pa.array(_signed(second))),
                    ],
                    names=["rk", "id", "weight", "rep", "k1", "k2", "lo", "n", "w1", "w2"],
                )

    return run


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(3).to_pylist()
            removed, kept = [], []
            for text, own in zip(batch.column(2).to_pylist(), spans):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                mark = np.zeros(len(words) + 1, dtype=np.int64)
                for s in own:
                    mark[s["lo"]] += 1
                    mark[s["lo"] + s["n"] + window - 1] -= 1
                gone = np.cumsum(mark)[:-1] > 0
                removed.append(int(gone.sum()))
                kept.append(b" ".join(words[i] for i in np.flatnonzero(~gone)).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=["rk", "id", "n_removed", "kept"],
            )

    return run


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """``(rows, spans)``: per document its key, word count, class; per document of several words its repeated windows.

    ``spans`` has (rk, id, spans: array of first window ``lo`` and window count ``n``) for
    documents that share windows without being copies of another; a copy (class
    ``n_same`` of 2 or more) is repeated throughout and has no spans row.
    """
    src = docs.select(row_key(id_col, text_col).alias("rk"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    base = stored(
        src.select("rk", "text").mapInArrow(_half_level(window), "rk long, n_words long, words_sha256 string, reps array<long>"),
        "op1-half",
    )
    long_enough = base.where(F.col("n_words") >= window)
    classes = long_enough.groupBy("words_sha256").agg(F.count("*").alias("n_same"), F.min("rk").alias("first_rk"))
    # one document stands for each class; it weighs 2 if it has copies
    weights = classes.select(F.col("first_rk").alias("rk"), F.least("n_same", F.lit(2)).alias("weight"))
    heads = stored(long_enough.select("rk", "reps").join(weights, "rk"), "op1-heads")
    one = heads.select("rk", "weight", F.explode("reps").alias("rep"))
    # written, so that the join below has an exchange of its own on each side and a representative of many documents is split
    often = stored(one.groupBy("rep").agg(F.sum("weight").alias("c")).where("c >= 2").select("rep"), "op1-often")
    found = one.select("rk", "rep").join(often, "rep", "left_semi").groupBy("rk").agg(F.collect_set("rep").alias("hits"))
    hits = found.join(heads.select("rk", "weight"), "rk")
    segments = stored(
        src.join(hits, "rk")
        .select("rk", "id", "text", "weight", "hits")
        .mapInArrow(
            _full_level(window),
            f"rk long, id {id_type}, weight long, rep long, k1 long, k2 long, lo long, n long, w1 array<long>, w2 array<long>",
        ),
        "op1-segments",
    )
    key = ["rep", "k1", "k2"]
    seen = segments.groupBy(*key).agg(F.sum("weight").alias("c"), F.min(F.struct("rk", "lo")).alias("at"))
    seen = seen.withColumn("c", F.least("c", F.lit(2)))
    open_reps = seen.where("c < 2").select("rep").distinct()
    narrow = segments.select("rk", "id", "weight", *key, "lo", "n")
    settled_spans = narrow.where("weight = 1").join(seen.where("c >= 2").select(*key), key, "left_semi").select("rk", "id", "lo", "n")
    one_each = segments.join(seen.join(open_reps, "rep", "left_semi"), key).where("at.rk = rk and at.lo = lo")
    windows = stored(
        one_each.select("rk", "id", "lo", "c", F.posexplode(F.arrays_zip("w1", "w2")).alias("i", "w")).select(
            "rk", "id", (F.col("lo") + F.col("i")).alias("lo"), "c", F.col("w.w1").alias("w1"), F.col("w.w2").alias("w2")
        ),
        "op1-windows",
    )
    twice = windows.groupBy("w1", "w2").agg(F.sum("c").alias("t")).where("t >= 2").select("w1", "w2")
    open_spans = windows.where("c < 2").join(twice, ["w1", "w2"], "left_semi").select("rk", "id", "lo", F.lit(1).cast("long").alias("n"))
    spans = settled_spans.unionByName(open_spans).groupBy("rk", "id").agg(F.collect_list(F.struct("lo", "n")).alias("spans"))
    rows = src.select("rk", "id").join(base.select("rk", "n_words", "words_sha256").dropDuplicates(["rk"]), "rk")
    rows = rows.join(classes.select("words_sha256", "n_same"), "words_sha256", "left")
    return rows, spans


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Documents without the words of repeated windows: (id, n_words, n_removed, kept, kept_sha256).

    A word goes if a window of ``window`` words over it has a word sequence that also
    starts elsewhere, in any document or in the same one; windows are judged on the
    input. ``kept`` holds the kept words of changed documents joined by one space and
    is null where nothing was removed. Null and empty texts have no words; documents
    under ``window`` words are unchanged; repeated rows are copies of each other; a
    null id is an id like any other; an empty table gives no rows; other columns are
    ignored.
    """
    rows, spans = repeated_spans(docs, id_col, text_col, window)
    src = docs.select(row_key(id_col, text_col).alias("rk"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    cut = (
        src.join(spans.withColumnRenamed("id", "id2"), "rk")
        .where(F.col("id").eqNullSafe(F.col("id2")))
        .select("rk", "id", "text", "spans")
        .mapInArrow(_cut(window), f"rk long, id {id_type}, n_removed long, kept string")
        .dropDuplicates(["rk"])
        .select("rk", "n_removed", "kept")
    )
    copied = F.coalesce(F.col("n_same") > 1, F.lit(False))
    return rows.join(cut, "rk", "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.when(copied, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copied, F.lit("")).otherwise(F.col("kept")).alias("kept"),
        F.when(copied, F.sha2(F.lit(""), 256)).otherwise(F.coalesce(F.sha2("kept", 256), "words_sha256")).alias("kept_sha256"),
    )
