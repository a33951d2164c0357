"""Language identification by multinomial naive Bayes over hashed character n-grams.

Two- and three-character grams of lower-cased text, runs of non-letters being one
space, are hashed into ``DIMS`` columns. Counts by language give a smoothed
log-probability matrix, languages by columns, which is broadcast: its size is
``DIMS`` times the number of languages, and more than ``MAX_LANGS`` languages are
refused. A batch of texts is one sparse count matrix times that matrix in numpy.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.llm.words import mix, slices

DIMS = 1 << 14
SMOOTH = 0.5
#: Labelled documents to learn from: all of them up to this many, else so many on average: all of each small language
#: and, by hash of the id, one and the same number of each large one.
TRAIN_DOCS = 40_000
MAX_LANGS = 256
UNKNOWN = "und"


def gram_columns(texts: list[str | None], dims: int = DIMS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(column of each gram, text number of each gram, number of letters of each text)."""
    low = [(t or "").lower() for t in texts]
    points = np.frombuffer("\n".join(low).encode("utf-32-le", "surrogatepass") + b"\n\0\0\0", dtype=np.uint32)
    size = np.fromiter((len(t) + 1 for t in low), dtype=np.int64, count=len(low))
    owner = np.repeat(np.arange(len(low)), size)
    seen = np.flatnonzero(np.bincount(points))
    table = np.zeros(int(seen[-1]) + 1, dtype=bool)
    table[seen] = [chr(c).isalpha() for c in seen]
    letter = table[points]
    letters = np.bincount(owner[letter], minlength=len(low))
    start = np.zeros(len(points), dtype=bool)
    start[np.cumsum(size)[:-1]] = True
    start[0] = True
    keep = letter | start | np.concatenate([[True], letter[:-1]])
    code = np.where(letter, points, 32).astype(np.uint64)[keep]
    owner = owner[keep]
    two = code[:-1] * np.uint64(0x110000) + code[1:]
    same2 = owner[:-1] == owner[1:]
    three = two[:-1] * np.uint64(0x110000) + code[2:] + np.uint64(1 << 63)
    same3 = owner[:-2] == owner[2:]
    grams = np.concatenate([two[same2], three[same3]])
    return (mix(grams) & np.uint64(dims - 1)).astype(np.int64), np.concatenate([owner[:-1][same2], owner[:-2][same3]]), letters


def _count(langs: list[str], dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), dims), dtype=np.int64)
        docs = np.zeros(len(langs), dtype=np.int64)
        number = {lang: i for i, lang in enumerate(langs)}
        for batch in batches:
            texts, labels = batch.column(0), batch.column(1)
            for lo, hi in slices(_sizes(texts)):
                cols, owner, _ = gram_columns(texts.slice(lo, hi - lo).to_pylist(), dims)
                own = np.array([number[x] for x in labels.slice(lo, hi - lo).to_pylist()], dtype=np.int64)
                total += np.bincount(own[owner] * dims + cols, minlength=total.size).reshape(total.shape)
                docs += np.bincount(own, minlength=len(langs))
        at = np.flatnonzero(total.ravel())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, np.full(len(langs), -1) - np.arange(len(langs)))), pa.array(np.append(total.ravel()[at], docs))], names=["cell", "c"]
        )

    return run


def _sizes(texts: pa.Array) -> np.ndarray:
    return texts.cast(pa.large_string()).to_pandas().str.len().fillna(0).to_numpy()


def _predict(model, langs: list[str], dims: int, text_col: str, keep: list[str], added: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, prior = model.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            names, scores = [], []
            for lo, hi in slices(_sizes(texts), 1 << 20):
                cols, owner, letters = gram_columns(texts.slice(lo, hi - lo).to_pylist(), dims)
                n = hi - lo
                score = np.stack([np.bincount(owner, weights=logs[cols, k], minlength=n) for k in range(len(langs))], axis=1) + prior
                best = score.argmax(axis=1)
                share = 1 / np.exp(score - score.max(axis=1, keepdims=True)).sum(axis=1)
                names += [langs[b] if c else UNKNOWN for b, c in zip(best, letters)]
                scores += [float(s) if c else 0.0 for s, c in zip(share, letters)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(c)) for c in keep], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*keep, *added],
            )

    return run


def shares(sizes: list[int], total: int) -> list[float]:
    """The share of each size to take so that all small ones are taken whole, the others level, ``total`` together."""
    level, rest = 0.0, float(total)
    for k, n in enumerate(sorted(sizes)):
        level = rest / (len(sizes) - k)
        if n > level:
            break
        rest -= n
        level = float(n)
    return [min(1.0, level / n) for n in sizes]


def train(labelled: DataFrame, dims: int = DIMS, train_docs: int = TRAIN_DOCS):
    """``(langs, log-probability matrix dims x langs, log priors)`` from (key, text, lang) rows."""
    labelled = labelled.where("lang is not null and text is not null")
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").limit(MAX_LANGS + 1).collect()
    langs, n = [r.lang for r in sizes], sum(r.n for r in sizes)
    if len(langs) > MAX_LANGS:
        raise ValueError(f"over {MAX_LANGS} languages; the model would not stay small")
    if not langs:
        return [], np.zeros((dims, 0)), np.zeros(0)
    if n > train_docs:
        share = F.create_map(*[F.lit(x) for r, s in zip(sizes, shares([r.n for r in sizes], train_docs)) for x in (r.lang, math.ceil(1_000_000_000 * s))])
        labelled = labelled.where(F.pmod(F.xxhash64("key", F.lit(5)), F.lit(1_000_000_000)) < share[F.col("lang")])
    counted = labelled.select("text", "lang").mapInArrow(_count(langs, dims), "cell long, c long")
    counts = np.zeros((len(langs), dims))
    docs = np.array([r.n for r in sizes], dtype=np.float64)
    for r in counted.groupBy("cell").agg(F.sum("c").alias("c")).collect():  # dims x languages numbers at most
        if r.cell >= 0:  # the others are documents learnt from; the prior counts all
            counts[r.cell // dims, r.cell % dims] = r.c
    logs = np.log((counts + SMOOTH) / (counts.sum(axis=1, keepdims=True) + SMOOTH * dims))
    return langs, logs.T.copy(), np.log((docs + 1) / (docs.sum() + len(docs)))


def predict(docs: DataFrame, model, text_col: str = "text", keep: list[str] | None = None, added: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Columns ``keep`` of ``docs`` (default: all but the text), the predicted language and its score."""
    langs, logs, prior = model
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    if not langs:
        return docs.select(*keep, F.lit(UNKNOWN).alias(added[0]), F.lit(0.0).alias(added[1]))
    sent = docs.sparkSession.sparkContext.broadcast((logs, prior))
    schema = T.StructType([docs.schema[c] for c in keep]).add(added[0], "string").add(added[1], "double")
    return docs.mapInArrow(_predict(sent, langs, DIMS, text_col, keep, added), schema)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: (id, held_out, lang_pred, score); learnt from documents that are not held out.

    ``score`` is the posterior of the predicted language. A text that is null or has no
    letter is ``und`` with score 0; so is every text if no document has a language. A tie
    goes to the first language by name; repeated rows get equal rows; a null id is not
    held out; long texts are read whole; an empty table gives no rows.
    """
    own = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    model = train(own.where("not held_out").select(F.col("id").alias("key"), "text", "lang"))
    return predict(own.select("id", "held_out", "text"), model).withColumnRenamed("id", id_col)


