"""Whitening of embeddings by incremental eigendecomposition.

Every partition keeps the spectrum of the scatter matrix of its own vectors: a vector
(with its number of copies in the batch) is one centred rank-one update, whose
eigenvalues are the roots of a secular equation and whose eigenvectors follow from
them, after components that the update does not move are deflated. Spectra of
partitions are combined in a tree of small groups: the pairs of one spectrum and the
difference of the means are successive rank-one updates of the other. The combined
basis then goes through distributed Rayleigh-Ritz passes over all vectors until the
residual is at rounding level; with a basis of full rank (the default) that is one pass.

State is bounded by the dimension and the rank, never by the number of rows: a
partition holds one basis, and the driver receives one combined row a pass.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from typing import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import stored

COMPONENTS = 8
#: Entries become whole numbers: floor(SCALE * c) + SHIFT, held at +-2**62 where they are larger.
SCALE, SHIFT, LIMIT = 1024, 100_000, 2**62
#: Spectra or sums that one task combines.
FAN_IN = 8
#: A Ritz vector is done when its residual is under this share of its eigenvalue.
RESIDUAL = 1e-11
PASSES = 200
EPS = float(np.finfo(float).eps)


# --- vectors of a batch -----------------------------------------------------------------

def whole_vectors(column, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, x): positions of the vectors of ``dim`` finite entries, and these as whole numbers."""
    lists = column.cast(pa.large_list(pa.float64()))
    size = np.nan_to_num(pc.list_value_length(lists).to_numpy(zero_copy_only=False), nan=0).astype(np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    good = np.concatenate([[0], np.cumsum(np.isfinite(values))])
    end = np.cumsum(size)
    keep = (size == dim) & (good[end] - good[end - size] == dim) & pc.is_valid(lists).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(values[np.repeat(keep, size)].reshape(-1, dim) * SCALE)
    return np.flatnonzero(keep), np.clip(x, -LIMIT, LIMIT).astype(np.int64) + SHIFT


def exact_sums(x: np.ndarray) -> list[int]:
    """Sums of the columns as Python integers; halves are summed apart, so nothing overflows."""
    high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
    return [(int(h) << 32) + int(v) for h, v in zip(high, low)]


def centred(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list[int | None]]:
    """(x - S/n as doubles, sum of (n x - S)^2 of each row, null where it does not fit a long)."""
    reach = max((n * abs(int(v)) + abs(s) for v, s in zip(np.abs(x).max(axis=0), sums)), default=0) if len(x) else 0
    if reach < 2**62 and reach * reach * len(sums) < 2**63:
        moved = n * x - np.array(sums, dtype=np.int64)
        return moved / n, (moved * moved).sum(axis=1).tolist()
    moved = [[n * int(v) - s for v, s in zip(row, sums)] for row in x]
    if not moved:
        return np.zeros(x.shape), []
    far = [sum(v * v for v in row) for row in moved]
    return np.array([[v / n for v in row] for row in moved]), [v if v < 2**63 else None for v in far]


# --- rank-one updates -------------------------------------------------------------------

def secular_roots(d: np.ndarray, z2: np.ndarray) -> np.ndarray:
    """``gap[j, i]`` = d_i - root_j of 1 + sum z2_i / (d_i - t) = 0, for rising distinct d and positive z2.

    Root j lies between d_j and d_{j+1} (the last one within sum z2 above the last d). It
    is found as an offset from its nearer pole, by interpolation with the two poles
    around it, kept inside a bracket that every step narrows.
    """
    n = len(d)
    upper = np.append(d[1:], d[-1] + z2.sum())
    half = (upper - d) / 2
    at_half = 1 + (z2 / ((d - d[:, None]) - half[:, None])).sum(axis=1)
    left = (at_half >= 0) | (np.arange(n) == n - 1)
    origin = np.where(left, d, upper)
    poles = d - origin[:, None]
    lo = np.where(left, 0.0, -half)
    hi = np.where(left, np.where(np.arange(n) == n - 1, 2 * half, half), 0.0)
    below = np.tri(n, dtype=bool)
    near, far = d - origin, upper - origin
    t, done = (lo + hi) / 2, np.zeros(n, dtype=bool)
    for _ in range(60):
        gap = poles - t[:, None]
        parts = z2 / gap
        f = 1 + parts.sum(axis=1)
        lo, hi = np.where(f < 0, t, lo), np.where(f < 0, hi, t)
        slopes = parts / gap
        psi = np.where(below, slopes, 0.0).sum(axis=1)
        phi = slopes.sum(axis=1) - psi
        p, q = near - t, far - t
        a = (p + q) * f - p * q * (psi + phi)
        b, c = p * q * f, f - p * psi - q * phi
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        small = np.abs(step) <= 1e-10 * np.abs(t)  # steps converge in square: this is the last one
        new = np.where(small, np.clip(t + step, lo, hi), t + step)
        inside = small | ((new > lo) & (new < hi))
        t = np.where(done, t, np.where(inside, new, (lo + hi) / 2))
        done |= small | (hi - lo <= 2 * EPS * np.abs(t))
        if done.all():
            break
    return poles - t[:, None]


def update_diagonal(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of diag(d) + z z', for rising d."""
    n = len(d)
    turn = np.eye(n)
    z = z.astype(float).copy()
    size = float(np.linalg.norm(z))
    tol = 8 * EPS * max(float(np.abs(d).max(initial=0)), size * size)
    z[np.abs(z) * size <= tol] = 0.0
    # deflation of equal eigenvalues: a reflection inside each group leaves one entry of z
    k = 0
    while k < n:
        m = k + 1
        while m < n and d[m] - d[k] <= tol:
            m += 1
        own = z[k:m]
        if np.count_nonzero(own) > 1:
            w = own.copy()
            end = np.copysign(np.linalg.norm(own), own[-1])
            w[-1] += end
            w /= np.linalg.norm(w)
            turn[:, k:m] -= 2 * np.outer(turn[:, k:m] @ w, w)
            z[k:m] = 0.0
            z[m - 1] = -end
        k = m
    live = np.flatnonzero(z)
    if len(live) == 0:
        return d, turn
    own = d[live]
    gap = secular_roots(own, z[live] ** 2)
    roots = own - np.diag(gap)
    # entries of z for which these roots are exact, so that the vectors are orthogonal
    between = own[:, None] - own
    np.fill_diagonal(between, 1.0)
    better = np.sqrt(np.abs(np.prod(gap / between, axis=0))) * np.sign(z[live])
    vectors = (better / gap).T
    vectors /= np.linalg.norm(vectors, axis=0)
    values = d.copy()
    values[live] = roots
    turn[:, live] = turn[:, live] @ vectors
    order = np.argsort(values, kind="stable")
    return values[order], turn[:, order]


@dataclass
class Spectrum:
    """Number of vectors, their sums and mean, and the eigenpairs of their scatter matrix (rising, ``rank`` at most)."""

    rank: int
    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray
    basis: np.ndarray
    updates: int = 0

    @classmethod
    def empty(cls, dim: int, rank: int) -> Spectrum:
        return cls(rank, 0, [0] * dim, np.zeros(dim), np.zeros(0), np.zeros((dim, 0)))

    def rank_one(self, v: np.ndarray) -> None:
        """Add v v' to the scatter matrix: project, append what the basis lacks, solve, drop what exceeds the rank."""
        inside = self.basis.T @ v
        rest = v - self.basis @ inside
        again = self.basis.T @ rest
        inside, rest = inside + again, rest - self.basis @ again
        over = float(np.linalg.norm(rest))
        values, basis, z = self.values, self.basis, inside
        if basis.shape[1] < len(v) and over > 1e-12 * max(float(np.linalg.norm(v)), 1e-300):
            values = np.append(0.0, values)
            basis = np.column_stack([rest / over, basis])
            z = np.append(over, inside)
        if len(values) == 0:
            return
        values, turn = update_diagonal(values, z)
        self.values, self.basis = values[-self.rank :], (basis @ turn)[:, -self.rank :]
        self.updates += 1
        if self.updates % 256 == 0:
            self.basis = np.linalg.qr(self.basis)[0]

    def add(self, x: np.ndarray, copies: int) -> None:
        n = self.n + copies
        away = x - self.mean
        if self.n:
            self.rank_one(np.sqrt(self.n / n * copies) * away)
        self.mean, self.n = self.mean + away * (copies / n), n

    def combine(self, other: Spectrum) -> None:
        if not other.n:
            return
        for value, vector in zip(other.values, other.basis.T):
            if value > 0:
                self.rank_one(np.sqrt(value) * vector)
        n = self.n + other.n
        away = other.mean - self.mean
        if self.n:
            self.rank_one(np.sqrt(self.n / n * other.n) * away)
        self.mean, self.n = self.mean + away * (other.n / n), n
        self.sums = [a + b for a, b in zip(self.sums, other.sums)]

    def row(self) -> dict:
        return {"n": self.n, "sums": [str(s) for s in self.sums], "mean": self.mean.tolist(), "values": self.values.tolist(), "basis": self.basis.ravel().tolist()}

    @classmethod
    def read(cls, row, rank: int) -> Spectrum:
        mean, values = np.array(row["mean"], dtype=float), np.array(row["values"], dtype=float)
        return cls(rank, int(row["n"]), [int(s) for s in row["sums"]], mean, values, np.array(row["basis"], dtype=float).reshape(len(mean), len(values)))


# --- distributed passes -----------------------------------------------------------------

def _per_partition(vectors: DataFrame, dim: int, start: Callable, fold: Callable, finish: Callable, schema: str) -> DataFrame:
    """One row a partition: ``fold(state, x)`` over its batches, then ``finish(state) -> dict``."""
    arrow = pa.schema([("part", pa.int64())] + [(n, _ARROW[t]) for n, t in (f.split(" ") for f in schema.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = start()
        for batch in batches:
            _, x = whole_vectors(batch.column(0), dim)
            if len(x):
                fold(state, x)
        yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), **finish(state)}], arrow)

    return vectors.mapInArrow(run, f"part long, {schema}")


_ARROW = {"long": pa.int64(), "array<double>": pa.list_(pa.float64()), "array<string>": pa.list_(pa.string())}


def _combined(rows: DataFrame, merge: Callable[[list[dict]], dict], name: str):
    """The one row that ``merge`` makes of all rows, in a tree of groups of ``FAN_IN``; null without rows."""
    rows = stored(rows, name)
    last = rows.agg(F.max("part")).head()[0]
    if last is None:
        return None

    def group(frame: pd.DataFrame) -> pd.DataFrame:
        ordered = frame.sort_values("part").to_dict("records")
        return pd.DataFrame([{"part": ordered[0]["part"], **merge(ordered)}])

    while last > 0:
        rows = rows.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("part").applyInPandas(group, rows.schema)
        last //= FAN_IN
    return rows.head()


def _spectrum(vectors: DataFrame, dim: int, rank: int) -> Spectrum | None:
    def fold(state: Spectrum, x: np.ndarray) -> None:
        state.sums = [a + b for a, b in zip(state.sums, exact_sums(x))]
        different, copies = np.unique(x, axis=0, return_counts=True)
        for v, c in zip(different.astype(float), copies):
            state.add(v, int(c))

    def merge(rows: list[dict]) -> dict:
        state = Spectrum.read(rows[0], rank)
        for row in rows[1:]:
            state.combine(Spectrum.read(row, rank))
        return state.row()

    schema = "n long, sums array<string>, mean array<double>, values array<double>, basis array<double>"
    row = _combined(_per_partition(vectors, dim, lambda: Spectrum.empty(dim, rank), fold, Spectrum.row, schema), merge, "spectra")
    return None if row is None or row["n"] == 0 else Spectrum.read(row, rank)


def _summed(rows: list[dict]) -> dict:
    return {"total": np.sum([np.array(r["total"], dtype=float) for r in rows], axis=0).tolist(), "trace": [float(sum(r["trace"][0] for r in rows))]}


def _ritz(vectors: DataFrame, dim: int, n: int, sums: list[int], basis: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues, eigenvectors, trace) of the covariance, falling, from Rayleigh-Ritz passes over all vectors."""
    basis = np.linalg.qr(basis)[0]
    for k in range(PASSES):
        shape = basis.shape

        def fold(state: dict, x: np.ndarray, basis=basis) -> None:
            z, _ = centred(x, n, sums)
            state["total"] += z.T @ (z @ basis)
            state["trace"] += float((z * z).sum())

        start = lambda: {"total": np.zeros(shape), "trace": 0.0}
        finish = lambda s: {"total": s["total"].ravel().tolist(), "trace": [s["trace"]]}
        row = _combined(_per_partition(vectors, dim, start, fold, finish, "total array<double>, trace array<double>"), _summed, "ritz")
        image, trace = np.array(row["total"], dtype=float).reshape(shape) / n, row["trace"][0] / n
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz = basis @ turn
        off = np.linalg.norm(image @ turn - ritz * values, axis=0)[:components]
        if (off <= np.maximum(RESIDUAL * values[:components], 4 * dim * EPS * values[0])).all() or shape[1] == dim:
            break
        basis = np.linalg.qr(image)[0]
    else:
        logging.getLogger(__name__).warning("Ritz vectors have a residual of %g after %d passes", off.max(), PASSES)
    return values[:components], ritz[:, :components], trace


def _identity_error(vectors: DataFrame, dim: int, whiten: Callable, size: int) -> float:
    """Largest entry of the covariance of the whitened vectors minus the identity, centred before multiplying."""

    def moments(n: int, mean: np.ndarray, second: np.ndarray) -> dict:
        return {"n": n, "mean": mean.tolist(), "second": second.ravel().tolist()}

    def merge(rows: list[dict]) -> dict:
        n, mean, second = 0, np.zeros(size), np.zeros((size, size))
        for r in rows:
            if r["n"]:
                away = np.array(r["mean"], dtype=float) - mean
                total = n + int(r["n"])
                second = second + np.array(r["second"], dtype=float).reshape(size, size) + np.outer(away, away) * (n / total * r["n"])
                mean, n = mean + away * (r["n"] / total), total
        return moments(n, mean, second)

    def fold(state: dict, x: np.ndarray) -> None:
        w, _ = whiten(x)
        mean = w.mean(axis=0)
        state.update(merge([state, moments(len(w), mean, (w - mean).T @ (w - mean))]))

    empty = lambda: moments(0, np.zeros(size), np.zeros((size, size)))
    row = _combined(_per_partition(vectors, dim, empty, fold, lambda s: s, "n long, mean array<double>, second array<double>"), merge, "identity")
    return float(np.abs(np.array(row["second"]).reshape(size, size) / row["n"] - np.eye(size)).max(initial=0))


def whiten_embeddings(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, rank: int | None = None
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component.

    Vectors that are null or hold null or non-finite entries are dropped, empty ones too;
    where lengths differ the most frequent one counts (the longest of several) and others
    are dropped. Repeated rows each count and each have their rows; null ids are kept.
    There are as many components as dimensions where these are fewer. A component without
    variance has a null ``whitened`` and is left out of ``identity_error``; ``deviation``
    is null where it does not fit a long. Equal eigenvalues share a plane, in which any
    basis is right. Signs make the largest entry of a component positive. An empty table
    gives an empty result; other columns are ignored, whatever their names. ``rank`` bounds
    the basis (default: all dimensions); smaller ones take more Rayleigh-Ritz passes.
    """
    spark = rows.sparkSession
    id_type = rows.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    v = F.col(vector_col)
    fine = F.coalesce(F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))), F.lit(False))
    own = rows.where(fine & (F.size(v) > 0)).select(v.alias("vector"), F.col(id_col).alias(id_col))
    lengths = own.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n"))
    most = lengths.agg(F.max_by("dim", F.struct("n", "dim"))).head()[0]
    if most is None:
        return spark.createDataFrame([], schema)
    dim, vectors = most, own.select("vector")
    rank = min(dim, max(rank or dim, min(components, dim)))
    found = _spectrum(vectors, dim, rank)
    n, sums = found.n, found.sums
    basis = found.basis
    if basis.shape[1] < rank:  # fewer directions than asked for were seen
        basis = np.linalg.qr(np.column_stack([basis, np.eye(dim)]))[0][:, :rank]
    values, ritz, trace = _ritz(vectors, dim, n, sums, basis, min(components, dim))
    ritz = ritz * np.sign(ritz[np.abs(ritz).argmax(axis=0), np.arange(ritz.shape[1])])
    live = values > dim * EPS * max(float(values[0]), 0.0)
    size = len(values)

    def whiten(x: np.ndarray, every: bool = False):
        z, far = centred(x, n, sums)
        out = np.full((len(x), size), np.nan)
        out[:, live] = z @ ritz[:, live] / np.sqrt(values[live])
        return (out if every else out[:, live]), far

    error = _identity_error(vectors, dim, whiten, int(live.sum())) if live.any() else 0.0
    explained = np.where(live, values / trace if trace > 0 else 0.0, 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = whole_vectors(batch.column(0), dim)
            white, far = whiten(x, True)
            m = len(at)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).take(pa.array(np.repeat(at, size))),
                    pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * size, n, dtype=np.int64)),
                    pa.array([d for d in far for _ in range(size)], pa.int64()),
                    pa.array(white.ravel(), pa.float64(), from_pandas=True),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * size, error)),
                ],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return own.mapInArrow(run, schema)


__all__ = ["COMPONENTS", "Spectrum", "secular_roots", "update_diagonal", "whiten_embeddings"]
