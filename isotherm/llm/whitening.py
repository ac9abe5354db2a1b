"""Whitening of vectors; the components come from FEAST contour integration.

Executors sum exact integers for the means and centred products for the covariance, one array
per task, added up by a merge tree; d x d numbers reach the driver, whatever the number of rows.
There, the spectrum is cut from the top into intervals whose numbers of eigenvalues are known
by the inertia of shifted matrices (Sylvester). For each interval a Gauss-Legendre quadrature of
complex shifted solves along a circle projects onto its eigenspace, Rayleigh-Ritz extracts the
pairs, and an interval is done when it has as many as its inertia counts say.

Rows whose vector is null or holds null or non-finite entries are dropped; entries that
a shorter vector lacks count as null, the longest vector sets the dimension. Entries beyond
2^52 in size after scaling count as 2^52. Repeated rows count as often as they come. A component
whose eigenvalue is zero beside the largest (rank deficient, or a single row) has a null ``whitened`` and
is left out of ``identity_error``; with no variance at all ``explained`` is null. A ``deviation``
beyond 64 bits is null. An empty table gives an empty result. No column beside key and vector is read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.operators.partials import merge_arrays, task_part

#: Scale and offset of the integers, components, quadrature points on a half circle, eigenvalues an interval should hold.
SCALE, OFFSET, COMPONENTS, POINTS, PER_INTERVAL = 1024, 100_000, 8, 16, 4
_LARGEST = 1 << 52


# --------------------------------------------------------------------------- eigenvalues


def inertia(a: np.ndarray) -> tuple[int, int]:
    """Numbers of positive and negative eigenvalues, by Bunch-Parlett elimination with 1x1 and 2x2 pivots."""
    a, positive, negative = np.array(a, dtype=float), 0, 0
    alpha = (1 + np.sqrt(17)) / 8
    while len(a):
        diagonal = np.abs(np.diag(a))
        p = int(diagonal.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        r, s = np.unravel_index(int(off.argmax()), off.shape)
        if max(diagonal[p], off[r, s]) == 0.0:
            break
        chosen = [p] if len(a) == 1 or diagonal[p] >= alpha * off[r, s] else [int(r), int(s)]
        rest = np.delete(np.arange(len(a)), chosen)
        pivot, side = a[np.ix_(chosen, chosen)], a[np.ix_(rest, chosen)]
        if len(chosen) == 1:
            positive, negative = positive + (pivot[0, 0] > 0), negative + (pivot[0, 0] < 0)
        else:  # such a pivot is indefinite
            positive, negative = positive + 1, negative + 1
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(pivot, side.T)
        a = (a + a.T) / 2
    return int(positive), int(negative)


def _above(v: np.ndarray, at: float) -> int:
    return inertia(v - at * np.eye(len(v)))[0]


def _gap(v: np.ndarray, low: float, high: float) -> tuple[float, int] | None:
    """A place between two eigenvalues, as near the middle as a wide gap allows, and the eigenvalues above it."""
    for room in (1e-2, 1e-4, 1e-6):
        for at in (0.5, 0.42, 0.58, 0.34, 0.66, 0.26, 0.74, 0.18, 0.82, 0.1, 0.9):
            mid, free = low + at * (high - low), room * (high - low)
            n = _above(v, mid - free)
            if n == _above(v, mid + free):
                return mid, n
    return None


def intervals(v: np.ndarray, k: int) -> list[tuple[float, float, int]]:
    """``low, high, eigenvalues`` from the top of the spectrum down, until k are covered.

    An interval is cut while it holds more than ``PER_INTERVAL``, near its middle and where no eigenvalue is
    near; one without such a place holds a cluster and stays whole.
    """
    radius = np.abs(v).sum(axis=1) - np.abs(np.diag(v))
    span = max(np.abs(v).sum(axis=1).max(), np.finfo(float).tiny)
    high, low = (np.diag(v) + radius).max() + 1e-3 * span, (np.diag(v) - radius).min() - 1e-3 * span
    todo, out, covered = [(low, high, len(v), 0)], [], 0
    while todo and covered < k:
        a, b, below, above = todo.pop()  # eigenvalues above a and above b
        cut = _gap(v, a, b) if below - above > PER_INTERVAL and b - a > 1e-10 * span else None
        if cut is not None:
            mid, n = cut
            todo += [(a, mid, below, n), (mid, b, n, above)]
        elif below > above:
            out.append((a, b, below - above))
            covered += below - above
    return out


def project(v: np.ndarray, low: float, high: float, basis: np.ndarray) -> np.ndarray:
    """Spectral projector of an interval, by quadrature along the circle through its ends, times a basis."""
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    center, r = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(basis)
    for x, w in zip(nodes, weights, strict=True):
        turn = np.exp(1j * np.pi / 2 * (1 - x))
        solved = np.linalg.solve((center + r * turn) * np.eye(len(v)) - v, basis.astype(complex))
        out += w / 2 * np.real(r * turn * solved)
    return out


def _ritz(v: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    q = np.linalg.qr(basis)[0]
    h = q.T @ v @ q
    values, turns = np.linalg.eigh((h + h.T) / 2)
    return values[::-1], (q @ turns)[:, ::-1]


def feast(v: np.ndarray, k: int, *, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and unit eigenvectors as columns.

    Raises ``ArithmeticError`` if an interval does not yield as many pairs as its inertia counts.
    """
    d, scale = len(v), np.abs(v).sum(axis=1).max() if len(v) else 0.0
    k = min(k, d)
    if scale == 0.0 or k == 0:
        return np.zeros(k), np.eye(d)[:, :k]
    rng, found = np.random.default_rng(13), []
    for low, high, count in intervals(v, k):
        margin = max((high - low) * 1e-9, 1e-14 * scale)
        size = min(d, count + max(4, count // 2))
        basis = rng.standard_normal((d, size))
        best = np.inf
        for _ in range(rounds):
            basis = project(v, low, high, basis)
            values, vectors = _ritz(v, basis)
            inside = (values >= low - margin) & (values <= high + margin)
            pairs = vectors[:, inside]
            error = np.abs(v @ pairs - pairs * values[inside]).max(initial=0.0)
            settled = error <= 1e-15 * d * scale or error >= best and error <= 1e-11 * scale
            if inside.sum() == count and settled:
                break
            if inside.sum() != count and size < d:  # a larger subspace separates what lies close outside
                size = min(d, size + max(2, size // 4))
                vectors = np.hstack([vectors, rng.standard_normal((d, size - vectors.shape[1]))])
            best = min(best, error) if inside.sum() == count else np.inf
            basis = vectors
        else:
            raise ArithmeticError(f"{int(inside.sum())} of {count} eigenvalues between {low} and {high}, residual {error}")
        found.append(pairs)
    values, vectors = _ritz(v, np.hstack(found))
    return values[:k], vectors[:, :k]


# --------------------------------------------------------------------------- rows


@dataclass
class Whitening:
    n: int
    dim: int
    sums: list[int]
    values: np.ndarray
    #: dim x components
    vectors: np.ndarray
    trace: float
    #: mean of the centred rows, zero up to rounding
    left: np.ndarray
    identity_error: float | None = None

    @property
    def used(self) -> np.ndarray:
        """Components with variance."""
        top = self.values.max(initial=0.0)
        return self.values > top * self.dim * np.finfo(float).eps

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        part = np.array([s % self.n for s in self.sums], dtype=float) / self.n
        return (x - whole) - part

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(np.where(self.used, self.values, 1.0)))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S)^2 per row."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([s % self.n for s in self.sums], dtype=np.int64)
        away = x - whole
        if self.dim * (self.n * (int(np.abs(away).max(initial=0)) + 1)) ** 2 < 1 << 63:
            return ((self.n * away - rest) ** 2).sum(axis=1).tolist()
        sums = [sum((self.n * a - r) ** 2 for a, r in zip(row, rest.tolist(), strict=True)) for row in away.tolist()]
        return [s if s < 1 << 63 else None for s in sums]


def _blocks(batches: Iterable[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield batch.column(0), batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _integers(df: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """``key, x array<long>`` of the rows that take part, and their dimension."""
    rows = df.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v")).filter(F.col("v").isNotNull())
    rows = rows.filter(F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))))
    dim = rows.agg(F.max(F.size("v")).alias("d")).head()["d"] or 0
    rows = rows.filter(F.size("v") == dim)

    def whole(c):
        return F.floor(F.greatest(F.least(c * SCALE, F.lit(float(_LARGEST))), F.lit(float(-_LARGEST)))) + OFFSET

    return rows.select("key", F.transform("v", whole).alias("x")), dim


def _summed(rows: DataFrame, kind: str, size: int, partial: Callable[[Iterable[pa.RecordBatch]], np.ndarray | None]) -> list | None:
    """One array per task, added up on the executors; the sum comes to the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = partial(batches)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([task_part()], pa.int64()), pa.array([total])], names=["part", "sums"])

    partials = rows.mapInArrow(run, f"part long, sums array<{kind}>")
    merged = merge_arrays(partials, [], ["sums"], parts=rows.rdd.getNumPartitions()).head()
    return None if merged is None else merged["sums"]


def fit(df: DataFrame, *, key: str, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Components over all rows that take part; None without any. The rows are read four times:
    dimension, sums, covariance, and the covariance of what was whitened."""
    rows, dim = _integers(df, key, vector)
    if dim == 0:
        return None

    def first(batches: Iterable[pa.RecordBatch]) -> np.ndarray | None:
        total = None
        for _, x in _blocks(batches, dim):
            # 128-bit sums as two places: entries reach 2^52
            each = np.concatenate(([len(x)], (x >> 26).sum(axis=0), (x & ((1 << 26) - 1)).sum(axis=0)))
            total = each if total is None else total + each
        return total

    sums = _summed(rows, "long", 2 * dim + 1, first)
    if sums is None:
        return None
    n = sums[0]
    made = Whitening(n, dim, [(a << 26) + b for a, b in zip(sums[1 : dim + 1], sums[dim + 1 :], strict=True)], np.zeros(0), np.zeros((dim, 0)), 0.0, np.zeros(dim))

    def products(batches: Iterable[pa.RecordBatch]) -> np.ndarray | None:
        total = None
        for _, x in _blocks(batches, dim):
            y = made.centred(x)
            each = np.concatenate(((y.T @ y).ravel(), y.sum(axis=0)))
            total = each if total is None else total + each
        return total

    found = np.array(_summed(rows, "double", dim * dim + dim, products))
    v, left = found[: dim * dim].reshape(dim, dim) / n, found[dim * dim :] / n
    v = (v + v.T) / 2 - np.outer(left, left)
    made.trace, made.left = float(np.trace(v)), left
    made.values, made.vectors = feast(v, components)
    used = np.flatnonzero(made.used)
    if len(used):
        center = (left @ (made.vectors / np.sqrt(np.where(made.used, made.values, 1.0))))[used]

        def check(batches: Iterable[pa.RecordBatch]) -> np.ndarray | None:
            total = None
            for _, x in _blocks(batches, dim):
                w = made.whitened(x)[:, used] - center
                total = w.T @ w if total is None else total + w.T @ w
            return None if total is None else total.ravel()

        again = np.array(_summed(rows, "double", len(used) ** 2, check)).reshape(len(used), -1) / n
        made.identity_error = float(np.abs(again - np.eye(len(used))).max())
    return made


def apply(df: DataFrame, made: Whitening | None, *, key: str, vector: str = "embedding") -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error``: a row per row and component."""
    schema = "key long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows, _ = _integers(df, key, vector)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(made.values)
        values = np.where(made.used, made.values, 0.0)
        explained = [v / made.trace if made.trace > 0 else None for v in values.tolist()]
        for keys, x in _blocks(batches, made.dim):
            size = len(x) * k
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(keys.to_numpy(zero_copy_only=False), k)) if not keys.null_count else keys.take(pa.array(np.repeat(np.arange(len(x)), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array([made.n] * size, pa.int64()),
                    pa.array([v for v in made.deviations(x) for _ in range(k)], pa.int64()),
                    pa.array(made.whitened(x).ravel(), mask=np.tile(~made.used, len(x))),
                    pa.array(explained * len(x), pa.float64()),
                    pa.array([made.identity_error] * size, pa.float64()),
                ],
                names=[part.split()[0] for part in schema.split(", ")],
            )

    if made is None:
        return rows.sparkSession.createDataFrame([], schema)
    return rows.select(F.col("key").cast("long").alias("key"), "x").mapInArrow(run, schema)
