"""Small numpy kernels that run inside Arrow tasks."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

_SLICE = 4096
#: Ranks of centers held at a time, and the size of a set from which on its ranks are gone through by row, not by center.
_RANKS, _MANY = 1 << 22, 64


def as_matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix, without copying when it is float64."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten()
    if column.null_count or flat.null_count:
        raise ValueError("feature vectors must not hold missing values")
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if n and (len(values) % n or np.any(np.diff(column.offsets.to_numpy()) != len(values) // n)):
        raise ValueError("feature vectors differ in length")
    if np.isnan(values).any():
        raise ValueError("feature vectors must not hold NaN")
    return values.reshape(n, -1) if n else values.reshape(0, 0)


def nearest(points: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest center (ties to the lowest) and the squared distance.

    Ranks by the norm expansion (one matrix product), then settles by direct differences
    every row whose two best centers lie within rounding of each other. The returned
    distance always comes from direct differences.
    """
    norms = np.einsum("ij,ij->i", centers, centers)
    rank = points @ (-2.0 * centers.T)
    rank += norms
    best = rank.argmin(axis=1)
    if len(centers) > 1 and len(points):
        scale = np.einsum("ij,ij->i", points, points) + norms.max()
        low = rank[np.arange(len(points)), best]
        close = np.flatnonzero((rank <= (low + 1e-12 * scale)[:, None]).sum(axis=1) > 1)
        for start in range(0, len(close), _SLICE):
            rows = close[start : start + _SLICE]
            exact = np.stack([((points[rows] - c) ** 2).sum(axis=1) for c in centers], axis=1)
            best[rows] = exact.argmin(axis=1)
    gap = points - centers[best]
    return best, np.einsum("ij,ij->i", gap, gap)


def shared_rows(sets: Sequence[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct rows of several sets of centers, and which of them make up each set."""
    at: dict[bytes, int] = {}
    made = [np.array([at.setdefault(row.tobytes(), len(at)) for row in np.asarray(s, dtype=float)]) for s in sets]
    return np.array([np.frombuffer(row) for row in at]), made


class Ranks:
    """Ranks of points by distance to many centers, for sets of these (:func:`shared_rows`); one matrix product.

    The last bits of a rank are given to the number of its center, so that the least and the second
    rank of a set are all that is looked for; where these lie as close as the bits given up, direct differences decide,
    as in :func:`nearest`.
    """

    def __init__(self, rows: np.ndarray) -> None:
        self.rows, self.back, self.norms = rows, -2.0 * rows, np.einsum("ij,ij->i", rows, rows)
        self.number, self.tag = np.arange(len(rows))[:, None], (1 << len(rows).bit_length()) - 1
        self.near = 1e-12 + 2.0 ** (len(rows).bit_length() - 50)
        self.place = np.zeros(self.tag + 1, np.intp)  # scratch: the place of a center in the set at hand
        self.step = min(_SLICE, max(256, _RANKS // max(1, len(rows))))

    def slices(self, points: np.ndarray) -> Iterator[slice]:
        """Takes the points in slices whose ranks fit."""
        size = np.einsum("ij,ij->i", points, points)
        for start in range(0, len(points), self.step):
            part = slice(start, min(start + self.step, len(points)))
            self.x, self.size = points[part], size[part]
            self.rank = self.back @ self.x.T
            self.rank += self.norms[:, None]
            bits = self.rank.view(np.int64)
            bits &= ~self.tag
            bits |= self.number
            yield part

    def least(self, centers: Sequence[int]) -> np.ndarray:
        low = self.rank[centers[0]].copy()
        for j in centers[1:]:
            np.minimum(low, self.rank[j], out=low)
        return low

    def nearest(self, s: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """Index of the nearest center of a set, for the points of the slice or some of them."""
        ranks, x, size = ([self.rank[j] for j in s.tolist()], self.x, self.size) if at is None else (self.rank[s[:, None], at], self.x[at], self.size[at])
        if len(s) > _MANY:
            mine = np.array(ranks)
            low = mine.min(axis=0)
            mine[mine == low] = np.inf
            second = mine.min(axis=0) if len(np.unique(s)) == len(s) else np.full(len(x), -np.inf)  # equal centers are a tie
        else:
            low, second, taller = ranks[0].copy(), np.full(len(x), np.inf), np.empty(len(x))
            for r in ranks[1:]:
                np.maximum(low, r, out=taller)
                np.minimum(second, taller, out=second)
                np.minimum(low, r, out=low)
        self.place[s] = np.arange(len(s))
        best = self.place[low.view(np.int64) & self.tag]
        close = np.flatnonzero(second <= low + self.near * (size + self.norms[s].max()))
        if len(close):
            best[close] = np.stack([((x[close] - self.rows[j]) ** 2).sum(axis=1) for j in s], axis=1).argmin(axis=1)
        return best

    def touched(self, old: np.ndarray, new: np.ndarray) -> np.ndarray | None:
        """Points that may be nearest to a center in which two sets differ; None if all centers do."""
        same = old == new
        if not same.any():
            return None
        moved = np.concatenate([old[~same], new[~same]])
        if not len(moved):
            return np.zeros(0, np.intp)
        slack = self.near * (self.size + max(self.norms[old].max(), self.norms[new].max()))
        return np.flatnonzero(self.least(moved.tolist()) <= self.least(old[same].tolist()) + slack)


def nearest_many(points: np.ndarray, rows: np.ndarray, sets: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Index of the nearest center in each of several sets, as :func:`nearest` finds it; equal sets are settled once."""
    ranks, unlike = Ranks(rows), {s.tobytes(): s for s in sets}
    out = {key: np.zeros(len(points), np.intp) for key in unlike}
    for part in ranks.slices(points):
        for key, s in unlike.items():
            out[key][part] = ranks.nearest(s)
    return [out[s.tobytes()] for s in sets]


def relabelled(points: np.ndarray, rows: np.ndarray, old: Sequence[np.ndarray], new: Sequence[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``number, points, was, now``: for every pair of sets the points whose nearest center is another one.

    Where centers did not move, only points that may be nearest to one that did are looked at.
    """
    ranks = Ranks(rows)
    for part in ranks.slices(points):
        for i, (o, n) in enumerate(zip(old, new, strict=True)):
            at = ranks.touched(o, n)
            if at is not None and not len(at):
                continue
            was, now = ranks.nearest(o, at), ranks.nearest(n, at)
            changed = np.flatnonzero(was != now)
            if len(changed):
                yield i, part.start + (changed if at is None else at[changed]), was[changed], now[changed]


def squared_gaps(points: np.ndarray, centers: np.ndarray, best: np.ndarray) -> np.ndarray:
    """Squared distance of every point to its own center, by direct differences."""
    gap = points - centers[best]
    return np.einsum("ij,ij->i", gap, gap)


def moved_sums(values: np.ndarray, into: np.ndarray, out_of: np.ndarray | None, size: int) -> np.ndarray:
    """Sums by group ``0..size-1`` of rows that enter ``into`` and, where given, leave ``out_of``.
    The values must add exactly (:func:`places`)."""
    if size > _MANY:
        sums = group_sums(values, into, size)[0]
        return sums if out_of is None else sums - group_sums(values, out_of, size)[0]
    sign, at = np.zeros((size, len(values))), np.arange(len(values))
    sign[into, at] = 1.0
    if out_of is not None:
        sign[out_of, at] -= 1.0
    return sign @ values


def bounds(points: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest center, an upper bound of its distance and a lower bound of all others',
    as 16-bit numbers and single precision rounded outwards."""
    best, d2 = nearest(points, centers)
    norms, size = np.einsum("ij,ij->i", centers, centers), np.einsum("ij,ij->i", points, points)
    others = points @ (-2.0 * centers.T) + norms
    others[np.arange(len(points)), best] = np.inf
    low = others.min(axis=1) + size - 1e-11 * (size + norms.max())
    up, low = np.sqrt(d2).astype(np.float32), np.sqrt(np.maximum(low, 0.0)).astype(np.float32)
    return best.astype(np.uint16), np.nextafter(up, np.float32(np.inf)), np.nextafter(low, np.float32(-np.inf))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of a to all rows of b.

    One matrix product; pairs so close that it cancels are measured directly.
    """
    size = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)
    d2 = size - 2.0 * (a @ b.T)
    i, j = np.nonzero(d2 < 1e-5 * size)
    gap = a[i] - b[j]
    d2[i, j] = np.einsum("ij,ij->i", gap, gap)
    return np.sqrt(np.maximum(d2, 0.0))


def group_sums(points: np.ndarray, group: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Vector sum and count per group index ``0..size-1``."""
    counts = np.bincount(group, minlength=size)
    sums = np.zeros((size, points.shape[1]))
    used = counts > 0
    if used.any():
        order = np.argsort(group, kind="stable")
        starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
        sums[used] = np.add.reduceat(points[order], starts[used], axis=0)
    return sums, counts


def quanta(bound: float, n: int, precision: int = 60) -> list[float]:
    """Steps of the places in which up to n values of at most ``bound`` in size are added exactly.

    Sums of n multiples of a step stay whole multiples a double can hold, so their order does not
    matter. Places follow until what is left of a value is 2^-``precision`` of the bound.
    """
    if not bound > 0.0:
        return [1.0]
    room = 52 - max(2, int(n - 1).bit_length())
    top = math.frexp(bound)[1]
    return [math.ldexp(1.0, max(top - room * (i + 1), -1070)) for i in range(max(1, -(-precision // room)))]


def places(values: np.ndarray, steps: list[float]) -> list[np.ndarray]:
    """Values as one array of multiples per step, the coarsest first; what is below the last is dropped."""
    out = []
    for step in steps:
        shift = 1.5 * 2.0**52 * step
        out.append((values + shift) - shift)
        values = values - out[-1]
    return out


def uniform(bits: np.ndarray, seed: int) -> np.ndarray:
    """Uniform draws in [0, 1) from row hashes and a seed (SplitMix64 finaliser).

    Fixed values: the published constants of that generator.
    """
    with np.errstate(over="ignore"):
        z = bits.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def weighted_kmeans(
    candidates: np.ndarray, weights: np.ndarray, k: int, seed: int, max_iter: int = 30
) -> np.ndarray:
    """Weighted k-means++ seeding and weighted Lloyd on a few dozen candidates."""
    rng = np.random.default_rng(seed)

    def draw(mass: np.ndarray) -> int:
        hit = int(np.searchsorted(np.cumsum(mass), rng.random() * mass.sum()))
        return min(hit, len(mass) - 1)

    picked = [draw(weights) if weights.sum() > 0 else 0]
    while len(picked) < k:
        mass = weights * nearest(candidates, candidates[picked])[1]
        picked.append(draw(mass) if mass.sum() > 0 else int(rng.integers(len(candidates))))
    centers = candidates[picked].copy()
    for _ in range(max_iter):
        best, _ = nearest(candidates, centers)
        mass = np.bincount(best, weights=weights, minlength=k)
        sums, _ = group_sums(candidates * weights[:, None], best, k)
        updated = np.where(mass[:, None] > 0, sums / np.where(mass > 0, mass, 1.0)[:, None], centers)
        if np.array_equal(updated, centers):
            break
        centers = updated
    return centers
