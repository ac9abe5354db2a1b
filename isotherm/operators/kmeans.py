"""K-means as Spark jobs.

Points are packed once into blocks (one row per Arrow batch) and cached; every round is
one job in which a task reduces its blocks to one row per restart and non-empty cluster, an array of
sums; the executors add these up where they are many, and K x d numbers return to the driver. Sums are
kept in places that add exactly (:func:`isotherm.functions.kernels.quanta`), so a round gives the
same bits however the points are partitioned. For the same reason a round after the first
needs only what the points that changed clusters take along. All restarts share a pass, in which a centroid that
several of them have is measured once.
Only centroids cross rounds, so the lineage of the points never grows and a lost executor
costs no more than the recomputation of its blocks.

Late rounds move centroids little. On request, labels and distance bounds of one round, kept beside the points,
settle most points by the triangle inequality, and as sums add exactly, a round only
adds what moved to the sums of that round (:class:`Bounds`). The result is the same to the bit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from isotherm.functions import kernels
from isotherm.functions.exprs import hash_bits, hash_uniform, squared_distance
from isotherm.operators.partials import FAN, add_rows, merge_arrays, task_part

# Defaults of the two published variants.
K, SEED, SEED_STEP, ROUND_STEP = 14, 42, 7919, 977
MAX_ITER, TOL, N_INIT = 50, 1e-4, 10
INIT_ROUNDS, OVERSAMPLE = 2, 2.0
RANDOM_TOL, RANDOM_N_INIT = 0.01, 3

#: The round whose labels later rounds start from, and how often all points may be measured in sum before they are taken anew.
BOUNDS_FROM, BOUNDS_REFRESH = 3, 1.0
_BOUND_BYTES = 10  # a point and run

#: Bytes of partial sums that a round may hand to the driver as the tasks emit them; more are added up on the executors.
DIRECT_BYTES = 1 << 18
_SHARD_BYTES, _SHARDS = 1 << 22, 64

_PARTIAL = "run int, cluster int, part long, sums array<double>"

Blocks = Iterator[tuple[np.ndarray, np.ndarray]]


# --------------------------------------------------------------------------- packing


class PackedPoints:
    """Blocks of points and the number of tasks that scan them."""

    def __init__(self, df: DataFrame) -> None:
        self.df = df

    @cached_property
    def tasks(self) -> int:
        return self.df.rdd.getNumPartitions()

    @cached_property
    def extent(self) -> tuple[int, float]:
        """Number of points and their largest coordinate in size, by one pass."""

        def fold(points: Blocks) -> Iterator[dict]:
            n, most = 0, 0.0
            for _, x in points:
                n, most = n + len(x), max(most, float(np.abs(x).max(initial=0.0)))
            yield {"n": pa.array([n], pa.int64()), "most": [most]}

        row = scan(self, "n long, most double", fold).agg(F.sum("n").alias("n"), F.max("most").alias("most")).head()
        return row["n"] or 0, row["most"] or 0.0


def pack_points(points: DataFrame, *, ids: Sequence[str], features: str = "features") -> PackedPoints:
    """``h binary, x binary, d int``: row hashes and vectors of one Arrow batch per row.

    ``ids`` is the row key; its hash drives every random choice, so results do not depend
    on partitioning.
    """

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = np.ascontiguousarray(kernels.as_matrix(batch.column(1)))
            h = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([h.tobytes()], pa.binary()),
                    pa.array([x.tobytes()], pa.binary()),
                    pa.array([x.shape[1]], pa.int32()),
                ],
                names=["h", "x", "d"],
            )

    source = points.select(
        hash_bits(*ids).alias("h"), F.col(features).cast("array<double>").alias("x")
    )
    return PackedPoints(source.mapInArrow(pack, "h binary, x binary, d int"))


def _unpack(batches: Iterable[pa.RecordBatch]) -> Blocks:
    for batch in batches:
        for h, x, d in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
            yield (
                np.frombuffer(h.as_buffer(), dtype=np.int64),
                np.frombuffer(x.as_buffer(), dtype=np.float64).reshape(-1, d.as_py()),
            )


def scan(blocks: PackedPoints, schema: str, fold: Callable[[Blocks], Iterable[dict]]) -> DataFrame:
    """One pass in which ``fold`` turns the blocks of a task into a few column batches."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in fold(_unpack(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(out[n]) for n in names], names=names)

    return blocks.df.mapInArrow(run, schema)


# --------------------------------------------------------------------------- passes


def _steps(blocks: PackedPoints, centers: Sequence[np.ndarray], vectors: bool) -> tuple[list[float], list[float]]:
    """Places of the coordinate sums and of the cost."""
    n, most = blocks.extent
    d = max((c.shape[1] for c in centers), default=0)
    reach = most + max((float(np.abs(c).max(initial=0.0)) for c in centers), default=0.0)
    return kernels.quanta(most, n) if vectors else [], kernels.quanta(2 * d * reach * reach, n)


def partial_sums(blocks: PackedPoints, centers: Sequence[np.ndarray], *, vectors: bool = True) -> DataFrame:
    """Map side of a round: one row per task, run and non-empty cluster. ``sums`` holds the vector sum in
    its places (unless ``vectors`` is off), the cost in its places and the count."""
    centers = [np.asarray(c, dtype=float) for c in centers]
    steps, cost_steps = _steps(blocks, centers, vectors)

    rows, sets = kernels.shared_rows(centers)

    def fold(points: Blocks) -> Iterator[dict]:
        totals = [np.zeros((len(c), c.shape[1] * len(steps) + len(cost_steps) + 1)) for c in centers]
        for _, x in points:
            split = kernels.places(x, steps)
            split = np.hstack(split) if split else x[:, :0]
            for c, best, total in zip(centers, kernels.nearest_many(x, rows, sets), totals, strict=True):
                if steps:
                    total[:, : split.shape[1]] += kernels.moved_sums(split, best, None, len(c))
                for i, price in enumerate(kernels.places(kernels.squared_gaps(x, c, best), cost_steps)):
                    total[:, split.shape[1] + i] += np.bincount(best, weights=price, minlength=len(c))
                total[:, -1] += np.bincount(best, minlength=len(c))
        for run, total in enumerate(totals):
            used = np.flatnonzero(total[:, -1])
            if len(used):
                yield {
                    "run": np.full(len(used), run, dtype=np.int32),
                    "cluster": used.astype(np.int32),
                    "part": np.full(len(used), task_part(), dtype=np.int64),
                    "sums": list(total[used]),
                }

    return scan(blocks, _PARTIAL, fold)


def _added_up(blocks: PackedPoints, partials: DataFrame, shapes: Sequence[tuple[int, int]], emitted: int | None = None) -> list[np.ndarray]:
    """Sums of the partials of every run, clusters x width. Tasks emit at most one row per run and cluster, about
    ``emitted`` where that is known. Beyond ``DIRECT_BYTES`` of all tasks the executors add them up, so one row per run and cluster returns."""
    offsets = np.concatenate([[0], np.cumsum([n for n, _ in shapes])]).astype(np.int64)
    width = max((w for _, w in shapes), default=0)
    size = 8 * width * blocks.tasks * (int(offsets[-1]) if emitted is None else emitted)
    if blocks.tasks > 1 and size > DIRECT_BYTES:
        partials = add_rows(partials, ["run", "cluster"], "sums", shards=min(_SHARDS, 1 + size // _SHARD_BYTES))
    rows = partials.toArrow()
    total = np.zeros((int(offsets[-1]), width))
    if rows.num_rows:
        at = offsets[rows.column("run").to_numpy()] + rows.column("cluster").to_numpy()
        np.add.at(total, at, rows.column("sums").combine_chunks().flatten().to_numpy().reshape(len(at), width))
    return np.split(total, offsets[1:-1])


class Moves:
    """Vector sums of every run in their places, with the counts behind them, and the centroids they belong to.

    A later round measures the points against these and the new centroids, and a task emits only
    what points that changed clusters add and take away, so late rounds emit little. The sums are those of a full round, to the bit.
    """

    def __init__(self, blocks: PackedPoints) -> None:
        self.blocks, self.before, self.totals = blocks, {}, {}
        self.emitted: int | None = None

    def round(self, runs: Sequence[int], centers: Sequence[np.ndarray], raw: list) -> list[tuple[np.ndarray, np.ndarray]]:
        """Vector sums and counts of every run; ``raw`` takes the vector sums in their places, with the counts behind them."""
        later = [i for i, r in enumerate(runs) if r in self.before]
        steps, _ = _steps(self.blocks, centers, True)
        rows, sets = kernels.shared_rows([*centers, *[self.before[runs[i]] for i in later]])
        first, old = [i for i in range(len(runs)) if runs[i] not in self.before], sets[len(centers) :]
        shapes = [(len(c), rows.shape[1] * len(steps) + 1) for c in centers]

        def fold(points: Blocks) -> Iterator[dict]:
            totals = [np.zeros(shape) for shape in shapes]
            for _, x in points:
                split = np.hstack([*kernels.places(x, steps), np.ones((len(x), 1))])
                if first:
                    for i, now in zip(first, kernels.nearest_many(x, rows, [sets[i] for i in first]), strict=True):
                        totals[i] += kernels.moved_sums(split, now, None, len(totals[i]))
                for j, at, was, now in kernels.relabelled(x, rows, old, [sets[i] for i in later]) if later else ():
                    totals[later[j]] += kernels.moved_sums(split[at], now, was, len(totals[later[j]]))
            for run, total in enumerate(totals):
                used = np.flatnonzero(total.any(axis=1))
                if len(used):
                    yield {
                        "run": np.full(len(used), run, dtype=np.int32),
                        "cluster": used.astype(np.int32),
                        "part": np.full(len(used), task_part(), dtype=np.int64),
                        "sums": list(total[used]),
                    }

        found = _added_up(self.blocks, scan(self.blocks, _PARTIAL, fold), shapes, None if first else self.emitted)
        self.emitted = 2 * sum(int(total.any(axis=1).sum()) for total in found)
        out = []
        for run, c, total in zip(runs, centers, found, strict=True):
            whole = total + self.totals[run] if run in self.totals else total
            self.before[run], self.totals[run] = np.array(c), whole
            raw.append(whole)
            out.append((_whole(whole[:, :-1], len(steps)), whole[:, -1]))
        return out


def _whole(total: np.ndarray, steps: int) -> np.ndarray:
    """Vector sums from their places, the finest first, so that none of it is lost."""
    return sum(reversed(np.split(total, steps, axis=1))) if steps else total[:, :0]


def _round(blocks: PackedPoints, centers: Sequence[np.ndarray], *, vectors: bool = True, seen: Observation | None = None):
    """Reduce side: sums, counts and cost per run. ``seen`` observes the rows the tasks emit."""
    centers = [np.asarray(c, dtype=float) for c in centers]
    partials = partial_sums(blocks, centers, vectors=vectors)
    if seen is not None:
        partials = partials.observe(seen, F.count(F.lit(1)).alias("n_partials"), F.sum(F.element_at("sums", -1)).cast("long").alias("n_points"))
    steps, cost_steps = _steps(blocks, centers, vectors)
    widths = [c.shape[1] * len(steps) for c in centers]
    shapes = [(len(c), w + len(cost_steps) + 1) for c, w in zip(centers, widths, strict=True)]
    out = []
    for total, width in zip(_added_up(blocks, partials, shapes), widths, strict=True):
        cost = sum(reversed([total[:, width + i].sum() for i in range(len(cost_steps))]))
        out.append((_whole(total[:, :width], len(steps)), total[:, -1], float(cost)))
    return out


class Bounds:
    """Labels and distance bounds of every point in one round, cached beside the points.

    With ``moved`` how far each centroid has gone since, a point whose upper bound plus the move of its own
    centroid stays below its lower bound less the largest move of another one, or below half the way from its own to
    the next centroid, keeps its label unmeasured. All later rounds hang on the points and this one round, so the lineage stays two steps deep. Per point
    and run ``_BOUND_BYTES`` are kept, and a second copy of the points.
    """

    def __init__(self, blocks: PackedPoints, runs: Sequence[int], centers: Sequence[np.ndarray], totals: Sequence[np.ndarray]) -> None:
        self.blocks, self.looked = blocks, 0
        self.place = {run: at for at, run in enumerate(runs)}
        self.centers, self.totals = [np.array(c) for c in centers], list(totals)
        centers = self.centers

        def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                near = []
                for _, x in _unpack([batch]):
                    near.append([b"".join(part.tobytes() for part in kernels.bounds(x, c)) for c in centers])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.list_(pa.binary()))], names=["h", "x", "d", "near"])

        self.df = blocks.df.mapInArrow(measure, "h binary, x binary, d int, near array<binary>").persist(StorageLevel.MEMORY_AND_DISK)

    def release(self) -> None:
        self.df.unpersist()

    def round(self, runs: Sequence[int], centers: Sequence[np.ndarray], raw: list) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[int]]:
        """Vector sums and counts of every run, and how many points were measured; ``raw`` takes the vector sums in
        their places, with the counts behind them."""
        places, old = [self.place[r] for r in runs], [self.centers[self.place[r]] for r in runs]
        steps, _ = _steps(self.blocks, centers, True)
        width = [c.shape[1] * len(steps) + 1 for c in centers]
        apart = [kernels.distances(c, c) + np.diag(np.full(len(c), np.inf)) for c in centers]
        half = [a.min(axis=1) / 2 for a in apart]

        def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # one row more than clusters: the points measured
            totals = [np.zeros((len(c) + 1, w)) for c, w in zip(centers, width, strict=True)]
            for batch in batches:
                for (_, x), near in zip(_unpack([batch]), batch.column(3), strict=True):
                    for at, before, c, middle, total in zip(places, old, centers, half, totals, strict=True):
                        held = near[at].as_buffer()
                        n = len(x)
                        label = np.frombuffer(held, np.uint16, n).astype(np.int64)
                        up, low = np.frombuffer(held, np.float32, 2 * n, 2 * n).astype(float).reshape(2, n)
                        moved = np.sqrt(((c - before) ** 2).sum(axis=1))
                        far = int(moved.argmax())
                        others = np.full(len(c), moved[far])
                        others[far] = np.delete(moved, far).max(initial=0.0)
                        safe = np.maximum(low - others[label], middle[label])
                        open_ = np.flatnonzero(~((up + moved[label]) * (1 + 1e-9) < safe))
                        # one distance, to the own centroid, settles many of these
                        gap = x[open_] - c[label[open_]]
                        open_ = open_[~(np.sqrt(np.einsum("ij,ij->i", gap, gap)) * (1 + 1e-9) < safe[open_])]
                        best, _ = kernels.nearest(x[open_], c) if len(open_) else (label[open_], None)
                        total[-1, -1] += len(open_)
                        changed = best != label[open_]
                        if changed.any():
                            rows = open_[changed]
                            split = np.column_stack([*kernels.places(x[rows], steps), np.ones(len(rows))])
                            for sign, owner in ((1, best[changed]), (-1, label[rows])):
                                sums, _ = kernels.group_sums(split, owner, len(c))
                                total[:-1] += sign * sums
            for run, total in enumerate(totals):
                used = np.flatnonzero(total.any(axis=1))
                if len(used):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(used), run, np.int32)), pa.array(used.astype(np.int32)),
                            pa.array(np.full(len(used), task_part(), np.int64)), pa.array(list(total[used])),
                        ],
                        names=["run", "cluster", "part", "sums"],
                    )

        found = _added_up(self.blocks, self.df.mapInArrow(fold, _PARTIAL), [(len(c) + 1, w) for c, w in zip(centers, width, strict=True)])
        out = []
        for at, total in zip(places, found, strict=True):
            whole = self.totals[at] + total[:-1]
            raw.append(whole)
            out.append((_whole(whole[:, :-1], len(steps)), whole[:, -1]))
        looked = [int(total[-1, -1]) for total in found]
        first = self.blocks.extent[0] if self.looked == 0 else 0  # the bounds themselves, taken in this pass
        self.looked += sum(looked) + len(runs)
        return out, [n + first for n in looked]


def _smallest_draws(blocks: PackedPoints, seeds: Sequence[int], k: int) -> list[np.ndarray]:
    """For every seed the k points with the smallest draws: a uniform sample. A task
    returns at most k points per seed."""

    def drawn(seeds: Sequence[int]) -> DataFrame:
        def fold(points: Blocks) -> Iterator[dict]:
            kept: dict = {}
            for h, x in points:
                for run, seed in enumerate(seeds):
                    u, bits, rows = kernels.uniform(h, seed), h, x
                    if run in kept:
                        u, bits, rows = (np.concatenate(p) for p in zip(kept[run], (u, bits, rows), strict=True))
                    # rows that share a key share a draw and count once
                    first = np.unique(bits, return_index=True)[1]
                    first = first[np.lexsort((bits[first], u[first]))[:k]]
                    kept[run] = (u[first], bits[first], rows[first])
            for run, (u, bits, rows) in kept.items():
                yield {"run": np.full(len(u), run, np.int32), "u": u, "h": bits, "x": list(rows)}

        return scan(blocks, "run int, u double, h long, x array<double>", fold)

    if k == 1:
        smallest = drawn(seeds).groupBy("run").agg(F.min(F.struct("u", "h", "x")).alias("s"))
        found = {r["run"]: [r["s"]["x"]] for r in smallest.collect()}
        return [np.array(found[run]) for run in range(len(seeds))]
    return [
        np.array([r["x"] for r in drawn([seed]).dropDuplicates(["h"]).orderBy("u", "h").limit(k).collect()])
        for seed in seeds
    ]


def farthest_in_blocks(blocks: PackedPoints, centers: np.ndarray) -> np.ndarray:
    """The point with the largest distance to its nearest center; the row hash breaks ties."""

    def fold(points: Blocks) -> Iterator[dict]:
        top = None
        for h, x in points:
            _, d2 = kernels.nearest(x, centers)
            i = np.lexsort((h, -d2))[0]
            if top is None or (d2[i], -h[i]) > (top[0], -top[1]):
                top = (d2[i], h[i], x[i])
        if top is not None:
            yield {"d2": [top[0]], "h": [int(top[1])], "x": [top[2]]}

    far = scan(blocks, "d2 double, h long, x array<double>", fold)
    return np.array(far.orderBy(F.desc("d2"), "h").limit(1).head()["x"])


def refill_farthest(blocks: PackedPoints, centers: Sequence[np.ndarray], empty: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Centers of every run with its empty ones moved, in order, to the point then farthest from all.

    One pass for all runs and clusters: tasks keep the points farthest from the centers that stay, which
    no replacement can bring farther away, and the moves are replayed on these. Only where the farthest of them
    is no longer beyond the last one kept, another pass looks among all points.
    """
    centers = [np.array(c, dtype=float) for c in centers]
    stay = [np.delete(c, e, axis=0) for c, e in zip(centers, empty, strict=True)]
    room = 256 + 16 * max(len(e) for e in empty)

    def fold(points: Blocks) -> Iterator[dict]:
        heaps: dict = {}
        for h, x in points:
            for run, c in enumerate(stay):
                d2 = kernels.nearest(x, c)[1] if len(c) else np.full(len(x), np.inf)
                rows = (d2, h, x)
                if run in heaps:
                    rows = tuple(np.concatenate(pair) for pair in zip(heaps[run], rows, strict=True))
                first = np.lexsort((rows[1], -rows[0]))[:room]
                heaps[run] = tuple(part[first] for part in rows)
        for run, (d2, h, x) in heaps.items():
            n = len(d2)
            yield {"run": np.full(n, run, np.int32), "part": np.full(n, task_part(), np.int64), "d2": d2, "h": h, "x": list(x)}

    rows, parts = scan(blocks, "run int, part long, d2 double, h long, x array<double>", fold), blocks.tasks
    while True:  # groups of tasks first, so that no task meets the heaps of all
        rows = rows.withColumn("part", F.floor(F.col("part") / FAN))
        best = Window.partitionBy("run", "part").orderBy(F.desc("d2"), "h")
        rows = rows.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= room).drop("_rank")
        parts = -(-parts // FAN)
        if parts <= 1:
            break
    kept: list[list] = [[] for _ in centers]
    for r in rows.collect():
        kept[r["run"]].append(r)
    for c, holes, mine in zip(centers, empty, kept, strict=True):
        h, x = np.array([r["h"] for r in mine]), np.array([r["x"] for r in mine])
        last = min((r["d2"] for r in mine), default=0.0) if len(mine) >= room else -1.0
        for j in holes:
            d2 = kernels.nearest(x, c)[1]
            top = np.lexsort((h, -d2))[0]
            c[j] = x[top] if d2[top] > last else farthest_in_blocks(blocks, c)
    return centers


def _sample_by_distance(
    blocks: PackedPoints, centers: Sequence[np.ndarray], factors: Sequence[float], seeds: Sequence[int]
) -> list[np.ndarray]:
    """Keep a point with probability ``factor * d2``, for every run in one pass.

    The expected number of points kept is ``oversample * K`` a run, whatever the data size.
    Rows that share a key share a draw; a task returns such a candidate once.
    """

    rows, sets = kernels.shared_rows(centers)

    def fold(points: Blocks) -> Iterator[dict]:
        seen: list[set[int]] = [set() for _ in centers]
        for h, x in points:
            near = kernels.nearest_many(x, rows, sets)
            for run, (c, best, factor, seed) in enumerate(zip(centers, near, factors, seeds, strict=True)):
                d2 = kernels.squared_gaps(x, c, best)
                hit = np.flatnonzero((d2 > 0.0) & (kernels.uniform(h, seed) < factor * d2))
                hit = hit[np.unique(h[hit], return_index=True)[1]]
                hit = hit[[bits not in seen[run] for bits in h[hit].tolist()]] if len(hit) else hit
                if len(hit):
                    seen[run].update(h[hit].tolist())
                    yield {"run": np.full(len(hit), run, np.int32), "h": h[hit], "x": list(x[hit])}

    found = scan(blocks, "run int, h long, x array<double>", fold).collect()
    kept: list[list] = [[] for _ in centers]
    for (run, _), r in sorted({(r["run"], r["h"]): r for r in found}.items()):
        kept[run].append(r["x"])
    return [np.array(x).reshape(-1, centers[0].shape[1]) for x in kept]


# --------------------------------------------------------------------------- init and Lloyd


def parallel_init(
    blocks: PackedPoints,
    k: int | Sequence[int],
    seeds: Sequence[int],
    *,
    rounds: int = INIT_ROUNDS,
    oversample: float = OVERSAMPLE,
) -> list[np.ndarray]:
    """k-means|| starts for all seeds together: two passes per oversampling round and one
    pass for the weights, however many restarts there are. ``k`` may differ per seed."""
    ks = [k] * len(seeds) if isinstance(k, int) else list(k)
    distinct = sorted(set(seeds))
    first = dict(zip(distinct, _smallest_draws(blocks, distinct, 1), strict=True))
    centers = [first[s] for s in seeds]
    live = [True] * len(seeds)
    for number in range(rounds):
        costs = [cost for _, _, cost in _round(blocks, centers, vectors=False)]
        live = [on and cost > 0.0 for on, cost in zip(live, costs, strict=True)]
        runs = [i for i, on in enumerate(live) if on]
        if not runs:
            break
        found = _sample_by_distance(
            blocks,
            [centers[i] for i in runs],
            [oversample * ks[i] / costs[i] for i in runs],
            [seeds[i] + number * ROUND_STEP for i in runs],
        )
        for i, extra in zip(runs, found, strict=True):
            centers[i] = np.vstack([centers[i], extra])
    starts = [pad_candidates(c, n) if len(c) <= n else None for c, n in zip(centers, ks, strict=True)]
    large = [i for i, s in enumerate(starts) if s is None]
    if large:
        for i, (_, counts, _) in zip(large, _round(blocks, [centers[i] for i in large], vectors=False), strict=True):
            starts[i] = kernels.weighted_kmeans(centers[i], counts, ks[i], seeds[i])
    return starts


def pad_candidates(candidates: np.ndarray, k: int) -> np.ndarray:
    """Too few candidates: repeat the last one."""
    return np.vstack([candidates, np.repeat(candidates[-1:], k - len(candidates), axis=0)])[:k]


@dataclass
class Fit:
    centroids: np.ndarray
    cost: float
    iterations: int
    converged: bool
    sizes: np.ndarray
    attempt: int = 0
    seed: int | None = None
    costs: list[float] = field(default_factory=list)
    measured: list[int] = field(default_factory=list)  # points compared with all centroids, by round


def fused_groups(starts: Sequence[np.ndarray], limit: int = 500_000) -> list[list[int]]:
    """Runs that share a pass: consecutive ones while a task emits at most ``limit`` sums of coordinates."""
    groups: list[list[int]] = []
    size = limit + 1
    for i, s in enumerate(starts):
        width = len(s) * (np.shape(s)[1] + 2)
        if size + width > limit:
            groups.append([])
            size = 0
        groups[-1].append(i)
        size += width
    return groups


def lloyd_blocks(
    blocks: PackedPoints,
    starts: Sequence[np.ndarray],
    *,
    max_iter: int = MAX_ITER,
    tol: float | None = TOL,
    empty: str = "farthest",
    seeds: Sequence[int] | None = None,
    keep_costs: bool = False,
    bounds: bool = False,
) -> list[Fit]:
    """Lloyd rounds for several starts at once; a converged run leaves the passes.

    ``empty``: ``farthest`` moves an empty cluster to the point farthest from all current
    centroids (each replacement sees the earlier ones), ``random`` to a random point,
    ``keep`` leaves it. ``tol=None`` disables the early exit. Cost and sizes belong to the
    final centroids. ``bounds`` lets late rounds measure only points whose label may change, where the
    bounds of all runs take no more room than the points; costs of single rounds need them all. It pays
    where K x d is large: it keeps a second copy of the points.
    """
    if empty not in ("farthest", "random", "keep"):
        raise ValueError(f"unknown policy {empty!r}")
    current = [np.array(s, dtype=float) for s in starts]
    iterations, done = [0] * len(current), [False] * len(current)
    trace: list[list[float]] = [[] for _ in current]
    measured: list[list[int]] = [[] for _ in current]
    narrow = all(_BOUND_BYTES * len(current) <= 8 * c.shape[1] and 1 < len(c) < 1 << 16 for c in current)
    held: Bounds | None = None
    moves = Moves(blocks)
    for step in range(1, max_iter + 1):
        runs = [i for i, d in enumerate(done) if not d]
        if not runs:
            break
        centers = [current[i] for i in runs]
        raw: list[np.ndarray] = []
        if held is not None:
            found, looked = held.round(runs, centers, raw)
            for i, n in zip(runs, looked, strict=True):
                measured[i].append(n)
            worn = held.looked > BOUNDS_REFRESH * blocks.extent[0] * len(runs)
        elif not keep_costs:
            found, worn = moves.round(runs, centers, raw), False
            for i, (_, counts) in zip(runs, found, strict=True):
                measured[i].append(int(counts.sum()))
        else:
            rounds = _round(blocks, centers)
            found, worn = [(sums, counts) for sums, counts, _ in rounds], False
            for i, (_, counts, cost) in zip(runs, rounds, strict=True):
                trace[i].append(cost)
                measured[i].append(int(counts.sum()))
        if bounds and narrow and not keep_costs and BOUNDS_FROM <= step <= max_iter - 2 and (held is None or worn):
            if held is not None:
                held.release()
            held = Bounds(blocks, runs, centers, raw)
        updates, holes = {}, {}
        for i, (sums, counts) in zip(runs, found, strict=True):
            used = counts > 0
            updates[i] = np.where(used[:, None], sums / np.where(used, counts, 1.0)[:, None], current[i])
            if empty != "keep" and not used.all():
                holes[i] = np.flatnonzero(~used)
        if holes and empty == "farthest":
            filled = refill_farthest(blocks, [updates[i] for i in holes], list(holes.values()))
            updates |= dict(zip(holes, filled, strict=True))
        elif holes:
            base = {i: seeds[i] if seeds is not None else SEED for i in holes}
            draws = [(i, j, base[i] + 1_000_003 * step + int(j)) for i in holes for j in holes[i]]
            for (i, j, _), point in zip(draws, _smallest_draws(blocks, [d for *_, d in draws], 1), strict=True):
                updates[i][j] = point[0]
        for i in runs:
            shift = np.sqrt(((updates[i] - current[i]) ** 2).sum(axis=1)).max()
            current[i], iterations[i] = updates[i], step
            done[i] = tol is not None and shift < tol
    if held is not None:
        held.release()
    final = _round(blocks, current, vectors=False)
    return [
        Fit(
            c, cost, n, stop, counts.astype(np.int64), attempt=i,
            seed=seeds[i] if seeds is not None else None, costs=t if keep_costs else [], measured=m,
        )
        for i, (c, (_, counts, cost), n, stop, t, m) in enumerate(
            zip(current, final, iterations, done, trace, measured, strict=True)
        )
    ]


class CachedPoints:
    """Packed points, cached for the duration of a fit."""

    def __init__(self, points: DataFrame, *, ids: Sequence[str], features: str = "features") -> None:
        self.blocks = pack_points(points, ids=ids, features=features)

    def __enter__(self) -> PackedPoints:
        self.blocks.df.persist(StorageLevel.MEMORY_AND_DISK)
        return self.blocks

    def __exit__(self, *exc: object) -> None:
        self.blocks.df.unpersist()


def restart_seeds(n_init: int, seed: int = SEED) -> list[int]:
    return [seed + SEED_STEP * attempt for attempt in range(n_init)]


def fit_restarts(
    blocks: PackedPoints,
    k: int = K,
    *,
    n_init: int = N_INIT,
    init: str = "parallel",
    seed: int = SEED,
    max_iter: int = MAX_ITER,
    tol: float | None = TOL,
    empty: str = "farthest",
) -> list[Fit]:
    """All restarts, in attempt order."""
    seeds = restart_seeds(n_init, seed)
    if init == "parallel":
        starts = parallel_init(blocks, k, seeds)
    elif init == "random":
        starts = [pad_candidates(s, k) for s in _smallest_draws(blocks, seeds, k)]
    else:
        raise ValueError(f"unknown init {init!r}")
    return lloyd_blocks(blocks, starts, max_iter=max_iter, tol=tol, empty=empty, seeds=seeds)


def best_of(fits: Sequence[Fit]) -> Fit:
    """Lowest cost, the first of equals."""
    return min(fits, key=lambda f: (f.cost, f.attempt))


def kmeans(points: DataFrame, k: int = K, *, ids: Sequence[str], features: str = "features", **options) -> Fit:
    """Best of ``n_init`` restarts; options as in :func:`fit_restarts`."""
    with CachedPoints(points, ids=ids, features=features) as blocks:
        return best_of(fit_restarts(blocks, k, **options))


def kmeans_random(points: DataFrame, k: int = K, *, ids: Sequence[str], features: str = "features", **options) -> Fit:
    """The variant with uniform starts, a looser tolerance and random re-seeding."""
    settings = {"n_init": RANDOM_N_INIT, "init": "random", "tol": RANDOM_TOL, "empty": "random", **options}
    return kmeans(points, k, ids=ids, features=features, **settings)


def lloyd(
    points: DataFrame,
    centroids: np.ndarray,
    *,
    ids: Sequence[str],
    features: str = "features",
    **options,
) -> Fit:
    """Lloyd from given centroids; options as in :func:`lloyd_blocks`."""
    with CachedPoints(points, ids=ids, features=features) as blocks:
        return lloyd_blocks(blocks, [centroids], **options)[0]


@dataclass(frozen=True)
class Scatter:
    """Non-empty clusters of one set of centers."""

    used: np.ndarray
    means: np.ndarray
    sizes: np.ndarray
    away: np.ndarray  # mean distance of the members to their mean
    variance: np.ndarray  # mean squared distance


def cluster_scatter(blocks: PackedPoints, centers: Sequence[np.ndarray]) -> list[Scatter]:
    """Means, sizes and spread of the clusters of every set of centers. Two passes for all sets together."""
    means = []
    for c, (sums, counts, _) in zip(centers, _round(blocks, centers), strict=True):
        means.append(np.where(counts[:, None] > 0, sums / np.where(counts > 0, counts, 1.0)[:, None], c))

    def fold(points: Blocks) -> Iterator[dict]:
        totals = [np.zeros((len(c), 3)) for c in centers]
        for _, x in points:
            for c, m, total in zip(centers, means, totals, strict=True):
                best, _ = kernels.nearest(x, c)
                away = ((x - m[best]) ** 2).sum(axis=1)
                for column, weights in enumerate((None, np.sqrt(away), away)):
                    total[:, column] += np.bincount(best, weights=weights, minlength=len(c))
        for run, total in enumerate(totals):
            yield {
                "run": np.full(len(total), run, np.int32),
                "cluster": np.arange(len(total), dtype=np.int32),
                "part": np.full(len(total), task_part(), np.int64),
                "sums": list(total),
            }

    rows = merge_arrays(scan(blocks, _PARTIAL, fold), ["run", "cluster"], ["sums"], parts=blocks.tasks).collect()
    out = []
    for run, m in enumerate(means):
        mine = {r["cluster"]: r["sums"] for r in rows if r["run"] == run and r["sums"][0] > 0}
        used = np.array(sorted(mine), dtype=np.int64)
        sizes, away, squares = np.array([mine[j] for j in used]).reshape(-1, 3).T
        out.append(Scatter(used, m[used], sizes, away / sizes, squares / sizes))
    return out


# --------------------------------------------------------------------------- row-level operators


def _nearest_udf(centers: np.ndarray):
    centers = np.asarray(centers, dtype=float)

    @F.arrow_udf("cluster int, d2 double")
    def assign(features: pa.Array) -> pa.Array:
        best, d2 = kernels.nearest(kernels.as_matrix(features), centers) if len(features) else ([], [])
        return pa.StructArray.from_arrays(
            [pa.array(best, pa.int32()), pa.array(d2, pa.float64())], names=["cluster", "d2"]
        )

    return assign


def assign_nearest(
    df: DataFrame, centroids: np.ndarray, *, features: str = "features", cluster: str = "cluster", d2: str = "d2"
) -> DataFrame:
    """Add the nearest centroid and the squared distance to it. K x d numbers travel with
    the task; only the vector column passes through Python."""
    hit = _nearest_udf(centroids)(F.col(features).cast("array<double>"))
    return (
        df.withColumn("_near", hit)
        .withColumns({cluster: F.col("_near.cluster"), d2: F.col("_near.d2")})
        .drop("_near")
    )


def assign_many(
    df: DataFrame, centroids: Sequence[np.ndarray], *, features: str = "features", prefix: str = "cluster"
) -> DataFrame:
    """Nearest centroid under several sets of centroids: ``cluster0``, ``cluster1``, ..."""
    sets = [np.asarray(c, dtype=float) for c in centroids]

    @F.arrow_udf("array<int>")
    def assign(rows: pa.Array) -> pa.Array:
        if len(rows) == 0:
            return pa.array([], pa.list_(pa.int32()))
        x = kernels.as_matrix(rows)
        labels = np.stack([kernels.nearest(x, c)[0] for c in sets], axis=1).astype(np.int32)
        offsets = np.arange(len(labels) + 1, dtype=np.int32) * len(sets)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(labels.ravel()))

    labelled = df.withColumn("_near", assign(F.col(features).cast("array<double>")))
    return labelled.withColumns({f"{prefix}{i}": F.col("_near")[i] for i in range(len(sets))}).drop("_near")


def vector_sums(df: DataFrame, *, label: str = "cluster", features: str = "features", cost: str | None = None) -> DataFrame:
    """``label, sums``: one row per label, its vector sum, count and cost in one array.

    Every task pre-aggregates its rows into one row per label, so a label that holds most rows is no
    hot key; rows of a label are added in the order of the tasks.
    """

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = kernels.as_matrix(batch.column(1))
            values, group = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_inverse=True)
            price = batch.column(2).to_numpy(zero_copy_only=False)
            sums, counts = kernels.group_sums(np.column_stack([x, np.ones(len(x)), price]), group, len(values))
            for value, row in zip(values.tolist(), sums, strict=True):
                totals[value] = totals[value] + row if value in totals else row
        if totals:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.int64()), pa.array([task_part()] * len(totals), pa.int64()), pa.array(list(totals.values()), pa.list_(pa.float64()))],
                names=["label", "part", "sums"],
            )

    price = F.col(cost) if cost else F.lit(0.0)
    source = df.select(
        F.col(label).cast("long").alias("label"),
        F.col(features).cast("array<double>").alias("x"),
        price.cast("double").alias("cost"),
    )
    partials = source.mapInArrow(fold, "label long, part long, sums array<double>")
    return merge_arrays(partials, ["label"], ["sums"], parts=source.rdd.getNumPartitions())


def centroid_update(df: DataFrame, *, label: str = "cluster", features: str = "features", d2: str | None = "d2") -> DataFrame:
    """``cluster, n, cost, centroid array<double>``: merged partials, one row per cluster."""
    rows = vector_sums(df, label=label, features=features, cost=d2)
    n = F.element_at("sums", -2)
    return rows.select(
        F.col("label").cast("int").alias("cluster"),
        n.cast("long").alias("n"),
        F.element_at("sums", -1).alias("cost"),
        F.transform(F.slice("sums", F.lit(1), F.size("sums") - 2), lambda v: v / n).alias("centroid"),
    )


def collect_centroids(centroids: DataFrame) -> tuple[list[int], np.ndarray]:
    """K rows to the driver, in cluster order."""
    rows = sorted(centroids.select("cluster", "centroid").collect(), key=lambda r: r["cluster"])
    return [r["cluster"] for r in rows], np.array([r["centroid"] for r in rows], dtype=float)


def kmeans_cost(df: DataFrame, *, d2: str = "d2") -> DataFrame:
    return df.agg(F.sum(d2).alias("cost"), F.count(F.lit(1)).alias("n_points"))


def farthest_point(df: DataFrame, *, d2: str = "d2", ids: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Row with the largest distance, smallest key first among equals: a one-row top-k."""
    return df.orderBy(F.desc(d2), *ids).limit(1).select(*ids, d2, *keep)


def first_centroids(df: DataFrame, k: int, *, order: Sequence[str], features: str = "features") -> np.ndarray:
    """Deterministic start: the first k vectors by key."""
    rows = df.orderBy(*order).limit(k).select(F.col(features).cast("array<double>").alias("x")).collect()
    return np.array([r["x"] for r in rows], dtype=float)


def dsquared_sample(
    df: DataFrame,
    centroids: np.ndarray,
    k: int,
    *,
    ids: Sequence[str],
    seed: int = SEED,
    oversample: float = OVERSAMPLE,
    features: str = "features",
) -> DataFrame:
    """Bernoulli sample with probability ``min(1, oversample * k * d2 / cost)``."""
    scored = assign_nearest(df, centroids, features=features)
    cost = scored.agg(F.sum("d2").alias("cost")).scalar()
    factor = F.try_divide(F.lit(oversample * k), cost)
    return scored.filter((F.col("d2") > 0) & (hash_uniform(*ids, seed=seed) < factor * F.col("d2")))


def centroid_shift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Largest Euclidean move of a centroid between two K-row tables."""
    both = old.select("cluster", F.col("centroid").alias("a")).join(
        new.select("cluster", F.col("centroid").alias("b")), "cluster"
    )
    return both.agg(F.sqrt(F.max(squared_distance("a", "b"))).alias("shift"))


def partial_record_count(blocks: PackedPoints, centroids: np.ndarray) -> DataFrame:
    """How far one round shrinks: points in, rows that its tasks really emit, counted in the pass itself."""
    seen = Observation()
    _round(blocks, [centroids], seen=seen)
    found = seen.get
    n, rows = found["n_points"] or 0, found["n_partials"]
    return blocks.df.sparkSession.createDataFrame(
        [(n, rows, n / rows if rows else None)], "n_points long, n_partials long, reduction double"
    )


def kmeans_mllib(
    points: DataFrame,
    k: int = K,
    *,
    features: str = "features",
    n_init: int = 1,
    seed: int = SEED,
    max_iter: int = MAX_ITER,
    tol: float = TOL,
) -> tuple[KMeansModel, float, DataFrame]:
    """Spark ML's own k-means with the same number of restarts: model, cost, vectors."""
    vectors = points.withColumn("_v", array_to_vector(F.col(features).cast("array<double>")))
    cached = vectors.select("_v").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        models = [
            KMeans(
                k=k, featuresCol="_v", predictionCol="cluster", initMode="k-means||",
                initSteps=INIT_ROUNDS, maxIter=max_iter, tol=tol, seed=s,
            ).fit(cached)
            for s in restart_seeds(n_init, seed)
        ]
    finally:
        cached.unpersist()
    best = min(models, key=lambda m: m.summary.trainingCost)
    return best, float(best.summary.trainingCost), vectors
