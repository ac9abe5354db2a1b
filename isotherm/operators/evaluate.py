"""Internal quality of a clustering and the choice of K."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.functions import kernels
from isotherm.operators import kmeans as km
from isotherm.operators.partials import merge_arrays

#: Rows of a block and blocks of a group in the exact silhouette.
BLOCK_ROWS, GROUP_BLOCKS = 2048, 8


def _silhouette_rows(
    df: DataFrame, ids: Sequence[str], labels: Sequence[str], features: str, block_rows: int, group_blocks: int
) -> DataFrame:
    """``_row struct<ids>, labeling, own, silhouette`` for every row and label column.

    Rows are dealt into hashed blocks of about ``block_rows``, each packed into one binary row. A task gets
    one pair of groups of ``group_blocks`` blocks, measures them block against block by matrix products
    and adds the distances up per (row, cluster): what it returns is one array per block, whatever it
    met. So a block travels once per group, and its sums return once per group. Arrays of a block are merged
    in a tree, and scored next to its keys. Several labelings of the same points share the distances.
    """
    rows = df.select(
        F.struct(*ids).alias("_row"),
        F.array(*[F.col(c).cast("long") for c in labels]).alias("labels"),
        F.col(features).cast("array<double>").alias("x"),
    )
    sizes = rows.select(F.posexplode("labels").alias("labeling", "own")).groupBy("labeling", "own").count().collect()
    known = [sorted((r["own"], r["count"]) for r in sizes if r["labeling"] == i) for i in range(len(labels))]
    total = sum(n for _, n in known[0])
    n_blocks = max(1, -(-total // block_rows))
    groups = -(-n_blocks // group_blocks)
    # clusters of all labelings side by side
    values = [np.array([v for v, _ in k], dtype=np.int64) for k in known]
    width = sum(len(v) for v in values)

    row_type = rows.schema["_row"].dataType.simpleString()
    dealt = rows.withColumn("b", F.pmod(F.xxhash64("_row", "x"), F.lit(n_blocks)).cast("int"))

    def pack(where, t):
        """One row per block; every reader finds its rows in the same order."""
        t = t.take(pa.array(np.lexsort((t.column("h2").to_numpy(), t.column("h1").to_numpy()))))
        own = np.stack(t.column("labels").to_pylist()).astype(np.int64) if len(t) else np.zeros((0, len(labels)), np.int64)
        keys = pa.ListArray.from_arrays(pa.array([0, len(t)], pa.int32()), t.column("_row").combine_chunks())
        cells = [pa.array([m.tobytes()], pa.binary()) for m in (own, np.ascontiguousarray(kernels.as_matrix(t.column("x"))))]
        return pa.table([pa.array([where[0].as_py()], pa.int32()), keys, *cells], names=["b", "keys", "own", "x"])

    keyed = dealt.withColumns({"h1": F.xxhash64("_row"), "h2": F.xxhash64("_row", "x", "labels")})
    packed = keyed.groupBy("b").applyInArrow(pack, f"b int, keys array<{row_type}>, own binary, x binary")

    def blocks_of(t: pa.Table) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Number, cluster membership and points of each block; a group without blocks has no columns either."""
        if not t.num_rows:
            return []
        out = []
        for b, own, x in zip(t.column("b"), t.column("own"), t.column("x"), strict=True):
            mine = np.frombuffer(own.as_buffer(), np.int64).reshape(-1, len(labels))
            member, at = np.zeros((len(mine), width)), 0
            for i, v in enumerate(values):
                member[np.arange(len(mine)), at + np.searchsorted(v, mine[:, i])] = 1.0
                at += len(v)
            points = np.frombuffer(x.as_buffer(), np.float64)
            out.append((b.as_py(), member, points.reshape(len(mine), -1)))
        return out

    def measure(where, a, b):
        i, j = (w.as_py() for w in where)
        left = blocks_of(a)
        right = left if i == j else blocks_of(b)
        sums = [np.zeros(member.shape) for _, member, _ in left]
        back = sums if i == j else [np.zeros(member.shape) for _, member, _ in right]
        for p, (_, mine, x) in enumerate(left):
            for q in range(p if i == j else 0, len(right)):
                _, theirs, y = right[q]
                for k in range(0, len(x), 512):
                    gap = kernels.distances(x[k : k + 512], y)
                    sums[p][k : k + 512] += gap @ theirs
                    if i != j or p != q:
                        back[q] += gap.T @ mine[k : k + 512]
        made = [(number, j, part) for (number, _, _), part in zip(left, sums, strict=True)]
        if i != j:
            made += [(number, i, part) for (number, _, _), part in zip(right, back, strict=True)]
        return pa.table(
            [pa.array([b for b, _, _ in made], pa.int32()), pa.array([g for _, g, _ in made], pa.int64()),
             pa.array([part.ravel() for *_, part in made], pa.list_(pa.float64()))],
            names=["b", "part", "sums"],
        )

    bare = packed.select("b", "own", "x", F.expr(f"b div {group_blocks}").cast("int").alias("g"))
    left = bare.withColumns({"i": F.col("g"), "j": F.explode(F.sequence(F.col("g"), F.lit(groups - 1)))})
    again = bare.select(*[F.col(c).alias(c) for c in bare.columns])  # columns of its own, as both sides meet
    right = again.withColumns({"j": F.col("g"), "i": F.explode(F.sequence(F.lit(0), F.col("g")))})
    met = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(measure, "b int, part long, sums array<double>")
    merged = merge_arrays(met, ["b"], ["sums"], parts=groups)

    def score(where, sums, t):
        own = np.frombuffer(t.column("own")[0].as_buffer(), np.int64).reshape(-1, len(labels))
        keys = t.column("keys").combine_chunks().flatten()
        total, at, made = np.array(sums.column("sums")[0].values).reshape(len(own), width), 0, []
        for i, k in enumerate(known):
            size = np.array([n for _, n in k], dtype=float)
            mine, each, rows = np.searchsorted(values[i], own[:, i]), total[:, at : at + len(k)], np.arange(len(own))
            at += len(k)
            a = each[rows, mine] / np.maximum(size[mine] - 1, 1)
            mean = each / size
            mean[rows, mine] = np.inf
            b = mean.min(axis=1, initial=np.inf)
            top = np.maximum(a, np.where(np.isfinite(b), b, 0))
            fit = (size[mine] > 1) & np.isfinite(b) & (top > 0)
            value = np.where(fit, (np.where(np.isfinite(b), b, 0) - a) / np.where(top > 0, top, 1), 0.0)
            made.append(pa.table([keys, np.full(len(own), i, np.int32), own[:, i], value], names=["_row", "labeling", "own", "silhouette"]))
        return pa.concat_tables(made)

    return merged.groupBy("b").cogroup(packed.groupBy("b")).applyInArrow(
        score, f"_row {row_type}, labeling int, own long, silhouette double"
    )


def silhouette_samples(
    df: DataFrame, *, ids: Sequence[str], label: str = "cluster", features: str = "features", block_rows: int = BLOCK_ROWS,
    group_blocks: int = GROUP_BLOCKS,
) -> DataFrame:
    """Exact Euclidean silhouette per row, for any number of rows: ``*ids, cluster, silhouette``.

    The arithmetic is quadratic by nature, memory and task size do not grow; where that
    cost is too high use :func:`silhouette_squared`. ``ids`` must be a row key.
    """
    scored = _silhouette_rows(df, ids, [label], features, block_rows, group_blocks)
    return scored.select("_row.*", F.col("own").cast("int").alias("cluster"), "silhouette")


def silhouette(df: DataFrame, *, label: str = "cluster", **options) -> DataFrame:
    """Mean Euclidean silhouette: one row."""
    return silhouette_many(df, labels=[label], **options).select("silhouette")


def silhouette_many(
    df: DataFrame, *, ids: Sequence[str], labels: Sequence[str], features: str = "features", block_rows: int = BLOCK_ROWS,
    group_blocks: int = GROUP_BLOCKS,
) -> DataFrame:
    """Mean Euclidean silhouette of several label columns: ``labeling, silhouette``."""
    scored = _silhouette_rows(df, ids, labels, features, block_rows, group_blocks)
    return scored.groupBy("labeling").agg(F.avg("silhouette").alias("silhouette"))


def silhouette_squared(df: DataFrame, *, label: str = "cluster", features: str = "features") -> DataFrame:
    """Mean silhouette under squared Euclidean distance, linear in the rows.

    The mean squared distance to a cluster follows from its size, mean and mean squared
    norm, so one pass builds K rows and a last one scores. Points are taken relative to their
    overall mean, found by a first pass, or squares of a common offset would drown the spread.
    """
    rows = df.select(
        F.col(label).cast("long").alias("own"), F.col(features).cast("array<double>").alias("x")
    )
    whole = km.centroid_update(rows.select(F.lit(0).alias("own"), "x"), label="own", features="x", d2=None).collect()
    if whole:
        center = F.array(*[F.lit(float(v)) for v in whole[0]["centroid"]])
        rows = rows.withColumn("x", F.zip_with("x", center, lambda v, m: v - m))
    spread = F.aggregate("x", F.lit(0.0), lambda t, v: t + v * v)
    stats = km.centroid_update(rows.withColumn("q", spread), label="own", features="x", d2="q").collect()
    stats.sort(key=lambda r: r["cluster"])
    labels = np.array([r["cluster"] for r in stats])
    sizes = np.array([r["n"] for r in stats], dtype=float)
    means = np.array([r["centroid"] for r in stats])
    scatter = np.array([r["cost"] for r in stats]) / sizes - (means**2).sum(axis=1)

    @F.arrow_udf("double")
    def score(own: pa.Array, x: pa.Array) -> pa.Array:
        if len(x) == 0:
            return pa.array([], pa.float64())
        points = kernels.as_matrix(x)
        mine = np.searchsorted(labels, own.to_numpy(zero_copy_only=False))
        away = np.stack([((points - m) ** 2).sum(axis=1) for m in means], axis=1) + scatter
        at = np.arange(len(points))
        size = sizes[mine]
        a = away[at, mine] * size / np.maximum(size - 1, 1)
        away[at, mine] = np.inf
        b = away.min(axis=1)
        top = np.maximum(a, b)
        safe = np.where(top > 0, top, 1.0)
        s = np.where((size == 1) | (len(labels) == 1) | (top <= 0), 0.0, (b - a) / safe)
        return pa.array(np.nan_to_num(s))

    return rows.agg(F.avg(score("own", "x")).alias("silhouette"))


def silhouettes_of_centers(blocks: km.PackedPoints, centers: Sequence[np.ndarray], spread: Sequence[km.Scatter]) -> list[float]:
    """Mean squared-distance silhouettes of the assignments to several sets of centers, in one pass
    over the packed points for all of them; ``spread`` is their :func:`kmeans.cluster_scatter`."""

    def fold(points: km.Blocks) -> Iterator[dict]:
        total, n = np.zeros(len(centers)), 0
        for _, x in points:
            n += len(x)
            for run, (c, s) in enumerate(zip(centers, spread, strict=True)):
                if len(s.means) < 2:
                    continue
                mine = np.searchsorted(s.used, kernels.nearest(x, c)[0])
                away = np.stack([((x - m) ** 2).sum(axis=1) for m in s.means], axis=1) + s.variance
                rows, size = np.arange(len(x)), s.sizes[mine]
                own = away[rows, mine] * size / np.maximum(size - 1, 1)
                away[rows, mine] = np.inf
                other = away.min(axis=1)
                top = np.maximum(own, other)
                total[run] += np.where((size > 1) & (top > 0), (other - own) / np.where(top > 0, top, 1.0), 0.0).sum()
        yield {"run": np.arange(len(centers), dtype=np.int32), "total": total, "n": np.full(len(centers), n, np.int64)}

    sums = km.scan(blocks, "run int, total double, n long", fold).groupBy("run")
    rows = sums.agg((F.sum("total") / F.sum("n")).alias("mean")).collect()
    return [v for _, v in sorted((r["run"], r["mean"]) for r in rows)]


def davies_bouldin(df: DataFrame, *, label: str = "cluster", features: str = "features") -> DataFrame:
    """Mean over clusters of the worst (s_i + s_j) / d_ij; only K rows meet."""
    ids, means = km.collect_centroids(
        km.centroid_update(df, label=label, features=features, d2=None)
    )
    order = np.array(ids)

    @F.arrow_udf("double")
    def to_own_mean(own: pa.Array, x: pa.Array) -> pa.Array:
        if len(x) == 0:
            return pa.array([], pa.float64())
        gap = kernels.as_matrix(x) - means[np.searchsorted(order, own.to_numpy(zero_copy_only=False))]
        return pa.array(np.sqrt((gap**2).sum(axis=1)))

    scatter = (
        df.select(
            F.col(label).cast("long").alias("own"),
            to_own_mean(F.col(label).cast("long"), F.col(features).cast("array<double>")).alias("away"),
        )
        .groupBy("own")
        .agg(F.avg("away").alias("s"))
    )
    s = {r["own"]: r["s"] for r in scatter.collect()}
    value = _davies_bouldin(means, np.array([s[i] for i in ids]))
    return df.sparkSession.createDataFrame([(value,)], "davies_bouldin double")


def _davies_bouldin(means: np.ndarray, scatter: np.ndarray) -> float:
    if len(means) < 2 or np.allclose(scatter, 0):
        return 0.0
    between = kernels.distances(means, means)
    ratio = (scatter[:, None] + scatter) / np.where(between > 0, between, np.inf)
    np.fill_diagonal(ratio, -np.inf)
    return float(ratio.max(axis=1).mean())


def k_sweep(
    points: DataFrame,
    *,
    ids: Sequence[str],
    features: str = "features",
    k_range: Sequence[int] = tuple(range(3, 16)),
    n_init: int = 20,
    max_iter: int = 300,
    tol: float = km.TOL,
    seed: int = km.SEED,
    measure: str = "squared",
) -> DataFrame:
    """``k, inertia, silhouette, davies_bouldin`` per K.

    Restarts of all K run side by side: one pass over the cached points per round serves
    as many runs as fit the partial-sum limit. ``measure`` picks the squared silhouette (linear,
    one pass for all K) or the exact Euclidean one (quadratic, for tables of locations).
    """
    if measure not in ("euclidean", "squared"):
        raise ValueError(f"unknown measure {measure!r}")
    seeds = km.restart_seeds(n_init, seed)
    with km.CachedPoints(points, ids=ids, features=features) as blocks:
        runs = [(k, s) for k in k_range for s in seeds]
        starts = km.parallel_init(blocks, [k for k, _ in runs], [s for _, s in runs])
        fits: list[km.Fit] = []
        for group in km.fused_groups(starts):
            fits += km.lloyd_blocks(
                blocks,
                [starts[i] for i in group],
                max_iter=max_iter,
                tol=tol,
                seeds=[runs[i][1] for i in group],
            )
        best = [km.best_of(fits[i * n_init : (i + 1) * n_init]) for i in range(len(k_range))]
        centers = [f.centroids for f in best]
        spread = km.cluster_scatter(blocks, centers)
        scores = dict(enumerate(silhouettes_of_centers(blocks, centers, spread))) if measure == "squared" else {}
    if measure == "euclidean":
        labelled = km.assign_many(points, centers, features=features)
        rows = silhouette_many(labelled, ids=ids, labels=[f"cluster{i}" for i in range(len(centers))], features=features).collect()
        scores = {r["labeling"]: r["silhouette"] for r in rows}
    out = [
        (int(k), f.cost, scores[i], _davies_bouldin(spread[i].means, spread[i].away))
        for i, (k, f) in enumerate(zip(k_range, best, strict=True))
    ]
    return points.sparkSession.createDataFrame(
        out, "k int, inertia double, silhouette double, davies_bouldin double"
    )


def select_k(
    metrics: DataFrame, *, metric: str = "silhouette", k: str = "k", largest: bool = True
) -> DataFrame:
    """Best K (ties to the smallest) and whether it sits on the edge of the sweep."""
    score = -F.col(metric) if largest else F.col(metric)
    best = metrics.agg(
        F.min(F.struct(score.alias("s"), F.col(k).cast("int").alias("k"))).alias("best"),
        F.min(k).alias("lo"),
        F.max(k).alias("hi"),
    )
    value = -F.col("best.s") if largest else F.col("best.s")
    return best.select(
        F.col("best.k").alias("optimal_k"),
        value.alias("score"),
        ((F.col("best.k") == F.col("lo")) | (F.col("best.k") == F.col("hi"))).alias("at_boundary"),
    )


def kmeans_final(
    points: DataFrame,
    metrics: DataFrame,
    *,
    ids: Sequence[str],
    features: str = "features",
    k: int | None = None,
    n_init: int = 50,
    max_iter: int = 500,
    seed: int = km.SEED,
) -> km.Fit:
    """Final model at the K with the best silhouette, or at a pinned K."""
    chosen = k if k is not None else select_k(metrics).head()["optimal_k"]
    return km.kmeans(
        points, chosen, ids=ids, features=features, n_init=n_init, max_iter=max_iter, seed=seed
    )


def metrics_row(metrics: DataFrame) -> DataFrame:
    """The sweep as one row of arrays, the shape of the metrics file: the K of the largest silhouette, that of the
    smallest Davies-Bouldin index beside it, and whether the first sits on the edge of the sweep."""
    ordered = F.array_sort(
        F.collect_list(F.struct("k", "inertia", "silhouette", "davies_bouldin"))
    )
    return metrics.agg(ordered.alias("m")).select(
        F.col("m.k").alias("k_range"),
        F.col("m.inertia").alias("inertias"),
        F.col("m.silhouette").alias("silhouettes"),
        F.col("m.davies_bouldin").alias("davies_bouldin"),
        select_k(metrics).select("optimal_k").scalar().alias("optimal_k"),
        select_k(metrics, metric="davies_bouldin", largest=False).select("optimal_k").scalar().alias("optimal_k_davies_bouldin"),
        select_k(metrics).select("at_boundary").scalar().alias("at_boundary"),
    )
