import numpy as np
import pytest
from pyspark.sql import functions as F

from isotherm.functions import kernels
from isotherm.operators import compare as cp
from isotherm.operators import evaluate as ev
from isotherm.operators import kmeans as km
from isotherm.operators import sample as sm


def blobs(k=4, per=60, d=3, seed=0, spread=0.4):
    rng = np.random.default_rng(seed)
    grid = np.stack(np.meshgrid(*[np.arange(3)] * d), -1).reshape(-1, d)[:k] * 10.0
    x = np.repeat(grid, per, axis=0) + rng.normal(size=(k * per, d)) * spread
    return x, np.repeat(np.arange(k), per)


def frame(spark, x, labels=None, parts=3):
    labels = np.zeros(len(x), int) if labels is None else labels
    rows = [(i, int(c), [float(v) for v in row]) for i, (c, row) in enumerate(zip(labels, x))]
    return spark.createDataFrame(rows, "id long, cluster int, features array<double>").repartition(parts)


def lloyd_numpy(x, c, rounds):
    c = c.copy()
    for _ in range(rounds):
        own = ((x[:, None] - c) ** 2).sum(2).argmin(1)
        for j in range(len(c)):
            if (own == j).any():
                c[j] = x[own == j].mean(0)
    return c, float(((x[:, None] - c) ** 2).sum(2).min(1).sum())


def silhouette_numpy(x, own, squared=False):
    d = np.sqrt(((x[:, None] - x) ** 2).sum(2))
    d = d**2 if squared else d
    out = []
    for i in range(len(x)):
        mine = own == own[i]
        if mine.sum() == 1:
            out.append(0.0)
            continue
        a = d[i][mine].sum() / (mine.sum() - 1)
        b = min(d[i][own == j].mean() for j in set(own) if j != own[i])
        out.append((b - a) / max(a, b))
    return np.array(out)


def test_nearest_breaks_ties_to_the_lowest_index():
    x = np.array([[0.0, 0.0], [1.0, 0.0]])
    c = np.array([[1.0, 0.0], [-1.0, 0.0], [1.0, 0.0]])
    best, d2 = kernels.nearest(x, c)
    assert best.tolist() == [0, 0] and d2.tolist() == [1.0, 0.0]
    # far from the origin the norm expansion alone would lose these differences
    x = np.full((1000, 2), 1e7)
    c = np.array([[1e7 + 2e-3, 1e7], [1e7 + 1e-3, 1e7]])
    best, d2 = kernels.nearest(x, c)
    assert (best == 1).all() and np.allclose(d2, 1e-6, rtol=1e-3)


def test_distances_of_equal_rows_are_zero():
    x = np.random.default_rng(0).normal(size=(50, 9)) + 1e4
    d = kernels.distances(x, x)
    assert (np.diag(d) == 0).all()
    assert np.allclose(d, np.sqrt(((x[:, None] - x) ** 2).sum(2)), atol=1e-7)


def test_lloyd_equals_numpy(spark):
    x, _ = blobs(spread=4.0)
    start = x[[0, 5, 100, 150, 200]]
    fit = km.lloyd(frame(spark, x), start, ids=["id"], max_iter=6, tol=None, empty="keep")
    centers, cost = lloyd_numpy(x, start, 6)
    assert np.allclose(fit.centroids, centers) and fit.cost == pytest.approx(cost)
    assert fit.iterations == 6 and not fit.converged and fit.sizes.sum() == len(x)


def test_cost_never_rises_and_belongs_to_final_centroids(spark):
    x, _ = blobs(k=6, spread=5.0)
    with km.CachedPoints(frame(spark, x), ids=["id"]) as blocks:
        fit = km.lloyd_blocks(blocks, [x[:6]], keep_costs=True)[0]
    assert all(b <= a + 1e-9 for a, b in zip(fit.costs, fit.costs[1:]))
    assert fit.cost == pytest.approx(((x[:, None] - fit.centroids) ** 2).sum(2).min(1).sum())


@pytest.mark.parametrize("init", ["parallel", "random"])
@pytest.mark.parametrize("k", [4, 14])
def test_blobs_are_recovered(spark, init, k):
    x, labels = blobs(k=k)
    df = frame(spark, x, labels)
    fit = km.kmeans(df, k, ids=["id"], init=init, n_init=10)
    found = km.assign_nearest(df.select("id", "features"), fit.centroids)
    scores = cp.label_scores(cp.labels_join(df, found, keys=["id"])).head()
    assert scores["ari"] == 1.0 and scores["nmi"] == pytest.approx(1.0)


def test_result_does_not_depend_on_partitions(spark):
    x, _ = blobs(k=9, spread=6.0)
    fits = [km.kmeans(frame(spark, x, parts=p), 7, ids=["id"], n_init=3) for p in (1, 4, 11)]
    for f in fits[1:]:
        assert f.attempt == fits[0].attempt
        assert np.allclose(f.centroids, fits[0].centroids)
    sampled = [
        {r["id"] for r in km.dsquared_sample(frame(spark, x, parts=p), x[:5], 5, ids=["id"]).collect()} for p in (2, 9)
    ]
    assert sampled[0] == sampled[1]


def test_every_bit_is_the_same_for_any_partitioning(spark):
    """Places add exactly, so neither blocks, tasks nor the merge order can show in a result."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((3000, 5)) * 10.0 ** rng.integers(-6, 6, (3000, 1))
    seen = []
    for parts in (1, 4, 40):
        with km.CachedPoints(frame(spark, x, parts=parts), ids=["id"]) as blocks:
            assert blocks.tasks == parts
            rounds = km._round(blocks, [x[:7], x[5:25]])
            fit = km.lloyd_blocks(blocks, [x[:7]], max_iter=4)[0]
        seen.append([(s.tobytes(), n.tobytes(), cost) for s, n, cost in rounds] + [fit.centroids.tobytes(), fit.cost])
    assert seen[0] == seen[1] == seen[2]
    own = ((x[:, None] - x[:7]) ** 2).sum(2).argmin(1)
    sums = np.frombuffer(seen[0][0][0]).reshape(7, 5)
    assert np.allclose(sums, [x[own == j].sum(0) for j in range(7)], rtol=1e-9, atol=1e-9 * np.abs(x).max())


def test_bounds_change_no_bit_and_spare_distances(spark):
    """Overlapping points far from the origin, several runs that converge at different rounds."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((4000, 8)) + 3 * rng.integers(0, 3, (4000, 8)) + 1e4
    seeds = km.restart_seeds(3)
    with km.CachedPoints(frame(spark, x, parts=5), ids=["id"]) as blocks:
        starts = [s for s in km._smallest_draws(blocks, seeds, 9)]
        plain = km.lloyd_blocks(blocks, starts, seeds=seeds, bounds=False, max_iter=40)
        quick = km.lloyd_blocks(blocks, starts, seeds=seeds, bounds=True, max_iter=40)
    for a, b in zip(plain, quick, strict=True):
        assert a.centroids.tobytes() == b.centroids.tobytes() and a.cost == b.cost and a.sizes.tolist() == b.sizes.tolist()
        assert (a.iterations, a.converged) == (b.iterations, b.converged) and len(a.measured) == len(b.measured) == a.iterations
        assert set(a.measured) == {len(x)}
        assert sum(b.measured[5:]) < 0.5 * sum(a.measured[5:])


def test_bounds_hold():
    rng = np.random.default_rng(6)
    for offset in (0.0, 1e6):
        x, c = rng.standard_normal((500, 4)) + offset, rng.standard_normal((7, 4)) + offset
        best, up, low = kernels.bounds(x, c)
        d = np.sqrt(((x[:, None] - c) ** 2).sum(2))
        own = d[np.arange(500), best]
        d[np.arange(500), best] = np.inf
        assert (own <= up).all() and (low <= d.min(1)).all() and np.allclose(up, own, rtol=1e-6)


@pytest.mark.parametrize("copies", [1, 600])
def test_all_empty_clusters_move_in_one_pass(spark, monkeypatch, copies):
    """As if each had its own pass; with many copies of the farthest point the points kept run out and passes follow."""
    x, _ = blobs(k=4, spread=3.0)
    x = np.vstack([x, np.repeat([[90.0, 90.0, 90.0]], copies, axis=0)])
    start = [np.vstack([x[:3], np.full((n, 3), 1e4)]) for n in (1, 4)]
    passes = []
    whole = km.farthest_in_blocks
    with km.CachedPoints(frame(spark, x, parts=6), ids=["id"]) as blocks:
        want = [c.copy() for c in start]
        for c in want:
            for j in range(3, len(c)):
                c[j] = whole(blocks, c)
        monkeypatch.setattr(km, "farthest_in_blocks", lambda *a: passes.append(1) or whole(*a))
        got = km.refill_farthest(blocks, start, [np.arange(3, len(c)) for c in start])
    assert all(a.tobytes() == b.tobytes() for a, b in zip(got, want, strict=True))
    assert bool(passes) == (copies > 1)


def test_places_add_exactly():
    from isotherm.functions import kernels

    rng = np.random.default_rng(4)
    for scale, n in ((1.0, 10), (1e-300, 1000), (1e12, 100_000), (3.7, 1)):
        x = rng.standard_normal(n) * scale
        steps = kernels.quanta(float(np.abs(x).max()), n)
        parts = kernels.places(x, steps)
        for part in parts:
            assert part.sum() == rng.permutation(part).sum() == np.add.reduce(part[::-1])
        assert np.abs(sum(parts) - x).max() <= 2.0**-58 * np.abs(x).max()
    assert kernels.places(np.zeros(3), kernels.quanta(0.0, 3))[0].tolist() == [0.0] * 3


def test_observed_rows_are_those_emitted(spark):
    x, _ = blobs(k=8, per=500)
    with km.CachedPoints(frame(spark, x, parts=4), ids=["id"]) as blocks:
        emitted = km.partial_sums(blocks, [x[:8]]).count()
        row = km.partial_record_count(blocks, x[:8]).head()
        assert (row["n_points"], row["n_partials"], row["reduction"]) == (4000, emitted, 4000 / emitted)


def test_empty_clusters(spark):
    x, _ = blobs(k=2, per=50, d=2)
    start = np.vstack([x[:1], x[60:61], [[500.0, 500.0]], [[600.0, 600.0]]])
    df = frame(spark, x)
    kept = km.lloyd(df, start, ids=["id"], max_iter=1, empty="keep")
    assert kept.centroids[2].tolist() == [500.0, 500.0] and kept.sizes[2] == 0
    moved = km.lloyd(df, start, ids=["id"], max_iter=1, empty="farthest")
    c = start.copy()
    own = ((x[:, None] - c) ** 2).sum(2).argmin(1)
    c[0], c[1] = x[own == 0].mean(0), x[own == 1].mean(0)
    for j in (2, 3):
        c[j] = x[((x[:, None] - c) ** 2).sum(2).min(1).argmax()]
    assert np.allclose(moved.centroids, c)
    random = km.lloyd(df, start, ids=["id"], max_iter=1, empty="random")
    assert all((np.abs(x - random.centroids[j]).sum(1) < 1e-12).any() for j in (2, 3))


def test_too_few_points(spark):
    x = np.array([[0.0, 0.0]] * 5 + [[1.0, 1.0]] * 5)
    with km.CachedPoints(frame(spark, x), ids=["id"]) as blocks:
        starts = km.parallel_init(blocks, 4, [1, 2])
    assert all(s.shape == (4, 2) for s in starts)
    assert km.pad_candidates(np.array([[1.0], [2.0]]), 4).ravel().tolist() == [1.0, 2.0, 2.0, 2.0]


def test_bad_vectors_are_refused(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "id long, features array<double>").coalesce(1)
    with pytest.raises(Exception, match="differ in length"):
        km.lloyd(df, np.zeros((1, 2)), ids=["id"])
    df = spark.createDataFrame([(1, [1.0, float("nan")])], "id long, features array<double>")
    with pytest.raises(Exception, match="NaN"):
        km.lloyd(df, np.zeros((1, 2)), ids=["id"])


def test_weighted_recluster():
    c = np.array([[0.0], [0.1], [10.0], [10.1]])
    out = np.sort(kernels.weighted_kmeans(c, np.array([3.0, 1.0, 1.0, 1.0]), 2, seed=1).ravel())
    assert np.allclose(out, [0.025, 10.05])


def test_uniform_draws():
    u = kernels.uniform(np.arange(100_000), 7)
    assert 0 <= u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.005
    assert abs(np.corrcoef(u, kernels.uniform(np.arange(100_000), 8))[0, 1]) < 0.02


@pytest.mark.parametrize(("block_rows", "group_blocks"), [(2048, 8), (50, 1), (7, 3)])
def test_silhouette(spark, block_rows, group_blocks):
    x, labels = blobs(k=5, per=40, spread=4.0)
    labels = labels.copy()
    labels[0] = 9  # a cluster of one
    df = frame(spark, x, labels)
    want = silhouette_numpy(x, labels)
    got = ev.silhouette_samples(df, ids=["id"], block_rows=block_rows, group_blocks=group_blocks).toPandas().sort_values("id")
    assert np.allclose(got["silhouette"], want)
    assert ev.silhouette(df, ids=["id"], block_rows=block_rows).head()[0] == pytest.approx(want.mean())
    squared = ev.silhouette_squared(df).head()[0]
    far = df.withColumn("features", F.transform("features", lambda v: v + 1e8))
    assert ev.silhouette_squared(far).head()[0] == pytest.approx(squared, abs=1e-5)
    assert squared == pytest.approx(silhouette_numpy(x, labels, squared=True).mean())


def test_silhouette_ships_blocks_not_rows(spark):
    """Every row is shuffled once, when it is packed; then blocks travel, once per group, and arrays per block."""
    rng = np.random.default_rng(2)
    df = frame(spark, rng.standard_normal((4000, 3)), np.arange(4000) % 3)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        scored = ev.silhouette(df, ids=["id"], block_rows=100, group_blocks=10)
        scored.collect()
        plan, rows = [scored._jdf.queryExecution().executedPlan()], []
        while plan:
            node = plan.pop()
            children = node.children()
            plan += [children.apply(i) for i in range(children.size())]
            if node.nodeName() == "Exchange":
                rows.append(node.metrics().apply("shuffleRecordsWritten").value())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    # 40 blocks in 4 groups: a block goes to each group once a side, its sums come back once a group
    assert sorted(r for r in rows if r)[-1] <= 4000 and sum(r for r in rows if r < 4000) <= 4 * 40 * 4


def test_squared_silhouette_equals_spark_ml(spark):
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector

    x, labels = blobs(k=4, spread=3.0)
    df = frame(spark, x, labels)
    ml = ClusteringEvaluator(featuresCol="v", predictionCol="cluster").evaluate(
        df.withColumn("v", array_to_vector("features"))
    )
    assert ev.silhouette_squared(df).head()[0] == pytest.approx(ml)


def test_davies_bouldin(spark):
    x, labels = blobs(k=5, spread=3.0)
    m = np.array([x[labels == j].mean(0) for j in range(5)])
    s = np.array([np.sqrt(((x[labels == j] - m[j]) ** 2).sum(1)).mean() for j in range(5)])
    want = np.mean([max((s[i] + s[j]) / np.sqrt(((m[i] - m[j]) ** 2).sum()) for j in range(5) if j != i) for i in range(5)])
    assert ev.davies_bouldin(frame(spark, x, labels)).head()[0] == pytest.approx(want)


@pytest.mark.parametrize("measure", ["euclidean", "squared"])
def test_sweep_finds_the_blobs(spark, measure):
    x, labels = blobs(k=5)
    df = frame(spark, x, labels).drop("cluster")
    metrics = ev.k_sweep(df, ids=["id"], k_range=range(3, 8), n_init=5, measure=measure)
    best = ev.select_k(metrics).head()
    assert best["optimal_k"] == 5 and not best["at_boundary"]
    assert ev.select_k(metrics, metric="davies_bouldin", largest=False).head()["optimal_k"] == 5
    row = metrics.filter("k = 5").head()
    assert row["silhouette"] == pytest.approx(silhouette_numpy(x, labels, squared=measure == "squared").mean())
    fit = ev.kmeans_final(df, metrics, ids=["id"], n_init=3)
    assert fit.cost == pytest.approx(row["inertia"])
    assert len(ev.kmeans_final(df, metrics, ids=["id"], k=3, n_init=2).centroids) == 3
    wide = ev.metrics_row(metrics).head()
    assert wide["k_range"] == [3, 4, 5, 6, 7] and wide["optimal_k"] == 5


def test_select_k_edges(spark):
    table = spark.createDataFrame([(3, 0.5), (4, 0.7), (5, 0.7)], "k int, silhouette double")
    row = ev.select_k(table).head()
    assert (row["optimal_k"], row["at_boundary"]) == (4, False)
    assert ev.select_k(table.filter("k > 3")).head()["at_boundary"]


def test_points_are_never_collected(spark):
    """A round returns at most K partials a task, whatever the number of points."""
    x, _ = blobs(k=8, per=500)
    with km.CachedPoints(frame(spark, x, parts=4), ids=["id"]) as blocks:
        row = km.partial_record_count(blocks, x[:8]).head()
    assert row["n_points"] == 4000 and row["n_partials"] <= 4 * 8


def test_copies_of_one_row(spark):
    """A third of the rows is one row, copied: starts stay distinct, candidates stay few."""
    x, _ = blobs(k=4, per=50)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(7, [30.0, 30.0, 30.0])] * 100
    df = spark.createDataFrame(rows, "id long, features array<double>").repartition(5)
    with km.CachedPoints(df, ids=["id"]) as blocks:
        (start,) = km._smallest_draws(blocks, [3], 20)
        found = km._sample_by_distance(blocks, [x[:1]], [1e9], [5])[0]
        fit = km.best_of(km.fit_restarts(blocks, 5, n_init=3))
    assert len(np.unique(start, axis=0)) == 20
    assert len(found) <= 200
    assert fit.sizes.sum() == 300 and 100 in fit.sizes


def test_samples(spark, monkeypatch):
    rows = spark.range(495).select("id", (F.col("id") * 2).alias("v"))
    sizes = [sm.fraction_sample(rows, f, ids=["id"]).count() for f in (0.1, 0.25, 0.5)]
    assert sizes == [50, 124, 248]
    big = spark.range(60_000).toDF("id")
    nested = sm.nested_samples(big, [495, 5000, 50_000, None], ids=["id"])
    sets = [{r["id"] for r in df.collect()} for df in nested.values()]
    assert [len(s) for s in sets] == [495, 5000, 50_000, 60_000]
    assert all(a < b for a, b in zip(sets, sets[1:]))
    again = {r["id"] for r in sm.sample_rows(big.repartition(7), 495, ids=["id"]).collect()}
    assert again == sets[0]
    assert sm.sample_rows(big, 0, ids=["id"]).count() == 0
    assert sm.sample_rows(big, 70_000, ids=["id"]).count() == 60_000
    many = sm.fraction_samples(rows, [0.0, 0.1, 0.25, 0.5, 1.0], ids=["id"])
    assert [df.count() for df in many.values()] == [0, 50, 124, 248, 495]
    keys = {r["id"] for r in many[0.25].collect()}
    assert keys == {r["id"] for r in sm.fraction_sample(rows, 0.25, ids=["id"]).collect()}
    jobs = []
    grouped = type(big).groupBy
    monkeypatch.setattr(type(big), "groupBy", lambda self, *c: jobs.append(1) or grouped(self, *c))
    sm.nested_samples(big, [1, 495, 5000, 50_000, 59_999], ids=["id"])
    assert len(jobs) <= 3  # the count and every rank
    monkeypatch.undo()
    twice = big.limit(100).union(big.limit(100)).repartition(3)
    assert sm.sample_rows(twice, 101, ids=["id"]).count() == 101
    assert sm.nested_samples(big.limit(0), [3, None], ids=["id"])[3].count() == 0
    monkeypatch.setattr(sm, "_RANKED", 20)
    assert {r["id"] for r in sm.sample_rows(big, 495, ids=["id"]).collect()} == sets[0]
    with pytest.raises(ValueError, match="row key"):
        sm.sample_rows(big.select(F.lit(1).alias("id")), 10, ids=["id"])


def test_flow_chooses_k(spark):
    """Four groups of locations: without K, the flow sweeps, selects 4 and fits it."""
    from isotherm.plans import climate

    rng = np.random.default_rng(5)
    rows = [(float(i), float(i % 7), *(10.0 * np.array([[0, 0], [0, 1], [1, 0], [1, 1]])[i % 4] + rng.normal(0, 0.2, 2)).tolist()) for i in range(80)]
    table = spark.createDataFrame(rows, "lat double, lon double, a double, b double")
    result = climate.cluster_locations(table, k=None, sweep={"k_range": range(3, 7), "n_init": 2}, n_init=2)
    assert [r["k"] for r in result.metrics.orderBy("k").collect()] == [3, 4, 5, 6]
    groups = {(int(r["lat"]) % 4, r["cluster"]) for r in result.assignments.collect()}
    assert len(result.fit.centroids) == len(groups) == 4


def test_sweep_queries_run_the_whole_range(spark, monkeypatch):
    """k_sweep and kmeans_final call the library with its own settings."""
    from isotherm.operators import evaluate as ev
    from isotherm.plans import catalog_cluster as cc

    calls = []
    monkeypatch.setattr(cc, "_separated", lambda spark, sf: "points")
    monkeypatch.setattr(cc, "_named_by_member", lambda assigned: assigned)
    monkeypatch.setattr(cc.km, "assign_nearest", lambda points, centroids: "assigned")
    monkeypatch.setattr(ev, "k_sweep", lambda points, **options: calls.append(options))
    monkeypatch.setattr(ev, "kmeans_final", lambda points, metrics, **options: calls.append(options) or type("Fit", (), {"centroids": None}))
    cc.k_sweep(spark, "")
    cc.kmeans_final(spark, "")
    assert calls == [{"ids": cc.IDS}] * 3


def test_late_rounds_hand_over_only_what_moved(spark, monkeypatch):
    """Sums of later rounds are those of full rounds to the bit, added up on the executors, one row per cluster."""
    x, _ = blobs(k=6, per=150, d=5, seed=3, spread=3.0)
    x[::7] = np.round(x[::7])  # ties
    returned = []
    added = km.add_rows
    monkeypatch.setattr(km, "DIRECT_BYTES", 0)
    monkeypatch.setattr(km, "add_rows", lambda *a, **b: returned.append(added(*a, **b)) or returned[-1])
    with km.CachedPoints(frame(spark, x, parts=7), ids=["id"]) as blocks:
        moves, current = km.Moves(blocks), [x[:4], x[10:90], np.vstack([x[:3], x[:3]])]
        for _ in range(4):
            raw: list = []
            found = moves.round(range(3), current, raw)
            emitted = returned[-1].count()
            full = km._round(blocks, current)
            for (sums, counts), (sums2, counts2, _) in zip(found, full, strict=True):
                assert np.array_equal(sums, sums2) and np.array_equal(counts, counts2)
            assert emitted <= sum(len(c) for c in current)  # seven tasks, but one row per run and cluster
            current = [np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], c) for (s, n), c in zip(found, current, strict=True)]
        still = moves.round([0, 1, 2], [moves.before[i] for i in range(3)], [])
        assert returned[-1].count() == 0 and np.array_equal(still[0][1], found[0][1])


def test_a_sweep_shares_its_passes():
    """All 260 runs of a sweep over 74 dimensions in one group."""
    assert len(km.fused_groups([np.zeros((k, 74)) for k in range(3, 16) for _ in range(20)])) == 1


def test_nearest_in_many_sets():
    rng = np.random.default_rng(1)
    for d, off in ((3, 0.0), (20, 1e4), (2, 1e7)):
        x = rng.normal(size=(3000, d)) + off
        x[:200] = np.round(x[:200])
        sets = [np.vstack([x[rng.integers(0, 300, k)], x[:2]]) for k in (1, 5, 15, 90)]
        sets[2][4], sets[3][7] = sets[2][1], sets[3][3]
        moved = [np.where(rng.random((len(c), 1)) < 0.3, c + 0.1, c) for c in sets]
        rows, numbers = kernels.shared_rows(sets + moved)
        expected = [kernels.nearest(x, c)[0] for c in sets + moved]
        for got, best in zip(kernels.nearest_many(x, rows, numbers), expected, strict=True):
            assert np.array_equal(got, best)
        labels = [b.copy() for b in expected[:4]]
        for i, at, was, now in kernels.relabelled(x, rows, numbers[:4], numbers[4:]):
            assert np.array_equal(labels[i][at], was) and (was != now).all()
            labels[i][at] = now
        assert all(np.array_equal(a, b) for a, b in zip(labels, expected[4:], strict=True))
