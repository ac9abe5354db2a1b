"""Queries: clustering, evaluation, profiles, validation, samples."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.functions.exprs import hash_uniform, settle
from isotherm.operators import compare as cp
from isotherm.operators import evaluate as ev
from isotherm.operators import features as ft
from isotherm.operators import kmeans as km
from isotherm.operators import profile as pf
from isotherm.operators import sample as sm
from isotherm.operators.columns import cluster_results as project_results
from isotherm.operators.columns import resolve_themes
from isotherm.plans import climate
from isotherm.plans.registry import query
from isotherm.plans.standins import (
    DAILY_SQL,
    N_LABELS,
    PARAMS,
    VECTORS_SQL,
    assign_sql,
    daily,
    meteo,
    regime_points,
    solar,
    table,
    update_sql,
    vectors,
)
from isotherm.plans.standins import settle_sql as st

IDS = ("vec_id",)


def _start(points: DataFrame, k: int = N_LABELS) -> np.ndarray:
    return km.first_centroids(points, k, order=IDS)


def _assigned(spark: SparkSession, sf: str) -> DataFrame:
    points = vectors(spark, sf)
    return km.assign_nearest(points, _start(points))


ASSIGNED_SQL = f"WITH {VECTORS_SQL}, {assign_sql('near', 'start')}"

# --- assignment, update, Lloyd


@query(f"{ASSIGNED_SQL} SELECT vec_id, cluster, {st('d2', 6)} AS d2 FROM near")
def assign_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return _assigned(spark, sf).select("vec_id", "cluster", settle("d2", 6).alias("d2"))


_UPDATE_COLUMNS = ", ".join(f"{st(f'c[{i + 1}]', 6)} AS x{i}" for i in range(4))


def _centers(spark: SparkSession, centers: np.ndarray) -> DataFrame:
    """Centroids as rows: cluster, the first four coordinates and the sum over all."""
    rows = [(i, [float(v) for v in c]) for i, c in enumerate(centers)]
    return _center_columns(spark.createDataFrame(rows, "cluster int, centroid array<double>"))


def _center_columns(df: DataFrame, *extra: str) -> DataFrame:
    total = F.aggregate("centroid", F.lit(0.0), lambda t, v: t + v)
    return df.select(
        "cluster",
        *extra,
        *[settle(F.col("centroid")[i], 6).alias(f"x{i}") for i in range(4)],
        settle(total, 6).alias("total"),
    )


@query(f"""{ASSIGNED_SQL}, {update_sql('upd', 'near')}, m AS (SELECT cluster, count(*) AS n, {st('sum(d2)', 5)} AS cost FROM near GROUP BY cluster)
SELECT cluster, n, cost, {_UPDATE_COLUMNS}, {st('list_sum(c)', 6)} AS total FROM upd JOIN m USING (cluster)""")
def centroid_update(spark: SparkSession, sf: str) -> DataFrame:
    updated = km.centroid_update(_assigned(spark, sf)).withColumn("cost", settle("cost", 5))
    return _center_columns(updated, "n", "cost")


@query(f"{ASSIGNED_SQL} SELECT {st('sum(d2)', 4)} AS cost, count(*) AS n_points FROM near")
def kmeans_cost(spark: SparkSession, sf: str) -> DataFrame:
    return km.kmeans_cost(_assigned(spark, sf)).withColumn("cost", settle("cost", 4))


@query(f"{ASSIGNED_SQL} SELECT vec_id, {st('d2', 6)} AS d2, label FROM near ORDER BY near.d2 DESC, vec_id LIMIT 1")
def farthest_point(spark: SparkSession, sf: str) -> DataFrame:
    far = km.farthest_point(_assigned(spark, sf), ids=IDS, keep=("label",))
    return far.withColumn("d2", settle("d2", 6))


@query(f"""{ASSIGNED_SQL}, {update_sql('upd', 'near')}
SELECT {st('max(list_distance(s.c, u.c))', 6)} AS shift FROM start s JOIN upd u USING (cluster)""")
def centroid_shift(spark: SparkSession, sf: str) -> DataFrame:
    points = vectors(spark, sf)
    start = _start(points)
    old = spark.createDataFrame(
        [(i, [float(v) for v in c]) for i, c in enumerate(start)], "cluster int, centroid array<double>"
    )
    new = km.centroid_update(km.assign_nearest(points, start))
    return km.centroid_shift(old, new).select(settle("shift", 6).alias("shift"))


def _lloyd_sql(rounds: int, start: str = "start") -> str:
    parts, centers = [], start
    for i in range(rounds):
        parts += [assign_sql(f"near{i}", centers), update_sql(f"upd{i}", f"near{i}", centers)]
        centers = f"upd{i}"
    return ", ".join(parts)


@query(f"""WITH {VECTORS_SQL}, {_lloyd_sql(3)}
SELECT cluster, {_UPDATE_COLUMNS}, {st('list_sum(c)', 6)} AS total FROM upd2""")
def kmeans_lloyd3(spark: SparkSession, sf: str) -> DataFrame:
    points = vectors(spark, sf)
    fit = km.lloyd(points, _start(points), ids=IDS, max_iter=3)
    return _centers(spark, fit.centroids)


@query(f"""WITH {VECTORS_SQL}, {_lloyd_sql(7)}
SELECT cluster, {_UPDATE_COLUMNS}, {st('list_sum(c)', 6)} AS total FROM upd6""")
def kmeans_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Seven rounds, the last ones by distance bounds."""
    points = vectors(spark, sf)
    fit = km.lloyd(points, _start(points), ids=IDS, max_iter=7, tol=None, empty="keep", bounds=True)
    return _centers(spark, fit.centroids)


_REGIME_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_REGIME_SQL = f"""s AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _MEASURES)} FROM lineitem),
z AS (SELECT {", ".join(_REGIME_KEYS)}, {", ".join(f"({c} - m_{c}) / s_{c} AS z{i}" for i, c in enumerate(_MEASURES))} FROM lineitem, s),
pts AS (SELECT row_number() OVER (ORDER BY {", ".join(_REGIME_KEYS)}) AS vec_id, 0 AS label,
  [z0, z1, z2, z3, {", ".join(f"z{i} * z{j}" for i in range(4) for j in range(i, 4))}] AS x FROM z),
start AS (SELECT CAST(vec_id - 1 AS INT) AS cluster, x AS c FROM pts WHERE vec_id <= 14)"""


@query(f"""WITH {_REGIME_SQL}, {_lloyd_sql(3)}
SELECT cluster, {", ".join(f"{st(f'c[{i + 1}]', 5)} AS x{i}" for i in range(4))} FROM upd2""")
def regime_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """All daily rows as points in 14 dimensions, K=14: three rounds from the first 14 keys."""
    points = regime_points(spark, sf)
    start = km.first_centroids(points, km.K, order=_REGIME_KEYS)
    fit = km.lloyd(points, start, ids=_REGIME_KEYS, max_iter=3, tol=None, empty="keep")
    rows = [(i, *[float(v) for v in c[:4]]) for i, c in enumerate(fit.centroids)]
    out = spark.createDataFrame(rows, "cluster int, " + ", ".join(f"x{i} double" for i in range(4)))
    return out.withColumns({f"x{i}": settle(f"x{i}", 5) for i in range(4)})


_ZSCORED_SQL = f"""s AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _MEASURES)} FROM lineitem),
pts AS (SELECT row_number() OVER (ORDER BY {", ".join(_REGIME_KEYS)}) AS vec_id, 0 AS label,
  [{", ".join(f"({c} - m_{c}) / s_{c}" for c in _MEASURES)}] AS x FROM lineitem, s),
start AS (SELECT CAST(vec_id - 1 AS INT) AS cluster, x AS c FROM pts WHERE vec_id <= 14)"""


@query(f"""WITH {_ZSCORED_SQL}, {_lloyd_sql(3)}, {assign_sql('fin', 'upd2')}
SELECT cluster AS regime, count(*) AS n_rows, {st('sum(d2)', 3)} AS cost FROM fin GROUP BY cluster""")
def regime_flow(spark: SparkSession, sf: str) -> DataFrame:
    """Daily rows standardised, reduced and clustered. All components are kept, a rotation, which
    leaves distances as they were: sizes and costs of the regimes are those of the standardised rows."""
    rows = table(spark, sf, "lineitem").select(*_REGIME_KEYS, *_MEASURES)
    regimes = climate.daily_regimes(rows, _MEASURES, keys=_REGIME_KEYS, components=len(_MEASURES))
    start = km.first_centroids(regimes, km.K, order=_REGIME_KEYS)
    named, _ = climate.regime_clusters(regimes, keys=_REGIME_KEYS, start=start, max_iter=3, tol=None, empty="keep")
    return named.groupBy("regime").agg(F.count(F.lit(1)).alias("n_rows"), settle(F.sum("d2"), 3).alias("cost"))


_FAR = 100.0


@query(f"""WITH {VECTORS_SQL}, begin AS (SELECT cluster, CASE WHEN cluster < 8 THEN c ELSE list_transform(c, lambda v: {_FAR}e0) END AS c FROM start),
{_lloyd_sql(4, 'begin')}
SELECT cluster, {_UPDATE_COLUMNS}, {st('list_sum(c)', 6)} AS total FROM upd3""")
def kmeans_fixed_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """Fixed rounds without early exit; two starts lie far out and stay there, empty."""
    points = vectors(spark, sf)
    start = _start(points)
    start[8:] = _FAR
    fit = km.lloyd(points, start, ids=IDS, max_iter=4, tol=None, empty="keep")
    return _centers(spark, fit.centroids)


@query(f"""WITH {VECTORS_SQL}, begin AS (SELECT cluster, CASE WHEN cluster < 8 THEN c ELSE list_transform(c, lambda v: {_FAR}e0) END AS c FROM start),
{_lloyd_sql(1, 'begin')},
{assign_sql('a8', 'upd0')}, f8 AS (SELECT x FROM a8 ORDER BY d2 DESC, vec_id LIMIT 1),
one AS (SELECT cluster, CASE WHEN cluster = 8 THEN (SELECT x FROM f8) ELSE c END AS c FROM upd0),
{assign_sql('a9', 'one')}, f9 AS (SELECT x FROM a9 ORDER BY d2 DESC, vec_id LIMIT 1),
two AS (SELECT cluster, CASE WHEN cluster = 9 THEN (SELECT x FROM f9) ELSE c END AS c FROM one)
SELECT cluster, {_UPDATE_COLUMNS}, {st('list_sum(c)', 6)} AS total FROM two""")
def empty_reseed(spark: SparkSession, sf: str) -> DataFrame:
    """One round from a start with two empty clusters: each moves to the farthest point."""
    points = vectors(spark, sf)
    start = _start(points)
    start[8:] = _FAR
    fit = km.lloyd(points, start, ids=IDS, max_iter=1, empty="farthest")
    return _centers(spark, fit.centroids)


_UNIFORM_SQL = "('0x' || substr(md5({key} || '|{seed}'), 1, 13))::BIGINT"


@query(f"""{ASSIGNED_SQL}, t AS (SELECT 2e0 * 10 / sum(d2) AS f FROM near)
SELECT vec_id, {st('d2', 6)} AS d2 FROM near, t
WHERE d2 > 1e-12 AND {_UNIFORM_SQL.format(key="vec_id", seed=42)} / 4503599627370496e0 < f * d2""")
def dsquared_sample(spark: SparkSession, sf: str) -> DataFrame:
    points = vectors(spark, sf)
    drawn = km.dsquared_sample(points, _start(points), N_LABELS, ids=IDS)
    return drawn.select("vec_id", settle("d2", 6).alias("d2"))


@query(f"""{ASSIGNED_SQL} SELECT count(*) AS n_points, count(DISTINCT (vec_id % 4, cluster)) AS n_partials,
count(*) / count(DISTINCT (vec_id % 4, cluster)) AS reduction FROM near""")
def partial_record_count(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that the tasks of one round emit, observed in the pass, for partitions known by key."""
    points = vectors(spark, sf)
    dealt = points.repartitionById(4, (F.col("vec_id") % 4).cast("int"))
    with km.CachedPoints(dealt, ids=IDS) as blocks:
        return km.partial_record_count(blocks, _start(points))


def _fit_rows(spark: SparkSession, fits: list[km.Fit]) -> DataFrame:
    rows = [(f.attempt, float(f.cost), f.iterations, bool(f.converged), int((f.sizes > 0).sum())) for f in fits]
    return spark.createDataFrame(
        rows, "attempt int, cost double, iterations int, converged boolean, n_clusters int"
    )


@query()
def kmeans_parallel_init(spark: SparkSession, sf: str) -> DataFrame:
    """Cost of the k-means|| starts of ten restarts, before any Lloyd round."""
    with km.CachedPoints(vectors(spark, sf), ids=IDS) as blocks:
        seeds = km.restart_seeds(km.N_INIT)
        starts = km.parallel_init(blocks, N_LABELS, seeds)
        return _fit_rows(spark, km.lloyd_blocks(blocks, starts, max_iter=0, seeds=seeds))


_KNOWN_SQL = "SELECT vec_id, min(vec_id) OVER (PARTITION BY label) AS cluster FROM embeddings"


def _separated(spark: SparkSession, sf: str) -> DataFrame:
    """All embeddings with ten times the one-hot label appended: the optimum at K = 10 is the label."""
    label = F.sequence(F.lit(0), F.lit(N_LABELS - 1))
    apart = F.transform(label, lambda i: F.when(i == F.col("label"), 10.0).otherwise(0.0))
    return table(spark, sf, "embeddings").select(
        "vec_id", F.concat(F.col("embedding").cast("array<double>"), apart).alias("features")
    )


def _named_by_member(assigned: DataFrame) -> DataFrame:
    """Clusters under the name of their smallest member."""
    names = assigned.groupBy("cluster").agg(F.min("vec_id").alias("name"))
    return assigned.join(names, "cluster").select("vec_id", F.col("name").alias("cluster"))


@query(_KNOWN_SQL)
def kmeans_restarts(spark: SparkSession, sf: str) -> DataFrame:
    """The best of ten restarts: lowest cost, the first of equals."""
    points = _separated(spark, sf)
    with km.CachedPoints(points, ids=IDS) as blocks:
        best = km.best_of(km.fit_restarts(blocks, N_LABELS))
    return _named_by_member(km.assign_nearest(points, best.centroids))


@query()
def kmeans_random_init(spark: SparkSession, sf: str) -> DataFrame:
    fit = km.kmeans_random(vectors(spark, sf), N_LABELS, ids=IDS)
    return km.assign_nearest(vectors(spark, sf), fit.centroids).select("vec_id", "cluster")


@query(_KNOWN_SQL)
def kmeans_mllib(spark: SparkSession, sf: str) -> DataFrame:
    """The library's k-means with as many restarts as ours."""
    model, _, points = km.kmeans_mllib(_separated(spark, sf), N_LABELS, n_init=km.N_INIT)
    return _named_by_member(model.transform(points))


@query(_KNOWN_SQL)
def kmeans_final(spark: SparkSession, sf: str) -> DataFrame:
    """K from the whole sweep, then the final fit and its assignment."""
    points = _separated(spark, sf)
    fit = ev.kmeans_final(points, ev.k_sweep(points, ids=IDS), ids=IDS)
    return _named_by_member(km.assign_nearest(points, fit.centroids))


@query()
def cluster_results(spark: SparkSession, sf: str) -> DataFrame:
    """Native products to clustered locations: keys, label, leading components."""
    result = climate.climate_clusters([meteo(spark, sf), solar(spark, sf)])
    return project_results(result.assignments)


# --- internal quality


@query(f"""{ASSIGNED_SQL}, pairs AS (SELECT a.vec_id, a.cluster AS own, b.cluster AS other, sum(list_distance(a.x, b.x)) AS t, count(*) AS n
  FROM near a, near b GROUP BY a.vec_id, a.cluster, b.cluster),
s AS (SELECT vec_id, own, max(n) FILTER (own = other) AS n_own, max(t / nullif(n - 1, 0)) FILTER (own = other) AS a, min(t / n) FILTER (own <> other) AS b
  FROM pairs GROUP BY vec_id, own)
SELECT vec_id, own AS cluster, {st("CASE WHEN n_own = 1 THEN 0 ELSE (b - a) / greatest(a, b) END", 6)} AS silhouette FROM s""")
def silhouette_exact(spark: SparkSession, sf: str) -> DataFrame:
    scores = ev.silhouette_samples(_assigned(spark, sf), ids=IDS)
    return scores.withColumn("silhouette", settle("silhouette", 6))


@query(f"""{ASSIGNED_SQL}, pairs AS (SELECT a.vec_id, a.cluster AS own, b.cluster AS other, sum(pow(list_distance(a.x, b.x), 2)) AS t, count(*) AS n
  FROM near a, near b GROUP BY a.vec_id, a.cluster, b.cluster),
s AS (SELECT vec_id, max(n) FILTER (own = other) AS n_own, max(t / nullif(n - 1, 0)) FILTER (own = other) AS a, min(t / n) FILTER (own <> other) AS b
  FROM pairs GROUP BY vec_id)
SELECT {st("avg(CASE WHEN n_own = 1 THEN 0 ELSE (b - a) / greatest(a, b) END)", 6)} AS silhouette FROM s""")
def silhouette_sq(spark: SparkSession, sf: str) -> DataFrame:
    return ev.silhouette_squared(_assigned(spark, sf)).select(settle("silhouette", 6).alias("silhouette"))


@query(f"""{ASSIGNED_SQL}, {update_sql('upd', 'near')},
s AS (SELECT u.cluster, any_value(u.c) AS c, avg(list_distance(n.x, u.c)) AS s FROM near n JOIN upd u USING (cluster) GROUP BY u.cluster)
SELECT {st("avg(r)", 6)} AS davies_bouldin FROM (
  SELECT a.cluster, max((a.s + b.s) / list_distance(a.c, b.c)) AS r FROM s a JOIN s b ON a.cluster <> b.cluster GROUP BY a.cluster)""")
def davies_bouldin(spark: SparkSession, sf: str) -> DataFrame:
    return ev.davies_bouldin(_assigned(spark, sf)).select(settle("davies_bouldin", 6).alias("davies_bouldin"))


@query()
def k_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return ev.k_sweep(_separated(spark, sf), ids=IDS)


@query(f"""WITH p AS (SELECT vec_id, label, list_concat(CAST(embedding AS DOUBLE[]), list_transform(range(10), lambda i: CASE WHEN i = label THEN 10e0 ELSE 0e0 END)) AS x FROM embeddings),
m AS (SELECT label, list(m ORDER BY dim) AS c FROM (SELECT label, dim, avg(v) AS m FROM (SELECT label, unnest(range(len(x))) AS dim, unnest(x) AS v FROM p) GROUP BY label, dim) GROUP BY label),
d AS (SELECT label, any_value(c) AS c, avg(list_distance(x, c)) AS s, sum(pow(list_distance(x, c), 2)) AS cost FROM p JOIN m USING (label) GROUP BY label),
db AS (SELECT avg(r) AS v FROM (SELECT a.label, max((a.s + b.s) / list_distance(a.c, b.c)) AS r FROM d a JOIN d b ON a.label <> b.label GROUP BY a.label))
SELECT 10 AS optimal_k, 10 AS optimal_k_davies_bouldin, false AS at_boundary, 13 AS n_k, {st("(SELECT sum(cost) FROM d)", 3)} AS inertia,
  {st("(SELECT v FROM db)", 6)} AS davies_bouldin""")
def metrics_record(spark: SparkSession, sf: str) -> DataFrame:
    """The record of a whole sweep K = 3..15 over separated points: both choices of K, and the
    measures at that K."""
    record = ev.metrics_row(ev.k_sweep(_separated(spark, sf), ids=IDS))
    at = (F.array_position("k_range", F.col("optimal_k")) - 1).cast("int")
    return record.select(
        "optimal_k", "optimal_k_davies_bouldin", "at_boundary", F.size("k_range").alias("n_k"),
        settle(F.get("inertias", at), 3).alias("inertia"), settle(F.get("davies_bouldin", at), 6).alias("davies_bouldin"),
    )


@query(f"""WITH m AS (SELECT l_linenumber + 2 AS k, avg(l_discount * l_quantity) AS silhouette FROM lineitem GROUP BY l_linenumber)
SELECT CAST(k AS INT) AS optimal_k, {st("silhouette", 6)} AS score, k IN (3, 9) AS at_boundary FROM m ORDER BY silhouette DESC, k LIMIT 1""")
def select_k(spark: SparkSession, sf: str) -> DataFrame:
    """Argmax rule on a metric curve taken from the line items."""
    metrics = table(spark, sf, "lineitem").groupBy((F.col("l_linenumber") + 2).alias("k")).agg(
        F.avg(F.col("l_discount") * F.col("l_quantity")).alias("silhouette")
    )
    return ev.select_k(metrics).withColumn("score", settle("score", 6))


# --- profiles of clusters of sites

_SITE_CLUSTER = "cast(((site - 1) % 33) div 3 as int)"


def _site_features(spark: SparkSession, sf: str) -> DataFrame:
    features = ft.location_features(daily(spark, sf), PARAMS, keys=("site", "lat", "lon"))
    return features.withColumn("cluster", F.expr(_SITE_CLUSTER))


_SITES_SQL = f"""{DAILY_SQL}, f AS (
  SELECT site, lat, lon, CAST(((site - 1) % 33) // 3 AS INT) AS cluster, avg(T2M) AS T2M_mean, avg(PRECTOTCORR) AS PRECTOTCORR_mean,
         avg(RH2M) AS RH2M_mean, avg(WS2M) AS WS2M_mean FROM daily GROUP BY site, lat, lon),
profile AS (
  SELECT cluster, count(*) AS n_locations, min(lat) AS lat_min, max(lat) AS lat_max, min(lon) AS lon_min, max(lon) AS lon_max,
         avg(lat) AS lat_center, avg(lon) AS lon_center, avg(T2M_mean) AS temperature, avg(PRECTOTCORR_mean) AS precipitation,
         avg(RH2M_mean) AS humidity, avg(WS2M_mean) AS wind_speed,
         CASE WHEN avg(lon) > -121 THEN 'Eastern Washington' WHEN avg(lon) > -122.5 THEN 'Central/Cascade Region' ELSE 'Western Washington' END AS region
  FROM f GROUP BY cluster)"""
_THEME_DIGITS = {"temperature": 4, "precipitation": 2, "humidity": 6, "wind_speed": 6}
_PROFILE_SQL = ", ".join(f"{st(t, d)} AS {t}" for t, d in {"lat_center": 5, "lon_center": 5, **_THEME_DIGITS}.items())


def _profile(spark: SparkSession, sf: str) -> DataFrame:
    features = _site_features(spark, sf)
    themes = {name.lower().replace(" ", "_"): c for name, c in resolve_themes(features.columns).items()}
    return pf.cluster_profile(features, themes=themes)


@query(f"WITH {_SITES_SQL} SELECT cluster, n_locations, lat_min, lat_max, lon_min, lon_max, {_PROFILE_SQL}, region FROM profile")
def cluster_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _profile(spark, sf).withColumns(
        {c: settle(c, d) for c, d in {"lat_center": 5, "lon_center": 5, **_THEME_DIGITS}.items()}
    )


@query(f"""WITH {_SITES_SQL} SELECT cluster, {", ".join(
    st(f"CASE WHEN max({t}) OVER () > min({t}) OVER () THEN ({t} - min({t}) OVER ()) / (max({t}) OVER () - min({t}) OVER ()) ELSE 0.5e0 END", 6) + f" AS {t}"
    for t in _THEME_DIGITS)} FROM profile""")
def profile_minmax(spark: SparkSession, sf: str) -> DataFrame:
    scaled = pf.profile_minmax(_profile(spark, sf), list(_THEME_DIGITS))
    return scaled.select("cluster", *[settle(t, 6).alias(t) for t in _THEME_DIGITS])


@query(f"""WITH {_SITES_SQL} SELECT x.theme, x.param, {st("avg(CASE x.param WHEN 'T2M_mean' THEN T2M_mean WHEN 'PRECTOTCORR_mean' THEN PRECTOTCORR_mean WHEN 'RH2M_mean' THEN RH2M_mean ELSE WS2M_mean END)", 3)} AS mean
FROM f, (VALUES ('Temperature', 'T2M_mean'), ('Precipitation', 'PRECTOTCORR_mean'), ('Humidity', 'RH2M_mean'), ('Wind Speed', 'WS2M_mean')) x(theme, param)
GROUP BY x.theme, x.param""")
def profile_params(spark: SparkSession, sf: str) -> DataFrame:
    """Which column speaks for which theme, and its mean over all sites."""
    features = _site_features(spark, sf)
    rows = [
        F.struct(F.lit(theme).alias("theme"), F.lit(c).alias("param"), settle(F.avg(c), 3).alias("mean"))
        for theme, c in resolve_themes(features.columns).items()
    ]
    return features.agg(F.array(*rows).alias("r")).select(F.inline("r"))


@query(f"WITH {_SITES_SQL} SELECT region, count(*) AS n_clusters FROM profile GROUP BY region")
def region_counts(spark: SparkSession, sf: str) -> DataFrame:
    return pf.region_counts(_profile(spark, sf))


@query(f"{ASSIGNED_SQL} SELECT cluster, count(*) AS n, {st('count(*) * 100e0 / sum(count(*)) OVER ()', 6)} AS percent FROM near GROUP BY cluster")
def cluster_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return pf.cluster_sizes(_assigned(spark, sf)).withColumn("percent", settle("percent", 6))


@query(f"""{ASSIGNED_SQL}, c AS (SELECT cluster, count(*) AS n FROM near GROUP BY cluster)
SELECT count(*) AS n_clusters, CAST(sum(n) AS BIGINT) AS n_rows, {st('avg(n)', 4)} AS mean_size, max(n) AS max_size, min(n) AS min_size FROM c""")
def size_summary(spark: SparkSession, sf: str) -> DataFrame:
    return pf.size_summary(_assigned(spark, sf)).withColumn("mean_size", settle("mean_size", 4))


# --- two labelings: the given label against the nearest start vector


def _label_pairs(spark: SparkSession, sf: str) -> DataFrame:
    given = vectors(spark, sf).select("vec_id", F.col("label").alias("cluster"))
    return cp.labels_join(given, _assigned(spark, sf), keys=IDS)


_PAIRS_SQL = f"{ASSIGNED_SQL}, pairs AS (SELECT vec_id, label AS cluster_a, cluster AS cluster_b FROM near)"
_SCORES_SQL = f"""{_PAIRS_SQL}, ct AS (SELECT cluster_a, cluster_b, count(*) AS n FROM pairs GROUP BY ALL),
ra AS (SELECT cluster_a, sum(n) AS n FROM ct GROUP BY ALL), rb AS (SELECT cluster_b, sum(n) AS n FROM ct GROUP BY ALL),
t AS (SELECT (SELECT count(*) FROM pairs)::DOUBLE AS n, (SELECT sum(n * (n - 1) / 2e0) FROM ct) AS p,
  (SELECT sum(n * (n - 1) / 2e0) FROM ra) AS pa, (SELECT sum(n * (n - 1) / 2e0) FROM rb) AS pb,
  (SELECT avg(CAST(cluster_a = cluster_b AS DOUBLE)) FROM pairs) AS rate),
mi AS (SELECT sum(ct.n / t.n * ln(t.n * ct.n / (ra.n * rb.n))) AS mi FROM ct JOIN ra USING (cluster_a) JOIN rb USING (cluster_b), t),
h AS (SELECT (SELECT -sum(ra.n / t.n * ln(ra.n / t.n)) FROM ra, t) AS ha, (SELECT -sum(rb.n / t.n * ln(rb.n / t.n)) FROM rb, t) AS hb),
score AS (SELECT CAST(n AS BIGINT) AS n, (p - pa * pb / (n * (n - 1) / 2)) / ((pa + pb) / 2 - pa * pb / (n * (n - 1) / 2)) AS ari,
  mi / ((ha + hb) / 2) AS nmi, rate AS agreement_rate FROM t, mi, h)"""


@query(f"{_PAIRS_SQL} SELECT vec_id, cluster_a, cluster_b FROM pairs")
def labels_join(spark: SparkSession, sf: str) -> DataFrame:
    return _label_pairs(spark, sf)


@query(f"{_PAIRS_SQL} SELECT cluster_a, cluster_b, count(*) AS n FROM pairs GROUP BY ALL")
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return cp.confusion_matrix(_label_pairs(spark, sf))


@query(f"""{_PAIRS_SQL} SELECT cluster_a, {", ".join(f'count(*) FILTER (cluster_b = {i}) AS c{i}' for i in range(N_LABELS))} FROM pairs GROUP BY cluster_a""")
def confusion_wide(spark: SparkSession, sf: str) -> DataFrame:
    wide = cp.confusion_wide(_label_pairs(spark, sf), range(N_LABELS))
    return wide.select("cluster_a", *[F.col(str(i)).alias(f"c{i}") for i in range(N_LABELS)])


@query(f"""{_PAIRS_SQL}, ct AS (SELECT cluster_a, cluster_b, count(*) AS overlap FROM pairs GROUP BY ALL),
tot AS (SELECT *, CAST(sum(overlap) OVER (PARTITION BY cluster_a) AS BIGINT) AS total FROM ct)
SELECT cluster_a, cluster_b, overlap, total, {st('overlap / total', 6)} AS share FROM tot
QUALIFY row_number() OVER (PARTITION BY cluster_a ORDER BY overlap DESC, cluster_b) = 1""")
def best_mapping(spark: SparkSession, sf: str) -> DataFrame:
    return cp.best_mapping(_label_pairs(spark, sf)).withColumn("share", settle("share", 6))


@query(f"{_SCORES_SQL} SELECT {st('ari', 6)} AS ari FROM score")
def adjusted_rand(spark: SparkSession, sf: str) -> DataFrame:
    return cp.adjusted_rand(_label_pairs(spark, sf)).select(settle("ari", 6).alias("ari"))


@query(f"{_SCORES_SQL} SELECT {st('nmi', 6)} AS nmi FROM score")
def nmi(spark: SparkSession, sf: str) -> DataFrame:
    return cp.nmi(_label_pairs(spark, sf)).select(settle("nmi", 6).alias("nmi"))


@query(f"{_PAIRS_SQL} SELECT vec_id, cluster_a, cluster_b, cluster_a = cluster_b AS agreement FROM pairs")
def agreement(spark: SparkSession, sf: str) -> DataFrame:
    return cp.agreement(_label_pairs(spark, sf))


@query(f"""{_PAIRS_SQL} SELECT count(*) FILTER (cluster_a = cluster_b) AS n_agree, count(*) FILTER (cluster_a <> cluster_b) AS n_disagree,
{st('avg(CAST(cluster_a = cluster_b AS DOUBLE))', 6)} AS agreement_rate FROM pairs""")
def agreement_rate(spark: SparkSession, sf: str) -> DataFrame:
    rate = cp.agreement_rate(_label_pairs(spark, sf))
    return rate.withColumn("agreement_rate", settle("agreement_rate", 6))


@query(f"""{_SCORES_SQL} SELECT n, {st('ari', 6)} AS ari, {st('nmi', 6)} AS nmi, {st('agreement_rate', 6)} AS agreement_rate,
CASE WHEN ari > 0.8 THEN 'excellent' WHEN ari > 0.5 THEN 'good' WHEN ari > 0.3 THEN 'moderate' ELSE 'low' END AS ari_band,
CASE WHEN nmi > 0.8 THEN 'excellent' WHEN nmi > 0.5 THEN 'good' ELSE 'moderate' END AS nmi_band,
CASE WHEN ari > 0.8 AND agreement_rate > 0.8 THEN 'EXCELLENT' WHEN ari > 0.5 AND agreement_rate > 0.6 THEN 'GOOD'
     WHEN ari > 0.3 THEN 'MODERATE' ELSE 'LOW' END AS verdict FROM score""")
def validation_verdict(spark: SparkSession, sf: str) -> DataFrame:
    verdict = cp.validation_verdict(cp.label_scores(_label_pairs(spark, sf)))
    return verdict.withColumns({c: settle(c, 6) for c in ("ari", "nmi", "agreement_rate")})


@query(f"""{_PAIRS_SQL}, a AS (SELECT cluster_a AS label, count(*) AS n_a FROM pairs GROUP BY ALL), b AS (SELECT cluster_b AS label, count(*) AS n_b FROM pairs GROUP BY ALL)
SELECT label, coalesce(n_a, 0) AS n_a, coalesce(n_b, 0) AS n_b FROM a FULL JOIN b USING (label)""")
def paired_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return cp.paired_sizes(_label_pairs(spark, sf))


@query("SELECT 1e0 AS ari, 1e0 AS nmi FROM embeddings LIMIT 1")
def seed_control(spark: SparkSession, sf: str) -> DataFrame:
    """Agreement of two independent fits of the same points, ten restarts each: the yardstick for
    any other pair, and 1 where the optimum is clear."""
    points = _separated(spark, sf)
    with km.CachedPoints(points, ids=IDS) as blocks:
        fits = [km.best_of(km.fit_restarts(blocks, N_LABELS, seed=s)) for s in (1, 2)]
    left, right = (km.assign_nearest(points, f.centroids) for f in fits)
    scores = cp.label_scores(cp.labels_join(left, right, keys=IDS))
    return scores.select(settle("ari", 6).alias("ari"), settle("nmi", 6).alias("nmi"))


# --- samples


def _prefix_sql(n: str) -> str:
    return f"""SELECT event_id, user_id, value FROM events
QUALIFY row_number() OVER (ORDER BY {_UNIFORM_SQL.format(key="event_id", seed=42)}, event_id) <= {n}"""


@query(f"""SELECT 10 AS percent, * FROM ({_prefix_sql("(SELECT round_even(count(*) * 0.1, 0) FROM events)")})
UNION ALL SELECT 25, * FROM ({_prefix_sql("(SELECT round_even(count(*) * 0.25, 0) FROM events)")})
UNION ALL SELECT 50, * FROM ({_prefix_sql("(SELECT round_even(count(*) * 0.5, 0) FROM events)")})""")
def fraction_sample(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select("event_id", "user_id", "value")
    parts = None
    for fraction, part in sm.fraction_samples(rows, [0.1, 0.25, 0.5], ids=("event_id",)).items():
        part = part.select(F.lit(round(100 * fraction)).alias("percent"), "*")
        parts = part if parts is None else parts.unionByName(part)
    return parts


@query(" UNION ALL ".join(
    f"SELECT {n} AS size, * FROM ({_prefix_sql(str(n))})" for n in (495, 5000)
) + " UNION ALL SELECT 0 AS size, event_id, user_id, value FROM events")
def nested_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Prefixes of one fixed order; size 0 stands for all rows."""
    rows = table(spark, sf, "events").select("event_id", "user_id", "value")
    parts = None
    for n, part in sm.nested_samples(rows, [495, 5000, None], ids=("event_id",)).items():
        part = part.select(F.lit(n or 0).alias("size"), "*")
        parts = part if parts is None else parts.unionByName(part)
    return parts


@query(f"""SELECT event_id, {_UNIFORM_SQL.format(key="event_id", seed=7)} / 4503599627370496e0 AS u FROM events""")
def hash_draws(spark: SparkSession, sf: str) -> DataFrame:
    """The partition-independent uniform of every row."""
    return table(spark, sf, "events").select("event_id", hash_uniform("event_id", seed=7).alias("u"))
