"""The whole flow, from native products to clusters, as composed operators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.operators import evaluate as ev
from isotherm.operators import features as ft
from isotherm.operators import kmeans as km
from isotherm.operators import quality, reduce
from isotherm.operators.columns import flatten_features, numeric_columns
from isotherm.operators.grid import Grid
from isotherm.operators.regrid import Product, regrid_products
from isotherm.sources import tables


def combined_daily(products: Sequence[Product], target: Grid | None = None, **options) -> DataFrame:
    """All products on one dense grid: ``time, lat_i, lon_i, lat, lon`` and every measure."""
    return regrid_products(products, target or Grid.dense(), **options)


def numeric_features(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return numeric_columns(df, exclude=keys)


@dataclass(frozen=True)
class Clustering:
    assignments: DataFrame
    scores: DataFrame
    features: DataFrame
    dropped: list[str]
    reduction: reduce.Reduction
    fit: km.Fit
    metrics: DataFrame | None = None  # of the sweep, where K was chosen


def cluster_locations(
    features: DataFrame,
    *,
    keys: Sequence[str] = ("lat", "lon"),
    threshold: float = 0.99,
    variance: float = 0.95,
    k: int | None = km.K,
    sweep: dict | None = None,
    **kmeans_options,
) -> Clustering:
    """Fill, prune, standardise, reduce and cluster a feature table (one row a location).

    The feature table is the first small result of the flow and several passes read it,
    so it is written once to the shared folder; the daily rows are read a single time.
    Without ``k``, a sweep (its options in ``sweep``) chooses it by the silhouette, the exact Euclidean one
    for a table of locations, and the final fit follows with that K.
    """
    features = tables.materialise(features, "features")
    names = numeric_features(features, keys)
    filled = quality.mean_fill(features, names)
    dropped = reduce.redundant_columns(reduce.correlation_matrix(filled, names), names, threshold)
    kept = [c for c in names if c not in set(dropped)]
    filled = filled.select(*keys, *kept)
    reduction = reduce.fit_reduction(filled, kept, variance=variance)
    scores = reduce.apply_reduction(reduction, filled, keep=keys)
    metrics = None
    if k is None:
        metrics = ev.k_sweep(scores, ids=keys, **{"measure": "euclidean", **(sweep or {})})
        fit = ev.kmeans_final(scores, metrics, ids=keys, **kmeans_options)
    else:
        fit = km.kmeans(scores, k, ids=keys, **kmeans_options)
    assignments = km.assign_nearest(scores, fit.centroids)
    return Clustering(assignments, scores, filled, dropped, reduction, fit, metrics)


def labelled_features(result: Clustering, *, keys: Sequence[str] = ("lat", "lon")) -> DataFrame:
    """Engineered features and label on one row: scores and label are computed next to the
    features they come from."""
    columns = [*keys, *result.reduction.columns]
    scored = reduce.apply_reduction(result.reduction, result.features, keep=columns)
    return km.assign_nearest(scored, result.fit.centroids).drop("features", "d2")


def metadata(result: Clustering) -> DataFrame:
    """The one row that describes the clustered dataset, ready for the JSON sink."""
    fit = result.reduction
    names = [f"PC{i + 1}" for i in range(fit.components)]
    return result.scores.agg(
        F.count(F.lit(1)).alias("n_locations"),
        F.lit(fit.components).alias("n_features"),
        F.lit(fit.variance_retained).alias("pca_variance_retained"),
        F.lit(len(fit.columns)).alias("original_features"),
        F.lit(fit.components).alias("pca_components"),
        F.array(*[F.lit(n) for n in names]).alias("feature_columns"),
        F.array(F.min("lat"), F.max("lat")).alias("lat_range"),
        F.array(F.min("lon"), F.max("lon")).alias("lon_range"),
    )


def export_components(result: Clustering, *, keys: Sequence[str] = ("lat", "lon")) -> DataFrame:
    """Flat ``lat, lon, PC1..PCd``, the hand-off to the clustering job."""
    return flatten_features(result.scores, result.reduction.components, keep=keys)


def daily_regimes(
    df: DataFrame, params: Sequence[str], *, keys: Sequence[str] = ("lat", "lon"), components: int = 14
) -> DataFrame:
    """Standardise and reduce the daily rows themselves: keys and ``features``."""
    reduction = reduce.fit_reduction(df.select(*keys, *params), params, components=components)
    return reduce.apply_reduction(reduction, df, keep=keys)


def regime_clusters(
    regimes: DataFrame, *, keys: Sequence[str], k: int = km.K, start: np.ndarray | None = None, **options
) -> tuple[DataFrame, km.Fit]:
    """Cluster the reduced daily rows (:func:`daily_regimes`), from given centroids or by restarts: rows
    with their regime, and the fit. The scores are written once, as every round reads them."""
    regimes = tables.materialise(regimes, "regimes")
    fit = km.kmeans(regimes, k, ids=keys, **options) if start is None else km.lloyd(regimes, start, ids=keys, **options)
    return km.assign_nearest(regimes, fit.centroids, cluster="regime"), fit


def climate_clusters(
    products: Sequence[Product], *, seasonal: Sequence[str] | None = None, target: Grid | None = None, **options
) -> Clustering:
    """Native products to clustered locations."""
    daily = combined_daily(products, target)
    params = [p for product in products for p in product.params]
    table = ft.location_features(
        daily, params, seasonal=ft.SEASONAL_PARAMS if seasonal is None else seasonal
    )
    return cluster_locations(table, **options)
