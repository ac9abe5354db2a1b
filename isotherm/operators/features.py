"""Per-location features from daily rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isotherm.functions.exprs import SEASONS, nan_as_null, season

# Measures that get seasonal means.
SEASONAL_PARAMS = ("T2M", "PRECTOTCORR", "RH2M", "WS2M", "ALLSKY_SFC_SW_DWN", "CLOUD_AMT")
LOCATION = ("lat", "lon")


def _stats(param: str) -> list[Column]:
    c = nan_as_null(param)
    return [
        F.avg(c).alias(f"{param}_mean"),
        F.stddev_samp(c).alias(f"{param}_std"),
        F.min(c).alias(f"{param}_min"),
        F.max(c).alias(f"{param}_max"),
    ]


def _seasonal(param: str, label: Column) -> list[Column]:
    return [F.avg(F.when(label == s, nan_as_null(param))).alias(f"{param}_{s}") for s in SEASONS]


def location_stats(
    df: DataFrame, params: Sequence[str], *, keys: Sequence[str] = LOCATION
) -> DataFrame:
    """Mean, sample std, min and max of every measure per location."""
    return df.groupBy(*keys).agg(*[s for p in params for s in _stats(p)])


def seasonal_means(
    df: DataFrame, params: Sequence[str], *, keys: Sequence[str] = LOCATION, time: str = "time"
) -> DataFrame:
    """Long form: one row per location and season."""
    return (
        df.withColumn("season", season(time))
        .groupBy(*keys, "season")
        .agg(*[F.avg(nan_as_null(p)).alias(p) for p in params])
    )


def seasonal_pivot(
    df: DataFrame, params: Sequence[str], *, keys: Sequence[str] = LOCATION, time: str = "time"
) -> DataFrame:
    """Wide form, measures A-Z by season. The season list is known, so this is one
    aggregation with conditional means instead of a pivot over a second shuffle."""
    labelled = df.withColumn("_season", season(time))
    return labelled.groupBy(*keys).agg(
        *[s for p in sorted(params) for s in _seasonal(p, F.col("_season"))]
    )


def pivot_seasons(long: DataFrame, params: Sequence[str], *, keys: Sequence[str] = LOCATION) -> DataFrame:
    """Pivot an existing long table of seasonal means."""
    params = sorted(params)
    wide = long.groupBy(*keys).pivot("season", list(SEASONS)).agg(*[F.first(p).alias(p) for p in params])
    if len(params) == 1:
        return wide.select(*keys, *[F.col(s).alias(f"{params[0]}_{s}") for s in SEASONS])
    return wide.select(*keys, *[F.col(f"{s}_{p}").alias(f"{p}_{s}") for p in params for s in SEASONS])


def location_features(
    df: DataFrame,
    params: Sequence[str],
    *,
    seasonal: Sequence[str] = SEASONAL_PARAMS,
    keys: Sequence[str] = LOCATION,
    time: str = "time",
) -> DataFrame:
    """Statistics and seasonal means per location in a single aggregation.

    Equal to joining :func:`location_stats` with :func:`seasonal_pivot`: one scan, one
    shuffle of one partial row per location and map task, no join and no hot key.
    Column order: statistics in measure order, then seasonal columns A-Z; the pruning
    rule depends on it.
    """
    seasonal = sorted(p for p in seasonal if p in set(params))
    labelled = df.withColumn("_season", season(time)) if seasonal else df
    return labelled.groupBy(*keys).agg(
        *[s for p in params for s in _stats(p)],
        *[s for p in seasonal for s in _seasonal(p, F.col("_season"))],
    )


def degree_days(
    df: DataFrame, *, t_max: str = "T2M_MAX", t_min: str = "T2M_MIN", base: float = 10.0,
    keys: Sequence[str] = LOCATION,
) -> DataFrame:
    """Growing degree days: sum of the daily mean temperature above the base."""
    mean = (F.col(t_max) + F.col(t_min)) / 2.0
    return df.groupBy(*keys).agg(F.sum(F.greatest(mean - base, F.lit(0.0))).alias("degree_days"))


def frost_days(df: DataFrame, *, t_min: str = "T2M_MIN", keys: Sequence[str] = LOCATION) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_if(F.col(t_min) < 0).alias("frost_days"))


def solar_ratio(
    df: DataFrame,
    *,
    all_sky: str = "ALLSKY_SFC_SW_DWN",
    clear_sky: str = "CLRSKY_SFC_SW_DWN",
    keys: Sequence[str] = LOCATION,
) -> DataFrame:
    """Share of the clear-sky irradiance that arrives under the actual sky."""
    return df.groupBy(*keys).agg(F.try_divide(F.avg(all_sky), F.avg(clear_sky)).alias("solar_ratio"))
