"""What the clusters look like."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isotherm.functions.exprs import REGION_CUTS, REGION_DEFAULT, region
from isotherm.operators.columns import resolve_themes


def cluster_sizes(df: DataFrame, *, label: str = "cluster") -> DataFrame:
    """Rows and percent per label, in the order of the labels. The window runs over the K counted rows, not the data."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("percent", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy())).orderBy(label)


def cluster_profile(
    df: DataFrame,
    *,
    label: str = "cluster",
    lat: str = "lat",
    lon: str = "lon",
    themes: Mapping[str, str] | None = None,
    cuts=REGION_CUTS,
    default_region: str = REGION_DEFAULT,
) -> DataFrame:
    """Size, extent, center, region and themed means per cluster, in one aggregation, in the order of the labels."""
    chosen = resolve_themes(df.columns) if themes is None else dict(themes)
    grouped = df.groupBy(label).agg(
        F.count(F.lit(1)).alias("n_locations"),
        F.min(lat).alias("lat_min"),
        F.max(lat).alias("lat_max"),
        F.min(lon).alias("lon_min"),
        F.max(lon).alias("lon_max"),
        F.avg(lat).alias("lat_center"),
        F.avg(lon).alias("lon_center"),
        *[F.avg(c).alias(theme) for theme, c in chosen.items()],
    )
    return grouped.withColumn("region", region("lon_center", cuts, default_region)).orderBy(label)


def profile_minmax(profile: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale every profile column to 0..1 over the clusters; a constant one becomes 0.5."""
    everyone = Window.partitionBy()

    def scaled(c: str):
        lo, hi = F.min(c).over(everyone), F.max(c).over(everyone)
        return F.when(hi > lo, (F.col(c) - lo) / (hi - lo)).otherwise(F.lit(0.5))

    return profile.withColumns({c: scaled(c) for c in columns})


def region_counts(profile: DataFrame) -> DataFrame:
    return profile.groupBy("region").agg(F.count(F.lit(1)).alias("n_clusters"))


def size_summary(df: DataFrame, *, label: str = "cluster") -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.count(F.lit(1)).alias("n_clusters"),
        F.sum("n").alias("n_rows"),
        F.avg("n").alias("mean_size"),
        F.max("n").alias("max_size"),
        F.min("n").alias("min_size"),
    )
