"""Choosing, assembling and relabelling columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Preferred feature column per profile theme, first match wins.
PROFILE_THEMES = {
    "Temperature": ("T2M_mean", "T2M_std", "T2M_MIN_mean", "T2M_MAX_mean"),
    "Precipitation": ("PRECTOTCORR_mean", "PRECTOT_mean"),
    "Humidity": ("RH2M_mean", "RH_mean"),
    "Solar Radiation": (
        "ALLSKY_SFC_SW_DWN_std",
        "ALLSKY_SFC_SW_DNI_mean",
        "ALLSKY_KT_mean",
        "MIDDAY_INSOL_mean",
    ),
    "Wind Speed": ("WS2M_mean", "WS10M_mean", "WS_mean"),
    "Cloud Cover": ("CLOUD_AMT_mean", "CLOUD_OD_mean"),
}

KEYS = ("time", "lat", "lon")


def project_available(
    df: DataFrame, wanted: Sequence[str], *, keys: Sequence[str] = KEYS
) -> tuple[DataFrame, list[str]]:
    """Keep the keys and those wanted columns that exist; also return the missing names."""
    present = set(df.columns)
    found = [c for c in wanted if c in present]
    if not found:
        raise ValueError("none of the requested columns is present")
    return df.select(*keys, *found), [c for c in wanted if c not in present]


def project_strict(df: DataFrame, wanted: Sequence[str], *, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keep the keys and all wanted columns; an unknown name fails in analysis."""
    return df.select(*keys, *wanted)


def numeric_columns(df: DataFrame, *, exclude: Iterable[str] = ("lat", "lon")) -> list[str]:
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def columns_except(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    skip = set(exclude)
    return [c for c in df.columns if c not in skip]


def component_columns(df: DataFrame, *, prefix: str = "PC") -> list[str]:
    found = [c for c in df.columns if c.startswith(prefix)]
    if not found:
        raise ValueError(f"no {prefix}* feature columns found")
    return found


def assemble_features(
    df: DataFrame, columns: Sequence[str], *, keep: Sequence[str] = (), out: str = "features"
) -> DataFrame:
    """Flat measure columns to one ``array<double>``."""
    return df.select(*keep, F.array(*[F.col(c).cast("double") for c in columns]).alias(out))


def flatten_features(
    df: DataFrame, size: int, *, features: str = "features", keep: Sequence[str] = (), prefix: str = "PC"
) -> DataFrame:
    """One ``array<double>`` to flat columns ``PC1..PCsize``."""
    return df.select(*keep, *[F.col(features)[i].alias(f"{prefix}{i + 1}") for i in range(size)])


def resolve_themes(
    columns: Iterable[str], themes: Mapping[str, Sequence[str]] = PROFILE_THEMES
) -> dict[str, str]:
    """First available candidate per theme; themes without any candidate are left out."""
    present = set(columns)
    chosen = {}
    for theme, candidates in themes.items():
        hit = next((c for c in candidates if c in present), None)
        if hit is not None:
            chosen[theme] = hit
    return chosen


def column_stats(df: DataFrame, stats: Mapping[str, Column]) -> Row:
    """All the given global aggregates of ``df`` in one job; one row returns.

    The fitted numbers then enter later plans as literals, so a plan with many columns
    holds its input once and not once per column.
    """
    return df.agg(*[c.alias(n) for n, c in stats.items()]).head()


def cluster_results(
    df: DataFrame,
    *,
    keys: Sequence[str] = ("lat", "lon"),
    cluster: str = "cluster",
    features: str = "features",
    components: int = 3,
) -> DataFrame:
    """Keys, label and the leading components, all taken from the same scored row."""
    return df.select(
        *keys,
        cluster,
        *[F.get(F.col(features), F.lit(i)).alias(f"PC{i + 1}") for i in range(components)],
    )
