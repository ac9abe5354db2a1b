"""Missing values, infinities, ranges and summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isotherm.functions.exprs import nan_as_null
from isotherm.operators.columns import column_stats, numeric_columns

_INF = float("inf")


def _is_inf(c: str) -> Column:
    return F.abs(F.col(c)) == F.lit(_INF)


def _one_row_per_column(df: DataFrame, columns: Sequence[str], stats: Mapping[str, object]) -> DataFrame:
    """One global aggregate over all columns, turned into one row per column."""
    aggregated = df.agg(
        F.array(
            *[
                F.struct(F.lit(c).alias("param"), *[make(c).alias(n) for n, make in stats.items()])
                for c in columns
            ]
        ).alias("r")
    )
    return aggregated.select(F.inline("r"))


def null_profile(df: DataFrame, columns: Sequence[str], *, only_missing: bool = True) -> DataFrame:
    """Missing values per column of any type: NULL, and NaN where the type has it."""
    floating = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}

    def missing(c: str) -> Column:
        absent = F.isnull(F.col(c))
        return F.count_if(absent | F.isnan(F.col(c)) if c in floating else absent)

    out = _one_row_per_column(df, columns, {"n_missing": missing})
    return out.filter("n_missing > 0") if only_missing else out


def inf_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _one_row_per_column(df, columns, {"n_inf": lambda c: F.count_if(_is_inf(c))})


def inf_clean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """If any measure is infinite, blank it and drop every row with a missing column.

    Without a single infinity the rows stay as they are, missing values included. The
    gate is a scalar subquery, so the operator stays lazy.
    """
    any_inf = F.lit(False)
    for c in columns:
        any_inf = any_inf | F.coalesce(_is_inf(c), F.lit(False))
    gate = df.agg(F.coalesce(F.bool_or(any_inf), F.lit(False)).alias("g")).scalar()
    broken = any_inf
    for field in df.schema.fields:
        broken = broken | F.isnull(F.col(field.name))
        if field.dataType.typeName() in ("double", "float"):
            broken = broken | F.coalesce(F.isnan(F.col(field.name)), F.lit(False))
    return df.filter(~gate | ~broken)


def mean_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace missing values by the column mean (fitted in one job)."""
    means = column_stats(df, {c: F.avg(nan_as_null(c)) for c in columns})
    return df.withColumns({c: F.coalesce(nan_as_null(c), F.lit(means[c])) for c in columns})


def zero_fill(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.fill(0.0, list(columns) if columns is not None else numeric_columns(df, exclude=()))


def describe_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Typed mean/std/min/max, one row per column."""
    return _one_row_per_column(
        df,
        columns,
        {
            "mean": lambda c: F.avg(nan_as_null(c)),
            "std": lambda c: F.stddev_samp(nan_as_null(c)),
            "min": lambda c: F.min(nan_as_null(c)),
            "max": lambda c: F.max(nan_as_null(c)),
        },
    )


def dataset_metadata(
    df: DataFrame, *, keys: Sequence[str] = ("lat", "lon"), time: str = "time"
) -> DataFrame:
    """Rows, distinct locations and times, extents: one row.

    Counting distinct keys after a plain ``groupBy(keys)`` shuffles one partial row per
    key and map task; ``count(distinct ...)`` next to other aggregates would expand rows.
    """
    per_site = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(time).alias("t0"), F.max(time).alias("t1")
    )
    sites = per_site.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_locations"),
        F.min("t0").alias("time_min"),
        F.max("t1").alias("time_max"),
        F.min(keys[0]).alias("lat_min"),
        F.max(keys[0]).alias("lat_max"),
        F.min(keys[1]).alias("lon_min"),
        F.max(keys[1]).alias("lon_max"),
    )
    n_times = df.groupBy(time).agg(F.lit(1).alias("one")).agg(F.count("one").alias("n")).scalar()
    return sites.withColumn("n_times", n_times).withColumn(
        "n_params", F.lit(len(numeric_columns(df, exclude=keys))).cast("long")
    )


def range_guard(
    df: DataFrame, ranges: Mapping[str, tuple[float, float]], *, time: str = "time", last=None
) -> DataFrame:
    """Blank implausible values and drop rows past the last published day."""
    if last is not None:
        df = df.filter(F.col(time) <= F.lit(last))
    return df.withColumns({c: F.when(F.col(c).between(lo, hi), F.col(c)) for c, (lo, hi) in ranges.items()})


def range_rejects(
    df: DataFrame, ranges: Mapping[str, tuple[float, float]], *, time: str = "time", last=None
) -> DataFrame:
    """How many values :func:`range_guard` blanks per column, and the rows it drops."""
    late = F.lit(False) if last is None else F.col(time) > F.lit(last)
    rows = [
        F.struct(
            F.lit(c).alias("param"),
            F.count_if(~late & ~F.col(c).between(lo, hi)).alias("n_rejected"),
            F.count_if(late).alias("n_late_rows"),
        )
        for c, (lo, hi) in ranges.items()
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def standardisation_check(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Overall mean and population std of a standardised matrix."""
    total, squares = F.lit(0.0), F.lit(0.0)
    for c in columns:
        total = total + F.col(c)
        squares = squares + F.col(c) * F.col(c)
    size = F.count(F.lit(1)) * F.lit(float(len(columns)))
    mean = F.sum(total) / size
    return df.agg(mean.alias("mean"), F.sqrt(F.sum(squares) / size - mean * mean).alias("std"))
