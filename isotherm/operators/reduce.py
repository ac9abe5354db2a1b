"""Correlation pruning, standardisation and principal components.

Everything here rests on mergeable states that one pass over the rows builds: moments per column,
pairwise co-moments for correlations, and an R factor of the centred rows for components. States of
tasks meet in a tree on the executors; d x d numbers reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isotherm.functions import kernels
from isotherm.operators.partials import State, fold_states


@dataclass(frozen=True)
class Moments:
    rows: int
    counts: np.ndarray
    means: np.ndarray
    stds: np.ndarray  # population

    @property
    def complete(self) -> bool:
        return bool((self.counts == self.rows).all())


def _doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.selectExpr(*[f"cast(`{c}` AS double) AS c{i}" for i, c in enumerate(columns)])


def _extremes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    present = ~np.isnan(x)
    return np.where(present, x, np.inf).min(axis=0), np.where(present, x, -np.inf).max(axis=0)


def moments(df: DataFrame, columns: Sequence[str]) -> Moments:
    """Row count, and count, mean and population std per column, missing values left out, in one pass.

    The merge is the exact one for (count, mean, squared deviations). An aggregate expression per
    column and statistic would say the same, but compiling a thousand of them takes longer than the
    pass. The std of a constant column is 0.
    """
    d = len(columns)

    def each(x: np.ndarray) -> State:
        present = ~np.isnan(x)
        n = present.sum(axis=0).astype(np.float64)
        mean = np.where(present, x, 0.0).sum(axis=0) / np.maximum(n, 1.0)
        dev = np.where(present, (x - mean) ** 2, 0.0).sum(axis=0)
        return [np.array([float(len(x))]), n, mean, dev, *_extremes(x)]

    def combine(a: State, b: State) -> State:
        n = a[1] + b[1]
        share, away = b[1] / np.maximum(n, 1.0), b[2] - a[2]
        dev = a[3] + b[3] + away**2 * a[1] * share
        return [a[0] + b[0], n, a[2] + away * share, dev, np.minimum(a[4], b[4]), np.maximum(a[5], b[5])]

    found = fold_states(_doubles(df, columns), each, combine)
    if found is None:
        return Moments(0, np.zeros(d), np.zeros(d), np.zeros(d))
    rows, n, mean, dev, low, high = found
    std = np.where(high > low, np.sqrt(dev / np.maximum(n, 1.0)), 0.0)
    return Moments(int(rows[0]), n, mean, std)


def co_moments(df: DataFrame, columns: Sequence[str]) -> State | None:
    """``n, mean, spread, product, low, high`` over all rows, by one pass: for columns i, j and the rows where
    both are present their number, the mean of i, its squared deviations, and the products of deviations;
    then the extremes of every column. None without rows."""

    def each(x: np.ndarray) -> State:
        present = ~np.isnan(x)
        counts = np.maximum(present.sum(axis=0), 1)
        pivot = np.where(present, x, 0.0).sum(axis=0) / counts
        z = np.where(present, x - pivot, 0.0)
        shape = (x.shape[1],) * 2
        if present.all():
            n, s = np.full(shape, float(len(x))), np.broadcast_to(z.sum(axis=0)[:, None], shape)
            q = np.broadcast_to((z * z).sum(axis=0)[:, None], shape)
        else:
            mask = present.astype(np.float64)
            n, s, q = mask.T @ mask, z.T @ mask, (z * z).T @ mask
        some = np.maximum(n, 1.0)
        return [n, np.where(n > 0, pivot[:, None] + s / some, 0.0), q - s * s / some, z.T @ z - s * s.T / some, *_extremes(x)]

    def combine(a: State, b: State) -> State:
        n = a[0] + b[0]
        away, share = np.where((a[0] > 0) & (b[0] > 0), b[1] - a[1], 0.0), b[0] / np.maximum(n, 1.0)
        mean = np.where(a[0] > 0, a[1], b[1]) + away * share
        both = a[0] * share
        return [
            n, mean, a[2] + b[2] + away**2 * both, a[3] + b[3] + away * away.T * both,
            np.minimum(a[4], b[4]), np.maximum(a[5], b[5]),
        ]

    return fold_states(_doubles(df, columns), each, combine)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Pearson matrix with pairwise-complete rows, by one pass; a constant column gives NaN."""
    d = len(columns)
    found = co_moments(df, columns)
    if found is None:
        return np.full((d, d), np.nan)
    n, mean, spread, product, low, high = found
    # a column that is constant on the common rows leaves only rounding behind
    whole = spread + n * (mean - np.diag(mean)[:, None]) ** 2
    varies = (spread > 1e-12 * whole) & (spread > n * (1e-13 * np.abs(mean)) ** 2) & (high > low)[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(varies & varies.T, np.clip(product / np.sqrt(spread * spread.T), -1.0, 1.0), np.nan)


def corr_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Absolute correlation of every pair ``i < j``, in long form."""
    r = correlation_matrix(df, columns)
    rows = [
        (i, j, columns[i], columns[j], None if np.isnan(r[i, j]) else float(abs(r[i, j])))
        for i in range(len(columns))
        for j in range(i + 1, len(columns))
    ]
    return df.sparkSession.createDataFrame(rows, "i int, j int, a string, b string, abs_r double")


def redundant_columns(r: np.ndarray, columns: Sequence[str], threshold: float = 0.99) -> list[str]:
    """Columns correlated beyond the threshold with any earlier column, itself dropped or not."""
    above = np.triu(np.nan_to_num(np.abs(r), nan=0.0) > threshold, k=1)
    return [c for c, hit in zip(columns, above.any(axis=0), strict=True) if hit]


def corr_prune(
    df: DataFrame, columns: Sequence[str], *, threshold: float = 0.99
) -> tuple[DataFrame, list[str]]:
    """Drop redundant columns; the order of ``columns`` decides which ones."""
    dropped = redundant_columns(correlation_matrix(df, columns), columns, threshold)
    return df.drop(*dropped), dropped


def zscore(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Standardise with the population std (fitted in one job); a constant column becomes 0."""
    stats = moments(df, columns)

    def scaled(i: int, c: str):
        if stats.stds[i] > 0:
            return (F.col(c) - F.lit(float(stats.means[i]))) / F.lit(float(stats.stds[i]))
        return F.when(F.col(c).isNotNull(), F.lit(0.0))

    return df.withColumns({c: scaled(i, c) for i, c in enumerate(columns)})


@dataclass(frozen=True)
class Reduction:
    """Fitted standardisation and components: everything a later run needs to score rows."""

    columns: list[str]
    means: np.ndarray
    stds: np.ndarray
    loadings: np.ndarray  # d x components
    ratios: np.ndarray  # variance share of every component, largest first

    @property
    def components(self) -> int:
        return self.loadings.shape[1]

    @property
    def variance_retained(self) -> float:
        return float(self.ratios[: self.components].sum())

    @property
    def compression(self) -> float:
        return len(self.columns) / self.components

    def save(self, spark: SparkSession, path: str) -> None:
        """One Parquet row."""
        row = (
            self.columns, self.means.tolist(), self.stds.tolist(), self.loadings.tolist(), self.ratios.tolist()
        )
        schema = (
            "columns array<string>, means array<double>, stds array<double>, "
            "loadings array<array<double>>, ratios array<double>"
        )
        spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Reduction:
        row = spark.read.parquet(path).head()
        return Reduction(
            list(row["columns"]), *[np.array(row[n]) for n in ("means", "stds", "loadings", "ratios")]
        )


def components_for(ratios: Sequence[float], threshold: float) -> int:
    """Smallest count whose cumulative share reaches the threshold, else all."""
    hits = np.flatnonzero(np.cumsum(ratios) >= threshold)
    return int(hits[0]) + 1 if len(hits) else len(ratios)


def components_for_variance(
    ratios: DataFrame, thresholds: Sequence[float], *, order: str = "pc", ratio: str = "ratio"
) -> DataFrame:
    """The same rule on a table of one row per component."""
    running = ratios.select(
        F.col(order).alias("pc"),
        F.sum(ratio).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)).alias("cum"),
    )
    return running.agg(
        F.array(
            *[
                F.struct(
                    F.lit(float(t)).alias("threshold"),
                    F.coalesce(F.min(F.when(F.col("cum") >= t, F.col("pc"))), F.max("pc"))
                    .cast("int")
                    .alias("n_components"),
                )
                for t in thresholds
            ]
        ).alias("r")
    ).select(F.inline("r"))


def centred_factor(df: DataFrame, columns: Sequence[str]) -> State | None:
    """``n, holes, mean, R, low, high`` over all rows, by one pass: R is the triangular factor of the rows minus their
    mean, so that R'R is their scatter. Factors merge by a QR of both and the difference of the means; nothing is
    squared, so a large offset of a column costs no digits of its spread."""

    def each(x: np.ndarray) -> State:
        holes = np.isnan(x)
        x = np.where(holes, 0.0, x)
        mean = x.mean(axis=0)
        mean = mean + (x - mean).mean(axis=0)  # what rounding left of a large mean
        return [np.array([float(len(x))]), np.array([float(holes.sum())]), mean, np.linalg.qr(x - mean, mode="r"), x.min(axis=0), x.max(axis=0)]

    def combine(a: State, b: State) -> State:
        n, away = a[0] + b[0], b[2] - a[2]
        between = np.sqrt(a[0] * b[0] / n) * away
        factor = np.linalg.qr(np.vstack([a[3], b[3], between]), mode="r")
        return [n, a[1] + b[1], a[2] + away * (b[0] / n), factor, np.minimum(a[4], b[4]), np.maximum(a[5], b[5])]

    return fold_states(_doubles(df, columns), each, combine)


def fit_reduction(
    df: DataFrame, columns: Sequence[str], *, variance: float = 0.95, components: int | None = None
) -> Reduction:
    """Standardise (population std) and fit principal components in one pass.

    The components are singular vectors of the merged triangular factor. Signs are fixed: the largest
    loading of a component is positive. Without a given count the smallest one that reaches ``variance``
    is kept.
    """
    d = len(columns)
    found = centred_factor(df, columns)
    n, holes, mean, factor, low, high = found or (np.zeros(1), np.zeros(1), np.zeros(d), np.zeros((0, d)), np.zeros(d), np.zeros(d))
    if holes[0]:
        raise ValueError("missing values where none are allowed; fill them first")
    rows = int(n[0])
    stds = np.where(high > low, np.sqrt((factor**2).sum(axis=0) / max(rows, 1)), 0.0)
    scaled = factor * np.where(stds > 0, 1.0 / np.where(stds > 0, stds, 1.0), 0.0)
    singular, vectors = np.linalg.svd(scaled, full_matrices=True)[1:]
    values = np.zeros(d)
    values[: len(singular)] = singular**2 / max(rows, 1)
    total = values.sum()
    ratios = values / total if total > 0 else np.zeros_like(values)
    # no more components than the data can span
    limit = min(d, max(rows, 1))
    kept = min(components if components is not None else components_for(ratios, variance), limit)
    loadings = vectors.T[:, :kept]
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(kept)])
    return Reduction(
        columns=list(columns),
        means=mean,
        stds=stds,
        loadings=loadings * np.where(signs == 0, 1.0, signs),
        ratios=ratios,
    )


def apply_reduction(
    reduction: Reduction, df: DataFrame, *, keep: Sequence[str] = ("lat", "lon"), out: str = "features"
) -> DataFrame:
    """Scores of a fitted (or reloaded) reduction as ``array<double>``."""
    mean = reduction.means
    scale = np.where(reduction.stds > 0, reduction.stds, 1.0)
    projection = reduction.loadings * (reduction.stds > 0)[:, None]

    @F.arrow_udf("array<double>")
    def score(rows: pa.Array) -> pa.Array:
        if len(rows) == 0:
            return pa.array([], pa.list_(pa.float64()))
        scores = ((kernels.as_matrix(rows) - mean) / scale) @ projection
        offsets = np.arange(len(scores) + 1, dtype=np.int32) * scores.shape[1]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(scores.ravel()))

    vector = F.array(*[F.col(c).cast("double") for c in reduction.columns])
    return df.select(*keep, score(vector).alias(out))


def variance_table(spark: SparkSession, reduction: Reduction) -> DataFrame:
    """Explained share and running share per component."""
    running = np.cumsum(reduction.ratios)
    rows = [(i + 1, float(r), float(c)) for i, (r, c) in enumerate(zip(reduction.ratios, running, strict=True))]
    return spark.createDataFrame(rows, "pc int, ratio double, cumulative double")
