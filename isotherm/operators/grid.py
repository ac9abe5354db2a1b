"""Rectilinear grids, axes, boxes and joins on grid keys."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Study area, inclusive on both ends, and the observation window.
LAT_RANGE = (45.53, 49.0)
LON_RANGE = (-124.77, -116.92)
SPACING = 0.25
TIME_RANGE = ("2018-01-01", "2024-12-31")


@dataclass(frozen=True)
class Axis:
    start: float
    step: float
    size: int

    def value(self, index: Column) -> Column:
        return F.lit(self.start) + index * F.lit(self.step)

    def position(self, coord: Column) -> Column:
        """Fractional index of a coordinate."""
        return (coord - F.lit(self.start)) / F.lit(self.step)

    def index(self, coord: Column, tolerance: float = 1e-3) -> Column:
        """Integer index of a node; a coordinate off the axis fails the job."""
        p = self.position(coord)
        i = F.rint(p)
        on_axis = (F.abs(p - i) <= tolerance) & i.between(0, self.size - 1)
        message = F.concat(F.lit(f"not a node of {self}: "), F.coalesce(coord.cast("string"), F.lit("NULL")))
        return F.when(on_axis, i.cast("int")).otherwise(F.raise_error(message).cast("int"))

    @staticmethod
    def covering(lo: float, hi: float, step: float) -> Axis:
        """Nodes ``lo, lo+step, ...`` up to, but not including, ``hi+step``."""
        return Axis(lo, step, math.ceil((hi + step - lo) / step))


@dataclass(frozen=True)
class Grid:
    lat: Axis
    lon: Axis

    @property
    def size(self) -> int:
        return self.lat.size * self.lon.size

    @staticmethod
    def dense(lat_range=LAT_RANGE, lon_range=LON_RANGE, spacing: float = SPACING) -> Grid:
        return Grid(Axis.covering(*lat_range, spacing), Axis.covering(*lon_range, spacing))

    def nodes(self, spark: SparkSession) -> DataFrame:
        """``lat_i, lon_i, lat, lon``: the product of both axes, made by index arithmetic."""
        ids = spark.range(self.size)
        lat_i = F.expr(f"cast(id div {self.lon.size} as int)")
        lon_i = F.expr(f"cast(id % {self.lon.size} as int)")
        return ids.select(
            lat_i.alias("lat_i"),
            lon_i.alias("lon_i"),
            self.lat.value(lat_i).alias("lat"),
            self.lon.value(lon_i).alias("lon"),
        )

    def with_index(self, df: DataFrame, *, lat: str = "lat", lon: str = "lon") -> DataFrame:
        """Add the integer keys of native nodes."""
        return df.withColumns({"lat_i": self.lat.index(F.col(lat)), "lon_i": self.lon.index(F.col(lon))})

    def snap(self, df: DataFrame, *, lat: str = "lat", lon: str = "lon") -> DataFrame:
        """Add the integer keys of the nearest node (halves go down, edges clamp)."""
        def nearest(axis: Axis, coord: str) -> Column:
            i = F.ceil(axis.position(F.col(coord)) - 0.5)
            return F.least(F.greatest(i, F.lit(0)), F.lit(axis.size - 1)).cast("int")

        return df.withColumns({"lat_i": nearest(self.lat, lat), "lon_i": nearest(self.lon, lon)})


def infer_axis(df: DataFrame, column: str) -> Axis:
    """Axis of a uniform grid from its extent and distinct count (three numbers come back)."""
    row = (
        df.groupBy(column)
        .agg(F.lit(1).alias("one"))
        .agg(F.min(column).alias("lo"), F.max(column).alias("hi"), F.count("one").alias("n"))
        .head()
    )
    step = (row.hi - row.lo) / (row.n - 1) if row.n > 1 else 1.0
    return Axis(row.lo, step, row.n)


def bbox_filter(
    df: DataFrame,
    *,
    lat_range: Sequence[float] = LAT_RANGE,
    lon_range: Sequence[float] = LON_RANGE,
    lat: str = "lat",
    lon: str = "lon",
) -> DataFrame:
    """Inclusive box; a plain range predicate, so it reaches the scan."""
    return df.filter(F.col(lat).between(*lat_range) & F.col(lon).between(*lon_range))


def day_axis(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per calendar day, both ends included."""
    return spark.range(1).select(
        F.explode(
            F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))
        ).alias("time")
    )


def time_slice(df: DataFrame, start: str, end: str, *, time: str = "time") -> DataFrame:
    """Rows of the days ``start..end``. The bound on a timestamp is half open, so the
    predicate needs no cast of the column and reaches the scan."""
    after = F.date_add(F.lit(end).cast("date"), 1)
    kind = df.schema[time].dataType
    return df.filter(
        (F.col(time) >= F.lit(start).cast("date").cast(kind)) & (F.col(time) < after.cast(kind))
    )


# Fixed value: bits of Spark's bitmaps.
_BITS = 32_768


def missing_days(
    df: DataFrame, start: str, end: str, *, keys: Sequence[str] = ("lat", "lon"), time: str = "time"
) -> DataFrame:
    """Days without an observation: per key, or overall when ``keys`` is empty.

    The days of a key become bits, set before the shuffle, so one scan and one shuffle of a bitmap per task
    and key answer it, and a key that holds most rows travels once per task. Unset bits come out as days. A key
    without a day in the window misses all of them.
    """
    first = date.fromisoformat(start)
    n = (date.fromisoformat(end) - first).days + 1
    index = F.datediff(F.col(time).cast("date"), F.lit(first))
    windows = range(0, max(n, 1), _BITS)
    bitmaps = [
        F.bitmap_construct_agg(F.when(index.between(low, min(low + _BITS, n) - 1), index - low).cast("long")).alias(f"_days{low}")
        for low in windows
    ]
    seen = df.groupBy(*keys).agg(*bitmaps)

    # seven bytes at a time, the first one highest, fit a long
    step = 56

    def word(low: int) -> Column:
        count = -(-min(_BITS, n - low) // step)
        part = lambda g: F.substring(F.col(f"_days{low}"), (g * 7 + 1).cast("int"), F.lit(7))
        value = lambda g: F.conv(F.hex(F.rpad(part(g), 7, F.unhex(F.lit("00")))), 16, 10).cast("long")
        return F.transform(
            F.sequence(F.lit(0), F.lit(count - 1)), lambda g: F.struct((g * step + low).alias("start"), F.lit(min(low + _BITS, n)).alias("end"), value(g).alias("bits"))
        )

    if n <= 0:
        return seen.select(*keys, F.lit(first).alias(time)).limit(0)
    words = seen.select(*keys, F.explode(F.concat(*[word(low) for low in windows])).alias("_word"))
    start_, bits = F.col("_word.start"), F.col("_word.bits")
    places = F.sequence(F.lit(0), F.least(F.lit(step), F.col("_word.end") - start_) - 1)
    unset = F.filter(places, lambda p: F.bit_get(bits, F.lit(48) - F.floor(p / 8).cast("int") * 8 + p % 8) == 0)
    gaps = words.filter(bits != (1 << step) - 1).select(*keys, start_.alias("_start"), F.explode(unset).alias("_place"))
    return gaps.select(*keys, F.date_add(F.lit(first), F.col("_start") + F.col("_place")).alias(time))


def grid_join(
    left: DataFrame, right: DataFrame, *, keys: Sequence[str] = ("time", "lat_i", "lon_i")
) -> DataFrame:
    """Inner join of two products on integer grid keys; display columns come from the left."""
    shared = [c for c in right.columns if c in left.columns and c not in keys]
    return left.join(right.drop(*shared), list(keys), "inner")


def colocated_join(
    left: DataFrame,
    right: DataFrame,
    *,
    keys: Sequence[str] = ("time", "lat", "lon"),
    digits: int = 4,
) -> DataFrame:
    """Join of two products at the nodes both native grids share.

    Coordinates are compared as whole multiples of 10^-digits degrees.
    """
    def keyed(df: DataFrame) -> DataFrame:
        scale = float(10**digits)
        return df.withColumns(
            {f"_{c}": F.round(F.col(c) * scale).cast("long") for c in keys[1:]}
        )

    on = [keys[0], *[f"_{c}" for c in keys[1:]]]
    return keyed(left).join(keyed(right).drop(*keys[1:]), on, "inner").drop(*on[1:])


def union_products(products: Mapping[str, DataFrame], *, tag: str = "product") -> DataFrame:
    """All products in one long table; a measure a product lacks is NULL there."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in products.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
