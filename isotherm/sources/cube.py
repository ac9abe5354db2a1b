"""Gridded cubes as tables: one row per time and chunk with a matrix per measure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.functions.exprs import nan_as_null
from isotherm.operators.grid import Grid

# Grid index of the first row and column of a chunk.
_LAT_FROM, _LON_FROM = "lat_from", "lon_from"


def cube_flatten(cube: DataFrame, grid: Grid, variables: Sequence[str], *, time: str = "time") -> DataFrame:
    """``time, lat, lon, <variables>`` from rows whose variables are ``array<array<double>>``
    indexed [lat][lon]; columns ``lat_from, lon_from`` place a chunk, without them a row
    starts at the first node. Every row explodes on its own; nothing is shuffled."""
    origin = {
        c: F.col(c) if c in cube.columns else F.lit(0) for c in (_LAT_FROM, _LON_FROM)
    }
    rows = cube.select(
        time,
        *[value.alias(c) for c, value in origin.items()],
        F.posexplode(F.arrays_zip(*variables)).alias("y", "r"),
    )
    cells = rows.select(
        time,
        (F.col(_LAT_FROM) + F.col("y")).alias("lat_i"),
        _LON_FROM,
        F.posexplode(F.arrays_zip(*[F.col("r").getField(v).alias(v) for v in variables])).alias("x", "c"),
    )
    return cells.select(
        time,
        grid.lat.value(F.col("lat_i")).alias("lat"),
        grid.lon.value(F.col(_LON_FROM) + F.col("x")).alias("lon"),
        *[nan_as_null(F.col("c").getField(v)).alias(v) for v in variables],
    )


def cube_pack(
    df: DataFrame, grid: Grid, variables: Sequence[str], *, time: str = "time", chunk: int = 64
) -> DataFrame:
    """The inverse: a row per time and chunk of at most ``chunk`` by ``chunk`` nodes, absent
    nodes NULL. A group is one chunk of one time, however large the grid; a node that
    occurs twice fails."""
    indexed = grid.with_index(df).withColumns(
        {
            _LAT_FROM: (F.floor(F.col("lat_i") / chunk) * chunk).cast("int"),
            _LON_FROM: (F.floor(F.col("lon_i") / chunk) * chunk).cast("int"),
        }
    )
    height, width = min(chunk, grid.lat.size), min(chunk, grid.lon.size)
    cell = (F.col("lat_i") - F.col(_LAT_FROM)) * width + F.col("lon_i") - F.col(_LON_FROM)
    # copies of a node collapse before the chunk is collected
    once = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("a node occurs twice at one time")).cast("int"))
    nodes = indexed.groupBy(time, _LAT_FROM, _LON_FROM, "lat_i", "lon_i").agg(
        *[F.first(v).alias(v) for v in variables], once.alias("_once")
    )
    packed = nodes.filter("_once IS NULL").groupBy(time, _LAT_FROM, _LON_FROM).agg(
        F.map_from_entries(F.collect_list(F.struct(cell, F.struct(*variables)))).alias("m")
    )

    def axis(start: str, size: int, limit: int):
        """0-based offsets inside a chunk; the last chunk of an axis may be shorter."""
        return F.sequence(F.lit(0), F.least(F.lit(size), F.lit(limit) - F.col(start)) - 1)

    def matrix(v: str):
        return F.transform(
            axis(_LAT_FROM, height, grid.lat.size),
            lambda y: F.transform(
                axis(_LON_FROM, width, grid.lon.size),
                lambda x: F.try_element_at("m", y * width + x).getField(v),
            ),
        )

    return packed.select(time, _LAT_FROM, _LON_FROM, *[matrix(v).alias(v) for v in variables])
