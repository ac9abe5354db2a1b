"""Regridding over the source nodes that a target needs.

Interpolation weights depend on geometry alone and, on rectilinear grids, follow from the
position of every target index between the source nodes of its axis. So does the set of
nodes that are needed at all: index arithmetic tells it for any row, and the ends of an axis
become range predicates that reach the scan. What is left is packed where it is read: the rows
of one (time, tile of the target grid) become one binary row, a border node one more in the tile
beside it, and the first row of a time in a task announces the time to every tile. One shuffle brings the
packs of a (time, tile) together, where a dense array over the needed nodes alone is filled and all
measures of all products are interpolated by array arithmetic. Memory follows the tile, however
fine or large the source; every product is read once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isotherm.functions.exprs import nan_as_null, round_coord
from isotherm.operators.grid import Axis, Grid

_EDGE = 1e-9
# Rows of a task that are packed together.
_PACKED = 1 << 16


@dataclass(frozen=True)
class Product:
    """A product on its native grid: one row per (time, node), measures in ``params``.

    ``unique=False`` averages repeated (time, node) rows first, with map-side combining.
    ``circular`` names measures in degrees that are interpolated on the unit circle.
    """

    name: str
    rows: DataFrame
    grid: Grid
    params: Sequence[str]
    unique: bool = True
    circular: Sequence[str] = ()


@dataclass(frozen=True)
class AxisPosition:
    """Where target indices of one axis lie between the source nodes."""

    lower: np.ndarray
    upper: np.ndarray
    nearest: np.ndarray  # ties to the lower node
    frac: np.ndarray
    inside: np.ndarray

    @staticmethod
    def of(source: Axis, target: Axis, index: np.ndarray) -> AxisPosition:
        p = (target.start + index * target.step - source.start) / source.step
        lower = np.clip(np.floor(p), 0, max(source.size - 2, 0)).astype(np.int64)
        return AxisPosition(
            lower,
            np.minimum(lower + 1, source.size - 1),
            np.clip(np.ceil(p - 0.5), 0, source.size - 1).astype(np.int64),
            np.clip(p - lower, 0.0, 1.0),
            (p >= -_EDGE) & (p <= source.size - 1 + _EDGE) & (source.size > 1),
        )

    @cached_property
    def needed(self) -> np.ndarray:
        """Source nodes these targets use, in order."""
        return np.unique(np.r_[self.lower, self.upper, self.nearest])


def _tile_index(target: Axis, tile: int, number: int) -> np.ndarray:
    return np.arange(number * tile, min((number + 1) * tile, target.size))


def _position(source: Grid, target: Grid, axis: str, tile: int, number: int) -> AxisPosition:
    goal = getattr(target, axis)
    return AxisPosition.of(getattr(source, axis), goal, _tile_index(goal, tile, number))


def needed_range(source: Axis, target: Axis) -> tuple[float, float]:
    """Coordinates of the outermost source nodes that the target axis uses."""
    ends = AxisPosition.of(source, target, np.array([0, target.size - 1])).needed
    low, high = (source.start + n * source.step for n in (int(ends[0]), int(ends[-1])))
    return min(low, high), max(low, high)


def is_needed(source: Axis, target: Axis, node: Column) -> Column:
    """May a target use the source node? It must lie less than one source step away; the outermost
    nodes also serve the targets beyond them."""
    at = (F.lit(source.start - target.start) + node * F.lit(source.step)) / F.lit(target.step)
    away = F.abs(at - F.least(F.greatest(F.rint(at), F.lit(0.0)), F.lit(float(target.size - 1))))
    return (away <= abs(source.step / target.step) * (1 + _EDGE)) | node.isin(0, source.size - 1)


def node_tiles(source: Axis, target: Axis, tile: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last tile with a target that may use the node; the outermost nodes also serve all
    targets beyond them."""
    at = (source.start + node * source.step - target.start) / target.step
    reach = abs(source.step / target.step)
    first, last = np.floor(at - reach), np.ceil(at + reach)
    before, after = (0, source.size - 1) if source.step * target.step > 0 else (source.size - 1, 0)
    first, last = np.where(node == before, 0, first), np.where(node == after, target.size - 1, last)
    return tuple(np.clip(i, 0, target.size - 1).astype(np.int64) // tile for i in (first, last))


class _NodeArray:
    """The needed source nodes of one tile as a dense array, missing ones NaN."""

    def __init__(self, lat: AxisPosition, lon: AxisPosition, measures: int) -> None:
        self.lat, self.lon = lat, lon
        self.rows, self.columns = lat.needed, lon.needed
        self.values = np.full((len(self.rows) * len(self.columns), measures), np.nan)
        self.seen = np.zeros(len(self.values), dtype=bool)

    def put(self, y: np.ndarray, x: np.ndarray, values: np.ndarray) -> None:
        i = np.minimum(np.searchsorted(self.rows, y), len(self.rows) - 1)
        j = np.minimum(np.searchsorted(self.columns, x), len(self.columns) - 1)
        used = (self.rows[i] == y) & (self.columns[j] == x)
        at = i[used] * len(self.columns) + j[used]
        if self.seen[at].any() or len(np.unique(at)) < len(at):
            raise ValueError("a node occurs twice at one time; use Product(unique=False) to average")
        self.seen[at] = True
        self.values[at] = values[used]

    def take(self, y: np.ndarray, x: np.ndarray) -> np.ndarray:
        grid = self.values.reshape(len(self.rows), len(self.columns), -1)
        return grid[np.ix_(np.searchsorted(self.rows, y), np.searchsorted(self.columns, x))]

    def nearest(self) -> np.ndarray:
        return self.take(self.lat.nearest, self.lon.nearest)

    def hull(self) -> np.ndarray:
        return self.lat.inside[:, None] & self.lon.inside

    def linear(self) -> np.ndarray:
        """A cell is split along the diagonal from its low-low to its high-high corner. A
        vertex without weight is not needed; a missing one makes the target missing."""
        v, u = self.lat.frac[:, None], self.lon.frac[None, :]
        right = (u >= v)[..., None]
        middle = np.where(
            right, self.take(self.lat.lower, self.lon.upper), self.take(self.lat.upper, self.lon.lower)
        )
        corners = (
            (1.0 - np.maximum(u, v), self.take(self.lat.lower, self.lon.lower)),
            (np.abs(u - v), middle),
            (np.minimum(u, v), self.take(self.lat.upper, self.lon.upper)),
        )
        total = sum(np.where(w[..., None] > _EDGE, w[..., None] * value, 0.0) for w, value in corners)
        return np.where(self.hull()[..., None], total, np.nan)


def _measures(product: Product) -> list[str]:
    """Columns that are interpolated: a circular measure travels as sine and cosine."""
    plain = [c for c in product.params if c not in product.circular]
    return plain + [f"{c}__{part}" for c in product.circular for part in ("sin", "cos")]


def needed_rows(product: Product, target: Grid, time: str) -> DataFrame:
    """``time, _lat_node, _lon_node`` and the measures of the rows the target needs.

    Coordinates beyond the outermost needed nodes are cut by a range predicate on the columns
    themselves, which files and partitions can be skipped by; within it, index arithmetic decides. A
    coordinate that is null, or next to a needed node but off it, fails the job.
    """
    rows, keys, used = product.rows, [], F.lit(True)
    for name in ("lat", "lon"):
        source, goal = getattr(product.grid, name), getattr(target, name)
        low, high = needed_range(source, goal)
        slack = abs(source.step) / 2
        rows = rows.filter(F.col(name).between(low - slack, high + slack) | F.col(name).isNull())
        keys.append(source.index(F.col(name)).alias(f"_{name}_node"))
        node = F.rint(source.position(F.col(name)))
        used = used & (is_needed(source, goal, node) | node.isNull())
    rows = rows.filter(used)
    for c in product.circular:
        rows = rows.withColumns({f"{c}__sin": F.sin(F.radians(c)), f"{c}__cos": F.cos(F.radians(c))})
    measures = _measures(product)
    rows = rows.select(time, *keys, *[F.col(c).cast("double").alias(c) for c in measures])
    if not product.unique:
        rows = rows.groupBy(time, "_lat_node", "_lon_node").agg(*[F.avg(nan_as_null(F.col(c))).alias(c) for c in measures])
    return rows


def _packed(product: Product, number: int, target: Grid, time: str, tile: int) -> DataFrame:
    """One row per (time, tile) and ``_PACKED`` rows of a task: node indexes and measures as bytes."""
    rows, measures, grid = needed_rows(product, target, time), len(_measures(product)), product.grid
    tiles = [(ty, tx) for ty in range(-(-target.lat.size // tile)) for tx in range(-(-target.lon.size // tile))]
    schema = T.StructType(
        [rows.schema[time], *[T.StructField(c, T.IntegerType()) for c in ("_p", "_lat_tile", "_lon_tile")],
         *[T.StructField(c, T.BinaryType()) for c in ("_y", "_x", "_values")]]
    )

    def packs(times: pa.Array, tile_ids: list[tuple[int, int]], parts: list[tuple[bytes, bytes, bytes]]) -> pa.RecordBatch:
        y, x, values = zip(*parts, strict=True)
        columns = [times, [number] * len(parts), [t for t, _ in tile_ids], [t for _, t in tile_ids]]
        arrays = [columns[0], *[pa.array(c, pa.int32()) for c in columns[1:]], *[pa.array(c, pa.binary()) for c in (y, x, values)]]
        return pa.RecordBatch.from_arrays(arrays, names=schema.names)

    def split(held: list[pa.RecordBatch], announced: set) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        times = table.column(time).combine_chunks()
        coded = times.dictionary_encode(null_encoding="encode")
        code, distinct = coded.indices.to_numpy(), coded.dictionary
        fresh = [i for i, t in enumerate(distinct) if t not in announced]
        if fresh:
            announced.update(distinct[i] for i in fresh)
            for at in range(0, len(fresh), 1000):
                some = distinct.take(pa.array(np.repeat(fresh[at : at + 1000], len(tiles))))
                yield packs(some, tiles * (len(some) // len(tiles)), [(b"", b"", b"")] * len(some))
        y, x = (table.column(c).to_numpy().astype(np.int64) for c in ("_lat_node", "_lon_node"))
        values = np.column_stack([table.column(c).to_numpy() for c in table.column_names[3:]]).astype(np.float64, copy=False)
        (y0, y1), (x0, x1) = node_tiles(grid.lat, target.lat, tile, y), node_tiles(grid.lon, target.lon, tile, x)
        # a row once per tile it reaches
        wide = x1 - x0 + 1
        copies = (y1 - y0 + 1) * wide
        row = np.repeat(np.arange(len(y)), copies)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)
        ty, tx = y0[row] + nth // wide[row], x0[row] + nth % wide[row]
        order = np.lexsort((tx, ty, code[row]))
        row, ty, tx = row[order], ty[order], tx[order]
        start = np.flatnonzero(np.r_[True, (np.diff(code[row]) != 0) | (np.diff(ty) != 0) | (np.diff(tx) != 0)])
        y32, x32 = y.astype(np.int32), x.astype(np.int32)
        ends = np.r_[start[1:], len(row)]
        for at in range(0, len(start), 1000):
            pieces = [row[a:b] for a, b in zip(start[at : at + 1000], ends[at : at + 1000], strict=True)]
            first = start[at : at + 1000]
            yield packs(
                times.take(pa.array(row[first])), list(zip(ty[first].tolist(), tx[first].tolist(), strict=True)),
                [(y32[r].tobytes(), x32[r].tobytes(), values[r].tobytes()) for r in pieces],
            )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, announced = [], 0, set()
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= _PACKED:
                yield from split(held, announced)
                held, size = [], 0
        if held:
            yield from split(held, announced)

    if measures == 0:
        raise ValueError(f"product {product.name!r} has no measures")
    return rows.mapInArrow(pack, schema)


def regrid_products(
    products: Sequence[Product],
    target: Grid,
    *,
    time: str = "time",
    tile: int = 64,
    method: str = "linear+nearest",
) -> DataFrame:
    """All products on the target grid, inner-joined on (time, node), in one shuffle.

    The products are stacked before the shuffle instead of being joined after it. A time
    must occur in every product, at a node the target needs. Output: ``time, lat_i, lon_i, lat, lon``, the measures, and
    one ``is_extrapolated`` flag per product (suffixed by its name when there are several).

    ``method``: ``linear`` leaves targets outside the hull, or next to a missing source
    value, missing; ``nearest`` uses the nearest node only; ``linear+nearest`` falls back.
    """
    if method not in ("linear", "nearest", "linear+nearest"):
        raise ValueError(f"unknown method {method!r}")
    names = [c for product in products for c in product.params]
    if len(set(names)) < len(names):
        raise ValueError("measures of different products share a name")
    stacked = None
    for number, product in enumerate(products):
        rows = _packed(product, number, target, time, tile)
        stacked = rows if stacked is None else stacked.unionByName(rows)

    flags = []
    if method != "nearest":
        flags = [f"is_extrapolated_{p.name}" if len(products) > 1 else "is_extrapolated" for p in products]
    schema = T.StructType(
        [
            stacked.schema[time],
            T.StructField("lat_i", T.IntegerType()),
            T.StructField("lon_i", T.IntegerType()),
            *[T.StructField(c, T.DoubleType()) for c in names],
            *[T.StructField(f, T.BooleanType()) for f in flags],
        ]
    )
    # what a task needs of the products, without their rows
    plans = [(p.grid, _measures(p), list(p.params), set(p.circular)) for p in products]

    def finished(key, nodes: list[_NodeArray], present: np.ndarray) -> Iterator[pa.RecordBatch]:
        """All targets of one (time, tile), once its rows are in."""
        if not present.all():
            return
        lat_i, lon_i = _tile_index(target.lat, tile, key[1]), _tile_index(target.lon, tile, key[2])
        size = len(lat_i) * len(lon_i)
        arrays = {
            time: pa.repeat(key[0], size),
            "lat_i": pa.array(np.repeat(lat_i, len(lon_i)), pa.int32()),
            "lon_i": pa.array(np.tile(lon_i, len(lat_i)), pa.int32()),
        }
        for number, (_, measures, params, circular) in enumerate(plans):
            around = nodes[number]
            values = around.nearest() if method != "linear" else around.linear()
            if method == "linear+nearest":
                exact = around.linear()
                values = np.where(np.isnan(exact), values, exact)
            flat = dict(zip(measures, values.reshape(size, -1).T, strict=True))
            for c in params:
                column = flat.get(c)
                if c in circular:
                    column = np.degrees(np.arctan2(flat[f"{c}__sin"], flat[f"{c}__cos"])) % 360.0
                arrays[c] = pa.array(np.ascontiguousarray(column), from_pandas=True)
            if flags:
                arrays[flags[number]] = pa.array(~around.hull().ravel())
        yield pa.RecordBatch.from_arrays([arrays[f] for f in schema.names], names=schema.names)

    def interpolate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Packs arrive sorted by (time, tile); one group is open at a time."""
        key, nodes, present = None, [], None
        positions = cache(lambda p, axis, number: _position(plans[p][0], target, axis, tile, number))
        for batch in batches:
            times = batch.column(time)
            columns = [batch.column(c).to_pylist() for c in ("_p", "_lat_tile", "_lon_tile")]
            for at, (p, ty, tx) in enumerate(zip(*columns, strict=True)):
                if key is None or (ty, tx) != key[1:] or not key[0].equals(times[at]):
                    if key is not None:
                        yield from finished(key, nodes, present)
                    key, present = (times[at], ty, tx), np.zeros(len(plans), dtype=bool)
                    nodes = [
                        _NodeArray(positions(n, "lat", ty), positions(n, "lon", tx), len(measures))
                        for n, (_, measures, _, _) in enumerate(plans)
                    ]
                present[p] = True
                y, x, values = (batch.column(c)[at].as_buffer() for c in ("_y", "_x", "_values"))
                if y.size:
                    nodes[p].put(
                        np.frombuffer(y, np.int32), np.frombuffer(x, np.int32), np.frombuffer(values, np.float64).reshape(-1, len(plans[p][1]))
                    )
        if key is not None:
            yield from finished(key, nodes, present)

    # Sorted partitions instead of a grouped map: that one opens a stream per group.
    group = [time, "_lat_tile", "_lon_tile"]
    dense = stacked.repartition(*group).sortWithinPartitions(*group).mapInArrow(interpolate, schema)
    return dense.select(
        time,
        "lat_i",
        "lon_i",
        round_coord(target.lat.value(F.col("lat_i"))).alias("lat"),
        round_coord(target.lon.value(F.col("lon_i"))).alias("lon"),
        *names,
        *flags,
    )


def regrid(product: Product, target: Grid, **options) -> DataFrame:
    """One product on the target grid; see :func:`regrid_products`."""
    return regrid_products([product], target, **options)
