"""Partial results of tasks, added up on the executors.

A task hands over one row per key: the key, its position ``part`` and arrays of numbers.
Rows meet in groups of ``fan`` consecutive positions, are added element by element in the
order of their positions, and the sums meet again the same way. No task ever holds more
than ``fan`` arrays of a key, and since the order is fixed, so is every last bit.
States that do not simply add up are merged by a function in the same tree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN = 32


def task_part() -> int:
    """Position of the running task, for partials made in Python."""
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def _added(rows: Column, name: str) -> Column:
    """Element-wise sum of the arrays ``name`` in a sorted list of partials."""
    rest = F.slice(rows, F.lit(2), F.size(rows))
    return F.aggregate(rest, rows[0][name], lambda total, row: F.zip_with(total, row[name], lambda a, b: a + b))


def merge_arrays(
    partials: DataFrame, keys: Sequence[str], arrays: Sequence[str], *, parts: int, fan: int = FAN, part: str = "part", keep: int = 1
) -> DataFrame:
    """``keys, arrays``: the sums of all partials of a key, for positions ``0..parts-1``.

    ``keep`` leaves the last levels to the reader: at most so many rows of a key, and none is shuffled if the
    tasks were so few.

    Every array of a column has the same length for one key. At most ``parts`` rows of a key
    are shuffled, then ``parts / fan``, and so on; nothing passes through the driver or Python.
    An empty input gives an empty table.
    """
    if fan < 2:
        raise ValueError("fan must be 2 at least")
    columns = [*keys, *arrays]
    rows = partials.select(F.col(part).cast("long").alias("_part"), *columns)
    while parts > keep:
        level = rows.groupBy(*keys, F.floor(F.col("_part") / fan).alias("_next")).agg(
            F.array_sort(F.collect_list(F.struct("_part", *arrays))).alias("_all")
        )
        rows = level.select(F.col("_next").alias("_part"), *keys, *[_added(F.col("_all"), a).alias(a) for a in arrays])
        parts = -(-parts // fan)
    return rows.select(*columns)


def add_rows(partials: DataFrame, keys: Sequence[str], array: str, *, shards: int) -> DataFrame:
    """``partials`` with one row per key (whole numbers) left: the sum of its arrays, which must add exactly.

    As their order does not matter, a task adds rows as they come and holds the sums of its keys alone, however
    many tasks handed them over. Arrays are of one length.
    """
    names = [f.name for f in partials.schema]
    rest = [n for n in names if n not in (*keys, array)]

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: dict[tuple, int] = {}
        totals: np.ndarray | None = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = batch.column(names.index(array)).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            found = zip(*(batch.column(names.index(k)).to_pylist() for k in keys), strict=True)
            place = np.array([at.setdefault(k, len(at)) for k in found])
            if totals is None:
                totals = np.zeros((0, x.shape[1]))
            if len(at) > len(totals):
                totals = np.vstack([totals, np.zeros((max(len(at), 2 * len(totals)) - len(totals), x.shape[1]))])
            np.add.at(totals, place, x)
        if totals is not None:
            columns = dict(zip(keys, (np.array(c) for c in zip(*at, strict=True)), strict=True))
            columns |= {n: np.zeros(len(at), np.int64) for n in rest} | {array: list(totals[: len(at)])}
            yield pa.RecordBatch.from_arrays([pa.array(columns[n]).cast(batch.schema.field(n).type) for n in names], names=names)

    return partials.repartition(shards, *keys).mapInArrow(add, partials.schema)


State = list[np.ndarray]


def fold_states(
    df: DataFrame, each: Callable[[np.ndarray], State], combine: Callable[[State, State], State], *, fan: int = FAN
) -> State | None:
    """One state of all rows of numeric columns; None without any row.

    ``each`` makes the state of a batch, a matrix with NaN for missing values, ``combine`` that of two
    neighbours. A task hands over one binary row; while there are more than ``fan`` of them, groups of
    ``fan`` neighbours merge on the executors, and the root is the driver. The rows are read once.
    """

    def packed(part: int, state: State) -> pa.RecordBatch:
        arrays = [pa.array([part], pa.int64()), pa.array([[a.tobytes() for a in state]], pa.list_(pa.binary()))]
        arrays.append(pa.array([[list(a.shape) for a in state]], pa.list_(pa.list_(pa.int64()))))
        return pa.RecordBatch.from_arrays(arrays, names=["part", "state", "shapes"])

    def states(t: pa.Table | pa.RecordBatch) -> list[State]:
        rows = sorted(zip(*(t.column(c).to_pylist() for c in ("part", "state", "shapes")), strict=True), key=lambda r: r[0])
        return [[np.frombuffer(b).reshape(s) for b, s in zip(state, shapes, strict=True)] for _, state, shapes in rows]

    def start(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns])
                total = each(x) if total is None else combine(total, each(x))
        if total is not None:
            yield packed(task_part(), total)

    schema = "part long, state array<binary>, shapes array<array<bigint>>"
    rows, parts = df.mapInArrow(start, schema), df.rdd.getNumPartitions()
    while parts > fan:

        def merge(key, t):
            return pa.Table.from_batches([packed(key[0].as_py(), reduce(combine, states(t)))])

        rows = rows.groupBy(F.floor(F.col("part") / fan).alias("next")).applyInArrow(merge, schema)
        parts = -(-parts // fan)
    found = states(rows.toArrow())
    return reduce(combine, found) if found else None
