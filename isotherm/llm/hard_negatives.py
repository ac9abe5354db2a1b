"""Hard negatives: rows of another label that score nearly as high as a positive.

Scores are integer inner products. Anchors meet all rows, in blocks: rows are dealt to groups of about
``rows``, anchors to slices of about ``slice_rows``, and each pair of slice and group is one task's
int64 tile, multiplied by Strassen's recursion with zero padding and exact integer additions. A tile
leaves per anchor its best positives in the first pass, and per anchor and positive the best
rows of the window in the second. These short lists are merged by windowed top-k, first within
64 bundles of groups, then over them, so the largest merge of an anchor has 64 lists.
Groups are dealt by row numbers, not by keys, labels or vectors: copies, hot labels and repeated ids
are spread like any other rows. Work is anchors x rows, as asked; what is shuffled is one copy of the
rows a slice and one of the anchors a group.

Rows with a null label, id or vector or a null or non-finite component take no part. Vectors of
different lengths are padded with zeros. Integers beyond 2^((62 - log2 d) / 2) in size (2^28 for 64
dimensions) count as that, so scores fit 64 bits. Rows that repeat an id count on their own: each
is an anchor, a positive or a negative as often as it comes. Ties go to the smaller vec_id. Zero
scores and empty vectors are allowed; a negative positive score has an empty window. Empty tables give empty results.
Columns beside the three named ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isotherm.llm.common import materialise

#: Rows of a group and of a slice, rows multiplied at once, and the side at which the recursion ends.
ROWS, SLICE_ROWS, TILE, LEAF = 4096, 16_384, 1024, 32
POSITIVES, NEGATIVES = 5, 3
_BUNDLES = 64
_NONE = np.iinfo(np.int64).min


# --------------------------------------------------------------------------- products


def _even(a: np.ndarray) -> np.ndarray:
    """Zero padding to even sides."""
    pad = [(0, side % 2) for side in a.shape]
    return np.pad(a, pad) if pad != [(0, 0), (0, 0)] else a


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b.T`` of int64 matrices (rows x d, columns x d), exact modulo 2^64: seven products of half the
    size in place of eight, down to ``leaf``."""
    m, n, d = len(a), len(b), a.shape[1]
    if min(m, n, d) <= leaf:
        return a @ b.T
    a, b = _even(a), _even(b)
    i, j, k = len(a) // 2, len(b) // 2, a.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    # the blocks of b.T
    b11, b21, b12, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    out = np.empty((len(a), len(b)), np.int64)
    c11, c12, c21, c22 = out[:i, :j], out[:i, j:], out[i:, :j], out[i:, j:]
    p = strassen(a11 + a22, b11 + b22, leaf)
    c11[:], c22[:] = p, p
    p = strassen(a21 + a22, b11, leaf)
    c21[:] = p
    c22 -= p
    p = strassen(a11, b12 - b22, leaf)
    c12[:] = p
    c22 += p
    p = strassen(a22, b21 - b11, leaf)
    c11 += p
    c21 += p
    p = strassen(a11 + a12, b22, leaf)
    c11 -= p
    c12 += p
    c22 += strassen(a21 - a11, b11 + b12, leaf)
    c11 += strassen(a12 - a22, b21 + b22, leaf)
    return out[:m, :n]


# --------------------------------------------------------------------------- tiles


def _matrix(table: pa.Table, name: str, width: int) -> np.ndarray:
    """A list column as int64 rows, padded with zeros."""
    column = table.column(name).combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k largest allowed scores of every row; among equals the first columns."""
    if scores.shape[1] > k:
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    else:
        least = np.full(len(scores), _NONE)
    row, column = np.nonzero((scores >= least[:, None]) & (scores != _NONE))
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k]


def _ints(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _tiles(anchors: pa.Table, rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the anchors of a tile and their scores with all rows of the group."""
    width = max((int(np.diff(t.column("x").combine_chunks().offsets.to_numpy()).max(initial=0)) for t in (anchors, rows)))
    a, b = _matrix(anchors, "x", width), _matrix(rows, "x", width)
    for start in range(0, len(a), TILE):
        at = np.arange(start, min(start + TILE, len(a)))
        yield at, strassen(a[at], b)


def _positives(anchors: pa.Table, rows: pa.Table, k: int) -> Iterator[dict]:
    """Best rows of the same label. Rows of other labels need no product here."""
    labels, other = _ints(anchors, "label"), _ints(rows, "label")
    for label in np.intersect1d(labels, other):
        mine, theirs = np.flatnonzero(labels == label), np.flatnonzero(other == label)
        some, all_rows = anchors.take(mine), rows.take(theirs)
        key, ids, them = _ints(some, "r"), _ints(all_rows, "vec_id"), _ints(all_rows, "r")
        for at, scores in _tiles(some, all_rows):
            scores[key[at][:, None] == them] = _NONE
            i, j = _best(scores, k)
            yield {"r": key[at][i], "score": scores[i, j], "vec_id": ids[j], "row": them[j]}


def _window(score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole scores s with 50 p <= 100 s <= 95 p, without overflow: from ceil(p / 2) to floor(19 p / 20)."""
    return -(-score // 2), score // 20 * 19 + score % 20 * 19 // 20


def _negatives(anchors: pa.Table, rows: pa.Table, k: int) -> Iterator[dict]:
    """Best rows of other labels within the window of each positive."""
    labels, other, ids = _ints(anchors, "label"), _ints(rows, "label"), _ints(rows, "vec_id")
    key = _ints(anchors, "r")
    found = anchors.column("positives").combine_chunks()
    offsets, values = found.offsets.to_numpy(), found.flatten()
    score = values.field("score").to_numpy(zero_copy_only=False)
    for at, scores in _tiles(anchors, rows):
        scores[labels[at][:, None] == other] = _NONE
        sizes = np.diff(offsets)[at]
        for place in range(int(sizes.max(initial=0))):
            has = np.flatnonzero(sizes > place)
            low, high = _window(score[offsets[at[has]] + place])
            mine = scores[has]
            mine[(mine < low[:, None]) | (mine > high[:, None])] = _NONE
            i, j = _best(mine, k)
            yield {"r": key[at[has[i]]], "place": np.full(len(i), place), "score": mine[i, j], "vec_id": ids[j]}


# --------------------------------------------------------------------------- passes


def _integers(df: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """``r, vec_id, label, x`` of the rows that take part; ``r`` numbers them."""
    v = F.col("v")
    rows = df.select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v")
    ).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull())
    rows = rows.filter(F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))))
    most = float(1 << 52)
    whole = F.transform(v, lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(most)), F.lit(-most))))
    return rows.select(F.monotonically_increasing_id().alias("r"), "vec_id", "label", whole.alias("x"))


def _top(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best of every key, merged in bundles before they meet."""
    order = [F.desc("score"), F.col("vec_id"), *[F.col(c) for c in rows.columns if c == "row"]]
    place = F.row_number().over(Window.partitionBy(*keys, "bundle").orderBy(*order))
    some = rows.withColumn("rank", place).filter(F.col("rank") <= k)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return some.withColumn("rank", place).filter(F.col("rank") <= k).drop("bundle")


def mine(
    df: DataFrame, *, anchor: Column | None = None, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256,
    positives: int = POSITIVES, negatives: int = NEGATIVES, rows: int = ROWS, slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchor`` says which rows are anchors, as a condition on ``vec_id``; by default every 50th id.
    An anchor's positives are its best ``positives`` other rows of the label; for each, the best ``negatives``
    rows of other labels with 50 p <= 100 s <= 95 p are returned.
    """
    anchor = F.col("vec_id") % 50 == 0 if anchor is None else anchor
    numbered = materialise(_integers(df, key, vector, label, scale), "vectors")
    sizes = numbered.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(anchor, 1).otherwise(0)).alias("anchors"), F.max(F.size("x")).alias("d")
    ).head()
    groups, slices = max(1, -(-sizes["n"] // rows)), max(1, -(-(sizes["anchors"] or 0) // slice_rows))
    limit = F.lit(1 << (62 - max(1, (sizes["d"] or 1) - 1).bit_length()) // 2)
    bounded = numbered.withColumn("x", F.transform("x", lambda c: F.greatest(F.least(c, limit), -limit)))
    dealt = F.xxhash64("r", F.lit(11))
    group, part = F.pmod(F.xxhash64("r"), F.lit(groups)), F.pmod(dealt, F.lit(slices))

    def meet(anchors: DataFrame, work, schema: str) -> DataFrame:
        """One task's tile per slice and group."""
        names = [c.split()[0] for c in schema.split(", ")]

        def tile(where, left: pa.Table, right: pa.Table) -> pa.Table:
            made = [pa.table({n: pa.array(out[n], pa.int64()) for n in names if n != "bundle"}) for out in work(left, right)] if len(left) and len(right) else []
            table = pa.concat_tables(made) if made else pa.table({n: pa.array([], pa.int64()) for n in names if n != "bundle"})
            return table.append_column("bundle", pa.array([where[1].as_py() % _BUNDLES] * len(table), pa.int64()))

        copies = anchors.select("*", part.alias("s"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("g"))
        # ids in order within a group: the first column of equal scores is the smallest id
        others = bounded.select("*", group.alias("g"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("s"))

        def ordered(where, left: pa.Table, right: pa.Table) -> pa.Table:
            # a side without rows has no columns either
            return tile(where, left, right.sort_by([("vec_id", "ascending"), ("r", "ascending")]) if len(right) else right)

        return copies.groupBy("s", "g").cogroup(others.groupBy("s", "g")).applyInArrow(ordered, schema)

    anchors = materialise(bounded.filter(anchor), "anchors")
    near = meet(anchors, lambda a, b: _positives(a, b, positives), "r long, score long, vec_id long, row long, bundle long")
    found = _top(near, ["r"], positives).groupBy("r").agg(
        F.array_sort(F.collect_list(F.struct("rank", "score", "vec_id"))).alias("positives")
    )
    found = materialise(found, "positives")
    windows = meet(
        anchors.join(found, "r"), lambda a, b: _negatives(a, b, negatives), "r long, place long, score long, vec_id long, bundle long"
    )
    hard = _top(windows, ["r", "place"], negatives).select(
        "r", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    named = found.join(anchors.select("r", F.col("vec_id").alias("anchor_id")), "r")
    named = named.select("r", "anchor_id", F.posexplode("positives").alias("place", "positive"))
    return hard.join(named, ["r", "place"]).select(
        "anchor_id", F.col("positive.vec_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), "negative_id",
        F.col("positive.score").alias("positive_score"), "negative_score",
    )
