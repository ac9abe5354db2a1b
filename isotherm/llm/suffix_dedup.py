"""Repeated passages by suffix sorting with hashed comparisons.

A byte is removed if a string of ``length`` bytes that covers it also starts anywhere else. Texts are
cut into runs of windows first: the window of ``length`` bytes at p belongs to the anchor, its
leftmost ``GRAM``-byte piece of lowest hash. Equal windows have equal anchors, so only anchors that occur
twice or more matter, and each run of windows with one anchor is judged as a whole: equal runs settle
each other by counting. Where an anchor comes with different runs, their suffixes are sorted: prefix
polynomial hashes give the common extension of two suffixes by binary search, a merge sort
built on that comparison orders those as far from their anchor, and neighbours whose common extension reaches ``length`` are
repeats, compared byte by byte before they count.

A sort holds ``VARIANTS`` different runs at most. An anchor with more is divided first, into groups of
suffixes that alone can be equal: a run is cut where the distance to the anchor passes a multiple of ``WIDTHS``,
and pieces belong together if the bytes that all windows of such a stretch share (its core) have one
hash. Equal pieces settle each other, byte by byte; one of each goes on, to a sort or, where a group
is still too large, to the next width. Pieces of one window have only equal ones in their group. So
what is read again of an anchor are the stretches in which its runs part, never all their windows.

Texts are shuffled twice (to cut out such runs, to remove what repeats), everything else is narrow.
Anchors and runs are counted with partial aggregation, and where counts go back to rows, keys that hold more than
a thousandth of the rows (fewer than a thousand keys) are broadcast: a passage that a third of the documents share is
no hot task.

Defined cases: a null text is empty; texts below ``length`` bytes keep all. Equal texts of at least that
length lose all their bytes, as each repeats the other; repeated rows are such texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.llm.common import join_counts, materialise, text_of

GRAM, VARIANTS = 32, 1_024
WIDTHS = (32, 4, 1)  # distances to the anchor that a piece spans, down to one window
PIECE = 1 << 19  # windows handled at once
BUFFER = 1 << 19  # bytes whose suffixes are sorted together
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
        x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


@lru_cache(maxsize=4)
def _byte_values(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=_U) * _U(2) + _U(1)


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64, kept for the longest n so far (one piece at most)."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.ones(max(n, 1 << 16), dtype=_U)
        known[1:] = base
        with np.errstate(over="ignore"):
            known = np.multiply.accumulate(known)
        _powers[base] = known
    return known[:n]


class Hashes:
    """Prefix polynomial hashes of a byte array."""

    def __init__(self, data: np.ndarray, seed: int = 1) -> None:
        with np.errstate(over="ignore"):
            terms = _byte_values(seed)[data] * _power(_BASE, len(data))
            self.prefix = np.concatenate([np.zeros(1, _U), np.cumsum(terms, dtype=_U)])
        self.shift = _power(_INVERSE, len(data) + 1)

    def windows(self, length: int) -> np.ndarray:
        """Hash of the window at each place."""
        with np.errstate(over="ignore"):
            n = len(self.prefix) - length
            return (self.prefix[length:] - self.prefix[:n]) * self.shift[:n]

    def at(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.prefix[start + length] - self.prefix[start]) * self.shift[start]


def _lowest(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window, from running minima of blocks in both directions."""
    n = len(x)
    full = -(-n // width) * width
    blocks = np.full(full, np.iinfo(_U).max, dtype=_U)
    blocks[:n] = x
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def runs(data: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Anchor hash, hash of the whole run, first window and number of windows, for a text in pieces.

    A run ends where its anchor does. At the seam of two pieces it may be cut, which only
    makes two runs of one; each is judged by itself.
    """
    total = len(data) - length + 1
    for at in range(0, max(total, 0), PIECE):
        count = min(PIECE, total - at)
        part = data[at : at + count + length - 1]
        hashes = Hashes(part)
        grams = _mixed(hashes.windows(GRAM))
        # the low bits hold the place: the leftmost of equal hashes is the anchor
        keyed = (grams & ~_U((1 << 20) - 1)) | np.arange(len(grams), dtype=_U)
        place = (_lowest(keyed, length - GRAM + 1) & _U((1 << 20) - 1)).astype(np.int64)
        start = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        size = np.diff(np.concatenate([start, [count]]))
        anchor = grams[place[start]]
        whole = _mixed(hashes.at(start, size + length - 1) + size.astype(_U))
        # where the anchor lies in the run is part of what makes two runs equal
        yield anchor, _mixed(whole ^ _mixed((place[start] - start).astype(_U))), start + at, size


# ---- suffixes of one buffer ---------------------------------------------------------------


class Suffixes:
    def __init__(self, data: np.ndarray, length: int) -> None:
        self.data, self.length, self.hashes = data, length, Hashes(data, seed=2)

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common extension of suffix pairs, up to ``length``, by binary search on hashes."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.length, np.int64)
        while True:
            open_ = low < high
            if not open_.any():
                return low
            middle = (low + high + 1) >> 1
            same = self.hashes.at(a, middle) == self.hashes.at(b, middle)
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether suffix a sorts before suffix b; equal ones don't."""
        shared = self.extension(a, b)
        end = shared >= self.length
        shared = np.minimum(shared, self.length - 1)
        return ~end & (self.data[a + shared] < self.data[b + shared])

    def sort(self, starts: np.ndarray, cells: np.ndarray | None = None) -> np.ndarray:
        """Suffixes by cell, and sorted within each. ``cells`` numbers ones that may be equal at all;
        without it all are in one cell.

        Bottom-up merge sort: in each round all pairs of neighbouring runs of all cells merge at once, an
        element's new place being its own rank plus its rank in the other run.
        """
        n = len(starts)
        cells = np.zeros(n, np.int64) if cells is None else cells
        order = np.argsort(cells, kind="stable")
        cells, order = cells[order], starts[order]
        first = np.concatenate([[0], np.flatnonzero(np.diff(cells)) + 1]) if n else np.zeros(0, np.int64)
        size = np.diff(np.concatenate([first, [n]]))
        first, end = np.repeat(first, size), np.repeat(first + size, size)
        width, widest = 1, int(size.max(initial=0))
        while width < widest:
            index = np.arange(n)
            run = (index - first) // width
            left = run % 2 == 0
            other = first + np.where(left, run + 1, run - 1) * width
            low, high = np.minimum(other, end), np.minimum(other + width, end)
            base = low.copy()
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) >> 1
                mine, theirs, leading = order[open_], order[middle], left[open_]
                # an element of the left run goes before equal ones of the right run
                earlier = self.before(np.where(leading, theirs, mine), np.where(leading, mine, theirs))
                earlier = np.where(leading, earlier, ~earlier)
                low[open_[earlier]] = middle[earlier] + 1
                high[open_[~earlier]] = middle[~earlier]
            place = first + (run // 2) * 2 * width + (index - first - run * width) + (low - base)
            merged = np.empty_like(order)
            merged[place] = order
            order, width = merged, 2 * width
        return order

    def repeated(self, starts: np.ndarray, cells: np.ndarray | None = None) -> np.ndarray:
        """Which of the suffixes share their first ``length`` bytes with another of their cell."""
        order = self.sort(starts, cells)
        near = np.flatnonzero(self.extension(order[:-1], order[1:]) >= self.length)
        same = np.zeros(len(near), dtype=bool)
        for at in range(0, len(near), 4096):  # the bytes decide, not the hashes
            some = near[at : at + 4096]
            span = np.arange(self.length)
            same[at : at + 4096] = (self.data[order[some][:, None] + span] == self.data[order[some + 1][:, None] + span]).all(1)
        hit = order[np.concatenate([near[same], near[same] + 1])]
        return np.isin(starts, hit)


def _intervals(flags: np.ndarray, first: int, length: int) -> list[tuple[int, int]]:
    """Byte intervals that the flagged windows cover."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(first + int(a), first + int(b) - 1 + length) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def removed(data: bytes, intervals: list[tuple[int, int]]) -> tuple[int, int, str]:
    """Bytes removed, maximal removed runs, and the SHA-256 of what is left."""
    kept, at, gone, spans, end = hashlib.sha256(), 0, 0, 0, -1
    for a, b in sorted(intervals):
        if a > end:
            kept.update(data[at:a])
            spans, gone, end, at = spans + 1, gone + b - a, b, b
        elif b > end:
            gone, end, at = gone + b - end, b, b
    kept.update(data[at:])
    return gone, spans, kept.hexdigest()


# ---- the job ------------------------------------------------------------------------------

_TEXT_KEY = ("t1", "t2")


def _keyed(docs: DataFrame, text: str, key: str) -> DataFrame:
    body = text_of(F.col(text))
    rows = docs.select(F.col(key).alias("key"), body.alias("text"))
    return rows.withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(7), "text")})


def all_runs(rows: DataFrame, length: int) -> DataFrame:
    """Every run of every text: anchor, run, text key, first window and number of windows."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts, held = [], 0
            for t1, t2, t in zip(batch["t1"], batch["t2"], batch["text"], strict=True):
                data = np.frombuffer(t.encode("utf-8", "surrogatepass"), dtype=np.uint8)
                for anchor, run, start, size in runs(data, length):
                    n = len(start)
                    parts.append((anchor.view(np.int64), run.view(np.int64), np.full(n, t1), np.full(n, t2), start, size))
                    held += n
                if held > 200_000:
                    yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*parts, strict=True)), strict=True)))
                    parts, held = [], 0
            if parts:
                yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*parts, strict=True)), strict=True)))

    names = ["anchor", "run", "t1", "t2", "first", "size"]
    return rows.select("t1", "t2", "text").mapInPandas(cut, "anchor long, run long, t1 long, t2 long, first int, size int")


def _segments(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted runs, from one row of each text, and where their anchor begins in them."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, held = [], 0
            for t, t1, t2, runs_ in zip(batch["text"], batch["t1"], batch["t2"], batch["runs"], strict=True):
                data = t.encode("utf-8", "surrogatepass")
                pieces = [data[r["first"] : r["first"] + r["size"] + length - 1] for r in runs_]
                places = _anchor_places(pieces, length)
                for r, at, piece in zip(runs_, places, pieces, strict=True):
                    out.append((r["anchor"], r["v"], r["alone"], t1, t2, r["first"], at, piece))
                    held += len(piece)
                if held > 4 << 20:
                    yield pd.DataFrame(out, columns=names, dtype=object)
                    out, held = [], 0
            if out:
                yield pd.DataFrame(out, columns=names, dtype=object)

    names = ["group", "v", "alone", "t1", "t2", "first", "at", "bytes"]
    lists = wanted.groupBy(*_TEXT_KEY).agg(F.collect_list(F.struct("anchor", "first", "size", "alone", "v")).alias("runs"))
    found = rows.select("t1", "t2", "text").join(lists, list(_TEXT_KEY))
    # equal texts give equal rows: one of each is enough
    return found.mapInPandas(
        cut, "group long, v long, alone boolean, t1 long, t2 long, first int, at int, bytes binary"
    ).dropDuplicates(["group", "t1", "t2", "first"])


def _anchor_places(pieces: list[bytes], length: int) -> list[int]:
    """Where the anchor of each run begins: all its windows have it at one place, so the first one tells."""
    grams = length - GRAM + 1
    out: list[int] = []
    for i in range(0, len(pieces), 1024):
        heads = np.frombuffer(b"".join(p[:length] for p in pieces[i : i + 1024]), dtype=np.uint8)
        hashed = _mixed(Hashes(heads).windows(GRAM)) >> _U(20)
        starts = np.arange(len(heads) // length) * length
        out += hashed[starts[:, None] + np.arange(grams)].argmin(1).tolist()
    return out


def _sorted_repeats(segments: DataFrame, length: int) -> DataFrame:
    """Intervals of the segments that stand alone, from the suffixes of all segments of their group."""

    def judge(group: list[tuple]) -> list[tuple]:
        data = np.frombuffer(b"".join(g[6] for g in group), dtype=np.uint8)
        offset = np.cumsum([0, *(len(g[6]) for g in group)])
        sizes = np.array([len(g[6]) - length + 1 for g in group])
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        starts = np.repeat(offset[:-1], sizes) + inside
        # equal windows have one anchor, and it as far from their start: these two make the cell
        number = np.unique(np.array([g[0] for g in group]), return_inverse=True)[1]
        cells = np.repeat(number, sizes) * length + np.repeat(np.array([g[5] for g in group]), sizes) - inside
        flags, at, out = Suffixes(data, length).repeated(starts, cells), 0, []
        for _, alone, t1, t2, first, _, piece in group:
            n = len(piece) - length + 1
            if alone:
                out += [(t1, t2, a, b) for a, b in _intervals(flags[at : at + n], first, length)]
            at += n
        return out

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, held = [], 0
        for batch in batches:
            out = []
            for row in zip(*(batch[c] for c in ("group", "alone", "t1", "t2", "first", "at", "bytes")), strict=True):
                if held >= BUFFER and row[0] != group[-1][0]:  # a group is never cut
                    out += judge(group)
                    group, held = [], 0
                group.append(row)
                held += len(row[6])
            if out:
                yield pd.DataFrame(out, columns=["t1", "t2", "a", "b"], dtype=object)
        if group:
            yield pd.DataFrame(judge(group), columns=["t1", "t2", "a", "b"], dtype=object)

    spread = segments.repartition("group").sortWithinPartitions("group", "t1", "t2", "first")
    return spread.mapInPandas(sort, "t1 long, t2 long, a int, b int")


def _pieces(segments: DataFrame, width: int, length: int) -> DataFrame:
    """Segments cut by the distance to their anchor; the new group adds the stretch and its core."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            data = np.frombuffer(b"".join(batch["bytes"]), dtype=np.uint8)
            out, cores, offset = [], [], 0
            for g, alone, t1, t2, first, at, piece in zip(
                *(batch[c] for c in ("group", "alone", "t1", "t2", "first", "at", "bytes")), strict=True
            ):
                windows = len(piece) - length + 1
                for stretch in range(at // width, (at - windows + 1) // width - 1, -1):
                    # windows whose anchor is stretch * width up to as much and width - 1 away
                    i, j = max(0, at - stretch * width - width + 1), min(windows - 1, at - stretch * width)
                    out.append((g, stretch, alone, t1, t2, first + i, at - i, piece[i : j + length]))
                    cores.append(offset + at - stretch * width)
                offset += len(piece)
            if out:
                rows = pd.DataFrame(out, columns=names, dtype=object)
                core = Hashes(data, seed=3).at(np.array(cores), length - width + 1)
                owner = _mixed(rows["group"].to_numpy(np.int64).view(_U) + rows["stretch"].to_numpy(np.int64).view(_U))
                rows["group"] = _mixed(core ^ owner).view(np.int64)
                yield rows.drop(columns="stretch")

    names = ["group", "stretch", "alone", "t1", "t2", "first", "at", "bytes"]
    return segments.mapInPandas(cut, "group long, alone boolean, t1 long, t2 long, first int, at int, bytes binary")


def _divided(segments: DataFrame, width: int, length: int) -> tuple[DataFrame, DataFrame]:
    """Intervals of the pieces that equal another one, and one of each kind for what is left to
    compare: groups that hold several kinds, with their number ``v``."""
    cut = materialise(_pieces(segments, width, length), "suffix-pieces")
    kind = ["group", "at", "bytes"]
    kinds = cut.groupBy(*kind).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("t1", "t2", "first")).alias("one"), F.bool_or("alone").alias("open")
    )
    kinds = materialise(kinds, "suffix-pieces-kinds")
    total = cut.count()
    hit = join_counts(cut, kinds.filter("n > 1 AND open").select(*kind, "n"), kind, total=total).filter("alone")
    intervals = hit.select("t1", "t2", F.col("first").alias("a"), (F.col("first") + F.octet_length("bytes")).alias("b"))
    groups = kinds.groupBy("group").agg(
        F.count(F.lit(1)).alias("v"), F.bool_or(F.col("open") & (F.col("n") == 1)).alias("any")
    ).filter("v > 1 AND any").select("group", "v")
    groups = materialise(groups, "suffix-pieces-groups")
    left = join_counts(kinds.select(*kind, "n", "one", "open"), groups, ["group"], n="v", total=kinds.count())
    return intervals, left.select("group", "v", (F.col("open") & (F.col("n") == 1)).alias("alone"), "one.*", "at", "bytes")


def repeats(docs: DataFrame, *, text: str = "text", key: str = "doc_id", length: int = 200) -> DataFrame:
    """One row per document: key, n_bytes, n_removed, n_spans, kept_sha256."""
    rows = _keyed(docs, text, key)
    cut = materialise(all_runs(rows, length), "suffix-runs")
    anchors = cut.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("run").alias("low"), F.max("run").alias("high")).filter("n > 1")
    anchors = materialise(anchors.select("anchor", "n", F.expr("low <> high").alias("mixed")), "suffix-anchors")
    again = materialise(join_counts(cut, anchors, ["anchor"], total=cut.count()).drop("n"), "suffix-again")
    settled = again.filter("NOT mixed")
    # runs of anchors that come with several: those found twice are settled, one of each is kept to compare with
    mixed = again.filter("mixed")
    kinds = mixed.groupBy("anchor", "run").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("t1", "t2", "first", "size")).alias("one")
    )
    kinds = materialise(kinds, "suffix-kinds")
    twice = join_counts(mixed, kinds.filter("n > 1").select("anchor", "run", "n"), ["anchor", "run"], total=mixed.count())
    settled = settled.select("t1", "t2", "first", "size").union(twice.select("t1", "t2", "first", "size"))
    variants = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("v"), F.bool_or(F.col("n") == 1).alias("any"))
    variants = materialise(variants.filter("any").select("anchor", "v"), "suffix-variants")
    wanted = join_counts(kinds, variants, ["anchor"], n="v", total=kinds.count()).select(
        "anchor", "one.*", (F.col("n") == 1).alias("alone"), "v"
    )
    left = materialise(_segments(rows, wanted, length), "suffix-segments")
    intervals = settled.select("t1", "t2", F.col("first").alias("a"), (F.col("first") + F.col("size") + (length - 1)).alias("b"))
    intervals = intervals.union(_sorted_repeats(left.filter(F.col("v") <= VARIANTS), length))
    for width in WIDTHS:
        large = left.filter(F.col("v") > VARIANTS)
        if large.isEmpty():
            break
        found, left = _divided(large, width, length)
        left = materialise(left, "suffix-left")
        intervals = intervals.union(found).union(_sorted_repeats(left.filter(F.col("v") <= VARIANTS), length))
    lists = intervals.groupBy(*_TEXT_KEY).agg(F.collect_set(F.struct("a", "b")).alias("spans"))

    @F.pandas_udf("n_removed long, n_spans long, kept_sha256 string")
    def remove(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = [removed(t.encode("utf-8", "surrogatepass"), [(s["a"], s["b"]) for s in i]) for t, i in zip(texts, spans, strict=True)]
        return pd.DataFrame(out, columns=["n_removed", "n_spans", "kept_sha256"])

    both = rows.join(lists, list(_TEXT_KEY), "left")
    hit = both.filter("spans IS NOT NULL").select("key", "text", remove("text", "spans").alias("r"))
    clean = both.filter("spans IS NULL")
    size = F.octet_length("text").cast("long").alias("n_bytes")
    return hit.select(F.col("key").alias(key), size, "r.*").union(
        clean.select(F.col("key"), size, F.lit(0).cast("long"), F.lit(0).cast("long"), F.sha2(F.col("text").cast("binary"), 256))
    )
