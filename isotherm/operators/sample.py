"""Exact-size samples without a global sort.

Rows get a hashed position that depends on their key alone. One radix histogram of the positions
gives the total and, for any number of sample sizes at once, the prefix in which the n-th smallest
position lies; the next level refines those prefixes alone. Samples of growing size nest by construction.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.functions.exprs import hash_bits

# The position is cut into levels of 13 bits: 8192 counters a pass.
_BITS, _LEVEL_BITS = 52, 13
# Rows that may share a position; more are no accident of the hash.
_RANKED = 10_000

Cut = tuple[int, int, int]


def cut_points(positions: DataFrame, sizes: Callable[[int], Sequence[int]]) -> dict[int, Cut]:
    """For every sample size n, ``lo, hi, need``: rows below ``lo`` belong to the n smallest, and ``need`` more
    of the rows in ``[lo, hi)``, which share one position. ``sizes`` gets the number of rows.

    A level is one pass for all sizes, with 8192 counters for each prefix that is still open; two
    levels settle tables of up to some ten million rows, four settle any.
    """
    done: dict[int, Cut] = {}
    width, prefixes, open_ = _BITS, [0], None
    while open_ is None or open_:
        width -= _LEVEL_BITS
        inside = positions.filter(F.shiftright("_pos", width + _LEVEL_BITS).isin(prefixes)) if open_ else positions
        counts = inside.groupBy(F.shiftright("_pos", width).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
        table = sorted((r["p"], r["n"]) for r in counts)
        if open_ is None:
            total = sum(n for _, n in table)
            wanted = {n for n in sizes(total)}
            done |= {n: (0, 0, 0) for n in wanted if n <= 0} | {n: (1 << _BITS, 1 << _BITS, 0) for n in wanted if n >= total and n > 0}
            open_ = {n: (0, n) for n in wanted - set(done)}
        following = {}
        for n, (prefix, need) in open_.items():
            for p, size in table:
                if p >> _LEVEL_BITS != prefix:
                    continue
                if size >= need:
                    break
                need -= size
            lo, hi = p << width, (p + 1) << width
            if size == need:
                done[n] = (hi, hi, 0)
            elif width:
                following[n] = (p, need)
            elif size <= _RANKED:
                done[n] = (lo, hi, need)
            else:
                raise ValueError(f"{size} rows share one position: ids is not a row key")
        open_, prefixes = following, sorted({p for p, _ in following.values()})
    return done


def _samples(df: DataFrame, sizes: Callable[[int], Sequence[int]], ids: Sequence[str], seed: int) -> dict[int, DataFrame]:
    positioned = df.withColumn("_pos", hash_bits(*ids, seed=seed))
    out = {}
    for n, (lo, hi, need) in cut_points(positioned.select("_pos"), sizes).items():
        part = df.filter(F.lit(False)) if hi == 0 else df if lo == 1 << _BITS else positioned.filter(F.col("_pos") < lo)
        if need:
            edge = positioned.filter((F.col("_pos") >= lo) & (F.col("_pos") < hi))
            part = part.unionByName(edge.orderBy("_pos", *ids).limit(need))
        out[n] = part.drop("_pos")
    return out


def sample_rows(df: DataFrame, n: int, *, ids: Sequence[str], seed: int = 42) -> DataFrame:
    """The n rows with the smallest hashed position; ``ids`` must be a row key."""
    return _samples(df, lambda total: [n], ids, seed)[n]


def fraction_samples(df: DataFrame, fractions: Sequence[float], *, ids: Sequence[str], seed: int = 42) -> dict[float, DataFrame]:
    """Exactly ``round(fraction * rows)`` rows (halves to even) for each fraction, without replacement."""
    sizes: dict[float, int] = {}

    def of(total: int) -> list[int]:
        sizes.update({f: round(total * f) for f in fractions})
        return list(sizes.values())

    found = _samples(df, of, ids, seed)
    return {f: found[sizes[f]] for f in fractions}


def fraction_sample(df: DataFrame, fraction: float, *, ids: Sequence[str], seed: int = 42) -> DataFrame:
    """The sample of one fraction."""
    return fraction_samples(df, [fraction], ids=ids, seed=seed)[fraction]


def nested_samples(
    df: DataFrame, sizes: Sequence[int | None], *, ids: Sequence[str], seed: int = 42
) -> dict[int | None, DataFrame]:
    """One sample per size, each a subset of the next larger one; ``None`` is all rows."""
    some = [n for n in sizes if n is not None]
    found = _samples(df, lambda total: some, ids, seed) if some else {}
    return {n: df if n is None else found[n] for n in sizes}
