"""Column expressions. All of them stay on the JVM inside generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calendar month -> season name.
SEASON_MONTHS = {
    "winter": (12, 1, 2),
    "spring": (3, 4, 5),
    "summer": (6, 7, 8),
    "fall": (9, 10, 11),
}
# Output order of the seasonal columns.
SEASONS = ("fall", "spring", "summer", "winter")

# Eastern boundary first, open intervals in degrees of longitude.
REGION_CUTS = (
    (-121.0, "Eastern Washington"),
    (-122.5, "Central/Cascade Region"),
)
REGION_DEFAULT = "Western Washington"

# Agreement bands, highest first.
ARI_BANDS = ((0.8, "excellent"), (0.5, "good"), (0.3, "moderate"))
NMI_BANDS = ((0.8, "excellent"), (0.5, "good"))
OVERALL_BANDS = ((0.8, 0.8, "EXCELLENT"), (0.5, 0.6, "GOOD"), (0.3, None, "MODERATE"))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_as_null(c: Column | str) -> Column:
    """NULL is the only missing marker after ingest."""
    c = _col(c)
    return F.when(~F.isnan(c), c)


def season(time: Column | str) -> Column:
    month = F.month(_col(time))
    label = None
    for name, months in SEASON_MONTHS.items():
        hit = month.isin(*months)
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return label


def region(lon: Column | str, cuts=REGION_CUTS, default: str = REGION_DEFAULT) -> Column:
    lon = _col(lon)
    label = None
    for cut, name in cuts:
        label = F.when(lon > cut, name) if label is None else label.when(lon > cut, name)
    return label.otherwise(default)


def round_coord(c: Column | str, digits: int = 4) -> Column:
    return F.round(_col(c), digits)


def squared_distance(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(
        F.zip_with(_col(a), _col(b), lambda x, y: (x - y) * (x - y)),
        F.lit(0.0),
        lambda total, x: total + x,
    )


def distance(a: Column | str, b: Column | str) -> Column:
    return F.sqrt(squared_distance(a, b))


def vector_to_string(vector: Column | str, sep: str = ",") -> Column:
    return F.concat_ws(sep, F.transform(_col(vector), lambda x: x.cast("string")))


def string_to_vector(text: Column | str, sep: str = ",") -> Column:
    return F.split(_col(text), sep).cast("array<double>")


def hash_bits(*ids: Column | str, seed: int = 0) -> Column:
    """52 pseudo-random bits that depend on the row key and the seed only.

    The draw of a row is the same for every partitioning, retry and engine, which
    ``rand(seed)`` (seeded per partition) cannot give.
    """
    text = F.concat_ws("|", *[_col(c).cast("string") for c in ids], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def hash_uniform(*ids: Column | str, seed: int = 0) -> Column:
    """Uniform in [0, 1), keyed by row and seed."""
    return hash_bits(*ids, seed=seed) / F.lit(float(2**52))


def settle(c: Column | str, digits: int) -> Column:
    """Quantise for display and comparison.

    The bin edge lies off the decimal midpoint, where averages of short decimals
    like to fall, so two summation orders that differ in the last bit land in one bin.
    """
    scale = float(10**digits)
    return F.floor(_col(c) * F.lit(scale) + F.lit(0.4871)).cast("double") / F.lit(scale)


def bands(score: Column | str, steps: Sequence[tuple[float, str]], default: str) -> Column:
    score = _col(score)
    label = None
    for cut, name in steps:
        label = F.when(score > cut, name) if label is None else label.when(score > cut, name)
    return label.otherwise(default)


def overall_verdict(ari: Column | str, rate: Column | str) -> Column:
    ari, rate = _col(ari), _col(rate)
    label = None
    for ari_cut, rate_cut, name in OVERALL_BANDS:
        hit = ari > ari_cut if rate_cut is None else (ari > ari_cut) & (rate > rate_cut)
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return label.otherwise("LOW")
