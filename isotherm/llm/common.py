"""Small helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.sources.tables import materialise

__all__ = ["drawn", "fresh", "join_counts", "small_batches", "materialise", "table", "text_of", "words_of"]

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]+"
#: A key with more than one in so many rows is no longer shuffled to one task.
HEAVY = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Hand texts to Python in smaller batches than Spark's default, for bounded memory with long
    texts; a session that already asks for fewer rows keeps its setting."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, rows)


def text_of(text: Column) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words_of(text: Column, *, lower: bool = False) -> Column:
    """Words of a text as an array; ``lower`` folds A-Z only."""
    if lower:
        text = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(text, SPACES), "")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that no column of ``df`` has, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def join_counts(rows: DataFrame, counts: DataFrame, on: list[str], *, n: str = "n", total: int) -> DataFrame:
    """``rows`` joined with ``counts``, a written table with one row per key of which ``n`` says how
    many of the ``total`` rows have it.

    Keys that hold more than one row in ``HEAVY`` are fewer than ``HEAVY``, by arithmetic, and are broadcast, so their
    rows stay where they are; only the others are shuffled.
    """
    heavy = counts.filter(F.col(n) > max(1, total // HEAVY))
    light = counts.filter(F.col(n) <= max(1, total // HEAVY))
    if heavy.isEmpty():
        return rows.join(light, on)
    heavy = F.broadcast(heavy)
    if light.isEmpty():
        return rows.join(heavy, on)
    return rows.join(heavy, on).unionByName(rows.join(heavy, on, "left_anti").join(light, on))


def drawn(rows: DataFrame, most: int, *by: str) -> DataFrame:
    """At most ``most`` rows, about so many where there are more, chosen by the hash of the columns
    ``by``. Rows are first thinned to their share, so no task returns more than its part."""
    total = rows.count()
    if total <= most:
        return rows
    place = F.xxhash64(*by)
    share = F.lit(int(min(1.0, 1.25 * most / total) * (1 << 53)))
    thinned = rows.filter(place.bitwiseAND(F.lit((1 << 53) - 1)) < share)
    return thinned.orderBy(place, *by).limit(most)
