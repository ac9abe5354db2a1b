"""Reading and writing tables on any Hadoop file system URI."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isotherm.functions.exprs import nan_as_null


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder the cluster names; a machine-local one only
    in local mode without that setting."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="isotherm-")
    return f"{shared.rstrip('/')}/isotherm-{name}-{uuid.uuid4().hex}"


def nan_to_null(df: DataFrame) -> DataFrame:
    """NULL for NaN in every floating-point column."""
    floating = {
        f.name: nan_as_null(f.name)
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(floating) if floating else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Header CSV. With a schema there is no inference pass and a malformed row fails."""
    reader = spark.read.option("header", True)
    if schema is None:
        return nan_to_null(reader.option("inferSchema", True).csv(path))
    return nan_to_null(reader.schema(schema).option("mode", "FAILFAST").csv(path))


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Column-pruned scan: only the named columns are decoded."""
    df = spark.read.parquet(path)
    return nan_to_null(df.select(*columns) if columns is not None else df)


def pruned_scan(spark: SparkSession, path: str, *, exclude: Sequence[str] = ("time",)) -> DataFrame:
    """All columns but the excluded ones, decided from the file's own schema."""
    df = spark.read.parquet(path)
    skip = set(exclude)
    return nan_to_null(df.select(*[c for c in df.columns if c not in skip]))


def write_csv(df: DataFrame, path: str, *, single_file: bool = False) -> None:
    """Header CSV, overwriting. One file only on request, for results of bounded size."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)


def write_daily(df: DataFrame, path: str, *, time: str = "time", mode: str = "overwrite") -> None:
    """Hand-off between stages: Parquet by year, files clustered by year and location.

    Tasks hold ranges of (year, location): no task writes a whole large year, and few tasks
    write to the same one.
    """
    by_year = df.withColumn("year", F.year(time)).repartitionByRange("year", "lat", "lon")
    by_year.sortWithinPartitions("year", "lat", "lon", time).write.mode(mode).partitionBy("year").parquet(path)


def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a stage result to the shared folder once and go on from the files.

    Later passes neither repeat the stage nor depend on the executors that computed it.
    """
    path = scratch_path(df.sparkSession, name)
    write_parquet(df, path)
    return df.sparkSession.read.parquet(path)


def write_json(row: DataFrame, path: str) -> None:
    """Metrics or metadata: one row."""
    row.coalesce(1).write.mode("overwrite").json(path)


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return bool(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where))


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str:
    """First path that exists."""
    for path in paths:
        if exists(spark, path):
            return path
    raise FileNotFoundError(f"none of {list(paths)} exists")


def read_components(
    spark: SparkSession, paths: Sequence[str], *, expected: int | None = None, prefix: str = "PC"
) -> DataFrame:
    """Component table from the first path that exists. A fallback with fewer components
    than the model has fails instead of clustering on less."""
    path = first_existing(spark, paths)
    header = spark.read.option("header", True).csv(path).columns  # reads the first line only
    found = [c for c in header if c.startswith(prefix)]
    if not found or (expected is not None and len(found) != expected):
        raise ValueError(f"expected {expected} {prefix} columns, found {len(found)}")
    wanted = {"lat", "lon", *found}
    schema = T.StructType([T.StructField(c, T.DoubleType() if c in wanted else T.StringType()) for c in header])
    return read_csv(spark, path, schema).select("lat", "lon", *found)


def verify_written(df: DataFrame, path: str, *, fmt: str = "parquet") -> DataFrame:
    """Read back what was written and check columns, row count and a checksum of each column."""
    spark = df.sparkSession
    if fmt == "csv":
        header = spark.read.option("header", True).csv(path).columns
        if header != df.columns:
            raise ValueError(f"header {header} instead of {df.columns}")
        back = read_csv(spark, path, df.schema)
        df = nan_to_null(df)  # as read_csv does
    else:
        back = spark.read.format(fmt).load(path)
    if set(back.columns) != set(df.columns):
        raise ValueError(f"columns differ: {sorted(set(back.columns) ^ set(df.columns))}")

    def sums(rows: DataFrame) -> dict[str, object]:
        # decimal sums of hashes: the order of rows does not matter
        each = [F.sum(F.xxhash64(F.col(c)).cast("decimal(38,0)")).alias(f"c{i}") for i, c in enumerate(df.columns)]
        return rows.agg(F.count(F.lit(1)).alias("rows"), *each).first().asDict()

    wanted, found = sums(df), sums(back.select(*df.columns))
    if wanted["rows"] != found["rows"]:
        raise ValueError(f"wrote {wanted['rows']} rows, read {found['rows']}")
    if bad := [c for i, c in enumerate(df.columns) if wanted[f"c{i}"] != found[f"c{i}"]]:
        raise ValueError(f"values differ in {bad}")
    return back

