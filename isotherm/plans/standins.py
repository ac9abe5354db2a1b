"""How the driver tables stand in for gridded inputs, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.operators.grid import Axis, Grid
from isotherm.operators.regrid import Product

METEO_GRID = Grid(Axis(46.0, 0.5, 7), Axis(-124.375, 0.625, 12))
SOLAR_GRID = Grid(Axis(46.5, 1.0, 3), Axis(-124.5, 1.0, 8))
PARAMS = ["T2M", "PRECTOTCORR", "RH2M", "WS2M"]
N_LABELS = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows per site: a supplier is a node of the dense grid, its shipments are days."""
    node = F.col("l_suppkey") - 1
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("site"),
        F.col("l_shipdate").cast("date").alias("time"),
        (F.lit(45.53) + F.expr("(l_suppkey - 1) div 33") * F.lit(0.25)).alias("lat"),
        (F.lit(-124.77) + (node % 33) * F.lit(0.25)).alias("lon"),
        F.col("l_quantity").alias("T2M"),
        F.col("l_extendedprice").alias("PRECTOTCORR"),
        F.col("l_discount").alias("RH2M"),
        F.col("l_tax").alias("WS2M"),
    )


DAILY_SQL = """daily AS (
  SELECT l_suppkey AS site, CAST(l_shipdate AS DATE) AS time,
         45.53e0 + ((l_suppkey - 1) // 33) * 0.25e0 AS lat,
         -124.77e0 + ((l_suppkey - 1) % 33) * 0.25e0 AS lon,
         l_quantity AS T2M, l_extendedprice AS PRECTOTCORR, l_discount AS RH2M, l_tax AS WS2M
  FROM lineitem)"""


def holed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows with NULL, NaN and infinite measures at places the table itself decides."""
    df = table(spark, sf_dir, "lineitem")
    return df.select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity")).alias("T2M"),
        F.when(F.col("l_tax") == 0.08, F.lit(float("nan"))).otherwise(F.col("l_discount")).alias("RH2M"),
        F.when(F.col("l_quantity") == 50.0, F.lit(float("inf")))
        .otherwise(F.col("l_extendedprice"))
        .alias("PRECTOTCORR"),
        F.col("l_tax").alias("WS2M"),
    )


HOLED_SQL = """holed AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_linenumber <> 7 THEN l_quantity END AS T2M,
         CASE WHEN l_tax = 0.08e0 THEN 'nan'::DOUBLE ELSE l_discount END AS RH2M,
         CASE WHEN l_quantity = 50 THEN 'inf'::DOUBLE ELSE l_extendedprice END AS PRECTOTCORR,
         l_tax AS WS2M
  FROM lineitem)"""


def _native(spark: SparkSession, sf_dir: str, grid: Grid, measures: dict[str, str], period: str = "month", key: str = "l_partkey") -> DataFrame:
    """Means per period and native node; the node of a row is its key modulo the grid."""
    rows = table(spark, sf_dir, "lineitem")
    cell = F.expr(f"({key}) % {grid.size}")
    means = (
        rows.groupBy(F.date_trunc(period, "l_shipdate").cast("date").alias("time"), cell.alias("cell"))
        .agg(*[F.avg(c).alias(name) for name, c in measures.items()])
    )
    lat_i = F.expr(f"cell div {grid.lon.size}")
    return means.select(
        "time",
        grid.lat.value(lat_i).alias("lat"),
        grid.lon.value(F.col("cell") % grid.lon.size).alias("lon"),
        *measures,
    )


METEO = {"T2M": "l_quantity", "RH2M": "l_discount"}
SOLAR = {"ALLSKY_SFC_SW_DWN": "l_extendedprice", "CLOUD_AMT": "l_tax"}


def meteo(spark: SparkSession, sf_dir: str) -> Product:
    return Product("meteo", _native(spark, sf_dir, METEO_GRID, METEO), METEO_GRID, list(METEO))


def solar(spark: SparkSession, sf_dir: str) -> Product:
    return Product("solar", _native(spark, sf_dir, SOLAR_GRID, SOLAR), SOLAR_GRID, list(SOLAR))


#: A source finer than its target that reaches beyond it on every side, and the coarse target.
FINE_GRID = Grid(Axis(44.0, 0.3, 20), Axis(-127.0, 0.3, 40))
COARSE_GRID = Grid(Axis(45.53, 1.0, 4), Axis(-124.77, 1.5, 6))
FINE_KEY = "l_orderkey * 131 + l_linenumber * 17"


def fine(spark: SparkSession, sf_dir: str) -> Product:
    return Product("fine", _native(spark, sf_dir, FINE_GRID, METEO, key=FINE_KEY), FINE_GRID, list(METEO))


def solar_days(spark: SparkSession, sf_dir: str) -> Product:
    """Daily rows; about a third of the nodes are missing on a day."""
    return Product("solar", _native(spark, sf_dir, SOLAR_GRID, SOLAR, "day"), SOLAR_GRID, list(SOLAR))


def native_sql(name: str, grid: Grid, measures: dict[str, str], period: str = "month", key: str = "l_partkey") -> str:
    """CTE ``name``: the native product with its node indexes ``sy, sx``."""
    means = ", ".join(f"avg({c}) AS {m}" for m, c in measures.items())
    return f"""{name} AS (
  SELECT CAST(date_trunc('{period}', l_shipdate) AS DATE) AS time,
         (({key}) % {grid.size}) // {grid.lon.size} AS sy, (({key}) % {grid.size}) % {grid.lon.size} AS sx,
         {grid.lat.start}e0 + ((({key}) % {grid.size}) // {grid.lon.size}) * {grid.lat.step}e0 AS lat,
         {grid.lon.start}e0 + ((({key}) % {grid.size}) % {grid.lon.size}) * {grid.lon.step}e0 AS lon,
         {means}
  FROM lineitem GROUP BY ALL)"""


METEO_SQL = native_sql("meteo", METEO_GRID, METEO)
SOLAR_SQL = native_sql("solar", SOLAR_GRID, SOLAR)
FINE_SQL = native_sql("fine", FINE_GRID, METEO, key=FINE_KEY)
SOLAR_DAYS_SQL = native_sql("solar", SOLAR_GRID, SOLAR, "day")


def regrid_sql(
    name: str, grid: Grid, measures: dict[str, str], *, method: str = "linear+nearest", target: Grid | None = None
) -> str:
    """CTEs up to ``{name}_dense``, written without the weight table of the engine: the
    nearest node comes from a brute-force search over all nodes."""
    n, t = name, target or Grid.dense()
    lin = ", ".join(f"sum(w * {m}) AS {m}" for m in measures)
    pick = {
        "linear": lambda m: f"l.{m}",
        "nearest": lambda m: f"s.{m}",
        "linear+nearest": lambda m: f"coalesce(l.{m}, s.{m})",
    }[method]
    values = ", ".join(f"{pick(m)} AS {m}" for m in measures)
    return f"""{n}_pos AS (
  SELECT i AS lat_i, j AS lon_i, {t.lat.start}e0 + i * {t.lat.step}e0 AS lat, {t.lon.start}e0 + j * {t.lon.step}e0 AS lon,
         ({t.lat.start}e0 + i * {t.lat.step}e0 - ({grid.lat.start}e0)) / {grid.lat.step}e0 AS py,
         ({t.lon.start}e0 + j * {t.lon.step}e0 - ({grid.lon.start}e0)) / {grid.lon.step}e0 AS px
  FROM range({t.lat.size}) a(i), range({t.lon.size}) b(j)),
{n}_hull AS (
  SELECT *, CAST(least(floor(py), {grid.lat.size - 2}) AS BIGINT) AS y0, CAST(least(floor(px), {grid.lon.size - 2}) AS BIGINT) AS x0
  FROM {n}_pos WHERE py BETWEEN 0 AND {grid.lat.size - 1} AND px BETWEEN 0 AND {grid.lon.size - 1}),
{n}_frac AS (SELECT *, px - x0 AS u, py - y0 AS v FROM {n}_hull),
{n}_w AS (
  SELECT lat_i, lon_i, y0 AS sy, x0 AS sx, 1 - greatest(u, v) AS w FROM {n}_frac
  UNION ALL SELECT lat_i, lon_i, CASE WHEN u >= v THEN y0 ELSE y0 + 1 END, CASE WHEN u >= v THEN x0 + 1 ELSE x0 END, abs(u - v) FROM {n}_frac
  UNION ALL SELECT lat_i, lon_i, y0 + 1, x0 + 1, least(u, v) FROM {n}_frac),
{n}_need AS (SELECT lat_i, lon_i, count(*) AS n_w FROM {n}_w WHERE w > 1e-9 GROUP BY ALL),
{n}_lin AS (
  SELECT s.time, w.lat_i, w.lon_i, {lin}
  FROM {n}_w w JOIN {n} s USING (sy, sx) JOIN {n}_need k ON k.lat_i = w.lat_i AND k.lon_i = w.lon_i
  WHERE w.w > 1e-9 GROUP BY s.time, w.lat_i, w.lon_i HAVING count(*) = max(k.n_w)),
{n}_node AS (SELECT i AS sy, j AS sx FROM range({grid.lat.size}) a(i), range({grid.lon.size}) b(j)),
{n}_near AS (
  SELECT lat_i, lon_i, sy, sx FROM {n}_pos, {n}_node
  QUALIFY row_number() OVER (PARTITION BY lat_i, lon_i ORDER BY
    round(pow((py - sy) * {grid.lat.step}e0, 2) + pow((px - sx) * {grid.lon.step}e0, 2), 9), sy, sx) = 1),
{n}_dense AS (
  SELECT t.time, CAST(p.lat_i AS INT) AS lat_i, CAST(p.lon_i AS INT) AS lon_i, round(p.lat, 4) AS lat, round(p.lon, 4) AS lon,
         {values}, k.n_w IS NULL AS is_extrapolated
  FROM (SELECT DISTINCT time FROM {n}) t CROSS JOIN {n}_pos p
  JOIN {n}_near q USING (lat_i, lon_i)
  LEFT JOIN {n}_need k ON k.lat_i = p.lat_i AND k.lon_i = p.lon_i
  LEFT JOIN {n}_lin l ON l.time = t.time AND l.lat_i = p.lat_i AND l.lon_i = p.lon_i
  LEFT JOIN {n} s ON s.time = t.time AND s.sy = q.sy AND s.sx = q.sx)"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point table: ``vec_id, label, features``."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("features")
    )


VECTORS_SQL = """pts AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
start AS (SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INT) AS cluster, x AS c
          FROM pts QUALIFY row_number() OVER (ORDER BY vec_id) <= 10)"""


def assign_sql(name: str, centers: str) -> str:
    """CTE ``name``: every point with its nearest row of ``centers(cluster, c)``."""
    return f"""{name} AS (
  SELECT vec_id, label, x, cluster, dist * dist AS d2 FROM (
    SELECT p.vec_id, p.label, p.x, k.cluster, list_distance(p.x, k.c) AS dist FROM pts p, {centers} k)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, cluster) = 1)"""


def update_sql(name: str, assigned: str, old: str | None = None) -> str:
    """CTE ``name(cluster, c)``: mean vector per cluster; empty ones keep the row of ``old``."""
    means = f"""SELECT cluster, list(m ORDER BY dim) AS c FROM (
      SELECT cluster, dim, avg(v) AS m FROM (
        SELECT cluster, unnest(range(len(x))) AS dim, unnest(x) AS v FROM {assigned}) GROUP BY cluster, dim)
    GROUP BY cluster"""
    if old is None:
        return f"{name} AS ({means})"
    return f"{name} AS (SELECT o.cluster, coalesce(m.c, o.c) AS c FROM {old} o LEFT JOIN ({means}) m USING (cluster))"


def settle_sql(expr: str, digits: int) -> str:
    """The quantisation of :func:`isotherm.functions.exprs.settle`."""
    scale = f"{10**digits}e0"
    return f"floor(({expr}) * {scale} + 0.4871e0) / {scale}"


def regime_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily points in 14 dimensions: the four measures, standardised, and their products."""
    from isotherm.operators.reduce import zscore

    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    measures = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    rows = zscore(table(spark, sf_dir, "lineitem").select(*keys, *measures), measures)
    products = [F.col(a) * F.col(b) for i, a in enumerate(measures) for b in measures[i:]]
    return rows.select(*keys, F.array(*measures, *products).alias("features"))
