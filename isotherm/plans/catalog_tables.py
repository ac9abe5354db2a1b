"""Queries: sources, projections, predicates, scalar functions, data quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.functions import exprs
from isotherm.functions.exprs import settle
from isotherm.operators import columns as co
from isotherm.operators import grid as gr
from isotherm.operators import quality as qa
from isotherm.plans.registry import query
from isotherm.plans.standins import (
    DAILY_SQL,
    HOLED_SQL,
    METEO_GRID,
    METEO_SQL,
    PARAMS,
    VECTORS_SQL,
    daily,
    holed,
    meteo,
    table,
    vectors,
)
from isotherm.plans.standins import settle_sql as st
from isotherm.sources import cube, tables


@query("""SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders""")
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate")
    )
    path = tables.scratch_path(spark, "orders")
    tables.write_csv(rows, path)
    return tables.verify_written(rows, path, fmt="csv")


@query("""SELECT c_custkey, c_acctbal, c_mktsegment FROM customer""")
def pruned_scan(spark: SparkSession, sf: str) -> DataFrame:
    return tables.pruned_scan(spark, f"{sf}/customer.parquet", exclude=("c_name", "c_nationkey"))


@query(f"""WITH {METEO_SQL},
nodes AS (SELECT i AS sy, j AS sx FROM range(7) a(i), range(12) b(j))
SELECT t.time, 46e0 + n.sy * 0.5e0 AS lat, -124.375e0 + n.sx * 0.625e0 AS lon,
       {st("m.T2M", 4)} AS T2M, {st("m.RH2M", 5)} AS RH2M
FROM (SELECT DISTINCT time FROM meteo) t CROSS JOIN nodes n LEFT JOIN meteo m USING (time, sy, sx)""")
def cube_flatten(spark: SparkSession, sf: str) -> DataFrame:
    product = meteo(spark, sf)
    stored = cube.cube_pack(product.rows, METEO_GRID, product.params)
    return cube.cube_flatten(stored, METEO_GRID, product.params).select(
        "time", "lat", "lon", settle("T2M", 4).alias("T2M"), settle("RH2M", 5).alias("RH2M")
    )


@query(f"""WITH {DAILY_SQL}
SELECT count(*) AS n_rows, count(DISTINCT (lat, lon)) AS n_locations, min(time) AS time_min, max(time) AS time_max,
       min(lat) AS lat_min, max(lat) AS lat_max, min(lon) AS lon_min, max(lon) AS lon_max,
       count(DISTINCT time) AS n_times, 4::BIGINT AS n_params FROM daily""")
def dataset_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return qa.dataset_metadata(daily(spark, sf).drop("site"))


@query("""SELECT event_id, user_id, value, event_type FROM events""")
def project_available(spark: SparkSession, sf: str) -> DataFrame:
    wanted = ["value", "event_type", "pressure", "humidity"]
    found, missing = co.project_available(table(spark, sf, "events"), wanted, keys=("event_id", "user_id"))
    if missing != ["pressure", "humidity"]:
        raise AssertionError(missing)
    return found


@query(f"""WITH {DAILY_SQL}
SELECT site, time, lat, lon, T2M FROM daily
WHERE lat BETWEEN 45.53e0 AND 46.1e0 AND lon BETWEEN -122.0e0 AND -118.0e0""")
def bbox_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = daily(spark, sf).select("site", "time", "lat", "lon", "T2M")
    return gr.bbox_filter(rows, lat_range=(45.53, 46.1), lon_range=(-122.0, -118.0))


@query("""SELECT event_id, CAST(ts AS DATE) AS day, value FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'""")
def time_slice(spark: SparkSession, sf: str) -> DataFrame:
    rows = gr.time_slice(table(spark, sf, "events"), "2024-01-08", "2024-01-21", time="ts")
    return rows.select("event_id", F.col("ts").cast("date").alias("day"), "value")


@query(f"""WITH {DAILY_SQL}
SELECT s.site, CAST(d.day AS DATE) AS time FROM (SELECT DISTINCT site FROM daily) s
CROSS JOIN generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY) d(day)
WHERE NOT EXISTS (SELECT 1 FROM daily x WHERE x.site = s.site AND x.time = CAST(d.day AS DATE))""")
def missing_days(spark: SparkSession, sf: str) -> DataFrame:
    return gr.missing_days(daily(spark, sf), "1995-01-01", "2001-12-31", keys=("site",))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, f[1] AS f1, f[2] AS f2, f[3] AS f3, len(f) AS size
FROM (SELECT *, [l_quantity, CAST(l_linenumber AS DOUBLE), l_tax] AS f FROM lineitem)""")
def assemble_features(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    out = co.assemble_features(
        table(spark, sf, "lineitem"), ["l_quantity", "l_linenumber", "l_tax"], keep=keys
    )
    flat = co.flatten_features(out, 3, keep=[*keys, "features"], prefix="f")
    return flat.select(*keys, "f1", "f2", "f3", F.size("features").cast("long").alias("size"))


@query(f"""WITH {VECTORS_SQL}
SELECT vec_id, len(x) AS size, x[1] AS first, x[64] AS last, {st("list_sum(x)", 6)} AS total FROM pts""")
def vector_string(spark: SparkSession, sf: str) -> DataFrame:
    text = vectors(spark, sf).select("vec_id", exprs.vector_to_string("features").alias("features_str"))
    back = text.select("vec_id", exprs.string_to_vector("features_str").alias("x"))
    total = F.aggregate("x", F.lit(0.0), lambda t, v: t + v)
    return back.select(
        "vec_id",
        F.size("x").cast("long").alias("size"),
        F.col("x")[0].alias("first"),
        F.element_at("x", -1).alias("last"),
        settle(total, 6).alias("total"),
    )


@query("""SELECT c_custkey, round(45.53e0 + c_custkey / 30011e0, 4) AS lat, round(-124.77e0 + c_custkey / 20011e0, 4) AS lon
FROM customer""")
def coord_round(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        "c_custkey",
        exprs.round_coord(F.lit(45.53) + key / F.lit(30011.0)).alias("lat"),
        exprs.round_coord(F.lit(-124.77) + key / F.lit(20011.0)).alias("lon"),
    )


@query("""SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter' WHEN month(o_orderdate) <= 5 THEN 'spring'
WHEN month(o_orderdate) <= 8 THEN 'summer' ELSE 'fall' END AS season FROM orders""")
def season_label(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", exprs.season("o_orderdate").alias("season"))


@query(f"""WITH {DAILY_SQL}
SELECT site, CASE WHEN avg(lon) > -121 THEN 'Eastern Washington' WHEN avg(lon) > -122.5 THEN 'Central/Cascade Region'
ELSE 'Western Washington' END AS region FROM daily GROUP BY site""")
def region_label(spark: SparkSession, sf: str) -> DataFrame:
    centers = daily(spark, sf).groupBy("site").agg(F.avg("lon").alias("lon"))
    return centers.select("site", exprs.region("lon").alias("region"))


@query("""SELECT a.vec_id, b.vec_id AS other_id,
""" + f"""{st("list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))", 6)} AS distance,
{st("pow(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 2)", 6)} AS squared
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def vector_distance(spark: SparkSession, sf: str) -> DataFrame:
    a = vectors(spark, sf).select("vec_id", F.col("features").alias("a"))
    b = a.select(F.col("vec_id").alias("other_id"), F.col("a").alias("b"), (F.col("vec_id") - 1).alias("vec_id"))
    return a.join(b, "vec_id").select(
        "vec_id",
        "other_id",
        settle(exprs.distance("a", "b"), 6).alias("distance"),
        settle(exprs.squared_distance("a", "b"), 6).alias("squared"),
    )


@query(f"""WITH {HOLED_SQL}, n AS (
  SELECT 'T2M' AS param, count(*) FILTER (T2M IS NULL OR isnan(T2M)) AS n_missing FROM holed
  UNION ALL SELECT 'RH2M', count(*) FILTER (RH2M IS NULL OR isnan(RH2M)) FROM holed
  UNION ALL SELECT 'PRECTOTCORR', count(*) FILTER (PRECTOTCORR IS NULL OR isnan(PRECTOTCORR)) FROM holed
  UNION ALL SELECT 'WS2M', count(*) FILTER (WS2M IS NULL OR isnan(WS2M)) FROM holed)
SELECT * FROM n WHERE n_missing > 0""")
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return qa.null_profile(holed(spark, sf), PARAMS)


@query(f"""WITH {HOLED_SQL}
  SELECT 'T2M' AS param, count(*) FILTER (isinf(T2M)) AS n_inf FROM holed
  UNION ALL SELECT 'RH2M', count(*) FILTER (isinf(RH2M)) FROM holed
  UNION ALL SELECT 'PRECTOTCORR', count(*) FILTER (isinf(PRECTOTCORR)) FROM holed
  UNION ALL SELECT 'WS2M', count(*) FILTER (isinf(WS2M)) FROM holed""")
def inf_profile(spark: SparkSession, sf: str) -> DataFrame:
    return qa.inf_profile(holed(spark, sf), PARAMS)


@query(f"""WITH {HOLED_SQL}
SELECT * FROM holed WHERE T2M IS NOT NULL AND NOT isnan(RH2M) AND NOT isinf(PRECTOTCORR)""")
def inf_clean(spark: SparkSession, sf: str) -> DataFrame:
    return qa.inf_clean(holed(spark, sf), PARAMS)


@query(f"""WITH {HOLED_SQL}
SELECT l_orderkey, l_linenumber, {st("coalesce(T2M, (SELECT avg(T2M) FROM holed))", 5)} AS T2M,
{st("CASE WHEN isnan(RH2M) THEN (SELECT avg(RH2M) FROM holed WHERE NOT isnan(RH2M)) ELSE RH2M END", 6)} AS RH2M, WS2M FROM holed""")
def mean_fill(spark: SparkSession, sf: str) -> DataFrame:
    filled = qa.mean_fill(holed(spark, sf).drop("PRECTOTCORR"), ["T2M", "RH2M", "WS2M"])
    return filled.withColumns({"T2M": settle("T2M", 5), "RH2M": settle("RH2M", 6)})


@query(f"""WITH {HOLED_SQL}
SELECT l_orderkey, l_linenumber, coalesce(T2M, 0) AS T2M, CASE WHEN isnan(RH2M) THEN 0 ELSE RH2M END AS RH2M, WS2M FROM holed""")
def zero_fill(spark: SparkSession, sf: str) -> DataFrame:
    return qa.zero_fill(holed(spark, sf).drop("PRECTOTCORR"), ["T2M", "RH2M", "WS2M"])


def _describe_sql(param: str, digits: int) -> str:
    return (
        f"SELECT '{param}' AS param, {st(f'avg({param})', digits)} AS mean, {st(f'stddev_samp({param})', digits)} AS std, "
        f"min({param}) AS min, max({param}) AS max FROM daily"
    )


@query(f"WITH {DAILY_SQL} " + " UNION ALL ".join(_describe_sql(p, 5 if p in ("RH2M", "WS2M") else 3) for p in PARAMS))
def describe_stats(spark: SparkSession, sf: str) -> DataFrame:
    fine = F.col("param").isin("RH2M", "WS2M")
    out = qa.describe_stats(daily(spark, sf), PARAMS)
    return out.withColumns(
        {c: F.when(fine, settle(c, 5)).otherwise(settle(c, 3)) for c in ("mean", "std")}
    )


@query(f"""WITH {DAILY_SQL}, ok AS (SELECT * FROM daily WHERE time <= DATE '2000-12-31')
SELECT site, time, CASE WHEN T2M BETWEEN 2 AND 45 THEN T2M END AS T2M,
       CASE WHEN PRECTOTCORR BETWEEN 1000 AND 50000 THEN PRECTOTCORR END AS PRECTOTCORR FROM ok""")
def range_guard(spark: SparkSession, sf: str) -> DataFrame:
    rows = daily(spark, sf).select("site", "time", "T2M", "PRECTOTCORR")
    return qa.range_guard(rows, {"T2M": (2.0, 45.0), "PRECTOTCORR": (1000.0, 50000.0)}, last="2000-12-31")


@query(f"""WITH {DAILY_SQL}
SELECT 'T2M' AS param, count(*) FILTER (time <= DATE '2000-12-31' AND NOT T2M BETWEEN 2 AND 45) AS n_rejected,
       count(*) FILTER (time > DATE '2000-12-31') AS n_late_rows FROM daily
UNION ALL SELECT 'PRECTOTCORR', count(*) FILTER (time <= DATE '2000-12-31' AND NOT PRECTOTCORR BETWEEN 1000 AND 50000),
       count(*) FILTER (time > DATE '2000-12-31') FROM daily""")
def range_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return qa.range_rejects(
        daily(spark, sf), {"T2M": (2.0, 45.0), "PRECTOTCORR": (1000.0, 50000.0)}, last="2000-12-31"
    )
