"""Queries: grids, regridding, joins of products, features, reduction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.functions.exprs import settle
from isotherm.operators import features as ft
from isotherm.operators import grid as gr
from isotherm.operators import reduce as rd
from isotherm.operators.regrid import regrid, regrid_products
from isotherm.plans import climate
from isotherm.plans.registry import query
from isotherm.plans.standins import (
    COARSE_GRID,
    DAILY_SQL,
    FINE_GRID,
    FINE_SQL,
    METEO,
    METEO_GRID,
    METEO_SQL,
    PARAMS,
    SOLAR,
    SOLAR_DAYS_SQL,
    SOLAR_GRID,
    SOLAR_SQL,
    daily,
    fine,
    meteo,
    regrid_sql,
    solar,
    solar_days,
    table,
)
from isotherm.plans.standins import settle_sql as st
from isotherm.sources import tables

DENSE_METEO = regrid_sql("meteo", METEO_GRID, METEO)
DENSE_SOLAR = regrid_sql("solar", SOLAR_GRID, SOLAR)
DIGITS = {"T2M": 4, "RH2M": 6, "ALLSKY_SFC_SW_DWN": 2, "CLOUD_AMT": 6}


def _sites(spark: SparkSession, sf: str) -> DataFrame:
    """Customers scattered over the study area."""
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        "c_custkey",
        (F.lit(45.53) + (key * 37 % 347) / F.lit(100.0)).alias("lat"),
        (F.lit(-124.77) + (key * 91 % 785) / F.lit(100.0)).alias("lon"),
        "c_acctbal",
    )


_SITES_SQL = """sites AS (
  SELECT c_custkey, 45.53e0 + (c_custkey * 37 % 347) / 100e0 AS lat, -124.77e0 + (c_custkey * 91 % 785) / 100e0 AS lon, c_acctbal
  FROM customer)"""


def _snap_sql(spacing: str, n_lat: int, n_lon: int) -> str:
    return (
        f"CAST(least(greatest(ceil((lat - 45.53e0) / {spacing} - 0.5e0), 0), {n_lat - 1}) AS INT) AS lat_i, "
        f"CAST(least(greatest(ceil((lon + 124.77e0) / {spacing} - 0.5e0), 0), {n_lon - 1}) AS INT) AS lon_i"
    )


@query(f"""WITH {_SITES_SQL}, snapped AS (SELECT *, {_snap_sql("0.25e0", 15, 33)} FROM sites)
SELECT CAST(i AS INT) AS lat_i, CAST(j AS INT) AS lon_i, 45.53e0 + i * 0.25e0 AS lat, -124.77e0 + j * 0.25e0 AS lon, count(c_custkey) AS n_sites
FROM range(15) a(i) CROSS JOIN range(33) b(j) LEFT JOIN snapped s ON s.lat_i = i AND s.lon_i = j GROUP BY i, j""")
def dense_grid(spark: SparkSession, sf: str) -> DataFrame:
    target = gr.Grid.dense()
    counts = target.snap(_sites(spark, sf)).groupBy("lat_i", "lon_i").agg(F.count(F.lit(1)).alias("n_sites"))
    return target.nodes(spark).join(counts, ["lat_i", "lon_i"], "left").na.fill(0, ["n_sites"])


_SPACINGS = {0.1: (36, 80), 0.25: (15, 33), 0.5: (8, 17)}


@query(f"WITH {_SITES_SQL} " + " UNION ALL ".join(
    f"""SELECT {s}e0 AS spacing, {a * b}::BIGINT AS n_nodes, count(DISTINCT (lat_i, lon_i)) AS n_occupied, count(*) AS n_sites
FROM (SELECT {_snap_sql(f"{s}e0", a, b)} FROM sites)""" for s, (a, b) in _SPACINGS.items()))
def multi_spacing(spark: SparkSession, sf: str) -> DataFrame:
    parts = None
    for spacing in _SPACINGS:
        target = gr.Grid.dense(spacing=spacing)
        per_node = target.snap(_sites(spark, sf)).groupBy("lat_i", "lon_i").agg(F.count(F.lit(1)).alias("n"))
        part = per_node.agg(
            F.lit(spacing).alias("spacing"),
            F.lit(target.size).cast("long").alias("n_nodes"),
            F.count(F.lit(1)).alias("n_occupied"),
            F.sum("n").alias("n_sites"),
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


def _settled(df: DataFrame) -> DataFrame:
    return df.withColumns({c: settle(c, d) for c, d in DIGITS.items() if c in df.columns})


def _settled_sql(measures: dict[str, str], prefix: str = "") -> str:
    return ", ".join(f"{st(prefix + m, DIGITS[m])} AS {m}" for m in measures)


@query(f"""WITH {METEO_SQL}, {regrid_sql("meteo", METEO_GRID, METEO, method="linear")}
SELECT time, lat_i, lon_i, lat, lon, {_settled_sql(METEO)}, is_extrapolated FROM meteo_dense""")
def regrid_linear(spark: SparkSession, sf: str) -> DataFrame:
    return _settled(regrid(meteo(spark, sf), gr.Grid.dense(), method="linear"))


@query(f"""WITH {METEO_SQL}, {regrid_sql("meteo", METEO_GRID, METEO, method="nearest")}
SELECT time, lat_i, lon_i, lat, lon, {_settled_sql(METEO)} FROM meteo_dense""")
def regrid_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return _settled(regrid(meteo(spark, sf), gr.Grid.dense(), method="nearest"))


@query(f"""WITH {METEO_SQL}, {DENSE_METEO}
SELECT time, lat_i, lon_i, lat, lon, {_settled_sql(METEO)}, is_extrapolated FROM meteo_dense""")
def regrid_full(spark: SparkSession, sf: str) -> DataFrame:
    return _settled(regrid(meteo(spark, sf), gr.Grid.dense()))


@query(f"""WITH {FINE_SQL}, {regrid_sql("fine", FINE_GRID, METEO, target=COARSE_GRID)}
SELECT time, lat_i, lon_i, lat, lon, {_settled_sql(METEO)}, is_extrapolated FROM fine_dense""")
def regrid_fine(spark: SparkSession, sf: str) -> DataFrame:
    """A source finer and larger than the target: an eighth of its nodes is needed."""
    return _settled(regrid(fine(spark, sf), COARSE_GRID, tile=2))


DEGREE_GRID = gr.Grid.dense(spacing=1.0)


@query(f"""WITH {SOLAR_DAYS_SQL}, {regrid_sql("solar", SOLAR_GRID, SOLAR, target=DEGREE_GRID)}
SELECT time, lat_i, lon_i, lat, lon, {_settled_sql(SOLAR)}, is_extrapolated FROM solar_dense""")
def regrid_days(spark: SparkSession, sf: str) -> DataFrame:
    """Daily rows with holes over three by five tiles."""
    return _settled(regrid(solar_days(spark, sf), DEGREE_GRID, tile=2))


_JOINED = f"""SELECT m.time, m.lat_i, m.lon_i, m.lat, m.lon, {_settled_sql(METEO)}, {_settled_sql(SOLAR)}"""


@query(f"""WITH {METEO_SQL}, {DENSE_METEO}, {SOLAR_SQL}, {DENSE_SOLAR}
{_JOINED} FROM meteo_dense m JOIN solar_dense s USING (time, lat_i, lon_i)""")
def grid_join(spark: SparkSession, sf: str) -> DataFrame:
    target = gr.Grid.dense()
    left = regrid(meteo(spark, sf), target).drop("is_extrapolated")
    right = regrid(solar(spark, sf), target).drop("is_extrapolated")
    return _settled(gr.grid_join(left, right))


@query(f"""WITH {METEO_SQL}, {DENSE_METEO}, {SOLAR_SQL}, {DENSE_SOLAR}
{_JOINED}, m.is_extrapolated AS is_extrapolated_meteo, s.is_extrapolated AS is_extrapolated_solar
FROM meteo_dense m JOIN solar_dense s USING (time, lat_i, lon_i)""")
def regrid_joined(spark: SparkSession, sf: str) -> DataFrame:
    return _settled(regrid_products([meteo(spark, sf), solar(spark, sf)], gr.Grid.dense()))


@query(f"""WITH {METEO_SQL}, {SOLAR_SQL}
SELECT m.time, m.lat, m.lon, {_settled_sql(METEO)}, {_settled_sql(SOLAR)} FROM meteo m JOIN solar s
ON s.time = m.time AND round(s.lat * 10000) = round(m.lat * 10000) AND round(s.lon * 10000) = round(m.lon * 10000)""")
def colocated_join(spark: SparkSession, sf: str) -> DataFrame:
    return _settled(gr.colocated_join(meteo(spark, sf).rows, solar(spark, sf).rows))


@query(f"""WITH {METEO_SQL}, {SOLAR_SQL}
SELECT 'meteo' AS product, time, lat, lon, {_settled_sql(METEO)}, NULL::DOUBLE AS ALLSKY_SFC_SW_DWN, NULL::DOUBLE AS CLOUD_AMT FROM meteo
UNION ALL SELECT 'solar', time, lat, lon, NULL, NULL, {_settled_sql(SOLAR)} FROM solar""")
def union_products(spark: SparkSession, sf: str) -> DataFrame:
    return _settled(gr.union_products({"meteo": meteo(spark, sf).rows, "solar": solar(spark, sf).rows}))


# --- features

_P_DIGITS = {"T2M": 4, "PRECTOTCORR": 2, "RH2M": 6, "WS2M": 6}
_SEASON_SQL = """CASE WHEN month(time) IN (12, 1, 2) THEN 'winter' WHEN month(time) <= 5 THEN 'spring'
WHEN month(time) <= 8 THEN 'summer' ELSE 'fall' END"""


def _feature_settle(df: DataFrame) -> DataFrame:
    out = {}
    for c in df.columns:
        base = next((p for p in _P_DIGITS if c == p or c.startswith(p + "_")), None)
        if base is not None:
            out[c] = settle(c, _P_DIGITS[base])
    return df.withColumns(out)


_STATS_SQL = ", ".join(
    f"{st(f'{fn}({p})', d)} AS {p}_{name}"
    for p, d in _P_DIGITS.items()
    for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
)
_PIVOT_SQL = ", ".join(
    f"{st(f'avg({p}) FILTER (season = {s!r})', _P_DIGITS[p])} AS {p}_{s}"
    for p in sorted(PARAMS)
    for s in ("fall", "spring", "summer", "winter")
)
_SEASONED = f"{DAILY_SQL}, seasoned AS (SELECT *, {_SEASON_SQL} AS season FROM daily)"


@query(f"WITH {DAILY_SQL} SELECT lat, lon, {_STATS_SQL} FROM daily GROUP BY lat, lon")
def location_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _feature_settle(ft.location_stats(daily(spark, sf), PARAMS))


@query(f"""WITH {_SEASONED} SELECT lat, lon, season, {", ".join(f"{st(f'avg({p})', d)} AS {p}" for p, d in _P_DIGITS.items())}
FROM seasoned GROUP BY lat, lon, season""")
def seasonal_means(spark: SparkSession, sf: str) -> DataFrame:
    return _feature_settle(ft.seasonal_means(daily(spark, sf), PARAMS))


@query(f"WITH {_SEASONED} SELECT lat, lon, {_PIVOT_SQL} FROM seasoned GROUP BY lat, lon")
def seasonal_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return _feature_settle(ft.seasonal_pivot(daily(spark, sf), PARAMS))


@query(f"WITH {_SEASONED} SELECT lat, lon, {_STATS_SQL}, {_PIVOT_SQL} FROM seasoned GROUP BY lat, lon")
def location_features(spark: SparkSession, sf: str) -> DataFrame:
    return _feature_settle(ft.location_features(daily(spark, sf), PARAMS))


@query(f"""WITH {DAILY_SQL} SELECT lat, lon, {st("sum(greatest((T2M + (T2M - 12)) / 2 - 10, 0))", 3)} AS degree_days
FROM daily GROUP BY lat, lon""")
def degree_days(spark: SparkSession, sf: str) -> DataFrame:
    days = daily(spark, sf).withColumns({"T2M_MAX": F.col("T2M"), "T2M_MIN": F.col("T2M") - 12.0})
    return ft.degree_days(days).withColumn("degree_days", settle("degree_days", 3))


@query(f"WITH {DAILY_SQL} SELECT lat, lon, count(*) FILTER (T2M - 12 < 0) AS frost_days FROM daily GROUP BY lat, lon")
def frost_days(spark: SparkSession, sf: str) -> DataFrame:
    return ft.frost_days(daily(spark, sf).withColumn("T2M_MIN", F.col("T2M") - 12.0))


@query(f"""WITH {DAILY_SQL} SELECT lat, lon, {st("avg(PRECTOTCORR * (1 - RH2M)) / avg(PRECTOTCORR)", 6)} AS solar_ratio
FROM daily GROUP BY lat, lon""")
def solar_ratio(spark: SparkSession, sf: str) -> DataFrame:
    sky = daily(spark, sf).withColumns(
        {"ALLSKY_SFC_SW_DWN": F.col("PRECTOTCORR") * (1 - F.col("RH2M")), "CLRSKY_SFC_SW_DWN": F.col("PRECTOTCORR")}
    )
    return ft.solar_ratio(sky).withColumn("solar_ratio", settle("solar_ratio", 6))


# --- correlation, standardisation, components

_PAIR_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "doubled", "mixed"]
_WIDE_SQL = """wide AS (
  SELECT l_quantity, l_extendedprice, CASE WHEN l_linenumber <> 7 THEN l_discount END AS l_discount, l_tax,
         CASE WHEN l_linenumber <> 3 THEN 2 * l_quantity + 1 END AS doubled, l_quantity + l_tax AS mixed FROM lineitem)"""


def _wide(spark: SparkSession, sf: str) -> DataFrame:
    line = F.col("l_linenumber")
    return table(spark, sf, "lineitem").select(
        "l_quantity",
        "l_extendedprice",
        F.when(line != 7, F.col("l_discount")).alias("l_discount"),
        "l_tax",
        F.when(line != 3, 2 * F.col("l_quantity") + 1).alias("doubled"),
        (F.col("l_quantity") + F.col("l_tax")).alias("mixed"),
    )


@query(f"WITH {_WIDE_SQL} " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {st(f'abs(corr({a}, {b}))', 6)} AS abs_r FROM wide"
    for i, a in enumerate(_PAIR_COLUMNS) for b in _PAIR_COLUMNS[i + 1:]))
def corr_pairs(spark: SparkSession, sf: str) -> DataFrame:
    pairs = rd.corr_pairs(_wide(spark, sf), _PAIR_COLUMNS)
    return pairs.select("a", "b", settle("abs_r", 6).alias("abs_r"))


@query(f"""WITH {_WIDE_SQL}, r AS (
{" UNION ALL ".join(f"SELECT {j} AS j, '{b}' AS dropped, abs(corr({a}, {b})) AS r FROM wide"
for j, b in enumerate(_PAIR_COLUMNS) for a in _PAIR_COLUMNS[:j])})
SELECT dropped FROM r WHERE r > 0.99 GROUP BY dropped""")
def corr_prune(spark: SparkSession, sf: str) -> DataFrame:
    wide = _wide(spark, sf)
    kept, dropped = rd.corr_prune(wide, _PAIR_COLUMNS)
    assert set(kept.columns) == set(_PAIR_COLUMNS) - set(dropped)
    return spark.createDataFrame([(c,) for c in dropped], "dropped string")


_Z = ["T2M_mean", "PRECTOTCORR_std", "RH2M_mean", "WS2M_min", "WS2M_fall"]


@query(f"""WITH {_SEASONED}, f AS (SELECT lat, lon, avg(T2M) AS T2M_mean, stddev_samp(PRECTOTCORR) AS PRECTOTCORR_std,
  avg(RH2M) AS RH2M_mean, min(WS2M) AS WS2M_min, avg(WS2M) FILTER (season = 'fall') AS WS2M_fall FROM seasoned GROUP BY lat, lon),
s AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _Z)} FROM f)
SELECT lat, lon, {", ".join(st(f"CASE WHEN s_{c} > 0 THEN ({c} - m_{c}) / s_{c} ELSE 0 END", 5) + f" AS {c}" for c in _Z)} FROM f, s""")
def zscore(spark: SparkSession, sf: str) -> DataFrame:
    table_ = ft.location_features(daily(spark, sf), PARAMS).select("lat", "lon", *_Z)
    scaled = rd.zscore(table_, _Z)
    return scaled.withColumns({c: settle(c, 5) for c in _Z})


@query(f"""WITH v AS (SELECT dim, var_pop(v) AS s FROM (SELECT unnest(range(64)) AS dim, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings) GROUP BY dim),
c AS (SELECT row_number() OVER (ORDER BY s DESC) AS pc, sum(s) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) / (SELECT sum(s) FROM v) AS cum FROM v)
SELECT t AS threshold, CAST(min(pc) FILTER (cum >= t) AS INT) AS n_components FROM c, (VALUES (0.9e0), (0.95e0), (0.99e0)) x(t) GROUP BY t""")
def components_for_variance(spark: SparkSession, sf: str) -> DataFrame:
    """The threshold rule on the variance shares of the raw dimensions, largest first."""
    dims = table(spark, sf, "embeddings").select(F.posexplode(F.col("embedding").cast("array<double>")).alias("dim", "v"))
    spread = dims.groupBy("dim").agg(F.var_pop("v").alias("s")).collect()
    total = sum(r["s"] for r in spread)
    rows = [(i + 1, r["s"] / total) for i, r in enumerate(sorted(spread, key=lambda r: -r["s"]))]
    ratios = spark.createDataFrame(rows, "pc int, ratio double")
    return rd.components_for_variance(ratios, [0.9, 0.95, 0.99])


def _feature_table(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    features = ft.location_features(daily(spark, sf), PARAMS)
    return features, climate.numeric_features(features, ("lat", "lon"))


_ALL = [f"{p}_{n}" for p in PARAMS for n in ("mean", "std", "min", "max")] + [
    f"{p}_{n}" for p in sorted(PARAMS) for n in ("fall", "spring", "summer", "winter")
]
_RAW_SQL = ", ".join(
    [f"{fn}({p}) AS {p}_{n}" for p in PARAMS for n, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))]
    + [f"avg({p}) FILTER (season = {n!r}) AS {p}_{n}" for p in PARAMS for n in ("fall", "spring", "summer", "winter")]
)


def _energy_sql(columns: list[str]) -> str:
    """Squared length of the standardised row, which a full rotation of it keeps."""
    return " + ".join(f"CASE WHEN s_{c} > 0 THEN power(({c} - m_{c}) / s_{c}, 2) ELSE 0 END" for c in columns)


def _spread_sql(columns: list[str], source: str) -> str:
    return f"SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in columns)} FROM {source}"


_SCORES_SQL = f"""WITH {_SEASONED}, f AS (SELECT lat, lon, {_RAW_SQL} FROM seasoned GROUP BY lat, lon), s AS ({_spread_sql(_ALL, "f")})
SELECT lat, lon, CAST(least({len(_ALL)}, (SELECT count(*) FROM f)) AS INT) AS n_components, {st(_energy_sql(_ALL), 3)} AS energy FROM f, s"""


@query(f"""WITH {_SEASONED}, f AS (SELECT lat, lon, {_RAW_SQL} FROM seasoned GROUP BY lat, lon),
u AS (UNPIVOT f ON COLUMNS(* EXCLUDE (lat, lon)) INTO NAME c VALUE v),
r AS (SELECT a.c AS a, b.c AS b, CASE WHEN stddev_pop(a.v) > 0 AND stddev_pop(b.v) > 0 THEN corr(a.v, b.v) ELSE 0 END AS r
  FROM u a JOIN u b ON a.lat = b.lat AND a.lon = b.lon GROUP BY a.c, b.c)
SELECT CAST({len(_ALL)} AS BIGINT) AS n_columns, 1e0 AS total, {st("sum(r * r) / power(sum(r) FILTER (a = b), 2)", 6)} AS energy FROM r""")
def pca_variance(spark: SparkSession, sf: str) -> DataFrame:
    """Shares of variance: they add up to one, and their squares to those of the correlations."""
    features, names = _feature_table(spark, sf)
    shares = rd.variance_table(spark, rd.fit_reduction(features, names))
    energy = settle(F.sum(F.col("ratio") * F.col("ratio")), 6)
    return shares.agg(F.count(F.lit(1)).alias("n_columns"), F.round(F.sum("ratio"), 9).alias("total"), energy.alias("energy"))


def _energies(scores: DataFrame, *keys: str) -> DataFrame:
    energy = F.aggregate("features", F.lit(0.0), lambda t, v: t + v * v)
    return scores.select(*keys, F.size("features").alias("n_components"), settle(energy, 3).alias("energy"))


@query(_SCORES_SQL)
def pca_scores(spark: SparkSession, sf: str) -> DataFrame:
    """All components: a rotation, so each row keeps its length."""
    features, names = _feature_table(spark, sf)
    return _energies(rd.apply_reduction(rd.fit_reduction(features, names, components=len(names)), features), "lat", "lon")


@query(_SCORES_SQL)
def apply_model(spark: SparkSession, sf: str) -> DataFrame:
    """Fit, save, reload and score again."""
    features, names = _feature_table(spark, sf)
    path = tables.scratch_path(spark, "model")
    rd.fit_reduction(features, names, components=len(names)).save(spark, path)
    return _energies(rd.apply_reduction(rd.Reduction.load(spark, path), features), "lat", "lon")


@query(f"""WITH {DAILY_SQL}, s AS ({_spread_sql(PARAMS, "daily")})
SELECT site, time, {len(PARAMS)} AS n_components, {st(_energy_sql(PARAMS), 3)} AS energy FROM daily, s""")
def daily_regimes(spark: SparkSession, sf: str) -> DataFrame:
    return _energies(climate.daily_regimes(daily(spark, sf), PARAMS, keys=("site", "time")), "site", "time")


_THREE = PARAMS[:3]
#: The characteristic equation of a 3 x 3 correlation matrix, solved in closed form.
_SHARES_SQL = f"""{DAILY_SQL}, r AS (SELECT {", ".join(f"corr({a}, {b}) AS {n}" for n, a, b in
  (("r12", _THREE[0], _THREE[1]), ("r13", _THREE[0], _THREE[2]), ("r23", _THREE[1], _THREE[2])))} FROM daily),
p AS (SELECT sqrt((r12 * r12 + r13 * r13 + r23 * r23) / 3e0) AS p, r12 * r13 * r23 AS det FROM r),
a AS (SELECT p, acos(greatest(-1e0, least(1e0, det / (p * p * p)))) / 3e0 AS phi FROM p),
pcs AS (SELECT unnest([1, 2, 3]) AS pc, unnest([1 + 2 * p * cos(phi), 1 + 2 * p * cos(phi + 4 * pi() / 3), 1 + 2 * p * cos(phi + 2 * pi() / 3)]) / 3e0 AS ratio FROM a),
shares AS (SELECT pc, ratio, sum(ratio) OVER (ORDER BY pc) AS cum FROM pcs)"""


def _three_measures(spark: SparkSession, sf: str) -> DataFrame:
    return rd.variance_table(spark, rd.fit_reduction(daily(spark, sf).select(*_THREE), _THREE))


@query(f"WITH {_SHARES_SQL} SELECT CAST(pc AS INT) AS pc, {st('ratio', 6)} AS ratio, {st('cum', 6)} AS cumulative FROM shares")
def pca_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Shares of variance of a fitted reduction of the daily rows."""
    return _three_measures(spark, sf).select("pc", *[settle(c, 6).alias(c) for c in ("ratio", "cumulative")])


@query(f"""WITH {_SHARES_SQL} SELECT t AS threshold, CAST(coalesce(min(pc) FILTER (cum >= t), 3) AS INT) AS n_components
FROM shares, (VALUES (0.3e0), (0.6e0), (0.9e0), (1.1e0)) x(t) GROUP BY t""")
def pca_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """How many components of a fitted reduction reach a share of variance."""
    return rd.components_for_variance(_three_measures(spark, sf), [0.3, 0.6, 0.9, 1.1])


_TWO = PARAMS[:2]


@query(f"""WITH {DAILY_SQL}, s AS ({_spread_sql(_TWO, "daily")}), r AS (SELECT corr({_TWO[0]}, {_TWO[1]}) AS r FROM daily),
z AS (SELECT site, time, ({_TWO[0]} - m_{_TWO[0]}) / s_{_TWO[0]} AS a, sign(r) * ({_TWO[1]} - m_{_TWO[1]}) / s_{_TWO[1]} AS b FROM daily, s, r)
SELECT site, time, {st("abs(a + b) / sqrt(2e0)", 5)} AS pc1, {st("abs(a - b) / sqrt(2e0)", 5)} AS pc2 FROM z""")
def pca_pair(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of two measures: their components are the sum and the difference, whose signs are free."""
    rows = daily(spark, sf).select("site", "time", *_TWO)
    scores = rd.apply_reduction(rd.fit_reduction(rows, _TWO, components=2), rows, keep=("site", "time"))
    return scores.select("site", "time", *[settle(F.abs(F.col("features")[i]), 5).alias(f"pc{i + 1}") for i in range(2)])
