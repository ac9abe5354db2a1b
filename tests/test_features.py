import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from isotherm.functions import exprs
from isotherm.operators import columns as co
from isotherm.operators import features as ft
from isotherm.operators import grid as gr
from isotherm.operators import quality as qa
from isotherm.operators import reduce as rd


def sites(n=6, years=2):
    rows = []
    for s in range(n):
        for d in range(365 * years):
            day = dt.date(2019, 1, 1) + dt.timedelta(days=d)
            t = 10 + 8 * math.cos(2 * math.pi * day.timetuple().tm_yday / 365) + s
            rows.append((day, 46.0 + s, -120.0 - s, t, float("nan") if d % 97 == 0 else t * (s + 1)))
    return pd.DataFrame(rows, columns=["time", "lat", "lon", "T2M", "RH2M"])


@pytest.fixture(scope="module")
def daily(spark):
    return spark.createDataFrame(sites())


def test_location_features_equal_pandas(spark, daily):
    pdf = sites()
    want = pdf.groupby(["lat", "lon"])[["T2M", "RH2M"]].agg(["mean", "std", "min", "max"])
    want.columns = ["_".join(c) for c in want.columns]
    months = {12: "winter", 1: "winter", 2: "winter", 3: "spring", 4: "spring", 5: "spring",
              6: "summer", 7: "summer", 8: "summer", 9: "fall", 10: "fall", 11: "fall"}
    pdf["season"] = pd.to_datetime(pdf["time"]).dt.month.map(months)
    pivot = pdf.pivot_table(index=["lat", "lon"], columns="season", values=["T2M", "RH2M"], aggfunc="mean")
    pivot.columns = ["_".join(c) for c in pivot.columns]
    want = want.join(pivot).reset_index()
    got = ft.location_features(daily, ["T2M", "RH2M"])
    assert got.columns == list(want.columns)
    got = got.toPandas().sort_values("lat").reset_index(drop=True)
    assert np.allclose(got, want)


def test_fused_equals_join_of_parts(spark, daily):
    params = ["T2M", "RH2M"]
    parts = ft.location_stats(daily, params).join(ft.seasonal_pivot(daily, params), ["lat", "lon"])
    fused = ft.location_features(daily, params)
    assert parts.columns == fused.columns
    a, b = (x.toPandas().sort_values("lat").to_numpy() for x in (parts, fused))
    assert np.allclose(a, b)
    long = ft.pivot_seasons(ft.seasonal_means(daily, params), params).toPandas().sort_values("lat")
    assert np.allclose(long.to_numpy(), ft.seasonal_pivot(daily, params).toPandas().sort_values("lat").to_numpy())


def test_full_width_is_224(spark):
    from isotherm.sources.schemas import METEOROLOGY, RADIATION, daily_schema

    params = [*METEOROLOGY, *RADIATION]
    empty = spark.createDataFrame([], daily_schema(params))
    names = ft.location_features(empty, params).columns
    assert len(names) == 2 + 224
    assert names[2:6] == ["T2M_mean", "T2M_std", "T2M_min", "T2M_max"]
    assert names[-24:-20] == [f"ALLSKY_SFC_SW_DWN_{s}" for s in ("fall", "spring", "summer", "winter")]


def test_single_row_site_and_absent_season(spark):
    one = spark.createDataFrame([(dt.date(2020, 7, 1), 1.0, 2.0, 5.0)], "time date, lat double, lon double, T2M double")
    row = ft.location_features(one, ["T2M"]).head()
    assert row["T2M_std"] is None and row["T2M_winter"] is None and row["T2M_summer"] == 5.0


def test_degree_and_frost_days(spark):
    rows = [(1.0, 2.0, 20.0, 10.0), (1.0, 2.0, 8.0, -2.0), (1.0, 2.0, None, -1.0)]
    df = spark.createDataFrame(rows, "lat double, lon double, T2M_MAX double, T2M_MIN double")
    # greatest() skips a missing mean, so that day adds nothing
    assert ft.degree_days(df).head()["degree_days"] == 5.0
    assert ft.frost_days(df).head()["frost_days"] == 2


def test_seasons_and_regions(spark):
    got = spark.range(1, 13).select(exprs.season(F.make_date(F.lit(2020), "id", F.lit(1))).alias("s")).collect()
    assert [r["s"] for r in got] == ["winter"] * 2 + ["spring"] * 3 + ["summer"] * 3 + ["fall"] * 3 + ["winter"]
    lons = spark.createDataFrame([(-120.9,), (-121.0,), (-122.5,), (-124.0,)], "lon double")
    assert [r[0] for r in lons.select(exprs.region("lon")).collect()] == [
        "Eastern Washington", "Central/Cascade Region", "Western Washington", "Western Washington"]


def test_column_choice(spark, daily):
    found, missing = co.project_available(daily, ["RH2M", "PSC"])
    assert found.columns == ["time", "lat", "lon", "RH2M"] and missing == ["PSC"]
    with pytest.raises(ValueError):
        co.project_available(daily, ["PSC"])
    with pytest.raises(AnalysisException):
        co.project_strict(daily, ["PSC"])
    assert co.numeric_columns(daily) == ["T2M", "RH2M"]
    assert co.columns_except(daily, ["time", "lat", "lon"]) == ["T2M", "RH2M"]
    with pytest.raises(ValueError):
        co.component_columns(daily)
    assert co.resolve_themes(["T2M_std", "T2M_MIN_mean", "WS10M_mean"]) == {
        "Temperature": "T2M_std", "Wind Speed": "WS10M_mean"}


def test_quality(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(1, 1.0, nan), (2, inf, 2.0), (3, None, 4.0), (4, 5.0, 6.0)], "id int, a double, b double")
    assert {tuple(r) for r in qa.null_profile(df, ["a", "b"]).collect()} == {("a", 1), ("b", 1)}
    assert {tuple(r) for r in qa.inf_profile(df, ["a", "b"]).collect()} == {("a", 1), ("b", 0)}
    assert [r["id"] for r in qa.inf_clean(df, ["a", "b"]).collect()] == [4]
    # without an infinity the incomplete rows stay
    finite = df.filter("id <> 2")
    assert sorted(r["id"] for r in qa.inf_clean(finite, ["a", "b"]).collect()) == [1, 3, 4]
    filled = {r["id"]: (r["a"], r["b"]) for r in qa.mean_fill(finite, ["a", "b"]).collect()}
    assert filled == {1: (1.0, 5.0), 3: (3.0, 4.0), 4: (5.0, 6.0)}
    zero = {r["id"]: (r["a"], r["b"]) for r in qa.zero_fill(finite, ["a", "b"]).collect()}
    assert zero[1] == (1.0, 0.0) and zero[3] == (0.0, 4.0)
    empty = qa.inf_clean(df.filter("id > 9"), ["a", "b"])
    assert empty.count() == 0
    stats = {r["param"]: r for r in qa.describe_stats(finite, ["a", "b"]).collect()}
    assert stats["b"]["mean"] == 5.0 and stats["b"]["std"] == pytest.approx(math.sqrt(2))
    guarded = qa.range_guard(df.withColumn("time", F.lit("2024-01-01").cast("date")), {"b": (3.0, 9.0)}, last="2024-12-31")
    assert sorted(str(r["b"]) for r in guarded.collect()) == ["4.0", "6.0", "None", "None"]


def test_missing_days_over_several_bitmaps(spark, monkeypatch):
    """Windows of more days than a bitmap has, keys without any day, days outside the window."""
    rng = np.random.default_rng(4)
    start = dt.date(1900, 1, 1)
    for n in (1, 55, 56, 57, 700, 40_000):
        days = {k: set(rng.choice(n, rng.integers(0, n), replace=False).tolist()) for k in range(4)} | {4: set(range(n))}
        rows = [(k, start + dt.timedelta(days=d)) for k, seen in days.items() for d in seen for _ in range(1 + d % 2)]
        rows += [(k, start - dt.timedelta(days=1)) for k in days] + [(None, None), (5, start + dt.timedelta(days=n))]
        df = spark.createDataFrame(rows, "site int, time date")
        end = start + dt.timedelta(days=n - 1)
        got = gr.missing_days(df, str(start), str(end), keys=("site",)).collect()
        want = {(k, start + dt.timedelta(days=d)) for k, seen in (days | {5: set(), None: set()}).items() for d in set(range(n)) - seen}
        assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert gr.missing_days(df, "2000-01-02", "2000-01-01", keys=("site",)).collect() == []
    plan = gr.missing_days(df, "2000-01-01", "2000-12-31", keys=("site",))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_missing_days_and_slice(spark):
    rows = [(1, dt.datetime(2024, 1, d, 5)) for d in (1, 2, 4)] + [(2, dt.datetime(2024, 1, 3, 1))]
    df = spark.createDataFrame(rows, "site int, time timestamp_ntz")
    gaps = gr.missing_days(df, "2024-01-01", "2024-01-04", keys=("site",)).collect()
    assert sorted((r["site"], r["time"].day) for r in gaps) == [(1, 3), (2, 1), (2, 2), (2, 4)]
    assert [r["time"].day for r in gr.missing_days(df, "2024-01-01", "2024-01-05", keys=()).collect()] == [5]
    assert gr.time_slice(df, "2024-01-02", "2024-01-03").count() == 2


def test_filters_reach_the_scan(spark, tmp_path, daily):
    path = str(tmp_path / "d")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    daily.write.parquet(path)
    df = gr.time_slice(gr.bbox_filter(spark.read.parquet(path)), "2019-03-01", "2019-04-01").select("T2M")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(lat,45.53)" in plan and "GreaterThanOrEqual(time,2019-03-01)" in plan
    assert "RH2M" not in plan.split("ReadSchema")[1]


def test_correlation_with_holes_equals_pandas(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5))
    x[:, 1] = x[:, 0] * 2 + 1e-3 * x[:, 1]
    x[:, 4] = 7.0
    pdf = pd.DataFrame(x, columns=list("abcde"))
    full = rd.correlation_matrix(spark.createDataFrame(pdf), list("abcde"))
    assert np.allclose(full, pdf.corr(), equal_nan=True)
    pdf.loc[::7, "a"] = np.nan
    pdf.loc[3::11, "c"] = np.nan
    holed = rd.correlation_matrix(spark.createDataFrame(pdf).repartition(4), list("abcde"))
    assert np.allclose(holed, pdf.corr(), equal_nan=True)


@pytest.mark.parametrize("tasks", [1, 5, 40])
def test_partials_are_added_by_spark(spark, tasks):
    pdf = pd.DataFrame(np.random.default_rng(5).normal(size=(200, 3)), columns=list("abc"))
    pdf.loc[::9, "b"] = np.nan
    got = rd.correlation_matrix(spark.createDataFrame(pdf).repartition(tasks), list("abc"))
    assert np.allclose(got, pdf.corr())


def test_constant_on_common_rows_has_no_correlation(spark):
    rng = np.random.default_rng(2)
    for _ in range(3):
        pdf = pd.DataFrame({"a": rng.normal(size=30), "b": rng.normal(size=30)})
        pdf.loc[10:, "a"], pdf.loc[:9, "b"] = np.nan, np.nan
        pdf.loc[5:15, "a"] = 0.1 + rng.normal()  # constant wherever b is present
        got = rd.correlation_matrix(spark.createDataFrame(pdf), ["a", "b"])
        assert np.isnan(got[0, 1]) and np.isnan(pdf.corr().iloc[0, 1])


def test_missing_values_of_any_type(spark):
    rows = [(None, "x", 1.0, 1), ("2020-01-01", None, float("nan"), None), ("2020-01-02", "y", None, 3)]
    df = spark.createDataFrame(rows, "d string, s string, v double, n int").withColumn("d", F.to_date("d"))
    got = {r["param"]: r["n_missing"] for r in qa.null_profile(df, df.columns).collect()}
    assert got == {"d": 1, "s": 1, "v": 2, "n": 1}


def test_prune_is_not_greedy():
    r = np.array([[1, 0.995, 0.5, np.nan], [0.995, 1, 0.995, np.nan], [0.5, 0.995, 1, np.nan], [np.nan] * 4])
    # c goes because of b, although b is dropped itself
    assert rd.redundant_columns(r, list("abcd")) == ["b", "c"]
    assert rd.redundant_columns(np.array([[1, 0.99], [0.99, 1]]), ["a", "b"]) == []


def test_zscore_uses_the_population_std(spark):
    pdf = pd.DataFrame({"k": range(5), "a": [1.0, 2, 3, 4, 10], "c": [3.0] * 5})
    out = rd.zscore(spark.createDataFrame(pdf), ["a", "c"]).toPandas().sort_values("k")
    assert np.allclose(out["a"], (pdf["a"] - pdf["a"].mean()) / pdf["a"].std(ddof=0))
    assert (out["c"] == 0).all()
    check = qa.standardisation_check(spark.createDataFrame(out), ["a"]).head()
    assert check["mean"] == pytest.approx(0, abs=1e-12) and check["std"] == pytest.approx(1)


def test_components_equal_numpy_and_spark_ml(spark, tmp_path):
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler

    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6)) + 5
    x[:, 5] = 2.0
    names = [f"f{i}" for i in range(6)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(lat=np.arange(300.0), lon=0.0)).repartition(3)
    fit = rd.fit_reduction(df, names, variance=0.95)
    z = (x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1)
    _, s, vt = np.linalg.svd(z, full_matrices=False)
    ratios = s**2 / (s**2).sum()
    assert np.allclose(fit.ratios, ratios)
    assert fit.components == np.argmax(np.cumsum(ratios) >= 0.95) + 1
    scores = rd.apply_reduction(fit, df).toPandas().sort_values("lat")
    got, want = np.array(scores["features"].to_list()), z @ vt[: fit.components].T
    assert np.allclose(np.abs(got), np.abs(want))
    assert (fit.loadings[np.abs(fit.loadings).argmax(0), range(fit.components)] > 0).all()
    fit.save(spark, str(tmp_path / "m"))
    again = rd.apply_reduction(rd.Reduction.load(spark, str(tmp_path / "m")), df).toPandas().sort_values("lat")
    assert np.array_equal(np.array(again["features"].to_list()), got)
    raw = VectorAssembler(inputCols=names[:5], outputCol="v").transform(df)
    scaled = StandardScaler(withMean=True, inputCol="v", outputCol="s").fit(raw).transform(raw)
    ml = PCA(k=5, inputCol="s", outputCol="p").fit(scaled)
    assert np.allclose(ml.explainedVariance.toArray(), fit.ratios[:5])


def test_component_thresholds(spark):
    assert rd.components_for([0.6, 0.3, 0.1], 0.89) == 2
    # never reached: all of them
    assert rd.components_for([0.6, 0.3], 0.95) == 2
    table = spark.createDataFrame([(1, 0.6), (2, 0.3)], "pc int, ratio double")
    assert {tuple(r) for r in rd.components_for_variance(table, [0.5, 0.95]).collect()} == {(0.5, 1), (0.95, 2)}


def test_missing_values_are_refused(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "a double, b double")
    with pytest.raises(ValueError):
        rd.fit_reduction(df, ["a", "b"])


def test_components_with_a_large_offset(spark):
    """An offset of 1e8 costs none of the digits that squares of it would."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 4)) @ rng.normal(size=(4, 4))
    x = np.round(x * 2**20) / 2**20  # the offset keeps these digits
    names = list("abcd")
    for parts in (1, 40):
        near, far = (
            rd.fit_reduction(spark.createDataFrame(pd.DataFrame(x + o, columns=names)).repartition(parts), names, components=4) for o in (0.0, 1e8)
        )
        assert np.allclose(far.ratios, near.ratios, rtol=1e-6) and np.allclose(far.stds, x.std(0), rtol=1e-7)
        assert np.allclose(np.abs(far.loadings), np.abs(near.loadings), atol=1e-5)
    empty = rd.fit_reduction(spark.createDataFrame([], "a double, b double"), ["a", "b"], components=1)
    assert empty.ratios.tolist() == [0.0, 0.0]
    one = rd.fit_reduction(spark.createDataFrame([(1.0, 5.0)], "a double, b double"), ["a", "b"])
    assert one.stds.tolist() == [0.0, 0.0] and one.components == 1


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_correlations_in_one_pass(spark, parts):
    """Holes, constants and offsets against pandas; the rows upstream are made once."""
    rng = np.random.default_rng(parts)
    x = rng.normal(size=(800, 6)) @ rng.normal(size=(6, 6)) * 10.0 ** np.arange(-2, 4) + 1e5
    pdf = pd.DataFrame(x, columns=list("abcdef"))
    pdf.loc[rng.random(800) < 0.3, "b"] = np.nan
    pdf.loc[pdf["a"] > pdf["a"].median(), "c"] = np.nan
    pdf["g"] = 7.0
    pdf["h"] = np.where(pdf["c"].isna(), pdf["a"], 3.0)  # constant where c is present
    pdf["i"] = np.nan
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.createDataFrame(pdf).repartition(parts)
    df = df.mapInPandas(counted, df.schema)
    names = list(pdf.columns)
    got = rd.correlation_matrix(df, names)
    assert seen.value == 800
    want = pdf.corr().to_numpy()
    want[names.index("c"), names.index("h")] = want[names.index("h"), names.index("c")] = np.nan
    assert np.array_equal(np.isnan(got), np.isnan(want))
    assert np.allclose(np.nan_to_num(got), np.nan_to_num(want), atol=1e-9)
    seen.value = 0
    stats = rd.moments(df, names)
    assert seen.value == 800 and np.allclose(stats.means[:8], pdf.mean()[:8]) and np.allclose(stats.stds[:8], pdf.std(ddof=0)[:8])
    assert np.isnan(rd.correlation_matrix(df.limit(0), names)).all()
