"""Every registered query: value for value against its SQL, else against its own promise."""

import os

import pytest

import __spark_entry__ as entry
from isotherm.plans.standins import regime_points
from tests.oracle import connect, differences

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_matches_sql(spark, duck, name):
    assert differences(spark, duck, SF, QUERIES[name], SQL[name]) == []


@pytest.mark.parametrize("name", ["kmeans_parallel_init"])
def test_runs_without_sql(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    assert rows


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 495 and len({r["cluster"] for r in rows}) == 14
    assert len({(r["lat"], r["lon"]) for r in rows}) == 495


def test_flow_outputs(spark, tmp_path):
    """Component export, metadata, labelled features and the reload of what was written."""
    from isotherm.operators import columns as co
    from isotherm.operators import kmeans as km
    from isotherm.plans import climate
    from isotherm.plans.standins import meteo, solar
    from isotherm.sources import tables

    result = climate.climate_clusters([meteo(spark, SF), solar(spark, SF)], n_init=2)
    d = result.reduction.components
    path = str(tmp_path / "components")
    tables.write_csv(climate.export_components(result), path)
    back = tables.read_components(spark, [path], expected=d)
    names = co.component_columns(back)
    points = co.assemble_features(back, names, keep=("lat", "lon"))
    again = km.assign_nearest(points, result.fit.centroids)
    labels = {(r["lat"], r["lon"]): r["cluster"] for r in result.assignments.collect()}
    assert {(r["lat"], r["lon"]): r["cluster"] for r in again.collect()} == labels
    wide = climate.labelled_features(result)
    assert {(r["lat"], r["lon"]): r["cluster"] for r in wide.select("lat", "lon", "cluster").collect()} == labels
    assert set(result.reduction.columns) <= set(wide.columns)
    tables.write_json(climate.metadata(result), str(tmp_path / "meta"))
    meta = spark.read.json(str(tmp_path / "meta")).head()
    assert meta["n_locations"] == 495 and meta["pca_components"] == d and len(meta["feature_columns"]) == d
    assert meta["pca_variance_retained"] >= 0.95 and meta["lat_range"] == [45.53, 49.03]


def test_sql_names_are_registered():
    assert set(SQL) <= set(QUERIES)


def test_bench_points(spark):
    row = regime_points(spark, SF).head()
    assert len(row["features"]) == 14
