import datetime as dt

import pytest
from pyspark.sql import functions as F

from isotherm.operators.grid import Axis, Grid
from isotherm.sources import cube, schemas, tables


def test_csv(spark, tmp_path):
    df = spark.createDataFrame([(46.0, -120.0, 3), (46.25, -120.5, 1)], schemas.ASSIGNMENTS)
    path = str(tmp_path / "a")
    tables.write_csv(df, path, single_file=True)
    assert len(list((tmp_path / "a").glob("*.csv"))) == 1
    back = tables.verify_written(df, path, fmt="csv")
    assert back.dtypes == df.dtypes and sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    tables.write_csv(df.limit(1), path)
    assert tables.read_csv(spark, path).count() == 1
    (tmp_path / "bad.csv").write_text("lat,lon,cluster\n46.0,x,1\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        tables.read_csv(spark, str(tmp_path / "bad.csv"), schemas.ASSIGNMENTS).collect()


def test_nan_becomes_null(spark, tmp_path):
    (tmp_path / "n.csv").write_text("a,b\n1.0,NaN\n,2.0\n")
    rows = tables.read_csv(spark, str(tmp_path / "n.csv"), "a double, b double").collect()
    assert [tuple(r) for r in rows] == [(1.0, None), (None, 2.0)]


def test_component_fallback(spark, tmp_path):
    full, short = str(tmp_path / "full"), str(tmp_path / "short")
    df = spark.createDataFrame([(1.0, 2.0, 0.1, 0.2, 0.3, 0.4)], schemas.component_schema(4))
    tables.write_csv(df.drop("PC4"), short)
    with pytest.raises(ValueError):
        tables.read_components(spark, [full, short], expected=4)
    assert tables.read_components(spark, [full, short], expected=3).columns == ["lat", "lon", "PC1", "PC2", "PC3"]
    tables.write_csv(df, full)
    assert len(tables.read_components(spark, [full, short], expected=4).columns) == 6
    with pytest.raises(FileNotFoundError):
        tables.first_existing(spark, [str(tmp_path / "none")])


def test_daily_hand_off_is_partitioned_by_year(spark, tmp_path):
    rows = [(dt.date(y, 6, 1), 46.0, -120.0, float(y)) for y in (2018, 2019, 2019)]
    df = spark.createDataFrame(rows, schemas.daily_schema(["T2M"]))
    path = str(tmp_path / "daily")
    tables.write_daily(df, path)
    plan = spark.read.parquet(path).filter("year = 2019")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert tables.read_parquet(spark, path, ["T2M"]).count() == 3
    assert set(tables.pruned_scan(spark, path).columns) == {"lat", "lon", "T2M", "year"}


def test_read_back_compares_header_and_values(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, None)], "a double, b double")
    for fmt, save in (("csv", tables.write_csv), ("parquet", tables.write_parquet)):
        path = str(tmp_path / fmt)
        save(df, path)
        assert tables.verify_written(df, path, fmt=fmt).count() == 2
        with pytest.raises(ValueError, match="values differ"):
            tables.verify_written(df.withColumn("b", F.col("b") + 1), path, fmt=fmt)
        with pytest.raises(ValueError, match="header|columns"):
            tables.verify_written(df.withColumnRenamed("b", "c"), path, fmt=fmt)


def test_malformed_component_fails(spark, tmp_path):
    path = str(tmp_path / "pc")
    tables.write_csv(spark.createDataFrame([("1", "2", "0.1", "x")], "lat string, lon string, PC1 string, PC2 string"), path)
    with pytest.raises(Exception, match="MALFORMED|NumberFormat"):
        tables.read_components(spark, [path], expected=2).collect()


def test_json_and_stage_hand_off(spark, tmp_path):
    row = spark.createDataFrame([([3, 4], 2.5)], "k_range array<int>, score double")
    tables.write_json(row, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).head()["k_range"] == [3, 4]
    again = tables.materialise(row, "stage")
    assert again.head() == row.head()
    assert tables.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_cube(spark):
    grid = Grid(Axis(46.0, 0.5, 2), Axis(-124.0, 1.0, 3))
    rows = [(dt.date(2020, 1, 1), 46.0 + 0.5 * i, -124.0 + j, float(i * 3 + j), float(-j)) for i in range(2) for j in range(3)]
    df = spark.createDataFrame(rows[:-1], schemas.daily_schema(["a", "b"]))
    packed = cube.cube_pack(df, grid, ["a", "b"])
    assert packed.head()["a"] == [[0.0, 1.0, 2.0], [3.0, 4.0, None]]
    chunks = cube.cube_pack(df, grid, ["a", "b"], chunk=2).orderBy("lat_from", "lon_from").collect()
    assert [(r["lat_from"], r["lon_from"], r["a"]) for r in chunks] == [
        (0, 0, [[0.0, 1.0], [3.0, 4.0]]), (0, 2, [[2.0], [None]])]
    with pytest.raises(Exception, match="occurs twice"):
        cube.cube_pack(df.union(df), grid, ["a"]).collect()
    flat = cube.cube_flatten(packed, grid, ["a", "b"])
    assert {tuple(r) for r in flat.collect()} == {tuple(r) for r in rows[:-1]} | {(dt.date(2020, 1, 1), 46.5, -122.0, None, None)}
    part = cube.cube_flatten(cube.cube_pack(df, grid, ["a", "b"], chunk=2), grid, ["a", "b"])
    assert {tuple(r) for r in part.collect()} == {tuple(r) for r in flat.collect()}
    assert len(schemas.METEOROLOGY) == 20 and len(schemas.RADIATION) == 30
