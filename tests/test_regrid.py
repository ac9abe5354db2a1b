import datetime as dt

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from isotherm.operators.grid import Axis, Grid, infer_axis
from isotherm.operators.regrid import AxisPosition, Product, is_needed, needed_range, needed_rows, node_tiles, regrid, regrid_products
from isotherm.plans.standins import METEO_GRID, SOLAR_GRID

DAYS = [dt.date(2020, 1, d) for d in range(1, 6)]


def planar(lat, lon, day):
    return 3.0 + 2.0 * lat - 0.5 * lon + 0.1 * day.day


def cube_rows(grid, days=DAYS, skip=(), value=planar):
    rows = []
    for day in days:
        for i in range(grid.lat.size):
            for j in range(grid.lon.size):
                if (day, i, j) in skip:
                    continue
                lat, lon = grid.lat.start + i * grid.lat.step, grid.lon.start + j * grid.lon.step
                rows.append((day, lat, lon, value(lat, lon, day)))
    return rows


def product(spark, grid, rows, name="p", **kw):
    return Product(name, spark.createDataFrame(rows, "time date, lat double, lon double, v double"), grid, ["v"], **kw)


@pytest.mark.parametrize(("grid", "native", "inside"), [(METEO_GRID, 84, 336), (SOLAR_GRID, 24, 224)])
def test_golden_counts(spark, grid, native, inside):
    target = Grid.dense()
    assert (grid.size, target.size, target.lat.size, target.lon.size) == (native, 495, 15, 33)
    lat, lon = (
        AxisPosition.of(getattr(grid, a), getattr(target, a), np.arange(getattr(target, a).size)) for a in ("lat", "lon")
    )
    assert lat.inside.sum() * lon.inside.sum() == inside
    out = regrid(product(spark, grid, cube_rows(grid, days=DAYS[:1], value=lambda a, b, t: 1.0)), target, method="linear")
    row = out.agg(F.count("v"), F.min("v"), F.max("v")).head()
    # weights of a target add up to one
    assert row[0] == inside and row[1] == pytest.approx(1.0) and row[2] == pytest.approx(1.0)


@pytest.mark.parametrize("options", [{}, {"tile": 4}, {"tile": 1}])
def test_planar_field_is_exact_inside_and_nearest_outside(spark, options):
    out = regrid(product(spark, METEO_GRID, cube_rows(METEO_GRID)), Grid.dense(), **options).toPandas()
    assert len(out) == 495 * len(DAYS)
    inside = out[~out["is_extrapolated"]]
    assert len(inside) == 336 * len(DAYS)
    assert np.allclose(inside["v"], [planar(a, b, t) for a, b, t in zip(inside["lat"], inside["lon"], inside["time"])], atol=1e-9)
    outside = out[out["is_extrapolated"]]
    lats = METEO_GRID.lat.start + METEO_GRID.lat.step * np.arange(7)
    lons = METEO_GRID.lon.start + METEO_GRID.lon.step * np.arange(12)
    for row in outside.sample(60, random_state=1).itertuples():
        lat, lon = lats[np.abs(lats - row.lat).argmin()], lons[np.abs(lons - row.lon).argmin()]
        assert row.v == pytest.approx(planar(lat, lon, row.time))


def test_missing_sources(spark):
    hole = {(DAYS[1], 3, 5)}
    rows = cube_rows(METEO_GRID, skip=hole)
    # one value NaN on another day
    rows = [(t, a, b, float("nan") if (t == DAYS[2] and a == 47.5 and b == -121.25) else v) for t, a, b, v in rows]
    rows = [(t, a, b, None if (t == DAYS[3] and a == 47.5 and b == -121.25) else v) for t, a, b, v in rows]
    out = regrid(product(spark, METEO_GRID, rows), Grid.dense()).toPandas()
    assert len(out) == 495 * len(DAYS)
    linear = regrid(product(spark, METEO_GRID, rows), Grid.dense(), method="linear").toPandas()
    lone = cube_rows(METEO_GRID, days=DAYS[:1], value=lambda a, b, t: float(a == 47.5 and b == -121.25))
    touched = regrid(product(spark, METEO_GRID, lone), Grid.dense(), method="linear").filter("v > 0").count()
    missing = linear[linear["v"].isna() & ~linear["is_extrapolated"]].groupby("time").size().to_dict()
    assert missing == {DAYS[1]: touched, DAYS[2]: touched, DAYS[3]: touched}
    # the nearest node of a few targets is the hole itself
    assert 0 < out["v"].isna().sum() < missing[DAYS[1]] * 3


def test_repeated_rows_are_averaged_on_request(spark):
    rows = cube_rows(METEO_GRID, days=DAYS[:1])
    twice = rows + [(t, a, b, v + 2.0) for t, a, b, v in rows]
    with pytest.raises(Exception, match="occurs twice"):
        regrid(product(spark, METEO_GRID, twice), Grid.dense()).collect()
    once = regrid(product(spark, METEO_GRID, rows), Grid.dense()).toPandas().sort_values(["lat", "lon"])
    mean = regrid(product(spark, METEO_GRID, twice, unique=False), Grid.dense()).toPandas().sort_values(["lat", "lon"])
    assert np.allclose(mean["v"].to_numpy(), once["v"].to_numpy() + 1.0)


def test_products_meet_like_a_join(spark):
    a = product(spark, METEO_GRID, cube_rows(METEO_GRID), "a")
    rows = [(t, la, lo, v * 2) for t, la, lo, v in cube_rows(SOLAR_GRID, days=DAYS[1:])]
    b = Product("b", spark.createDataFrame(rows, "time date, lat double, lon double, w double"), SOLAR_GRID, ["w"])
    both = regrid_products([a, b], Grid.dense())
    keys = ["time", "lat_i", "lon_i"]
    joined = regrid(a, Grid.dense()).drop("lat", "lon", "is_extrapolated").join(
        regrid(b, Grid.dense()).drop("lat", "lon", "is_extrapolated"), keys
    )
    got = both.select(*keys, "v", "w").toPandas().sort_values(keys).reset_index(drop=True)
    want = joined.select(*keys, "v", "w").toPandas().sort_values(keys).reset_index(drop=True)
    assert len(got) == 495 * 4
    assert np.allclose(got[["v", "w"]], want[["v", "w"]])


def test_circular_measure(spark):
    rows = cube_rows(METEO_GRID, days=DAYS[:1], value=lambda a, b, t: 350.0 if round((b + 124.375) / 0.625) % 2 else 10.0)
    out = regrid(product(spark, METEO_GRID, rows, circular=["v"]), Grid.dense()).toPandas()
    # the mean of 350 and 10 degrees points north, never south
    assert ((out["v"] < 10.1) | (out["v"] > 349.9)).all()


def test_off_grid_coordinate_fails(spark):
    rows = [*cube_rows(METEO_GRID, days=DAYS[:1]), (DAYS[0], 46.2, -124.375, 1.0)]
    with pytest.raises(PySparkException):
        regrid(product(spark, METEO_GRID, rows), Grid.dense()).collect()


AXES = [
    (Axis(46.0, 0.5, 7), Axis(45.53, 0.25, 15)), (Axis(-124.375, 0.625, 12), Axis(-124.77, 0.25, 33)), (Axis(0.0, 0.01, 900), Axis(1.003, 1.0, 6)),
    (Axis(10.0, -0.1, 101), Axis(0.55, 0.5, 17)), (Axis(0.0, 0.25, 5), Axis(0.0, 0.25, 5)), (Axis(3.0, 1.0, 1), Axis(0.0, 1.0, 9)),
    (Axis(0.0, 1.0, 4), Axis(20.0, 0.5, 8)), (Axis(0.0, 1.0, 4), Axis(-9.0, 0.5, 8)), (Axis(0.0, 7.0, 30), Axis(3.5, 7.0, 29)), (Axis(0.0, 0.3, 50), Axis(14.0, -0.9, 14)),
]


@pytest.mark.parametrize(("source", "target"), AXES)
def test_needed_nodes_by_arithmetic(spark, source, target):
    at = AxisPosition.of(source, target, np.arange(target.size))
    inside = at.inside
    # beyond the hull only the nearest node counts
    want = set(np.r_[at.lower[inside], at.upper[inside], at.nearest].tolist())
    nodes = spark.range(source.size).withColumn("used", is_needed(source, target, F.col("id")))
    got = {r["id"] for r in nodes.filter("used").collect()}
    # one more on either side of a target that lies on a node, and the ends
    assert want <= got and len(got - want - {0, source.size - 1}) <= 2 * target.size
    low, high = needed_range(source, target)
    places = source.start + np.array(sorted(want)) * source.step
    assert low <= places.min() and places.max() <= high
    for tile in (1, 4, 64):
        first, last = node_tiles(source, target, tile, np.arange(source.size))
        for number in range(-(-target.size // tile)):
            index = np.arange(number * tile, min((number + 1) * tile, target.size))
            own = AxisPosition.of(source, target, index)
            used = np.r_[own.lower[own.inside], own.upper[own.inside], own.nearest]
            assert ((first[used] <= number) & (number <= last[used])).all()


def test_source_far_finer_and_larger_than_the_target(spark):
    """A hundred nodes to a target step: what is read and held follows the target."""
    source, target = Grid(Axis(40.0, 0.01, 1200), Axis(-130.0, 0.01, 1500)), Grid(Axis(45.003, 1.0, 4), Axis(-124.776, 1.0, 6))
    ids = spark.range(source.size, numPartitions=8)
    lat = source.lat.value(F.expr("id div 1500")).alias("lat")
    lon = source.lon.value(F.expr("id % 1500")).alias("lon")
    rows = ids.select(F.lit(DAYS[0]).alias("time"), lat, lon).withColumn("v", 3.0 + 2.0 * F.col("lat") - 0.5 * F.col("lon"))
    p = Product("p", rows, source, ["v"])
    needed = needed_rows(p, target, "time")
    assert needed.count() <= (3 * 4) * (3 * 6)
    out = regrid(p, target, tile=3).toPandas()
    assert len(out) == 24 and not out["is_extrapolated"].any()
    assert np.allclose(out["v"], 3.0 + 2.0 * out["lat"] - 0.5 * out["lon"], atol=1e-9)


def test_ranges_reach_the_scan_and_each_product_is_read_once(spark, tmp_path):
    parts = []
    for name, grid in (("a", METEO_GRID), ("b", SOLAR_GRID)):
        path = str(tmp_path / name)
        product(spark, grid, cube_rows(grid)).rows.withColumnRenamed("v", name).withColumn("unread", F.lit(1)).write.parquet(path)
        parts.append(Product(name, spark.read.parquet(path), grid, [name]))
    target = Grid(Axis(47.1, 0.1, 10), Axis(-121.0, 0.1, 10))
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = regrid_products(parts, target, tile=4)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert plan.count("FileScan parquet") == 2 and plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert plan.count("Or(And(GreaterThanOrEqual(lat,") == 2 and plan.count("LessThanOrEqual(lon,") == 2 and "unread" not in plan
    assert regrid_products(parts, target, tile=4).count() == 500


def test_absent_rows_still_give_targets(spark):
    """A time whose rows lie in one corner has all its targets, also where no row is near."""
    rows = [(DAYS[0], 46.0, -124.375, 1.0), (DAYS[1], 30.0, 0.0, 1.0)]
    out = regrid(product(spark, METEO_GRID, rows), Grid.dense(), tile=4).toPandas()
    assert len(out) == 495 and out["v"].notna().sum() > 0 and (out["v"].dropna() == 1.0).all()
    assert regrid(product(spark, METEO_GRID, []), Grid.dense()).count() == 0
    with pytest.raises(PySparkException):
        regrid(product(spark, METEO_GRID, [(DAYS[0], None, -124.375, 1.0)]), Grid.dense()).collect()


@pytest.mark.parametrize("packed", [1, 7, 1 << 16])
def test_pack_size_does_not_matter(spark, monkeypatch, packed):
    from isotherm.operators import regrid as module

    monkeypatch.setattr(module, "_PACKED", packed)
    rows = spark.createDataFrame(cube_rows(METEO_GRID), "time date, lat double, lon double, v double").repartition(3)
    out = regrid(Product("p", rows, METEO_GRID, ["v"]), Grid.dense(), tile=8).filter("not is_extrapolated").toPandas()
    assert len(out) == 336 * len(DAYS)
    assert np.allclose(out["v"], [planar(a, b, t) for a, b, t in zip(out["lat"], out["lon"], out["time"], strict=True)], atol=1e-9)


def test_axis_and_grid(spark):
    lats = np.arange(45.53, 49.0 + 0.25, 0.25)
    nodes = Grid.dense().nodes(spark).toPandas()
    assert np.array_equal(np.sort(nodes["lat"].unique()), lats)
    rows = spark.createDataFrame(cube_rows(METEO_GRID), "time date, lat double, lon double, v double")
    axis = infer_axis(rows, "lon")
    assert (axis.size, axis.start, axis.step) == (12, -124.375, pytest.approx(0.625))
    assert Axis.covering(45.53, 49.0, 0.1).size == len(np.arange(45.53, 49.1, 0.1))
