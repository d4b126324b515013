"""A whole run on a small grid, and on single points."""

import datetime as dt

import pytest

from gridagro.plans.prepare import Sources, prepare
from gridagro.sources.schemas import SOIL_VALUES


@pytest.fixture()
def sources(spark):
    cells = [(10 + 0.5 * i, 0.5 * j) for i in range(4) for j in range(3)]
    days = [dt.date(y, 1, 1) + dt.timedelta(days=30 * i) for y in (2000, 2001) for i in range(12)]
    soil_schema = "lat double, lon double, " + ", ".join(f"{n} double" for n in SOIL_VALUES) + ", Band1 double"
    cube_schema = "time date, lat double, lon double, " + ", ".join(
        f"{n} double" for n in ("srad", "tmax", "tmin", "pr", "wind", "Tdewmin", "Tdewmax")
    )
    return Sources(
        mask=spark.createDataFrame([(a, b, 0.0 if a == 10 else 1.0) for a, b in cells], "lat double, lon double, mask double"),
        soil=spark.createDataFrame([(a, b, *[1.0] * 14, None if b == 0 else 3.0) for a, b in cells], soil_schema),
        dem=spark.createDataFrame([(a, b, 100.0) for a, b in cells], "lat double, lon double, Band1 double"),
        cube=spark.createDataFrame([(d, a, b, 20.0, 30.0, 20.0, 1.0, 2.0, 15.0, 18.0) for d in days for a, b in cells], cube_schema),
        management=spark.createDataFrame([("m1", "a", 150, 0), ("m2", "b", 160, 1)], "idMangt string, Idcultivar string, sowingdate int, InoFertiPolicyCode int"),
    )


def test_run_over_valid_cells(sources):
    run = prepare(sources, [1, 2], 2000, 2000, subdomains=4)
    assert run.cells.count() == run.soil.count() == run.coordinates.count() == 6
    assert run.cells.select("subdomain").distinct().count() == 4
    assert run.climate.count() == 6 * 12
    assert run.climate.filter("Etppm > 0").count() == 6 * 12
    assert run.units.count() == 6 * 3


def test_run_at_points(spark, sources):
    points = spark.createDataFrame([(0.6, 10.1), (0.55, 10.0), (9.0, 50.0), (0.1, 10.1)], "lon double, lat double")
    run = prepare(sources, [1], 2000, 2001, points=points, res=0.5)
    assert sorted(r.idPoint for r in run.coordinates.collect()) == ["10.0_0.0", "10.0_0.5", "11.5_1.0"]
    assert sorted(r.IdSoil for r in run.soil.collect()) == ["10.0_0.5", "11.5_1.0"]
    assert run.climate.count() == 3 * 24
    assert run.units.count() == 2 * 2 * 2
    with pytest.raises(ValueError):
        prepare(sources, [1], 2000, 2001, points=points)


def test_the_cube_is_scanned_once(spark, sources, tmp_path):
    from dataclasses import replace

    path = str(tmp_path / "cube")
    sources.cube.write.parquet(path)
    run = prepare(replace(sources, cube=spark.read.parquet(path)), [1], 2000, 2000)
    for table in (run.units, run.climate, run.soil, run.coordinates, run.management):
        assert path not in table._jdf.queryExecution().executedPlan().toString()
    assert run.climate.count() == 6 * 12 and run.units.count() == 6 * 2


def test_region_and_box_bound_the_cells(spark, sources):
    edges = [(1, 10.9, -0.1, 10.9, 2.0), (1, 10.9, 2.0, 12.0, 2.0), (1, 12.0, 2.0, 12.0, -0.1), (1, 12.0, -0.1, 10.9, -0.1)]
    swapped = [(r, y1, x1, y2, x2) for r, x1, y1, x2, y2 in edges]
    region = spark.createDataFrame(swapped, "region_id long, x1 double, y1 double, x2 double, y2 double")
    inside = prepare(sources, [1], 2000, 2000, region=region, res=0.5, all_touched=False)
    assert sorted(r.idPoint for r in inside.coordinates.collect()) == ["11.0_0.5", "11.0_1.0", "11.5_0.5", "11.5_1.0"]
    boxed = prepare(sources, [1], 2000, 2000, box=(0.0, 11.2, 0.6, 12.0))
    assert [r.idPoint for r in boxed.coordinates.collect()] == ["11.5_0.5"]
    assert prepare(sources, [1], 2000, 2000, box=(50.0, 50.0, 51.0, 51.0)).units.count() == 0
