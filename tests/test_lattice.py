"""Plane lattices that are not in degrees: blocks and nearest cells far beyond 90 and 360."""

import os
import random

import duckdb
import pytest
from pyspark.sql import Window, functions as F

from checks import catalog, fixtures as fx
from checks.compare import connect, differences
from gridagro.operators.nearest import nearest_cells
from gridagro.operators.partition import assign_subdomain


def test_blocks_of_a_lattice_equal_ntile(spark):
    rng = random.Random(5)
    rows = [(round(rng.uniform(-900, 2500), 4), round(rng.uniform(-700, 900), 4), 1.0) for _ in range(80)]
    cells = spark.createDataFrame(rows, "lat double, lon double, mask double")
    got = {(r.lat, r.lon): r.subdomain for r in assign_subdomain(cells, 7, degrees=False).collect()}
    tiled = cells.withColumn("b", F.ntile(7).over(Window.orderBy("lat", "lon")) - 1)
    assert got == {(r.lat, r.lon): r.b for r in tiled.collect()}


def test_nearest_of_a_lattice_equals_full_search(spark):
    rng = random.Random(6)
    lats, lons = ([round(start + 0.5 * i, 4) for i in range(900) if rng.random() < 0.3] for start in (-120.0, 200.0))
    grid = spark.createDataFrame([(a, lons[i % len(lons)]) for i, a in enumerate(lats)] + [(lats[0], b) for b in lons], "lat double, lon double")
    points = [(i, rng.uniform(100, 800), rng.uniform(-300, 500)) for i in range(200)]
    table = spark.createDataFrame(points, "id int, lon double, lat double")
    near = lambda value, axis: min(axis, key=lambda v: (round(abs(value - v), 6), -v))
    got = {r.id: (r.cell_lon, r.cell_lat) for r in nearest_cells(table, grid, 0.5, degrees=False).collect()}
    assert got == {i: (near(x, lons), near(y, lats)) for i, x, y in points}
    assert nearest_cells(table, grid.limit(0), 0.5, degrees=False).isEmpty()
    with pytest.raises(Exception, match="not in degrees"):
        nearest_cells(table, grid, 0.5).collect()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", ["assign_subdomain", "nearest_cells", "prepare_cells", "prepare_at_points"])
def test_queries_go_beyond_ninety(spark, tmp_path, name):
    """The tables of the smallest size with keys from 16,000 on, whose latitudes are above 90."""
    sf = str(tmp_path)
    for table, keys in {"supplier": ["s_suppkey"], "lineitem": ["l_suppkey"], "customer": [], "part": []}.items():
        df = spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet")
        df.withColumns({key: F.col(key) + 16_000 for key in keys}).write.parquet(f"{sf}/{table}.parquet")
    assert fx.cells(spark, sf).agg(F.min("lat")).first()[0] > 90
    assert catalog.QUERIES[name](spark, sf).count() > 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the driver's tables are not here")
def test_queries_beyond_ninety_equal_the_sql(spark, tmp_path):
    """All tables of the smallest size, the suppliers (and what names them) also with keys from 16,000 on."""
    sf = str(tmp_path)
    for file in os.listdir("/root/testdata/sf0.001"):
        os.symlink(f"/root/testdata/sf0.001/{file}", f"{sf}/{file}")
    for table, key in {"supplier": "s_suppkey", "lineitem": "l_suppkey"}.items():
        os.unlink(f"{sf}/{table}.parquet")
        shifted = f"select * replace ({key} + 16000 * i as {key}) from (select unnest([0, 1]) as i), '/root/testdata/sf0.001/{table}.parquet'"
        duckdb.sql(f"copy (select * exclude (i) from ({shifted})) to '{sf}/{table}.parquet'")
    con = connect(sf)
    for name in ["assign_subdomain_strict", "nearest_cells", "select_nearest", "prepare_at_points", "prepare_cells", "prepare_from_variables", "prepare_management", "prepare_soil", "prepare_soil_with_texture", "prepare_units", "prepare_weather"]:
        rows, problem = differences(spark, con, name, sf)
        assert rows and not problem, name
