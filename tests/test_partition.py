"""Blocks of cells: equal to ntile, contiguous, and balanced whatever the layout of the cells."""

import random

import pytest
from pyspark.sql import Window, functions as F

from gridagro.operators.partition import assign_subdomain, row_major_rank


def _grid(spark, points):
    return spark.createDataFrame([(lat, lon, 1.0) for lat, lon in points], "lat double, lon double, mask double")


def _layouts():
    rng = random.Random(7)
    scattered = [(round(rng.uniform(-60, 60), 4), round(rng.uniform(-170, 170), 4)) for _ in range(60)]
    one_row = [(12.225, -17.0 + 0.05 * i) for i in range(60)]
    one_column = [(-3.0 + 0.05 * i, 4.025) for i in range(60)]
    return {"scattered": scattered, "one_row": one_row, "one_column": one_column}


@pytest.mark.parametrize("layout", ["scattered", "one_row", "one_column"])
def test_blocks_equal_ntile(spark, layout):
    points = [(round(a, 4), round(b, 4)) for a, b in _layouts()[layout]]
    cells = _grid(spark, points)
    for n in (1, 7, 60, 100):
        got = {(r.lat, r.lon): r.subdomain for r in assign_subdomain(cells, n).collect()}
        tiled = cells.withColumn("b", F.ntile(n).over(Window.orderBy("lat", "lon")) - 1)
        assert got == {(r.lat, r.lon): r.b for r in tiled.collect()}


def test_sizes(spark):
    cells = _grid(spark, [(0.0, float(i)) for i in range(10)])
    sizes = assign_subdomain(cells, 3).groupBy("subdomain").count().orderBy("subdomain").collect()
    assert [r["count"] for r in sizes] == [4, 3, 3]


def test_repeated_cells_count_once(spark):
    cells = _grid(spark, [(0.0, 1.0)] * 50 + [(0.0, 2.0), (1.0, 1.0)])
    assert {r.subdomain for r in assign_subdomain(cells, 3).collect()} == {0, 1, 2}
    assert assign_subdomain(cells, 3).count() == 3


def test_strict_sizes_blocks_on_all_masked_cells(spark):
    rows = [(0.0, float(i), 0.0 if i < 4 else 1.0) for i in range(8)]
    cells = spark.createDataFrame(rows, "lat double, lon double, mask double")
    sensible = {r.lon: r.subdomain for r in assign_subdomain(cells, 2).collect()}
    strict = {r.lon: r.subdomain for r in assign_subdomain(cells, 2, strict=True).collect()}
    assert sensible == {4.0: 0, 5.0: 0, 6.0: 1, 7.0: 1}
    assert set(strict.values()) == {1}


def test_rank_has_no_wide_window_without_partition(spark):
    """The only unpartitioned windows run over whole degrees."""
    cells = _grid(spark, [(0.5 * i, 1.0) for i in range(20)])
    got = sorted((r.lat, r.position, r.n_cells) for r in row_major_rank(cells.drop("mask")).collect())
    assert got == [(0.5 * i, i, 20) for i in range(20)]
