"""Nearest cells against a full search of both axes."""

import random

from gridagro.operators.nearest import nearest_cells, select_nearest


def _nearest(value, axis):
    return min(axis, key=lambda v: (round(abs(value - v), 6), -v))


def test_nearest_equals_full_search(spark):
    rng = random.Random(3)
    lats = sorted({round(10 + 0.05 * i, 4) for i in range(40) if rng.random() < 0.6} | {55.5})
    lons = sorted({round(-17.575 + 0.05 * i, 4) for i in range(60) if rng.random() < 0.6})
    grid = spark.createDataFrame([(a, b) for a in lats for b in lons], "lat double, lon double")
    points = [(i, rng.uniform(-30, 200), rng.uniform(-80, 89)) for i in range(150)]
    points += [(1000 + i, lons[0] + 0.025 * i, lats[0] + 0.025 * i) for i in range(60)]
    table = spark.createDataFrame(points, "id int, lon double, lat double")
    got = {r.id: (r.cell_lon, r.cell_lat) for r in nearest_cells(table, grid, 0.05).collect()}
    assert got == {i: (_nearest(x, lons), _nearest(y, lats)) for i, x, y in points}


def test_ties_go_to_the_larger_coordinate(spark):
    grid = spark.createDataFrame([(12.225 + 0.05 * i, -17.575 + 0.05 * j) for i in range(5) for j in range(9)], "lat double, lon double")
    points = spark.createDataFrame([(-17.35, 12.25), (-17.43, 12.31), (None, 1.0)], "lon double, lat double")
    got = sorted((r.cell_lon, r.cell_lat) for r in nearest_cells(points, grid, 0.05).collect())
    assert got == [(-17.425, 12.325), (-17.325, 12.275)]


def test_select_repeats_cells_for_repeated_points(spark):
    cube = spark.createDataFrame([(1, 0.0, 0.0, 5.0), (2, 0.0, 0.0, 6.0), (1, 0.0, 1.0, 7.0)], "time int, lat double, lon double, v double")
    points = spark.createDataFrame([(0.1, 0.1), (0.2, -0.3)], "lon double, lat double")
    assert sorted(r.v for r in select_nearest(cube, points, 1.0).collect()) == [5.0, 5.0, 6.0, 6.0]
