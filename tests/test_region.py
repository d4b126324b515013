"""Polygon clips against all-pairs arithmetic."""

import math
import random

import pytest

from gridagro.operators import region
from gridagro.operators.filters import clip_bbox

RES = 0.05


def _edges(spark, rings):
    schema = "region_id long, ring_id long, ring array<struct<lon:double,lat:double>>"
    return region.ring_edges(spark.createDataFrame(rings, schema))


def _brute(cells, edges, touched):
    hits, h = set(), RES / 2
    for r in {e[0] for e in edges}:
        own = [e[1:] for e in edges if e[0] == r]
        for lat, lon in cells:
            crossings = sum(
                (y1 > lat) != (y2 > lat) and lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 for x1, y1, x2, y2 in own
            )
            meets = any(
                min(x1, x2) <= lon + h
                and max(x1, x2) >= lon - h
                and min(y1, y2) <= lat + h
                and max(y1, y2) >= lat - h
                and abs((x2 - x1) * (lat - y1) - (y2 - y1) * (lon - x1)) <= h * (abs(x2 - x1) + abs(y2 - y1))
                for x1, y1, x2, y2 in own
            )
            if crossings % 2 or (touched and meets):
                hits.add((r, lat, lon))
    return hits


def _star(rng, x, y, size, n):
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    return [(x + rng.uniform(0.2, 1) * size * math.cos(a), y + rng.uniform(0.2, 1) * size * math.sin(a)) for a in angles]


@pytest.mark.parametrize("offset", [0.0, 0.025])
@pytest.mark.parametrize("touched", [True, False])
def test_clip_equals_all_pairs(spark, touched, offset):
    rng = random.Random(11)
    cells = [
        (round(12 + offset + RES * i, 4), round(-17 + offset + RES * j, 4))
        for i in range(20)
        for j in range(25)
        if rng.random() < 0.9
    ]
    rings = [
        (1, 0, _star(rng, -16.5, 12.5, 0.5, 12)),
        (1, 1, _star(rng, -16.5, 12.5, 0.15, 6)),
        (2, 0, _star(rng, -16.3, 12.3, 0.02, 4)),
        # A comb whose teeth all lie in one grid row, and a box on cell borders.
        (3, 0, [(-16.9 + 0.003 * i, 12.41 + 0.02 * (i % 2)) for i in range(80)] + [(-16.6, 12.9)]),
        (4, 0, [(-16.2, 12.2), (-16.0, 12.2), (-16.0, 12.4), (-16.2, 12.4)]),
        (5, 0, [(-16.05, 12.6)]),
    ]
    edges = _edges(spark, rings)
    grid = spark.createDataFrame(cells, "lat double, lon double")
    got = {(r.region_id, r.lat, r.lon) for r in region.region_cells(grid, edges, RES, touched).collect()}
    assert got == _brute(cells, [tuple(e) for e in edges.collect()], touched)


def test_centre_hits_are_touched(spark):
    grid = spark.createDataFrame([(12 + RES * i, RES * j) for i in range(8) for j in range(8)], "lat double, lon double")
    edges = _edges(spark, [(1, 0, [(0.01, 12.01), (0.31, 12.02), (0.17, 12.33)])])
    centre = region.clip_polygon(grid, edges, RES, all_touched=False)
    touched = region.clip_polygon(clip_bbox(grid, *region.envelope(edges, RES)), edges, RES)
    assert centre.exceptAll(touched).isEmpty()
    assert not touched.exceptAll(centre).isEmpty()


def test_closed_and_open_rings_agree(spark):
    open_ring = [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]
    edges = _edges(spark, [(1, 0, open_ring), (2, 0, [*open_ring, open_ring[0]])])
    grid = spark.createDataFrame([(0.25, 0.25), (0.75, 0.75)], "lat double, lon double")
    hits = region.region_cells(grid, edges, 0.5, all_touched=False)
    assert sorted((r.region_id, r.lat) for r in hits.collect()) == [(1, 0.25), (2, 0.25)]
