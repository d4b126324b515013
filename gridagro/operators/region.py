"""Clipping of grids by polygons.

A polygon is turned into the grid columns it covers in each grid row, as a drawing routine
would do, and these are joined to the cells by equality. The work follows the outline and the
area of the polygons; cells and edges are never paired all with all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridagro.operators.filters import CELL, snapped
from gridagro.operators.joins import HOT_SPLITS, lookup_join

EDGE = ("region_id", "x1", "y1", "x2", "y2")

# Keeps a centre that lies on a bucket border on one side of it, whatever its last bit.
_BORDER = 1e-6


def ring_edges(rings: DataFrame) -> DataFrame:
    """Edges of polygon rings ``(region_id, ring_id, ring array<struct<lon,lat>>)``.

    A ring may repeat its first vertex at the end or leave it out. Holes are rings of the same
    region.
    """
    ring = F.col("ring")
    following = F.concat(F.slice(ring, 2, F.size(ring) - 1), F.slice(ring, 1, 1))
    return (
        rings.filter(F.size("ring") > 0)
        .select("region_id", F.explode(F.arrays_zip(ring.alias("a"), following.alias("b"))).alias("e"))
        .select(
            "region_id",
            F.col("e.a.lon").alias("x1"),
            F.col("e.a.lat").alias("y1"),
            F.col("e.b.lon").alias("x2"),
            F.col("e.b.lat").alias("y2"),
        )
    )


def _bucket(x: Column, res: float) -> Column:
    return F.floor(x / res + _BORDER)


def _rows_of(cells: DataFrame, res: float) -> DataFrame:
    """The latitudes of the grid, at most 1.8 million on the 4-digit lattice."""
    return cells.select("lat").distinct().withColumn("row", _bucket(F.col("lat"), res))


def _centre_columns(cells: DataFrame, edges: DataFrame, res: float) -> DataFrame:
    """Grid columns whose centre is inside a region (even-odd rule), per latitude."""
    y1, y2, lat = F.col("y1"), F.col("y2"), F.col("lat")
    sloped = edges.filter(y1 != y2).withColumn(
        "row", F.explode(F.sequence(_bucket(F.least(y1, y2), res), _bucket(F.greatest(y1, y2), res)))
    )
    crossings = (
        lookup_join(sloped, _rows_of(cells, res), ["row"], "inner", spread=EDGE, splits=HOT_SPLITS, multiplied=True)
        .filter((y1 > lat) != (y2 > lat))
        .withColumn("cross", (F.col("x2") - F.col("x1")) * (lat - y1) / (y2 - y1) + F.col("x1"))
        .withColumn("column", _bucket(F.col("cross"), res))
        .select("region_id", "lat", "column", "cross")
    )
    centres = cells.select("lon").distinct().withColumn("column", _bucket(F.col("lon"), res))
    first_column = F.when(F.col("cross") > F.col("lon"), F.col("column") + 1).otherwise(F.col("column"))
    # Crossings between the same two centres cancel in pairs, which also bounds the window below
    # by the number of grid columns.
    switches = (
        lookup_join(crossings, centres, ["column"], "left", spread=["region_id", "lat"], splits=HOT_SPLITS)
        .groupBy("region_id", "lat", first_column.alias("column"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n % 2 = 1")
    )
    along = Window.partitionBy("region_id", "lat").orderBy("column")
    return (
        switches.select(
            "region_id",
            "lat",
            "column",
            (F.lead("column").over(along) - 1).alias("last"),
            F.row_number().over(along).alias("k"),
        )
        .filter("k % 2 = 1")
        .select("region_id", "lat", F.explode(F.sequence("column", "last")).alias("column"))
    )


def _touched_cells(cells: DataFrame, edges: DataFrame, res: float) -> DataFrame:
    """Cells whose closed box meets an edge."""
    half = F.lit(res / 2)
    x1, y1, x2, y2 = (F.col(name) for name in EDGE[1:])
    lat, lon = F.col("lat"), F.col("lon")
    in_rows = edges.withColumn(
        "row",
        F.explode(
            F.sequence(
                _bucket(F.least(y1, y2) - half, res) - 1,
                _bucket(F.greatest(y1, y2) + half, res) + 1,
            )
        ),
    )
    banded = lookup_join(in_rows, _rows_of(cells, res), ["row"], "inner", spread=EDGE, splits=HOT_SPLITS, multiplied=True).filter(
        (F.least(y1, y2) <= lat + half) & (F.greatest(y1, y2) >= lat - half)
    )

    # The part of the edge inside the band of this row bounds the columns to look at.
    def x_at(y: Column) -> Column:
        part = F.coalesce(F.try_divide(y - y1, y2 - y1), F.lit(0.0))
        return x1 + (x2 - x1) * F.least(F.greatest(part, F.lit(0.0)), F.lit(1.0))

    low, high = x_at(lat - half), x_at(lat + half)
    flat = y1 == y2
    left = F.when(flat, F.least(x1, x2)).otherwise(F.least(low, high))
    right = F.when(flat, F.greatest(x1, x2)).otherwise(F.greatest(low, high))
    candidates = banded.withColumn(
        "column",
        F.explode(F.sequence(_bucket(left - half, res) - 1, _bucket(right + half, res) + 1)),
    )
    boxes = cells.select(*CELL, _bucket(lon, res).alias("column"))
    dx, dy = x2 - x1, y2 - y1
    meets = (
        (F.least(x1, x2) <= lon + half)
        & (F.greatest(x1, x2) >= lon - half)
        & (F.abs(dx * (lat - y1) - dy * (lon - x1)) <= half * (F.abs(dx) + F.abs(dy)))
    )
    return (
        lookup_join(candidates, boxes, ["lat", "column"], "inner", spread=EDGE, splits=HOT_SPLITS, multiplied=True)
        .filter(meets)
        .select("region_id", *CELL)
        .distinct()
    )


def region_cells(cells: DataFrame, edges: DataFrame, res: float, all_touched: bool = True) -> DataFrame:
    """``(region_id, lat, lon)`` of the cells of each region.

    A cell belongs to a region if its centre is inside (even-odd rule over all rings, so holes
    count) or, with ``all_touched``, if its closed box meets the closed polygon. ``res`` is the
    spacing of the grid.
    """
    grid = snapped(cells).select(*CELL).distinct()
    inside = _centre_columns(grid, edges, res)
    boxes = grid.select(*CELL, _bucket(F.col("lon"), res).alias("column"))
    hits = inside.join(boxes.hint("merge"), ["lat", "column"]).select("region_id", *CELL)
    if all_touched:
        hits = hits.unionByName(_touched_cells(grid, edges, res)).distinct()
    return hits


def envelope(edges: DataFrame, margin: float) -> tuple[float, float, float, float]:
    """(lon_min, lat_min, lon_max, lat_max) around all edges, for ``clip_bbox``.

    This runs a small job: four numbers come to the driver, so that the box is a constant in the
    plan and reaches the scan.
    """
    box = edges.agg(
        F.min(F.least("x1", "x2")) - margin,
        F.min(F.least("y1", "y2")) - margin,
        F.max(F.greatest("x1", "x2")) + margin,
        F.max(F.greatest("y1", "y2")) + margin,
    ).first()
    return tuple(box)


def clip_polygon(df: DataFrame, edges: DataFrame, res: float, all_touched: bool = True, grid: DataFrame | None = None) -> DataFrame:
    """Rows of a grid or cube whose cell belongs to any of the regions.

    For a cube pass its static ``grid``; otherwise the cells are taken from the rows of ``df``.
    Clip large inputs to the ``envelope`` of the regions first.
    """
    placed = snapped(df)
    kept = region_cells(placed if grid is None else grid, edges, res, all_touched).select(*CELL).distinct()
    return lookup_join(placed, kept, CELL, "left_semi")
