"""Nearest grid cell of each point, with latitude and longitude matched on their own axes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridagro.functions import round_half_even
from gridagro.operators.filters import in_degrees, nulls_for_nans, snapped
from gridagro.operators.joins import HOT_SPLITS, lookup_join

_DISTANCE_DIGITS = 6

#: Coordinates in degrees: longitudes from -180 or from 0.
GLOBE = {"lat": (-90.0, 90.0), "lon": (-180.0, 360.0)}


def _axis_reach(values: DataFrame, res: float, low: float, high: float) -> DataFrame:
    """Each axis value with its neighbours, once per bucket in which it can be the nearest.

    ``values`` has one column ``v`` of distinct values. Windows run inside one degree; the values
    across a degree border come from a table with one row for each whole degree that has values.
    """
    by_degree = values.withColumn("__degree", F.floor("v"))
    in_degree = Window.partitionBy("__degree").orderBy("v")
    over_degrees = Window.orderBy("__degree")  # one row per whole degree, at most 541 on the globe
    borders = (
        by_degree.groupBy("__degree")
        .agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
        .select(
            "__degree",
            F.lag("hi").over(over_degrees).alias("hi_before"),
            F.lead("lo").over(over_degrees).alias("lo_after"),
        )
    )
    linked = (
        by_degree.withColumns({"lower": F.lag("v").over(in_degree), "upper": F.lead("v").over(in_degree)})
        .join(borders, "__degree")
        .select(
            "v",
            F.coalesce("lower", "hi_before").alias("lower"),
            F.coalesce("upper", "lo_after").alias("upper"),
        )
    )
    start = F.coalesce((F.col("lower") + F.col("v")) / 2, F.lit(low))
    end = F.coalesce((F.col("v") + F.col("upper")) / 2, F.lit(high))
    slack = 10.0**-_DISTANCE_DIGITS
    return linked.withColumn(
        "bucket", F.explode(F.sequence(_bucket(start - slack, res), _bucket(end + slack, res)))
    )


def _bucket(x: Column, res: float) -> Column:
    return F.floor(x / res)


def _match_axis(points: DataFrame, values: DataFrame, name: str, res: float, low: float, high: float) -> DataFrame:
    at = F.least(F.greatest(F.col(name), F.lit(low)), F.lit(high))
    reach = _axis_reach(values.select(F.col(name).alias("v")).distinct(), res, low, high)
    other = "lon" if name == "lat" else "lat"
    found = lookup_join(points.withColumn("bucket", _bucket(at, res)), reach, ["bucket"], "inner", [other], HOT_SPLITS)

    def away(axis: str) -> Column:
        return round_half_even(F.abs(F.col(name) - F.col(axis)), _DISTANCE_DIGITS)

    # A tie goes to the larger axis value.
    nearest = F.coalesce(away("v") <= away("lower"), F.lit(True)) & F.coalesce(
        away("v") < away("upper"), F.lit(True)
    )
    return found.filter(nearest).withColumn(f"cell_{name}", F.col("v")).drop("v", "lower", "upper", "bucket")


def _extent(axes: DataFrame) -> dict[str, tuple[float, float]]:
    """The smallest and the largest value of each axis; four numbers, found in one pass over the grid."""
    least, most, west, east = nulls_for_nans(axes).agg(F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon")).first()
    return {"lat": (least or 0.0, most or 0.0), "lon": (west or 0.0, east or 0.0)}


def nearest_cells(points: DataFrame, grid: DataFrame, res: float, degrees: bool = True) -> DataFrame:
    """``points`` with ``cell_lat`` and ``cell_lon``, the nearest value of each axis of ``grid``.

    Points outside the grid go to its border. ``res`` is the spacing of the grid; it sets the
    width of the join buckets and does not change the result. Cells that cannot be in degrees are an
    error, unless ``degrees`` is false: then the grid is any plane lattice, whose extent is looked up.
    """
    known = points.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    axes = snapped(grid).select("lat", "lon")
    extent = GLOBE if degrees else _extent(axes)
    axes = in_degrees(axes) if degrees else axes
    on_lat = _match_axis(known, axes, "lat", res, *extent["lat"])
    return _match_axis(on_lat, axes, "lon", res, *extent["lon"])


def select_nearest(df: DataFrame, points: DataFrame, res: float, degrees: bool = True) -> DataFrame:
    """Rows of a grid or cube at the nearest cell of each point; a point may repeat a cell."""
    placed = snapped(df)
    cells = nearest_cells(points, placed, res, degrees).select(
        F.col("cell_lat").alias("lat"), F.col("cell_lon").alias("lon")
    )
    spread = [name for name in ("time",) if name in df.columns]
    return lookup_join(placed, cells, ["lat", "lon"], "inner", spread, HOT_SPLITS)
