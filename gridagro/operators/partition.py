"""Balanced sub-domains of valid cells in row-major order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gridagro.operators.filters import CELL, in_degrees, nulls_for_nans, snapped


def row_major_rank(cells: DataFrame) -> DataFrame:
    """0-based position of each cell in (lat, lon) order, and the number of cells.

    A global rank without a global sort. Cells are counted per tile (one latitude, one degree of
    longitude), the counts are summed up to whole degrees of latitude, and a cell's position is
    its place inside its tile plus what lies before the tile. With cells unique on the 4-digit
    lattice, the windows see at most 10^4 cells per tile, the tiles of one degree of latitude,
    and one row for each whole degree that has cells.
    """
    tiled = cells.withColumns({"__degree": F.floor("lat"), "__band": F.floor("lon")})
    tiles = tiled.groupBy("__degree", "lat", "__band").agg(F.count(F.lit(1)).alias("__n"))
    degrees = tiles.groupBy("__degree").agg(F.sum("__n").alias("__n"))

    before = (Window.unboundedPreceding, -1)
    over_degrees = Window.orderBy("__degree")  # one row per whole degree, at most 181 on the globe
    degree_offsets = degrees.select(
        "__degree",
        F.coalesce(F.sum("__n").over(over_degrees.rowsBetween(*before)), F.lit(0)).alias("__below"),
        F.sum("__n")
        .over(over_degrees.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        .alias("n_cells"),
    )
    in_degree = Window.partitionBy("__degree").orderBy("lat", "__band").rowsBetween(*before)
    tile_offsets = tiles.withColumn("__inside", F.coalesce(F.sum("__n").over(in_degree), F.lit(0))).join(
        degree_offsets, "__degree"
    )
    in_tile = Window.partitionBy("lat", "__band").orderBy("lon")
    offsets = tile_offsets.select("lat", "__band", (F.col("__below") + F.col("__inside")).alias("__offset"), "n_cells")
    return (
        tiled.withColumn("__place", F.row_number().over(in_tile) - 1)
        .join(offsets, ["lat", "__band"])
        .withColumn("position", F.col("__place") + F.col("__offset"))
        .drop("__degree", "__band", "__place", "__offset")
    )


def assign_subdomain(cells: DataFrame, n: int, strict: bool = False, degrees: bool = True) -> DataFrame:
    """Split the cells with mask 1 into ``n`` row-major blocks whose sizes differ by at most one.

    ``strict`` sizes the blocks on all cells with a mask value, also those that are not kept. Coordinates
    that cannot be degrees are an error, unless ``degrees`` is false: then they are any plane lattice.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    ranked_mask = F.col("mask").isNotNull() if strict else F.col("mask") == 1
    placed = snapped(nulls_for_nans(cells))
    unique = (in_degrees(placed) if degrees else placed).filter(ranked_mask).groupBy(*CELL).agg(F.max("mask").alias("mask"))

    size, longer = F.floor(F.col("n_cells") / n), F.col("n_cells") % n
    in_longer = longer * (size + 1)
    block = F.when(F.col("position") < in_longer, F.floor(F.col("position") / (size + 1))).otherwise(
        longer + F.floor(F.try_divide(F.col("position") - in_longer, size))
    )
    return (
        row_major_rank(unique)
        .filter("mask = 1")
        .select(*CELL, "mask", block.cast("int").alias("subdomain"))
    )


def take_subdomain(cells: DataFrame, index: int) -> DataFrame:
    """The cells of one block."""
    return cells.filter(F.col("subdomain") == index)
