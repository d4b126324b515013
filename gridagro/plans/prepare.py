"""All input tables of a run from the gridded sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from gridagro.operators.cube import align_variables
from gridagro.operators.filters import CELL, apply_mask, clip_bbox, filter_years, snapped, unit_mask
from gridagro.operators.nearest import nearest_cells
from gridagro.operators.region import clip_polygon, envelope
from gridagro.plans.inputs import climate_table, coordinates_table, replace_texture, soil_table, valid_subdomains
from gridagro.plans.management import management_table
from gridagro.plans.units import sim_units
from gridagro.sources.sinks import stored


@dataclass(frozen=True)
class Sources:
    """Static grids, the daily cube and the management template.

    ``cube`` is one table with all variables, or one table for each. ``texture`` is a grid of Band1
    codes whose classes replace those of the soil grid.
    """

    mask: DataFrame
    soil: DataFrame
    dem: DataFrame
    cube: DataFrame | Sequence[DataFrame]
    management: DataFrame
    grids: DataFrame | None = None
    texture: DataFrame | None = None


@dataclass(frozen=True)
class Run:
    """Input tables of a run."""

    cells: DataFrame
    coordinates: DataFrame
    soil: DataFrame
    climate: DataFrame
    management: DataFrame
    units: DataFrame


def prepare(
    sources: Sources,
    options: Sequence[int],
    first: int,
    last: int,
    subdomains: int = 1,
    texture: str | None = None,
    method: str = "tdew",
    dates: Sequence[int] | None = None,
    cultivars: Sequence[str] = (),
    fertiliser: Sequence = (),
    varieties: Mapping[str, str] | None = None,
    points: DataFrame | None = None,
    res: float | None = None,
    region: DataFrame | None = None,
    all_touched: bool = True,
    box: tuple[float, float, float, float] | None = None,
    degrees: bool = True,
    **window,
) -> Run:
    """The tables of a run over the valid cells, or over the cells nearest to ``points``.

    ``region`` (edges of polygons) and ``box`` (lon_min, lat_min, lon_max, lat_max) bound the cells.
    These are worked out and written once, with their elevation; the box around them is a constant in
    every other plan, so that scans skip what lies outside. Climate and evapotranspiration are computed
    in one scan of the cube and written once; the units take their years from that table. With
    ``points`` mask and sub-domains do not apply, and a cell that is nearest to several points is
    simulated once. ``points`` and ``region`` need ``res``, the spacing of the grid. Cells that cannot be in
    degrees are an error, unless ``degrees`` is false.
    """
    if (points is not None or region is not None) and res is None:
        raise ValueError("points and regions need the spacing of the grid")
    mask, soil_grid = sources.mask, sources.soil
    if region is not None:
        around = envelope(region, res)
        mask = clip_polygon(clip_bbox(mask, *around), region, res, all_touched)
    if box is not None:
        mask = clip_bbox(mask, *box)
    if points is None:
        valid = valid_subdomains(mask, soil_grid, subdomains, degrees=degrees)
    else:
        nearest = nearest_cells(points, soil_grid, res, degrees).select(F.col("cell_lat").alias("lat"), F.col("cell_lon").alias("lon"))
        valid = unit_mask(nearest.distinct()).withColumn("subdomain", F.lit(0))
    height = snapped(sources.dem.select(*CELL, "Band1"))
    cells = stored(valid.join(height, list(CELL), "left"), "cells")
    corners = cells.agg(F.min("lon"), F.min("lat"), F.max("lon"), F.max("lat")).first()

    def near(df: DataFrame) -> DataFrame:
        """Rows in the box around the cells, to the precision of the lattice; all if there are no cells."""
        if corners[0] is None:
            return df
        return clip_bbox(df, corners[0] - 1e-4, corners[1] - 1e-4, corners[2] + 1e-4, corners[3] + 1e-4)

    cube = sources.cube
    if not isinstance(cube, DataFrame):
        cube = align_variables([near(filter_years(part, first, last)) for part in cube])
    coordinates = coordinates_table(cells)
    soil = soil_table(apply_mask(near(soil_grid), cells), texture=texture)
    if sources.texture is not None:
        soil = replace_texture(soil, near(sources.texture), unit_mask(cells))
    climate = stored(climate_table(near(cube), cells, first, last, method), "climate")
    management = management_table(
        sources.management,
        None if sources.grids is None else apply_mask(near(sources.grids), cells),
        dates,
        cultivars,
        fertiliser,
        varieties,
    )
    return Run(cells.drop("Band1"), coordinates, soil, climate, management, sim_units(climate, soil, management, options, **window))
