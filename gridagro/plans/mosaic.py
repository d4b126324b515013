"""Mosaics of sub-domain outputs on a reference grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridagro.functions import as_float, fill_in_mask
from gridagro.operators.aggregates import first_non_null
from gridagro.operators.cube import reindex
from gridagro.operators.filters import CELL, nulls_for_nans, snapped

SLICE = ("model", "scenario", "time")


def with_mask(grid: DataFrame, mask: DataFrame) -> DataFrame:
    """The cells of a grid with their crop mask value."""
    return snapped(grid).join(nulls_for_nans(snapped(mask)).select(*CELL, "mask"), list(CELL), "left")


def fill_cube(df: DataFrame, mask_column: str = "mask") -> DataFrame:
    """NULL becomes 0 in all variables where the mask is 1; the mask column is dropped."""
    fixed = (*SLICE, *CELL, mask_column)
    variables = [name for name in df.columns if name not in fixed]
    return df.withColumns(
        {name: fill_in_mask(F.col(name), F.col(mask_column)) for name in variables}
    ).drop(mask_column)


def mosaic(outputs: DataFrame, grid: DataFrame, mask: DataFrame | None = None, slots: int | None = None) -> DataFrame:
    """One cube per model and scenario on the reference grid.

    ``outputs`` has model, scenario, time, lat, lon, subdomain and numeric variables. Overlaps go to
    the lowest sub-domain with a value; the mask joins the grid before the grid is repeated for
    every slice. Values are single precision.
    """
    merged = first_non_null(nulls_for_nans(snapped(outputs)), [*SLICE, *CELL])
    cells = snapped(grid).select(*CELL).distinct()
    placed = reindex(merged, cells if mask is None else with_mask(cells, mask), SLICE, slices_of=outputs, slots=slots)
    filled = placed if mask is None else fill_cube(placed)
    variables = [name for name in merged.columns if name not in (*SLICE, *CELL)]
    return filled.select(*SLICE, *CELL, *[as_float(F.col(name)).alias(name) for name in variables])
