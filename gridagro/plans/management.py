"""The crop management table, optionally with gridded values."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from gridagro.functions import cell_mangt_id, map_variety, point_id, sown_mangt_id, trunc_int
from gridagro.operators.filters import drop_incomplete, filter_in, snapped
from gridagro.operators.joins import grid_product

# Names of gridded variables and the management columns they replace.
_GRID_NAMES = {"variety": "Idcultivar", "sowing_date": "sowingdate"}


def spatialise_management(
    management: DataFrame, grids: DataFrame, varieties: Mapping[str, str] | None = None, slots: int | None = None
) -> DataFrame:
    """Every management record at every gridded cell, gridded values replacing base columns.

    ``grids`` has lat, lon and any of variety, sowing_date or management columns. The cell is
    written into the management id; the former id stays in ``oldid``.
    """
    cells = snapped(drop_incomplete(grids))
    if "variety" in cells.columns:
        cells = cells.withColumn("variety", map_variety(F.col("variety"), varieties or {}))
    cells = cells.withColumnsRenamed(_GRID_NAMES).withColumn("idPoint", point_id(F.col("lat"), F.col("lon")))
    replaced = [name for name in cells.columns if name in management.columns]
    crossed = grid_product(cells, management.drop(*replaced), slots=slots)
    return crossed.withColumns(
        {
            "oldid": F.col("idMangt"),
            "idMangt": cell_mangt_id(F.col("idPoint"), F.col("idMangt")),
            "sowingdate": trunc_int(F.col("sowingdate")),
        }
    )


def expand_sowing(management: DataFrame, dates: Sequence[int]) -> DataFrame:
    """Every record once per sowing date, the date being added to the ids."""
    sown = management.withColumn("sowingdate", F.explode(F.array(*[F.lit(int(date)) for date in dates])))
    ids = [name for name in ("idMangt", "oldid") if name in management.columns]
    return sown.withColumns({name: sown_mangt_id(F.col(name), F.col("sowingdate")) for name in ids})


def management_table(
    management: DataFrame,
    grids: DataFrame | None = None,
    dates: Sequence[int] | None = None,
    cultivars: Iterable[str] = (),
    fertiliser: Iterable = (),
    varieties: Mapping[str, str] | None = None,
) -> DataFrame:
    """The management records to simulate.

    The lists select cultivars and fertiliser codes unless these come from a grid. The choice is
    made on the base records, before they are multiplied by cells and dates.
    """
    gridded = set(grids.columns) if grids is not None else set()
    if "variety" not in gridded and "Idcultivar" not in gridded:
        management = filter_in(management, "Idcultivar", cultivars)
    if "InoFertiPolicyCode" not in gridded:
        management = filter_in(management, "InoFertiPolicyCode", fertiliser)
    table = management if grids is None else spatialise_management(management, grids, varieties)
    return table if dates is None else expand_sowing(table, dates)
