"""Reference evapotranspiration and thermal time."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridagro.functions import degree_day, et0_tdew, kelvin_to_celsius, season_year, tmean
from gridagro.functions.agroclimate import DEFAULT_BASE
from gridagro.operators.cube import combine_by_coords, with_static
from gridagro.operators.filters import CELL, filter_years, nulls_for_nans, snapped
from gridagro.operators.joins import lookup_join
from gridagro.plans.inputs import reference_et


def with_coordinates(climate: DataFrame, coordinates: DataFrame) -> DataFrame:
    """Climate rows with the latitude and altitude of their point."""
    known = coordinates.select("idPoint", F.col("latitudeDD").alias("latitude"), "altitude")
    return lookup_join(climate, known, ["idPoint"], "left")


def with_reference_et(climate: DataFrame, coordinates: DataFrame, method: str = "tdew") -> DataFrame:
    """The climate table with Etppm computed from dew points or from relative humidity."""
    et = reference_et(method, F.col("latitude"), F.col("altitude"), F.col("DOY"))
    return with_coordinates(climate, coordinates).withColumn("Etppm", et).select(*climate.columns)


def gridded_reference_et(cube: DataFrame, dem: DataFrame) -> DataFrame:
    """Daily evapotranspiration grids ``etp`` from a cube and an elevation grid with Band1."""
    elevation = dem.select(*CELL, F.col("Band1").alias("altitude"))
    placed = with_static(nulls_for_nans(cube), nulls_for_nans(elevation))
    names = ("tmin", "tmax", "tmoy", "Tdewmin", "Tdewmax", "wind", "srad")
    et = et0_tdew(
        F.col("lat"),
        F.col("altitude"),
        F.col("DOY"),
        *[F.col(name) for name in names],
        guard=True,
        clip_low=False,
    )
    return placed.select("time", *CELL, et.alias("etp"))


def thermal_time(
    tmax: DataFrame,
    tmin: DataFrame | None,
    calendar: DataFrame,
    first: int,
    last: int,
    base: float = DEFAULT_BASE,
) -> DataFrame:
    """Degree-days above ``base`` in each cell's growing season, per planting year.

    ``tmax`` and ``tmin`` hold tasmax and tasmin in kelvin, the calendar planting_day and
    maturity_day. A cube stored with both temperatures side by side is given as ``tmax`` alone;
    it needs no alignment, and its days are added up before anything is shuffled. Each day falls into at most one season, so days are neither repeated nor
    scanned once per year. A missing temperature adds nothing; a cell without days in season, or
    without a calendar, has 0.
    """
    if tmin is None:
        both = filter_years(tmax, first, last + 1).select("time", *CELL, "tasmax", "tasmin")
        daily = nulls_for_nans(snapped(both))
    else:
        parts = [
            filter_years(df, first, last + 1).select("time", *CELL, name)
            for df, name in ((tmax, "tasmax"), (tmin, "tasmin"))
        ]
        daily = combine_by_coords(parts)
    seasons = nulls_for_nans(snapped(calendar.select(*CELL, "planting_day", "maturity_day")))
    degrees = degree_day(kelvin_to_celsius(tmean(F.col("tasmin"), F.col("tasmax"))), base)
    planted = season_year(F.year("time"), F.dayofyear("time"), F.col("planting_day"), F.col("maturity_day"))
    # Days out of season stay in a group of their own, which keeps their cells in the result.
    sums = (
        lookup_join(daily, seasons, CELL, "left")
        .groupBy(*CELL, planted.alias("ref_year"))
        .agg(F.sum(degrees).alias("gdd"))
    )
    # One entry per year and cell, so that years without a sum are filled in without a second scan.
    entry = F.when(F.col("ref_year").isNotNull(), F.struct("ref_year", "gdd"))
    by_cell = sums.groupBy(*CELL).agg(F.map_from_entries(F.collect_list(entry)).alias("by_year"))
    return by_cell.select(
        F.explode(F.sequence(F.lit(first), F.lit(last))).alias("ref_year"), *CELL, "by_year"
    ).select("ref_year", *CELL, F.coalesce(F.element_at("by_year", F.col("ref_year")), F.lit(0.0)).alias("gdd"))
