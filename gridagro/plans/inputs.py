"""The keyed input tables: cells, coordinates, soil, climate and the weather layout of a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gridagro.functions import (
    calendar_parts,
    et0_rhum,
    et0_tdew,
    point_id,
    round_half_even,
    texture_name,
    tmean,
    to_day,
    trunc_int,
    weather_key,
)
from gridagro.functions.numeric import CLIMATE_DIGITS, COORDINATE_DIGITS, SOIL_DIGITS
from gridagro.operators.filters import (
    CELL,
    apply_mask,
    conform,
    crop_cells,
    drop_incomplete,
    filter_years,
    nulls_for_nans,
    snapped,
    valid_cells,
)
from gridagro.operators.joins import lookup_join
from gridagro.operators.partition import assign_subdomain
from gridagro.sources.schemas import (
    CLIMATE,
    CLIMATE_VALUES,
    COORDINATES,
    COORDINATES_LEGACY,
    MODEL_WEATHER,
    SOIL,
    SOIL_VALUES,
)


def valid_subdomains(mask: DataFrame, soil: DataFrame, n: int, strict: bool = False, degrees: bool = True) -> DataFrame:
    """Valid crop cells with their sub-domain. Written once, it serves every table below."""
    return assign_subdomain(valid_cells(mask, soil) if strict else crop_cells(mask, soil), n, strict, degrees)


def _inside(df: DataFrame, cells: DataFrame | None) -> DataFrame:
    """Complete rows of the masked cells, or of all cells, on the common lattice."""
    return drop_incomplete(snapped(df) if cells is None else apply_mask(df, cells))


def coordinates_table(dem: DataFrame, cells: DataFrame | None = None, legacy: bool = False) -> DataFrame:
    """Altitude and coordinates of each cell; ``dem`` has lat, lon and Band1."""
    known = _inside(dem.select(*CELL, "Band1"), cells)
    blank = F.lit("")
    columns = COORDINATES_LEGACY if legacy else COORDINATES
    return conform(
        known.select(
            trunc_int(round_half_even(F.col("Band1"), COORDINATE_DIGITS)).alias("altitude"),
            F.col("lat").alias("latitudeDD"),
            F.col("lon").alias("longitudeDD"),
            point_id(F.col("lat"), F.col("lon")).alias("idPoint"),
            *[blank.alias(name) for name in columns if name in ("codeSWstation", "startRain", "EndRain")],
            *[blank.alias(name) for name in columns if name not in COORDINATES],
        ),
        columns,
    )


def soil_table(soil: DataFrame, cells: DataFrame | None = None, texture: str | None = None) -> DataFrame:
    """Soil records of the valid cells; ``texture`` fixes one class instead of the Band1 codes."""
    known = _inside(soil, cells)
    values = {name: round_half_even(F.col(name).cast("double"), SOIL_DIGITS) for name in SOIL_VALUES}
    constants = {
        "IdSoil": point_id(F.col("lat"), F.col("lon")),
        "totp": F.lit(-99.0),
        "SoilTextureType": F.lit(texture) if texture is not None else texture_name(F.col("Band1")),
        "SoilOption": F.lit("simple"),
        "RunoffType": F.lit(1),
        "albedo": F.lit(0.3),
    }
    return conform(known.withColumns({**values, **constants}), SOIL)


def climate_table(
    cube: DataFrame,
    cells: DataFrame | None = None,
    first: int | None = None,
    last: int | None = None,
    method: str | None = None,
) -> DataFrame:
    """Daily climate of the valid cells; ``cube`` has time, lat, lon and the aligned variables.

    All years in one plan: filters on ``time`` and the mask come before any arithmetic, and the
    only join is that with the cells. With a ``method`` the cells must have the elevation ``Band1``,
    and the reference evapotranspiration is computed in the same pass; it is NULL without elevation.
    """
    if first is not None and last is not None:
        cube = filter_years(cube, first, last)
    if method is None:
        known = _inside(cube, cells)
    else:
        height = snapped(cells.filter("mask = 1")).select(*CELL, trunc_int(round_half_even(F.col("Band1"), COORDINATE_DIGITS)).alias("__altitude"))
        known = lookup_join(drop_incomplete(snapped(cube)), height, CELL, "inner")
    if "pr" in known.columns:
        known = known.withColumnRenamed("pr", "rain")
    known = known.withColumn("tmoy", tmean(F.col("tmin"), F.col("tmax")))
    present = [name for name in CLIMATE_VALUES if name in known.columns]
    rounded = {name: round_half_even(F.col(name).cast("double"), CLIMATE_DIGITS) for name in present}
    keys = {**calendar_parts(to_day(F.col("time"))), "idPoint": point_id(F.col("lat"), F.col("lon"))}
    table = known.withColumns({**rounded, **keys})
    if method is not None:
        table = table.withColumn("Etppm", reference_et(method, F.col("lat"), F.col("__altitude"), F.col("DOY")))
    return conform(table, CLIMATE)


def reference_et(method: str, latitude: Column, altitude: Column, doy: Column) -> Column:
    """Evapotranspiration from the columns of the climate table, by dew points or by relative humidity."""
    temperatures = [F.col(name) for name in ("tmin", "tmax", "tmoy")]
    wind, srad = F.col("wind"), F.col("srad")
    if method == "tdew":
        return et0_tdew(latitude, altitude, doy, *temperatures, F.col("Tdewmin"), F.col("Tdewmax"), wind, srad)
    if method == "rhum":
        return et0_rhum(latitude, altitude, doy, *temperatures, F.col("rhum"), wind, srad)
    raise ValueError(f"unknown method {method!r}")


def model_weather(climate: DataFrame) -> DataFrame:
    """The climate table in the layout of a model's weather table."""
    renamed = climate.select(
        F.col("idPoint").alias("IdDClim"),
        weather_key(F.col("idPoint"), F.col("year"), F.col("DOY")).alias("idjourclim"),
        F.col("year").alias("annee"),
        F.col("DOY").alias("jda"),
        F.col("Nmonth").alias("mois"),
        F.col("NdayM").alias("jour"),
        "tmax",
        "tmin",
        "tmoy",
        F.col("srad").alias("rg"),
        F.col("rain").alias("plu"),
        F.col("Etppm").alias("Etp"),
    )
    return conform(renamed, MODEL_WEATHER)


def replace_texture(soil: DataFrame, texture: DataFrame, mask: DataFrame) -> DataFrame:
    """Soil records with the class of a texture grid; records without one are dropped.

    The mask only has to be present at a cell, whatever its value.
    """
    masked = nulls_for_nans(snapped(mask)).filter(F.col("mask").isNotNull()).select(*CELL)
    classes = (
        snapped(drop_incomplete(texture.select(*CELL, "Band1")))
        .join(masked, list(CELL), "left_semi")
        .select(
            point_id(F.col("lat"), F.col("lon")).alias("IdSoil"),
            texture_name(F.col("Band1")).alias("SoilTextureType"),
        )
    )
    old = [name for name in soil.columns if name in ("SoilTextureType", "SoilTextureType_x", "SoilTextureType_y")]
    return soil.drop(*old).join(classes, "IdSoil")
