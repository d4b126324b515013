"""Identifiers, code tables and the parsing of names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from gridagro.functions.numeric import snap

# Soil texture codes and their class names.
TEXTURE_CLASSES = {
    1: "clay",
    2: "silty clay",
    3: "sandy clay",
    4: "clay loam",
    5: "silty clay loam",
    6: "sandy clay loam",
    7: "loam",
    8: "silty loam",
    9: "sandy loam",
    10: "silt",
    11: "loamy sand",
    12: "sand",
}


def _coordinate_text(x: Column) -> Column:
    # A decimal never prints with an exponent; one zero stays after the point.
    short = F.rtrim(snap(x).cast("decimal(9,4)").cast("string"), F.lit("0"))
    return F.concat(short, F.when(short.endswith("."), "0").otherwise(""))


def point_id(lat: Column, lon: Column) -> Column:
    """``<lat>_<lon>`` with at most four decimals and at least one."""
    return F.concat_ws("_", _coordinate_text(lat), _coordinate_text(lon))


def sim_id(point: Column, year: Column, mangt: Column, option: Column) -> Column:
    return F.concat_ws("_", point, year.cast("string"), mangt, option.cast("string"))


def parse_sim_id(idsim: Column) -> dict[str, Column]:
    """lat, lon, year and scenario of a simulation id."""
    pieces = F.split(idsim, "_", 4)
    return {
        "lat": F.get(pieces, F.lit(0)).cast("double"),
        "lon": F.get(pieces, F.lit(1)).cast("double"),
        "time": F.get(pieces, F.lit(2)).cast("double").cast("int"),
        "scenario": F.get(pieces, F.lit(3)),
    }


def scenario_of(idsim: Column) -> Column:
    return F.get(F.split(idsim, "_", 4), F.lit(3))


def in_scenario(idsim: Column, scenario: Column | str) -> Column:
    """Equality on the parsed scenario, so that ``1_2`` does not catch ``11_2``."""
    wanted = F.lit(scenario) if isinstance(scenario, str) else scenario
    return scenario_of(idsim) == wanted


def parse_output_name(path: Column) -> dict[str, Column]:
    """model, scenario and sub-domain out of ``…/<model>_yearly_<scenario>_<subdomain>.<ext>``."""
    pattern = r"([^/_]+)_yearly_(.+)_([0-9]+)\.[A-Za-z0-9]+$"
    return {
        "model": F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")),
        "scenario": F.nullif(F.regexp_extract(path, pattern, 2), F.lit("")),
        "subdomain": F.nullif(F.regexp_extract(path, pattern, 3), F.lit("")).cast("int"),
    }


def parse_file_name(path: Column, pattern: str) -> dict[str, Column]:
    """variable, first year and last year out of a file name; NULL where ``pattern`` does not match.

    The three groups of ``pattern`` must be the variable and the two years.
    """
    return {
        "variable": F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")),
        "first_year": F.nullif(F.regexp_extract(path, pattern, 2), F.lit("")).cast("int"),
        "last_year": F.nullif(F.regexp_extract(path, pattern, 3), F.lit("")).cast("int"),
    }


def _literal_map(values: Mapping[int, str]) -> Column:
    return F.create_map(*[F.lit(item) for pair in values.items() for item in pair])


def texture_name(code: Column) -> Column:
    """Class name of a soil texture code, NULL for an unknown code."""
    return F.element_at(_literal_map(TEXTURE_CLASSES), code.cast("int"))


def map_variety(code: Column, mapping: Mapping[str, str]) -> Column:
    """Cultivar of a variety code; the code is rounded first and unmapped codes give NULL.

    ``mapping`` has keys such as ``"26.0"``.
    """
    by_code = {int(float(key)): cultivar for key, cultivar in mapping.items()}
    if not by_code:
        return F.lit(None).cast("string")
    return F.element_at(_literal_map(by_code), F.rint(code).cast("int"))


def cell_mangt_id(point: Column, mangt: Column) -> Column:
    return F.concat_ws("_", point, mangt)


def sown_mangt_id(mangt: Column, sowing: Column) -> Column:
    return F.concat_ws("_", mangt, sowing.cast("string"))


def weather_key(point: Column, year: Column, doy: Column) -> Column:
    return F.concat_ws(".", point, year.cast("string"), doy.cast("string"))
