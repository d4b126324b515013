"""Results of the crop models in one schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from gridagro.functions import doy_from_sim_year, kg_to_t, parse_sim_id
from gridagro.operators.cube import union_by_name
from gridagro.operators.filters import conform, null_negative, null_sentinel, nulls_for_nans
from gridagro.sources.schemas import MODEL_DATES, OUTPUT_VALUES, RAW_OUTPUT, SUMMARY_OUTPUT

# Field names of one model's result table and the common names.
CELSIUS_FIELDS = {
    "idsim": "Idsim",
    "iplt": "Planting",
    "JulPheno1_1": "Emergence",
    "JulPheno1_4": "Ant",
    "JulPheno1_6": "Mat",
    "Biom(nrec)": "Biom_ma",
    "Grain(nrec)": "Yield",
    "LAI": "MaxLai",
    "SigmaSimEsol": "CumE",
    "Ngrain": "GNumber",
    "stockNsol": "SoilN",
    "SigmaCultEsol": "Transp",
}

def _normalised(df: DataFrame, model: str) -> DataFrame:
    """Common columns; coordinates and year come from the file, or from the id where absent."""
    parsed = parse_sim_id(F.col("Idsim"))
    absent = {name: column for name, column in parsed.items() if name not in df.columns}
    named = {"Model": F.lit(model), "scenario": parsed["scenario"]}
    if "Texte" not in df.columns:
        named["Texte"] = F.lit("")
    columns = {"scenario": "string", **RAW_OUTPUT}
    return conform(nulls_for_nans(df).withColumns({**absent, **named}), columns)


def normalise_celsius(raw: DataFrame) -> DataFrame:
    """Renamed fields, the rest parsed from the id. This model reports no Nleac and CroN_ma."""
    return _normalised(raw.withColumnsRenamed(CELSIUS_FIELDS), "Celsius")


def normalise_dssat(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Missing-value codes removed, dates as days from the simulation year, t/ha, no negatives.

    Only reported values are searched for the missing-value code: a longitude of -99 is a place.
    """
    year = parse_sim_id(F.col("Idsim"))["time"]
    cleaned = null_sentinel(nulls_for_nans(raw), columns=OUTPUT_VALUES)
    dated = cleaned.withColumns({name: doy_from_sim_year(F.col(name), year, strict) for name in MODEL_DATES})
    weighed = dated.withColumns({name: kg_to_t(F.col(name)) for name in ("Yield", "Biom_ma")})
    return _normalised(null_negative(weighed, OUTPUT_VALUES), "Dssat")


def normalise_stics(raw: DataFrame) -> DataFrame:
    """Values as reported."""
    return _normalised(raw, "Stics")


def normalise_output(raw: DataFrame, model: str) -> DataFrame:
    """Results of one of the three models in the common schema."""
    variants = {"celsius": normalise_celsius, "dssat": normalise_dssat, "stics": normalise_stics}
    return variants[model.lower()](raw)


def union_outputs(parts: Sequence[DataFrame]) -> DataFrame:
    """Results of several models in one table."""
    return union_by_name(parts)


def output_cube(outputs: DataFrame) -> DataFrame:
    """Values of the outputs keyed by model, scenario and (time, lat, lon), without the text columns."""
    extra = [name for name in ("subdomain",) if name in outputs.columns]
    values = [name for name in OUTPUT_VALUES if name in outputs.columns]
    return outputs.select(F.col("Model").alias("model"), "scenario", "time", "lat", "lon", *extra, *values)


def summary_output(outputs: DataFrame) -> DataFrame:
    """The columns of the summary table."""
    return conform(outputs, SUMMARY_OUTPUT)


def replace_model_rows(existing: DataFrame, fresh: DataFrame, model: str) -> DataFrame:
    """``existing`` with the rows of one model replaced by ``fresh``."""
    kept = existing.filter(~F.col("Model").eqNullSafe(F.lit(model)))
    return union_by_name([kept, fresh])
