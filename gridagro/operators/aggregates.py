"""Grouped operators. Each reduces on the map side before its shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from gridagro.functions import scenario_of
from gridagro.operators.filters import nulls_for_nans


def coordinate_years(climate: DataFrame) -> DataFrame:
    """Distinct (idPoint, year) pairs of the climate table."""
    return climate.select("idPoint", F.col("year").cast("int").alias("year")).distinct()


def scenario_list(outputs: DataFrame) -> DataFrame:
    """Distinct scenarios of each model."""
    return outputs.select(F.col("Model").alias("model"), scenario_of(F.col("Idsim")).alias("scenario")).distinct()


def simulations_per_subdomain(outputs: DataFrame) -> DataFrame:
    """Number of simulations of each model in each sub-domain."""
    return outputs.groupBy("model", "subdomain").agg(F.count(F.lit(1)).alias("n_simulations"))


def duplicate_keys(
    outputs: DataFrame, keys: Sequence[str] = ("model", "scenario", "time", "lat", "lon")
) -> DataFrame:
    """Keys that occur more than once; a cube can only be laid out when there are none."""
    return outputs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def first_non_null(outputs: DataFrame, keys: Sequence[str], priority: str = "subdomain") -> DataFrame:
    """One row per key with, for each variable, the non-NULL value of the lowest ``priority``."""
    variables = [name for name in outputs.columns if name not in (*keys, priority)]
    return outputs.groupBy(*keys).agg(
        *[
            F.min_by(name, F.when(F.col(name).isNotNull(), F.col(priority))).alias(name)
            for name in variables
        ]
    )


def mean_yield_map(outputs: DataFrame, first_year: int, last_year: int, value: str = "Yield") -> DataFrame:
    """Mean of ``value`` over the years for each model, scenario and cell."""
    return (
        nulls_for_nans(outputs.filter(F.col("time").between(first_year, last_year)))
        .groupBy("model", "scenario", "lat", "lon")
        .agg(F.avg(value).alias(f"mean_{value}"), F.count(value).alias("n_years"))
    )
