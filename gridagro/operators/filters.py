"""Row filters, masks and column clean-up."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from gridagro.functions import nan_to_null, snap
from gridagro.operators.joins import HOT_SPLITS, lookup_join

CELL = ("lat", "lon")


def snapped(df: DataFrame) -> DataFrame:
    """Grid keys moved to the common 4-digit lattice."""
    return df.withColumns({name: snap(F.col(name)) for name in CELL})


def in_degrees(df: DataFrame) -> DataFrame:
    """The same rows; a coordinate that cannot be in degrees is an error."""
    beyond = (F.abs("lat") > 90) | (F.col("lon") < -180) | (F.col("lon") > 360)
    problem = F.raise_error(F.concat_ws(" ", F.lit("not in degrees:"), F.col("lat").cast("string"), F.col("lon").cast("string"))).cast("boolean")
    return df.filter(F.when(beyond, problem).otherwise(F.lit(True)))


def nulls_for_nans(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating-point column."""
    floats = [name for name, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({name: nan_to_null(F.col(name)) for name in floats})


def clip_bbox(df: DataFrame, lon_min: float, lat_min: float, lon_max: float, lat_max: float) -> DataFrame:
    """Cells inside a bounding box, both ends included; the filter reaches the scan."""
    return df.filter(F.col("lat").between(lat_min, lat_max) & F.col("lon").between(lon_min, lon_max))


def filter_years(df: DataFrame, first: int, last: int) -> DataFrame:
    """Rows of a range of years, as conditions on ``year`` (prunes partitions) and on ``time``."""
    if "year" in df.columns:
        df = df.filter(F.col("year").between(first, last))
    if "time" in df.columns:
        start, stop = (F.lit(date(year, 1, 1)) for year in (first, last + 1))
        df = df.filter((F.col("time") >= start) & (F.col("time") < stop))
    return df


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows without any missing value, NULL or NaN.

    One condition per column: the scan can use the null checks, and the optimizer's constraint
    rules stay linear in the number of columns, which they do not for a single ``na.drop``.
    """
    present = [F.col(name).isNotNull() for name in df.columns]
    numbers = [~F.isnan(name) for name, kind in df.dtypes if kind in ("double", "float")]
    return df.filter(reduce(and_, present + numbers))


def unit_mask(cells: DataFrame) -> DataFrame:
    """A mask of ones over all cells, for runs without a crop mask."""
    return cells.select(*CELL, F.lit(1.0).alias("mask"))


def apply_mask(df: DataFrame, mask: DataFrame) -> DataFrame:
    """Rows whose cell has mask 1, matched by coordinate."""
    kept = snapped(mask.filter("mask = 1")).select(*CELL)
    return lookup_join(snapped(df), kept, CELL, "left_semi")


def valid_cells(mask: DataFrame, soil: DataFrame) -> DataFrame:
    """The mask, set to NULL where any soil variable is missing."""
    complete = snapped(drop_incomplete(soil)).select(*CELL, F.lit(True).alias("__complete"))
    return (
        nulls_for_nans(snapped(mask.select(*CELL, "mask")))
        .join(complete, list(CELL), "left")
        .select(*CELL, F.when(F.col("__complete"), F.col("mask")).alias("mask"))
    )


def crop_cells(mask: DataFrame, soil: DataFrame) -> DataFrame:
    """The cells with mask 1 and complete soil: ``valid_cells`` for those who need no others.

    A semi-join, whose estimated size is that of the mask, so later joins with it are planned as
    joins with a small table.
    """
    complete = snapped(drop_incomplete(soil)).select(*CELL)
    return snapped(mask.filter("mask = 1").select(*CELL, "mask")).join(complete, list(CELL), "left_semi")


def count_cells(mask: DataFrame) -> DataFrame:
    """Number of cells with a mask value."""
    return nulls_for_nans(mask).agg(F.count("mask").alias("n_cells"))


def filter_in(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Rows whose ``column`` is listed, compared as text; an empty list keeps all rows."""
    wanted = [str(value) for value in values]
    return df.filter(F.col(column).cast("string").isin(wanted)) if wanted else df


def null_sentinel(df: DataFrame, sentinel: float = -99, columns: Iterable[str] | None = None) -> DataFrame:
    """The missing-value code of a model becomes NULL, in all numeric columns or in those listed."""
    kinds = ("double", "float", "int", "bigint", "smallint")
    numeric = [name for name, kind in df.dtypes if kind in kinds] if columns is None else columns
    return df.withColumns({name: F.when(F.col(name) != sentinel, F.col(name)) for name in numeric})


def null_negative(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Negative values become NULL in the listed columns."""
    return df.withColumns({name: F.when(F.col(name) >= 0, F.col(name)) for name in columns})


def conform(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Exactly ``columns`` (name to type), in that order; absent ones are NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(name) if name in present else F.lit(None)).cast(kind).alias(name)
            for name, kind in columns.items()
        ]
    )


def unfertilised_code(code: Column) -> Column:
    """Whether a fertiliser code, number or text, is 0."""
    return F.coalesce(code.try_cast("double") == 0, F.lit(False))


def drop_fertilised(units: DataFrame, management: DataFrame, options: Sequence[int] = (2, 4)) -> DataFrame:
    """Drop units of a no-fertiliser option whose management is not a zero-fertiliser one.

    Few management ids may cover all units, hence the split by unit id.
    """
    known = (
        management.filter(unfertilised_code(F.col("InoFertiPolicyCode")) & F.col("idMangt").isNotNull())
        .select("idMangt", F.lit(True).alias("__unfertilised"))
        .distinct()
    )
    return (
        lookup_join(units, known, ["idMangt"], "left", spread=["idsim"], splits=HOT_SPLITS)
        .filter(~F.col("idOption").isin(*options) | F.col("__unfertilised"))
        .drop("__unfertilised")
    )
