"""Numeric column helpers: rounding, truncation, unit changes and missing values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

COORDINATE_DIGITS = 4
CLIMATE_DIGITS = 1
SOIL_DIGITS = 3


def nan_to_null(x: Column) -> Column:
    """NaN becomes NULL, so that only one kind of missing value travels through a plan."""
    return F.nanvl(x, F.lit(None))


def round_half_even(x: Column, digits: int) -> Column:
    """Round to ``digits`` decimals, ties to even (``round`` of Spark goes half-up)."""
    scale = F.lit(float(10**digits))
    return F.rint(x * scale) / scale


def snap(coordinate: Column) -> Column:
    """Coordinate on the 4-digit lattice on which grids are joined and ids are built."""
    return round_half_even(coordinate, COORDINATE_DIGITS)


def strict_cast(value: Column, kind: str) -> Column:
    """Text as ``kind``; blank text is NULL, text that cannot be read is an error."""
    text = F.trim(value.cast("string"))
    read = text.try_cast(kind)
    problem = F.raise_error(F.concat(F.lit(f"not readable as {kind}: "), text)).cast(kind)
    return F.when(text.isNull() | (text == ""), F.lit(None).cast(kind)).when(read.isNull(), problem).otherwise(read)


def trunc_int(x: Column) -> Column:
    """Integer part, toward zero: -3.7 gives -3."""
    return nan_to_null(x.cast("double")).cast("int")


def kg_to_t(x: Column) -> Column:
    """kg/ha to t/ha."""
    return x / F.lit(1000.0)


def as_float(x: Column) -> Column:
    """Single precision, as stored in published cubes."""
    return x.cast("float")


def fill_in_mask(x: Column, mask: Column) -> Column:
    """NULL becomes 0 where the crop mask is 1; other values stay."""
    return F.when(x.isNull() & (mask == 1), F.lit(0).cast("double")).otherwise(x)
