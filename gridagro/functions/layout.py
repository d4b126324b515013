"""Keys that lay out tables so that boxes of cells are found in few files and pages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Steps per degree of the curve: arc seconds, finer than any grid here; 21 bits hold the longitudes from -180 to 360.
_STEPS = 3600


def _spread(x: Column) -> Column:
    """The bits of x on the even places of a long: its binary digits, read as a number in base 4.

    x stands here once. Shifts and masks name it twice in each of five steps, which Spark unfolds to 32 copies.
    """
    return F.conv(F.bin(x), 4, 10).cast("long")


def z_key(lat: Column, lon: Column) -> Column:
    """Place of a cell on the Z-order curve over latitude and longitude: cells near in both are near on it.

    NULL where a coordinate is missing. Coordinates beyond -90 to 90 and -180 to 360 count as the nearest of these.
    """

    def step(degrees: Column, least: int, most: int) -> Column:
        return F.floor((F.greatest(F.lit(float(least)), F.least(degrees, F.lit(float(most)))) - least) * _STEPS).cast("long")

    key = _spread(step(lon, -180, 360)).bitwiseOR(F.shiftleft(_spread(step(lat, -90, 90)), 1))
    return F.when(lat.isNotNull() & lon.isNotNull(), key)
