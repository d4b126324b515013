"""Temperatures, extraterrestrial radiation and reference evapotranspiration.

Every function is a Column expression, so it runs inside generated code; a NULL input gives a
NULL result. Units: altitude m, temperatures degrees C, wind m/s at 2 m, radiation MJ/m2/day,
evapotranspiration mm/day.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from gridagro.functions.numeric import nan_to_null

# Physical constants of the FAO-56 equations.
SOLAR_CONSTANT = 0.082
STEFAN_BOLTZMANN = 4.903e-9
KELVIN_OFFSET = 273.15
DEFAULT_BASE = 8.0


def tmean(tmin: Column, tmax: Column) -> Column:
    return (tmin + tmax) / 2


def kelvin_to_celsius(t: Column) -> Column:
    return t - KELVIN_OFFSET


def degree_day(t: Column, base: float = DEFAULT_BASE) -> Column:
    """Degrees above ``base``; a missing temperature counts as no degrees."""
    if base < 0:
        raise ValueError("the base temperature must not be negative")
    return F.when(t > base, t - base).otherwise(F.lit(0.0))


def ra(lat: Column, doy: Column, guard: bool = False) -> Column:
    """Extraterrestrial radiation.

    Without ``guard`` days of polar night or polar day give NULL; with it the sunset angle is
    held just inside its domain.
    """
    phi = F.radians(lat)
    turn = F.lit(2 * math.pi) * doy / 365
    distance = F.lit(1.0) + F.lit(0.033) * F.cos(turn)
    declination = F.lit(0.409) * F.sin(turn - 1.39)
    slope = F.tan(phi) * F.tan(declination)
    if guard:
        inside = F.lit(1.0) - slope * slope
        inside = F.when(inside <= 0, F.lit(1e-5)).otherwise(inside)
        sunset = F.atan(slope / F.sqrt(inside)) + math.pi / 2
    else:
        sunset = nan_to_null(F.acos(-slope))
    daily = sunset * F.sin(phi) * F.sin(declination) + F.cos(phi) * F.cos(declination) * F.sin(sunset)
    return F.lit(24 * 60 / math.pi * SOLAR_CONSTANT) * distance * daily


def saturation_pressure(t: Column) -> Column:
    return F.lit(0.6108) * F.exp(F.lit(17.27) * t / (t + 237.3))


def _saturation_mean(tmin: Column, tmax: Column) -> Column:
    return (saturation_pressure(tmin) + saturation_pressure(tmax)) / 2


def _penman_monteith(alt, tmin, tmax, tmid, vapour, wind, srad, radiation, clip_low) -> Column:
    pressure = F.lit(101.3) * F.pow((F.lit(293.0) - F.lit(0.0065) * alt) / 293, F.lit(5.26))
    gamma = F.lit(0.000665) * pressure
    delta = F.lit(4098.0) * saturation_pressure(tmid) / F.pow(tmid + 237.3, F.lit(2.0))
    deficit = _saturation_mean(tmin, tmax) - vapour

    # try_divide: a clear-sky radiation of 0 gives NULL instead of an error. least/greatest skip
    # NULL, hence the guard that keeps a missing ratio missing.
    ratio = F.try_divide(srad, (F.lit(0.75) + F.lit(2e-5) * alt) * radiation)
    cloudiness = F.least(ratio, F.lit(1.0))
    if clip_low:
        cloudiness = F.greatest(cloudiness, F.lit(0.0))
    cloudiness = F.when(ratio.isNotNull(), cloudiness)

    body = (F.pow(tmin + 273.16, F.lit(4.0)) + F.pow(tmax + 273.16, F.lit(4.0))) / 2
    longwave = (
        F.lit(STEFAN_BOLTZMANN)
        * body
        * (cloudiness * 1.35 - 0.35)
        * (F.lit(0.34) - F.lit(0.14) * F.sqrt(vapour))
    )
    net = F.lit(0.77) * srad - longwave
    wind_term = gamma * 900 * wind * deficit / (tmid + 273)
    return nan_to_null((F.lit(0.408) * delta * net + wind_term) / (delta + gamma * (F.lit(0.34) * wind + 1)))


def et0_tdew(lat, alt, doy, tmin, tmax, tmid, tdewmin, tdewmax, wind, srad, guard=False, clip_low=True) -> Column:
    """Penman-Monteith reference evapotranspiration with vapour pressure from dew points."""
    vapour = (saturation_pressure(tdewmax) + saturation_pressure(tdewmin)) / 2
    return _penman_monteith(alt, tmin, tmax, tmid, vapour, wind, srad, ra(lat, doy, guard), clip_low)


def et0_rhum(lat, alt, doy, tmin, tmax, tmid, rhum, wind, srad, guard=False, clip_low=True) -> Column:
    """Penman-Monteith reference evapotranspiration with vapour pressure from relative humidity."""
    vapour = rhum * _saturation_mean(tmin, tmax) / 100
    return _penman_monteith(alt, tmin, tmax, tmid, vapour, wind, srad, ra(lat, doy, guard), clip_low)
