"""Calendar helpers: date parts, leap years, simulation windows and season membership."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Window:
    """First and last day of a simulation, as (year, day of year) pairs."""

    start_day: Column
    end_year: Column
    end_day: Column


def to_day(ts: Column) -> Column:
    return F.to_date(ts)


def calendar_parts(time: Column) -> dict[str, Column]:
    """Date text and integer parts of a day, keyed by their column names."""
    return {
        "w_date": F.date_format(time, "yyyy-MM-dd"),
        "year": F.year(time),
        "DOY": F.dayofyear(time),
        "Nmonth": F.month(time),
        "NdayM": F.dayofmonth(time),
    }


def is_leap(year: Column) -> Column:
    return ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)


def year_length(year: Column) -> Column:
    return F.when(is_leap(year), 366).otherwise(365)


def start_day(sowing: Column, before: int) -> Column:
    """Day on which the simulation starts; it never reaches back into the year before."""
    return F.when(sowing.isNotNull(), F.greatest(F.lit(1), sowing - before))


def _rolls_over(year: Column, sowing: Column, after: int, strict: bool) -> Column:
    limit = F.lit(365) if strict else year_length(year)
    return sowing + after > limit


def end_day(year: Column, sowing: Column, after: int, strict: bool = False) -> Column:
    """Day of year on which the simulation ends.

    ``strict`` compares with 365 in every year, so that day 366 of a leap year becomes day 0
    of the next one.
    """
    last = sowing + after
    return F.when(_rolls_over(year, sowing, after, strict), last - year_length(year)).otherwise(last)


def end_year(year: Column, sowing: Column, after: int, strict: bool = False) -> Column:
    return F.when(_rolls_over(year, sowing, after, strict), year + 1).otherwise(year)


def sowing_window(year: Column, sowing: Column, before: int, after: int, strict: bool = False) -> Window:
    """Window from ``before`` days ahead of sowing to ``after`` days past it."""
    return Window(
        start_day(sowing, before),
        end_year(year, sowing, after, strict),
        end_day(year, sowing, after, strict),
    )


def fixed_window(year: Column, start: int, end: int, strict: bool = False) -> Window:
    """The same days of year for every unit; a window that ends before it starts wraps the year.

    ``strict`` wraps the windows that do not need it, and only those.
    """
    wraps = end > start if strict else start > end
    return Window(F.lit(start), year + 1 if wraps else year, F.lit(end))


def doy_from_sim_year(yyyyddd: Column, sim_year: Column, strict: bool = False) -> Column:
    """``YYYYDDD`` as a day counted from the first day of the simulation year.

    A date in a later year is moved by the length of the simulation year (``strict``: by the
    length of the date's own year).
    """
    year = F.floor(yyyyddd / 1000)
    day = yyyyddd % 1000
    return F.when(year > sim_year, day + year_length(year if strict else sim_year)).otherwise(day).cast("double")


def season_year(year: Column, doy: Column, planting: Column, harvest: Column) -> Column:
    """Year in which the season that holds this day was planted, NULL outside any season.

    With harvest before planting the season runs into the next year. A day belongs to at most
    one season, so no day has to be repeated for its candidate years.
    """
    wraps = harvest < planting
    return (
        F.when(~wraps & doy.between(planting, harvest), year)
        .when(wraps & (doy >= planting), year)
        .when(wraps & (doy <= harvest), year - 1)
    )


def in_season(year: Column, doy: Column, planting: Column, harvest: Column, ref_year: Column) -> Column:
    """Whether a day lies in the season planted in ``ref_year``."""
    return F.coalesce(season_year(year, doy, planting, harvest) == ref_year, F.lit(False))


def day_of(year: Column, doy: Column) -> Column:
    """Days since 1970-01-01 of a (year, day of year) pair."""
    return F.unix_date(F.make_date(year, F.lit(1), F.lit(1))) + doy - 1
