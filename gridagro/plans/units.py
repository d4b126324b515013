"""The table of simulation units and their seasonal climate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as Spans, functions as F

from gridagro.functions import Window, day_of, fixed_window, sim_id, sowing_window
from gridagro.operators.aggregates import coordinate_years
from gridagro.operators.filters import conform, unfertilised_code
from gridagro.operators.joins import FEW, HOT_SPLITS, grid_product, lookup_join
from gridagro.sources.schemas import SIM_UNITS
from gridagro.sources.sinks import stored

UNIT_KEYS = ("idPoint", "idMangt", "IdSoil", "StartYear", "idOption")

# Sowing modes whose simulation window follows the sowing date; "model" has fixed days instead.
SOWING_MODES = ("fixed", "list", "grid")

NO_FERTILISER_OPTIONS = (2, 4)


def _unique_management(management: DataFrame) -> DataFrame:
    """One row per management id (and point), with its sowing date and label and a zero-fertiliser flag.

    Date and label are those of one record, the one with the smallest date.
    """
    keys = [name for name in ("idPoint", "idMangt") if name in management.columns]
    codes = [F.col(name) for name in ("InoFertiPolicyCode",) if name in management.columns]
    zero = [F.max(unfertilised_code(code)).alias("unfertilised") for code in codes]
    label = F.col("oldid" if "oldid" in management.columns else "idMangt")
    record = F.min(F.struct(F.col("sowingdate").cast("int").alias("sowingdate"), label.alias("label"))).alias("record")
    return management.groupBy(*keys).agg(record, *zero).withColumns({"sowingdate": F.col("record.sowingdate"), "label": F.col("record.label")}).drop("record")


def build_sim_units(
    years: DataFrame,
    soil: DataFrame,
    management: DataFrame,
    options: Sequence[int],
    mode: str = "list",
    before: int = 30,
    after: int = 200,
    start: int = 130,
    end: int = 290,
    strict: bool = False,
    zero_fertiliser_rule: bool = False,
    slots: int | None = None,
) -> DataFrame:
    """Simulation units: points with soil x years x management x options.

    Management applies at its own point if it has ``idPoint``, else everywhere. The inputs are
    made unique on their keys first, which makes the product unique as well, so the large result
    is neither shuffled nor de-duplicated. Years and options are unfolded last, row by row.
    ``slots`` is the number of shares of the product of points and management (see ``grid_product``).
    """
    if zero_fertiliser_rule and "InoFertiPolicyCode" not in management.columns:
        raise ValueError("the zero-fertiliser rule needs the column InoFertiPolicyCode of management")
    soils = soil.select(F.col("IdSoil").alias("idPoint")).distinct()
    # A point has no more entries than the calendar has years.
    points = (
        years.select("idPoint", "year")
        .distinct()
        .groupBy("idPoint")
        .agg(F.sort_array(F.collect_list("year")).alias("years"))
        .join(soils, "idPoint", "left_semi")
    )
    managed = _unique_management(management)
    if "idPoint" in managed.columns:
        placed = lookup_join(managed, points, ["idPoint"], "inner")
    else:
        placed = grid_product(points, managed, spread=["idPoint"], slots=slots)

    unfolded = placed.withColumn("year", F.explode("years")).withColumn(
        "idOption", F.explode(F.array(*[F.lit(int(option)) for option in dict.fromkeys(options)]))
    )
    if zero_fertiliser_rule:
        unfolded = unfolded.filter(~F.col("idOption").isin(*NO_FERTILISER_OPTIONS) | F.col("unfertilised"))

    year = F.col("year")
    window: Window
    if mode in SOWING_MODES:
        window = sowing_window(year, F.col("sowingdate"), before, after, strict)
    elif mode == "model":
        window = fixed_window(year, start, end, strict)
    else:
        raise ValueError(f"unknown sowing mode {mode!r}")
    return conform(
        unfolded.select(
            "idOption",
            "idPoint",
            "idMangt",
            F.col("idPoint").alias("IdSoil"),
            year.alias("StartYear"),
            window.start_day.alias("StartDay"),
            window.end_year.alias("EndYear"),
            window.end_day.alias("EndDay"),
            F.lit(1).alias("idIni"),
            sim_id(F.col("idPoint"), year, F.col("label"), F.col("idOption")).alias("idsim"),
        ),
        SIM_UNITS,
    )


def sim_units(climate: DataFrame, soil: DataFrame, management: DataFrame, options: Sequence[int], **window) -> DataFrame:
    """The unit table as a run uses it: years from the climate table, zero-fertiliser rule applied.

    The rule is a property of the management id, so it is checked while the units are unfolded
    and costs no join with the finished table.
    """
    return build_sim_units(coordinate_years(climate), soil, management, options, zero_fertiliser_rule=True, **window)


def dedupe_units(units: DataFrame) -> DataFrame:
    """One unit per key: of repeated ones, that with the smallest id, window and sowing."""
    rest = [name for name in units.columns if name not in UNIT_KEYS]
    ordered = ["idsim", *[name for name in rest if name != "idsim"]]
    return (
        units.groupBy(*UNIT_KEYS)
        .agg(F.min(F.struct(*ordered)).alias("unit"))
        .select(*[F.col(f"unit.{name}").alias(name) if name in rest else F.col(name) for name in units.columns])
    )


def order_units(units: DataFrame) -> DataFrame:
    """Units in the order of their keys, by range partitions."""
    return units.orderBy(*UNIT_KEYS)


def season_climate(units: DataFrame, climate: DataFrame) -> DataFrame:
    """Climate inside the window of each unit: sums of rain and ET, mean temperatures, day count.

    Units that share a window are computed once; the windows are stored with their numbers of units. The
    days of a point and year get running sums of each variable and of its known values; a window is the
    sum up to its last day less that up to the day before its first, whatever its length. Both ends of a window stand among the days as rows of
    their own, in the order of days, so they are looked up by the same running sum, gaps or not. A
    running sum covers one year at most, which keeps it as exact as adding up the window.
    """
    first, last = day_of(F.col("StartYear"), F.col("StartDay")), day_of(F.col("EndYear"), F.col("EndDay"))
    dated = units.select("idsim", "idPoint", first.alias("first"), last.alias("last"))
    windows = stored(dated.groupBy("idPoint", "first", "last").agg(F.count(F.lit(1)).alias("n")), "windows")
    hottest = windows.agg(F.max("n")).first()[0] or 0

    sums, means = ("rain", "Etppm"), ("tmin", "tmax", "tmoy")
    values = (*sums, *means)
    date = F.to_date("w_date")
    days = climate.select("idPoint", F.year(date).alias("year"), F.unix_date(date).alias("day"), F.lit(0).alias("end"), *[F.col(name).cast("double").alias(name) for name in values])

    # In its last year a window is added up to its last day, in earlier ones to the year's last; in its first year what is before it is taken off.
    opening, closing = F.unix_date(F.make_date("year", F.lit(1), F.lit(1))), F.unix_date(F.make_date("year", F.lit(12), F.lit(31)))
    years = F.sequence(*[F.year(F.date_from_unix_date(F.col(name).cast("int"))) for name in ("first", "last")])
    per_year = windows.filter("first <= last").withColumn("year", F.explode(years))
    ends = F.array(F.struct(F.least(F.col("last"), closing).alias("day"), F.lit(1).alias("end")), F.struct((F.col("first") - 1).alias("day"), F.lit(-1).alias("end")))
    looked_up = F.filter(ends, lambda e: (e["end"] == 1) | (e["day"] >= opening))
    edges = per_year.select("idPoint", "year", "first", "last", F.inline(looked_up))

    so_far = Spans.partitionBy("idPoint", "year").orderBy("day", F.abs("end")).rowsBetween(Spans.unboundedPreceding, Spans.currentRow)
    running = {name: F.sum(F.coalesce(name, F.lit(0.0))).over(so_far) for name in values}
    running |= {f"n_{name}": F.count(name).over(so_far) for name in values} | {"n_days": F.sum((F.col("end") == 0).cast("long")).over(so_far)}
    found = days.unionByName(edges, allowMissingColumns=True).withColumns(running).filter("end <> 0")
    totals = found.groupBy("idPoint", "first", "last").agg(
        F.sum(F.col("end") * F.col("n_days")).alias("n_days"),
        *[F.sum(F.col("end") * F.col(name)).alias(name) for name in values],
        *[F.sum(F.col("end") * F.col(f"n_{name}")).alias(f"n_{name}") for name in values],
    )
    totals = totals.select(
        "idPoint", "first", "last", "n_days",
        *[F.when(F.col(f"n_{name}") > 0, F.col(name)).alias(name) for name in sums],
        *[F.try_divide(name, f"n_{name}").alias(name) for name in means],
    )
    # A window may be shared by most units, hence the split by unit id; if none is, a split would only repeat the totals.
    splits = HOT_SPLITS if hottest > FEW else 1
    return (
        lookup_join(dated, totals, ["idPoint", "first", "last"], "left", spread=["idsim"], splits=splits)
        .drop("first", "last")
        .withColumn("n_days", F.coalesce("n_days", F.lit(0).cast("long")))
    )
