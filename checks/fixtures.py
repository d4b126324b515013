"""Grids, cubes and tables derived from the driver's tables (see FIXTURES.md).

The views are plans, built once per session; no data is held. One supplier is one grid cell of a 0.05 degree grid with ten cells per latitude. Only
order-free aggregates are used, and every view covers its whole source table.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridagro.functions import point_id
from gridagro.operators.filters import apply_mask
from gridagro.operators.region import ring_edges

#: The lattice has no end: a table of more than 15,550 suppliers has rows beyond 90, so its coordinates are not degrees.
RES = 0.05
SUBDOMAINS = 7

_CULTIVARS = {2: "amber", 3: "birch", 5: "cedar", 7: "dune", 11: "ember", 13: "fern", 17: "grove", 19: "heath", 23: "iris", 26: "juniper", 29: "kelp", 31: "larch"}

VARIETIES = {f"{code}.0": name for code, name in _CULTIVARS.items()}

VARIETY_SQL = f"case 1 + k % 32 {' '.join(f'when {code} then {name!r}' for code, name in _CULTIVARS.items())} end"

SOWING_DATES = [150, 166, 290]

MODELS = ["Celsius", "Dssat", "Stics"]


@cache
def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def lat_of(k: Column) -> Column:
    return (F.lit(12225.0) + F.lit(50.0) * F.floor(k / 10)) / 1e3


def lon_of(k: Column) -> Column:
    return (F.lit(-17575.0) + F.lit(50.0) * (k % 10)) / 1e3


def _null_if(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


@cache
def cells(spark, sf) -> DataFrame:
    """k, lat, lon and the static values of each cell."""
    k, balance = F.col("s_suppkey"), F.col("s_acctbal")
    no_calendar = k % 17 == 8
    wet_end = F.least(F.lit(210) + F.lit(20) * (k % 10), F.lit(365))
    return table(spark, sf, "supplier").select(
        k.alias("k"),
        F.col("s_nationkey").alias("nation"),
        lat_of(k).alias("lat"),
        lon_of(k).alias("lon"),
        F.when(k % 7 == 3, None).when(k % 11 == 5, 0.0).otherwise(1.0).alias("mask"),
        (balance / 10).alias("dem"),
        _null_if(k % 13 == 6, 1 + k % 12).alias("Band1"),
        _null_if(no_calendar, 100 + 20 * (k % 10)).alias("planting_day"),
        _null_if(no_calendar, F.when(k % 3 == 0, 60).otherwise(wet_end)).alias("maturity_day"),
        balance.alias("balance"),
    )


@cache
def mask(spark, sf) -> DataFrame:
    return cells(spark, sf).select("lat", "lon", "mask")


@cache
def dem(spark, sf) -> DataFrame:
    return cells(spark, sf).select("lat", "lon", F.col("dem").alias("Band1"))


@cache
def soil(spark, sf) -> DataFrame:
    k, balance = F.col("k"), F.col("balance")
    return cells(spark, sf).select(
        "lat",
        "lon",
        (balance / 7).alias("SoilTotalDepth"),
        (balance / 9).alias("SoilRDepth"),
        ((k % 40) / 300).alias("Wwp"),
        ((k % 50) / 170).alias("Wfc"),
        (1 + (k % 8) / 16).alias("bd"),
        (balance / 11).alias("OrganicNStock"),
        (5 + (k % 30) / 13).alias("pH"),
        _null_if(k % 19 == 5, (k % 60) / 70).alias("OrganicC"),
        ((k % 5) / 3).alias("cf"),
        ((k % 9) / 7).alias("extp"),
        ((k % 6) / 7).alias("totp"),
        ((k % 90) / 11).alias("sand"),
        ((k % 80) / 11).alias("clay"),
        ((k % 70) / 11).alias("silt"),
        F.col("Band1").cast("double").alias("Band1"),
    )


@cache
def cube(spark, sf, among: DataFrame | None = None) -> DataFrame:
    """Daily climate, sparse: time, lat, lon and the variables under their source names.

    ``among`` is a mask whose cells alone are aggregated; all lines are read.
    """
    low, high = F.min("l_quantity"), F.max("l_quantity")
    lines = table(spark, sf, "lineitem")
    if among is not None:
        k = F.col("l_suppkey")
        lines = apply_mask(lines.withColumns({"lat": lat_of(k), "lon": lon_of(k)}), among)
    return (
        lines.groupBy(F.col("l_suppkey").alias("k"), F.to_date("l_shipdate").alias("time"))
        .agg(
            (high / 4 + 8).alias("srad"),
            (low / 5 + 15 + F.max("l_discount") * 100).alias("tmax"),
            (low / 5 + 10).alias("tmin"),
            (F.min("l_extendedprice") / 1000).alias("pr"),
            (F.max("l_tax") * 50 + 1).alias("wind"),
            (low + 40).alias("rhum"),
            (low / 5 + 6).alias("Tdewmin"),
            (low / 5 + 9).alias("Tdewmax"),
        )
        .withColumns({"lat": lat_of(F.col("k")), "lon": lon_of(F.col("k"))})
        .drop("k")
    )


@cache
def kelvin(spark, sf, name: str) -> DataFrame:
    """One temperature cube in kelvin: ``tasmax`` or ``tasmin``."""
    source = {"tasmax": "tmax", "tasmin": "tmin"}[name]
    return cube(spark, sf).select("time", "lat", "lon", (F.col(source) + 273.15).alias(name))


@cache
def calendar(spark, sf) -> DataFrame:
    return cells(spark, sf).select("lat", "lon", "planting_day", "maturity_day")


@cache
def management(spark, sf) -> DataFrame:
    """One record per brand of the part table."""
    return (
        table(spark, sf, "part")
        .groupBy("p_brand")
        .agg(
            (F.lit(100) + 5 * (F.sum("p_size") % 50)).cast("int").alias("sowingdate"),
            (F.min("p_retailprice") / 100).alias("sdens"),
            (F.sum("p_partkey") % 3).cast("int").alias("InoFertiPolicyCode"),
        )
        .select(
            F.regexp_replace("p_brand", "Brand#", "m").alias("idMangt"),
            F.col("p_brand").alias("Idcultivar"),
            "sowingdate",
            "sdens",
            F.lit("none").alias("OFertiPolicyCode"),
            "InoFertiPolicyCode",
            F.lit("none").alias("IrrigationPolicyCode"),
            F.lit("none").alias("SoilTillPolicyCode"),
        )
    )


@cache
def variety_grid(spark, sf) -> DataFrame:
    k = F.col("k")
    return cells(spark, sf).select("lat", "lon", (1 + k % 32 + F.lit(1e-9)).alias("variety"))


@cache
def sowing_grid(spark, sf) -> DataFrame:
    k = F.col("k")
    return cells(spark, sf).select("lat", "lon", (110 + k % 90 + F.lit(0.7)).alias("sowing_date"))


@cache
def raw_output(spark, sf) -> DataFrame:
    """Model results as reported: one row per cell, year and scenario ``m<m>_<option>``."""
    key, low, high = F.min("o_orderkey"), F.min("o_totalprice"), F.max("o_totalprice")
    k, ys, m = F.col("k"), F.col("time"), F.col("m")
    return (
        table(spark, sf, "orders")
        .groupBy(
            F.floor(F.col("o_custkey") / 15).alias("k"),
            F.year("o_orderdate").alias("time"),
            (F.col("o_custkey") % 3).alias("m"),
            F.substring("o_orderpriority", 1, 1).alias("option"),
        )
        .agg(key.alias("key"), low.alias("low"), high.alias("high"))
        .withColumns({"lat": lat_of(k), "lon": lon_of(k)})
        .select(
            F.element_at(F.array(*[F.lit(name) for name in MODELS]), (m + 1).cast("int")).alias("Model"),
            F.concat_ws("_", point_id(F.col("lat"), F.col("lon")), ys.cast("string"), F.concat(F.lit("m"), m), "option").alias("Idsim"),
            F.lit("").alias("Texte"),
            (ys * 1000 + 150).cast("double").alias("Planting"),
            (ys * 1000 + 157 + F.col("key") % 9).cast("double").alias("Emergence"),
            (ys * 1000 + 200 + F.col("key") % 40).cast("double").alias("Ant"),
            F.when(F.col("key") % 5 == 0, -99.0)
            .otherwise((ys + F.col("key") % 2) * 1000 + 20)
            .cast("double")
            .alias("Mat"),
            (F.col("high") / 50).alias("Biom_ma"),
            (F.col("low") / 100).alias("Yield"),
            (F.col("low") / 7).alias("GNumber"),
            (F.col("key") % 6).cast("double").alias("MaxLai"),
            F.when(F.col("key") % 4 == 0, -99.0).otherwise((F.col("key") % 30).cast("double")).alias("Nleac"),
            (F.col("key") % 11 - 3).cast("double").alias("SoilN"),
            (F.col("key") % 13).cast("double").alias("CroN_ma"),
            (F.col("high") / 900).alias("CumE"),
            (F.col("high") / 800).alias("Transp"),
            "time",
            "lat",
            "lon",
            "k",
        )
    )


@cache
def celsius_raw(spark, sf) -> DataFrame:
    """The same results under one model's own field names."""
    return raw_output(spark, sf).select(
        F.col("Idsim").alias("idsim"),
        F.col("Planting").alias("iplt"),
        F.col("Emergence").alias("JulPheno1_1"),
        F.col("Ant").alias("JulPheno1_4"),
        F.col("Mat").alias("JulPheno1_6"),
        F.col("Biom_ma").alias("Biom(nrec)"),
        F.col("Yield").alias("Grain(nrec)"),
        F.col("MaxLai").alias("LAI"),
        F.col("CumE").alias("SigmaSimEsol"),
        F.col("GNumber").alias("Ngrain"),
        F.col("SoilN").alias("stockNsol"),
        F.col("Transp").alias("SigmaCultEsol"),
    )


@cache
def parts_of_output(spark, sf) -> DataFrame:
    """Cubes of three sub-domains in which every cell occurs twice, the second time with other values."""
    k, missing = F.col("k"), F.col("MaxLai") == 0
    base = raw_output(spark, sf).select(
        F.col("Model").alias("model"),
        F.split("Idsim", "_", 4)[3].alias("scenario"),
        "time",
        "lat",
        "lon",
        "k",
        _null_if(missing, F.col("Yield")).alias("Yield"),
        F.col("Biom_ma"),
    )
    first = base.withColumn("subdomain", (k % 3).cast("int"))
    second = base.withColumns(
        {
            "subdomain": ((k + 1) % 3).cast("int"),
            "Yield": F.coalesce(F.col("Yield"), F.lit(0.0)) + 1,
            "Biom_ma": F.col("Biom_ma") + 1,
        }
    )
    return first.unionByName(second).drop("k")


@cache
def rings(spark, sf) -> DataFrame:
    """Two small regions, one with a hole, and a large triangle around the cells of each nation."""
    literal = spark.createDataFrame(
        [
            (1, 0, [(-17.56, 12.24), (-17.25, 12.26), (-17.4, 12.62)]),
            (1, 1, [(-17.45, 12.33), (-17.36, 12.33), (-17.4, 12.42)]),
            (2, 0, [(-17.3, 12.52), (-17.29, 12.52), (-17.295, 12.53)]),
        ],
        "region_id long, ring_id long, ring array<struct<lon:double,lat:double>>",
    )

    def vertex(lon: Column, lat: Column) -> Column:
        return F.struct(lon.alias("lon"), lat.alias("lat"))

    west, east, south, north = (F.col(name) for name in ("west", "east", "south", "north"))
    around = (
        cells(spark, sf)
        .groupBy("nation")
        .agg(
            F.min("lon").alias("west"),
            F.max("lon").alias("east"),
            F.min("lat").alias("south"),
            F.max("lat").alias("north"),
        )
        .select(
            (F.col("nation") + 100).cast("long").alias("region_id"),
            F.lit(0).cast("long").alias("ring_id"),
            F.array(
                vertex(west - 0.12, south - 0.06),
                vertex(east + 0.11, (south + north) / 2),
                vertex((west + east) / 2, north + 0.13),
            ).alias("ring"),
        )
    )
    return literal.unionByName(around)


@cache
def edges(spark, sf) -> DataFrame:
    return ring_edges(rings(spark, sf))


@cache
def points(spark, sf) -> DataFrame:
    """One point per customer, some half-way between cells and some outside the grid."""
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        key.alias("point"),
        ((F.lit(-17605.0) + 5 * (key % 110)) / 1e3).alias("lon"),
        ((F.lit(12200.0) + 5 * F.floor(key / 15)) / 1e3).alias("lat"),
    )


@cache
def typed_text(spark, sf) -> DataFrame:
    blank = F.col("event_id") % 10 == 0
    return table(spark, sf, "events").select(
        "event_id",
        F.when(blank, "").otherwise(F.col("value").cast("string")).alias("value"),
        F.when(blank, "").otherwise(F.col("props")).alias("props"),
        F.when(blank, "").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("ts"),
        F.when(blank, "").otherwise((F.col("event_id") % 2).cast("string")).alias("flag"),
    )
