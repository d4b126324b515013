"""One entry per operator: the Spark query and, next to it, the SQL it must agree with.

Results of transcendental functions and of sums in an engine-chosen order are rounded on both
sides.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import fixtures as fx
from checks.views import lat as lat_sql, length, lon as lon_sql, pid, rnd, with_views
from gridagro import functions as gf
from gridagro.operators import aggregates, cube as cubes, filters, nearest, partition, region
from gridagro.plans import agroclimate, inputs, management as mgmt, mosaic as mosaics, outputs, units
from gridagro.plans.prepare import Sources, prepare
from gridagro.session import scratch_path
from gridagro.sources import buckets, ledger, scan, sinks, types
from gridagro.sources.schemas import OUTPUT_VALUES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a query under its function's name."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = with_views(sql, *views)
        return f

    return register


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({name: gf.round_half_even(F.col(name), digits) for name in columns})


# ---------------------------------------------------------------- ids, codes, names


@query(f"select k, {pid()} as id_point from cells", ("cells",))
def point_id(spark, sf):
    return fx.cells(spark, sf).select("k", gf.point_id(F.col("lat"), F.col("lon")).alias("id_point"))


@query(
    "select Idsim as idsim, lat, lon, time, scenario from (select *, scenario from raw)",
    ("raw",),
)
def sim_id_parse(spark, sf):
    ids = fx.raw_output(spark, sf)
    return ids.select(F.col("Idsim").alias("idsim"), *[c.alias(n) for n, c in gf.parse_sim_id(F.col("Idsim")).items()])


@query("select Idsim as idsim from raw where scenario = 'm1_2'", ("raw",))
def in_scenario(spark, sf):
    return fx.raw_output(spark, sf).filter(gf.in_scenario(F.col("Idsim"), "m1_2")).select(F.col("Idsim").alias("idsim"))


@query(
    "select distinct model, scenario, subdomain from parts",
    ("parts",),
)
def parse_output_name(spark, sf):
    file = F.concat(
        F.lit("/out/exp_"),
        F.col("subdomain").cast("string"),
        F.lit("/"),
        F.col("model"),
        F.lit("_yearly_"),
        F.col("scenario"),
        F.lit("_"),
        F.col("subdomain").cast("string"),
        F.lit(".nc"),
    )
    names = fx.parts_of_output(spark, sf).select(file.alias("path")).distinct()
    return names.select(*[c.alias(n) for n, c in gf.parse_output_name(F.col("path")).items()])


_TEXTURE_CASE = "case Band1 " + " ".join(f"when {c} then '{n}'" for c, n in gf.TEXTURE_CLASSES.items()) + " end"


@query(f"select k, {_TEXTURE_CASE} as texture from cells", ("cells",))
def texture_names(spark, sf):
    return fx.cells(spark, sf).select("k", gf.texture_name(F.col("Band1")).alias("texture"))


@query(
    f"select lat, lon, {fx.VARIETY_SQL} as cultivar from cells",
    ("cells",),
)
def map_variety(spark, sf):
    return fx.variety_grid(spark, sf).select("lat", "lon", gf.map_variety(F.col("variety"), fx.VARIETIES).alias("cultivar"))


# ---------------------------------------------------------------- dates and numbers


@query(
    """select distinct time, strftime(time, '%Y-%m-%d') as w_date, cast(year(time) as int) as year,
      cast(dayofyear(time) as int) as "DOY", cast(month(time) as int) as "Nmonth", cast(day(time) as int) as "NdayM"
    from cube""",
    ("cube",),
)
def calendar_parts(spark, sf):
    days = fx.cube(spark, sf).select("time").distinct()
    return days.withColumns(gf.calendar_parts(gf.to_day(F.col("time"))))


def _window_sql(strict: bool) -> str:
    limit = "365" if strict else length("year")
    last = "sowingdate + 200"
    return f"""
    select idPoint as id_point, idMangt as id_mangt, year, greatest(1, sowingdate - 30) as start_day,
      cast(case when {last} > {limit} then year + 1 else year end as int) as end_year,
      cast(case when {last} > {limit} then {last} - {length('year')} else {last} end as int) as end_day
    from years, management"""


def _windows(spark, sf, strict):
    # The dates of a window depend on year and sowing date only; the join is the unit table's own.
    table = units.build_sim_units(
        _years(spark, sf), _all_points(spark, sf), fx.management(spark, sf), [1], strict=strict
    )
    return table.select(
        F.col("idPoint").alias("id_point"),
        F.col("idMangt").alias("id_mangt"),
        F.col("StartYear").alias("year"),
        F.col("StartDay").alias("start_day"),
        F.col("EndYear").alias("end_year"),
        F.col("EndDay").alias("end_day"),
    )


def _years(spark, sf):
    return aggregates.coordinate_years(_climate(spark, sf))


def _all_points(spark, sf):
    return fx.cells(spark, sf).select(gf.point_id(F.col("lat"), F.col("lon")).alias("IdSoil"))


@query(_window_sql(False), ("years", "management"))
def sowing_windows(spark, sf):
    return _windows(spark, sf, False)


@query(_window_sql(True), ("years", "management"))
def sowing_windows_strict(spark, sf):
    return _windows(spark, sf, True)


def _doy_sql(strict: bool) -> str:
    year = "floor(Mat / 1000)"
    size = length("cast(floor(Mat / 1000) as int)") if strict else length("time")
    return f"""select Idsim as idsim, case when Mat > 0 then Mat % 1000 + case when {year} > time then {size} else 0 end end as day
    from raw"""


def _doy(spark, sf, strict):
    raw = filters.null_sentinel(fx.raw_output(spark, sf), columns=["Mat"])
    return raw.select(F.col("Idsim").alias("idsim"), gf.doy_from_sim_year(F.col("Mat"), F.col("time"), strict).alias("day"))


@query(_doy_sql(False), ("raw",))
def doy_from_sim_year(spark, sf):
    return _doy(spark, sf, False)


@query(_doy_sql(True), ("raw",))
def doy_from_sim_year_strict(spark, sf):
    return _doy(spark, sf, True)


@query(
    f"""select k, {rnd('balance / 7', 3)} as half_even, cast(trunc(dem) as int) as truncated,
      balance / 1000 as tonnes, cast(balance as float) as single from cells""",
    ("cells",),
)
def numbers(spark, sf):
    c = F.col("balance")
    return fx.cells(spark, sf).select(
        "k",
        gf.round_half_even(c / 7, 3).alias("half_even"),
        gf.trunc_int(F.col("dem")).alias("truncated"),
        gf.kg_to_t(c).alias("tonnes"),
        gf.as_float(c).alias("single"),
    )


# ---------------------------------------------------------------- masks and regions


@query("select lat, lon, mask from cells where lat between 12.3e0 and 13.1e0 and lon between -17.5e0 and -17.2e0", ("cells",))
def clip_bbox(spark, sf):
    return filters.clip_bbox(fx.mask(spark, sf), -17.5, 12.3, -17.2, 13.1)


@query("select region_id, lat, lon from touched", ("touched",))
def region_cells_touched(spark, sf):
    return region.region_cells(fx.mask(spark, sf), fx.edges(spark, sf), fx.RES)


@query("select region_id, lat, lon from centre", ("centre",))
def region_cells_centre(spark, sf):
    return region.region_cells(fx.mask(spark, sf), fx.edges(spark, sf), fx.RES, all_touched=False)


@query(
    "select time, c.lat, c.lon, tmax from cube c where exists (select 1 from touched t where t.lat = c.lat and t.lon = c.lon)",
    ("cube", "touched"),
)
def clip_polygon_touched(spark, sf):
    daily, edges = fx.cube(spark, sf).select("time", "lat", "lon", "tmax"), fx.edges(spark, sf)
    near = filters.clip_bbox(daily, *region.envelope(edges, fx.RES))
    return region.clip_polygon(near, edges, fx.RES, grid=fx.mask(spark, sf))


@query(
    "select c.lat, c.lon, mask from cells c where exists (select 1 from centre t where t.lat = c.lat and t.lon = c.lon)",
    ("cells", "centre"),
)
def clip_polygon_centre(spark, sf):
    return region.clip_polygon(fx.mask(spark, sf), fx.edges(spark, sf), fx.RES, all_touched=False)


@query(
    "select time, u.lat, u.lon, tmin from cube u join cells c on c.lat = u.lat and c.lon = u.lon where mask = 1",
    ("cube", "cells"),
)
def apply_mask(spark, sf):
    daily = fx.cube(spark, sf).select("time", "lat", "lon", "tmin")
    return filters.apply_mask(daily, fx.mask(spark, sf))


@query("select lat, lon, 1e0 as mask from cells", ("cells",))
def unit_mask(spark, sf):
    return filters.unit_mask(fx.mask(spark, sf))


@query("select lat, lon, mask from valid", ("valid",))
def valid_cells(spark, sf):
    return filters.valid_cells(fx.mask(spark, sf), fx.soil(spark, sf))


@query("select lat, lon, mask from valid where mask = 1", ("valid",))
def crop_cells(spark, sf):
    return _cells(spark, sf)


@query("select count(mask) as n_cells from valid", ("valid",))
def count_cells(spark, sf):
    return filters.count_cells(filters.valid_cells(fx.mask(spark, sf), fx.soil(spark, sf)))


@query("select lat, lon, OrganicC as \"OrganicC\" from soilgrid where OrganicC is not null", ("soilgrid",))
def drop_incomplete(spark, sf):
    return filters.drop_incomplete(fx.soil(spark, sf).select("lat", "lon", "OrganicC"))


@query("select time, lat, lon, pr from cube where year(time) between 1996 and 1998", ("cube",))
def filter_years(spark, sf):
    return filters.filter_years(fx.cube(spark, sf).select("time", "lat", "lon", "pr"), 1996, 1998)


def _blocks_sql(n: int, ranked: str) -> str:
    return f"""select lat, lon, mask, cast(block - 1 as int) as subdomain
    from (select *, ntile({n}) over (order by lat, lon) as block from valid where {ranked}) where mask = 1"""


@query(_blocks_sql(fx.SUBDOMAINS, "mask = 1"), ("valid",))
def assign_subdomain(spark, sf):
    return inputs.valid_subdomains(fx.mask(spark, sf), fx.soil(spark, sf), fx.SUBDOMAINS, degrees=False)


@query(_blocks_sql(fx.SUBDOMAINS, "mask is not null"), ("valid",))
def assign_subdomain_strict(spark, sf):
    return inputs.valid_subdomains(fx.mask(spark, sf), fx.soil(spark, sf), fx.SUBDOMAINS, strict=True, degrees=False)


@query(
    f"select * from ({_blocks_sql(fx.SUBDOMAINS, 'mask = 1')}) where subdomain = 2",
    ("valid",),
)
def take_subdomain(spark, sf):
    blocks = inputs.valid_subdomains(fx.mask(spark, sf), fx.soil(spark, sf), fx.SUBDOMAINS, degrees=False)
    return partition.take_subdomain(blocks, 2)


@query("select lat, lon, mask from cells", ("cells",))
def row_major(spark, sf):
    return cubes.row_major(fx.mask(spark, sf))


@query("select point, lon, lat, cell_lat, cell_lon from nearest", ("nearest",))
def nearest_cells(spark, sf):
    return nearest.nearest_cells(fx.points(spark, sf), fx.mask(spark, sf), fx.RES, degrees=False)


@query(
    "select c.lat, c.lon, mask from nearest n join cells c on c.lat = n.cell_lat and c.lon = n.cell_lon",
    ("nearest", "cells"),
)
def select_nearest(spark, sf):
    return nearest.select_nearest(fx.mask(spark, sf), fx.points(spark, sf), fx.RES, degrees=False)


# ---------------------------------------------------------------- cubes


@query(
    "select time, lat, lon, tmax, tmin, case when wind > 2 then wind end as wind from cube where wind > 2",
    ("cube",),
)
def align_variables(spark, sf):
    daily = fx.cube(spark, sf)
    keys = ["time", "lat", "lon"]
    windy = daily.select(*keys, F.when(F.col("wind") > 2, F.col("wind")).alias("wind"))
    return cubes.align_variables([daily.select(*keys, "tmax"), daily.select(*keys, "tmin"), windy])


def _bucketed(spark, parts):
    """Names of catalog tables that hold the parts in buckets."""
    names = []
    for part in parts:
        path = scratch_path(spark, "bucketed")
        names.append("cube_" + path.rsplit("-", 1)[1])
        buckets.save_bucketed(part, names[-1], path, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return names


@query(
    "select time, lat, lon, tmax, tmin, case when wind > 2 then wind end as wind from cube where wind > 2 and year(time) between 1993 and 1997",
    ("cube",),
)
def align_bucketed(spark, sf):
    """Variables stored in buckets once, aligned for some years without a shuffle."""
    daily = sinks.stored(fx.cube(spark, sf), "cube")
    windy = daily.select("time", "lat", "lon", F.when(F.col("wind") > 2, F.col("wind")).alias("wind"))
    names = _bucketed(spark, [daily.select("time", "lat", "lon", "tmax"), daily.select("time", "lat", "lon", "tmin"), windy])
    return buckets.align_bucketed(spark, names, 1993, 1997)


@query(
    """select time, lat, lon, tmax, case when wind > 2 then wind else rhum end as wind, case when year(time) < 1998 then pr end as pr
    from cube""",
    ("cube",),
)
def combine_by_coords(spark, sf):
    daily = fx.cube(spark, sf)
    keys = ["time", "lat", "lon"]
    windy = daily.select(*keys, F.when(F.col("wind") > 2, F.col("wind")).alias("wind"))
    spare = daily.select(*keys, "tmax", F.col("rhum").alias("wind"))
    early = daily.filter(F.year("time") < 1998).select(*keys, "pr")
    return cubes.combine_by_coords([windy, spare, early])


@query("select distinct lat, lon from cube where time = (select min(time) from cube)", ("cube",))
def reference_grid(spark, sf):
    return cubes.reference_grid(fx.cube(spark, sf))


@query(
    """select time, u.lat, u.lon, tmin, dem as "Band1", cast(dayofyear(time) as int) as "DOY"
    from cube u join cells c on c.lat = u.lat and c.lon = u.lon""",
    ("cube", "cells"),
)
def with_static(spark, sf):
    return cubes.with_static(fx.cube(spark, sf).select("time", "lat", "lon", "tmin"), fx.dem(spark, sf))


@query(
    """select model, scenario, time, c.lat, c.lon, m.Yield as "Yield"
    from (select distinct model, scenario, time from merged) s cross join cells c
    left join merged m using (model, scenario, time, lat, lon)""",
    ("merged", "cells"),
)
def reindex_grid(spark, sf):
    merged = _merged(spark, sf).drop("Biom_ma")
    return cubes.reindex(merged, fx.mask(spark, sf).select("lat", "lon"))


@query(
    """select variable, cast(year(time) as int) as year, time, lat, lon, value from
    (unpivot (select time, lat, lon, tmax, tmin, pr from cube) on tmax, tmin, pr into name variable value value)""",
    ("cube",),
)
def split_by_year(spark, sf):
    return sinks.split_by_year(fx.cube(spark, sf), ["tmax", "tmin", "pr"])


# ---------------------------------------------------------------- input tables


def _cells(spark, sf):
    return filters.crop_cells(fx.mask(spark, sf), fx.soil(spark, sf))


def _climate(spark, sf):
    return inputs.climate_table(fx.cube(spark, sf), _cells(spark, sf))


def _coordinates(spark, sf):
    return inputs.coordinates_table(fx.dem(spark, sf), fx.mask(spark, sf))


_CLIMATE_SQL = """select idPoint, w_date, year, DOY as "DOY", Nmonth as "Nmonth", NdayM as "NdayM", srad, tmax, tmin, tmoy,
  rain, wind, rhum, Etppm as "Etppm", Tdewmin as "Tdewmin", Tdewmax as "Tdewmax", Surfpress as "Surfpress" from climate"""


@query(_CLIMATE_SQL, ("climate",))
def climate_table(spark, sf):
    return _climate(spark, sf)


@query("select * from coords", ("coords",))
def coordinates_table(spark, sf):
    return _coordinates(spark, sf)


@query('select *, \'\' as "SourceW", \'\' as "SourceRain", \'\' as "Comment", \'\' as ev from coords', ("coords",))
def coordinates_table_legacy(spark, sf):
    return inputs.coordinates_table(fx.dem(spark, sf), fx.mask(spark, sf), legacy=True)


def _soil_sql(texture: str) -> str:
    three = ", ".join(
        f'{rnd(n, 3)} as "{n}"'
        for n in ("SoilTotalDepth", "SoilRDepth", "Wwp", "Wfc", "bd", "OrganicNStock", "pH", "OrganicC", "cf", "extp")
    )
    rest = ", ".join(f'{rnd(n, 3)} as "{n}"' for n in ("sand", "clay", "silt"))
    return f"""select {pid()} as "IdSoil", {three}, -99e0 as totp, {rest}, {texture} as "SoilTextureType",
      'simple' as "SoilOption", cast(null as varchar) as "Slope", 1 as "RunoffType", 0.3e0 as albedo
    from soilgrid where OrganicC is not null and Band1 is not null and mask = 1"""


@query(_soil_sql(_TEXTURE_CASE), ("soilgrid",))
def soil_table(spark, sf):
    return inputs.soil_table(fx.soil(spark, sf), _cells(spark, sf))


@query(_soil_sql("'Loamy Sand'"), ("soilgrid",))
def soil_table_fixed_texture(spark, sf):
    return inputs.soil_table(fx.soil(spark, sf), _cells(spark, sf), texture="Loamy Sand")


@query(
    f"""select s."IdSoil", s.pH as "pH", s.albedo, t.texture as "SoilTextureType"
    from ({_soil_sql("'x'")}) s join (select {pid()} as id, case 13 - Band1 {_TEXTURE_CASE.removeprefix('case Band1 ')} as texture
      from cells where Band1 is not null and mask is not null) t on t.id = s."IdSoil" """,
    ("soilgrid", "cells"),
)
def replace_texture(spark, sf):
    table = inputs.soil_table(fx.soil(spark, sf), _cells(spark, sf), texture="x")
    grid = fx.cells(spark, sf).select("lat", "lon", (13 - F.col("Band1")).alias("Band1"))
    replaced = inputs.replace_texture(table, grid, fx.mask(spark, sf))
    return replaced.select("IdSoil", "pH", "albedo", "SoilTextureType")


@query(
    """select idPoint as "IdDClim", idPoint || '.' || year || '.' || DOY as idjourclim, year as annee, DOY as jda,
      Nmonth as mois, NdayM as jour, tmax, tmin, tmoy, srad as rg, rain as plu, Etppm as "Etp" from climate""",
    ("climate",),
)
def model_weather(spark, sf):
    return inputs.model_weather(_climate(spark, sf))


@query(
    """select event_id, case when event_id % 10 = 0 then null else value end as value,
      case when event_id % 10 = 0 then '' else props end as props,
      case when event_id % 10 = 0 then null else date_trunc('second', ts) end as ts,
      case when event_id % 10 = 0 then null else event_id % 2 = 1 end as flag from events""",
)
def declared_types(spark, sf):
    declared = {"value": "REAL", "props": "varchar(20)", "ts": "datetime", "flag": "bit"}
    typed = types.apply_declared_types(fx.typed_text(spark, sf), declared)
    return typed.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# ---------------------------------------------------------------- agro-climate


_PI = f"{math.pi!r}e0"


def _ra_sql(doy: str, latitude: str, guard: bool) -> str:
    turn = f"(2 * {_PI} * {doy} / 365)"
    dec = f"(0.409e0 * sin({turn} - 1.39e0))"
    phi = f"radians({latitude})"
    t = f"(tan({phi}) * tan({dec}))"
    inside = f"(case when 1 - {t} * {t} <= 0 then 1e-5 else 1 - {t} * {t} end)"
    # acos fails outside [-1, 1] in SQL, hence the case.
    sunset = f"(2 * atan(1e0) - atan(-{t} / sqrt({inside})))" if guard else f"(case when abs({t}) <= 1 then acos(-{t}) end)"
    return f"""(24 * 60 / {_PI} * 0.082e0 * (1 + 0.033e0 * cos({turn}))
      * ({sunset} * sin({phi}) * sin({dec}) + cos({phi}) * cos({dec}) * sin({sunset})))"""


def _e_sql(t: str) -> str:
    return f"(0.6108e0 * exp(17.27e0 * {t} / ({t} + 237.3e0)))"


def _et_sql(vapour: str, alt: str, radiation: str, low: bool) -> str:
    es = f"(({_e_sql('tmin')} + {_e_sql('tmax')}) / 2)"
    gamma = f"(0.000665e0 * 101.3e0 * pow((293 - 0.0065e0 * {alt}) / 293, 5.26e0))"
    delta = f"(4098 * {_e_sql('tmoy')} / pow(tmoy + 237.3e0, 2))"
    ratio = f"(srad / nullif((0.75e0 + 2e-5 * {alt}) * {radiation}, 0))"
    ratio = f"(case when {ratio} > 1 then 1e0 when {ratio} < 0 and {str(low).lower()} then 0e0 else {ratio} end)"
    rnl = f"""(4.903e-9 * (pow(tmin + 273.16e0, 4) + pow(tmax + 273.16e0, 4)) / 2
      * (1.35e0 * {ratio} - 0.35e0) * (0.34e0 - 0.14e0 * sqrt({vapour})))"""
    return f"""((0.408e0 * {delta} * (0.77e0 * srad - {rnl}) + {gamma} * 900 * wind * ({es} - {vapour}) / (tmoy + 273))
      / ({delta} + {gamma} * (1 + 0.34e0 * wind)))"""


def _climate_et_sql(vapour: str) -> str:
    et = _et_sql(vapour, "altitude", _ra_sql("DOY", "latitudeDD", False), True)
    return f"""select idPoint, w_date, {rnd(et, 4)} as "Etppm"
    from climate left join coords using (idPoint)"""


_TDEW = f"(({_e_sql('Tdewmax')} + {_e_sql('Tdewmin')}) / 2)"
_RHUM = f"(rhum * (({_e_sql('tmin')} + {_e_sql('tmax')}) / 2) / 100)"


def _et(spark, sf, method):
    climate = agroclimate.with_reference_et(_climate(spark, sf), _coordinates(spark, sf), method)
    return rounded(climate.select("idPoint", "w_date", "Etppm"), 4, "Etppm")


@query(_climate_et_sql(_TDEW), ("climate", "coords"))
def et0_tdew(spark, sf):
    return _et(spark, sf, "tdew")


@query(_climate_et_sql(_RHUM), ("climate", "coords"))
def et0_rhum(spark, sf):
    return _et(spark, sf, "rhum")


@query(
    "select idPoint, w_date, tmin, latitudeDD as latitude, altitude from climate left join coords using (idPoint)",
    ("climate", "coords"),
)
def with_coordinates(spark, sf):
    climate = _climate(spark, sf).select("idPoint", "w_date", "tmin")
    return agroclimate.with_coordinates(climate, _coordinates(spark, sf))


# Latitudes of the fixture grid are tropical, so they are stretched to reach the poles.
_POLAR = "((lat - 12.225e0) * 300 - 88)"


def _ra(spark, sf, guard):
    latitude = (F.col("lat") - 12.225) * 300 - 88
    days = fx.cube(spark, sf).select("time", "lat", "lon")
    value = gf.ra(latitude, F.dayofyear("time"), guard)
    return rounded(days.withColumn("ra", F.when(latitude < 89, value)), 4, "ra")


def _ra_query(guard: bool) -> str:
    value = _ra_sql("dayofyear(time)", _POLAR, guard)
    return f"select time, lat, lon, case when {_POLAR} < 89 then {rnd(value, 4)} end as ra from cube"


@query(_ra_query(False), ("cube",))
def ra_acos(spark, sf):
    return _ra(spark, sf, False)


@query(_ra_query(True), ("cube",))
def ra_guarded(spark, sf):
    return _ra(spark, sf, True)


@query(
    f"""select time, lat, lon, {rnd(_et_sql(_TDEW, 'dem', _ra_sql('dayofyear(time)', 'lat', True), False), 4)} as etp
    from (select u.*, (tmin + tmax) / 2 as tmoy, dem from cube u join cells c on c.lat = u.lat and c.lon = u.lon)""",
    ("cube", "cells"),
)
def gridded_et(spark, sf):
    daily = fx.cube(spark, sf).withColumn("tmoy", gf.tmean(F.col("tmin"), F.col("tmax")))
    return rounded(agroclimate.gridded_reference_et(daily, fx.dem(spark, sf)), 4, "etp")


_THERMAL_SQL = f"""select cast(y as int) as ref_year, lat, lon, {rnd('sum(degree)', 4)} as gdd from (
      select y, c.lat, c.lon, case when
        (maturity_day >= planting_day and year(time) = y and dayofyear(time) between planting_day and maturity_day)
        or (maturity_day < planting_day and ((year(time) = y and dayofyear(time) >= planting_day)
          or (year(time) = y + 1 and dayofyear(time) <= maturity_day)))
        then greatest((tmin + 273.15e0 + tmax + 273.15e0) / 2 - 273.15e0 - 8, 0) else 0 end as degree
      from cube u join cells c on c.lat = u.lat and c.lon = u.lon, generate_series(1995, 2000) g(y))
    group by y, lat, lon"""


@query(_THERMAL_SQL, ("cube", "cells"))
def thermal_time(spark, sf):
    tmax, tmin = fx.kelvin(spark, sf, "tasmax"), fx.kelvin(spark, sf, "tasmin")
    return rounded(agroclimate.thermal_time(tmax, tmin, fx.calendar(spark, sf), 1995, 2000), 4, "gdd")


@query(_THERMAL_SQL, ("cube", "cells"))
def thermal_time_side_by_side(spark, sf):
    """The same from a cube that stores both temperatures."""
    both = fx.cube(spark, sf).select(
        "time", "lat", "lon", (F.col("tmax") + 273.15).alias("tasmax"), (F.col("tmin") + 273.15).alias("tasmin")
    )
    return rounded(agroclimate.thermal_time(both, None, fx.calendar(spark, sf), 1995, 2000), 4, "gdd")


# ---------------------------------------------------------------- management and units


def _grids(spark, sf):
    keys = ["lat", "lon"]
    return cubes.combine_by_coords([fx.variety_grid(spark, sf), fx.sowing_grid(spark, sf)], keys)


_SPATIAL_COLUMNS = [
    "idMangt",
    "Idcultivar",
    "sowingdate",
    "sdens",
    "InoFertiPolicyCode",
    "idPoint",
    "oldid",
    "lat",
    "lon",
]


def _spatial(spark, sf):
    return mgmt.management_table(fx.management(spark, sf), _grids(spark, sf), varieties=fx.VARIETIES)


@query(
    'select idMangt, Idcultivar as "Idcultivar", sowingdate, sdens, InoFertiPolicyCode as "InoFertiPolicyCode", idPoint, oldid, lat, lon from spatial',
    ("spatial",),
)
def spatialise_management(spark, sf):
    crossed = mgmt.spatialise_management(fx.management(spark, sf), _grids(spark, sf), fx.VARIETIES)
    return crossed.select(*_SPATIAL_COLUMNS)


@query(
    f"""select idMangt || '_' || d as idMangt, Idcultivar as "Idcultivar", sdens, d as sowingdate
    from management, (values {', '.join(f'({d})' for d in fx.SOWING_DATES)}) t(d)""",
    ("management",),
)
def expand_sowing(spark, sf):
    sown = mgmt.expand_sowing(fx.management(spark, sf), fx.SOWING_DATES)
    return sown.select("idMangt", "Idcultivar", "sdens", "sowingdate")


@query("select idMangt, sowingdate from management where Idcultivar in ('Brand#4', 'Brand#23')", ("management",))
def filter_cultivars(spark, sf):
    kept = filters.filter_in(fx.management(spark, sf), "Idcultivar", ["Brand#4", "Brand#23"])
    return kept.select("idMangt", "sowingdate")


@query("select idMangt, sowingdate from management where InoFertiPolicyCode in (0, 2)", ("management",))
def filter_fertiliser(spark, sf):
    kept = filters.filter_in(fx.management(spark, sf), "InoFertiPolicyCode", ["0", "2"])
    return kept.select("idMangt", "sowingdate")


@query(
    f"""select idMangt || '_' || d as idMangt, oldid || '_' || d as oldid, Idcultivar as "Idcultivar", d as sowingdate, idPoint
    from spatial, (values {', '.join(f'({d})' for d in fx.SOWING_DATES)}) t(d) where InoFertiPolicyCode in (0, 1)""",
    ("spatial",),
)
def management_table(spark, sf):
    table = mgmt.management_table(
        fx.management(spark, sf),
        _grids(spark, sf),
        dates=fx.SOWING_DATES,
        cultivars=["not applied, varieties are gridded"],
        fertiliser=[0, 1],
        varieties=fx.VARIETIES,
    )
    return table.select("idMangt", "oldid", "Idcultivar", "sowingdate", "idPoint")


@query("select idPoint, year from years", ("years",))
def coordinate_years(spark, sf):
    return aggregates.coordinate_years(_climate(spark, sf))


def _units_sql(source: str, label: str, on: str, window: str, where: str = "true") -> str:
    return f"""select idOption, y.idPoint, m.idMangt, s.IdSoil as "IdSoil", y.year as "StartYear", {window}, 1 as idIni,
      y.idPoint || '_' || y.year || '_' || m.{label} || '_' || idOption as idsim
    from years y join soils s on s.IdSoil = y.idPoint join {source} m on {on} cross join options where {where}"""


_LAST = "(m.sowingdate + 200)"
_FOLLOWING = f"""greatest(1, m.sowingdate - 30) as "StartDay",
  cast(case when {_LAST} > {length('y.year')} then y.year + 1 else y.year end as int) as "EndYear",
  cast(case when {_LAST} > {length('y.year')} then {_LAST} - {length('y.year')} else {_LAST} end as int) as "EndDay" """
_FIXED = '300 as "StartDay", cast(y.year + 1 as int) as "EndYear", 100 as "EndDay"'
_FIXED_STRICT = '130 as "StartDay", cast(y.year + 1 as int) as "EndYear", 290 as "EndDay"'
_RULE = "(idOption in (1, 3) or m.InoFertiPolicyCode = 0)"
_UNIT_VIEWS = ("years", "soils", "options")


def _soil(spark, sf):
    return inputs.soil_table(fx.soil(spark, sf), _cells(spark, sf))


def _units_global(spark, sf, climate=None, **window):
    climate = _climate(spark, sf) if climate is None else climate
    return units.build_sim_units(
        aggregates.coordinate_years(climate), _soil(spark, sf), fx.management(spark, sf), [1, 2, 3, 4], **window
    )


@query(_units_sql("management", "idMangt", "true", _FOLLOWING), (*_UNIT_VIEWS, "management"))
def sim_units_global(spark, sf):
    return _units_global(spark, sf)


@query(_units_sql("spatial", "oldid", "m.idPoint = y.idPoint", _FOLLOWING), (*_UNIT_VIEWS, "spatial"))
def sim_units_spatial(spark, sf):
    years = aggregates.coordinate_years(_climate(spark, sf))
    return units.build_sim_units(years, _soil(spark, sf), _spatial(spark, sf), [1, 2, 3, 4], mode="grid")


@query(_units_sql("management", "idMangt", "true", _FIXED), (*_UNIT_VIEWS, "management"))
def sim_units_fixed_window(spark, sf):
    return _units_global(spark, sf, mode="model", start=300, end=100)


@query(_units_sql("management", "idMangt", "true", _FIXED_STRICT), (*_UNIT_VIEWS, "management"))
def sim_units_fixed_window_strict(spark, sf):
    return _units_global(spark, sf, mode="model", start=130, end=290, strict=True)


@query(_units_sql("management", "idMangt", "true", _FOLLOWING, _RULE), (*_UNIT_VIEWS, "management"))
def drop_fertilised(spark, sf):
    return filters.drop_fertilised(_units_global(spark, sf), fx.management(spark, sf))


@query(_units_sql("spatial", "oldid", "m.idPoint = y.idPoint", _FOLLOWING, _RULE), (*_UNIT_VIEWS, "spatial"))
def sim_units(spark, sf):
    return units.order_units(
        units.sim_units(_climate(spark, sf), _soil(spark, sf), _spatial(spark, sf), [1, 2, 3, 4], mode="grid")
    )


@query(
    f"""select idPoint, idMangt, "IdSoil", "StartYear", idOption, min(idsim) as idsim
    from ({_units_sql("management", "idMangt", "true", _FOLLOWING)}) group by all""",
    (*_UNIT_VIEWS, "management"),
)
def dedupe_units(spark, sf):
    once = _units_global(spark, sf)
    unique = units.dedupe_units(once.unionByName(once))
    return unique.select("idPoint", "idMangt", "IdSoil", "StartYear", "idOption", "idsim")


def _season_sql() -> str:
    first = 'make_date("StartYear", 1, 1) + cast("StartDay" - 1 as int)'
    last = 'make_date("EndYear", 1, 1) + cast("EndDay" - 1 as int)'
    return f"""select idsim, u.idPoint, count(c.w_date) as n_days, {rnd('sum(rain)', 6)} as rain, {rnd('sum(et)', 6)} as "Etppm",
      {rnd('avg(tmin)', 8)} as tmin, {rnd('avg(tmax)', 8)} as tmax, {rnd('avg(tmoy)', 8)} as tmoy
    from ({_units_sql("management", "idMangt", "true", _FOLLOWING)}) u
    left join (select *, cast(w_date as date) as d, tmax / 2 as et from climate) c
      on c.idPoint = u.idPoint and d between {first} and {last}
    group by idsim, u.idPoint"""


@query(_season_sql(), (*_UNIT_VIEWS, "management"))
def season_climate(spark, sf):
    cells = _cells(spark, sf)
    daily = inputs.climate_table(fx.cube(spark, sf, cells), cells).withColumn("Etppm", F.col("tmax") / 2)
    climate = sinks.stored(daily.select("idPoint", "w_date", "year", "rain", "Etppm", "tmin", "tmax", "tmoy"), "climate")
    simulated = _units_global(spark, sf, climate).select("idsim", "idPoint", "StartYear", "StartDay", "EndYear", "EndDay")
    seasonal = units.season_climate(sinks.stored(simulated, "units"), climate)
    return rounded(rounded(seasonal, 8, "tmin", "tmax", "tmoy"), 6, "rain", "Etppm")


def _run(spark, sf, cube=None, texture_grid=None, **changes):
    sources = Sources(
        mask=fx.mask(spark, sf),
        soil=fx.soil(spark, sf),
        dem=fx.dem(spark, sf),
        cube=fx.cube(spark, sf) if cube is None else cube,
        management=fx.management(spark, sf),
        grids=_grids(spark, sf),
        texture=texture_grid,
    )
    settings = {"options": [1, 2, 3, 4], "first": 1996, "last": 1999, "varieties": fx.VARIETIES, "mode": "grid", "degrees": False}
    return prepare(sources, **{**settings, **changes})


_IN_YEARS = '"StartYear" between 1996 and 1999'


@query(f"""select * from ({_units_sql("spatial", "oldid", "m.idPoint = y.idPoint", _FOLLOWING, _RULE)}) where {_IN_YEARS}""", (*_UNIT_VIEWS, "spatial"))
def prepare_units(spark, sf):
    """The unit table of a whole run, from the gridded sources."""
    return _run(spark, sf).units


@query(
    f"""select idPoint as "IdDClim", idPoint || '.' || year || '.' || DOY as idjourclim, year as annee, DOY as jda, Nmonth as mois, NdayM as jour,
      tmax, tmin, tmoy, srad as rg, rain as plu, et as "Etp" from
    (select *, {rnd(_et_sql(_TDEW, "altitude", _ra_sql("DOY", "latitudeDD", False), True), 4)} as et
      from climate left join coords using (idPoint)) where year between 1996 and 1999""",
    ("climate", "coords"),
)
def prepare_weather(spark, sf):
    """The weather table of a whole run, reference evapotranspiration included."""
    weather = inputs.model_weather(_run(spark, sf, subdomains=fx.SUBDOMAINS).climate)
    return rounded(weather, 4, "Etp")


@query(ORACLE["prepare_weather"])
def prepare_from_variables(spark, sf):
    """The same from a cube that is stored with one table per variable, in another order."""
    daily = fx.cube(spark, sf)
    keys = ["time", "lat", "lon"]
    parts = [daily.select(*keys, name) for name in sorted(set(daily.columns) - set(keys))]
    return rounded(inputs.model_weather(_run(spark, sf, cube=parts).climate), 4, "Etp")


@query(ORACLE["soil_table"])
def prepare_soil(spark, sf):
    """The soil table of a whole run."""
    return _run(spark, sf).soil


@query(
    f"""select s."IdSoil", s.pH as "pH", s.albedo, t.texture as "SoilTextureType"
    from ({_soil_sql("'x'")}) s join (select {pid()} as id, case 13 - Band1 {_TEXTURE_CASE.removeprefix('case Band1 ')} as texture
      from cells where Band1 is not null) t on t.id = s."IdSoil" """,
    ("soilgrid", "cells"),
)
def prepare_soil_with_texture(spark, sf):
    """The soil table of a run with a texture grid of its own."""
    grid = fx.cells(spark, sf).select("lat", "lon", (13 - F.col("Band1")).alias("Band1"))
    return _run(spark, sf, texture_grid=grid).soil.select("IdSoil", "pH", "albedo", "SoilTextureType")


@query(ORACLE["assign_subdomain"])
def prepare_cells(spark, sf):
    """The cells of a whole run with their sub-domains."""
    return _run(spark, sf, subdomains=fx.SUBDOMAINS).cells


@query(
    f"""select idMangt, oldid, Idcultivar as "Idcultivar", sowingdate, sdens, InoFertiPolicyCode as "InoFertiPolicyCode", idPoint
    from spatial where idPoint in (select {pid()} from valid where mask = 1)""",
    ("spatial", "valid"),
)
def prepare_management(spark, sf):
    """The management of a whole run: every record at every valid cell."""
    return _run(spark, sf).management.select("idMangt", "oldid", "Idcultivar", "sowingdate", "sdens", "InoFertiPolicyCode", "idPoint")


@query(
    f"""select "IdSoil", pH as "pH" from ({_soil_sql("'x'")}) join cells on {pid()} = "IdSoil"
    where lon between -17.5 and -17.2 and lat <= 12.5""",
    ("soilgrid", "cells"),
)
def prepare_in_box(spark, sf):
    """The soil table of a run in a bounding box."""
    return _run(spark, sf, box=(-17.5, 0.0, -17.2, 12.5)).soil.select("IdSoil", "pH")


@query(
    f"""select cast(trunc({rnd('dem', 4)}) as int) as altitude, cell_lat as "latitudeDD", cell_lon as "longitudeDD", {pid('cell_lat', 'cell_lon')} as "idPoint"
    from (select distinct cell_lat, cell_lon from nearest) n join cells c on c.lat = n.cell_lat and c.lon = n.cell_lon""",
    ("nearest", "cells"),
)
def prepare_at_points(spark, sf):
    """The coordinates of a run at single points."""
    run = _run(spark, sf, points=fx.points(spark, sf), res=fx.RES)
    return run.coordinates.select("altitude", "latitudeDD", "longitudeDD", "idPoint")


# ---------------------------------------------------------------- model outputs


_VALUES = ", ".join(f'{name} as "{name}"' for name in OUTPUT_VALUES)
_OUT_KEYS = 'Idsim as "Idsim", Texte as "Texte", scenario, time, lat, lon'


@query(
    f"""select 'Celsius' as "Model", {_OUT_KEYS}, {_VALUES.replace('Nleac as', 'cast(null as double) as').replace('CroN_ma as', 'cast(null as double) as')}
    from raw""",
    ("raw",),
)
def normalise_celsius(spark, sf):
    return outputs.normalise_celsius(fx.celsius_raw(spark, sf))


@query(f'select \'Dssat\' as "Model", {_OUT_KEYS}, {_VALUES} from dssat', ("dssat",))
def normalise_dssat(spark, sf):
    return outputs.normalise_dssat(fx.raw_output(spark, sf))


@query(f'select \'Stics\' as "Model", {_OUT_KEYS}, {_VALUES} from raw', ("raw",))
def normalise_stics(spark, sf):
    return outputs.normalise_stics(fx.raw_output(spark, sf))


@query(
    'select Idsim as "Idsim", case when Nleac <> -99 then Nleac end as "Nleac", case when SoilN >= 0 then SoilN end as "SoilN" from raw',
    ("raw",),
)
def null_sentinel_negative(spark, sf):
    raw = fx.raw_output(spark, sf).select("Idsim", "Nleac", "SoilN")
    return filters.null_negative(filters.null_sentinel(raw), ["SoilN"])


def _own(spark, sf, model):
    """The normalised results that belong to one model."""
    raw = fx.raw_output(spark, sf).filter(F.col("Model") == model)
    return outputs.normalise_output(raw, model)


def _summary(spark, sf):
    return outputs.summary_output(outputs.union_outputs([_own(spark, sf, model) for model in fx.MODELS]))


_SUMMARY_SQL = f"""
  select 'Celsius' as "Model", Idsim as "Idsim", Texte as "Texte", {_VALUES} from raw where Model = 'Celsius'
  union all select 'Dssat', Idsim, Texte, {_VALUES} from dssat where Idsim like '%\\_m1\\_%' escape '\\'
  union all select 'Stics', Idsim, Texte, {_VALUES} from raw where Model = 'Stics'"""


@query(_SUMMARY_SQL, ("raw", "dssat"))
def union_outputs(spark, sf):
    return _summary(spark, sf)


_REPLACED_SQL = f"""select * from ({_SUMMARY_SQL}) where "Model" <> 'Dssat'
  union all select 'Dssat', Idsim, Texte, {_VALUES} from dssat"""


@query(_REPLACED_SQL, ("raw", "dssat"))
def replace_model_rows(spark, sf):
    fresh = outputs.summary_output(outputs.normalise_dssat(fx.raw_output(spark, sf)))
    return outputs.replace_model_rows(_summary(spark, sf), fresh, "Dssat")


@query("select distinct Model as model, scenario from raw", ("raw",))
def scenario_list(spark, sf):
    return aggregates.scenario_list(fx.raw_output(spark, sf))


@query("select model, subdomain, count(*) as n_simulations from parts group by all", ("parts",))
def simulations_per_subdomain(spark, sf):
    return aggregates.simulations_per_subdomain(fx.parts_of_output(spark, sf))


@query(
    "select model, scenario, time, lat, lon, count(*) as n from parts group by all having count(*) > 1",
    ("parts",),
)
def duplicate_keys(spark, sf):
    return aggregates.duplicate_keys(fx.parts_of_output(spark, sf))


# ---------------------------------------------------------------- mosaics


def _merged(spark, sf):
    keys = ["model", "scenario", "time", "lat", "lon"]
    return aggregates.first_non_null(fx.parts_of_output(spark, sf), keys)


@query(
    'select model, scenario, time, lat, lon, Yield as "Yield", Biom_ma as "Biom_ma" from merged',
    ("merged",),
)
def first_non_null(spark, sf):
    return _merged(spark, sf)


def _mosaic_sql(value: str) -> str:
    return f"""select model, scenario, time, c.lat, c.lon, cast({value.format('m.Yield')} as float) as "Yield",
      cast({value.format('m.Biom_ma')} as float) as "Biom_ma"
    from (select distinct model, scenario, time from merged) s cross join cells c
    left join merged m using (model, scenario, time, lat, lon)"""


@query(_mosaic_sql("{}"), ("merged", "cells"))
def mosaic(spark, sf):
    return mosaics.mosaic(fx.parts_of_output(spark, sf), fx.mask(spark, sf))


@query(_mosaic_sql("case when {0} is null and mask = 1 then 0 else {0} end"), ("merged", "cells"))
def mosaic_masked(spark, sf):
    return mosaics.mosaic(fx.parts_of_output(spark, sf), fx.mask(spark, sf), fx.mask(spark, sf))


@query(
    """select model, scenario, time, c.lat, c.lon, case when m.Yield is null and mask = 1 then 0 else m.Yield end as "Yield"
    from merged m join cells c on c.lat = m.lat and c.lon = m.lon""",
    ("merged", "cells"),
)
def fill_in_mask(spark, sf):
    merged = _merged(spark, sf).drop("Biom_ma")
    return mosaics.fill_cube(mosaics.with_mask(merged, fx.mask(spark, sf)))


@query(
    f"""select 'Dssat' as model, scenario, lat, lon, {rnd('avg(Yield)', 10)} as "mean_Yield", count(Yield) as n_years
    from dssat where time between 1996 and 2000 group by scenario, lat, lon""",
    ("dssat",),
)
def mean_yield_map(spark, sf):
    cube = outputs.output_cube(outputs.normalise_dssat(fx.raw_output(spark, sf)))
    return rounded(aggregates.mean_yield_map(cube, 1996, 2000), 10, "mean_Yield")


# ---------------------------------------------------------------- readers and writers


@query("select time, lat, lon, tmin, tmax, cast(year(time) as int) as year from cube where year(time) between 1996 and 1998", ("cube",))
def read_cube(spark, sf):
    path = scratch_path(spark, "cube")
    sinks.write_by_year(fx.cube(spark, sf).select("time", "lat", "lon", "tmin", "tmax"), path)
    return scan.read_cube(spark, path, 1996, 1998)


@query(
    """select time, lat, lon, tmin, tmax, cast(year(time) as int) as year from cube
    where year(time) between 1993 and 1997 and lat between 12.3 and 12.6 and lon between -17.5 and -17.4""",
    ("cube",),
)
def read_box(spark, sf):
    """A box of some years out of a cube that is stored along a Z-order curve."""
    path = scratch_path(spark, "curve")
    cube = sinks.stored(fx.cube(spark, sf).select("time", "lat", "lon", "tmin", "tmax"), "cube")
    sinks.write_by_year(cube, path, z_order=True)
    return filters.clip_bbox(scan.read_cube(spark, path, 1993, 1997), -17.5, 12.3, -17.4, 12.6)


@query(
    """select variable, cast(year(time) as int) as year, time, lat, lon, cast(value as float) as value from
    (unpivot (select time, lat, lon, tmax, pr from cube) on tmax, pr into name variable value value)""",
    ("cube",),
)
def write_by_year(spark, sf):
    path = scratch_path(spark, "years")
    sinks.write_by_year(fx.cube(spark, sf), path, ["tmax", "pr"], single=True)
    return spark.read.parquet(path)


@query(
    """select variable, first_year, last_year, count(*) as n from (
      select variable, case when year(time) < 1996 then 1990 else 1996 end as first_year, case when year(time) < 1996 then 1995 else 1999 end as last_year
      from cube, (values ('pr'), ('tmax')) v(variable)) group by all""",
    ("cube",),
)
def files_by_pattern(spark, sf):
    """Rows of real files whose names tell variable and years; a file that names neither is left out."""
    path = scratch_path(spark, "named")
    daily = sinks.stored(fx.cube(spark, sf).select("time", "lat", "lon", "pr", "tmax", "wind"), "cube")
    for variable in ("pr", "tmax"):
        for first, last in ((1990, 1995), (1996, 1999)):
            part = daily.filter(F.year("time") < 1996 if first == 1990 else F.year("time") >= 1996)
            part.select("time", "lat", "lon", F.col(variable).alias("value")).write.parquet(f"{path}/{variable}_global_daily_{first}_{last}.parquet")
    daily.select("time", "lat", "lon", F.col("wind").alias("value")).write.parquet(f"{path}/notes.parquet")
    found = spark.read.option("recursiveFileLookup", "true").parquet(path)
    named = scan.files_by_pattern(found, r"([^/_]+)_global_daily_([0-9]{4})_([0-9]{4})\.parquet/")
    return named.groupBy("variable", "first_year", "last_year").agg(F.count(F.lit(1)).alias("n"))


@query(
    f'select Model as "Model", Idsim as "Idsim", nullif(Texte, \'\') as "Texte", {_VALUES}, time, lat, lon from raw', ("raw",)
)
def read_model_results(spark, sf):
    """Files of one model whose headers have the columns in different orders."""
    path = scratch_path(spark, "results")
    raw = fx.raw_output(spark, sf).drop("k")
    odd = F.pmod(F.xxhash64("Idsim"), F.lit(2)) == 1
    raw.filter(odd).write.csv(path, header=True)
    raw.filter(~odd).select(*sorted(raw.columns)).write.mode("append").csv(path, header=True)
    return scan.read_model_results(spark, path)


@query(_REPLACED_SQL, ("raw", "dssat"))
def replace_model(spark, sf):
    path = scratch_path(spark, "summary")
    sinks.replace_model(_summary(spark, sf), path)
    sinks.replace_model(outputs.summary_output(outputs.normalise_dssat(fx.raw_output(spark, sf))), path)
    return spark.read.parquet(path).select("Model", "Idsim", "Texte", *OUTPUT_VALUES)


@query(_mosaic_sql("{}"), ("merged", "cells"))
def write_scenarios(spark, sf):
    path = scratch_path(spark, "scenarios")
    merged = mosaics.mosaic(fx.parts_of_output(spark, sf), fx.mask(spark, sf))
    sinks.write_scenarios(merged, path, single=True)
    return spark.read.parquet(path)


@query("select region_id, x1, y1, x2, y2 from edges", ("edges",))
def read_regions(spark, sf):
    path = scratch_path(spark, "regions")
    fx.rings(spark, sf).write.json(path)
    return scan.read_regions(spark, path)


@query("select lon, lat from points", ("points",))
def read_points(spark, sf):
    """Files headed lon, lat and lat, lon, with a further column."""
    path = scratch_path(spark, "points")
    points = fx.points(spark, sf)
    points.filter("point % 2 = 0").select("lon", "lat").write.csv(path, header=True)
    points.filter("point % 2 = 1").select("point", "lat", "lon").write.mode("append").csv(path, header=True)
    return scan.read_points(spark, path)


# ---------------------------------------------------------------- tables kept over time


@query(
    f"""select time, lat, lon, count(distinct l_quantity) as n from (
      select cast(l_shipdate as date) as time, {lat_sql('l_suppkey')} as lat, {lon_sql('l_suppkey')} as lon, l_quantity from lineitem)
    group by time, lat, lon having count(distinct l_quantity) > 1"""
)
def repeated_coordinates(spark, sf):
    """Days on which a source has several different values for a cell."""
    daily = fx.table(spark, sf, "lineitem").select(
        F.to_date("l_shipdate").alias("time"), fx.lat_of(F.col("l_suppkey")).alias("lat"), fx.lon_of(F.col("l_suppkey")).alias("lon"), F.col("l_quantity")
    )
    return cubes.repeated_coordinates(daily)


@query(_THERMAL_SQL.replace("ref_year", "year").replace(f"{rnd('sum(degree)', 4)} as gdd", f"cast({rnd('sum(degree)', 4)} as float) as gdd"), ("cube", "cells"))
def thermal_by_year(spark, sf):
    """Thermal time written as one grid per planting year."""
    path = scratch_path(spark, "thermal")
    sinks.write_by_year(QUERIES["thermal_time_side_by_side"](spark, sf), path, single=True)
    return spark.read.parquet(path)


@query(ORACLE["gridded_et"].replace("as etp", "as etp, cast(year(time) as int) as year", 1), ())
def et_by_year(spark, sf):
    """Evapotranspiration written as one cube per year."""
    path = scratch_path(spark, "et")
    sinks.write_by_year(QUERIES["gridded_et"](spark, sf), path)
    return spark.read.parquet(path)


@query('select idPoint as "idPoint", w_date, rain from climate', ("climate",))
def append_years(spark, sf):
    """The climate table filled year by year, each appended to those before."""
    path = scratch_path(spark, "appended")
    climate = _climate(spark, sf).select("idPoint", "w_date", "year", "rain")
    for first, last in ((0, 1994), (1995, 1996), (1997, 9999)):
        sinks.write_table(climate.filter(F.col("year").between(first, last)).drop("year"), path, "append")
    return spark.read.parquet(path)


@query('select idPoint as "idPoint", w_date, tmax / 2 as "Etppm" from climate', ("climate",))
def swap_table(spark, sf):
    """A stored table written anew with a derived column, then read in place of the old one."""
    old = sinks.stored(_climate(spark, sf), "climate")
    new = scratch_path(spark, "climate")
    sinks.write_table(old.withColumn("Etppm", F.col("tmax") / 2), new)
    return spark.read.parquet(new).select("idPoint", "w_date", "Etppm")


@query('select idPoint as "idPoint", w_date, rain, year from climate', ("climate",))
def append_twice(spark, sf):
    """The climate table filled by runs that overlap and repeat; each computes and adds only the years that are absent."""
    path = scratch_path(spark, "ledger")
    climate = sinks.stored(_climate(spark, sf).select("idPoint", "w_date", "year", "rain"), "climate")
    for first, last in ((1990, 1994), (1993, 1996), (1990, 2010), (1990, 2010)):
        ledger.append_absent(climate, path, range(first, last + 1))
    return ledger.read_versions(spark, path)


@query('select idPoint as "idPoint", w_date, rain, year, tmax / 2 as "Etppm" from climate', ("climate",))
def swap_pointer(spark, sf):
    """A table rewritten from itself with a derived column, in one commit."""
    path = scratch_path(spark, "ledger")
    ledger.append_absent(_climate(spark, sf).select("idPoint", "w_date", "year", "rain", "tmax"), path, range(1990, 2011))
    ledger.swap(ledger.read_versions(spark, path).withColumn("Etppm", F.col("tmax") / 2).drop("tmax"), path, "year")
    return ledger.read_versions(spark, path)


@query(_REPLACED_SQL, ("raw", "dssat"))
def refresh_model(spark, sf):
    """The rows of one model replaced in one commit, twice."""
    path = scratch_path(spark, "ledger")
    ledger.refresh(_summary(spark, sf), path, "Model")
    new = outputs.summary_output(outputs.normalise_dssat(fx.raw_output(spark, sf)))
    for _ in range(2):
        ledger.refresh(new, path, "Model", ["Dssat"])
    return ledger.read_versions(spark, path).select("Model", "Idsim", "Texte", *OUTPUT_VALUES)


@query("select commit, case when commit = 0 or year <= 1995 then 0 else 1 end as written, cast(year as int) as year from (values (0), (1)) c(commit), range(1990, 2001) y(year) where commit = 1 or year <= 1995")
def ledger_history(spark, sf):
    """Which commit each live year of a table was written by, at every commit; years without rows count."""
    path = scratch_path(spark, "ledger")
    climate = _climate(spark, sf).select("idPoint", "year", "rain")
    ledger.append_absent(climate, path, range(1990, 1996))
    ledger.append_absent(climate, path, range(1990, 2001))
    lines = ledger.history(spark, path)
    firsts = lines.groupBy("value").agg(F.min("commit").alias("written"))
    return lines.join(firsts, "value").select("commit", "written", F.col("value").cast("int").alias("year"))


@query(f'select Idsim as "Idsim", {_VALUES} from raw', ("raw",))
def result_table(spark, sf):
    """Results read from a named table."""
    fx.raw_output(spark, sf).select("Idsim", *OUTPUT_VALUES).createOrReplaceTempView("gridagro_results")
    return scan.read_result_table(spark, "gridagro_results")


@query(f'select Idsim as "Idsim", {_VALUES} from raw', ("raw",))
def stored_result_table(spark, sf):
    """Results read from a table that the catalog holds."""
    path = scratch_path(spark, "results")
    name = "results_" + path.rsplit("-", 1)[1]
    sinks.save_table(fx.raw_output(spark, sf).select("Idsim", *OUTPUT_VALUES), name, path)
    return scan.read_result_table(spark, name)


@query(
    """select 'before' as stage, lat, lon, dem as "Band1" from cells
    union all select 'after', lat, lon, dem from cells where mask = 1""",
    ("cells",),
)
def mask_snapshots(spark, sf):
    """Elevation before and after the crop mask, from both tables that masking leaves in the catalog."""
    path = scratch_path(spark, "snapshots")
    name = "dem_" + path.rsplit("-", 1)[1]
    sinks.masked_with_snapshots(fx.dem(spark, sf), fx.mask(spark, sf), name, path)
    stages = [spark.table(f"{name}_{stage}").select(F.lit(stage).alias("stage"), "lat", "lon", "Band1") for stage in ("before", "after")]
    return cubes.union_by_name(stages)


@query("select model, scenario, count(*) as n from parts where model <> 'Stics' group by all", ("parts",))
def empty_refresh(spark, sf):
    """A model whose refresh brings no rows has none left."""
    path = scratch_path(spark, "refreshed")
    results = fx.parts_of_output(spark, sf).withColumnRenamed("model", "Model")
    sinks.replace_model(results, path)
    sinks.replace_model(results.limit(0), path, "Stics")
    left = spark.read.parquet(path).withColumnRenamed("Model", "model")
    return left.groupBy("model", "scenario").agg(F.count(F.lit(1)).alias("n"))


@query(_mosaic_sql("{}"), ("merged", "cells"))
def collect_outputs(spark, sf):
    """Cubes published per model, scenario and sub-domain, read back by their paths, and put together."""
    path = scratch_path(spark, "published")
    parts = fx.parts_of_output(spark, sf)
    name = F.concat(F.col("model"), F.lit("_yearly_"), F.col("scenario"), F.lit("_"), F.col("subdomain").cast("string"), F.lit(".parquet"))
    named = parts.withColumn("file", name).drop("model", "scenario", "subdomain")
    named.hint("rebalance", "file").write.partitionBy("file").parquet(path)
    found = spark.read.parquet(path)
    back = found.withColumns(gf.parse_output_name(F.col("file"))).drop("file")
    return mosaics.mosaic(back, fx.mask(spark, sf))
