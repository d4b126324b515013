"""The views of ``fixtures`` again, as DuckDB SQL, and small SQL expression builders."""

from __future__ import annotations

from checks.fixtures import VARIETY_SQL


def rnd(x: str, digits: int) -> str:
    return f"(round_even(({x}) * 1e{digits}, 0) / 1e{digits})"


def pid(lat: str = "lat", lon: str = "lon") -> str:
    return f"(cast({rnd(lat, 4)} as varchar) || '_' || cast({rnd(lon, 4)} as varchar))"


def leap(y: str) -> str:
    return f"(({y} % 4 = 0 and {y} % 100 <> 0) or {y} % 400 = 0)"


def length(y: str) -> str:
    return f"(case when {leap(y)} then 366 else 365 end)"


_LAT = "((12225e0 + 50e0 * floor({k} / 10e0)) / 1e3)"
_LON = "((-17575e0 + 50e0 * ({k} % 10)) / 1e3)"


def lat(k: str) -> str:
    return _LAT.format(k=k)


def lon(k: str) -> str:
    return _LON.format(k=k)


VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "cells": (
        (),
        f"""
        select s_suppkey as k, s_nationkey as nation, {lat('s_suppkey')} as lat, {lon('s_suppkey')} as lon,
          case when s_suppkey % 7 = 3 then null when s_suppkey % 11 = 5 then 0e0 else 1e0 end as mask,
          s_acctbal / 10 as dem,
          case when s_suppkey % 13 = 6 then null else 1 + s_suppkey % 12 end as Band1,
          case when s_suppkey % 17 = 8 then null else 100 + 20 * (s_suppkey % 10) end as planting_day,
          case when s_suppkey % 17 = 8 then null when s_suppkey % 3 = 0 then 60
               else least(210 + 20 * (s_suppkey % 10), 365) end as maturity_day,
          s_acctbal as balance
        from supplier""",
    ),
    "soilgrid": (
        ("cells",),
        """
        select lat, lon, mask, balance / 7 as SoilTotalDepth, balance / 9 as SoilRDepth, (k % 40) / 300e0 as Wwp,
          (k % 50) / 170e0 as Wfc, 1 + (k % 8) / 16e0 as bd, balance / 11 as OrganicNStock, 5 + (k % 30) / 13e0 as pH,
          case when k % 19 = 5 then null else (k % 60) / 70e0 end as OrganicC, (k % 5) / 3e0 as cf,
          (k % 9) / 7e0 as extp, (k % 6) / 7e0 as totp, (k % 90) / 11e0 as sand, (k % 80) / 11e0 as clay,
          (k % 70) / 11e0 as silt, Band1
        from cells""",
    ),
    "valid": (
        ("soilgrid",),
        """
        select lat, lon, case when OrganicC is not null and Band1 is not null then mask end as mask from soilgrid""",
    ),
    "cube": (
        (),
        f"""
        select l_suppkey as k, cast(l_shipdate as date) as time, {lat('l_suppkey')} as lat, {lon('l_suppkey')} as lon,
          8 + max(l_quantity) / 4 as srad, 15 + min(l_quantity) / 5 + 100 * max(l_discount) as tmax,
          10 + min(l_quantity) / 5 as tmin, min(l_extendedprice) / 1000 as pr, 1 + 50 * max(l_tax) as wind,
          40 + min(l_quantity) as rhum, 6 + min(l_quantity) / 5 as Tdewmin, 9 + min(l_quantity) / 5 as Tdewmax
        from lineitem group by l_suppkey, cast(l_shipdate as date)""",
    ),
    "climate": (
        ("cube", "valid"),
        f"""
        select {pid('c.lat', 'c.lon')} as idPoint, strftime(time, '%Y-%m-%d') as w_date,
          cast(year(time) as int) as year, cast(dayofyear(time) as int) as DOY, cast(month(time) as int) as Nmonth,
          cast(day(time) as int) as NdayM, {rnd('srad', 1)} as srad, {rnd('tmax', 1)} as tmax, {rnd('tmin', 1)} as tmin,
          {rnd('(tmin + tmax) / 2', 1)} as tmoy, {rnd('pr', 1)} as rain, {rnd('wind', 1)} as wind,
          {rnd('rhum', 1)} as rhum, cast(null as double) as Etppm, {rnd('Tdewmin', 1)} as Tdewmin,
          {rnd('Tdewmax', 1)} as Tdewmax, cast(null as double) as Surfpress
        from cube c join valid v on c.lat = v.lat and c.lon = v.lon and v.mask = 1""",
    ),
    "coords": (
        ("cells",),
        f"""
        select cast(trunc({rnd('dem', 4)}) as int) as altitude, {rnd('lat', 4)} as latitudeDD,
          {rnd('lon', 4)} as longitudeDD, '' as codeSWstation, {pid()} as idPoint, '' as startRain, '' as EndRain
        from cells where mask = 1""",
    ),
    "management": (
        (),
        """
        select replace(p_brand, 'Brand#', 'm') as idMangt, p_brand as Idcultivar,
          cast(100 + 5 * (sum(p_size) % 50) as int) as sowingdate, min(p_retailprice) / 100 as sdens,
          'none' as OFertiPolicyCode, cast(sum(p_partkey) % 3 as int) as InoFertiPolicyCode,
          'none' as IrrigationPolicyCode, 'none' as SoilTillPolicyCode
        from part group by p_brand""",
    ),
    "spatial": (
        ("cells", "management"),
        f"""
        select {pid()} || '_' || idMangt as idMangt, {VARIETY_SQL} as Idcultivar,
          cast(110 + k % 90 as int) as sowingdate, sdens, OFertiPolicyCode, InoFertiPolicyCode, IrrigationPolicyCode,
          SoilTillPolicyCode, {pid()} as idPoint, idMangt as oldid, {rnd('lat', 4)} as lat, {rnd('lon', 4)} as lon
        from cells cross join management""",
    ),
    "years": (("climate",), "select distinct idPoint, year from climate"),
    "soils": (
        ("soilgrid",),
        f"""
        select {pid()} as IdSoil from soilgrid where OrganicC is not null and Band1 is not null and mask = 1""",
    ),
    "options": ((), "select * from (values (1), (2), (3), (4)) t(idOption)"),
    "raw": (
        (),
        f"""
        select case m when 0 then 'Celsius' when 1 then 'Dssat' else 'Stics' end as Model,
          {pid(lat('k'), lon('k'))} || '_' || ys || '_m' || m || '_' || opt as Idsim, '' as Texte,
          cast(ys * 1000 + 150 as double) as Planting, cast(ys * 1000 + 157 + key % 9 as double) as Emergence,
          cast(ys * 1000 + 200 + key % 40 as double) as Ant,
          cast(case when key % 5 = 0 then -99 else (ys + key % 2) * 1000 + 20 end as double) as Mat,
          high / 50 as Biom_ma, low / 100 as Yield, low / 7 as GNumber, cast(key % 6 as double) as MaxLai,
          cast(case when key % 4 = 0 then -99 else key % 30 end as double) as Nleac,
          cast(key % 11 - 3 as double) as SoilN, cast(key % 13 as double) as CroN_ma, high / 900 as CumE,
          high / 800 as Transp, cast(ys as int) as time, {lat('k')} as lat, {lon('k')} as lon, k,
          'm' || m || '_' || opt as scenario
        from (select o_custkey // 15 as k, year(o_orderdate) as ys, o_custkey % 3 as m, o_orderpriority[1] as opt,
                min(o_orderkey) as key, min(o_totalprice) as low, max(o_totalprice) as high
              from orders group by all)""",
    ),
    "dssat": (
        ("raw",),
        f"""
        select 'Dssat' as Model, Idsim, Texte, scenario, time, lat, lon, k,
          {{dates}},
          case when Biom_ma >= 0 then Biom_ma / 1000 end as Biom_ma, case when Yield >= 0 then Yield / 1000 end as Yield,
          case when GNumber >= 0 then GNumber end as GNumber, case when MaxLai >= 0 then MaxLai end as MaxLai,
          case when Nleac >= 0 then Nleac end as Nleac, case when SoilN >= 0 then SoilN end as SoilN,
          case when CroN_ma >= 0 then CroN_ma end as CroN_ma, CumE, Transp
        from raw""",
    ),
    "parts": (
        ("raw",),
        """
        select Model as model, scenario, time, lat, lon, cast(k % 3 as int) as subdomain,
          case when MaxLai <> 0 then Yield end as Yield, Biom_ma from raw
        union all
        select Model, scenario, time, lat, lon, cast((k + 1) % 3 as int),
          case when MaxLai <> 0 then Yield else 0 end + 1, Biom_ma + 1 from raw""",
    ),
    "merged": (
        ("parts",),
        """
        select model, scenario, time, lat, lon, arg_min(Yield, subdomain) filter (Yield is not null) as Yield,
          arg_min(Biom_ma, subdomain) filter (Biom_ma is not null) as Biom_ma
        from parts group by model, scenario, time, lat, lon""",
    ),
    "vertices": (
        ("cells",),
        """
        select * from (values (1, 0, 0, -17.56e0, 12.24e0), (1, 0, 1, -17.25e0, 12.26e0), (1, 0, 2, -17.4e0, 12.62e0),
          (1, 1, 0, -17.45e0, 12.33e0), (1, 1, 1, -17.36e0, 12.33e0), (1, 1, 2, -17.4e0, 12.42e0),
          (2, 0, 0, -17.3e0, 12.52e0), (2, 0, 1, -17.29e0, 12.52e0), (2, 0, 2, -17.295e0, 12.53e0)) v(region_id, ring_id, seq, x, y)
        union all select nation + 100, 0, 0, min(lon) - 0.12e0, min(lat) - 0.06e0 from cells group by nation
        union all select nation + 100, 0, 1, max(lon) + 0.11e0, (min(lat) + max(lat)) / 2 from cells group by nation
        union all select nation + 100, 0, 2, (min(lon) + max(lon)) / 2, max(lat) + 0.13e0 from cells group by nation""",
    ),
    "edges": (
        ("vertices",),
        """
        select cast(a.region_id as bigint) as region_id, a.x as x1, a.y as y1, b.x as x2, b.y as y2
        from vertices a join vertices b
          on a.region_id = b.region_id and a.ring_id = b.ring_id and b.seq = (a.seq + 1) % 3""",
    ),
    "centre": (
        ("cells", "edges"),
        """
        select region_id, lat, lon from cells, edges
        where (y1 > lat) <> (y2 > lat) and lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1
        group by region_id, lat, lon having count(*) % 2 = 1""",
    ),
    "touched": (
        ("centre",),
        """
        select region_id, lat, lon from centre
        union
        select region_id, lat, lon from cells, edges
        where least(x1, x2) <= lon + 0.025e0 and greatest(x1, x2) >= lon - 0.025e0
          and least(y1, y2) <= lat + 0.025e0 and greatest(y1, y2) >= lat - 0.025e0
          and abs((x2 - x1) * (lat - y1) - (y2 - y1) * (lon - x1)) <= 0.025e0 * (abs(x2 - x1) + abs(y2 - y1))""",
    ),
    "points": (
        (),
        """
        select c_custkey as point, (-17605e0 + 5 * (c_custkey % 110)) / 1e3 as lon,
          (12200e0 + 5 * floor(c_custkey / 15e0)) / 1e3 as lat from customer""",
    ),
    "nearest": (
        ("points", "cells"),
        """
        select p.point, p.lon, p.lat, y.v as cell_lat, x.v as cell_lon from points p
        join (select plat, v from (select plat, v, row_number() over (partition by plat
                order by round_even(abs(plat - v) * 1e6, 0), v desc) as r
              from (select distinct lat as plat from points), (select distinct lat as v from cells)) where r = 1) y on y.plat = p.lat
        join (select plon, v from (select plon, v, row_number() over (partition by plon
                order by round_even(abs(plon - v) * 1e6, 0), v desc) as r
              from (select distinct lon as plon from points), (select distinct lon as v from cells)) where r = 1) x on x.plon = p.lon""",
    ),
}


def _day(name: str) -> str:
    value = f"(case when {name} <> -99 then {name} end)"
    shifted = f"({value} % 1000 + case when floor({value} / 1000) > time then {length('time')} else 0 end)"
    return f"case when {shifted} >= 0 then cast({shifted} as double) end as {name}"


_deps, _text = VIEWS["dssat"]
VIEWS["dssat"] = (_deps, _text.replace("{dates}", ", ".join(_day(n) for n in ("Planting", "Emergence", "Ant", "Mat"))))


def with_views(body: str, *names: str) -> str:
    """``body`` behind the common table expressions it needs, dependencies first."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in VIEWS[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    ctes = ",\n".join(f"{name} as ({VIEWS[name][1]}\n)" for name in ordered)
    return f"with {ctes}\n{body}" if ordered else body
