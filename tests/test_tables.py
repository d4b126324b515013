"""Input tables, management and units on small hand-made grids."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridagro.operators import cube, filters
from gridagro.plans import agroclimate, inputs, management as mgmt, units
from gridagro.sources.schemas import CLIMATE, COORDINATES, SIM_UNITS, SOIL, SOIL_VALUES


def _soil(spark, rows):
    schema = "lat double, lon double, " + ", ".join(f"{n} double" for n in SOIL_VALUES) + ", Band1 double"
    return spark.createDataFrame([(lat, lon, *[1.23456] * 14, band) for lat, lon, band in rows], schema)


def test_valid_cells_and_crop_cells(spark):
    mask = spark.createDataFrame([(1.0, 1.0, 1.0), (1.0, 2.0, 0.0), (2.0, 1.0, 1.0), (2.0, 2.0, None), (3.0, 3.0, 1.0)], "lat double, lon double, mask double")
    soil = _soil(spark, [(1.0, 1.0, 1.0), (1.0, 2.0, 2.0), (2.0, 1.0, float("nan")), (2.0, 2.0, 3.0)])
    valid = {(r.lat, r.lon): r.mask for r in filters.valid_cells(mask, soil).collect()}
    assert valid == {(1.0, 1.0): 1.0, (1.0, 2.0): 0.0, (2.0, 1.0): None, (2.0, 2.0): None, (3.0, 3.0): None}
    assert [(r.lat, r.lon) for r in filters.crop_cells(mask, soil).collect()] == [(1.0, 1.0)]
    assert filters.count_cells(filters.valid_cells(mask, soil)).first().n_cells == 2


def test_mask_is_matched_by_coordinate(spark):
    cells = spark.createDataFrame([(1.0000000001, 2.0, 5), (1.5, 2.0, 6)], "lat double, lon double, v int")
    mask = spark.createDataFrame([(1.0, 2.0, 1.0), (1.5, 2.0, 0.0)], "lat double, lon double, mask double")
    assert [r.v for r in filters.apply_mask(cells, mask).collect()] == [5]


def test_soil_table(spark):
    table = inputs.soil_table(_soil(spark, [(1.0, 1.0, 8.0), (2.0, 1.0, None)]))
    assert table.columns == list(SOIL)
    row = table.first()
    assert (row.IdSoil, row.pH, row.totp, row.SoilTextureType, row.Slope, row.albedo) == ("1.0_1.0", 1.235, -99.0, "silty loam", None, 0.3)
    assert table.count() == 1


def test_replace_texture_drops_former_columns(spark):
    soil = spark.createDataFrame([("1.0_1.0", "a", "b", 1.0), ("2.0_1.0", "a", "b", 2.0)], "IdSoil string, SoilTextureType string, SoilTextureType_x string, pH double")
    grid = spark.createDataFrame([(1.0, 1.0, 3.0), (2.0, 1.0, 4.0)], "lat double, lon double, Band1 double")
    mask = spark.createDataFrame([(1.0, 1.0, 0.0), (2.0, 1.0, None)], "lat double, lon double, mask double")
    got = inputs.replace_texture(soil, grid, mask)
    assert [(r.IdSoil, r.pH, r.SoilTextureType) for r in got.collect()] == [("1.0_1.0", 1.0, "sandy clay")]
    assert "SoilTextureType_x" not in got.columns


def test_coordinates_table(spark):
    dem = spark.createDataFrame([(1.0, 2.0, -3.7), (1.0, 3.0, None)], "lat double, lon double, Band1 double")
    assert [tuple(r) for r in inputs.coordinates_table(dem).collect()] == [(-3, 1.0, 2.0, "", "1.0_2.0", "", "")]
    assert inputs.coordinates_table(dem).columns == list(COORDINATES)
    assert inputs.coordinates_table(dem, legacy=True).columns[-4:] == ["SourceW", "SourceRain", "Comment", "ev"]


def test_climate_table(spark):
    rows = [
        (dt.datetime(2000, 3, 1, 12), 1.0, 2.0, 20.04, 30.0, 10.1, 1.25),
        (dt.datetime(2000, 3, 2, 12), 1.0, 2.0, 20.0, float("nan"), 10.0, 1.0),
        (dt.datetime(1999, 12, 31), 1.0, 2.0, 20.0, 25.0, 10.0, 1.0),
    ]
    daily = spark.createDataFrame(rows, "time timestamp, lat double, lon double, srad double, tmax double, tmin double, pr double")
    table = inputs.climate_table(daily, first=2000, last=2000)
    assert dict(table.dtypes) == CLIMATE and table.columns == list(CLIMATE)
    row = table.collect()[0]
    assert (row.idPoint, row.w_date, row.year, row.DOY, row.Nmonth, row.NdayM) == ("1.0_2.0", "2000-03-01", 2000, 61, 3, 1)
    assert (row.srad, row.tmax, row.tmin, row.tmoy, row.rain, row.wind) == (20.0, 30.0, 10.1, 20.0, 1.2, None)
    assert table.count() == 1


def test_combine_prefers_the_first_part(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0, 1.0), (2, 0.0, 0.0, None)], "time int, lat double, lon double, v double")
    b = spark.createDataFrame([(1, 0.0, 0.0, 9.0), (2, 0.0, 0.0, 8.0), (3, 0.0, 0.0, 7.0)], "time int, lat double, lon double, v double")
    c = spark.createDataFrame([(3, 0.0, 0.0, 5.0)], "time int, lat double, lon double, w double")
    got = {r.time: (r.v, r.w) for r in cube.combine_by_coords([a, b, c]).collect()}
    assert got == {1: (1.0, None), 2: (8.0, None), 3: (7.0, 5.0)}
    first = {r.time: (r.v, r.w) for r in cube.combine_by_coords([a, b, c], override=True).collect()}
    assert first == {1: (1.0, None), 2: (None, None), 3: (None, 5.0)}
    assert cube.align_variables([a, b, c]).count() == 0
    assert [(r.time, r.v, r.w) for r in cube.align_variables([b, a, c]).collect()] == [(3, 7.0, 5.0)]


def test_reference_et_of_unknown_point_is_null(spark):
    columns = ["idPoint", "w_date", "DOY", "tmin", "tmax", "tmoy", "Tdewmin", "Tdewmax", "rhum", "wind", "srad", "Etppm"]
    schema = ", ".join(f"{c} {'string' if c in ('idPoint', 'w_date') else 'int' if c == 'DOY' else 'double'}" for c in columns)
    climate = spark.createDataFrame([(p, "2000-01-01", 1, 10.0, 20.0, 15.0, 5.0, 8.0, 60.0, 2.0, 18.0, None) for p in ("a", "b")], schema)
    coords = spark.createDataFrame([("a", 10.0, 3)], "idPoint string, latitudeDD double, altitude int")
    for method in ("tdew", "rhum"):
        got = {r.idPoint: r.Etppm for r in agroclimate.with_reference_et(climate, coords, method).collect()}
        assert got["a"] > 0 and got["b"] is None
    with pytest.raises(ValueError):
        agroclimate.with_reference_et(climate, coords, "other")


def test_thermal_time_edges(spark):
    days = [dt.date(1999, 1, 1) + dt.timedelta(days=i) for i in range(800)]
    kelvin = 273.15
    rows = [(d, 1.0, lon, 20.0 + kelvin) for d in days for lon in (1.0, 2.0)]
    tmax = spark.createDataFrame(rows, "time date, lat double, lon double, tasmax double")
    tmin = tmax.select("time", "lat", "lon", (F.col("tasmax") - 4).alias("tasmin"))
    calendar = spark.createDataFrame([(1.0, 1.0, 300, 60)], "lat double, lon double, planting_day int, maturity_day int")
    got = {(r.ref_year, r.lon): round(r.gdd, 6) for r in agroclimate.thermal_time(tmax, tmin, calendar, 1999, 2001).collect()}
    assert got[1999, 1.0] == 10.0 * (66 + 60)
    assert got[2000, 1.0] == 10.0 * (67 + 60)
    assert got[2001, 1.0] == 0.0 and got[1999, 2.0] == 0.0
    assert len(got) == 6

    missing = tmax.withColumn("tasmax", F.when(F.col("lon") == 1.0, float("nan")).otherwise(F.col("tasmax")))
    side_by_side = missing.join(tmin, ["time", "lat", "lon"])
    for result in (
        agroclimate.thermal_time(missing, tmin, calendar, 1999, 1999),
        agroclimate.thermal_time(side_by_side, None, calendar, 1999, 1999),
    ):
        assert sorted((r.lon, r.gdd) for r in result.collect()) == [(1.0, 0.0), (2.0, 0.0)]


@pytest.fixture()
def management(spark):
    rows = [("m1", "a", 150, 5.0, 0), ("m2", "b", 166, 6.0, 1), ("m3", "a", 200, 7.0, 2)]
    return spark.createDataFrame(rows, "idMangt string, Idcultivar string, sowingdate int, sdens double, InoFertiPolicyCode int")


def test_management_lists(management):
    ids = lambda df: sorted(r.idMangt for r in df.collect())
    assert ids(mgmt.management_table(management)) == ["m1", "m2", "m3"]
    assert ids(mgmt.management_table(management, cultivars=["a"], fertiliser=["0"])) == ["m1"]
    assert ids(mgmt.management_table(management, dates=[110, 120], fertiliser=[1])) == ["m2_110", "m2_120"]


def test_gridded_management(spark, management):
    grid = spark.createDataFrame([(1.0, 2.0, 1.0000001, 140.9, 9.5), (1.0, 3.0, 7.0, 150.2, 8.5), (2.0, 2.0, None, 1.0, 1.0)], "lat double, lon double, variety double, sowing_date double, sdens double")
    table = mgmt.management_table(management, grid, cultivars=["ignored"], fertiliser=[0], varieties={"1.0": "c"}, dates=None)
    got = sorted((r.idMangt, r.oldid, r.idPoint, r.Idcultivar, r.sowingdate, r.sdens) for r in table.na.fill("-").collect())
    assert got == [("1.0_2.0_m1", "m1", "1.0_2.0", "c", 140, 9.5), ("1.0_3.0_m1", "m1", "1.0_3.0", "-", 150, 8.5)]
    sown = mgmt.management_table(management, grid, fertiliser=[0], dates=[7])
    assert {(r.idMangt, r.oldid) for r in sown.collect()} == {("1.0_2.0_m1_7", "m1_7"), ("1.0_3.0_m1_7", "m1_7")}


@pytest.fixture()
def run(spark):
    years = spark.createDataFrame([("p", 2000), ("p", 2001), ("q", 2000), ("p", 2000)], "idPoint string, year int")
    soil = spark.createDataFrame([("p",), ("p",), ("r",)], "IdSoil string")
    return years, soil


def test_units_everywhere(run, management):
    table = units.build_sim_units(*run, management, [1, 2, 1])
    assert table.columns == list(SIM_UNITS) and dict(table.dtypes) == SIM_UNITS
    assert table.count() == 2 * 3 * 2
    row = table.filter("idMangt = 'm2' and StartYear = 2000 and idOption = 2").first()
    assert (row.StartDay, row.EndYear, row.EndDay, row.idsim, row.IdSoil) == (136, 2000, 366, "p_2000_m2_2", "p")
    assert units.dedupe_units(table).exceptAll(table).isEmpty()


def test_units_at_their_own_point(spark, run):
    rows = [("p_m1", "m1", "p", 150, 0), ("z_m1", "m1", "z", 150, 0)]
    table = spark.createDataFrame(rows, "idMangt string, oldid string, idPoint string, sowingdate int, InoFertiPolicyCode int")
    got = units.build_sim_units(*run, table, [4], mode="model", start=300, end=60)
    assert sorted((r.idsim, r.StartDay, r.EndYear, r.EndDay) for r in got.collect()) == [("p_2000_m1_4", 300, 2001, 60), ("p_2001_m1_4", 300, 2002, 60)]
    with pytest.raises(ValueError):
        units.build_sim_units(*run, table, [4], mode="455")


def test_zero_fertiliser_code_may_be_text(spark, run, management):
    text = management.withColumn("InoFertiPolicyCode", F.concat(F.lit("0"), F.col("InoFertiPolicyCode").cast("string")))
    text = text.unionByName(text.limit(1).withColumns({"idMangt": F.lit("m9"), "InoFertiPolicyCode": F.lit("none")}))
    direct = units.sim_units(*run, text, [2])
    assert {r.idMangt for r in direct.collect()} == {"m1"}
    assert {r.idMangt for r in filters.drop_fertilised(units.build_sim_units(*run, text, [2]), text).collect()} == {"m1"}


def test_zero_fertiliser_rule(spark, run, management):
    extra = management.unionByName(spark.createDataFrame([(None, "a", 1, 1.0, 0)], management.schema))
    everything = units.build_sim_units(*run, management, [1, 2, 3, 4])
    kept = filters.drop_fertilised(everything, extra)
    assert {(r.idMangt, r.idOption) for r in kept.collect()} == {("m1", 1), ("m1", 2), ("m1", 3), ("m1", 4), ("m2", 1), ("m2", 3), ("m3", 1), ("m3", 3)}
    years, soil = run
    direct = units.sim_units(years, soil, management, [1, 2, 3, 4])
    assert direct.exceptAll(kept).isEmpty() and kept.exceptAll(direct).isEmpty()


def test_season_climate_sums_every_day_once(spark):
    start = dt.date(1999, 11, 20)
    days = [(("p", str(start + dt.timedelta(days=i)), float(i % 7), 1.5, 10.0 + i % 3, 20.0, None if i % 2 else 15.0)) for i in range(600) if i % 11]
    climate = spark.createDataFrame(days, "idPoint string, w_date string, rain double, Etppm double, tmin double, tmax double, tmoy double")
    windows = [("u1", "p", 2000, 1, 2000, 366), ("u2", "p", 2000, 5, 2000, 5), ("u3", "p", 1999, 340, 2001, 100), ("u4", "p", 2000, 63, 2000, 64), ("u5", "x", 2000, 1, 2000, 9), ("u6", "p", 2000, 1, 2000, 366)]
    table = spark.createDataFrame(windows, "idsim string, idPoint string, StartYear int, StartDay int, EndYear int, EndDay int")
    got = {r.idsim: r for r in units.season_climate(table, climate).collect()}
    assert len(got) == len(windows)
    for name, point, y1, d1, y2, d2 in windows:
        a, b = dt.date(y1, 1, 1) + dt.timedelta(d1 - 1), dt.date(y2, 1, 1) + dt.timedelta(d2 - 1)
        inside = [d for d in days if d[0] == point and str(a) <= d[1] <= str(b)]
        assert got[name].n_days == len(inside)
        if inside:
            assert got[name].rain == pytest.approx(sum(d[2] for d in inside))
            assert got[name].tmin == pytest.approx(sum(d[4] for d in inside) / len(inside))
            known = [d[6] for d in inside if d[6] is not None]
            assert got[name].tmoy == (pytest.approx(sum(known) / len(known)) if known else None)
        else:
            assert got[name].rain is None


def test_season_climate_does_not_depend_on_the_length_of_windows(spark):
    """Days are shuffled and sorted once and meet the ends of windows only, however many days a window has."""
    start = dt.date(2000, 1, 1)
    rows = [("p", str(start + dt.timedelta(days=i)), 0.1 * (i % 9), None, -5.0 + i % 31, 20.0, 1.0) for i in range(1461)]
    climate = spark.createDataFrame([*rows, rows[5]], "idPoint string, w_date string, rain double, Etppm double, tmin double, tmax double, tmoy double")
    schema = "idsim string, idPoint string, StartYear int, StartDay int, EndYear int, EndDay int"
    windows = [(f"u{y}_{d}_{n}", "p", y, d, y + (d + n) // 366, 1 + (d + n) % 366) for y in (2000, 2001) for d in (1, 2, 200, 366) for n in (0, 1, 30, 300, 700)]
    got = {r.idsim: r for r in units.season_climate(spark.createDataFrame([*windows, ("back", "p", 2001, 9, 2001, 8), ("four", "p", 2000, 1, 2003, 365)], schema), climate).collect()}
    for name, _, y1, d1, y2, d2 in [*windows, ("four", "p", 2000, 1, 2003, 365)]:
        a, b = dt.date(y1, 1, 1) + dt.timedelta(d1 - 1), dt.date(y2, 1, 1) + dt.timedelta(d2 - 1)
        inside = [r for r in [*rows, rows[5]] if str(a) <= r[1] <= str(b) and r[1][:4] <= str(y2)]
        assert got[name].n_days == len(inside), name
        assert got[name].Etppm is None
        if inside:
            assert got[name].rain == pytest.approx(sum(r[2] for r in inside), abs=1e-9) and got[name].tmin == pytest.approx(sum(r[4] for r in inside) / len(inside), abs=1e-9)
    assert got["back"].n_days == 0 and got["back"].rain is None
    plan = units.season_climate(spark.createDataFrame(windows, schema), climate)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and plan.count("Window [") == 1


def test_season_climate_takes_windows_by_their_days(spark):
    """A window that ends on day 0 of a year is that to the last day of the year before: its days count once."""
    climate = spark.createDataFrame([("p", f"2000-12-{d}", 1.0, 2.0, 3.0, 4.0, 5.0) for d in (29, 30, 31)], "idPoint string, w_date string, rain double, Etppm double, tmin double, tmax double, tmoy double")
    table = spark.createDataFrame([("a", "p", 2000, 364, 2000, 366), ("b", "p", 2000, 364, 2001, 0)], "idsim string, idPoint string, StartYear int, StartDay int, EndYear int, EndDay int")
    assert [(r.n_days, r.rain, r.tmin) for r in units.season_climate(table, climate).collect()] == [(3, 3.0, 3.0)] * 2


def test_season_climate_repeats_totals_for_hot_windows_only(spark, monkeypatch):
    climate = spark.createDataFrame([("p", "2000-01-02", 1.0, 2.0, 3.0, 4.0, 5.0)], "idPoint string, w_date string, rain double, Etppm double, tmin double, tmax double, tmoy double")
    table = spark.createDataFrame([(f"u{i}", "p", 2000, 1, 2000, 9) for i in range(40)], "idsim string, idPoint string, StartYear int, StartDay int, EndYear int, EndDay int")
    plain = units.season_climate(table, climate)
    monkeypatch.setattr(units, "FEW", 30)
    split = units.season_climate(table, climate)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (plain, split)]
    assert ["__part" in plan for plan in plans] == [False, True]
    assert sorted(plain.collect()) == sorted(split.collect()) and plain.filter("n_days = 1").count() == 40
