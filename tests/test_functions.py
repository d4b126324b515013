"""Hand-made rows for ids, dates, numbers and the agro-climatic formulas."""

import math

import pytest
from pyspark.sql import functions as F

from gridagro import functions as gf


def test_point_id(values):
    rows = [(14.0, 0.0005), (-16.275, 14.0), (12.22499999999, -0.00001), (None, 1.0)]
    got = values(rows, "lat double, lon double", id=gf.point_id(F.col("lat"), F.col("lon")))
    assert [g[0] for g in got][:3] == ["14.0_0.0005", "-16.275_14.0", "12.225_0.0"]


def test_sim_id_round_trip(values):
    rows = [("14.0_-16.275", 1999, "m1_150", 2)]
    made = gf.sim_id(F.col("p"), F.col("y"), F.col("m"), F.col("o"))
    got = values(rows, "p string, y int, m string, o int", id=made, **gf.parse_sim_id(made))
    assert got == [("14.0_-16.275_1999_m1_150_2", 14.0, -16.275, 1999, "m1_150_2")]


def test_scenarios_are_matched_whole(values):
    rows = [("1.0_2.0_2000_1_2",), ("1.0_2.0_2000_11_2",)]
    assert values(rows, "id string", hit=gf.in_scenario(F.col("id"), "1_2")) == [(True,), (False,)]


def test_output_name(values):
    rows = [("/o/exp_3/stics_yearly_m1_150_2_3.nc",), ("/o/other.nc",)]
    got = values(rows, "p string", **gf.parse_output_name(F.col("p")))
    assert got == [("stics", "m1_150_2", 3), (None, None, None)]


def test_texture_and_variety(values):
    rows = [(1.0,), (12.0,), (13.0,), (None,)]
    assert values(rows, "c double", t=gf.texture_name(F.col("c"))) == [("clay",), ("sand",), (None,), (None,)]
    mapping = {"26.0": "a", "2.0": "b"}
    rows = [(25.999999996,), (2.0,), (3.0,)]
    assert values(rows, "c double", v=gf.map_variety(F.col("c"), mapping)) == [("a",), ("b",), (None,)]


@pytest.mark.parametrize(
    ("year", "sowing", "strict", "expected"),
    [
        (2000, 166, False, (136, 2000, 366)),
        (2000, 166, True, (136, 2001, 0)),
        (2001, 166, False, (136, 2002, 1)),
        (2001, 166, True, (136, 2002, 1)),
        (2000, 290, False, (260, 2001, 124)),
        (2001, 10, False, (1, 2001, 210)),
        (1900, 166, False, (136, 1901, 1)),
    ],
)
def test_sowing_window(values, year, sowing, strict, expected):
    window = gf.sowing_window(F.col("y"), F.col("s"), 30, 200, strict)
    got = values([(year, sowing)], "y int, s int", a=window.start_day, b=window.end_year, c=window.end_day)
    assert got == [expected]


def test_fixed_window(values):
    for start, end, strict, end_year in [(130, 290, False, 2000), (130, 290, True, 2001), (300, 60, False, 2001)]:
        window = gf.fixed_window(F.col("y"), start, end, strict)
        assert values([(2000,)], "y int", y=window.end_year) == [(end_year,)]


def test_later_year_dates(values):
    rows = [(2001010.0, 2000), (2000150.0, 2000), (None, 2000)]
    for strict, moved in [(False, 376.0), (True, 375.0)]:
        got = values(rows, "d double, ys int", d=gf.doy_from_sim_year(F.col("d"), F.col("ys"), strict))
        assert got == [(moved,), (150.0,), (None,)]


def test_season_wraps_the_year(values):
    rows = [(1999, 299), (1999, 300), (2000, 60), (2000, 61), (1999, 60)]
    got = values(rows, "y int, d int", ref=gf.season_year(F.col("y"), F.col("d"), F.lit(300), F.lit(60)))
    assert got == [(None,), (1999,), (1999,), (None,), (1998,)]
    inside = gf.in_season(F.col("y"), F.col("d"), F.lit(300), F.lit(60), F.lit(1999))
    assert values(rows, "y int, d int", i=inside) == [(False,), (True,), (True,), (False,), (False,)]
    unknown = gf.season_year(F.col("y"), F.col("d"), F.lit(None).cast("int"), F.lit(60))
    assert set(values(rows, "y int, d int", r=unknown)) == {(None,)}


def test_rounding_and_truncation(values):
    rows = [(0.25,), (0.35,), (-3.7,), (float("nan"),), (None,)]
    got = values(rows, "x double", r=gf.round_half_even(F.col("x"), 1), t=gf.trunc_int(F.col("x")))
    assert got[:3] == [(0.2, 0), (0.4, 0), (-3.7, -3)]
    assert got[3][1] is None
    assert got[4] == (None, None)


def test_fill_in_mask(values):
    rows = [(None, 1.0), (None, 0.0), (None, None), (2.0, 1.0)]
    got = values(rows, "x double, m double", v=gf.fill_in_mask(F.col("x"), F.col("m")))
    assert got == [(0.0,), (None,), (None,), (2.0,)]


def _ra(lat, doy):
    phi, turn = math.radians(lat), 2 * math.pi * doy / 365
    dec = 0.409 * math.sin(turn - 1.39)
    sunset = math.acos(-math.tan(phi) * math.tan(dec))
    part = sunset * math.sin(phi) * math.sin(dec) + math.cos(phi) * math.cos(dec) * math.sin(sunset)
    return 24 * 60 / math.pi * 0.082 * (1 + 0.033 * math.cos(turn)) * part


def _e(t):
    return 0.6108 * math.exp(17.27 * t / (t + 237.3))


def _et0(lat, alt, doy, tn, tx, tm, ea, wind, rg):
    gamma = 0.000665 * 101.3 * ((293 - 0.0065 * alt) / 293) ** 5.26
    delta = 4098 * _e(tm) / (tm + 237.3) ** 2
    ratio = min(max(rg / ((0.75 + 2e-5 * alt) * _ra(lat, doy)), 0), 1)
    rnl = 4.903e-9 * ((tn + 273.16) ** 4 + (tx + 273.16) ** 4) / 2
    rnl *= (1.35 * ratio - 0.35) * (0.34 - 0.14 * math.sqrt(ea))
    adv = gamma * 900 * wind * ((_e(tn) + _e(tx)) / 2 - ea) / (tm + 273)
    return (0.408 * delta * (0.77 * rg - rnl) + adv) / (delta + gamma * (1 + 0.34 * wind))


def test_reference_et(values):
    rows = [(14.5, 30, 200, 22.0, 34.0, 28.0, 19.0, 23.0, 60.0, 2.5, 21.0), (-33.0, 1200, 15, 9.0, 25.0, 17.0, 5.0, 8.0, 55.0, 4.0, 44.0)]
    names = "lat alt doy tn tx tm dn dx rh u rg".split()
    schema = ", ".join(f"{n} {'int' if n in ('alt', 'doy') else 'double'}" for n in names)
    c = {n: F.col(n) for n in names}
    first = [c[n] for n in ("lat", "alt", "doy", "tn", "tx", "tm")]
    got = values(
        rows,
        schema,
        dew=gf.et0_tdew(*first, c["dn"], c["dx"], c["u"], c["rg"]),
        hum=gf.et0_rhum(*first, c["rh"], c["u"], c["rg"]),
        guarded=gf.et0_tdew(*first, c["dn"], c["dx"], c["u"], c["rg"], guard=True, clip_low=False),
    )
    for row, (dew, hum, guarded) in zip(rows, got):
        lat, alt, doy, tn, tx, tm, dn, dx, rh, u, rg = row
        by_dew = _et0(lat, alt, doy, tn, tx, tm, (_e(dn) + _e(dx)) / 2, u, rg)
        assert dew == pytest.approx(by_dew, rel=1e-12)
        assert guarded == pytest.approx(by_dew, rel=1e-9)
        assert hum == pytest.approx(_et0(lat, alt, doy, tn, tx, tm, rh * (_e(tn) + _e(tx)) / 200, u, rg), rel=1e-12)


def test_reference_et_is_null_on_missing_input_and_polar_night(values):
    schema = "lat double, t double"
    args = lambda srad: (F.lit(10), F.lit(1), F.col("t"), F.col("t") + 8, F.col("t") + 4)
    et = gf.et0_tdew(F.col("lat"), *args(None), F.lit(1.0), F.lit(3.0), F.lit(2.0), F.lit(5.0))
    got = values([(10.0, None), (80.0, 5.0), (10.0, 5.0)], schema, et=et, ra=gf.ra(F.col("lat"), F.lit(1)), g=gf.ra(F.col("lat"), F.lit(1), True))
    assert got[0][0] is None
    assert got[1][0] is None and got[1][1] is None and got[1][2] is not None
    assert got[2][0] is not None


def test_no_clear_sky_radiation_gives_null(values):
    et = gf.agroclimate._penman_monteith(
        F.lit(0), F.col("t"), F.col("t"), F.col("t"), F.lit(1.0), F.lit(1.0), F.lit(1.0), F.lit(0.0), True
    )
    assert values([(10.0,)], "t double", et=et) == [(None,)]


def test_degree_day(values):
    rows = [(20.0,), (8.0,), (3.0,), (None,)]
    assert values(rows, "t double", d=gf.degree_day(F.col("t"), 8.0)) == [(12.0,), (0.0,), (0.0,), (0.0,)]
    with pytest.raises(ValueError):
        gf.degree_day(F.col("t"), -1.0)
