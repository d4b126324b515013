"""Model outputs and mosaics on hand-made rows."""

import pytest

from gridagro.operators.aggregates import duplicate_keys, first_non_null, mean_yield_map
from gridagro.plans import mosaic as mosaics, outputs
from gridagro.sources.schemas import OUTPUT_VALUES, RAW_OUTPUT, ddl


def _raw(spark, **changes):
    row = {**dict.fromkeys(OUTPUT_VALUES, 5.0), "Model": "x", "Idsim": "1.5_2.5_2000_m1_2", "Texte": "t", "time": 2000, "lat": 1.5, "lon": -99.0, **changes}
    return spark.createDataFrame([tuple(row[n] for n in RAW_OUTPUT)], ddl(RAW_OUTPUT))


def test_dssat_cleaning(spark):
    raw = _raw(spark, Planting=2000150.0, Mat=2001010.0, Ant=-99.0, Yield=2500.0, Biom_ma=-4.0, SoilN=-1.0)
    row = outputs.normalise_dssat(raw).first()
    assert (row.Planting, row.Mat, row.Ant, row.Yield, row.Biom_ma, row.SoilN) == (150.0, 376.0, None, 2.5, None, None)
    assert (row.Model, row.scenario, row.lon, row.time) == ("Dssat", "m1_2", -99.0, 2000)
    assert outputs.normalise_dssat(raw, strict=True).first().Mat == 375.0


def test_nan_is_missing(spark):
    nan = float("nan")
    row = outputs.normalise_dssat(_raw(spark, Mat=nan, Yield=nan, SoilN=nan)).first()
    assert (row.Mat, row.Yield, row.SoilN) == (None, None, None)
    assert outputs.normalise_stics(_raw(spark, Yield=nan)).first().Yield is None


def test_stics_keeps_values(spark):
    row = outputs.normalise_output(_raw(spark, Yield=-99.0), "stics").first()
    assert (row.Model, row.Yield, row.scenario) == ("Stics", -99.0, "m1_2")


def test_celsius_is_renamed_and_parsed(spark):
    names = ["idsim", *[n for n in outputs.CELSIUS_FIELDS if n != "idsim"]]
    schema = ", ".join(f"`{n}` {'string' if n == 'idsim' else 'double'}" for n in names)
    raw = spark.createDataFrame([("14.0_-16.275_1999_m1_150_2", *[float(i) for i in range(1, len(names))])], schema)
    row = outputs.normalise_celsius(raw).first()
    assert (row.lat, row.lon, row.time, row.scenario, row.Model, row.Texte) == (14.0, -16.275, 1999, "m1_150_2", "Celsius", "")
    assert row.Yield == float(names.index("Grain(nrec)")) and row.Nleac is None


def test_replace_model_rows(spark):
    table = spark.createDataFrame([("A", 1), ("B", 2), (None, 3)], "Model string, v int")
    fresh = spark.createDataFrame([("B", 9)], "Model string, v int")
    got = outputs.replace_model_rows(table, fresh, "B")
    assert sorted(r.v for r in got.collect()) == [1, 3, 9]


@pytest.fixture()
def parts(spark):
    rows = [
        ("m", "s", 2000, 1.0, 1.0, 2, 5.0),
        ("m", "s", 2000, 1.0, 1.0, 0, None),
        ("m", "s", 2000, 1.0, 1.0, 1, 6.0),
        ("m", "s", 2000, 1.0, 2.0, 0, None),
        ("m", "s", 2001, 1.00000001, 2.0, 0, 3.3),
        ("m", "s", 2001, 9.0, 9.0, 0, 1.0),
    ]
    return spark.createDataFrame(rows, "model string, scenario string, time int, lat double, lon double, subdomain int, Yield double")


def test_overlap_takes_lowest_subdomain_with_a_value(parts):
    merged = first_non_null(parts, ["model", "scenario", "time", "lat", "lon"])
    assert {(r.time, r.lon): r.Yield for r in merged.collect()}[2000, 1.0] == 6.0
    assert [(r.time, r.lon, r.n) for r in duplicate_keys(parts).collect()] == [(2000, 1.0, 3)]


def test_mosaic_covers_the_grid(spark, parts):
    grid = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "lat double, lon double")
    mask = spark.createDataFrame([(1.0, 2.0, 1.0), (1.0, 3.0, 0.0)], "lat double, lon double, mask double")
    plain = {(r.time, r.lon): r.Yield for r in mosaics.mosaic(parts, grid).collect()}
    assert plain == {(2000, 1.0): 6.0, (2000, 2.0): None, (2000, 3.0): None, (2001, 1.0): None, (2001, 2.0): pytest.approx(3.3), (2001, 3.0): None}
    masked = mosaics.mosaic(parts, grid, mask)
    assert dict(masked.dtypes)["Yield"] == "float"
    assert {(r.time, r.lon): r.Yield for r in masked.collect()}[2000, 2.0] == 0.0


def test_mosaic_of_disjoint_blocks_is_the_input(spark):
    rows = [("m", "s", 2000, 1.0, float(i), i % 3, float(i)) for i in range(12)]
    blocks = spark.createDataFrame(rows, "model string, scenario string, time int, lat double, lon double, subdomain int, Yield double")
    grid = blocks.select("lat", "lon")
    got = sorted((r.lon, r.Yield) for r in mosaics.mosaic(blocks, grid).collect())
    assert got == [(float(i), float(i)) for i in range(12)]


def test_mean_map(spark):
    rows = [("m", "s", y, 1.0, 1.0, v) for y, v in ((2010, 100.0), (2011, 2.0), (2012, None), (2013, 4.0), (2014, float("nan")))]
    table = spark.createDataFrame(rows, "model string, scenario string, time int, lat double, lon double, Yield double")
    row = mean_yield_map(table, 2011, 2020).first()
    assert (row.mean_Yield, row.n_years) == (3.0, 2)
