"""Readers and writers, written and read back."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridagro.sources import scan, sinks, types


@pytest.fixture()
def cube(spark):
    rows = [(dt.date(y, 1, d), float(d), 1.0, y + d / 7, 1.0 * d) for y in (1999, 2000, 2001) for d in range(1, 6)]
    return spark.createDataFrame(rows, "time date, lat double, lon double, tmax double, tmin double")


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_years_are_partitions(spark, cube, tmp_path):
    path = str(tmp_path / "cube")
    sinks.write_by_year(cube, path)
    back = scan.read_cube(spark, path, 1999, 2000)
    assert _same(cube.filter(F.year("time") <= 2000), back.drop("year"))
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert (tmp_path / "cube" / "year=2001").is_dir()


def test_variables_are_partitions(spark, cube, tmp_path):
    path = str(tmp_path / "vars")
    sinks.write_by_year(cube, path, ["tmax", "tmin"], single=True)
    back = spark.read.parquet(path)
    assert dict(back.dtypes)["value"] == "float" and back.count() == 30
    assert sorted(p.name for p in (tmp_path / "vars").iterdir() if p.is_dir()) == ["variable=tmax", "variable=tmin"]


def test_model_replacement_leaves_others_alone(spark, tmp_path):
    path = str(tmp_path / "summary")
    schema = "Model string, lat double, lon double, v int"
    sinks.replace_model(spark.createDataFrame([("A", 1.0, 1.0, 1), ("B", 1.0, 1.0, 2), ("B", 2.0, 1.0, 3)], schema), path)
    sinks.replace_model(spark.createDataFrame([("B", 1.0, 1.0, 9)], schema), path)
    sinks.replace_model(spark.createDataFrame([("B", 1.0, 1.0, 9)], schema), path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 9]


def test_scenarios(spark, tmp_path):
    rows = [("m", f"s{i % 2}", 2000, 1.0, float(i), i / 3) for i in range(6)]
    table = spark.createDataFrame(rows, "model string, scenario string, time int, lat double, lon double, Yield double")
    path = str(tmp_path / "out")
    sinks.write_scenarios(table, path)
    assert _same(table, spark.read.parquet(path))


def test_tables(spark, cube, tmp_path):
    path = str(tmp_path / "table")
    sinks.write_table(cube, path)
    sinks.write_table(cube, path)
    assert spark.read.parquet(path).count() == 15
    sinks.write_table(cube, path, "append")
    assert spark.read.parquet(path).count() == 30


def test_masking_leaves_both_snapshots_in_the_catalog(spark, tmp_path):
    import uuid

    grid = spark.createDataFrame([(1.0, 1.0, 5), (1.0, 2.0, 6), (2.0, 1.0, 7)], "lat double, lon double, v int")
    mask = spark.createDataFrame([(1.0, 1.0, 1.0), (1.0, 2.0, 0.0), (2.0, 1.0, None)], "lat double, lon double, mask double")
    name = f"s_{uuid.uuid4().hex}"
    for _ in range(2):  # a second run replaces both
        assert [r.v for r in sinks.masked_with_snapshots(grid, mask, name, str(tmp_path / "s")).collect()] == [5]
    assert sorted(r.v for r in spark.table(f"{name}_before").collect()) == [5, 6, 7]
    assert [r.v for r in scan.read_result_table(spark, f"{name}_after").collect()] == [5]
    for stage in ("before", "after"):
        spark.sql(f"drop table {name}_{stage}")
    assert spark.read.parquet(str(tmp_path / "s" / "before")).count() == 3


def test_points_skip_blank_lines(spark, tmp_path):
    file = tmp_path / "points.csv"
    file.write_text("lon,lat\n-16.125,16.175\n-16.275,14.125\n\n\n")
    assert [tuple(r) for r in scan.read_points(spark, str(file)).collect()] == [(-16.125, 16.175), (-16.275, 14.125)]


def test_points_are_found_by_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("lat,name,lon\n16.175,x,-16.125\n,,\n")
    (tmp_path / "b.csv").write_text("lon,lat\n1,2\n")
    assert sorted(tuple(r) for r in scan.read_points(spark, str(tmp_path / "*.csv")).collect()) == [(-16.125, 16.175), (1.0, 2.0)]
    (tmp_path / "c.csv").write_text("lon,lat\nbad,3\n")
    with pytest.raises(Exception, match="not readable as double: bad"):
        scan.read_points(spark, str(tmp_path / "c.csv")).collect()
    (tmp_path / "d.csv").write_text("x,lat\n1,3\n")
    with pytest.raises(ValueError, match="lon"):
        scan.read_points(spark, str(tmp_path / "d.csv"))


def test_result_files_are_matched_by_header(spark, tmp_path):
    from gridagro.sources.schemas import RAW_OUTPUT

    for n in range(2):
        names = [name for name in (RAW_OUTPUT if n else reversed(RAW_OUTPUT)) if name != "Nleac"]
        row = ",".join({"string": f"t{n}", "int": "2000", "double": "1.5"}[RAW_OUTPUT[name]] for name in names)
        (tmp_path / f"{n}_stics.csv").write_text(",".join(names) + "\n" + row + "\n")
    back = scan.read_model_results(spark, str(tmp_path / "*_stics.csv"))
    assert back.count() == 2 and back.columns == list(RAW_OUTPUT)
    assert dict(back.dtypes) == RAW_OUTPUT
    assert back.select(F.sum("Yield"), F.count("Nleac"), F.max("time")).first()[:] == (3.0, 0, 2000)
    assert {r.Idsim for r in back.collect()} == {"t0", "t1"}
    (tmp_path / "2_stics.csv").write_text("Idsim,Yield\nt2,****\n")
    with pytest.raises(Exception, match="not readable as double"):
        scan.read_model_results(spark, str(tmp_path / "*_stics.csv")).collect()


def test_lines_that_do_not_fit_their_header(spark, tmp_path):
    read = lambda: sorted(map(tuple, scan.read_points(spark, str(tmp_path / "*.csv")).collect()))
    (tmp_path / "a.csv").write_text('\ufefflon ,"lat",note\r\n1,2,"x, ""y"""\r\n\r\n , ,\r\nlon ,"lat",note\n3,4,\n')
    (tmp_path / "b c=é.csv").write_text("\n\nnote,more,lat,lon\nx,,6,5\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "bare.csv").write_text("lat,lon\n")
    assert read() == [(1.0, 2.0), (3.0, 4.0), (5.0, 6.0)]
    for line in ("7,8", "7,8,x,", '7,8,"open'):
        (tmp_path / "z.csv").write_text(f"lon,lat,note\n{line}\n")
        with pytest.raises(Exception, match="not as many fields"):
            read()
    (tmp_path / "z.csv").write_text("lon,note\n9,x\n")  # a file without one of the columns
    assert sorted(map(str, scan.read_points(spark, str(tmp_path / "z.csv").replace("z", "[abz]")).collect())) == ["Row(lon=1.0, lat=2.0)", "Row(lon=3.0, lat=4.0)", "Row(lon=9.0, lat=None)"]


def test_many_small_files_of_different_headers(spark, tmp_path):
    """One scan of the lines, which meet their headers in a join; nothing is gathered in one group."""
    import random

    rnd = random.Random(1)
    for n in range(1500):
        names = ["lon", "lat", *[f"v{i}" for i in range(rnd.randrange(4))]]
        rnd.shuffle(names)
        row = {"lon": n / 10, "lat": n / 20}
        (tmp_path / f"p{n}.csv").write_text(",".join(names) + "\n" + ",".join(str(row.get(name, "x")) for name in names) + "\n")
    points = scan.read_points(spark, str(tmp_path / "*.csv"))
    plan = points._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in points.collect()} == {(n / 10, n / 20) for n in range(1500)}
    assert plan.count("FileScan text") == 1 and "collect_list" not in plan and "Window" not in plan


def test_files_by_pattern(spark, cube, tmp_path):
    for name in ("tas_global_daily_1995_2001", "notes"):
        cube.coalesce(1).write.parquet(str(tmp_path / "in" / name))
    back = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    pattern = r"([^/_]+)_global_daily_([0-9]{4})_([0-9]{4})/"
    named = scan.files_by_pattern(back, pattern)
    assert {(r.variable, r.first_year, r.last_year) for r in named.collect()} == {("tas", 1995, 2001)}
    assert named.count() == 15


def test_regions(spark, tmp_path):
    file = tmp_path / "regions.json"
    file.write_text('{"region_id": 1, "ring_id": 0, "ring": [{"lon": 0, "lat": 0}, {"lon": 1, "lat": 0}, {"lon": 0, "lat": 1}]}\n')
    got = sorted(tuple(r) for r in scan.read_regions(spark, str(file)).collect())
    assert got == [(1, 0.0, 0.0, 1.0, 0.0), (1, 0.0, 1.0, 0.0, 0.0), (1, 1.0, 0.0, 0.0, 1.0)]
    with file.open("a") as more:
        more.write('{"region_id": 2, "ring_id": 0, "ring": [{"lon": 0, "lat"\n')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        scan.read_regions(spark, str(file)).collect()


def test_declared_types(spark):
    table = spark.createDataFrame([("", "", "x", ""), ("2.5", "7", "", "1")], "a string, b string, c string, d string")
    declared = {"a": "REAL", "b": "Counter(4)", "c": "VARCHAR(10)", "d": "bit"}
    got = types.apply_declared_types(table, declared)
    assert [tuple(r) for r in got.collect()] == [(None, None, "x", None), (2.5, 7.0, "", True)]
    assert types.declared_kind("double (8)") == "Number" and types.declared_kind("DateTime") == "datetime"
    for unknown in ("blob", "varchar(", "12"):
        with pytest.raises(ValueError):
            types.declared_kind(unknown)
    with pytest.raises(Exception, match="not readable as double: x"):
        types.apply_declared_types(table, {"c": "integer"}).collect()


def test_empty_refresh_clears_its_model(spark, tmp_path):
    path = str(tmp_path / "summary")
    rows = spark.createDataFrame([("A", 1), ("B", 2)], "Model string, v int")
    sinks.replace_model(rows, path)
    sinks.replace_model(rows.limit(0), path, "B")
    assert [tuple(r) for r in spark.read.parquet(path).select("Model", "v").collect()] == [("A", 1)]
    sinks.replace_model(rows.limit(0), path, "C")


def test_parts_with_different_rows_at_a_coordinate_are_refused(spark):
    from gridagro.operators.cube import combine_by_coords, repeated_coordinates

    schema = "time int, lat double, lon double, u int, v int"
    good = spark.createDataFrame([(1, 1.0, 1.0, 5, 1), (1, 1.0, 1.0, 5, 1), (2, 1.0, 1.0, None, 2)], schema)
    assert sorted(map(str, combine_by_coords([good]).collect())) == sorted(map(str, good.distinct().collect()))
    bad = spark.createDataFrame([(1, 1.0, 1.0, 5, 1), (1, 1.0, 1.0, 1, 9)], schema)
    assert [tuple(r) for r in repeated_coordinates(bad).collect()] == [(1, 1.0, 1.0, 2)]
    with pytest.raises(Exception, match="different rows at 1 1.0 1.0"):
        combine_by_coords([good.drop("v"), bad]).collect()


def test_metres_are_refused(spark):
    from gridagro.operators.partition import assign_subdomain

    with pytest.raises(Exception, match="not in degrees"):
        assign_subdomain(spark.createDataFrame([(5000.0, 1.0, 1.0)], "lat double, lon double, mask double"), 2).collect()


def test_grids_by_planting_year(spark, tmp_path):
    gdd = spark.createDataFrame([(2000, 1.0, 1.0, 2.5), (2001, 1.0, 1.0, 3.5)], "ref_year int, lat double, lon double, gdd double")
    sinks.write_by_year(gdd, str(tmp_path / "gdd"))
    assert {(r.year, r.gdd) for r in scan.read_cube(spark, str(tmp_path / "gdd"), 2001, 2001).collect()} == {(2001, 3.5)}
