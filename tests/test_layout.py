"""The Z-order layout of cubes: the key itself, and what a box has to read."""

import random

import pytest
from pyspark.sql import functions as F

from gridagro import functions as gf
from gridagro.operators.filters import clip_bbox
from gridagro.sources import scan, sinks


def interleaved(lat, lon):
    y, x = int((min(max(lat, -90), 90) + 90) * 3600), int((min(max(lon, -180), 360) + 180) * 3600)
    return sum((x >> k & 1) << 2 * k | (y >> k & 1) << 2 * k + 1 for k in range(22))


def test_key_interleaves_the_bits(values):
    rnd = random.Random(4)
    rows = [(rnd.uniform(-90, 90), rnd.uniform(-180, 360)) for _ in range(300)] + [(90.0, 360.0), (-90.0, -180.0), (95.0, 400.0), (0.0, 0.0)]
    got = values(rows, "lat double, lon double", key=gf.z_key(F.col("lat"), F.col("lon")))
    assert [k for (k,) in got] == [interleaved(*r) for r in rows]
    assert values([(None, 1.0), (1.0, None)], "lat double, lon double", key=gf.z_key(F.col("lat"), F.col("lon"))) == [(None,), (None,)]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """One year of 160 x 160 cells in both layouts, in pages as small for it as usual ones are for a real cube."""
    spark.conf.set("parquet.page.row.count.limit", "2000")
    cells = spark.range(160 * 160).select((F.floor(F.col("id") / 160) * 0.05 + 10).alias("lat"), (F.col("id") % 160 * 0.05 - 17).alias("lon"))
    days = cells.select(F.explode(F.sequence(F.to_date(F.lit("2001-01-01")), F.to_date(F.lit("2001-01-12")))).alias("time"), "lat", "lon", (F.col("lat") * F.col("lon")).alias("tmax"))
    paths = {}
    for z in (False, True):
        paths[z] = str(tmp_path_factory.mktemp("layout") / "cube")
        sinks.write_by_year(days, paths[z], z_order=z)
    spark.conf.unset("parquet.page.row.count.limit")
    return days, paths


def scanned(df):
    """Rows that the scan hands on after row groups and pages were left out."""
    df._jdf.collectToPython()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()


def test_both_layouts_hold_the_same_rows(spark, stored):
    days, paths = stored
    for path in paths.values():
        back = scan.read_cube(spark, path, 2001, 2001).drop("year").select(*days.columns)
        assert back.exceptAll(days).isEmpty() and back.count() == days.count()


@pytest.mark.parametrize("box, share", [((-14.0, -90.0, -13.6, 90.0), 0.3), ((-14.0, 12.0, -13.6, 12.4), 0.08), ((-180.0, 12.0, 360.0, 12.4), 0.3)])
def test_a_box_reads_few_pages(spark, stored, box, share):
    days, paths = stored
    n = days.count()
    reads = {z: scanned(clip_bbox(scan.read_cube(spark, path, 2001, 2001), *box)) for z, path in paths.items()}
    assert reads[True] <= share * n
    if box[1] == -90.0:  # a strip of longitude: only the curve helps
        assert reads[False] > 0.95 * n > 3 * reads[True]


def test_key_names_each_coordinate_few_times():
    """Shifts and masks on one name doubled it in each step: some hundred copies of each coordinate, evaluated for every row."""
    text = str(gf.z_key(F.col("lat"), F.col("lon")))
    assert text.count("lat") <= 3 and text.count("lon") <= 3


def test_one_cell_is_cut_by_its_days(spark, tmp_path):
    """A place on the curve with all the rows is no single file: cells beyond 90 share one latitude on it."""
    days = spark.range(20_000).select(F.expr("date_add(date'2001-01-01', cast(id % 365 as int))").alias("time"), F.lit(95.0).alias("lat"), F.lit(1.0).alias("lon"), F.col("id").alias("v"))
    path = str(tmp_path / "cube")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sinks.write_by_year(days, path, z_order=True)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    back = spark.read.parquet(path)
    assert back.count() == 20_000 and back.select("_metadata.file_path").distinct().count() > 1
