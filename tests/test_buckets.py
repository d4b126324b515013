"""Bucketed cubes: same rows as the shuffled way, no exchange, repeated coordinates refused."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from gridagro.operators import cube as cubes
from gridagro.sources import buckets


@pytest.fixture()
def saved(spark, tmp_path):
    def save(*parts, n=6):
        names = []
        for part in parts:
            names.append(f"t_{uuid.uuid4().hex}")
            buckets.save_bucketed(part, names[-1], str(tmp_path / names[-1]), n)
        return names

    yield save
    for table in spark.catalog.listTables():
        if table.name.startswith("t_"):
            spark.sql(f"drop table {table.name}")


@pytest.fixture()
def parts(spark):
    rows = [(dt.date(y, 12, d), 10 + i * 0.05, -17 + j * 0.05, y + d + i / 7, None if (i + j) % 5 == 0 else float(j)) for y in (1999, 2000, 2001) for d in (1, 31) for i in range(7) for j in range(5)]
    cube = spark.createDataFrame(rows, "time date, lat double, lon double, tmax double, wind double")
    shaky = cube.select("time", (F.col("lat") + 1e-9).alias("lat"), "lon", F.when(F.col("wind") == 2, float("nan")).otherwise(F.col("wind")).alias("wind"))
    return [cube.select("time", "lat", "lon", "tmax"), shaky, cube.filter("lat > 10.1").select("time", "lat", "lon", F.col("tmax").alias("wind"), F.lit(1).alias("k"))]


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and not a.isEmpty()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_same_rows_as_the_shuffled_way(spark, parts, saved):
    names = saved(*parts)
    years = [part.filter(F.year("time").between(1999, 2000)) for part in parts]
    for k in (1, 2, 3):
        aligned = buckets.align_bucketed(spark, names[:k], 1999, 2000)
        assert same(cubes.align_variables(years[:k]), aligned)
    assert aligned.columns == ["time", "lat", "lon", "tmax", "wind", "k"]
    assert buckets.align_bucketed(spark, names, 1950, 1960).isEmpty()


def test_no_exchange_and_pruned_years(spark, parts, saved):
    plan = plan_of(buckets.align_bucketed(spark, saved(*parts), 2000, 2001))
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 3 and "PartitionFilters: [isnotnull(year" in plan
    assert "Exchange" in plan_of(cubes.align_variables(parts))


def test_repeated_coordinates_are_refused(spark, parts, saved):
    twice = parts[0].union(parts[0].limit(2))
    assert same(cubes.align_variables([parts[0]]), buckets.align_bucketed(spark, saved(twice), 1999, 2001))
    differ = parts[0].union(parts[0].limit(1).withColumn("tmax", F.lit(-1.0)))
    with pytest.raises(Exception, match="different rows at .* 10.0 -17.0"):
        buckets.align_bucketed(spark, saved(parts[1], differ), 1999, 2001).collect()
    with pytest.raises(Exception, match="no time, latitude"):
        saved(parts[0].withColumn("lat", F.lit(None).cast("double")))


def test_tables_with_other_buckets_still_align(spark, parts, saved):
    assert same(cubes.align_variables(parts), buckets.align_bucketed(spark, saved(*parts[:2]) + saved(parts[2], n=3), 1999, 2001))
