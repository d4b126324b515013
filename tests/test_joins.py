"""Split joins and products: same rows as the plain forms, with hot keys and repeated rows."""

from math import sqrt

import pytest
from pyspark.sql import functions as F

from gridagro.operators import joins
from gridagro.operators.joins import grid_product, lookup_join, product_shape


def _bag(df):
    return sorted(tuple("" if v is None else str(v) for v in row) for row in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("multiplied", [False, True])
def test_split_join_equals_plain_join(spark, how, multiplied):
    facts = spark.range(400).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 17).alias("k"), (F.col("id") % 50).alias("t")
    )
    facts = facts.unionByName(facts.limit(0)).unionByName(spark.createDataFrame([(None, 1), (99, 2)], "k long, t long"))
    lookup = spark.createDataFrame([(i, f"v{i}") for i in range(12)], "k long, v string")
    plain = facts.join(lookup, ["k"], how)
    assert _bag(lookup_join(facts, lookup, ["k"], how, spread=["t"], splits=8, multiplied=multiplied)) == _bag(plain)


def test_hot_key_is_shared(spark):
    facts = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("t"))
    lookup = spark.createDataFrame([(1, "v")], "k int, v string")
    with_parts = lookup_join(facts, lookup, ["k"], "inner", spread=["t"], splits=8, multiplied=True)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        assert with_parts.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    finally:
        spark.conf.unset(merging)


def test_unknown_join_type(spark):
    with pytest.raises(ValueError):
        lookup_join(spark.range(1), spark.range(1), ["id"], "right")


def test_product(spark):
    cells = spark.range(23).select((F.col("id") * 0.5).alias("lat"), F.lit(1.0).alias("lon"))
    table = spark.range(9).select(F.col("id").alias("m"))
    product = grid_product(cells, table)
    assert product.columns == ["lat", "lon", "m"]
    assert product.distinct().count() == product.count() == 23 * 9
    plan = product._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_product_with_empty_side(spark):
    cells = spark.createDataFrame([], "lat double, lon double")
    assert grid_product(cells, spark.range(3)).count() == 0


def _shuffled(df):
    """Rows that the exchanges of a query that has run have written."""
    plan, total = df._jdf.queryExecution().executedPlan().finalPhysicalPlan(), 0
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        stage = leaves.apply(i)
        if "Shuffle" in stage.nodeName():
            total += stage.plan().metrics().apply("shuffleRecordsWritten").value()
    return total


def _sides(spark, n, m):
    cells = spark.range(n).select((F.col("id") * 0.5).alias("lat"), F.lit(1.0).alias("lon"))
    return cells, spark.range(m).select((F.col("id") % 700).alias("m"), F.lit("x").alias("kind"))


@pytest.mark.parametrize(("n", "m"), [(900, 900), (100, 1600), (1600, 100)])
def test_two_sided_product_shuffles_the_square_root(spark, n, m):
    slots = 64
    cells, table = _sides(spark, n, m)
    product = grid_product(cells, table, slots=slots, sizes=(n, m))
    rows = product.collect()
    assert len(rows) == n * m
    assert _bag(product.groupBy("m").count()) == _bag(table.crossJoin(cells).groupBy("m").count())
    assert len({(r.lat, r.m) for r in rows}) == n * min(m, 700)
    assert _shuffled(product) <= 1.1 * 2 * sqrt(slots * n * m)


def test_large_tables_are_measured(spark, monkeypatch):
    cells, table = _sides(spark, 400, 400)
    monkeypatch.setattr(joins, "FEW", 1000)
    measured = grid_product(cells, table, slots=16)
    assert measured.count() == 400 * 400
    assert measured.rdd.getNumPartitions() == 16
    measured.collect()
    monkeypatch.setattr(joins, "FEW", 1_000_000)
    repeated = grid_product(cells, table, slots=16)
    repeated.collect()
    assert _shuffled(measured) == 2 * 4 * 400 and _shuffled(repeated) == 17 * 400
    assert _bag(measured) == _bag(repeated)


def test_shape_of_a_product():
    assert product_shape(64, 1000, 1000) == (8, 8)
    assert product_shape(64, 10**6, 10) == (64, 1)
    assert product_shape(64, 1, 10**6) == (1, 64)
    assert product_shape(200, 0, 0) == (200, 1)
    assert product_shape(1, 5, 5) == (1, 1)
