"""Every registered query against its SQL on the smallest tables, and the shape of its plan."""

import os

import pytest

from checks import catalog
from checks.compare import connect, differences
from gridagro.plans.units import order_units

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_matches_sql(spark, duck, name):
    rows, problem = differences(spark, duck, name, SF)
    assert not problem


def test_every_query_has_sql():
    assert set(catalog.ORACLE) == set(catalog.QUERIES)


@pytest.mark.parametrize("name", ["et0_tdew", "thermal_time", "sim_units", "mosaic_masked", "nearest_cells", "region_cells_touched", "season_climate"])
def test_plan_has_no_product_and_no_python(spark, name):
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert node not in plan


def test_cell_joins_hold_the_lookup_once(spark):
    """The daily table meets the cells in one broadcast of the cells, and without broadcasts in one shuffle by cell."""
    plan = lambda name: catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "explode(array(0, 1" not in plan("et0_tdew") and "explode(array(0, 1" not in plan("apply_mask")
    assert "Generate explode(sequence" in plan("season_climate") and "holding" not in plan("season_climate")


def test_rows_come_in_order(spark):
    cells = [(r.lat, r.lon) for r in catalog.QUERIES["row_major"](spark, SF).collect()]
    assert cells == sorted(cells) and len(cells) > 5
    units = spark.createDataFrame([(f"p{i % 3}", f"m{i % 5}", "s", 2000 - i % 7, i % 2) for i in range(60)], "idPoint string, idMangt string, IdSoil string, StartYear int, idOption int")
    ordered = [tuple(r) for r in order_units(units).collect()]
    assert ordered == sorted(ordered)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(catalog.ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())
