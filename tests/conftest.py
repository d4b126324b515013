import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridagro import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session.LOCAL_SETTINGS["spark.sql.shuffle.partitions"] = "4"
    active = session.local_session("4", "tests")
    active.sparkContext.setLogLevel("ERROR")
    yield active
    active.stop()


@pytest.fixture()
def values(spark):
    """Evaluate columns over rows: ``values(rows, schema, **columns)`` gives a list of tuples."""

    def run(rows, schema, **columns):
        df = spark.createDataFrame(rows, schema)
        return [tuple(row) for row in df.select(*[c.alias(n) for n, c in columns.items()]).collect()]

    return run
