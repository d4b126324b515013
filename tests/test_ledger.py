"""Tables kept over time: repeated, broken and concurrent writes."""

import pytest
from pyspark.sql import functions as F

from gridagro.sources import ledger


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame([(y, f"p{i}", float(10 * y + i)) for y in (1999, 2000, 2001, 2003) for i in range(3)], "year int, idPoint string, rain double")


def back(spark, path, number=None):
    return sorted(map(tuple, ledger.read_versions(spark, path, number).select("year", "idPoint", "rain").collect()))


def of(df):
    return sorted(map(tuple, df.select("year", "idPoint", "rain").collect()))


def test_appending_twice_is_appending_once(spark, rows, tmp_path):
    path = str(tmp_path / "table")
    assert ledger.append_absent(rows, path, [1999, 2000]) == [1999, 2000]
    assert back(spark, path) == of(rows.filter("year <= 2000"))
    assert ledger.append_absent(rows, path, range(1999, 2004)) == [2001, 2002, 2003]
    assert ledger.append_absent(rows, path, range(1999, 2004)) == []
    assert back(spark, path) == of(rows)
    assert back(spark, path, 0) == of(rows.filter("year <= 2000"))
    assert ledger.read_versions(spark, path).columns == ["idPoint", "rain", "year"]


def test_only_absent_years_are_computed(spark, rows, tmp_path):
    path = str(tmp_path / "table")
    ledger.append_absent(rows, path, [1999])
    fails = rows.withColumn("rain", F.when(F.col("year") == 1999, F.raise_error(F.lit("computed again")).cast("double")).otherwise(F.col("rain")))
    ledger.append_absent(fails, path, [1999, 2000])
    assert back(spark, path) == of(rows.filter("year <= 2000"))


def test_a_job_killed_before_its_commit_leaves_the_old_state(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    ledger.append_absent(rows, path, [1999, 2000])
    before = back(spark, path)

    def killed(*_):
        raise KeyboardInterrupt

    for write in (lambda: ledger.append_absent(rows, path, [2001]), lambda: ledger.refresh(rows.limit(0), path, "year", [1999]), lambda: ledger.swap(rows.limit(1), path, "year")):
        with monkeypatch.context() as m:
            m.setattr(ledger, "_put", killed)
            with pytest.raises(KeyboardInterrupt):
                write()
        assert back(spark, path) == before
    bad = rows.withColumn("rain", F.raise_error(F.lit("died half-way")).cast("double"))
    with pytest.raises(Exception, match="died half-way"):
        ledger.append_absent(bad, path, [2001])
    assert back(spark, path) == before
    assert ledger.append_absent(rows, path, [2001]) == [2001]
    assert back(spark, path) == of(rows.filter("year <= 2001"))
    assert len(ledger.forget(spark, path)) >= 3 and ledger.forget(spark, path) == [] and back(spark, path) == of(rows.filter("year <= 2001"))


def test_a_refresh_shows_all_old_or_all_new_rows(spark, rows, tmp_path):
    path = str(tmp_path / "table")
    ledger.append_absent(rows, path, [1999, 2000, 2001, 2003])
    old = ledger.read_versions(spark, path)  # a reader that began before the refresh
    ledger.refresh(ledger.read_versions(spark, path).filter("idPoint <> 'p0'").withColumn("rain", F.col("rain") + 1), path, "year", [2000, 2003])
    assert of(old) == of(rows)
    changed = rows.withColumn("rain", F.col("rain") + 1).filter("year in (2000, 2003) and idPoint <> 'p0'")
    assert back(spark, path) == of(rows.filter("year in (1999, 2001)").union(changed))
    ledger.refresh(rows.limit(0), path, "year", [1999])
    assert 1999 not in {y for y, _, _ in back(spark, path)}
    ledger.refresh(rows.filter("year = 1999"), path, "year")
    assert 1999 in {y for y, _, _ in back(spark, path)}
    ledger.refresh(rows, path, "year", [])
    assert len(back(spark, path)) == 3 + 3 + 2 + 2


def test_two_writers_of_one_number(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    ledger.append_absent(rows, path, [1999])
    put, done = ledger._put, []

    def late(spark, path, new):
        if not done:  # somebody else commits the same year and another just before
            done.append(1)
            ledger.append_absent(rows.withColumn("rain", F.lit(7.0)), path, [2000, 2003])
        return put(spark, path, new)

    monkeypatch.setattr(ledger, "_put", late)
    ledger.append_absent(rows, path, [2000, 2001])
    got = back(spark, path)
    assert {r for y, _, r in got if y in (2000, 2003)} == {7.0} and len(got) == 12
    assert [(r.commit, r.n) for r in ledger.history(spark, path).groupBy("commit").agg(F.count("*").alias("n")).orderBy("commit").collect()] == [(0, 1), (1, 3), (2, 4)]


def test_swap_of_a_table_by_itself(spark, rows, tmp_path):
    path = str(tmp_path / "table")
    ledger.append_absent(rows, path, [1999, 2000])
    ledger.swap(ledger.read_versions(spark, path).withColumn("et", F.col("rain") / 2), path, "year")
    now = ledger.read_versions(spark, path)
    assert now.columns == ["idPoint", "rain", "et", "year"] and now.filter("et <> rain / 2").isEmpty() and now.count() == 6
    assert back(spark, path, 0) == of(rows.filter("year <= 2000"))
    with pytest.raises(ValueError, match="has the columns"):
        ledger.append_absent(rows, path, [2001])


def test_years_prune_folders_of_live_versions(spark, rows, tmp_path):
    path = str(tmp_path / "table")
    ledger.append_absent(rows, path, [1999, 2000])
    ledger.append_absent(rows, path, [2001, 2003])
    one = ledger.read_versions(spark, path).filter("year = 2001")
    one._jdf.collectToPython()
    scans = one._jdf.queryExecution().executedPlan().collectLeaves()
    assert scans.size() == 1
    assert scans.apply(0).metrics().apply("numPartitions").value() == 1


def test_odd_tables(spark, rows, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(ValueError, match="no commits"):
        ledger.read_versions(spark, path)
    assert ledger.append_absent(rows.limit(0), path, [1990]) == [1990] and back(spark, path) == []
    assert ledger.append_absent(rows, path, [1990]) == []
    text = spark.createDataFrame([("a b/c=é", 1), ("x", 2)], "Model string, v int")
    models = str(tmp_path / "models")
    ledger.refresh(text, models, "Model")
    ledger.refresh(text.filter("v = 1").withColumn("v", F.lit(5)), models, "Model")
    assert sorted((r.Model, r.v) for r in ledger.read_versions(spark, models).collect()) == [("a b/c=é", 5), ("x", 2)]
    with pytest.raises(Exception, match="belong to no partition"):
        ledger.refresh(spark.createDataFrame([(None, 1)], "Model string, v int"), models, "Model")
    with pytest.raises(ValueError, match="version"):
        ledger.swap(text.withColumn("Version", F.lit(1)), models, "Model")
