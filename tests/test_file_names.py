"""File names are parsed once per file, not for every row."""

from pyspark.sql import functions as F

from gridagro.sources import scan


def test_names_are_parsed_in_a_table_of_files(spark, tmp_path):
    for name in ("tas_global_daily_1995_2001", "pr_global_daily_1990_1994", "notes"):
        spark.range(50).write.parquet(str(tmp_path / "in" / name))
    found = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "in")).filter("id % 5 = 3")
    named = scan.files_by_pattern(found, r"([^/_]+)_global_daily_([0-9]{4})_([0-9]{4})/")
    got = {(r.variable, r.first_year, r.last_year): r.n for r in named.groupBy("variable", "first_year", "last_year").agg(F.count("*").alias("n")).collect()}
    assert got == {("tas", 1995, 2001): 10, ("pr", 1990, 1994): 10} and named.columns == ["id", "variable", "first_year", "last_year"]
    assert "regexp_extract" not in named._jdf.queryExecution().optimizedPlan().toString()
