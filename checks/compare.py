"""Run queries in Spark and their SQL in DuckDB and compare schema, rows and values.

python -m checks.compare <sf_dir> [query …]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

from checks import catalog
from gridagro.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return value
    return str(value)


def bag(rows, names) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, con, name: str, sf_dir: str) -> tuple[int, str]:
    """Number of rows and a description of the first difference, empty if there is none."""
    df = catalog.QUERIES[name](spark, sf_dir)
    ours = bag(df.collect(), df.columns)
    if name not in catalog.ORACLE:
        return sum(ours.values()), ""
    relation = con.execute(catalog.ORACLE[name])
    names = [column[0] for column in relation.description]
    theirs = bag(relation.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return sum(ours.values()), f"columns {sorted(df.columns)} != {sorted(names)}"
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        return sum(ours.values()), (
            f"rows {sum(ours.values())} / {sum(theirs.values())}, columns {sorted(names)}\n"
            f"   only Spark {sum(extra.values())}: {list(extra)[:2]}\n   only SQL {sum(missing.values())}: {list(missing)[:2]}"
        )
    return sum(ours.values()), ""


def main(sf_dir: str, names: list[str]) -> int:
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names or catalog.QUERIES:
        begin = time.time()
        try:
            rows, problem = differences(spark, con, name, sf_dir)
        except Exception as error:  # a failing query must not hide the others
            rows, problem = 0, f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:32s} {rows:8d} rows {time.time() - begin:6.2f}s {problem}", flush=True)
    print(f"{len(names or catalog.QUERIES)} queries, {bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
