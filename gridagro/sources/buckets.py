"""Variables of a cube as bucketed catalog tables, put side by side without a shuffle.

Each variable is stored once in buckets of (cell, time). Tables with the same buckets are combined
bucket by bucket: neither the check for repeated coordinates nor the joins need an exchange, in every run
and for every range of years. The cell is a whole number, as Spark does not keep
the partitioning of floating-point keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridagro.operators.cube import CUBE, merged_parts
from gridagro.operators.filters import CELL, nulls_for_nans, snapped

#: Steps per degree of the common lattice of cells.
_LATTICE = 10_000
_KEYS = ("cell", "time")


def save_bucketed(cube: DataFrame, name: str, path: str, buckets: int) -> None:
    """Store a cube as the catalog table ``name`` with its files at ``path``, by year, in buckets of (cell, time).

    Tables to be combined need the same number of buckets: about the rows of a variable in all years
    that are read together, divided by what a task can sort. Each bucket of a year is one file. Rows
    without a coordinate are refused, NaN is stored as NULL.
    """
    known = snapped(cube)
    problem = F.raise_error(F.lit("a row has no time, latitude or longitude")).cast("boolean")
    known = known.filter(F.when(F.col("time").isNull() | F.col("lat").isNull() | F.col("lon").isNull(), problem).otherwise(F.lit(True)))
    step = lambda c: F.round(F.col(c) * _LATTICE).cast("long")
    placed = nulls_for_nans(known).withColumns({"cell": F.shiftleft(step("lat"), 32) + step("lon"), "year": F.year("time")})
    (
        placed.repartition(buckets, *_KEYS)
        .sortWithinPartitions("year", *_KEYS)
        .write.partitionBy("year")
        .bucketBy(buckets, *_KEYS)
        .sortBy(*_KEYS)
        .option("path", path)
        .saveAsTable(name)
    )


def align_bucketed(spark: SparkSession, names: Sequence[str], first: int, last: int) -> DataFrame:
    """``align_variables`` of the years ``first`` to ``last`` of tables by ``save_bucketed``, without a shuffle.

    Only the partitions of those years are read. Rows that a table has twice count once; different
    rows of one table at one coordinate are an error. Tables with other numbers of buckets are
    aligned too, but shuffled.
    """
    aligned, taken = None, set()
    for name in names:
        part = spark.table(name).filter(F.col("year").between(first, last)).drop("year")
        once = merged_parts([part], _KEYS, carried=CELL)
        new = [c for c in once.columns if c not in (*_KEYS, *CELL) and c not in taken]
        if aligned is not None and not new:
            continue
        taken.update(new)
        complete = once.na.drop("any", subset=new) if new else once
        # the merge join keeps to the buckets; a broadcast would send a whole variable to every executor
        aligned = complete.select(*_KEYS, *CELL, *new) if aligned is None else aligned.join(complete.select(*_KEYS, *new).hint("merge"), list(_KEYS))
    return aligned.drop("cell").select(*CUBE, *[c for c in aligned.columns if c not in (*CUBE, "cell")])
