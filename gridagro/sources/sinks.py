"""Writers. One distributed write each; sub-domains and years are partitions, not jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridagro.functions import as_float, z_key
from gridagro.operators.filters import apply_mask
from gridagro.session import scratch_path

_CELL = ("lat", "lon")


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Replace or append to a table. A table derived from itself must go to a new path."""
    df.write.mode(mode).parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read back.

    For tables that many plans use. The copy outlives executors, cuts the lineage, and gives
    later joins the table's real size.
    """
    path = scratch_path(df.sparkSession, name)
    write_table(df, path)
    return df.sparkSession.read.parquet(path)


def save_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """``df`` as the catalog table ``name`` with its files at ``path``, which outlive the table; the stored table."""
    df.write.mode("overwrite").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def masked_with_snapshots(grid: DataFrame, mask: DataFrame, name: str, path: str) -> DataFrame:
    """``apply_mask`` that leaves the grid before and after it as the catalog tables ``<name>_before`` and ``<name>_after``.

    The mask is applied to the stored grid, so what produced the grid runs once.
    """
    before = save_table(grid, f"{name}_before", f"{path}/before")
    return save_table(apply_mask(before, mask), f"{name}_after", f"{path}/after")


def _clustered(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows gathered by output partition and sorted by cell.

    ``rebalance`` lets adaptive execution size the writing tasks: an output partition that holds
    most of the data is split over many of them, small ones share a task. The sort keeps the
    latitude and longitude ranges of row groups narrow for later box filters.
    """
    keys = [name for name in _CELL if name in df.columns]
    return df.hint("rebalance", *partitions).sortWithinPartitions(*partitions, *keys)


def _along_curve(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows in ranges of output partition and Z-order curve, one range per file, sorted along it.

    A file, and every page of it, covers a compact patch of cells with all their days, so the ranges
    of latitude and of longitude are both narrow. The days of a place on the curve may be cut too, so a
    place with most of the rows is no single file. Ranges are cut by a sample, for which Spark reads
    the input once more: write from a stored table.
    """
    curve = z_key(F.col("lat"), F.col("lon"))
    time = [name for name in ("time",) if name in df.columns]
    placed = df.withColumn("__curve", curve)
    return placed.repartitionByRange(*partitions, "__curve", *time).sortWithinPartitions(*partitions, "__curve", *time).drop("__curve")


def float32(df: DataFrame) -> DataFrame:
    """Double columns in single precision, except the coordinates."""
    doubles = [name for name, kind in df.dtypes if kind == "double" and name not in _CELL]
    return df.withColumns({name: as_float(F.col(name)) for name in doubles})


def split_by_year(cube: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Long form (variable, year, time, lat, lon, value) of a multi-year cube."""
    ids = [F.year("time").alias("year"), F.col("time"), F.col("lat"), F.col("lon")]
    return cube.select(*ids, *[F.col(name).cast("double").alias(name) for name in variables]).unpivot(
        ["year", "time", "lat", "lon"], list(variables), "variable", "value"
    )


def write_by_year(
    cube: DataFrame, path: str, variables: Sequence[str] | None = None, single: bool = False, z_order: bool = False
) -> None:
    """A cube partitioned by year, or by variable and year when ``variables`` are listed.

    The year is that of ``time``, or ``ref_year`` for grids per planting year. Rows are sorted by
    latitude, then longitude, so that bands of latitude prune row groups and pages; with ``z_order``
    along a Z-order curve of both, so that any small box does.
    """
    if variables is not None:
        out, partitions = split_by_year(cube, variables), ["variable", "year"]
    elif "ref_year" in cube.columns:
        out, partitions = cube.withColumnRenamed("ref_year", "year"), ["year"]
    else:
        out, partitions = cube.withColumn("year", F.year("time")), ["year"]
    out = float32(out) if single else out
    laid = _along_curve(out, partitions) if z_order else _clustered(out, partitions)
    laid.write.mode("overwrite").partitionBy(*partitions).parquet(path)


def replace_model(df: DataFrame, path: str, model: str | None = None) -> None:
    """Replace the rows of the models in ``df`` and leave those of other models alone.

    With ``model`` the rows of that model are replaced, by none if ``df`` has none.
    """
    if model is not None:
        df = df.filter(F.col("Model") == model)
        if df.isEmpty():
            _remove_partition(df.sparkSession, f"{path}/Model={model}")
            return
    (
        _clustered(df, ["Model"])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("Model")
        .parquet(path)
    )


def _remove_partition(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def write_scenarios(df: DataFrame, path: str, single: bool = False) -> None:
    """One cube per model and scenario; ``single`` stores values in single precision."""
    out = float32(df) if single else df
    partitions = ["model", "scenario"]
    _clustered(out, partitions).write.mode("overwrite").partitionBy(*partitions).parquet(path)
