"""Readers. All are lazy scans with explicit schemas; none infers types from data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridagro.functions import parse_file_name, strict_cast
from gridagro.operators.filters import conform
from gridagro.operators.joins import lookup_join
from gridagro.operators.region import ring_edges
from gridagro.sources.schemas import POINTS, RAW_OUTPUT
from gridagro.sources.sinks import stored

#: Stands after the last field of a line while it is read, to tell how many there are; no field may be equal to it.
_END = "\x01end"


def read_cube(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """A cube for a range of years; only the partitions of those years are listed and read."""
    return spark.read.parquet(path).filter(F.col("year").between(first, last))


def files_by_pattern(df: DataFrame, pattern: str, path: str = "_metadata.file_path") -> DataFrame:
    """Rows whose file name matches ``pattern``, with the variable and years it names.

    Each name is parsed once, not for every row: the paths are found in a pass that reads no column, and
    both they and their names are stored, one row per file, as a condition on a name would be moved to the
    rows. Rows meet their names by the path.
    """
    placed = df.withColumn("__file", F.col(path))
    files = stored(placed.select("__file").distinct(), "files")
    names = stored(files.withColumns(parse_file_name(F.col("__file"), pattern)).filter(F.col("variable").isNotNull()), "names")
    return lookup_join(placed, names, ["__file"], "inner").drop("__file")


def _fields(line: Column, width: int) -> Column:
    """The fields of a CSV line and, after the last, _END; as an array that is filled up with NULL."""
    names = [f"c{i}" for i in range(width + 1)]
    read = F.from_csv(F.concat(line, F.lit(f",{_END}")), ", ".join(f"{name} string" for name in names))
    return F.array(*[read[name] for name in names])


def _by_header(spark: SparkSession, pattern: str, wanted: Sequence[str], skip_blank: bool = False) -> tuple[DataFrame, DataFrame]:
    """CSV files as one table of the ``wanted`` text columns, each file by its own header, and the table of headers.

    The files are scanned once for their first lines, which become a small table of one row per file
    with the positions of the wanted columns, and once for the rest, which meets its header by the
    file's path; no list of files or headers is gathered anywhere. Blank lines and lines that repeat
    the header are left out (with ``skip_blank`` also lines of blank fields only); a line with more or
    fewer fields than its header is an error.
    """
    lines = spark.read.text(pattern).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    lines = lines.filter(F.trim("value") != "")
    first = lines.filter("start = 0").withColumn("at", F.monotonically_increasing_id()).groupBy("file").agg(F.min_by("value", "at").alias("header"))
    first = stored(first, "headers")
    commas = F.length("header") - F.length(F.replace("header", F.lit(","), F.lit("")))
    width = (first.agg(F.max(commas)).first()[0] or 0) + 1  # one number: the most fields that a header can have
    fields = F.col("fields")
    names = F.transform(F.slice(fields, 1, F.array_position(fields, _END).cast("int") - 1), lambda name: F.trim(F.coalesce(name, F.lit(""))))
    headers = first.withColumn("fields", _fields(F.ltrim("header", F.lit("\ufeff")), width)).select("file", "header", names.alias("names"))
    placed = headers.select(
        "file", "header", F.size("names").alias("n"), F.array(*[F.coalesce(F.array_position("names", F.lit(name)).cast("int"), F.lit(0)) - 1 for name in wanted]).alias("at")
    )
    read = lines.drop("start").join(placed, "file", "left").filter("not value <=> header").withColumn("fields", _fields(F.col("value"), width + 1))
    problem = F.raise_error(F.concat(F.lit("not as many fields as in the header of "), F.col("file"), F.lit(": "), F.col("value"))).cast("boolean")
    read = read.filter(F.when(F.get("fields", F.col("n")) == _END, F.lit(True)).otherwise(problem))
    if skip_blank:
        read = read.filter(F.exists(F.slice(F.col("fields"), F.lit(1), F.col("n")), lambda x: F.coalesce(F.trim(x), F.lit("")) != ""))
    values = {name: F.when(F.get("at", F.lit(i)) >= 0, F.get("fields", F.get("at", F.lit(i)))) for i, name in enumerate(wanted)}
    return read.select(*[value.alias(name) for name, value in values.items()]), headers


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with columns lon and lat, found by its header; blank lines are skipped, unreadable values are an error."""
    points, headers = _by_header(spark, path, list(POINTS), skip_blank=True)
    known = headers.select(F.explode("names").alias("name")).filter(F.col("name").isin(*POINTS)).distinct().collect()
    missing = sorted(set(POINTS) - {row["name"] for row in known})
    if missing:
        raise ValueError(f"{path} has no column {missing}")
    return points.select(*[strict_cast(F.col(name), kind).alias(name) for name, kind in POINTS.items()])


def read_model_results(spark: SparkSession, pattern: str) -> DataFrame:
    """All result CSVs of a model as one table.

    The columns of a file are picked by the names of its own header, whatever their order; absent
    ones are NULL, blank values are NULL, and values that cannot be read are an error.
    """
    found, _ = _by_header(spark, pattern, list(RAW_OUTPUT))
    typed = {name: strict_cast(F.col(name), kind) for name, kind in RAW_OUTPUT.items() if kind != "string"}
    return conform(found.withColumns(typed), RAW_OUTPUT)


def read_result_table(spark: SparkSession, name: str) -> DataFrame:
    """A result table from the catalog."""
    return spark.table(name)


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """Edge table of the polygons in JSON lines ``{region_id, ring_id, ring: [{lon, lat}, …]}``.

    A malformed line is an error, as its region would be missing from every clip.
    """
    schema = "region_id long, ring_id long, ring array<struct<lon:double,lat:double>>"
    return ring_edges(spark.read.schema(schema).json(path, mode="FAILFAST"))
