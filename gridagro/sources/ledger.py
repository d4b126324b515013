"""Tables kept over time: versions of partitions, and a ledger that says which of them count.

A table is a folder. ``data/version=…/<key>=…/`` holds the files of each write, ``_ledger/`` one small
JSON file per commit, which names for each value of the partition column (a year, a model) the version
whose files count. A write first puts its files into a version of its own, then commits. The commit is
one rename of a finished file to the next number, which fails if that number is taken; so a reader sees
all of a write or nothing, a write that dies leaves the table as it was, and of two writers of the same
number one starts its commit over.

Readers ask the ledger once, when their DataFrame is made, and then scan the files of that state only;
the partition column prunes as usual. What no commit names any more stays until ``forget`` is called.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

_DATA, _LEDGER = "data", "_ledger"
_VERSION = "version"
#: Commits that may come between before a writer gives up.
TRIES = 100


class State(NamedTuple):
    """A commit: its number, the partition column, the columns, and the version of each live value.

    A version is None for a value that is known to have no rows.
    """

    number: int
    key: str
    schema: str
    live: dict[str, str | None]


def _hadoop(spark: SparkSession, path: str):
    """The file context of a path and the path itself."""
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    there = fs.Path(path)
    return fs.FileContext.getFileContext(there.toUri(), spark.sparkContext._jsc.hadoopConfiguration()), there


def _numbers(spark: SparkSession, path: str) -> list[int]:
    context, folder = _hadoop(spark, f"{path}/{_LEDGER}")
    if not context.util().exists(folder):
        return []
    names = [status.getPath().getName() for status in context.util().listStatus(folder)]
    return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())


def state(spark: SparkSession, path: str, number: int | None = None) -> State | None:
    """The latest commit, or that of a number; None for a table without commits."""
    if number is None:
        numbers = _numbers(spark, path)
        if not numbers:
            return None
        number = numbers[-1]
    text = spark.read.text(f"{path}/{_LEDGER}/{number:010d}.json", wholetext=True).first()[0]
    return State(number, **json.loads(text))


def _put(spark: SparkSession, path: str, new: State) -> bool:
    """Write a commit under its number; False if the number is taken."""
    context, final = _hadoop(spark, f"{path}/{_LEDGER}/{new.number:010d}.json")
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    draft = fs.Path(final.getParent(), f".{uuid.uuid4().hex}")
    stream = draft.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(draft)
    stream.write(bytearray(json.dumps({"key": new.key, "schema": new.schema, "live": new.live}), "utf-8"))
    stream.close()
    options = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 1)
    options[0] = getattr(fs, "Options$Rename").NONE
    try:
        context.rename(draft, final, options)
    except Exception:
        if not context.util().exists(final):
            raise
        context.delete(draft, False)
        return False
    return True


def commit(spark: SparkSession, path: str, key: str, schema: str, change: Callable[[dict[str, str | None]], dict[str, str | None]]) -> State:
    """Commit ``change`` of the live versions; after a commit of somebody else it is asked again."""
    for _ in range(TRIES):
        old = state(spark, path)
        if old is not None and (old.key, _names(old.schema)) != (key, _names(schema)):
            raise ValueError(f"{path} has the columns {_names(old.schema)} by {old.key}, not {_names(schema)} by {key}")
        new = State(old.number + 1 if old else 0, key, schema, change(dict(old.live) if old else {}))
        if _put(spark, path, new):
            return new
    raise RuntimeError(f"{path} is committed to all the time by others")


def _names(schema: str) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in StructType.fromJson(json.loads(schema))]


def _written(df: DataFrame, path: str, key: str) -> str:
    """``df`` as files of a new version, by partition and sorted by cell; the version's name."""
    version = uuid.uuid4().hex
    cell = [name for name in ("lat", "lon") if name in df.columns]
    (
        df.filter(F.when(F.col(key).isNull(), F.raise_error(F.lit(f"rows without {key} belong to no partition")).cast("boolean")).otherwise(F.lit(True)))
        .hint("rebalance", key)
        .sortWithinPartitions(key, *cell)
        .write.mode("errorifexists")
        .partitionBy(key)
        .parquet(f"{path}/{_DATA}/{_VERSION}={version}")
    )
    return version


def _values(spark: SparkSession, path: str, key: str, version: str) -> list[str]:
    """The partitions of a version, by its folders alone."""
    context, folder = _hadoop(spark, f"{path}/{_DATA}/{_VERSION}={version}")
    escaped = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    names = [status.getPath().getName() for status in context.util().listStatus(folder)]
    return [escaped.unescapePathName(name[len(key) + 1 :]) for name in names if name.startswith(f"{key}=")]


def _ordered(df: DataFrame, key: str) -> DataFrame:
    if key not in df.columns:
        raise ValueError(f"no column {key}")
    if _VERSION in {name.lower() for name in df.columns}:
        raise ValueError(f"{_VERSION} names the folders of versions and cannot be a column")
    return df.select(*[name for name in df.columns if name != key], key)


def append_absent(df: DataFrame, path: str, values: Sequence, key: str = "year") -> list:
    """Add those of the partitions ``values`` that the table does not have yet; returns them.

    Only they are computed: the filter on ``key`` goes down to the sources of ``df``. Values without
    rows are remembered as such. A repeated run does nothing. Where another writer has committed a
    value meanwhile, its rows stay.
    """
    spark, df = df.sparkSession, _ordered(df, key)
    old = state(spark, path)
    absent = [value for value in dict.fromkeys(values) if old is None or str(value) not in old.live]
    if not absent:
        return []
    version = _written(df.filter(F.col(key).isin(*absent)), path, key)
    have = set(_values(spark, path, key, version))
    mine = {str(value): version if str(value) in have else None for value in absent}
    commit(spark, path, key, df.schema.json(), lambda live: mine | live)
    return absent


def refresh(df: DataFrame, path: str, key: str, values: Sequence | None = None) -> None:
    """Replace whole partitions in one step: those of ``values``, or those that ``df`` has rows of.

    A value of ``values`` without rows in ``df`` is left empty; rows of other values are not written.
    ``df`` may be computed from the table itself.
    """
    spark, df = df.sparkSession, _ordered(df, key)
    if values is not None:
        df = df.filter(F.col(key).isin(*values)) if values else df.limit(0)
    version = _written(df, path, key)
    have = _values(spark, path, key, version)
    gone = {} if values is None else {str(value): None for value in values}
    commit(spark, path, key, df.schema.json(), lambda live: live | gone | dict.fromkeys(have, version))


def swap(df: DataFrame, path: str, key: str) -> None:
    """Replace the whole table by ``df``, which may be computed from it and have other columns."""
    spark, df = df.sparkSession, _ordered(df, key)
    version = _written(df, path, key)
    new = dict.fromkeys(_values(spark, path, key, version), version)
    for _ in range(TRIES):
        numbers = _numbers(spark, path)
        if _put(spark, path, State(numbers[-1] + 1 if numbers else 0, key, df.schema.json(), new)):
            return
    raise RuntimeError(f"{path} is committed to all the time by others")


def read_versions(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table as of its latest commit, or of the commit ``number``.

    One scan of the live versions. Values of the partition column prune folders at planning, also
    in filters on top of the result.
    """
    at = state(spark, path, number)
    if at is None:
        raise ValueError(f"{path} has no commits")
    schema = StructType.fromJson(json.loads(at.schema))
    by_version: dict[str, list[str]] = {}
    for value, version in at.live.items():
        if version is not None:
            by_version.setdefault(version, []).append(value)
    if not by_version:
        return spark.createDataFrame([], schema)
    stored = StructType.fromJson(json.loads(at.schema)).add(_VERSION, "string")
    found = spark.read.schema(stored).option("basePath", f"{path}/{_DATA}").parquet(*[f"{path}/{_DATA}/{_VERSION}={v}" for v in sorted(by_version)])
    kind = schema[at.key].dataType
    live = F.lit(False)
    for version, values in sorted(by_version.items()):
        live = live | ((F.col(_VERSION) == version) & F.col(at.key).isin(*[F.lit(value).cast(kind) for value in values]))
    return found.filter(live).select(*schema.names)


def history(spark: SparkSession, path: str) -> DataFrame:
    """The ledger as a table: commit, partition value, version (NULL: no rows)."""
    lines = spark.read.text(f"{path}/{_LEDGER}/*.json", wholetext=True).select("value", F.col("_metadata.file_name").alias("file"))
    live = F.from_json(F.get_json_object("value", "$.live"), "map<string, string>")
    return lines.select(F.regexp_extract("file", r"^(\d+)", 1).cast("int").alias("commit"), F.explode(live).alias("value", "version"))


def forget(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete the commits before the last ``keep`` and the versions that none of these names; returns the versions.

    Readers of older commits and writers that have not committed yet lose their files, so call it when
    there are none.
    """
    numbers = _numbers(spark, path)
    kept = [state(spark, path, number) for number in numbers[-keep:]]
    named = {version for at in kept for version in at.live.values()}
    context, folder = _hadoop(spark, f"{path}/{_DATA}")
    gone = [status.getPath() for status in context.util().listStatus(folder) if status.getPath().getName().removeprefix(f"{_VERSION}=") not in named]
    for number in numbers[:-keep]:
        context.delete(_hadoop(spark, f"{path}/{_LEDGER}/{number:010d}.json")[1], False)
    for version in gone:
        context.delete(version, True)
    return [version.getName().removeprefix(f"{_VERSION}=") for version in gone]
