"""Declared column types of exported tables."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from gridagro.functions import strict_cast

# Families of declared types and the kind of column each stands for.
FAMILIES = {
    "Number": ("smallint", "integer", "float", "double", "real", "counter"),
    "Text": ("text", "varchar", "timestamp"),
    "bit": ("bit",),
    "datetime": ("datetime", "time"),
}

_SPARK_TYPES = {"Number": "double", "bit": "boolean", "datetime": "timestamp"}
_DECLARED = re.compile(r"\s*([a-z]+)\s*(?:\(\s*\d+(?:\s*,\s*\d+)*\s*\))?\s*", re.IGNORECASE)


def declared_kind(declared: str) -> str:
    """Number, Text, bit or datetime for a declared type: a name with or without length, as ``varchar(20)``."""
    parsed = _DECLARED.fullmatch(declared)
    for kind, names in FAMILIES.items():
        if parsed and parsed[1].lower() in names:
            return kind
    raise ValueError(f"unknown column type {declared!r}")


def _typed(value: Column, kind: str) -> Column:
    return value.cast("string") if kind == "Text" else strict_cast(value, _SPARK_TYPES[kind])


def apply_declared_types(df: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """Columns cast to their declared types. Blank text is NULL but in text columns; unreadable text is an error."""
    return df.select(
        *[
            _typed(F.col(name), declared_kind(declared[name])).alias(name) if name in declared else F.col(name)
            for name in df.columns
        ]
    )
