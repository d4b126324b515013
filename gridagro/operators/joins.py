"""Joins that stay balanced when a few keys hold most of the rows.

Nothing here forces a broadcast. Spark compares the estimated size of a side with
``spark.sql.autoBroadcastJoinThreshold`` and broadcasts it only below that; adaptive execution
repeats the check on measured sizes. The salts below carry the other case.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, functions as F

#: Parts of a key in joins whose keys can be hot; a cell or a point cannot, having one row per day.
HOT_SPLITS = 8

#: Copies of a table in a product up to which its other side need not be counted.
FEW = 1_000_000

_PART = "__part"
_SLOT = "__slot"


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    spread: Sequence[str] = (),
    splits: int = 1,
    multiplied: bool = False,
) -> DataFrame:
    """Join a fact table to a much smaller keyed one; ``how`` must keep the fact side.

    With more than one of ``splits`` the rows of a key are split over as many parts by a hash of the
    ``spread`` columns and the lookup rows are repeated once per part, so a hot key is shared by several tasks. The
    hash depends on the row alone: a recomputed task sends every row to the same place. If Spark
    finds the lookup small enough to broadcast, the copies hold ``splits`` times its rows.

    ``multiplied`` marks facts that were just unfolded by an explode. Spark takes such a table to
    be as small as before and could broadcast it, so a merge join is asked for.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    keys = list(keys)
    added = [name for name in lookup.columns if name not in keys] if how in ("inner", "left") else []
    columns = [*facts.columns, *added]
    if spread and splits > 1:
        part = F.pmod(F.xxhash64(*spread), F.lit(splits)).cast("int")
        facts = facts.withColumn(_PART, part)
        lookup = lookup.withColumn(_PART, F.explode(F.array(*[F.lit(i) for i in range(splits)])))
        keys.append(_PART)
    if multiplied:
        lookup = lookup.hint("merge")
    return facts.join(lookup, keys, how).select(*columns)


def product_shape(slots: int, cells: int, table: int) -> tuple[int, int]:
    """Rows and columns of the matrix of about ``slots`` tasks that makes a product of two sides with the fewest copies.

    A cell is sent to all tasks of its row and a table row to all of its column, so cells x columns +
    table x rows are shuffled. That is least where both are equal, about 2 sqrt(slots x cells x table).
    """
    columns = round(sqrt(slots * table / max(cells, 1)))
    columns = min(max(columns, 1), slots)
    return ceil(slots / columns), columns


def grid_product(
    cells: DataFrame,
    table: DataFrame,
    spread: Sequence[str] = ("lat", "lon"),
    slots: int | None = None,
    sizes: tuple[int, int] | None = None,
) -> DataFrame:
    """Every cell with every row of ``table``, as an equi-join.

    The product is the result itself (management per cell, time slices per cell). Tasks form a
    matrix of about ``slots`` (``spark.sql.shuffle.partitions`` by default): cells are hashed to its
    rows by ``spread``, the table to its columns by all it holds, and each is repeated along the other
    side, so that each task has an even share of the product. A table that gives at most ``FEW`` rows
    when repeated in all slots is (one column); beyond that both sides are counted, unless ``sizes``
    tells their numbers of rows, and the matrix is the one with the fewest copies.

    Tasks are partitions of a fixed number: they are not merged for being small, as it is the
    output that is large. A merge join streams the cells past the rows of the task and spills, so no
    side has to fit in memory.
    """
    if slots is None:
        slots = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if sizes is not None:
        rows, columns = product_shape(slots, *sizes)
    elif table.limit(FEW // slots + 1).count() <= FEW // slots:
        rows, columns = slots, 1
    else:
        rows, columns = product_shape(slots, cells.count(), table.count())

    def share(names: Sequence[str], parts: int) -> Column:
        return F.pmod(F.xxhash64(*names), F.lit(parts)).cast("int")

    def every(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    row = share(spread, rows)
    placed = cells.withColumn(_SLOT, row) if columns == 1 else cells.withColumn(_PART, every(columns)).withColumn(_SLOT, row * columns + F.col(_PART)).drop(_PART)
    column = share(table.columns, columns) if columns > 1 else F.lit(0)
    repeated = table.withColumn(_PART, every(rows)).withColumn(_SLOT, F.col(_PART) * columns + column).drop(_PART)
    placed, repeated = placed.repartitionById(rows * columns, _SLOT), repeated.repartitionById(rows * columns, _SLOT)
    return placed.join(repeated.hint("merge"), _SLOT).drop(_SLOT)
