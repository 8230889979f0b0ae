"""Dense surrogate keys without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

_POS = "_pos"
_SHIFT = 33  # monotonically_increasing_id keeps the partition number above bit 33


def assign_keys(df: DataFrame, order: list[Column | str], key: str, start: int | Column = 0) -> DataFrame:
    """Number rows ``start+1 .. start+n`` in the total order ``order``.

    The rows are range-partitioned and sorted in parallel and written once together with
    their position. Each partition's offset (one number per partition) enters the result as
    a constant, so it is a projection of the written rows and needs no copy of its own.
    ``order`` has to identify a row, so that a run of equal leading values can be split.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(ordered.withColumn(_POS, F.monotonically_increasing_id()), "keys", "zstd")
    part = F.shiftright(F.col(_POS), _SHIFT)
    sizes = {r["_part"]: r["_n"] for r in placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).collect()}
    # what position 0 of a partition stands for: the rows before it, less the partition's own first position
    offsets, before = [], 0
    for number in range(max(sizes, default=0) + 1):
        offsets.append(before - (number << _SHIFT))
        before += sizes.get(number, 0)
    first = F.get(F.array(*[F.lit(n).cast("long") for n in offsets]), part.cast("int"))
    number = (F.lit(start) if isinstance(start, int) else start) + first + F.col(_POS) + 1
    return placed.withColumn(key, number.cast("long")).drop(_POS)


def max_key(table: DataFrame, key: str) -> int:
    """Highest assigned key, ignoring the -1 member; 0 for an empty table."""
    return table.where(F.col(key) != -1).agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
