"""Effective-dated and plain dimension key lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..session import WIDE, by_count

UNKNOWN = -1


def as_of_lookup(
    rows: DataFrame, dim: DataFrame, id_col: str, on_date: str | Column, key: str, out: str | None = None,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """Add the key of the dimension version whose window [valid_from, valid_to) holds ``on_date``.

    The equality on the durable id makes this an ordinary hash or sort-merge join with a
    residual range predicate. No hint is given: Spark broadcasts the four projected
    columns when their size allows it and otherwise shuffles, where AQE splits hot ids.
    ``wanted`` may hold the ids at hand (staged rows with the id column): the dimension is
    then cut to them by a semi join first, so a small reload does not shuffle a large dimension.
    """
    out = out or key
    ident = F.col(id_col)
    durable = F.col("source_record_id")
    if isinstance(rows.schema[id_col].dataType, IntegralType):
        # numbers stay numbers, so rows already partitioned by the id are not shuffled again
        durable, ident = durable.try_cast("bigint"), ident.cast("bigint")
    when = F.col(on_date) if isinstance(on_date, str) else on_date
    d = dim.select(
        durable.alias("_id"),
        F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
        F.col(key).alias("_key"),
    )
    if wanted is not None:
        d = d.join(by_count(wanted.select(ident.alias("_id")), times=WIDE), "_id", "left_semi")
    inside = (when >= F.col("_from")) & ((when < F.col("_to")) | F.col("_to").isNull())
    return (
        rows.join(d, (ident == F.col("_id")) & inside, "left")
        .withColumn(out, F.coalesce("_key", F.lit(UNKNOWN)).cast("bigint"))
        .drop("_id", "_from", "_to", "_key")
    )


def key_lookup(rows: DataFrame, dim: DataFrame, left: str | Column, natural: str, key: str, out: str | None = None) -> DataFrame:
    """Add the key of the row whose natural key equals ``left``; unmatched rows get -1."""
    out = out or key
    value = F.col(left) if isinstance(left, str) else left
    d = dim.select(F.col(natural).alias("_nk"), F.col(key).alias("_key"))
    return (
        rows.join(d, value == F.col("_nk"), "left")
        .withColumn(out, F.coalesce("_key", F.lit(UNKNOWN)).cast("bigint"))
        .drop("_nk", "_key")
    )
