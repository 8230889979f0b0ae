"""Neighbour-row lookups that stay parallel when one key holds most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def neighbour(
    df: DataFrame, keys: list[str], order: list[str], values: dict[str, str], bucket: Column, *, ahead: bool = False
) -> DataFrame:
    """Add the previous (or next) row's values within ``keys`` in ``order``.

    Rows are windowed per (key, bucket), where ``bucket`` is any coarse, order-preserving
    function of the first order column; only one edge row per bucket is carried across
    bucket borders, so a hot key is spread over its buckets.
    """
    b, cell = "_bucket_no", "_edge"
    rows = df.withColumn(b, bucket)
    inner = W.partitionBy(*keys, b).orderBy(*order)
    pick = F.min_by if ahead else F.max_by
    shift = F.lead if ahead else F.lag
    cells = F.struct(*[F.col(source).alias(name) for name, source in values.items()])
    edges = rows.groupBy(*keys, b).agg(pick(cells, F.struct(*order)).alias(cell))
    across = edges.select(*keys, b, shift(cell).over(W.partitionBy(*keys).orderBy(b)).alias("_across"))
    placed = rows.withColumn("_within", shift(cells).over(inner)).join(across, [*keys, b])
    found = F.coalesce("_within", "_across")
    return placed.select(*df.columns, *[found[name].alias(name) for name in values])
