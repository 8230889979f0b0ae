"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the smallest node reachable from each node that has an edge.

    Each round takes the smallest label among the neighbours and then the label of that
    label, so the rounds grow with the logarithm of the longest path. Labels are written
    to the shared folder each round; no edge or label goes to the driver. Edges with a
    null end are ignored; no edges give no rows.
    """
    both = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    both = stage(both.select(F.col(a).alias("u"), F.col(b).alias("v"))
                 .union(both.select(F.col(b).alias("u"), F.col(a).alias("v"))).distinct(), "edges")
    labels = stage(both.groupBy(F.col("u").alias("node"))
                   .agg(F.least(F.min("v"), F.first("u")).alias("component")), "labels")
    while True:
        near = (both.join(labels, both.v == labels.node).groupBy(F.col("u").alias("node"))
                .agg(F.min("component").alias("near")))
        step = (labels.join(near, "node")
                .select("node", F.col("component").alias("old"), F.least("component", "near").alias("mid")))
        jump = step.select(F.col("node").alias("mid"), F.col("mid").alias("far"))
        new = stage(step.join(jump, "mid", "left")
                    .select("node", "old", F.least("mid", F.coalesce("far", "mid")).alias("component")), "labels")
        if not new.where(F.col("component") != F.col("old")).limit(1).count():
            return new.select("node", "component")
        labels = new.select("node", "component")
