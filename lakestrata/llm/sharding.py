"""Uniform shuffle into shards of exact sizes through a communication matrix.

1. The rows of each source partition are counted.
2. How many rows partition p sends to shard s is drawn from the multivariate
   hypergeometric distribution: partition after partition from what the shards still
   need. Row sums are the partition sizes, column sums the shard sizes, exactly.
3. Each source task permutes its own rows at random and deals them by its matrix row.
   A shard's rows are dealt at random over cells of bounded size, so a shard of any size
   is put in order by many tasks.
4. Rows are exchanged by (shard, cell) and permuted again there by their random keys;
   cells follow each other, so slots run from 0 without gaps.

The law is ``rows``: shard sizes differ by one at most. Every draw comes from the seed and
the partition number, so a task that runs again deals alike; a task that finds another
number of rows than was counted fails instead of dealing wrongly, and such an input has to
be written first (``stage``).

Defined cases: null ids and texts are rows as others; repeated rows are dealt each; an
input column named ``shard`` or ``slot`` is replaced; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, lgamma, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship

SHARDS = 24
SEED = 20250131
CELL_ROWS = 1 << 14
LARGE = 1_000_000_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Good ones among n drawn; beyond the library's range by inversion from the mode outwards."""
    if good + bad < LARGE:
        return int(rng.hypergeometric(good, bad, n))
    lo, hi = max(0, n - bad), min(n, good)
    mode = min(hi, max(lo, (n + 1) * (good + 1) // (good + bad + 2)))

    def lc(a: int, b: int) -> float:
        return lgamma(a + 1) - lgamma(b + 1) - lgamma(a - b + 1)

    up = down = exp(lc(good, mode) + lc(bad, n - mode) - lc(good + bad, n))
    u, a, b = rng.random() - up, mode, mode
    while u > 0 and (a > lo or b < hi):
        if b < hi:
            up *= (good - b) / (b + 1) * (n - b) / (bad - n + b + 1)
            b += 1
            u -= up
            if u <= 0:
                return b
        if a > lo:
            down *= a / (good - a + 1) * (bad - n + a) / (n - a + 1)
            a -= 1
            u -= down
            if u <= 0:
                return a
        if up + down < 1e-300 and abs(b - mode) > 60 * (1 + sqrt(n)):
            break
    return mode


def matrix(sizes: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows from each partition to each shard, with exact sums both ways."""
    rng = np.random.default_rng([seed, len(sizes)])
    total = sum(sizes)
    need = [total // shards + (s < total % shards) for s in range(shards)]
    out = np.zeros((len(sizes), shards), np.int64)
    for p, n in enumerate(sizes):
        rest = sum(need)
        for s in range(shards):
            if not n:
                break
            rest -= need[s]
            k = hypergeometric(rng, need[s], rest, n)
            out[p, s] = k
            need[s] -= k
            n -= k
    return out


def deal(seed: int, p: int, row: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shard, cell and random key of each row of partition p, in the order of its rows."""
    rng = np.random.default_rng([seed, p])
    shard = rng.permutation(np.repeat(np.arange(len(row), dtype=np.int32), row))
    cell = (rng.random(len(shard)) * cells[shard]).astype(np.int32)
    return shard, cell, rng.integers(0, 1 << 62, len(shard))


def uniform_shards(df: DataFrame, shards: int = SHARDS, seed: int = SEED, cell_rows: int = CELL_ROWS) -> DataFrame:
    """The rows of ``df`` with ``shard`` and ``slot``; every column of ``df`` goes along."""
    spark = ship(df.sparkSession)
    df = df.drop("shard", "slot")
    found = {r["p"]: r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()}
    sizes = [found.get(p, 0) for p in range(max(found, default=-1) + 1)]
    table = matrix(sizes, shards, seed)
    cells = np.maximum(1, -(-table.sum(axis=0) // cell_rows))
    plan = spark.sparkContext.broadcast((table, cells))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, own = plan.value
        for batch in batches:
            for p in batch.column(0).to_pylist():
                shard, cell, _ = deal(seed, p, rows[p], own)
                pair, n = np.unique(shard.astype(np.int64) << 32 | cell, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array((pair >> 32).astype(np.int32)), pa.array(pair.astype(np.int32)),
                                                  pa.array(n)], names=["_shard", "_cell", "size"])

    sums = (spark.range(len(sizes)).mapInArrow(counted, "_shard int, _cell int, size long")
            .groupBy("_shard", "_cell").agg(F.sum("size").alias("size")))
    before = sums.select("_shard", "_cell", (F.sum("size").over(
        Window.partitionBy("_shard").orderBy("_cell")) - F.col("size")).alias("_before"))

    schema = T.StructType([*df.schema.fields, T.StructField("_shard", T.IntegerType()),
                           T.StructField("_cell", T.IntegerType()), T.StructField("_key", T.LongType())])
    names = schema.names

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, own = plan.value
        p = TaskContext.get().partitionId()
        row = rows[p] if p < len(rows) else np.zeros(shards, np.int64)
        shard, cell, key = deal(seed, p, row, own)
        at = 0
        for batch in batches:
            s = slice(at, at + batch.num_rows)
            at += batch.num_rows
            if at > len(shard):
                break
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x[s]) for x in (shard, cell, key))], names=names)
        if at != len(shard):
            raise RuntimeError(f"partition {p} changed between two reads: write the input first")

    within = F.row_number().over(Window.partitionBy("_shard", "_cell").orderBy("_key"))
    out = df.mapInArrow(dealt, schema).withColumn("_within", within).join(before, ["_shard", "_cell"])
    return out.select(*df.columns, F.col("_shard").alias("shard"), (F.col("_before") + F.col("_within") - 1).alias("slot"))
