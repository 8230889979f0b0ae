"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.session import in_scope, scratch_scope, stage

__all__ = ["in_bitmap", "held_out", "id_bitmap", "labelled_sample", "partitions", "settled", "ship", "stage", "table"]

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
BITMAP_BITS = 1 << 23
BATCH_ROWS = 1000
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where the checkout is visible to them.

    On a cluster without the checkout, pass the package with ``--py-files`` instead. Whole texts are
    long rows, so Arrow batches hold fewer of them than usual, and 4 MB unless the session says otherwise.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, "4m")
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, env.get("PYTHONPATH", "")]))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids whose labels are never learned from; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """``doc_id, text, y`` of at most ``most`` labelled rows outside the held-out fifth, one row an id.

    Ids are ranked by their hash, so the sample doesn't depend on partitioning; of the texts of a
    repeated id the one of the smallest hash counts. The size is bounded by ``most`` whatever is
    repeated, so the sample may be broadcast.
    """
    picked = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
    return rows.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("y").alias("y"))


def id_bitmap(ids: DataFrame, column: str) -> bytes:
    """A one-hash filter over the ids, of one fixed size (1 MB) whatever their number.

    It has no false negatives; users join the exact ids afterwards. Bitmap positions start at 1.
    """
    slot = F.pmod(F.xxhash64(column), F.lit(BITMAP_BITS)) + 1
    rows = (ids.select(slot.alias("slot"))
            .groupBy(F.bitmap_bucket_number("slot").alias("part"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect())
    out = bytearray(BITMAP_BITS // 8)
    for r in rows:
        at = (r["part"] - 1) * 4096
        out[at:at + 4096] = bytes(r["bits"])
    return bytes(out)


def in_bitmap(column: str) -> Column:
    """The place of an id in ``id_bitmap``, for the test inside a task."""
    slot = F.pmod(F.xxhash64(column), F.lit(BITMAP_BITS)) + 1
    return ((F.bitmap_bucket_number(slot) - 1) * 32768 + F.bitmap_bit_position(slot)).cast("long")


def settled(spark: SparkSession, work: Callable[[], DataFrame], label: str) -> DataFrame:
    """The table of ``work()``, written in the caller's scope; what ``work`` staged on the way is deleted."""
    keep = in_scope(stage)
    with scratch_scope(spark):
        return keep(work(), label)


def first_of(items: Iterable, default=None):
    return next(iter(items), default)
