"""Batch ledger: which load ran when, with what outcome and which high-water mark.

Every state change is one immutable JSON file, so runs never rewrite shared state and a
crash cannot lose an earlier entry. The current state of a batch is its newest entry.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .files import Files

BATCH_ID_WIDTH = 50
MESSAGE_WIDTH = 2000
NEVER = "1900-01-01 00:00:00"

LEDGER_SCHEMA = (
    "batch_key bigint, batch_id string, source_system string, target_table string, load_type string, "
    "watermark_column string, watermark_value_start string, watermark_value_end string, batch_status string, "
    "batch_start_timestamp timestamp_ntz, batch_end_timestamp timestamp_ntz, rows_extracted bigint, "
    "rows_inserted bigint, rows_updated bigint, rows_deleted bigint, rows_rejected bigint, "
    "error_message string, retry_count int, initiated_by string"
)

_clock_lock = threading.Lock()
_last_micros = 0


def next_micros() -> int:
    """Wall clock in microseconds, strictly increasing within this process."""
    global _last_micros
    with _clock_lock:
        _last_micros = max(_last_micros + 1, time.time_ns() // 1000)
        return _last_micros


def build_batch_id(target: str) -> str:
    """``<target>:<micros>``; a long target loses its tail, never the unique suffix."""
    suffix = f":{next_micros()}"
    return target[: BATCH_ID_WIDTH - len(suffix)] + suffix


@dataclass(frozen=True)
class Batch:
    key: int
    id: str
    row: dict


def utc_now() -> str:
    return datetime.now(UTC).replace(tzinfo=None).isoformat(sep=" ", timespec="microseconds")


class Ledger:
    def __init__(self, spark: SparkSession, root: str, clock: Callable[[], str] = utc_now):
        self.spark = spark
        self.dir = f"{root.rstrip('/')}/audit/etl_batch_control"
        self.files = Files(spark, root)
        self.clock = clock
        self.keys = f"{root.rstrip('/')}/audit/etl_batch_keys"
        self._lock = threading.Lock()
        self._last_key: int | None = None

    def _next_key(self) -> int:
        """A number no other ledger of this store has: whoever makes its file first owns it."""
        with self._lock:
            if self._last_key is None:
                taken = [n[:12] for folder in (self.dir, self.keys) for n in self.files.names(folder)]
                self._last_key = max((int(n) for n in taken if n.isdigit()), default=0)
            while True:
                self._last_key += 1
                if self.files.reserve(f"{self.keys}/{self._last_key:012d}"):
                    return self._last_key

    def _put(self, row: dict) -> None:
        seq = next_micros()
        body = json.dumps({**row, "entry_seq": seq}) + "\n"
        self.files.create_text(f"{self.dir}/{row['batch_key']:012d}-{seq}.json", body)

    def start(
        self, target: str, source_system: str, load_type: str, *, initiated_by: str,
        watermark_column: str | None = None, watermark_start: str | None = None,
    ) -> Batch:
        key = self._next_key()
        row = {
            "batch_key": key,
            "batch_id": build_batch_id(target),
            "source_system": source_system,
            "target_table": target,
            "load_type": load_type,
            "watermark_column": watermark_column,
            "watermark_value_start": watermark_start,
            "watermark_value_end": None,
            "batch_status": "running",
            "batch_start_timestamp": self.clock(),
            "retry_count": 0,
            "initiated_by": initiated_by,
        }
        self._put(row)
        return Batch(key, row["batch_id"], row)

    def complete(
        self, batch: Batch, rows_extracted: int, rows_inserted: int, watermark_end: str | None = None,
        rows_rejected: int = 0,
    ) -> None:
        self._put({
            **batch.row,
            "batch_status": "succeeded",
            "batch_end_timestamp": self.clock(),
            "rows_extracted": rows_extracted,
            "rows_inserted": rows_inserted,
            "rows_rejected": rows_rejected,
            # an empty load leaves the mark unset, and lookups skip unset marks
            "watermark_value_end": watermark_end or batch.row["watermark_value_end"],
        })

    def fail(self, batch: Batch, message: str) -> None:
        self._put({
            **batch.row,
            "batch_status": "failed",
            "batch_end_timestamp": self.clock(),
            "error_message": message[:MESSAGE_WIDTH],
        })

    def fail_open(self, initiated_by: str) -> int:
        """Close every batch this job left running, so no later fix can complete it."""
        stranded = [
            r.asDict()
            for r in self.frame()
            .where((F.col("batch_status") == "running") & (F.col("initiated_by") == initiated_by))
            .withColumn("batch_start_timestamp", F.col("batch_start_timestamp").cast("string"))
            .withColumn("batch_end_timestamp", F.col("batch_end_timestamp").cast("string"))
            .collect()
        ]
        for row in stranded:
            self.fail(Batch(row["batch_key"], row["batch_id"], row), "closed after an upstream step failed")
        return len(stranded)

    def frame(self) -> DataFrame:
        """Current state, one row per batch."""
        if not self.files.names(self.dir):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        entries = self.spark.read.schema(f"{LEDGER_SCHEMA}, entry_seq bigint").json(self.dir)
        return current_state(entries)


def current_state(entries: DataFrame) -> DataFrame:
    newest = F.row_number().over(W.partitionBy("batch_key").orderBy(F.desc("entry_seq")))
    return entries.withColumn("_rank", newest).where("_rank = 1").drop("_rank", "entry_seq")


def fail_open_rows(ledger: DataFrame, initiated_by: str, now: F.Column) -> DataFrame:
    """The same rule as a plan: running batches of one job become failed."""
    hit = (F.col("batch_status") == "running") & (F.col("initiated_by") == initiated_by)
    return (
        ledger.withColumn("error_message",
                          F.when(hit, "closed after an upstream step failed").otherwise(F.col("error_message")))
        .withColumn("batch_end_timestamp", F.when(hit, now).otherwise(F.col("batch_end_timestamp")))
        .withColumn("batch_status", F.when(hit, "failed").otherwise(F.col("batch_status")))
    )


def succeeded(ledger: DataFrame) -> DataFrame:
    return ledger.where("batch_status = 'succeeded'")


def latest_watermarks(ledger: DataFrame) -> DataFrame:
    """Newest high-water mark of every target that has one."""
    done = succeeded(ledger).where("watermark_value_end is not null")
    return done.groupBy("target_table").agg(
        F.max_by("watermark_value_end", F.struct("batch_end_timestamp", "batch_key")).alias("watermark_value_end"),
        F.max("batch_end_timestamp").alias("batch_end_timestamp"),
    )


def last_watermark(ledger: DataFrame, target: str) -> str | None:
    row = latest_watermarks(ledger.where(F.col("target_table") == target)).first()
    return row["watermark_value_end"] if row else None


def last_full_loads(ledger: DataFrame) -> DataFrame:
    """Rows extracted by the newest succeeded full load of every target."""
    done = succeeded(ledger).where("load_type = 'full_load'")
    return done.groupBy("target_table").agg(
        F.max_by("rows_extracted", F.struct("batch_end_timestamp", "batch_key")).alias("rows_extracted"))


def last_full_load(ledger: DataFrame, target: str) -> int | None:
    row = last_full_loads(ledger.where(F.col("target_table") == target)).first()
    return row["rows_extracted"] if row else None


def series_start(ledger: DataFrame, target: str) -> str | None:
    """First observation date to pull again: the date part of the highest mark (text order)."""
    hit = succeeded(ledger).where(F.col("target_table") == target)
    return hit.agg(F.substring(F.max("watermark_value_end"), 1, 10)).first()[0]


def gold_watermarks(ledger: DataFrame) -> DataFrame:
    """Per target, the end of its newest succeeded batch."""
    return succeeded(ledger).groupBy("target_table").agg(F.max("batch_end_timestamp").alias("watermark"))


def gold_watermark(ledger: DataFrame, target: str) -> str:
    hit = gold_watermarks(ledger.where(F.col("target_table") == target))
    row = hit.select(F.col("watermark").cast("string")).first()
    return row[0] if row and row[0] else NEVER
