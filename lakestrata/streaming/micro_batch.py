"""Landing and merging driven by a file stream instead of watermark extracts.

Every micro-batch is one landing batch followed by one current-state merge, with the
same operators as the scheduled run. ``availableNow`` drains what is there and stops.
A micro-batch that is replayed after a failure is harmless: the dedup and the hash
gate absorb rows that were merged before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..plans.silver import SPECS, merge_silver
from ..session import scratch_scope
from ..sources.config import TableConfig
from ..sources.landing import land
from ..sources.ledger import Ledger
from ..sources.store import TableStore


def source_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    """Parquet files dropped into a folder by the source system."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def land_and_merge(
    store: TableStore, ledger: Ledger, cfg: TableConfig, entities: list[str], job: str = "stream"
):
    """The function to run on every micro-batch."""

    def on_batch(rows: DataFrame, epoch: int) -> None:
        run_ts = ledger.clock()
        batch = ledger.start(cfg.target, cfg.source_system, "stream_append", initiated_by=job,
                             watermark_column=cfg.watermark)
        try:
            with scratch_scope(store.spark):
                result = land(store, rows, cfg, batch, run_ts, skip=False, mark_column=cfg.watermark)
                if result.appended:
                    for name in entities:
                        merge_silver(store, SPECS[name], batch_id=batch.key, run_ts=run_ts)
            ledger.complete(batch, result.extracted, result.appended, result.watermark, result.rejected)
        except Exception as exc:
            ledger.fail(batch, str(exc))
            raise

    return on_batch


def start(
    stream: DataFrame, store: TableStore, ledger: Ledger, cfg: TableConfig, checkpoint: str,
    entities: list[str] | None = None,
) -> StreamingQuery:
    """Drain the stream into the landing table and the current-state tables read from it."""
    names = entities or [s.name for s in SPECS.values() if s.source == cfg.target]
    return (
        stream.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(land_and_merge(store, ledger, cfg, names))
        .start()
    )
