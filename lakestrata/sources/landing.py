"""Extract from a source and append raw, hashed, stamped batches to the landing layer."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import ts
from ..functions.hashing import landing_hash
from ..operators.quality import load_issues
from ..session import observed, stage
from .config import (
    COMMON_RENAMES,
    TABLE_RENAMES,
    TableConfig,
    identifier,
    landing_schema,
)
from .ledger import Batch, Ledger, last_full_load, last_watermark
from .store import TableStore

LOOKBACK = timedelta(hours=1)
RECORD_ID = "bronze_record_id"


# -- extract --------------------------------------------------------------------
def apply_lookback(value: str | datetime | None, lookback: timedelta = LOOKBACK):
    """Step a timestamp mark back so late-committed rows are read again; other values pass."""
    if value is None:
        return None
    try:
        moment = value if isinstance(value, datetime) else datetime.fromisoformat(str(value))
    except ValueError:
        return value
    return (moment - lookback).isoformat(sep=" ")


def incremental_scan(source: DataFrame, watermark_column: str, mark: str | None) -> DataFrame:
    """Rows strictly above the mark; the literal has the column's type, so the filter is pushed down."""
    column = identifier(watermark_column, "watermark column")
    if mark is None:
        return source
    kind = source.schema[column].dataType
    return source.where(F.col(column) > F.lit(mark).cast(kind))


def extract(source: DataFrame, cfg: TableConfig, mark: str | None, strategy: str | None = None) -> DataFrame:
    identifier(cfg.name, "table name")
    if (strategy or cfg.strategy) != "incremental":
        return source
    return incremental_scan(source, cfg.watermark or "updated_at", apply_lookback(mark))


def jdbc_scan(
    spark: SparkSession, url: str, table: str, *, partition_column: str | None = None,
    bounds: tuple[str, str] | None = None, partitions: int = 32, fetch_size: int = 10_000, **options: str,
) -> DataFrame:
    """A database table; with a partition column the read is split into range queries."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=identifier(table, "table name"), fetchsize=str(fetch_size), **options
    )
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=identifier(partition_column, "partition column"),
            lowerBound=bounds[0], upperBound=bounds[1], numPartitions=str(partitions),
        )
    return reader.load()


FILE_TIME = "source_file_modified_at"
LINEAGE = ("bronze_source_file_name", "bronze_source_row_number", FILE_TIME)


def with_file_lineage(source: DataFrame) -> DataFrame:
    """File name, row number (from 1) and modification time of file-based sources.

    The time serves as their watermark: a filter on it is decided file by file, so files up to the
    mark aren't opened. Formats without row positions, such as CSV, leave the number unset.
    """
    numbered = "row_index" in source.select("_metadata").schema["_metadata"].dataType.names
    number = F.col("_metadata.row_index") + 1 if numbered else F.lit(None)
    return source.select(
        "*",
        F.col("_metadata.file_path").alias("bronze_source_file_name"),
        number.cast("bigint").alias("bronze_source_row_number"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias(FILE_TIME),
    )


# -- standardise ----------------------------------------------------------------
def _delete_flag(columns: list[str]) -> Column:
    if "is_deleted_source_flag" not in columns:
        return F.lit(False)
    return F.coalesce(F.col("is_deleted_source_flag").cast("boolean"), F.lit(False))


def standardize(
    source: DataFrame, cfg: TableConfig, batch_id: int, run_ts: str,
    system: str | None = None, schema: T.StructType | None = None, numbered: bool = False,
) -> DataFrame:
    """Source row -> landing row: payload, renames, delete flag, hash, stamps, target columns only.

    Where a row came from is neither payload nor part of its hash; the file's time stands in for
    the time of change if the source has none. ``numbered`` rows bring their landing id, which is
    neither of them as well.
    """
    schema = schema or landing_schema(cfg.target)
    lineage = [c for c in LINEAGE if c in source.columns] + [RECORD_ID] * numbered
    raw = [c for c in source.columns if c not in lineage]
    df = source.withColumn("bronze_raw_payload_jsonb", F.to_json(F.struct(*raw), {"ignoreNullFields": "false"}))
    stamps = [c for c in ("source_updated_at", "updated_at") if c in raw]
    if stamps:
        df = df.withColumn("updated_at_source_timestamp", F.coalesce(*stamps)).drop(*stamps)
    df = df.withColumnsRenamed({**COMMON_RENAMES, **TABLE_RENAMES.get(cfg.target, {})})
    business = [c for c in df.columns if c != "bronze_raw_payload_jsonb" and c not in lineage]
    df = df.withColumns({
        "bronze_row_hash": landing_hash(business),
        "bronze_is_deleted_flag": _delete_flag(df.columns),
        "bronze_batch_id": F.lit(batch_id).cast("bigint"),
        "bronze_source_system": F.lit(system or cfg.source_system),
        "bronze_source_table_name": F.lit(cfg.name),
        "bronze_extracted_at_timestamp": ts(run_ts),
        "bronze_loaded_at_timestamp": ts(run_ts),
    })
    if FILE_TIME in lineage and "updated_at_source_timestamp" not in df.columns:
        df = df.withColumn("updated_at_source_timestamp", F.col(FILE_TIME))
    have = set(df.columns)
    return df.selectExpr(*[
        f"cast({f.name if f.name in have else 'null'} as {f.dataType.simpleString()}) as {f.name}"
        for f in schema.fields if f.name != RECORD_ID or numbered
    ])


def column_gap(source: DataFrame, cfg: TableConfig) -> tuple[list[str], list[str]]:
    """(source columns without a landing column, landing columns nothing fills)."""
    landed = {**COMMON_RENAMES, **TABLE_RENAMES.get(cfg.target, {})}
    names = {landed.get(c, c) for c in source.columns}
    stamps = {"source_updated_at", "updated_at", FILE_TIME}
    if names & stamps:
        names = (names - stamps) | {"updated_at_source_timestamp"}
    target = [f.name for f in landing_schema(cfg.target).fields]
    business = [c for c in target if not c.startswith("bronze_")]
    return sorted(names - set(target)), sorted(set(business) - names)


# -- rows that can't be trusted ---------------------------------------------------
def required_keys(cfg: TableConfig) -> tuple[str, ...]:
    """The landing columns without which a row has no identity: the configured keys, else the first column."""
    return cfg.keys or (landing_schema(cfg.target)[0].name,)


def screen(source: DataFrame, cfg: TableConfig) -> tuple[Column, Column]:
    """(whether a source row is rejected, the reasons): a key is missing or isn't of its landing type.

    The reasons name every column that doesn't cast. A row whose keys are sound isn't rejected; if
    another column doesn't cast, the load fails, as its extract can't be trusted at all. Only
    columns whose type differs from the landing type are tried.
    """
    fields = {f.name: f.dataType for f in landing_schema(cfg.target).fields}
    landed = {**COMMON_RENAMES, **TABLE_RENAMES.get(cfg.target, {})}
    rejected, reasons = F.lit(False), [F.lit(None).cast("string")]
    for f in source.schema.fields:
        name = landed.get(f.name, f.name)
        if name not in fields or name.startswith("bronze_"):
            continue
        value, kind = F.col(f.name), fields[name]
        tried = f.dataType != kind and not isinstance(kind, T.StringType)
        uncastable = value.isNotNull() & value.try_cast(kind).isNull() if tried else F.lit(False)
        if name in required_keys(cfg):
            missing = value.isNull() | (F.trim(value.cast("string")) == "")
            reasons.append(F.when(missing, F.lit(f"missing {name}")))
            rejected, uncastable = rejected | missing | uncastable, ~missing & uncastable
        if tried:
            reasons.append(F.when(uncastable, F.lit(f"uncastable {name}")))
    return rejected, F.array_compact(F.array(*reasons))


QUARANTINE = "quarantine"


def quarantine(store: TableStore, rows: DataFrame, cfg: TableConfig, batch: Batch, run_ts: str, expected: int) -> None:
    """Store the rejected rows of a batch aside, raw and with their reasons; another number than was counted fails."""
    rejected, reasons = screen(rows, cfg)
    aside = rows.where(rejected).select(
        F.lit(batch.key).cast("bigint").alias("batch_key"), F.lit(cfg.name).alias("source_table_name"), reasons.alias("reasons"),
        ts(run_ts).alias("rejected_at"), F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("raw_row"))
    stored = store.append(QUARANTINE, cfg.target, aside, batch.key)
    if stored != expected:
        raise RuntimeError(f"{cfg.target}: {expected} rows were rejected, {stored} at a second look")


# -- skip unchanged full loads --------------------------------------------------
def current_hashes(landed: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Hash of the newest landed row per natural key, partially aggregated before the shuffle."""
    for k in keys:
        identifier(k, "key column")
    newest = landed.groupBy(*keys).agg(F.max_by("bronze_row_hash", RECORD_ID).alias("bronze_row_hash"))
    return newest.select("bronze_row_hash").where("bronze_row_hash is not null")


def skip_unchanged(rows: DataFrame, hashes: DataFrame) -> DataFrame:
    """Drop rows whose hash is already current; a reverted value is not, so it lands again."""
    return rows.join(hashes, "bronze_row_hash", "left_anti").select(rows.columns)


def high_water_mark(rows: DataFrame, column: str) -> DataFrame:
    """Largest watermark value of a batch, as text (NULL for an empty batch)."""
    return rows.agg(F.max(identifier(column, "watermark column")).cast("string").alias("watermark_value_end"))


# -- one table ------------------------------------------------------------------
@dataclass(frozen=True)
class LandingResult:
    batch: Batch
    extracted: int
    appended: int
    watermark: str | None
    rejected: int = 0
    # source columns that aren't landed, and landing columns that nothing fills
    dropped: tuple[str, ...] = ()
    unfilled: tuple[str, ...] = ()


class BatchRejected(RuntimeError):
    """A load broke a rule about its batch as a whole; nothing of it was committed."""


def land(
    store: TableStore, rows: DataFrame, cfg: TableConfig, batch: Batch, run_ts: str, *,
    skip: bool, mark_column: str | None, system: str | None = None, full: bool = False, previous: int | None = None,
) -> LandingResult:
    """Append one extracted batch; counts and the high-water mark come from the writing pass.

    Before the commit the batch is judged as a whole: every extracted row must be landed, known or
    rejected, and a ``full`` load must bring rows, and not far fewer than the ``previous`` one.
    Counts that don't tie out are taken again, exactly, as tasks repeated after a lost executor
    may have been counted twice.

    Rows without a sound key are set aside: they are counted in that pass and, if there are any,
    written to the table's quarantine. The mark covers them, so they aren't read again.
    """
    store.tracked[f"bronze.{cfg.target}"] = RECORD_ID
    known = store.exists("bronze", cfg.target)
    rejected, _ = screen(rows, cfg)
    mark = F.max(mark_column).cast("string") if mark_column in rows.columns else F.max(F.lit(None).cast("string"))
    seen = Observation()
    counted = rows.withColumn("_rejected", rejected).observe(
        seen, F.count(F.lit(1)).alias("n"), F.count_if("_rejected").alias("rejected"), mark.alias("mark"))
    sound = standardize(counted.where("not _rejected").drop("_rejected"), cfg, batch.key, run_ts, system)
    # full loads of known tables are read from the source once, then compared with what is landed
    snapshot = stage(sound, f"snapshot-{cfg.target}") if known and skip and cfg.keys else None
    found: dict = {}

    def approve(appended: int, written: DataFrame) -> int:
        found.update(observed(seen, n=0, rejected=0, mark=None))
        kept = snapshot.count() if snapshot is not None else appended
        if found["n"] != kept + found["rejected"]:
            exact = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(rejected).alias("rejected")).first()
            found.update(exact.asDict())
            appended = written.count()
            kept = snapshot.count() if snapshot is not None else appended
        issues = load_issues(full, found["n"], kept, found["rejected"], previous, cfg.least_share)
        if issues:
            raise BatchRejected(f"{cfg.target}: {'; '.join(issues)}")
        return appended

    fresh = sound
    if snapshot is not None:
        fresh = skip_unchanged(snapshot, current_hashes(store.read("bronze", cfg.target), cfg.keys))
    appended = _append(store, fresh, cfg, batch, approve)
    if found["rejected"]:
        quarantine(store, rows, cfg, batch, run_ts, found["rejected"])
    gap = column_gap(rows, cfg)
    return LandingResult(batch, found["n"], appended, found["mark"], found["rejected"], *map(tuple, gap))


def _append(store: TableStore, rows: DataFrame, cfg: TableConfig, batch: Batch,
            approve: Callable[[int, DataFrame], int] | None = None) -> int:
    """Number the rows after every id landed so far and commit them as one batch."""
    start = store.top("bronze", cfg.target)
    numbered = rows.withColumn(RECORD_ID, F.monotonically_increasing_id() + F.lit(start + 1))
    return store.append("bronze", cfg.target, numbered.select(landing_schema(cfg.target).fieldNames()), batch.key, approve)


def ingest_table(
    source: DataFrame, cfg: TableConfig, store: TableStore, ledger: Ledger, run_ts: str, *,
    strategy: str | None = None, job: str = "warehouse_run", mark: str | None | bool = True,
    previous: int | None | bool = True, judge: bool = False,
) -> LandingResult:
    """Open a batch, extract, append, then complete or fail the batch.

    With ``judge`` a full load that is empty, or far smaller than the last one, fails as a whole;
    without, its size is the caller's matter. ``mark`` and ``previous`` may carry the already
    looked-up watermark and the rows of the last full load, to spare ledger queries per table.
    """
    strategy = strategy or cfg.strategy
    load_type = replace(cfg, strategy=strategy).load_type  # what is done, not what the table's setting says
    batch = ledger.start(
        cfg.target, cfg.source_system, load_type, initiated_by=job, watermark_column=cfg.watermark
    )
    try:
        if mark is True:
            mark = last_watermark(ledger.frame(), cfg.target) if strategy == "incremental" else None
        rows, full = extract(source, cfg, mark, strategy), strategy == "full_load"
        if previous is True:
            previous = last_full_load(ledger.frame(), cfg.target) if full and judge else None
        result = land(store, rows, cfg, batch, run_ts, skip=full, mark_column=cfg.watermark, full=full and judge,
                      previous=previous)
        ledger.complete(batch, result.extracted, result.appended, result.watermark, result.rejected)
        return result
    except Exception as exc:
        ledger.fail(batch, str(exc))
        raise
