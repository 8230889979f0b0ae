"""Lineage, trail and ledger reports, personal data, snapshots of tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import ts
from ..operators.ordered import neighbour
from ..sources.store import TableStore

KEEP_SNAPSHOTS = 7
MARKER = "_snapshot"


# -- ledger and trail -------------------------------------------------------------
def recent_batches(ledger: DataFrame, n: int = 20) -> DataFrame:
    return (
        ledger.select("batch_key", "source_system", "target_table", "load_type", "batch_status", "rows_inserted",
                      "batch_start_timestamp", "error_message")
        .orderBy(F.desc("batch_start_timestamp"), F.desc("batch_key"))
        .limit(n)
    )


def recent_changes(trail: DataFrame, n: int = 20) -> DataFrame:
    return (
        trail.select("table_name", "operation_type", "record_key", "changed_columns", "change_reason",
                     "etl_batch_id", "changed_at")
        .orderBy(F.desc("changed_at"), "record_key", "changed_columns")
        .limit(n)
    )


def version_lineage(dim: DataFrame, ledger: DataFrame) -> DataFrame:
    """Every dimension version with the batch that wrote it."""
    b = ledger.select(F.col("batch_id").alias("etl_batch_id"), "initiated_by", "load_type", "batch_start_timestamp")
    return dim.join(b, "etl_batch_id").select(
        "source_record_id", "row_version", "valid_from", "etl_batch_id", "initiated_by", "load_type",
        "batch_start_timestamp",
    )


def batch_stats(ledger: DataFrame) -> DataFrame:
    """Runs, outcomes, rows and the newest mark per target."""
    ok = F.col("batch_status") == "succeeded"
    return ledger.groupBy("target_table").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(ok).alias("succeeded"),
        F.count_if(F.col("batch_status") == "failed").alias("failed"),
        F.sum(F.when(ok, F.col("rows_inserted"))).alias("rows_inserted"),
        F.max(F.when(ok, F.col("watermark_value_end"))).alias("watermark"),
    )


def unmatched_rate(fact: DataFrame, keys: list[str]) -> DataFrame:
    """Share of rows pointing at the -1 member, per key column; one pass over the fact."""
    total = F.count(F.lit(1))
    counts = fact.agg(total.alias("rows"), *[F.count_if(F.col(k) == -1).alias(k) for k in keys])
    long = counts.unpivot(["rows"], keys, "key_column", "unmatched")
    share = F.round(F.col("unmatched") / F.nullif(F.col("rows"), F.lit(0)), 6)
    return long.select("key_column", "rows", "unmatched", share.alias("unmatched_rate"))


def trace(fact: DataFrame, silver: DataFrame, landed: DataFrame) -> DataFrame:
    """Fact row -> current-state row -> landing row, by the lineage ids."""
    s = silver.select(
        F.col("silver_source_record_id").alias("source_record_id"), "silver_batch_id",
        F.col("silver_bronze_record_id").alias("bronze_record_id"), "silver_row_hash",
    )
    b = landed.select("bronze_record_id", "bronze_batch_id", "bronze_source_table_name", "bronze_row_hash")
    return (
        fact.select("source_record_id", "etl_batch_id")
        .join(s, "source_record_id")
        .join(b, "bronze_record_id")
    )


def status_durations(history: DataFrame, entity: str) -> DataFrame:
    """Time spent in each status, from the transition log; the last status is still open."""
    steps = neighbour(
        history, [entity], ["silver_changed_at_timestamp", "silver_status_history_id"],
        {"left_at": "silver_changed_at_timestamp"}, F.to_date("silver_changed_at_timestamp"), ahead=True,
    )
    hours = F.timestamp_diff("HOUR", F.col("silver_changed_at_timestamp"), F.col("left_at"))
    return steps.select(
        entity, F.col("silver_new_status").alias("status"),
        F.col("silver_changed_at_timestamp").alias("entered_at"), "left_at", hours.alias("hours_in_status"),
    )


def status_cycle_time(history: DataFrame, entity: str) -> DataFrame:
    d = status_durations(history, entity)
    n, total = F.count("hours_in_status"), F.sum("hours_in_status")
    return d.groupBy("status").agg(
        F.count(F.lit(1)).alias("entries"), n.alias("completed"),
        F.round(total / F.nullif(n, F.lit(0)), 4).alias("avg_hours"),
    )


# -- personal data ------------------------------------------------------------------
# Sensitivity classes of column-name parts.
PII = ("email", "phone", "first_name", "last_name", "full_name", "street_address")
NOT_IN_GOLD = ("email", "phone")


def classify(columns: list[str]) -> dict[str, str]:
    return {c: "PII" if any(p in c for p in PII) else "Internal" for c in columns}


def pii_register(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, column_name, sensitivity, filled``: every column of every table; one pass over each table."""
    parts = []
    for name, df in tables.items():
        kinds = classify(df.columns)
        counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
        sensitivity = F.create_map(*(F.lit(x) for pair in kinds.items() for x in pair))
        parts.append(counts.unpivot([], df.columns, "column_name", "filled").select(
            F.lit(name).alias("table_name"), "column_name", sensitivity[F.col("column_name")].alias("sensitivity"), "filled"))
    return reduce(DataFrame.unionByName, parts)


def assert_minimised(columns: list[str]) -> None:
    """Star-schema tables must not carry e-mail or phone columns (masked ones are fine)."""
    bad = [c for c in columns if any(p in c for p in NOT_IN_GOLD) and not c.endswith("_masked")]
    if bad:
        raise ValueError(f"personal data columns not allowed here: {bad}")


def erase(df: DataFrame, column: str, subjects: DataFrame) -> DataFrame:
    """All rows except those of the given subjects (column ``subject_id``, text)."""
    s = subjects.select(F.col("subject_id").alias("_sid"))
    return df.join(s, F.col(column).cast("string") == F.col("_sid"), "left_anti")


def erasure_log(df: DataFrame, table: str, column: str, subjects: DataFrame, run_ts: str, app: str) -> DataFrame:
    """One trail row per erased subject and table, without the erased values."""
    s = subjects.select(F.col("subject_id").alias("_sid"))
    hit = df.groupBy(F.col(column).cast("string").alias("record_key")).agg(F.count(F.lit(1)).alias("rows_erased"))
    return hit.join(s, F.col("record_key") == F.col("_sid"), "left_semi").select(
        F.lit(table).alias("table_name"), F.lit("DELETE").alias("operation_type"), "record_key", "rows_erased",
        F.lit("verified erasure request").alias("change_reason"), F.lit(app).alias("changed_by_app_user"),
        ts(run_ts).alias("changed_at"),
    )


def erase_subjects(store: TableStore, places: list[tuple[str, str, str]], subjects: DataFrame, run_ts: str,
                   app: str = "erasure") -> int:
    """Erase subjects from stored tables given as (layer, table, id column); log first, then rewrite.

    Old versions are expired right away: they would still hold the erased rows.
    """
    n = 0
    for layer, table, column in places:
        current = store.read(layer, table)
        log = erasure_log(current, f"{layer}.{table}", column, subjects, run_ts, app)
        store.append("audit", "erasure_log", log)
        n += store.erase(layer, table, column, subjects)
        store.expire(layer, table, keep=1)
    return n


# -- snapshots ------------------------------------------------------------------------
def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-independent content hash, computed in one distributed pass."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in sorted(df.columns)]
    h = F.xxhash64(*text).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(h), F.lit(0)).alias("content"))


def snapshot_tables(store: TableStore, tables: list[tuple[str, str]], dest: str, stamp: str,
                    keep: int = KEEP_SNAPSHOTS) -> str:
    """Copy the current version of each table to ``dest/stamp``; the oldest copies beyond ``keep`` go.

    Only folders that carry this function's marker are copies; nothing else in ``dest`` is touched.
    """
    if keep < 1:
        raise ValueError("keep at least one snapshot")
    target = f"{dest.rstrip('/')}/{stamp}"
    for layer, table in tables:
        store.read(layer, table).write.parquet(f"{target}/{layer}/{table}")
    store.files.create_text(f"{target}/{MARKER}", stamp)
    copies = [n for n in store.files.names(dest) if store.files.exists(f"{dest.rstrip('/')}/{n}/{MARKER}")]
    for old in copies[:-keep]:
        store.files.delete(f"{dest.rstrip('/')}/{old}")
    return target


def compare_copies(live: DataFrame, copy: DataFrame) -> DataFrame:
    """Counts and hashes side by side; ``matches`` also demands a non-empty copy."""
    prints = fingerprint(live).withColumn("side", F.lit("live")).union(
        fingerprint(copy).withColumn("side", F.lit("copy"))
    )
    columns = [
        F.max(F.when(F.col("side") == side, F.col(c))).alias(f"{side}_{c}")
        for side in ("live", "copy") for c in ("rows", "content")
    ]
    same = (F.col("live_rows") == F.col("copy_rows")) & (F.col("live_content") == F.col("copy_content"))
    return prints.agg(*columns).withColumn("matches", same & (F.col("copy_rows") > 0))


def verify_snapshot(store: TableStore, tables: list[tuple[str, str]], folder: str) -> list[str]:
    """Names of tables whose copy does not tie out."""
    bad = []
    for layer, table in tables:
        copy = store.spark.read.parquet(f"{folder}/{layer}/{table}")
        if not compare_copies(store.read(layer, table), copy).first()["matches"]:
            bad.append(f"{layer}.{table}")
    return bad
