"""Before/after trail of reloaded fact rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import ts
from .sieve import possible, semi

# bookkeeping columns that never count as a business change
STAMPS = ("etl_batch_id", "etl_load_timestamp", "etl_updated_timestamp")
DEFAULT_REASON = "source_update"
REASON_WIDTH = 500


def before_image(target: DataFrame, changed: DataFrame, match: str, stored: bool = False) -> DataFrame:
    """Stored rows that the reload is about to replace; of ``stored`` keys a bitmap spares most rows the join."""
    if stored:
        return semi(target, changed.select(match), [match])
    return target.join(changed.select(match), match, "left_semi").select(target.columns)


def change_reasons(adjustments: DataFrame, invoices: DataFrame, stored: bool = False) -> DataFrame:
    """Distinct adjustment reasons per invoice number, in text order, joined by '; ' and clipped.

    A reason takes at least three characters with its separator, so the first
    ``REASON_WIDTH`` characters never need more than that many reasons: ranking them
    first (Spark limits each group before the shuffle) bounds what a group gathers. Of ``stored``
    invoices a bitmap over their ids spares most adjustments of others the join.
    """
    reasons = adjustments.where("silver_adjustment_reason is not null").select(
        "silver_invoice_id", "silver_adjustment_reason"
    )
    if stored:
        reasons = possible(reasons, invoices, ["silver_invoice_id"])
    # the few wanted invoices cut the adjustments before anything is shuffled
    named = reasons.join(
        invoices.select("silver_invoice_id", F.col("silver_invoice_number").alias("invoice_number")), "silver_invoice_id"
    ).select("invoice_number", "silver_adjustment_reason").distinct()
    rank = F.row_number().over(W.partitionBy("invoice_number").orderBy("silver_adjustment_reason"))
    first = named.withColumn("_rank", rank).where(F.col("_rank") <= REASON_WIDTH)
    text = F.array_join(F.array_sort(F.collect_list("silver_adjustment_reason")), "; ")
    return first.groupBy("invoice_number").agg(F.left(text, F.lit(REASON_WIDTH)).alias("change_reason"))


def change_log(
    before: DataFrame,
    after: DataFrame,
    *,
    table: str,
    surrogate_key: str,
    record_key: str,
    batch_id: str,
    run_ts: str,
    reasons: DataFrame | None = None,
    app: str = "warehouse_run",
    match: str = "source_record_id",
) -> DataFrame:
    """One row per replaced fact row: DELETE when no successor, else UPDATE with the changed columns.

    The rows meet as plain columns and become structs afterwards, so constant columns and columns
    that are named twice do not travel.
    """
    columns = before.columns
    compared = sorted(c for c in columns if c != surrogate_key and c not in STAMPS)
    b = before.select(
        F.col(record_key).cast("string").alias("record_key"),
        *[F.col(c).alias(f"_old_{c}") for c in columns],
    )
    if reasons is not None:
        b = b.join(reasons.withColumnRenamed(record_key, "record_key"), "record_key", "left")
        reason = F.coalesce("change_reason", F.lit(DEFAULT_REASON))
    else:
        reason = F.lit(DEFAULT_REASON)
    a = after.select(*[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = b.join(a, F.col(f"_old_{match}") == F.col(f"_new_{match}"), "left")
    gone = F.col(f"_new_{match}").isNull()
    old, new = (F.struct(*[F.col(f"{side}_{c}").alias(c) for c in columns]) for side in ("_old", "_new"))
    names = F.concat_ws(
        ",", *[F.when(~F.col(f"_old_{c}").eqNullSafe(F.col(f"_new_{c}")), F.lit(c)) for c in compared]
    )
    changed = F.when(~gone & (names != ""), F.split(names, ","))
    return joined.select(
        F.lit(table).alias("table_name"),
        F.when(gone, "DELETE").otherwise("UPDATE").alias("operation_type"),
        "record_key",
        F.to_json(old).alias("old_row"),
        F.when(~gone, F.to_json(new)).alias("new_row"),
        changed.alias("changed_columns"),
        reason.alias("change_reason"),
        F.lit(app).alias("changed_by_app_user"),
        ts(run_ts).alias("changed_at"),
        F.lit(batch_id).alias("etl_batch_id"),
        F.col("_old_source_system").alias("source_system"),
    )
