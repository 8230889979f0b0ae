"""Facts: sales lines, payments with refund chains, the monthly customer snapshot."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import previous_month_end, ts
from ..functions.text import clip
from ..operators.asof import UNKNOWN, as_of_lookup, key_lookup
from ..operators.keys import assign_keys
from ..operators.merge import append_once
from ..operators.sieve import possible, semi
from ..session import stage

Tables = Mapping[str, DataFrame]

# The business columns of the facts.
SALES_COLUMNS = (
    "sales_line_key", "date_key", "cashier_key", "product_key", "customer_key", "store_key", "invoice_key",
    "invoice_number", "sales_qty", "unit_price", "unit_cost", "sales_amount", "sales_cost", "gross_profit",
    "source_system", "source_record_id",
)
PAYMENT_COLUMNS = (
    "payment_key", "invoice_key", "customer_key", "payment_method_key", "date_key", "payment_type_key",
    "cashier_key", "store_key", "parent_payment_key", "payment_sequence_num", "payment_amount", "tax_amount",
    "fee_amount", "net_amount", "source_system", "source_record_id",
)
SNAPSHOT_COLUMNS = (
    "snapshot_key", "snapshot_date_key", "customer_key", "last_order_date_key", "lifetime_order_count",
    "lifetime_sales_amount", "orders_last_30_days", "avg_days_to_full_payment", "open_invoice_count",
    "open_invoice_total", "is_active_customer", "customer_status", "source_system", "source_record_id",
)
SNAPSHOT_WINDOW_DAYS = 30


def fact_stamps(batch_id: str, run_ts: str) -> list[Column]:
    return [
        F.lit(batch_id).alias("etl_batch_id"),
        ts(run_ts).alias("etl_load_timestamp"),
        ts(run_ts).alias("etl_updated_timestamp"),
        F.lit(True).alias("is_complete"),
        F.lit(False).alias("is_validated"),
        F.lit(False).alias("dq_issue_flag"),
        F.lit(None).cast("string").alias("dq_issue_description"),
    ]


# -- what changed ---------------------------------------------------------------
def _after(mark: str | Column) -> Column:
    moment = ts(mark) if isinstance(mark, str) else mark
    return F.col("silver_updated_at_timestamp") > moment


def changed_invoices(invoice: DataFrame, line: DataFrame, mark: str | Column) -> DataFrame:
    """Numbers of invoices whose header or any line was merged after the mark.

    Both sides are filtered before they meet and the ids are staged, so Spark knows their
    size and a small change set reaches the invoices by broadcast.
    """
    headers = invoice.where(_after(mark)).select("silver_invoice_id")
    lines = line.where(_after(mark)).select("silver_invoice_id")
    touched = stage(headers.unionByName(lines).distinct(), "touched")
    return (
        invoice.join(touched, "silver_invoice_id", "left_semi")
        .select(F.col("silver_invoice_number").alias("invoice_number"))
        .where("invoice_number is not null")
        .distinct()
    )


def changed_payments(payment: DataFrame, mark: str | Column) -> DataFrame:
    return payment.where(_after(mark)).select(F.col("silver_payment_id").cast("string").alias("source_record_id"))


# -- sales ----------------------------------------------------------------------
def sales_rows(t: Tables, changed: DataFrame | None = None) -> DataFrame:
    """Sales lines with dimension keys and measures, before the surrogate key.

    Date, cashier, customer, store and invoice depend on the invoice header only, so
    their versions are looked up once per invoice and travel to the lines with the one
    join the lines need anyway; only the product lookup happens per line. In a reload
    the few headers are staged before and after the lookups, which keeps dimensions and
    lines out of the shuffle: a bitmap over the invoices tells most lines of the others.
    The measures that follow from other columns are left to ``sales_fact``.
    """
    header = t["invoice"].select(
        F.col("silver_invoice_id").alias("_invoice_id"),
        F.col("silver_invoice_number").alias("invoice_number"),
        F.col("silver_invoice_date").alias("_on"),
        "silver_customer_id", "silver_store_id", "silver_employee_id",
    )
    wanted = None
    if changed is not None:
        header = header.join(changed.select("invoice_number"), "invoice_number", "left_semi")
        header = wanted = stage(header, "headers")
    header = key_lookup(header, t["dim_date"], "_on", "date", "date_key")
    # the invoice lookup comes last: its result is laid out by invoice id, as the line join needs it
    for name, ident, key in (
        ("dim_cashier", "silver_employee_id", "cashier_key"),
        ("dim_customer", "silver_customer_id", "customer_key"),
        ("dim_store", "silver_store_id", "store_key"),
        ("dim_invoice", "_invoice_id", "invoice_key"),
    ):
        header = as_of_lookup(header, t[name], ident, "_on", key, wanted=wanted)
    header = header.drop("silver_customer_id", "silver_store_id", "silver_employee_id")
    if changed is not None:
        header = stage(header, "keyed-headers")

    line = t["invoice_line"].select(
        F.col("silver_invoice_id").alias("_invoice_id"),
        "silver_invoice_line_id",
        "silver_product_id",
        F.col("silver_order_qty").alias("sales_qty"),
        "silver_unit_price_amount", "silver_unit_cost_amount", "silver_line_total_amount",
        clip(F.col("silver_source_system"), 50).alias("source_system"),
    )
    if changed is not None:
        line = possible(line, header.select("_invoice_id"), ["_invoice_id"])
    rows = line.join(header, "_invoice_id")
    wanted = None
    if changed is not None:
        rows = wanted = stage(rows, "lines")
    rows = as_of_lookup(rows, t["dim_product"], "silver_product_id", "_on", "product_key", wanted=wanted)
    return rows.select(
        "date_key", "cashier_key", "product_key", "customer_key", "store_key", "invoice_key", "invoice_number",
        "sales_qty", "silver_unit_price_amount", "silver_unit_cost_amount", "silver_line_total_amount",
        "source_system", "silver_invoice_line_id",
    )


def sales_fact(
    t: Tables, *, batch_id: str, run_ts: str, changed: DataFrame | None = None, start: int = 0
) -> DataFrame:
    """New fact rows, keyed in text order of the line id from ``start`` + 1 on; the id travels as a number.

    Measures are taken from the keyed rows, so that cost and profit are neither sorted nor stored with them.
    """
    record = F.col("silver_invoice_line_id").cast("string")
    cost = F.col("sales_qty") * F.col("silver_unit_cost_amount")
    narrow = "decimal(12,2)"
    keyed = assign_keys(sales_rows(t, changed), [record, F.col("product_key")], "sales_line_key", start)
    keyed = keyed.withColumns({
        "source_record_id": record,
        "unit_price": F.col("silver_unit_price_amount").cast(narrow),
        "unit_cost": F.col("silver_unit_cost_amount").cast(narrow),
        "sales_amount": F.col("silver_line_total_amount").cast(narrow),
        "sales_cost": cost.cast(narrow),
        "gross_profit": (F.col("silver_line_total_amount") - cost).cast(narrow),
    })
    return keyed.select(*SALES_COLUMNS, *fact_stamps(batch_id, run_ts))


# -- payments -------------------------------------------------------------------
def payment_rows(t: Tables, changed: DataFrame | None = None) -> DataFrame:
    """Payments with dimension keys and measures, before surrogate and parent keys."""
    p = t["payment"]
    if changed is not None:
        p = semi(p, changed.select(F.col("source_record_id").cast("bigint").alias("silver_payment_id")), ["silver_payment_id"])
    rows = p.select(
        F.col("silver_payment_date").alias("_on"),
        "silver_invoice_id", "silver_customer_id", "silver_payment_method_id", "silver_payment_type_id",
        "silver_employee_id", "silver_store_id",
        F.col("silver_parent_payment_id").alias("parent_payment_id"),
        F.col("silver_payment_sequence_num").alias("payment_sequence_num"),
        F.col("silver_payment_amount").cast("decimal(12,2)").alias("payment_amount"),
        F.col("silver_tax_amount").cast("decimal(12,2)").alias("tax_amount"),
        F.col("silver_fee_amount").cast("decimal(12,2)").alias("fee_amount"),
        F.col("silver_net_amount").cast("decimal(12,2)").alias("net_amount"),
        clip(F.col("silver_source_system"), 50).alias("source_system"),
        F.col("silver_payment_id").cast("string").alias("source_record_id"),
    )
    wanted = None
    if changed is not None:
        rows = wanted = stage(rows, "changed-payment-rows")
    for name, ident, key in (
        ("dim_invoice", "silver_invoice_id", "invoice_key"),
        ("dim_customer", "silver_customer_id", "customer_key"),
        ("dim_payment_method", "silver_payment_method_id", "payment_method_key"),
        ("dim_cashier", "silver_employee_id", "cashier_key"),
        ("dim_store", "silver_store_id", "store_key"),
    ):
        rows = as_of_lookup(rows, t[name], ident, "_on", key, wanted=wanted)
    rows = key_lookup(rows, t["dim_date"], "_on", "date", "date_key")
    types = t["payment_type"].select("silver_payment_type_id", F.col("silver_type_code").alias("_type"))
    rows = rows.join(types, "silver_payment_type_id", "left")
    rows = key_lookup(rows, t["dim_payment_type"], "_type", "type_code", "payment_type_key")
    return rows


def resolve_parent(new: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Parent payment keys of ``new``, looked up among the new rows and the stored ones.

    Stored rows that are being reloaded are ignored in favour of their new key, so a
    refund arriving after its payment still finds it. Of the stored rows only the parents
    asked for are kept, by a semi-join whose other side is as small as the batch, so the
    stored fact isn't shuffled for a small batch.
    """
    known = new.select(F.col("source_record_id").alias("_pid"), F.col("payment_key").alias("parent_payment_key"))
    if existing is not None:
        asked = new.select(F.col("parent_payment_id").cast("string").alias("_pid")).where("_pid is not null").distinct()
        stored = existing.select(
            F.col("source_record_id").alias("_pid"), F.col("payment_key").alias("parent_payment_key")
        ).join(asked, "_pid", "left_semi")
        known = stored.join(known, "_pid", "left_anti").unionByName(known)
    # rows without a parent, most of them, would all meet in one partition of the join
    is_child = F.col("parent_payment_id").isNotNull()
    found = new.where(is_child).join(known, F.col("parent_payment_id").cast("string") == F.col("_pid"), "left").drop("_pid")
    kind = known.schema["parent_payment_key"].dataType
    return new.where(~is_child).withColumn("parent_payment_key", F.lit(None).cast(kind)).unionByName(found)


def moved_keys(existing: DataFrame, new: DataFrame) -> DataFrame:
    """(old key, new key) of every stored payment that is being reloaded."""
    return existing.select(F.col("payment_key").alias("_old"), "source_record_id").join(
        new.select("source_record_id", F.col("payment_key").alias("_new")), "source_record_id"
    ).select("_old", "_new")


def repoint_children(rows: DataFrame, moved: DataFrame, batch_id: str | None = None, run_ts: str | None = None) -> DataFrame:
    """Stored refunds whose parent was reloaded follow the parent to its new key, stamped with the load if given."""
    # rows without a parent, most of them, would all meet in one partition of the join
    is_child = F.col("parent_payment_key").isNotNull()
    out = rows.where(is_child).join(moved, F.col("parent_payment_key") == F.col("_old"), "left")
    if batch_id is not None:
        hit = F.col("_new").isNotNull()
        out = out.withColumns({
            "etl_batch_id": F.when(hit, F.lit(batch_id)).otherwise(F.col("etl_batch_id")),
            "etl_updated_timestamp": F.when(hit, ts(run_ts)).otherwise(F.col("etl_updated_timestamp")),
        })
    out = out.withColumn("parent_payment_key", F.coalesce("_new", "parent_payment_key")).select(rows.columns)
    return rows.where(~is_child).unionByName(out)


def payment_fact(
    t: Tables, *, batch_id: str, run_ts: str, changed: DataFrame | None = None, target: DataFrame | None = None,
    start: int = 0,
) -> DataFrame:
    """New fact rows, keyed in numeric order of the payment id; parents may be in ``target``."""
    order = [F.col("source_record_id").cast("bigint"), F.col("invoice_key")]
    keyed = assign_keys(payment_rows(t, changed), order, "payment_key", start)
    return resolve_parent(keyed, target).select(*PAYMENT_COLUMNS, *fact_stamps(batch_id, run_ts))


# -- customer snapshot ----------------------------------------------------------
def snapshot_day(run_date: str, explicit: str | None = None) -> Column:
    """The given date, else the last completed month-end before ``run_date``."""
    if explicit:
        return F.lit(explicit).cast("date")
    return previous_month_end(F.lit(run_date).cast("date"))


def day_key(calendar: DataFrame, on: Column) -> int:
    """The calendar key of one date, -1 outside the calendar."""
    row = calendar.where(F.col("date") == on).select("date_key").first()
    return row["date_key"] if row else UNKNOWN


def invoice_behaviour(invoice: DataFrame, on: Column) -> DataFrame:
    """Per-customer order and balance measures as of the snapshot date."""
    balance = F.col("silver_balance_due_amount")
    is_open = balance > 0
    recent = F.col("silver_invoice_date") > F.date_sub(on, SNAPSHOT_WINDOW_DAYS)
    return (
        invoice.where(F.col("silver_invoice_date") <= on)
        .groupBy("silver_customer_id")
        .agg(
            F.count_distinct("silver_invoice_id").cast("int").alias("lifetime_order_count"),
            F.sum("silver_total_amount").cast("decimal(14,2)").alias("lifetime_sales_amount"),
            F.count_if(recent).cast("int").alias("orders_last_30_days"),
            F.count_if(is_open).cast("int").alias("open_invoice_count"),
            F.coalesce(F.sum(F.when(is_open, balance)), F.lit(0)).cast("decimal(14,2)").alias("open_invoice_total"),
            F.max("silver_invoice_date").alias("last_order_date"),
        )
    )


def payment_speed(invoice: DataFrame, payment: DataFrame, on: Column) -> DataFrame:
    """Average days from invoice to last payment over paid invoices, exact to the cent of a day."""
    last = payment.groupBy("silver_invoice_id").agg(F.max("silver_payment_date").alias("_last"))
    paid = invoice.where((F.col("silver_invoice_status") == "paid") & (F.col("silver_invoice_date") <= on)).select(
        "silver_invoice_id", "silver_customer_id", "silver_invoice_date"
    )
    days = F.datediff("_last", "silver_invoice_date")
    exact = F.sum(days).cast("decimal(18,0)") / F.count(days).cast("decimal(18,0)")
    return (
        paid.join(last.where(F.col("_last") <= on), "silver_invoice_id")
        .groupBy("silver_customer_id")
        .agg(exact.cast("decimal(8,2)").alias("avg_days_to_full_payment"))
    )


def snapshot_rows(t: Tables, on: Column) -> DataFrame:
    """One row per customer as of ``on``, before the surrogate key."""
    zero = F.lit(0)
    c = t["customer"].select(
        "silver_customer_id", "silver_is_active_flag", "silver_customer_status",
        clip(F.col("silver_source_system"), 50).alias("source_system"),
    )
    rows = c.join(invoice_behaviour(t["invoice"], on), "silver_customer_id", "left").join(
        payment_speed(t["invoice"], t["payment"], on), "silver_customer_id", "left"
    )
    rows = as_of_lookup(rows, t["dim_customer"], "silver_customer_id", on, "customer_key")
    rows = rows.withColumn("snapshot_date_key", F.lit(day_key(t["dim_date"], on)))
    rows = key_lookup(rows, t["dim_date"], "last_order_date", "date", "date_key", "last_order_date_key")
    return rows.select(
        "snapshot_date_key", "customer_key", "last_order_date_key",
        F.coalesce("lifetime_order_count", zero).alias("lifetime_order_count"),
        F.coalesce("lifetime_sales_amount", zero).cast("decimal(14,2)").alias("lifetime_sales_amount"),
        F.coalesce("orders_last_30_days", zero).alias("orders_last_30_days"),
        "avg_days_to_full_payment",
        F.coalesce("open_invoice_count", zero).alias("open_invoice_count"),
        F.coalesce("open_invoice_total", zero).cast("decimal(14,2)").alias("open_invoice_total"),
        F.col("silver_is_active_flag").alias("is_active_customer"),
        F.col("silver_customer_status").alias("customer_status"),
        "source_system",
        F.col("silver_customer_id").cast("string").alias("source_record_id"),
    )


def snapshot_fact(
    t: Tables, on: Column, *, batch_id: str, run_ts: str, target: DataFrame | None = None, start: int = 0
) -> DataFrame:
    """Snapshot rows to append; none if that snapshot date is stored already."""
    rows = append_once(target, snapshot_rows(t, on), ["snapshot_date_key"])
    order = [F.col("source_record_id").cast("bigint"), F.col("customer_key")]
    keyed = assign_keys(rows, order, "snapshot_key", start)
    return keyed.select(*SNAPSHOT_COLUMNS, *fact_stamps(batch_id, run_ts))


def snapshot_exists(target: DataFrame, on: Column, calendar: DataFrame) -> bool:
    """Cheap guard before any snapshot work is planned."""
    return not target.where(F.col("snapshot_date_key") == day_key(calendar, on)).isEmpty()
