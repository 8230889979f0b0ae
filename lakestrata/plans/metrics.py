"""Business measures. Ratios are ratios of sums; a zero denominator gives NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SCALE = 6


def ratio(n: Column, d: Column) -> Column:
    """Safe division in double precision, rounded to a stable number of digits."""
    return F.round(n.cast("double") / F.nullif(d.cast("double"), F.lit(0.0)), SCALE)


def sales_kpis(sales: DataFrame, by: list[str] | None = None, few: bool = False) -> DataFrame:
    """Totals, margin, average price, order count and average order value per group.

    With ``few`` groups, or one, the orders are counted apart from the sums: a distinct count beside them would send
    the sums of every (group, invoice) pair along with it, where a task has but one row of sums per group.
    """
    by, few, orders = by or [], few or not by, F.count_distinct("invoice_number").alias("order_count")
    g = sales.groupBy(*by).agg(
        F.sum("sales_amount").alias("total_sales"),
        F.sum("sales_cost").alias("total_cost"),
        F.sum("gross_profit").alias("gross_profit"),
        F.sum("sales_qty").alias("total_quantity"),
        *([] if few else [orders]),
    )
    if few:
        counted = sales.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(orders)
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
        g = (g.join(counted, same) if by else g.crossJoin(counted)).drop(*[f"_{c}" for c in by])
    return g.withColumns({
        "gross_margin": ratio(F.col("gross_profit"), F.col("total_sales")),
        "avg_selling_price": ratio(F.col("total_sales"), F.col("total_quantity")),
        "avg_order_value": ratio(F.col("total_sales"), F.col("order_count")),
    })


def sales_over_time(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Per month: sales, the same month of last year, growth and year-to-date.

    Sales are summed to the day first, so only a calendar-sized table is windowed.
    """
    days = calendar.where("date_key <> -1").select("date_key", "calendar_year", "calendar_month_number_in_year")
    daily = sales.groupBy("date_key").agg(F.sum("sales_amount").alias("total_sales"))
    month = (
        daily.join(days, "date_key")
        .groupBy(F.col("calendar_year").cast("int").alias("year"),
                 F.col("calendar_month_number_in_year").cast("int").alias("month"))
        .agg(F.sum("total_sales").alias("total_sales"))
    )
    last = month.select((F.col("year") + 1).alias("year"), "month", F.col("total_sales").alias("sales_ly"))
    so_far = W.partitionBy("year").orderBy("month").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        month.join(last, ["year", "month"], "left")
        .withColumn("sales_yoy", ratio(F.col("total_sales") - F.col("sales_ly"), F.col("sales_ly")))
        .withColumn("sales_ytd", F.sum("total_sales").over(so_far))
    )


def collections(payments: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Net and gross collections, refunds, refund rate, fees and taxes per group."""
    refund = F.col("payment_kind") == "Refund"
    amount = F.col("payment_amount")
    zero = F.lit(0).cast("decimal(12,2)")
    g = payments.groupBy(*(by or [])).agg(
        F.sum(amount).alias("net_collected"),
        F.sum(F.when(refund, zero).otherwise(amount)).alias("gross_payments"),
        F.sum(F.when(refund, amount).otherwise(zero)).alias("total_refunds"),
        F.count_if("is_refund").alias("refund_count"),
        F.sum("fee_amount").alias("total_fees"),
        F.sum("tax_amount").alias("total_tax"),
    )
    return g.withColumn("refund_rate", ratio(-F.col("total_refunds"), F.col("gross_payments")))


def latest_snapshot(snapshot: DataFrame) -> DataFrame:
    """Only the newest snapshot date: these measures must never be summed over dates."""
    newest = snapshot.agg(F.max("snapshot_date_key").alias("snapshot_date_key"))
    return snapshot.join(F.broadcast(newest), "snapshot_date_key", "left_semi")


def customer_health(snapshot: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Customer counts, at-risk share, open total and days to pay in the newest snapshot."""
    at_risk = F.when(F.col("is_at_risk"), F.col("customer_key"))
    g = latest_snapshot(snapshot).groupBy(*(by or [])).agg(
        F.count_distinct("customer_key").alias("customers"),
        F.count_distinct(at_risk).alias("at_risk_customers"),
        F.sum("open_invoice_total").alias("open_invoice_total"),
        F.sum("avg_days_to_full_payment").alias("_days"),
        F.count("avg_days_to_full_payment").alias("_n"),
    )
    return (
        g.withColumn("at_risk_share", ratio(F.col("at_risk_customers"), F.col("customers")))
        .withColumn("avg_days_to_pay", ratio(F.col("_days"), F.col("_n")))
        .drop("_days", "_n")
    )


# -- dashboard cuts and star queries ---------------------------------------------
def sales_by(sales: DataFrame, dim: DataFrame, key: str, label: str) -> DataFrame:
    """KPIs per label.

    Orders are counted distinct per label, so the (label, invoice) pairs are what is shuffled, without the sums.
    """
    return sales_kpis(sales.join(dim.select(key, label), key), [label], few=True)


def collections_by(payments: DataFrame, dim: DataFrame, key: str, label: str) -> DataFrame:
    """Collections per label; the sums are additive, so keys are reduced before the join."""
    per_key = collections(payments, [key]).drop("refund_rate")
    sums = [c for c in per_key.columns if c != key]
    g = per_key.join(dim.select(key, label), key).groupBy(label).agg(*[F.sum(c).alias(c) for c in sums])
    return g.withColumn("refund_rate", ratio(-F.col("total_refunds"), F.col("gross_payments")))


def collections_by_po(payments: DataFrame, invoices: DataFrame) -> DataFrame:
    """Collections per purchase order; the unknown member is left out."""
    named = invoices.where("po_number <> 'Not Provided'")
    return collections_by(payments, named, "invoice_key", "po_number").select(
        "po_number", "net_collected", "refund_count"
    )


def at_risk_list(snapshot: DataFrame, customers: DataFrame) -> DataFrame:
    """At-risk customers of the newest snapshot, longest silence first."""
    risky = latest_snapshot(snapshot).where("is_at_risk")
    return (
        risky.join(customers.select("customer_key", "customer_name"), "customer_key")
        .select("customer_key", "customer_name", "days_since_last_order", "open_invoice_total")
        .orderBy(F.desc("days_since_last_order"), "customer_key")
    )


def profit_by_month(sales: DataFrame, calendar: DataFrame, products: DataFrame) -> DataFrame:
    """Sales and profit by month and department.

    The calendar is small, so the fact is reduced to (month, product) in the scan stage;
    the product join then runs on the reduced rows whatever its size.
    """
    monthly = (
        sales.join(calendar.select("date_key", "calendar_year_month"), "date_key")
        .groupBy("calendar_year_month", "product_key")
        .agg(F.sum("sales_amount").alias("sales"), F.sum("gross_profit").alias("gross_profit"))
    )
    return (
        monthly.join(products.select("product_key", "department_description"), "product_key")
        .groupBy("calendar_year_month", "department_description")
        .agg(F.sum("sales").alias("sales"), F.sum("gross_profit").alias("gross_profit"))
        .orderBy("calendar_year_month", "department_description")
    )


def collections_by_method(payments: DataFrame, methods: DataFrame) -> DataFrame:
    per_key = payments.groupBy("payment_method_key").agg(
        F.sum("payment_amount").alias("net_collected"),
        F.count("parent_payment_key").alias("refund_count"),
    )
    return (
        per_key.join(methods.select("payment_method_key", "method_name"), "payment_method_key")
        .groupBy("method_name")
        .agg(F.sum("net_collected").alias("net_collected"), F.sum("refund_count").alias("refund_count"))
        .orderBy(F.desc("net_collected"))
    )


def top_customers(snapshot: DataFrame, customers: DataFrame, snapshot_role: DataFrame, last_role: DataFrame,
                  n: int = 20) -> DataFrame:
    """The n customers with the highest lifetime sales, with both dates spelled out."""
    return (
        snapshot.join(customers.select("customer_key", "customer_name"), "customer_key")
        .join(snapshot_role.select("snapshot_date_key", "snapshot_date"), "snapshot_date_key")
        .join(last_role.select("last_order_date_key", "last_order_date"), "last_order_date_key")
        .select("customer_name", "snapshot_date", "last_order_date", "lifetime_sales_amount", "open_invoice_total")
        .orderBy(F.desc("lifetime_sales_amount"), "customer_name")
        .limit(n)
    )
