"""Serving views over the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import month_key, month_of_key
from ..functions.masking import mask_email, mask_phone
from ..functions.text import clip
from ..operators.calendar import DATE_ATTRIBUTES

AT_RISK_DAYS = 90
PRICE_SERIES = "CPIAUCSL"
PAPER_SERIES = "WPU0911"

# Columns each dimension view exposes.
DIMENSION_VIEWS = {
    "bi_dim_cashier": ("dim_cashier", ("cashier_key", "cashier_id", "cashier_first_name", "cashier_last_name",
                                       "cashier_full_name", "is_active", "store_id", "store_name", "is_current")),
    "bi_dim_customer": ("dim_customer", ("customer_key", "customer_id", "customer_name", "customer_street_address",
                                         "customer_city", "customer_county", "customer_state",
                                         "customer_city_state", "first_order_date_key", "is_current")),
    "bi_dim_date": ("dim_date", ("date_key", "date", *DATE_ATTRIBUTES)),
    "bi_dim_invoice": ("dim_invoice", ("invoice_key", "invoice_number", "po_number", "invoice_status", "is_current")),
    "bi_dim_payment_method": ("dim_payment_method", ("payment_method_key", "method_code", "method_name",
                                                     "method_type", "is_active", "is_current")),
    "bi_dim_payment_type": ("dim_payment_type", ("payment_type_key", "type_code", "type_name", "description")),
    "bi_dim_product": ("dim_product", ("product_key", "sku_number", "product_description", "brand_description",
                                       "category_description", "department_number", "department_description",
                                       "markup", "standard_price", "local_made_indicator", "is_current")),
    "bi_dim_store": ("dim_store", ("store_key", "store_id", "store_name", "store_city", "store_state",
                                   "store_region", "store_type", "open_date", "is_current")),
}
SALES_VIEW = (
    "sales_line_key", "date_key", "product_key", "customer_key", "store_key", "cashier_key", "invoice_key",
    "invoice_number", "sales_qty", "unit_price", "unit_cost", "sales_amount", "sales_cost", "gross_profit",
)
PAYMENT_VIEW = (
    "payment_key", "date_key", "customer_key", "store_key", "payment_method_key", "payment_type_key",
    "cashier_key", "invoice_key", "parent_payment_key", "payment_sequence_num", "payment_amount", "tax_amount",
    "fee_amount", "net_amount",
)
SNAPSHOT_VIEW = (
    "snapshot_key", "snapshot_date_key", "last_order_date_key", "customer_key", "lifetime_order_count",
    "lifetime_sales_amount", "orders_last_30_days", "avg_days_to_full_payment", "open_invoice_count",
    "open_invoice_total", "is_active_customer", "customer_status",
)


def dimension_view(name: str, tables) -> DataFrame:
    """A column-pruned dimension; every version is kept."""
    source, columns = DIMENSION_VIEWS[name]
    return tables[source].select(*columns)


def customer_contact(customer: DataFrame) -> DataFrame:
    """Masked contact data of customers that are not deleted."""
    return customer.where(~F.col("silver_is_deleted_flag")).select(
        clip(F.col("silver_customer_account_no"), 30).alias("customer_id"),
        clip(F.col("silver_customer_name"), 100).alias("customer_name"),
        mask_email(F.col("silver_email")).alias("email_masked"),
        mask_phone(F.col("silver_phone_number")).alias("phone_masked"),
    )


def sales_view(sales: DataFrame) -> DataFrame:
    return sales.select(*SALES_VIEW)


def payments_view(payments: DataFrame) -> DataFrame:
    """Payments with the refund flag: a row with a parent payment is a refund."""
    refund = F.col("parent_payment_key").isNotNull()
    return payments.select(
        *PAYMENT_VIEW,
        refund.alias("is_refund"),
        F.when(refund, "Refund").otherwise("Payment").alias("payment_kind"),
    )


def snapshot_view(snapshot: DataFrame, calendar: DataFrame, at_risk_days: int = AT_RISK_DAYS) -> DataFrame:
    """Snapshot with days since the last order and the at-risk flag.

    Customers that never ordered point at the 1900-01-01 member, so their gap is huge.
    """
    taken = calendar.select(F.col("date_key").alias("snapshot_date_key"), F.col("date").alias("_taken"))
    last = calendar.select(F.col("date_key").alias("last_order_date_key"), F.col("date").alias("_last"))
    days = F.datediff("_taken", "_last")
    risk = F.col("is_active_customer") & (F.col("orders_last_30_days") == 0) & (days > at_risk_days)
    return (
        snapshot.join(taken, "snapshot_date_key")
        .join(last, "last_order_date_key")
        .select(*SNAPSHOT_VIEW, days.alias("days_since_last_order"), F.coalesce(risk, F.lit(False)).alias("is_at_risk"))
    )


# -- economic context -----------------------------------------------------------
def monthly(fact: DataFrame, **sums: str) -> DataFrame:
    """Sums per YYYYMM of the date key."""
    return fact.groupBy(month_of_key(F.col("date_key")).alias("month_key")).agg(
        *[F.sum(column).alias(name) for name, column in sums.items()]
    )


def filled_series(econ: DataFrame, series_id: str, name: str) -> DataFrame:
    """Monthly values of one series; a missing value takes the last earlier known one.

    A series has one row per month, so the ordered window is bounded by the calendar;
    partitioning on the series keeps several series apart.
    """
    rows = econ.where(F.col("silver_series_id") == series_id).select(
        "silver_series_id",
        month_key(F.col("silver_observation_date")).alias("month_key"),
        F.col("silver_indicator_value").alias("_value"),
    )
    earlier = W.partitionBy("silver_series_id").orderBy("month_key").rowsBetween(W.unboundedPreceding, W.currentRow)
    return rows.select("month_key", F.last("_value", ignorenulls=True).over(earlier).alias(name))


def _percent(ratio: Column) -> Column:
    return F.round(ratio * 100, 2)


def revenue_real(sales: DataFrame, econ: DataFrame) -> DataFrame:
    """Monthly revenue restated at the prices of the newest month that has both revenue and an index.

    The base is found in a window over the months, a table bounded by the calendar, so the fact is read once.
    """
    revenue = monthly(sales, nominal_revenue="sales_amount")
    index = filled_series(econ, PRICE_SERIES, "cpi_index")
    both = revenue.join(index, "month_key")
    base = F.max_by("cpi_index", "month_key").over(W.partitionBy())
    ratio = F.col("base_cpi") / F.col("cpi_index")
    return both.withColumn("base_cpi", base).select(
        "month_key",
        "nominal_revenue",
        "cpi_index",
        "base_cpi",
        F.round(F.col("nominal_revenue") * ratio, 2).alias("real_revenue"),
        _percent(ratio - 1).alias("inflation_uplift_pct"),
    ).orderBy("month_key")


def margin_vs_paper(sales: DataFrame, econ: DataFrame) -> DataFrame:
    """Monthly margin next to the paper price index; months without an index stay."""
    months = monthly(sales, revenue="sales_amount", gross_profit="gross_profit")
    margin = F.when(F.col("revenue") != 0, _percent(F.col("gross_profit") / F.col("revenue")))
    return (
        months.withColumn("gross_margin_pct", margin)
        .join(filled_series(econ, PAPER_SERIES, "paper_ppi"), "month_key", "left")
        .orderBy("month_key")
    )
