"""Star-schema, serving, metric, quality and governance queries over the derived warehouse."""

from __future__ import annotations

from pyspark.sql import functions as F


from lakestrata.operators import quality as dq
from lakestrata.operators.asof import as_of_lookup, key_lookup
from lakestrata.operators.calendar import calendar_rows, role_view
from lakestrata.operators.changelog import before_image, change_log, change_reasons
from lakestrata.operators.contract import violations
from lakestrata.operators.keys import assign_keys
from lakestrata.operators.merge import append_once, replace_keys
from lakestrata.operators.scd import close_superseded, detect, new_versions, scd1_apply, version_changes
from lakestrata.operators.sieve import semi
from lakestrata.plans import facts, governance as gov, metrics, serving
from lakestrata.plans.dimensions import stage_payment_type
from lakestrata.plans.silver import SPECS
from lakestrata.plans.suite import column_tests
from lakestrata.session import stage

from . import given
from .duck import STAGES as SQL_STAGES
from .registry import query
from .source_sql import RUN_2
from .star import BATCH, DIMENSIONS, landed, star

_VERSION = "source_record_id row_version:l valid_from valid_to is_current:b record_hash is_deleted:b"
_ATTRS = {
    "dim_customer": "customer_id customer_name customer_street_address customer_city customer_county customer_state "
                    "customer_city_state first_order_date_key:l",
    "dim_cashier": "cashier_id cashier_first_name cashier_last_name cashier_full_name is_active store_id store_name",
    "dim_invoice": "invoice_number po_number invoice_date invoice_status invoice_total:d customer_id customer_name "
                   "store_id store_name",
    "dim_payment_method": "method_code method_name method_type is_active:b",
    "dim_product": "sku_number product_description brand_description category_description department_number "
                   "department_description markup:d standard_price:d local_made_indicator",
    "dim_store": "store_id store_name store_city store_state store_region store_type open_date",
}


def _dimension(name: str) -> None:
    key = DIMENSIONS[name].key

    @query(f"{key}:l {_VERSION} {_ATTRS[name]}", f"SELECT * FROM {name}", name=name)
    def table(spark, sf):
        return star(spark, sf).dim(name)


for _name in DIMENSIONS:
    _dimension(_name)

# -- calendar ---------------------------------------------------------------------
_CAL = ("date_key:l date full_date_description day_of_week day_number_in_calendar_month:l last_day_in_month_indicator "
        "calendar_week_ending_date calendar_month_name calendar_month_number_in_year:l calendar_quarter:l "
        "calendar_year_quarter calendar_year:l calendar_year_month holiday_indicator weekday_indicator")


@query(_CAL, "SELECT * FROM dim_date")
def dim_date(spark, sf):
    return star(spark, sf).dim_date()


@query("o_orderkey:l holiday_indicator weekday_indicator calendar_week_ending_date",
       "SELECT o_orderkey, d.* FROM orders JOIN dim_date d ON d.date = CAST(o_orderdate AS DATE)")
def dim_date_attributes(spark, sf):
    """Calendar attributes computed straight on the order dates."""
    days = given.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    attributes = calendar_rows(days.select("date").distinct(), RUN_2)
    return days.join(attributes, "date")


@query("source_record_id last_order_date last_order_calendar_year_quarter last_order_weekday_indicator", """
    SELECT f.source_record_id, d.date AS last_order_date, d.calendar_year_quarter AS last_order_calendar_year_quarter,
      d.weekday_indicator AS last_order_weekday_indicator FROM snapshot f JOIN dim_date d ON d.date_key = f.last_order_date_key""")
def dim_date_role_view(spark, sf):
    s = star(spark, sf)
    return s.snapshot().join(role_view(s.dim_date(), "last_order"), "last_order_date_key")


# -- type 1 -------------------------------------------------------------------------
@query("payment_type_key:l type_code type_name description is_deleted:b", "SELECT * FROM dim_payment_type")
def dim_payment_type(spark, sf):
    return star(spark, sf).dim_payment_type()


@query("brand_key:l brand parts:l", """
    WITH b AS (SELECT p_brand AS brand, count(*) AS parts FROM part GROUP BY 1),
    old AS (SELECT row_number() OVER (ORDER BY brand) AS brand_key, brand FROM b WHERE brand < 'Brand#2'),
    fresh AS (SELECT brand FROM b WHERE brand >= 'Brand#2')
    SELECT coalesce(o.brand_key, (SELECT max(brand_key) FROM old) + n.rn) AS brand_key, b.brand, b.parts FROM b
    LEFT JOIN old o ON o.brand = b.brand LEFT JOIN (SELECT brand, row_number() OVER (ORDER BY brand) AS rn FROM fresh) n ON n.brand = b.brand
    UNION ALL SELECT -1, 'Not Provided', 0""")
def dim_scd1_merge(spark, sf):
    """Known brands keep their key, new ones continue after the highest."""
    brands = given.table(spark, sf, "part").groupBy(F.col("p_brand").alias("brand")).agg(F.count(F.lit(1)).alias("parts"))
    unknown = {"brand_key": F.lit(-1), "brand": F.lit("Not Provided"), "parts": F.lit(0)}
    first = scd1_apply(brands.where("brand < 'Brand#2'"), None, "brand", "brand_key", RUN_2, unknown)
    return scd1_apply(brands, first, "brand", "brand_key", RUN_2, unknown)


# -- type 2 steps -------------------------------------------------------------------
@query("source_record_id record_hash customer_state first_order_date_key:l", "SELECT * FROM stg_dim_customer")
def dim_scd2_stage_hash(spark, sf):
    return star(spark, sf).staged("dim_customer")


@query("source_record_id current_row_version:l brand_description",
       "SELECT source_record_id, 1 AS current_row_version, brand_description FROM new_dim_product")
def dim_scd2_detect(spark, sf):
    s = star(spark, sf)
    return detect(s.staged("dim_product"), s.dim("dim_product", 1))


@query("invoice_key:l source_record_id row_version:l valid_from valid_to is_current:b etl_batch_id",
       f"SELECT *, '{BATCH[2]}' AS etl_batch_id FROM new_dim_invoice")
def dim_scd2_versions(spark, sf):
    s = star(spark, sf)
    return new_versions(DIMENSIONS["dim_invoice"], s.staged("dim_invoice"), s.dim("dim_invoice", 1), BATCH[2], RUN_2)


@query("customer_key:l row_version:l valid_to is_current:b", """
    SELECT * FROM dim_customer WHERE row_version = 1""")
def dim_scd2_close(spark, sf):
    s = star(spark, sf)
    added = s.dim("dim_customer").where("row_version = 2")
    return close_superseded(s.dim("dim_customer", 1), added, "customer_key", RUN_2)


@query("dimension key:l source_record_id label n:l", """
    SELECT 'dim_customer' AS dimension, customer_key AS key, source_record_id, customer_name AS label, (SELECT count(*) FROM dim_customer) AS n
    FROM dim_customer WHERE customer_key = -1
    UNION ALL SELECT 'dim_product', product_key, source_record_id, sku_number, (SELECT count(*) FROM dim_product) FROM dim_product WHERE product_key = -1""")
def dim_unknown_member(spark, sf):
    s = star(spark, sf)

    def one(name, key, label):
        d = s.dim(name)
        n = d.agg(F.count(F.lit(1)).alias("n"))
        return d.where(F.col(key) == -1).select(F.lit(name).alias("dimension"), F.col(key).alias("key"),
                                                "source_record_id", F.col(label).alias("label")).crossJoin(n)

    return one("dim_customer", "customer_key", "customer_name").unionByName(one("dim_product", "product_key", "sku_number"))


@query("source_record_id row_version:l column_name old_value new_value", """
    SELECT n.source_record_id, 2 AS row_version, 'brand_description' AS column_name, o.brand_description AS old_value, n.brand_description AS new_value
    FROM new_dim_product n JOIN dim_product_1 o ON o.source_record_id = n.source_record_id""")
def dim_change_log(spark, sf):
    return version_changes(star(spark, sf).dim("dim_product"), DIMENSIONS["dim_product"].attributes)


@query("source_record_id row_version:l valid_from valid_to", """
    SELECT source_record_id, row_version, valid_from, valid_to FROM dim_customer
    WHERE row_version > 1 AND valid_from >= DATE '1998-06-01' AND valid_from < DATE '1998-07-01'""")
def dim_versions_in_window(spark, sf):
    d = star(spark, sf).dim("dim_customer")
    return d.where("row_version > 1 and valid_from >= '1998-06-01' and valid_from < '1998-07-01'")


@query("k:l o_orderkey:l", """
    SELECT row_number() OVER (ORDER BY CAST(o_orderkey AS VARCHAR)) AS k, o_orderkey FROM orders""")
def dim_surrogate_keys(spark, sf):
    """Dense keys in text order over all orders."""
    o = given.table(spark, sf, "orders").select("o_orderkey")
    return assign_keys(o, [F.col("o_orderkey").cast("string")], "k")


# -- facts --------------------------------------------------------------------------
@query("invoice_number", "SELECT invoice_number FROM changed_invoices")
def fct_changed_invoices(spark, sf):
    return star(spark, sf).changed_invoices()


@query("source_record_id", "SELECT CAST(silver_payment_id AS VARCHAR) AS source_record_id FROM chg_payment")
def fct_changed_payments(spark, sf):
    return star(spark, sf).changed_payments()


@query("o_orderkey:l customer_key:l", """
    SELECT o_orderkey, coalesce(c.customer_key, -1) AS customer_key FROM orders LEFT JOIN dim_customer c
    ON c.source_record_id = CAST(o_custkey AS VARCHAR) AND CAST(o_orderdate AS DATE) >= c.valid_from
    AND (CAST(o_orderdate AS DATE) < c.valid_to OR c.valid_to IS NULL)""")
def fct_asof_lookup(spark, sf):
    """Customer version valid on each order date."""
    o = given.table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("d"))
    return as_of_lookup(o, star(spark, sf).dim("dim_customer"), "o_custkey", "d", "customer_key")


@query("l_orderkey:l l_linenumber:l ship_date_key:l", """
    SELECT l_orderkey, l_linenumber, coalesce(d.date_key, -1) AS ship_date_key FROM lineitem LEFT JOIN dim_date d ON d.date = CAST(l_shipdate AS DATE)""")
def fct_key_lookup(spark, sf):
    rows = given.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("d"))
    return key_lookup(rows, star(spark, sf).dim_date(), "d", "date", "date_key", "ship_date_key")


_SALES = ("sales_line_key:l date_key:l cashier_key:l product_key:l customer_key:l store_key:l invoice_key:l invoice_number "
          "sales_qty:l unit_price:d unit_cost:d sales_amount:d sales_cost:d gross_profit:d source_record_id")


@query(_SALES, "SELECT * FROM sales_1")
def fct_sales(spark, sf):
    return star(spark, sf).sales(1)


@query(_SALES, "SELECT * FROM sales")
def fct_replace_by_invoice(spark, sf):
    """Changed invoices are deleted and reinserted with new keys."""
    return star(spark, sf).sales()


_PAY = ("payment_key:l invoice_key:l customer_key:l payment_method_key:l date_key:l payment_type_key:l cashier_key:l "
        "store_key:l parent_payment_key:l payment_sequence_num:l payment_amount:d tax_amount:d fee_amount:d net_amount:d "
        "source_record_id")


@query(_PAY, """SELECT c.*, p.payment_key AS parent_payment_key FROM payments_1 c
    LEFT JOIN payments_1 p ON p.source_record_id = CAST(c.parent_payment_id AS VARCHAR)""")
def fct_payments(spark, sf):
    return star(spark, sf).payments(1)


@query(_PAY, "SELECT * FROM payments")
def fct_payments_refund_chain(spark, sf):
    """After a reload, refunds point at the new key of their payment."""
    return star(spark, sf).payments()


@query("method_key:l refunds:l refund_total:d", """
    SELECT p.payment_method_key AS method_key, count(*) AS refunds, sum(c.payment_amount) AS refund_total
    FROM payments c JOIN payments p ON p.payment_key = c.parent_payment_key GROUP BY 1""")
def fct_refunds_by_parent(spark, sf):
    p = star(spark, sf).payments()
    parent = p.select(F.col("payment_key").alias("_k"), F.col("payment_method_key").alias("method_key"))
    return p.join(parent, F.col("parent_payment_key") == F.col("_k")).groupBy("method_key").agg(
        F.count(F.lit(1)).alias("refunds"), F.sum("payment_amount").alias("refund_total"))


@query("invoice_number change_reason", """
    SELECT i.silver_invoice_number AS invoice_number, string_agg(r, '; ' ORDER BY r) AS change_reason
    FROM (SELECT DISTINCT silver_invoice_id, silver_adjustment_reason AS r FROM sv_invoice_adjustment WHERE silver_adjustment_reason IS NOT NULL) a
    JOIN sv_invoice i ON i.silver_invoice_id = a.silver_invoice_id GROUP BY 1""")
def fct_change_reason(spark, sf):
    s = star(spark, sf)
    return change_reasons(s.silver("invoice_adjustment"), s.silver("invoice"))


@query("sales_line_key:l invoice_number source_record_id", """
    SELECT * FROM sales_1 WHERE invoice_number IN (SELECT invoice_number FROM changed_invoices)""")
def fct_before_image(spark, sf):
    s = star(spark, sf)
    return before_image(s.sales(1), s.changed_invoices(), "invoice_number", stored=True)


_TRAIL = "table_name operation_type record_key changed_columns change_reason old_amount:d new_amount:d etl_batch_id"
_DIFF = ("cashier_key", "customer_key", "date_key", "gross_profit", "invoice_key", "product_key", "sales_amount", "sales_cost",
         "sales_qty", "store_key", "unit_cost", "unit_price")


def _sales_trail(s):
    # only reloaded invoices have a trail, so only their reasons are gathered
    invoices = s.silver("invoice").select("silver_invoice_id", "silver_invoice_number")
    changed = s.changed_invoices().select(F.col("invoice_number").alias("silver_invoice_number"))
    wanted = stage(semi(invoices, changed, ["silver_invoice_number"]), "changed-ids")
    return change_log(
        before_image(s.sales(1), s.changed_invoices(), "invoice_number", stored=True), s.new_sales(),
        table="gold.fact_retail_sales", surrogate_key="sales_line_key", record_key="invoice_number", batch_id=BATCH[2],
        run_ts=RUN_2, reasons=change_reasons(s.silver("invoice_adjustment"), wanted, stored=True))


def _readable(trail, column):
    return trail.withColumns({
        "changed_columns": F.array_join("changed_columns", ","),
        "old_amount": F.get_json_object("old_row", f"$.{column}").cast("decimal(12,2)"),
        "new_amount": F.get_json_object("new_row", f"$.{column}").cast("decimal(12,2)"),
    })


@query(_TRAIL, f"""
    SELECT 'gold.fact_retail_sales' AS table_name, 'UPDATE' AS operation_type, o.invoice_number AS record_key,
      nullif(concat_ws(',', {", ".join(f"CASE WHEN o.{c} IS DISTINCT FROM n.{c} THEN '{c}' END" for c in _DIFF)}), '') AS changed_columns,
      coalesce(r.change_reason, 'source_update') AS change_reason, o.sales_amount AS old_amount, n.sales_amount AS new_amount, '{BATCH[2]}' AS etl_batch_id
    FROM sales_1 o JOIN sales_new n ON n.source_record_id = o.source_record_id LEFT JOIN (
      SELECT i.silver_invoice_number AS invoice_number, string_agg(DISTINCT silver_adjustment_reason, '; ' ORDER BY silver_adjustment_reason) AS change_reason
      FROM sv_invoice_adjustment a JOIN sv_invoice i ON i.silver_invoice_id = a.silver_invoice_id WHERE silver_adjustment_reason IS NOT NULL GROUP BY 1) r
    ON r.invoice_number = o.invoice_number""")
def fct_change_log(spark, sf):
    return _readable(_sales_trail(star(spark, sf)), "sales_amount")


@query(_TRAIL, f"""
    SELECT 'gold.fact_payments' AS table_name, CASE WHEN n.source_record_id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operation_type,
      o.source_record_id AS record_key, NULL AS changed_columns, 'source_update' AS change_reason, o.payment_amount AS old_amount,
      n.payment_amount AS new_amount, '{BATCH[2]}' AS etl_batch_id
    FROM payments_1 o LEFT JOIN (SELECT * FROM payments_1 WHERE payment_sequence_num = 1) n ON n.source_record_id = o.source_record_id""")
def fct_change_log_deletes(spark, sf):
    """Payments without a successor are reported as deleted; untouched ones have no changed columns."""
    p = star(spark, sf).payments(1)
    log = change_log(p, p.where("payment_sequence_num = 1"), table="gold.fact_payments", surrogate_key="payment_key",
                     record_key="source_record_id", batch_id=BATCH[2], run_ts=RUN_2)
    return _readable(log, "payment_amount")


_SNAP = ("snapshot_key:l snapshot_date_key:l customer_key:l last_order_date_key:l lifetime_order_count:l lifetime_sales_amount:d "
         "orders_last_30_days:l avg_days_to_full_payment:d open_invoice_count:l open_invoice_total:d is_active_customer:b "
         "customer_status source_record_id")


@query(_SNAP, "SELECT * FROM snapshot")
def fct_customer_snapshot(spark, sf):
    return star(spark, sf).snapshot()


@query("silver_customer_id:l avg_days_to_full_payment:d", "SELECT silver_customer_id, days AS avg_days_to_full_payment FROM pace")
def fct_payment_speed(spark, sf):
    s = star(spark, sf)
    return facts.payment_speed(s.silver("invoice"), s.silver("payment"), s.snapshot_day())


@query("silver_customer_id:l lifetime_order_count:l lifetime_sales_amount:d orders_last_30_days:l open_invoice_count:l "
       "open_invoice_total:d last_order_date", """
    SELECT silver_customer_id, ordered.orders AS lifetime_order_count, worth AS lifetime_sales_amount,
      coalesce(lately.orders, 0) AS orders_last_30_days, coalesce(invoices, 0) AS open_invoice_count,
      coalesce(owed, 0) AS open_invoice_total, ordered_on AS last_order_date
    FROM ordered JOIN newest_order USING (silver_customer_id) LEFT JOIN lately USING (silver_customer_id)
    LEFT JOIN owing USING (silver_customer_id)""")
def fct_invoice_behaviour(spark, sf):
    s = star(spark, sf)
    return facts.invoice_behaviour(s.silver("invoice"), s.snapshot_day())


@query("snapshot_date_key:l rows:l", """
    SELECT year(d) * 10000 + month(d) * 100 + day(d) AS snapshot_date_key, count(*) AS rows FROM sv_customer CROSS JOIN snap_day GROUP BY 1""")
def fct_snapshot_append_once(spark, sf):
    """Appending the same snapshot date a second time adds nothing."""
    s = star(spark, sf)
    stored = s.snapshot()
    again = facts.snapshot_rows(s.tables(), s.snapshot_day())
    added = append_once(stored, again, ["snapshot_date_key"])
    both = stored.select(*added.columns).unionByName(added)
    return both.groupBy("snapshot_date_key").agg(F.count(F.lit(1)).alias("rows"))


@query("silver_invoice_id:l n:l", """
    SELECT silver_invoice_id, 1 AS n FROM sv_invoice WHERE silver_invoice_id % 13 <> 1""")
def snk_replace_with_removed(spark, sf):
    """Keys of the changed set that have no new rows disappear."""
    inv = star(spark, sf).silver("invoice").select("silver_invoice_id", F.lit(1).alias("n"))
    gone = inv.where("silver_invoice_id % 13 = 1")
    return replace_keys(inv, inv.where("false"), ["silver_invoice_id"], gone)


# -- serving ------------------------------------------------------------------------
def _view(name: str, columns: str) -> None:
    source, picked = serving.DIMENSION_VIEWS[name]

    @query(columns, f"SELECT {', '.join(picked)} FROM {source}", name=name)
    def view(spark, sf):
        return serving.dimension_view(name, star(spark, sf).tables())


for _v, _c in {
    "bi_dim_cashier": "cashier_key:l cashier_id cashier_first_name cashier_last_name cashier_full_name is_active store_id store_name is_current:b",
    "bi_dim_customer": "customer_key:l customer_id customer_name customer_street_address customer_city customer_county "
                       "customer_state customer_city_state first_order_date_key:l is_current:b",
    "bi_dim_date": _CAL,
    "bi_dim_invoice": "invoice_key:l invoice_number po_number invoice_status is_current:b",
    "bi_dim_payment_method": "payment_method_key:l method_code method_name method_type is_active:b is_current:b",
    "bi_dim_payment_type": "payment_type_key:l type_code type_name description",
    "bi_dim_product": "product_key:l sku_number product_description brand_description category_description department_number "
                      "department_description markup:d standard_price:d local_made_indicator is_current:b",
    "bi_dim_store": "store_key:l store_id store_name store_city store_state store_region store_type open_date is_current:b",
}.items():
    _view(_v, _c)


@query("customer_id customer_name email_masked phone_masked", r"""
    SELECT left(silver_customer_account_no, 30) AS customer_id, left(silver_customer_name, 100) AS customer_name,
      CASE WHEN silver_email <> '' THEN left(silver_email, 1) || '***@' || split_part(silver_email, '@', 2) END AS email_masked,
      '***-***-' || right(silver_phone_number, 4) AS phone_masked FROM sv_customer WHERE NOT silver_is_deleted_flag""")
def bi_mask_contact(spark, sf):
    return serving.customer_contact(star(spark, sf).silver("customer"))


@query("sales_line_key:l date_key:l product_key:l customer_key:l store_key:l cashier_key:l invoice_key:l invoice_number "
       "sales_qty:l unit_price:d unit_cost:d sales_amount:d sales_cost:d gross_profit:d", "SELECT * FROM sales")
def bi_fact_sales(spark, sf):
    return serving.sales_view(star(spark, sf).sales())


@query("payment_key:l date_key:l parent_payment_key:l payment_amount:d net_amount:d is_refund:b payment_kind",
       "SELECT * FROM bi_payments")
def bi_payments_kind(spark, sf):
    return star(spark, sf).bi_payments()


@query("snapshot_key:l customer_key:l days_since_last_order:l is_at_risk:b is_active_customer:b", "SELECT * FROM bi_snapshot")
def bi_at_risk(spark, sf):
    return star(spark, sf).bi_snapshot()


_MONTHS = "SELECT date_key // 100 AS month_key, sum(sales_amount) AS revenue, sum(gross_profit) AS gross_profit FROM sales GROUP BY 1"


def _filled(series: str) -> str:
    """A series by month; a month without a value takes the last one known."""
    return f"""SELECT year(silver_observation_date) * 100 + month(silver_observation_date) AS month_key,
        last_value(silver_indicator_value IGNORE NULLS) OVER (
          ORDER BY silver_observation_date ROWS UNBOUNDED PRECEDING) AS v
      FROM sv_econ_indicator WHERE silver_series_id = '{series}'"""


@query("month_key:l nominal_revenue:d cpi_index:d base_cpi:d real_revenue:d inflation_uplift_pct:d", f"""
    SELECT month_key, revenue AS nominal_revenue, v AS cpi_index, base_cpi,
      round(CAST(revenue AS DOUBLE) * ratio, 2) AS real_revenue, round((ratio - 1) * 100, 2) AS inflation_uplift_pct
    FROM (SELECT *, CAST(base_cpi AS DOUBLE) / CAST(v AS DOUBLE) AS ratio
      FROM (SELECT month_key, revenue, v, arg_max(v, month_key) OVER () AS base_cpi
        FROM ({_MONTHS}) sold JOIN ({_filled('CPIAUCSL')}) index USING (month_key)))""")
def bi_revenue_real(spark, sf):
    s = star(spark, sf)
    return serving.revenue_real(s.sales(), s.silver("econ_indicator"))


@query("month_key:l revenue:d gross_profit:d gross_margin_pct:d paper_ppi:d", f"""
    SELECT month_key, revenue, gross_profit, v AS paper_ppi,
      round(100 * CAST(gross_profit AS DOUBLE) / nullif(CAST(revenue AS DOUBLE), 0), 2) AS gross_margin_pct
    FROM ({_filled('WPU0911')}) index RIGHT JOIN ({_MONTHS}) sold USING (month_key)""")
def bi_margin_vs_cost(spark, sf):
    s = star(spark, sf)
    return serving.margin_vs_paper(s.sales(), s.silver("econ_indicator"))


# -- metrics ------------------------------------------------------------------------
_KPI = ("total_sales:d total_cost:d gross_profit:d total_quantity:l order_count:l gross_margin:d avg_selling_price:d avg_order_value:d")


def _kpi_sql(by: str, source: str) -> str:
    group = f"{by}, " if by else ""
    return f"""SELECT {group}total_sales, total_cost, gross_profit, total_quantity, order_count,
      round(CAST(gross_profit AS DOUBLE) / nullif(CAST(total_sales AS DOUBLE), 0), 6) AS gross_margin,
      round(CAST(total_sales AS DOUBLE) / nullif(total_quantity, 0), 6) AS avg_selling_price,
      round(CAST(total_sales AS DOUBLE) / nullif(order_count, 0), 6) AS avg_order_value
    FROM (SELECT {group}sum(sales_amount) AS total_sales, sum(sales_cost) AS total_cost, sum(gross_profit) AS gross_profit,
        sum(sales_qty) AS total_quantity, count(DISTINCT invoice_number) AS order_count FROM {source} {'GROUP BY ' + by if by else ''}) k"""


@query(_KPI, _kpi_sql("", "sales"))
def met_sales_kpis(spark, sf):
    return metrics.sales_kpis(star(spark, sf).sales())


@query("customer_key:l order_count:l avg_order_value:d total_sales:d", _kpi_sql("customer_key", "sales"))
def met_orders_aov(spark, sf):
    return metrics.sales_kpis(star(spark, sf).sales(), ["customer_key"])


@query("year:l month:l total_sales:d sales_ly:d sales_yoy:d sales_ytd:d", """
    WITH m AS (SELECT calendar_year AS year, calendar_month_number_in_year AS month, sum(sales_amount) AS total_sales
               FROM sales f JOIN dim_date d ON d.date_key = f.date_key WHERE d.date_key <> -1 GROUP BY 1, 2)
    SELECT m.year, m.month, m.total_sales, l.total_sales AS sales_ly,
      round(CAST(m.total_sales - l.total_sales AS DOUBLE) / nullif(CAST(l.total_sales AS DOUBLE), 0), 6) AS sales_yoy,
      sum(m.total_sales) OVER (PARTITION BY m.year ORDER BY m.month) AS sales_ytd
    FROM m LEFT JOIN m l ON l.year = m.year - 1 AND l.month = m.month""")
def met_yoy_ytd(spark, sf):
    s = star(spark, sf)
    return metrics.sales_over_time(s.sales(), s.dim_date())


def _collect_sql(by: str, source: str) -> str:
    group = f"{by}, " if by else ""
    return f"""SELECT *, round(CAST(-total_refunds AS DOUBLE) / nullif(CAST(gross_payments AS DOUBLE), 0), 6) AS refund_rate FROM (
      SELECT {group}sum(payment_amount) AS net_collected, coalesce(sum(payment_amount) FILTER (WHERE NOT is_refund), 0) AS gross_payments,
        coalesce(sum(payment_amount) FILTER (WHERE is_refund), 0) AS total_refunds, count(*) FILTER (WHERE is_refund) AS refund_count,
        sum(fee_amount) AS total_fees, sum(tax_amount) AS total_tax FROM {source} {'GROUP BY ' + by if by else ''}) k"""


_COLLECT = "net_collected:d gross_payments:d total_refunds:d refund_count:l total_fees:d total_tax:d refund_rate:d"


@query(_COLLECT, _collect_sql("", "bi_payments"))
def met_collections(spark, sf):
    return metrics.collections(star(spark, sf).bi_payments())


_HEALTH = "customers:l at_risk_customers:l open_invoice_total:d at_risk_share:d avg_days_to_pay:d"


def _health_sql(by: str, source: str) -> str:
    group = f"{by}, " if by else ""
    return f"""SELECT {group}count(DISTINCT customer_key) AS customers, count(DISTINCT customer_key) FILTER (WHERE is_at_risk) AS at_risk_customers,
      sum(open_invoice_total) AS open_invoice_total,
      round(CAST(count(DISTINCT customer_key) FILTER (WHERE is_at_risk) AS DOUBLE) / count(DISTINCT customer_key), 6) AS at_risk_share,
      round(CAST(sum(avg_days_to_full_payment) AS DOUBLE) / nullif(count(avg_days_to_full_payment), 0), 6) AS avg_days_to_pay
    FROM {source} {'GROUP BY ' + by if by else ''}"""


@query(_HEALTH, _health_sql("", "bi_snapshot"))
def met_latest_snapshot(spark, sf):
    return metrics.customer_health(star(spark, sf).bi_snapshot())


@query("customer_state " + _HEALTH, _health_sql("customer_state", "bi_snapshot b JOIN dim_customer c USING (customer_key)"))
def met_health_by_state(spark, sf):
    s = star(spark, sf)
    labelled = s.bi_snapshot().join(s.dim("dim_customer").select("customer_key", "customer_state"), "customer_key")
    return metrics.customer_health(labelled, ["customer_state"])


@query("department_description " + _KPI, _kpi_sql("department_description", "sales f JOIN dim_product p USING (product_key)"))
def met_sales_by_department(spark, sf):
    s = star(spark, sf)
    return metrics.sales_by(s.sales(), s.dim("dim_product"), "product_key", "department_description")


@query("store_name " + _KPI, _kpi_sql("store_name", "sales f JOIN dim_store p USING (store_key)"))
def met_sales_by_store(spark, sf):
    s = star(spark, sf)
    return metrics.sales_by(s.sales(), s.dim("dim_store"), "store_key", "store_name")


@query("method_name " + _COLLECT, _collect_sql("method_name", "bi_payments f JOIN dim_payment_method m USING (payment_method_key)"))
def met_collections_by_method(spark, sf):
    s = star(spark, sf)
    return metrics.collections_by(s.bi_payments(), s.dim("dim_payment_method"), "payment_method_key", "method_name")


@query("type_name " + _COLLECT, _collect_sql("type_name", "bi_payments f JOIN dim_payment_type m USING (payment_type_key)"))
def met_collections_by_type(spark, sf):
    s = star(spark, sf)
    return metrics.collections_by(s.bi_payments(), s.dim_payment_type(), "payment_type_key", "type_name")


@query("po_number net_collected:d refund_count:l", """
    SELECT po_number, sum(payment_amount) AS net_collected, count(*) FILTER (WHERE is_refund) AS refund_count
    FROM bi_payments f JOIN dim_invoice i USING (invoice_key) WHERE po_number <> 'Not Provided' GROUP BY 1""")
def met_collections_by_po(spark, sf):
    s = star(spark, sf)
    return metrics.collections_by_po(s.bi_payments(), s.dim("dim_invoice"))


@query("customer_key:l customer_name days_since_last_order:l open_invoice_total:d", """
    SELECT b.customer_key, c.customer_name, days_since_last_order, open_invoice_total FROM bi_snapshot b JOIN dim_customer c USING (customer_key)
    WHERE is_at_risk""")
def met_at_risk_list(spark, sf):
    s = star(spark, sf)
    return metrics.at_risk_list(s.bi_snapshot(), s.dim("dim_customer"))


# -- star queries -------------------------------------------------------------------
@query("calendar_year_month department_description sales:d gross_profit:d", """
    SELECT calendar_year_month, department_description, sum(amount) AS sales, sum(profit) AS gross_profit
    FROM (SELECT date_key, product_key, sum(sales_amount) AS amount, sum(gross_profit) AS profit FROM sales GROUP BY ALL)
    JOIN dim_date USING (date_key) JOIN dim_product USING (product_key) GROUP BY ALL""")
def qry_profit_by_month(spark, sf):
    s = star(spark, sf)
    return metrics.profit_by_month(s.sales(), s.dim_date(), s.dim("dim_product"))


@query("method_name net_collected:d refund_count:l", """
    SELECT method_name, sum(total) AS net_collected, CAST(sum(refunds) AS BIGINT) AS refund_count
    FROM (SELECT payment_method_key, sum(payment_amount) AS total, count(parent_payment_key) AS refunds FROM payments GROUP BY ALL)
    JOIN dim_payment_method USING (payment_method_key) GROUP BY ALL""")
def qry_collections_by_method(spark, sf):
    s = star(spark, sf)
    return metrics.collections_by_method(s.payments(), s.dim("dim_payment_method"))


@query("customer_name snapshot_date last_order_date lifetime_sales_amount:d open_invoice_total:d", """
    WITH day AS (SELECT MAP(list(date_key), list(date)) AS of FROM dim_date),
    ranked AS (SELECT customer_name, day.of[snapshot_date_key] AS snapshot_date, day.of[last_order_date_key] AS last_order_date,
        lifetime_sales_amount, open_invoice_total, row_number() OVER (ORDER BY lifetime_sales_amount DESC, customer_name) AS place
      FROM snapshot JOIN dim_customer USING (customer_key), day)
    SELECT * EXCLUDE (place) FROM ranked WHERE place <= 20""")
def qry_top_customers(spark, sf):
    s = star(spark, sf)
    cal = s.dim_date()
    return metrics.top_customers(s.snapshot(), s.dim("dim_customer"), role_view(cal, "snapshot"), role_view(cal, "last_order"))


@query("key_column rows:l unmatched:l unmatched_rate:d", " UNION ALL ".join(
    f"SELECT '{k}' AS key_column, count(*) AS rows, count(*) FILTER (WHERE {k} = -1) AS unmatched, "
    f"round(CAST(count(*) FILTER (WHERE {k} = -1) AS DOUBLE) / count(*), 6) AS unmatched_rate FROM sales"
    for k in ("date_key", "cashier_key", "product_key", "customer_key", "store_key", "invoice_key")))
def qry_unmatched_rate(spark, sf):
    keys = ["date_key", "cashier_key", "product_key", "customer_key", "store_key", "invoice_key"]
    return gov.unmatched_rate(star(spark, sf).sales(), keys)


@query("source_record_id row_version:l initiated_by load_type batch_start_timestamp", """
    SELECT source_record_id, row_version, initiated_by, load_type, batch_start_timestamp
    FROM dim_invoice JOIN ledger ON batch_key = row_version WHERE invoice_key > 0""")
def qry_lineage(spark, sf):
    """Dimension versions with the load that wrote them; the first two ledger rows stand for the two loads."""
    own = F.create_map(*(F.lit(x) for pair in BATCH.items() for x in pair))
    ledger = given.ledger(spark, sf)
    ledger = ledger.withColumn("batch_id", F.coalesce(F.try_element_at(own, F.col("batch_key").cast("int")), "batch_id"))
    return gov.version_lineage(star(spark, sf).dim("dim_invoice").where("invoice_key > 0"), ledger)


@query("table_name operation_type record_key changed_columns", f"""
    SELECT 'gold.fact_retail_sales' AS table_name, 'UPDATE' AS operation_type, record_key, changed_columns FROM (
      SELECT o.invoice_number AS record_key,
        nullif(concat_ws(',', {", ".join(f"CASE WHEN o.{c} IS DISTINCT FROM n.{c} THEN '{c}' END" for c in _DIFF)}), '') AS changed_columns
      FROM sales_1 o JOIN sales_new n ON n.source_record_id = o.source_record_id) x
    ORDER BY record_key, changed_columns NULLS FIRST LIMIT 20""")
def qry_recent_changes(spark, sf):
    top = gov.recent_changes(_sales_trail(star(spark, sf)))
    return top.withColumn("changed_columns", F.array_join("changed_columns", ","))


@query("silver_invoice_id:l status entered_at left_at hours_in_status:l", """
    SELECT silver_invoice_id, silver_new_status AS status, silver_changed_at_timestamp AS entered_at, left_at,
      date_sub('hour', silver_changed_at_timestamp, left_at) AS hours_in_status
    FROM (SELECT *, lead(silver_changed_at_timestamp) OVER (PARTITION BY silver_invoice_id ORDER BY silver_changed_at_timestamp, silver_status_history_id) AS left_at
          FROM sv_invoice_status_history) h""")
def qry_status_duration(spark, sf):
    return gov.status_durations(star(spark, sf).silver("invoice_status_history"), "silver_invoice_id")


@query("status entries:l completed:l avg_hours:d", """
    SELECT silver_new_status AS status, count(*) AS entries, count(h) AS completed, round(CAST(sum(h) AS DOUBLE) / nullif(count(h), 0), 4) AS avg_hours
    FROM (SELECT *, date_sub('hour', silver_changed_at_timestamp, lead(silver_changed_at_timestamp) OVER (PARTITION BY silver_invoice_id
            ORDER BY silver_changed_at_timestamp, silver_status_history_id)) AS h FROM sv_invoice_status_history) x GROUP BY 1""")
def qry_cycle_time(spark, sf):
    return gov.status_cycle_time(star(spark, sf).silver("invoice_status_history"), "silver_invoice_id")


# -- data quality -------------------------------------------------------------------
@query("silver_invoice_id:l", "SELECT silver_invoice_id FROM sv_invoice WHERE silver_invoice_status IS NULL")
def dq_not_null(spark, sf):
    return dq.not_null(star(spark, sf).silver("invoice"), "silver_invoice_status")


@query("l_orderkey:l l_linenumber:l n:l",
       "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dq_unique(spark, sf):
    return dq.unique(given.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("o_orderpriority n:l", """
    SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1""")
def dq_accepted_values(spark, sf):
    return dq.accepted_values(given.table(spark, sf, "orders"), "o_orderpriority", ("1-URGENT", "2-HIGH", "3-MEDIUM"))


@query("silver_state_code n:l", """
    SELECT silver_state_code, count(*) AS n FROM sv_customer_address WHERE silver_state_code IS NOT NULL
    AND silver_state_code NOT IN (SELECT silver_state_code FROM sv_state) GROUP BY 1""")
def dq_relationships(spark, sf):
    s = star(spark, sf)
    return dq.relationships(s.silver("customer_address"), "silver_state_code", s.silver("state"), "silver_state_code")


@query("test n:l", """
    SELECT 'not_null silver_invoice_status' AS test, count(*) AS n FROM sv_invoice WHERE silver_invoice_status IS NULL HAVING count(*) > 0
    UNION ALL SELECT 'accepted_values silver_invoice_status', count(*) FROM sv_invoice WHERE silver_invoice_status NOT IN ('open', 'paid') HAVING count(*) > 0""")
def dq_column_tests(spark, sf):
    """Several column tests of one table in one scan."""
    return column_tests(star(spark, sf).silver("invoice"), ["silver_invoice_id", "silver_invoice_status"],
                        {"silver_invoice_status": ("open", "paid")})


@query("rule n:l", """
    SELECT 'null silver_po_number' AS rule, count(*) AS n FROM sv_invoice WHERE silver_po_number IS NULL
    UNION ALL SELECT 'duplicate key', count(*) FROM (SELECT silver_customer_id FROM sv_invoice GROUP BY 1 HAVING count(*) > 1) d""")
def dq_contract(spark, sf):
    return violations(star(spark, sf).silver("invoice"), ["silver_invoice_id", "silver_po_number"], ["silver_customer_id"])


@query("gold_rows:l gold_total:d silver_rows:l silver_total:d total_diff:d", """
    SELECT g.n AS gold_rows, g.t AS gold_total, s.n AS silver_rows, s.t AS silver_total, g.t - s.t AS total_diff
    FROM (SELECT count(*) AS n, sum(sales_amount) AS t FROM sales_1) g, (SELECT count(*) AS n, sum(silver_line_total_amount) AS t FROM sv_invoice_line) s
    WHERE g.n <> s.n OR g.t <> s.t""")
def dq_reconcile_sales(spark, sf):
    """The fact before its reload does not tie out with the newer lines."""
    s = star(spark, sf)
    return dq.reconcile(s.sales(1), "sales_amount", s.silver("invoice_line"), "silver_line_total_amount")


@query("gold_rows:l gold_total:d silver_rows:l silver_total:d total_diff:d", """
    SELECT g.n AS gold_rows, g.t AS gold_total, s.n AS silver_rows, s.t AS silver_total, g.t - s.t AS total_diff
    FROM (SELECT count(*) AS n, sum(payment_amount) AS t FROM payments_1) g, (SELECT count(*) AS n, sum(silver_payment_amount) AS t FROM sv_payment) s
    WHERE g.n <> s.n OR g.t <> s.t""")
def dq_reconcile_payments(spark, sf):
    s = star(spark, sf)
    return dq.reconcile(s.payments(1), "payment_amount", s.silver("payment"), "silver_payment_amount")


@query("payment_key:l payment_amount:d", """
    SELECT payment_key, -payment_amount AS payment_amount FROM payments WHERE parent_payment_key IS NOT NULL AND -payment_amount >= 0""")
def dq_refund_sign(spark, sf):
    """Refund amounts with the sign turned, which the check must report."""
    p = star(spark, sf).payments()
    return dq.refunds_not_negative(p.withColumn("payment_amount", -F.col("payment_amount")))


def _broken_versions(s):
    """The customer dimension with damaged windows: every fifth entity keeps its old version open."""
    hit = (F.col("source_record_id").cast("int") % 5 == 0) & (F.col("row_version") == 1)
    d = s.dim("dim_customer")
    return d.withColumns({
        "valid_to": F.when(hit, None).otherwise(F.col("valid_to")),
        "is_current": F.when(hit, True).otherwise(F.col("is_current")),
        "row_version": F.when(F.col("source_record_id").cast("int") % 3 == 0, F.col("row_version") * 2).otherwise(F.col("row_version")),
    })


_BROKEN = """(SELECT source_record_id, valid_from, CASE WHEN CAST(source_record_id AS INT) % 5 = 0 AND row_version = 1 THEN NULL ELSE valid_to END AS valid_to,
    CASE WHEN CAST(source_record_id AS INT) % 5 = 0 AND row_version = 1 THEN true ELSE is_current END AS is_current,
    CASE WHEN CAST(source_record_id AS INT) % 3 = 0 THEN row_version * 2 ELSE row_version END AS row_version
    FROM dim_customer WHERE source_record_id <> '-1')"""


@query("dimension source_record_id valid_from", f"""
    SELECT DISTINCT 'dim_customer' AS dimension, source_record_id, valid_from
    FROM (SELECT source_record_id, valid_from, coalesce(valid_to, DATE '9999-12-31') AS ends,
        list({{'a': valid_from, 'z': coalesce(valid_to, DATE '9999-12-31')}}) OVER (
          PARTITION BY source_record_id ORDER BY row_version RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier
      FROM {_BROKEN} v)
    WHERE len(list_filter(earlier, lambda e: e.a < ends AND e.z > valid_from)) > 0""")
def dq_scd2_overlap(spark, sf):
    return dq.scd2_overlaps(_broken_versions(star(spark, sf)), "dim_customer")


@query("dimension source_record_id current_versions:l", f"""
    SELECT 'dim_customer' AS dimension, source_record_id, current_versions
    FROM (SELECT source_record_id, count(*) FILTER (is_current) AS current_versions FROM {_BROKEN} v GROUP BY ALL)
    WHERE current_versions != 1""")
def dq_scd2_one_current(spark, sf):
    return dq.scd2_one_current(_broken_versions(star(spark, sf)), "dim_customer")


@query("dimension source_record_id version_count:l max_version:l", f"""
    SELECT 'dim_customer' AS dimension, source_record_id, len(versions) AS version_count, list_max(versions) AS max_version
    FROM (SELECT source_record_id, list_sort(list(CAST(row_version AS BIGINT))) AS versions FROM {_BROKEN} v GROUP BY ALL)
    WHERE versions <> range(1, len(versions) + 1)""")
def dq_scd2_contiguous(spark, sf):
    return dq.scd2_contiguous(_broken_versions(star(spark, sf)), "dim_customer")


@query("dimension source_record_id row_version:l valid_to next_from", f"""
    SELECT 'dim_customer' AS dimension, source_record_id, row_version, valid_to, next_from
    FROM (SELECT *, CASE WHEN lead(row_version) OVER w = row_version + 1 THEN lead(valid_from) OVER w END AS next_from
      FROM {_BROKEN} v WINDOW w AS (PARTITION BY source_record_id ORDER BY row_version))
    WHERE valid_to IS DISTINCT FROM next_from""")
def dq_scd2_window_gaps(spark, sf):
    return dq.scd2_window_gaps(_broken_versions(star(spark, sf)), "dim_customer")


@query("silver_series_id latest_observation days_stale:l", """
    SELECT silver_series_id, max(silver_observation_date) AS latest_observation, date_diff('day', max(silver_observation_date), DATE '2002-01-02') AS days_stale
    FROM sv_econ_indicator GROUP BY 1 HAVING date_diff('day', max(silver_observation_date), DATE '2002-01-02') > 95""")
def dq_series_freshness(spark, sf):
    return dq.stale_series(star(spark, sf).silver("econ_indicator"), RUN_2[:10])


@query("silver_series_id month", """
    SELECT silver_series_id, silver_observation_date AS month FROM sv_econ_indicator
    WHERE silver_indicator_value IS NULL AND silver_observation_date > (SELECT min(silver_observation_date) FROM sv_econ_indicator)
      AND silver_observation_date < (SELECT max(silver_observation_date) FROM sv_econ_indicator)""")
def dq_month_gaps(spark, sf):
    """Months whose rows were dropped because they carry no value."""
    return dq.month_gaps(star(spark, sf).silver("econ_indicator").where(
        "silver_indicator_value is not null or silver_observation_date in (date'1995-01-01', date'2001-08-01')"))


@query("silver_series_id silver_observation_date n:l", """
    SELECT silver_series_id, silver_observation_date, 2 AS n FROM sv_econ_indicator""")
def dq_series_unique(spark, sf):
    e = star(spark, sf).silver("econ_indicator")
    return dq.unique(e.unionByName(e), ["silver_series_id", "silver_observation_date"])


@query("silver_series_id silver_observation_date silver_indicator_value:d", """
    SELECT silver_series_id, silver_observation_date, silver_indicator_value - 200 AS silver_indicator_value FROM sv_econ_indicator
    WHERE silver_indicator_value - 200 <= 0""")
def dq_series_positive(spark, sf):
    e = star(spark, sf).silver("econ_indicator")
    return dq.non_positive(e.withColumn("silver_indicator_value", F.col("silver_indicator_value") - 200))


@query("month_key:l", """
    SELECT DISTINCT date_key // 100 AS month_key FROM sales
    WHERE date_key // 100 < (SELECT coalesce(min(year(silver_observation_date) * 100 + month(silver_observation_date)), 999999)
      FROM sv_econ_indicator WHERE silver_series_id = 'CPIAUCSL' AND silver_indicator_value IS NOT NULL
        AND silver_observation_date >= DATE '1997-06-01')""")
def dq_basis_exists(spark, sf):
    """Revenue months before the index starts, with an index that starts in June 1997."""
    s = star(spark, sf)
    late = s.silver("econ_indicator").where("silver_observation_date >= date'1997-06-01'")
    return dq.months_without_basis(s.sales(), late, serving.PRICE_SERIES)


@query("silver_invoice_id:l dq_issue_flag:b dq_issue_description", """
    SELECT silver_invoice_id, d <> '' AS dq_issue_flag, nullif(d, '') AS dq_issue_description FROM (SELECT *, concat_ws('; ',
      CASE WHEN silver_invoice_status IS NULL THEN 'status outside vocabulary' END,
      CASE WHEN silver_invoice_due_date < silver_invoice_date THEN 'due before invoice date' END,
      CASE WHEN silver_total_amount <> silver_subtotal_amount - silver_discount_amount + silver_tax_amount + silver_fee_amount THEN 'total does not foot' END,
      CASE WHEN silver_balance_due_amount <> silver_total_amount - silver_paid_amount THEN 'balance does not foot' END) AS d FROM sv_invoice) x""")
def dq_footing(spark, sf):
    return dq.flag_rows(star(spark, sf).silver("invoice"), dq.invoice_rules())


@query("silver_invoice_line_id:l dq_issue_description", """
    SELECT silver_invoice_line_id, 'line does not foot' AS dq_issue_description FROM sv_invoice_line
    WHERE silver_line_total_amount <> silver_order_qty * silver_unit_price_amount - silver_discount_amount""")
def dq_line_footing(spark, sf):
    return dq.flag_rows(star(spark, sf).silver("invoice_line"), dq.line_rules()).where("dq_issue_flag")


@query("silver_customer_id:l dq_issue_description", """
    SELECT silver_customer_id, concat_ws('; ', CASE WHEN silver_customer_status IS NULL THEN 'status outside vocabulary' END,
      CASE WHEN silver_email NOT LIKE '%@%' THEN 'email without @' END) AS dq_issue_description FROM sv_customer
    WHERE silver_customer_status IS NULL OR silver_email NOT LIKE '%@%'""")
def dq_customer_rules(spark, sf):
    return dq.flag_rows(star(spark, sf).silver("customer"), dq.customer_rules()).where("dq_issue_flag")


@query("silver_payment_id:l dq_issue_description", """
    SELECT silver_payment_id, concat_ws('; ', CASE WHEN silver_payment_status IS NULL THEN 'status outside vocabulary' END,
      CASE WHEN silver_payment_date > DATE '2000-01-01' THEN 'payment in the future' END) AS dq_issue_description FROM sv_payment
    WHERE silver_payment_status IS NULL OR silver_payment_date > DATE '2000-01-01'""")
def dq_payment_rules(spark, sf):
    return dq.flag_rows(star(spark, sf).silver("payment"), dq.payment_rules("2000-01-01")).where("dq_issue_flag")


@query("silver_address_id:l dq_issue_description", """
    SELECT silver_address_id, concat_ws('; ', CASE WHEN silver_address_type IS NULL THEN 'type outside vocabulary' END,
      CASE WHEN silver_state_code = 'ZZ' THEN 'unknown state' END) AS dq_issue_description FROM sv_customer_address
    WHERE silver_address_type IS NULL OR silver_state_code = 'ZZ'""")
def dq_address_rules(spark, sf):
    states = [f"N{chr(65 + i)}" for i in range(25)]
    return dq.flag_rows(star(spark, sf).silver("customer_address"), dq.address_rules(states)).where("dq_issue_flag")


@query("silver_invoice_id:l silver_subtotal_amount:d line_sum:d", """
    SELECT i.silver_invoice_id, i.silver_subtotal_amount, l.line_sum FROM sv_invoice i JOIN (SELECT silver_invoice_id, sum(silver_line_total_amount) AS line_sum
      FROM sv_invoice_line GROUP BY 1) l ON l.silver_invoice_id = i.silver_invoice_id WHERE i.silver_subtotal_amount <> l.line_sum""")
def dq_header_vs_lines(spark, sf):
    s = star(spark, sf)
    return dq.header_vs_lines(s.silver("invoice"), s.silver("invoice_line"))


_RAW_KEY = "CASE WHEN o_orderkey % 10 = 1 THEN NULL WHEN o_orderkey % 10 = 2 THEN 'X' || CAST(o_orderkey AS STRING) ELSE CAST(o_orderkey AS STRING) END"


@query("outcome raw_total:d n:l", f"""
    SELECT outcome, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS raw_total, count(*) AS n FROM (SELECT *, CASE WHEN k IS NULL THEN 'missing key'
      WHEN TRY_CAST(k AS BIGINT) IS NULL THEN 'uncastable key' ELSE 'loaded' END AS outcome FROM (SELECT *, {_RAW_KEY} AS k FROM orders) o) x GROUP BY 1""")
def dq_quarantine_split(spark, sf):
    raw = given.table(spark, sf, "orders").withColumn("k", F.expr(_RAW_KEY))
    good, bad = dq.split_quarantine(raw, "k")
    price = F.get_json_object("raw_row", "$.o_totalprice").cast("decimal(12,2)")
    rows = good.select(F.lit("loaded").alias("outcome"), F.col("o_totalprice").cast("decimal(12,2)").alias("p")).unionByName(
        bad.select(F.col("reason").alias("outcome"), price.alias("p")))
    return rows.groupBy("outcome").agg(F.sum("p").alias("raw_total"), F.count(F.lit(1)).alias("n"))


# -- governance ---------------------------------------------------------------------
@query("source_record_id etl_batch_id silver_batch_id:l bronze_batch_id:l bronze_source_table_name silver_row_hash landed_payment_id:l", f"""
    SELECT CAST(silver_payment_id AS VARCHAR) AS source_record_id, '{BATCH[1]}' AS etl_batch_id, 1 AS silver_batch_id, 1 AS bronze_batch_id,
      'payment' AS bronze_source_table_name, silver_row_hash, silver_payment_id AS landed_payment_id FROM sv_payment_1""")
def aud_trace(spark, sf):
    """Fact rows followed back by the stored ids to the landing row they came from."""
    s = star(spark, sf)
    bronze = s.landing("oltp_payment")
    traced = gov.trace(s.payments(1), s.silver("payment", 1), bronze)
    return traced.join(bronze.select("bronze_record_id", F.col("payment_id").alias("landed_payment_id")), "bronze_record_id")


@query("silver_customer_id:l silver_customer_name", """
    SELECT silver_customer_id, silver_customer_name FROM sv_customer WHERE silver_customer_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def aud_erasure(spark, sf):
    """Customers with a negative balance asked to be forgotten."""
    subjects = given.table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("subject_id"))
    return gov.erase(star(spark, sf).silver("customer"), "silver_customer_id", subjects)


@query("table_name operation_type record_key rows_erased:l change_reason", """
    SELECT 'silver.payment' AS table_name, 'DELETE' AS operation_type, CAST(silver_customer_id AS VARCHAR) AS record_key, count(*) AS rows_erased,
      'verified erasure request' AS change_reason FROM sv_payment WHERE silver_customer_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY 3""")
def aud_erasure_log(spark, sf):
    subjects = given.table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("subject_id"))
    return gov.erasure_log(star(spark, sf).silver("payment"), "silver.payment", "silver_customer_id", subjects, RUN_2, "erasure")


_PERSONAL = {
    "customer": ("silver_email", "silver_phone_number", "silver_first_name", "silver_last_name"),
    "customer_address": ("silver_street_address_line_1", "silver_street_address_line_2"),
    "employee": ("silver_email", "silver_phone_number", "silver_first_name", "silver_last_name", "silver_full_name"),
    "store": ("silver_street_address", "silver_phone_number"),
    "dim_customer": ("customer_street_address",),
    "dim_cashier": ("cashier_first_name", "cashier_last_name", "cashier_full_name"),
}


@query("table_name column_name sensitivity filled:l", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, 'PII' AS sensitivity, count({c}) AS filled FROM {t if t.startswith('dim_') else 'sv_' + t}"
    for t, cs in _PERSONAL.items() for c in cs))
def aud_pii_register(spark, sf):
    """Columns with personal data in every current-state and dimension table, and how many values they hold."""
    s = star(spark, sf)
    tables = {name: s.silver(name) for name in SPECS} | {name: s.dim(name) for name in DIMENSIONS}
    return gov.pii_register(tables).where("sensitivity = 'PII'")


@query("table_name live_rows:l copy_rows:l matches:b", """
    SELECT 'orders' AS table_name, count(*) AS live_rows, count(*) AS copy_rows, true AS matches FROM orders
    UNION ALL SELECT 'damaged', count(*), count(*), false FROM orders""")
def snk_snapshot_verify(spark, sf):
    """A true copy ties out, a copy with one changed amount does not."""
    o = given.table(spark, sf, "orders")
    copy = stage(o, "copy")
    damaged = copy.withColumn("o_totalprice", F.when(F.col("o_orderkey") == 1, 0.0).otherwise(F.col("o_totalprice")))
    same = gov.compare_copies(o, copy).withColumn("table_name", F.lit("orders"))
    return same.unionByName(gov.compare_copies(o, damaged).withColumn("table_name", F.lit("damaged")))


