"""Sinks of the table store (SNK*, BRZ11) exercised on whole tables in the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lakestrata.operators.contract import ContractError
from lakestrata.operators.incremental import reconcile_delta, relationships_delta, unique_delta
from lakestrata.operators.merge import without
from lakestrata.operators.scd import close_superseded
from lakestrata.plans.dimensions import SCD2_DIMENSIONS
from lakestrata.plans.gate import Gate
from lakestrata.plans.run import DAILY, MONTHLY
from lakestrata.plans.silver import SPECS, merge_silver
from lakestrata.session import scratch_root, stage
from lakestrata.sources.landing import ingest_table, landing_schema
from lakestrata.sources.ledger import Ledger
from lakestrata.sources.store import TableStore

from . import given
from .registry import query
from .silver_queries import _spec_of
from .source_sql import RUN_1, RUN_2
from .star import CONFIGS, landed, star

BUCKETS = {"silver.invoice": 16, "silver.invoice_line": 16, "silver.customer": 16, "gold.dim_invoice": 16,
           "gold.fact_retail_sales": 16}


def _store(spark) -> TableStore:
    return TableStore(spark, f"{scratch_root(spark)}/store-{uuid.uuid4().hex}", BUCKETS)


@query("invoice_id:l bronze_batch_id:l invoice_status", """
    SELECT invoice_id, 2 AS bronze_batch_id, status_code AS invoice_status FROM src_invoice_2""")
def snk_append_batches(spark, sf):
    """Two landed batches; reading from the second on opens only its folder."""
    store = _store(spark)
    for wave in (1, 2):
        store.append("bronze", "oltp_invoice", landed(spark, sf, "oltp_invoice", wave), wave)
    return store.read_since("bronze", "oltp_invoice", 1)


def _merged(spark, sf) -> TableStore:
    store, s = _store(spark), star(spark, sf)
    changes, keys = s.changes("invoice"), ["silver_invoice_id"]
    store.overwrite("silver", "invoice", s.silver("invoice", 1), keys)
    store.rewrite("silver", "invoice", changes, lambda old: without(old, changes, keys, stored=True), changes)
    return store


@query(_spec_of("invoice"), "SELECT * FROM sv_invoice")
def snk_merge_buckets(spark, sf):
    """Copy-on-write merge into hash buckets."""
    return _merged(spark, sf).read("silver", "invoice")


@query(_spec_of("invoice"), "SELECT * FROM sv_invoice_1")
def snk_previous_version(spark, sf):
    """The version before the merge stays readable."""
    return _merged(spark, sf).read("silver", "invoice", 1)


@query("sales_line_key:l invoice_number sales_amount:d source_record_id", "SELECT * FROM sales")
def snk_replace_buckets(spark, sf):
    """Delete by the changed invoices and insert, bucket by bucket."""
    store, s = _store(spark), star(spark, sf)
    changed, new, keys = s.changed_invoices(), s.new_sales(), ["invoice_number"]
    store.overwrite("gold", "fact_retail_sales", s.sales(1), keys)
    store.rewrite("gold", "fact_retail_sales", changed, lambda old: without(old, changed, keys, stored=True), new)
    return store.read("gold", "fact_retail_sales")


@query("sales_line_key:l invoice_number sales_amount:d source_record_id", "SELECT * FROM sales")
def snk_replace_months(spark, sf):
    """Delete by the changed invoices and insert, in the month folders that hold them."""
    store, s = _store(spark), star(spark, sf)
    store.period_plan, store.bucket_plan = MONTHLY, {}
    changed, new, keys = s.changed_invoices(), s.new_sales(), ["invoice_number"]
    store.overwrite("gold", "fact_retail_sales", s.sales(1), keys)
    store.rewrite("gold", "fact_retail_sales", changed, lambda old: without(old, changed, keys, stored=True), new)
    return store.read("gold", "fact_retail_sales")


@query("snapshot_date_key:l customer_key:l lifetime_order_count:l open_invoice_total:d", """
    SELECT snapshot_date_key, customer_key, lifetime_order_count, open_invoice_total FROM bi_snapshot""")
def snk_newest_snapshot(spark, sf):
    """Two appended snapshot days; the newest is found from the folders and opened alone."""
    store, rows = _store(spark), star(spark, sf).snapshot()
    store.period_plan = DAILY
    for day in (rows.withColumn("snapshot_date_key", F.col("snapshot_date_key") - 1), rows):
        store.append("gold", "fact_customer_behavior_snapshot", day)
    return store.read_newest("gold", "fact_customer_behavior_snapshot")


@query("invoice_key:l source_record_id row_version:l valid_from valid_to is_current:b", "SELECT * FROM dim_invoice")
def snk_append_versions(spark, sf):
    """New dimension versions are added and the superseded ones closed, bucket by bucket."""
    store, s = _store(spark), star(spark, sf)
    spec = next(d for d in SCD2_DIMENSIONS if d.name == "dim_invoice")
    added = s.dim("dim_invoice").where("row_version = 2")
    store.overwrite("gold", "dim_invoice", s.dim("dim_invoice", 1), ["source_record_id"])
    store.rewrite("gold", "dim_invoice", added, lambda old: close_superseded(old, added, spec.key, RUN_2), added)
    return store.read("gold", "dim_invoice")


@query("batch_key:l target_table batch_status load_type rows_extracted:l rows_inserted:l watermark_value_end", """
    SELECT 1 AS batch_key, 'oltp_payment' AS target_table, 'succeeded' AS batch_status, 'incremental_append' AS load_type,
      count(*) AS rows_extracted, count(*) AS rows_inserted, CAST(max(updated_at) AS VARCHAR) AS watermark_value_end FROM src_payment_1
    UNION ALL SELECT 2, 'oltp_payment', 'succeeded', 'incremental_append', count(*), count(*), CAST(max(updated_at) AS VARCHAR)
    FROM src_payment_2 WHERE updated_at > (SELECT max(updated_at) FROM src_payment_1) - INTERVAL 1 HOUR""")
def brz_ingest_table(spark, sf):
    """Two incremental loads of the payments; the ledger tells what they did."""
    store, cfg = _store(spark), CONFIGS["oltp_payment"]
    for wave, run_ts in ((1, RUN_1), (2, RUN_2)):
        ledger = Ledger(spark, store.root, clock=lambda at=run_ts: at)
        ingest_table(given.source(spark, sf, "payment", wave), cfg, store, ledger, run_ts)
    return ledger.frame()


@query("batch:l rows_landed:l", """
    SELECT 1 AS batch, count(*) AS rows_landed FROM src_product_1
    UNION ALL SELECT 2, count(*) FROM src_product_2 n JOIN src_product_1 o USING (product_id)
      WHERE n.brand IS DISTINCT FROM o.brand OR n.updated_at <> o.updated_at""")
def brz_ingest_full_load(spark, sf):
    """Two full loads of the products; the second lands only what changed."""
    store, cfg = _store(spark), CONFIGS["oltp_product"]
    for wave, run_ts in ((1, RUN_1), (2, RUN_2)):
        ledger = Ledger(spark, store.root, clock=lambda at=run_ts: at)
        ingest_table(given.source(spark, sf, "product", wave), cfg, store, ledger, run_ts)
    rows = store.read("bronze", cfg.target)
    return rows.groupBy(F.col("bronze_batch_id").alias("batch")).agg(F.count(F.lit(1)).alias("rows_landed"))


@query("silver_customer_id:l silver_customer_name", """
    SELECT silver_customer_id, silver_customer_name FROM sv_customer WHERE silver_customer_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def aud_erasure_store(spark, sf):
    """Erasure from a stored table: affected folders are rewritten, old versions expired."""
    from lakestrata.plans.governance import erase_subjects

    store = _store(spark)
    store.overwrite("silver", "customer", star(spark, sf).silver("customer"), ["silver_customer_id"])
    who = given.table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("subject_id"))
    erase_subjects(store, [("silver", "customer", "silver_customer_id")], who, RUN_2)
    return store.read("silver", "customer")


@query("sales_line_key:l n:l", """
    WITH f AS (SELECT CASE WHEN sales_line_key > m THEN sales_line_key - 10 ELSE sales_line_key END AS k
      FROM sales, (SELECT max(sales_line_key) AS m FROM sales_1))
    SELECT k AS sales_line_key, count(*) AS n FROM f GROUP BY k HAVING count(*) > 1""")
def dq_incremental_unique(spark, sf):
    """A reload whose keys begin ten too low: found from the rewritten buckets and the key ranges of the others."""
    store, s, name = _store(spark), star(spark, sf), "fact_retail_sales"
    store.overwrite("gold", name, s.sales(1), ["invoice_number"])
    changed = s.changed_invoices()
    low = s.new_sales().withColumn("sales_line_key", F.col("sales_line_key") - 10)
    store.rewrite("gold", name, changed, lambda old: without(old, changed, ["invoice_number"], stored=True), low)
    return unique_delta(Gate(store, {}, {name: "gold"}).change(name, 1), ["sales_line_key"])


@query("silver_customer_id:l n:l", """
    SELECT silver_customer_id, count(*) AS n FROM sv_invoice
    WHERE silver_customer_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY 1""")
def dq_incremental_relationships(spark, sf):
    """Invoices change and customers go: their references are found from the parts that came and went."""
    store = _merged(spark, sf)
    store.overwrite("silver", "customer", star(spark, sf).silver("customer"), ["silver_customer_id"])
    gone = given.table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("silver_customer_id"))
    none = store.read("silver", "customer").limit(0)
    store.rewrite("silver", "customer", gone, lambda old: without(old, gone, ["silver_customer_id"]), none)
    gate = Gate(store, {}, {"invoice": "silver", "customer": "silver"})
    return relationships_delta(gate.change("invoice", 1), "silver_customer_id", gate.change("customer", 1), "silver_customer_id")


@query("gold_rows:l gold_total:d silver_rows:l silver_total:d total_diff:d", """
    SELECT g.n AS gold_rows, g.t AS gold_total, s.n AS silver_rows, s.t AS silver_total, g.t - s.t AS total_diff
    FROM (SELECT count(*) AS n, sum(sales_amount) AS t FROM sales_1) g, (SELECT count(*) AS n, sum(silver_line_total_amount) AS t FROM sv_invoice_line) s
    WHERE g.n <> s.n OR g.t <> s.t""")
def dq_incremental_reconcile(spark, sf):
    """Lines were merged since the fact was loaded; both totals come from summaries of parts."""
    store, s, keys = _store(spark), star(spark, sf), ["silver_invoice_line_id"]
    store.overwrite("gold", "fact_retail_sales", s.sales(1), ["invoice_number"])
    store.overwrite("silver", "invoice_line", s.silver("invoice_line", 1), keys)
    changes = s.changes("invoice_line")
    store.rewrite("silver", "invoice_line", changes, lambda old: without(old, changes, keys, stored=True), changes)
    gate = Gate(store, {}, {"fact_retail_sales": "gold", "invoice_line": "silver"})
    row = reconcile_delta(list(gate.summaries("fact_retail_sales").values()), list(gate.summaries("invoice_line").values()))
    schema = "gold_rows long, gold_total decimal(38,2), silver_rows long, silver_total decimal(38,2), total_diff decimal(38,2)"
    return spark.createDataFrame([row] if row else [], schema)


@query("silver_customer_id:l silver_phone_number silver_bronze_batch_id:l", """
    SELECT silver_customer_id, CASE WHEN silver_customer_id % 7 <> 0 AND c_acctbal < 0 THEN '4805550100' ELSE silver_phone_number END
      AS silver_phone_number, CASE WHEN silver_customer_id % 7 = 0 THEN 3 WHEN c_acctbal < 0 THEN 2 ELSE 1 END AS silver_bronze_batch_id
    FROM sv_customer JOIN customer ON c_custkey = silver_customer_id""")
def src_unprocessed_late_batch(spark, sf):
    """Batch 2 lands after batch 3 was merged: its rows come in, but for those that batch 3 holds too."""
    store, spec = _store(spark), SPECS["customer"]
    poor = given.table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("customer_id"))
    whole = {wave: stage(landed(spark, sf, spec.source, wave), "landed") for wave in (1, 2)}
    late = whole[1].join(poor, "customer_id", "left_semi").withColumn("phone", F.lit("(480) 555-0100"))
    batches = {1: whole[1], 3: whole[2], 2: late}
    for number, rows in batches.items():
        rows = rows.withColumn("bronze_batch_id", F.lit(number).cast("bigint"))
        store.append("bronze", spec.source, rows.select(landing_schema(spec.source).fieldNames()), number)
        merge_silver(store, spec, batch_id=10 + number, run_ts=RUN_2)
    return store.read("silver", "customer")


@query("invoice_number reason rows_rejected:l", """
    SELECT invoice_number, CASE WHEN status_code = 'lost' THEN 'missing invoice_id' ELSE 'uncastable invoice_id' END AS reason,
      count(*) OVER () AS rows_rejected FROM src_invoice_1 WHERE status_code IN (' Void', 'lost')""")
def dq_run_quarantine(spark, sf):
    """A load whose void invoices have an id that is no number and whose lost ones have none: set aside with the reason."""
    store, cfg = _store(spark), CONFIGS["oltp_invoice"]
    ident = F.when(F.col("status_code") == " Void", F.concat(F.lit("no "), F.col("invoice_id").cast("string"))).when(
        F.col("status_code") != "lost", F.col("invoice_id").cast("string"))
    rows = given.source(spark, sf, "invoice", 1).withColumn("invoice_id", ident)
    ledger = Ledger(spark, store.root, clock=lambda: RUN_1)
    ingest_table(rows, cfg, store, ledger, RUN_1)
    aside = store.read("quarantine", cfg.target).select(
        F.get_json_object("raw_row", "$.invoice_number").alias("invoice_number"), F.explode("reasons").alias("reason"),
        F.col("batch_key"))
    return aside.join(ledger.frame().select("batch_key", "rows_rejected"), "batch_key")


@query("o_orderkey:l o_custkey:l price:d day refused:l", """
    SELECT o_orderkey, o_custkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS price, CAST(o_orderdate AS TIMESTAMP) AS day,
      3 AS refused FROM orders""")
def snk_contract_drift(spark, sf):
    """Orders by status: finished ones with small types, open ones with wider types, the rest refused until it fits.

    Refused are narrower types, another column's type and missing keys; whichever status is the rest comes in at last.
    """
    store = _store(spark)
    store.required = {"bronze.orders": ["o_orderkey"]}
    rows = given.table(spark, sf, "orders").selectExpr(
        "cast(o_orderkey as bigint) o_orderkey", "cast(o_custkey as bigint) o_custkey",
        "cast(round(o_totalprice, 2) as decimal(18,2)) price", "cast(o_orderdate as timestamp_ntz) day", "o_orderstatus")
    small = rows.selectExpr("cast(o_orderkey as int) o_orderkey", "cast(o_custkey as int) o_custkey",
                            "cast(price as decimal(12,2)) price", "cast(day as date) day", "o_orderstatus")
    finished, is_open = F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "O"
    store.append("bronze", "orders", small.where(finished))
    store.append("bronze", "orders", rows.where(is_open))
    rest = rows.where(~F.coalesce(finished | is_open, F.lit(False)))
    unfit = (small.where(is_open), rows.withColumn("price", F.col("price").cast("string")),
             rows.withColumn("o_orderkey", F.lit(None).cast("bigint")))
    refused = 0
    for batch in unfit:
        try:
            store.append("bronze", "orders", batch)
        except ContractError:
            refused += 1
    store.append("bronze", "orders", rest)
    return store.read("bronze", "orders").withColumn("refused", F.lit(refused))
