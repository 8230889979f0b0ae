"""Sources, landing and ledger operators (SRC*, BRZ*, AUD*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakestrata.functions.dates import ts
from lakestrata.functions.intervals import Intervals
from lakestrata.operators import quality as dq
from lakestrata.plans import governance as gov
from lakestrata.sources import landing, ledger as led, series
from lakestrata.sources.config import freshness_limits

from . import given
from .registry import query
from .source_sql import RUN_1, RUN_2
from .star import CONFIGS, landed

MARK = "2001-12-20 00:30:00"


@query("o_orderkey:l o_custkey:l o_orderdate:s", "SELECT * FROM orders")
def src_full_scan(spark, sf):
    return landing.extract(given.table(spark, sf, "orders"), CONFIGS["oltp_product"], None, "full_load")


@query("event_id:l ts:s event_type:s", "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00'")
def src_incremental_scan(spark, sf):
    return landing.incremental_scan(given.table(spark, sf, "events"), "ts", "2024-01-15 12:00:00")


@query("event_id:l ts:s event_type:s", "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 1 HOUR")
def src_lookback_scan(spark, sf):
    return landing.incremental_scan(given.table(spark, sf, "events"), "ts",
                                    landing.apply_lookback("2024-01-15 12:00:00"))


@query("payment_id:l gross_amount:d updated_at:s",
       f"SELECT * FROM src_payment_2 WHERE updated_at > TIMESTAMP '{MARK}' - INTERVAL 1 HOUR")
def src_extract_dispatch(spark, sf):
    return landing.extract(given.source(spark, sf, "payment", 2), CONFIGS["oltp_payment"], MARK)


@query("target_table watermark_value_end", """
    SELECT target_table, arg_max(watermark_value_end, batch_end_timestamp) AS watermark_value_end FROM ledger
    WHERE batch_status = 'succeeded' AND watermark_value_end IS NOT NULL GROUP BY 1""")
def src_latest_watermark(spark, sf):
    return led.latest_watermarks(given.ledger(spark, sf))


@query("target_table observation_start", """
    SELECT target_table, substr(max(watermark_value_end), 1, 10) AS observation_start FROM ledger
    WHERE batch_status = 'succeeded' GROUP BY 1""")
def src_series_watermark(spark, sf):
    done = led.succeeded(given.ledger(spark, sf))
    return done.groupBy("target_table").agg(F.substring(F.max("watermark_value_end"), 1, 10).alias("observation_start"))


@query("series_id observation_date indicator_value:d units created_at", """
    SELECT event_type AS series_id, CAST(ts AS DATE) AS observation_date, CASE WHEN k % 10 <> 0 THEN k + 0.5 END AS indicator_value,
      'unit ' || event_type AS units, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS created_at
    FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) e WHERE CAST(ts AS DATE) >= DATE '2024-01-10'""")
def src_json_observations(spark, sf):
    """Every event as a one-observation JSON document."""
    events = given.table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    value = F.when(k % 10 != 0, F.concat(k.cast("string"), F.lit(".5"))).otherwise(".")
    text = F.concat(F.lit('{"observations":[{"date":"'), F.to_date("ts").cast("string"),
                    F.lit('","value":"'), value, F.lit('"}]}'))
    documents = series.parse_documents(events.select(F.col("event_type").alias("series_id"), text.alias("doc")), "doc")
    kinds = events.select(F.col("event_type").alias("series_id")).distinct().withColumn(
        "units", F.concat(F.lit("unit "), "series_id"))
    return series.observations(documents, kinds, "2024-01-10")


@query("customer_id:l k:l", """
    SELECT c_custkey AS customer_id, 2 AS k FROM customer WHERE c_custkey % 7 = 0""")
def src_unprocessed_batches(spark, sf):
    """Landing rows of batches the current-state table has not seen."""
    from lakestrata.plans.silver import unprocessed

    both = landed(spark, sf, "oltp_customer", 1).unionByName(landed(spark, sf, "oltp_customer", 2))
    return unprocessed(both, Intervals.of([1])).select("customer_id", F.col("bronze_batch_id").alias("k"))


@query("month orders:l", """
    SELECT m AS month, count(o_orderkey) AS orders FROM (SELECT CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)),
      date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS DATE) AS m FROM orders) s
    LEFT JOIN orders ON date_trunc('month', o_orderdate) = m GROUP BY 1""")
def src_month_spine(spark, sf):
    """Month spine over the order dates with the orders per month."""
    from lakestrata.functions.dates import spine

    o = given.table(spark, sf, "orders")
    lo, hi = o.agg(F.trunc(F.min("o_orderdate"), "MM").cast("string"), F.trunc(F.max("o_orderdate"), "MM").cast("string")).first()
    counts = o.groupBy(F.trunc("o_orderdate", "MM").alias("_m")).agg(F.count(F.lit(1)).alias("orders"))
    months = spine(spark, lo, hi, "1 month").withColumnRenamed("date", "month")
    return months.join(counts, F.col("month") == F.col("_m"), "left").select(
        "month", F.coalesce("orders", F.lit(0)).alias("orders"))


@query("o_orderkey:l file_name modified:b", """
    SELECT o_orderkey, 'orders.parquet' AS file_name, true AS modified FROM orders""")
def src_file_lineage(spark, sf):
    rows = landing.with_file_lineage(given.table(spark, sf, "orders"))
    return rows.select("o_orderkey", F.substring_index("bronze_source_file_name", "/", -1).alias("file_name"),
                       F.col("source_file_modified_at").isNotNull().alias("modified"))


@query("o_orderstatus rows:l numbered:l different:l lowest:l highest:l", """
    SELECT o_orderstatus, count(*) AS rows, count(*) AS numbered, count(*) AS different, min(n) AS lowest, max(n) AS highest
    FROM (SELECT o_orderstatus, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders) o GROUP BY 1""")
def src_file_rows(spark, sf):
    """Row numbers of the orders' file, which is written in the order of its keys, by status."""
    rows, number = landing.with_file_lineage(given.table(spark, sf, "orders")), F.col("bronze_source_row_number")
    return rows.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("rows"), F.count(number).alias("numbered"), F.countDistinct(number).alias("different"),
        F.min(number).alias("lowest"), F.max(number).alias("highest"))


@query("bronze_batch_id:l bronze_source_system bronze_source_table_name bronze_is_deleted_flag:b bronze_extracted_at_timestamp "
       "product_id:l sku unit_cost_amount:d is_local_made_flag:b updated_at_source_timestamp source_row_version:l payload_sku", f"""
    SELECT 2 AS bronze_batch_id, 'oltp' AS bronze_source_system, 'product' AS bronze_source_table_name, false AS bronze_is_deleted_flag,
      TIMESTAMP '{RUN_2}' AS bronze_extracted_at_timestamp, product_id, sku, unit_cost AS unit_cost_amount, is_local_made AS is_local_made_flag,
      updated_at AS updated_at_source_timestamp, row_version AS source_row_version, sku AS payload_sku FROM src_product_2""")
def brz_standardize(spark, sf):
    rows = landed(spark, sf, "oltp_product", 2)
    return rows.withColumn("payload_sku", F.get_json_object("bronze_raw_payload_jsonb", "$.sku"))


# the hash runs over the landing names in alphabetical order
_ORDER = ("category_code", "category_id", "category_name", "created_at", "deleted_at", "department_id", "description",
          "is_active", "is_deleted", "updated_at")


def _hash_sql(columns) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'None')" for c in columns) + "))"


@query("category_id:l bronze_row_hash parts:l", f"""
    SELECT category_id, {_hash_sql(_ORDER)} AS bronze_row_hash, (SELECT count(*) FROM part WHERE p_size = category_id) AS parts
    FROM src_product_category_1""")
def brz_row_hash(spark, sf):
    parts = given.table(spark, sf, "part").groupBy(F.col("p_size").cast("bigint").alias("category_id")).agg(
        F.count(F.lit(1)).alias("parts"))
    return landed(spark, sf, "oltp_product_category").select("category_id", "bronze_row_hash").join(parts, "category_id")


_STATUS_HASH = _hash_sql(("changed_at", "changed_by", "customer_id", "new_status", "old_status", "reason", "status_history_id"))


@query("customer_id:l bronze_row_hash", f"SELECT customer_id, {_STATUS_HASH} AS bronze_row_hash FROM src_customer_status_history_1")
def brz_row_hash_history(spark, sf):
    return landed(spark, sf, "oltp_customer_status_history")



@query("product_id:l batch:l", """
    SELECT product_id, 2 AS batch FROM src_product_2""")
def brz_latest_hash_per_key(spark, sf):
    """The newest landed row per product belongs to the second batch, with its hash."""
    both = landed(spark, sf, "oltp_product", 1).unionByName(landed(spark, sf, "oltp_product", 2))
    hashes = landing.current_hashes(both, ("product_id",))
    second = landed(spark, sf, "oltp_product", 2).select("product_id", "bronze_row_hash")
    return hashes.join(second, "bronze_row_hash").select("product_id", F.lit(2).alias("batch"))


@query("product_id:l brand", """
    SELECT n.product_id, n.brand FROM src_product_2 n JOIN src_product_1 o USING (product_id)
    WHERE n.brand IS DISTINCT FROM o.brand OR n.updated_at <> o.updated_at""")
def brz_hash_skip(spark, sf):
    """A repeated full load keeps only the rows that changed since they last landed."""
    hashes = landing.current_hashes(landed(spark, sf, "oltp_product", 1), ("product_id",))
    return landing.skip_unchanged(landed(spark, sf, "oltp_product", 2), hashes)


@query("watermark_value_end n:l", "SELECT CAST(max(updated_at) AS VARCHAR) AS watermark_value_end, count(*) AS n FROM src_invoice_line_1")
def brz_high_water_mark(spark, sf):
    rows = given.source(spark, sf, "invoice_line")
    return landing.high_water_mark(rows, "updated_at").crossJoin(F.broadcast(rows.agg(F.count(F.lit(1)).alias("n"))))


@query("target_table runs:l succeeded:l failed:l rows_inserted:l watermark", """
    SELECT target_table, count(*) AS runs, count(*) FILTER (WHERE batch_status = 'succeeded') AS succeeded,
      count(*) FILTER (WHERE batch_status = 'failed') AS failed,
      CAST(sum(rows_inserted) FILTER (WHERE batch_status = 'succeeded') AS BIGINT) AS rows_inserted,
      max(watermark_value_end) FILTER (WHERE batch_status = 'succeeded') AS watermark FROM ledger GROUP BY 1""")
def aud_batch_stats(spark, sf):
    return gov.batch_stats(given.ledger(spark, sf))


@query("batch_key:l batch_status error_message batch_end_timestamp", f"""
    SELECT batch_key, CASE WHEN hit THEN 'failed' ELSE batch_status END AS batch_status,
      CASE WHEN hit THEN 'closed after an upstream step failed' ELSE error_message END AS error_message,
      CASE WHEN hit THEN TIMESTAMP '{RUN_1}' ELSE batch_end_timestamp END AS batch_end_timestamp
    FROM (SELECT *, batch_status = 'running' AND initiated_by = 'warehouse_run' AS hit FROM ledger) l""")
def aud_fail_open(spark, sf):
    return led.fail_open_rows(given.ledger(spark, sf), "warehouse_run", ts(RUN_1))


@query("batch_key:l batch_status rows_inserted:l", """
    SELECT batch_key, batch_status, rows_inserted FROM ledger""")
def aud_current_state(spark, sf):
    """Running entry first, outcome entry second: the newest entry is the batch's state."""
    final = given.ledger(spark, sf)
    opened = final.withColumns({"batch_status": F.lit("running"), "rows_inserted": F.lit(None).cast("bigint"),
                                "entry_seq": F.lit(1)})
    return led.current_state(opened.unionByName(final.withColumn("entry_seq", F.lit(2))))


@query("target_table watermark", """
    SELECT target_table, max(batch_end_timestamp) AS watermark FROM ledger WHERE batch_status = 'succeeded' GROUP BY 1""")
def fct_gold_watermark(spark, sf):
    return led.gold_watermarks(given.ledger(spark, sf))


@query("batch_key:l target_table batch_status batch_start_timestamp error_message", """
    SELECT * FROM ledger ORDER BY batch_start_timestamp DESC, batch_key DESC LIMIT 20""")
def qry_recent_batches(spark, sf):
    return gov.recent_batches(given.ledger(spark, sf))


@query("batch_key:l target_table issue", """
    WITH done AS (SELECT * FROM ledger WHERE batch_status = 'succeeded'),
    full_loads AS (SELECT *, lag(rows_extracted) OVER (PARTITION BY target_table ORDER BY batch_end_timestamp, batch_key) AS prev
                   FROM done WHERE load_type = 'full_load')
    SELECT batch_key, target_table, 'empty full load' AS issue FROM full_loads WHERE rows_extracted = 0
    UNION ALL SELECT batch_key, target_table, 'extracted differs from inserted plus rejected' FROM done
      WHERE rows_extracted <> rows_inserted + coalesce(rows_rejected, 0)
    UNION ALL SELECT batch_key, target_table, 'row count dropped by more than half' FROM full_loads WHERE rows_extracted < prev * 0.5""")
def dq_batch_rules(spark, sf):
    return dq.batch_issues(given.ledger(spark, sf))


@query("event_type newest age_hours:l status", """
    SELECT event_type, max(ts) AS newest, date_sub('hour', max(ts), TIMESTAMP '2024-02-01 00:05:00') AS age_hours,
      CASE WHEN date_sub('hour', max(ts), TIMESTAMP '2024-02-01 00:05:00') > 48 THEN 'error'
           WHEN date_sub('hour', max(ts), TIMESTAMP '2024-02-01 00:05:00') > 24 THEN 'warn' ELSE 'pass' END AS status
    FROM events GROUP BY 1""")
def dq_freshness(spark, sf):
    return dq.freshness(given.table(spark, sf, "events"), ["event_type"], "ts", "2024-02-01 00:05:00")


@query("source newest age_hours:l status", """
    WITH newest AS (SELECT CASE event_type WHEN 'view' THEN 'ref_view' WHEN 'click' THEN 'econ_indicator' ELSE 'oltp_' || event_type END AS source,
        max(ts) AS newest FROM events GROUP BY 1),
      aged AS (SELECT *, date_sub('hour', newest, TIMESTAMP '2024-03-07 12:00:00') AS h FROM newest)
    SELECT source, newest, h AS age_hours, CASE WHEN source = 'ref_view' THEN 'exempt'
      WHEN source = 'econ_indicator' THEN CASE WHEN h > 45 * 24 THEN 'error' WHEN h > 35 * 24 THEN 'warn' ELSE 'pass' END
      WHEN h > 48 THEN 'error' WHEN h > 24 THEN 'warn' ELSE 'pass' END AS status FROM aged""")
def dq_freshness_sla(spark, sf):
    """Event types as sources: views as an exempt reference table, clicks as the monthly series, the others daily."""
    kind = F.col("event_type")
    source = F.when(kind == "view", "ref_view").when(kind == "click", "econ_indicator").otherwise(F.concat(F.lit("oltp_"), kind))
    newest = given.table(spark, sf, "events").groupBy(source.alias("source")).agg(F.max("ts").alias("newest"))
    limits = {n: freshness_limits(n) for n in ("ref_view", "econ_indicator")}
    other = [r[0] for r in newest.select("source").collect() if r[0] not in limits]  # a row for each source
    return dq.source_freshness(newest, limits | {n: freshness_limits(n) for n in other}, "2024-03-07 12:00:00")
