"""Rows that are few by their compressed files but many by count are not broadcast, and a bitmap travels in wide rows."""

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import sieve
from lakestrata.operators.asof import as_of_lookup
from lakestrata.operators.merge import upsert
from lakestrata.operators.scd import close_superseded
from lakestrata.plans import facts
from lakestrata.plans.dimensions import invoice_parts
from lakestrata.session import stage
from workload import given

MANY = 100_000


@pytest.fixture
def limit(spark):
    """A broadcast threshold that many rows exceed, though their files don't."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def joins(df, kind):
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    return {line.strip(" :+-*").split()[0].split("(")[0] for line in plan if "Join" in line and kind in line}


def ids(spark, n=MANY, name="k"):
    return stage(spark.range(0, n, 1, 2).withColumnRenamed("id", name), "ids", "zstd")


def test_a_bitmap_has_a_row_for_many_words(spark, monkeypatch):
    kept, real = [], sieve.stage
    monkeypatch.setattr(sieve, "stage", lambda df, label: kept.append(real(df, label)) or kept[-1])
    keys = ids(spark)
    rows = spark.range(0, 3 * MANY, 1, 4).withColumnRenamed("id", "k")
    through = sieve.marked(rows, keys, ["k"]).where("_maybe")
    assert MANY <= through.count() < 1.4 * MANY
    assert through.join(keys, "k", "left_semi").count() == MANY
    assert kept[0].count() <= MANY * sieve.BITS_PER_KEY // 64 // 32 + 1  # a row a word before


def test_the_exact_join_goes_by_the_count(spark, limit):
    keys, rows = ids(spark), ids(spark, 3 * MANY)
    assert joins(sieve.semi(rows, keys, ["k"]), "LeftSemi") == {"SortMergeJoin"}
    assert joins(sieve.anti(rows, keys, ["k"]), "LeftAnti") == {"SortMergeJoin"}
    assert joins(sieve.semi(rows, ids(spark, 1000), ["k"]), "LeftSemi") == {"BroadcastHashJoin"}
    assert sieve.semi(rows, keys, ["k"]).count() == MANY and sieve.anti(rows, keys, ["k"]).count() == 2 * MANY


def test_upsert_of_stored_changes_tells_rows_by_a_bitmap(spark, limit):
    target = stage(ids(spark, 3 * MANY).withColumn("v", F.lit(0)), "target", "zstd")
    changes = stage(ids(spark).withColumn("v", F.lit(1)), "changes", "zstd")
    whole = upsert(target, changes, ["k"], stored=True)
    assert "_bits" in whole._jdf.queryExecution().optimizedPlan().toString()
    assert joins(whole, "LeftAnti") == {"SortMergeJoin"}
    assert whole.agg(F.count("k"), F.sum("k"), F.sum("v")).first()[:] == (3 * MANY, sum(range(3 * MANY)), MANY)


def test_customers_of_invoices_go_by_the_count(spark, limit):
    stamp = "timestamp_ntz'2000-01-01 00:00:00'"
    customer = stage(spark.range(0, 2 * MANY, 1, 2).selectExpr(
        "id silver_customer_id", "'A' || id silver_customer_account_no", "'Print Co' silver_customer_name",
        f"{stamp} silver_updated_at_timestamp", "'x' a", "'y' b", "'z' c"), "customer", "zstd")
    invoice = spark.range(0, 500, 1, 2).selectExpr(
        "id silver_invoice_id", "id * 3 silver_customer_id", "1L silver_store_id", "false silver_is_deleted_flag", "'s' silver_source_system",
        f"{stamp} silver_source_updated_at_timestamp", "'I' || id silver_invoice_number", "'P' silver_po_number",
        "date'2000-01-01' silver_invoice_date", "'paid' silver_invoice_status", "cast(1 as decimal(18,2)) silver_total_amount",
        f"{stamp} silver_updated_at_timestamp")
    store = spark.sql(f"select 1L silver_store_id, 'S' silver_store_code, 'N' silver_store_name, {stamp} silver_updated_at_timestamp")
    t = {"invoice": stage(invoice, "invoice"), "customer": customer, "store": store}
    for since in (None, "1999-01-01 00:00:00"):
        parts = invoice_parts(t, since)
        assert "SortMergeJoin" in joins(parts, "LeftOuter")
        assert parts.where("silver_customer_account_no = 'A' || cast(source_record_id as bigint) * 3").count() == 500


def test_ended_versions_and_wanted_ids_go_by_the_count(spark, limit):
    day = F.lit("2000-01-01").cast("date")
    target = ids(spark, 2 * MANY).selectExpr(
        "k", "cast(k as string) source_record_id", "1 row_version", "true is_current", "date'1900-01-01' valid_from",
        "cast(null as date) valid_to", "timestamp_ntz'2000-01-01 00:00:00' etl_updated_timestamp")
    added = ids(spark).selectExpr("cast(k as string) source_record_id", "2 row_version", "date'2001-01-01' valid_from")
    closed = close_superseded(target, added, "k", "2001-01-01 08:00:00", MANY)
    assert joins(closed, "LeftOuter") == {"SortMergeJoin"} and closed.where("not is_current").count() == MANY
    looked = as_of_lookup(ids(spark, 10), target, "k", day, "k", "key", wanted=ids(spark, 5 * MANY))
    assert "SortMergeJoin" in joins(looked, "LeftSemi") and looked.where("key = k").count() == 10


def test_reloaded_payments_are_found_by_a_bitmap(spark, limit, monkeypatch):
    asked = []

    def found(rows, keys, on):
        asked.append((keys.count(), on))
        raise KeyError("the rest needs more tables")

    monkeypatch.setattr(facts, "semi", found, raising=False)
    changed = stage(ids(spark).selectExpr("cast(k as string) source_record_id"), "changed", "zstd")
    with pytest.raises(KeyError):
        facts.payment_rows({"payment": ids(spark, name="silver_payment_id")}, changed)
    assert asked == [(MANY, ["silver_payment_id"])]


def test_joined_source_tables_go_by_the_count(spark, limit, tmp_path):
    spark.range(0, 3 * MANY, 1, 1).selectExpr("id p_partkey", "'n' p_name", "'b' p_brand", "'t' p_type", "1 p_size", "2.5D p_retailprice").write.parquet(
        f"{tmp_path}/part.parquet")
    spark.range(0, 50, 1, 1).selectExpr(
        "id l_orderkey", "id * 7 l_partkey", "id l_suppkey", "1 l_linenumber", "1D l_quantity", "9D l_extendedprice", "0.1D l_discount",
        "0D l_tax", "'N' l_returnflag", "'O' l_linestatus", "timestamp_ntz'2000-01-01 00:00:00' l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    lines = given.source(spark, str(tmp_path), "invoice_line")
    assert joins(lines, "Inner") == {"SortMergeJoin"} and lines.count() == 50
