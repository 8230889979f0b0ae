"""Loads are judged as a whole before they are committed; sources by the age of their newest rows."""

import pytest
from pyspark.sql import functions as F

from lakestrata.operators.quality import load_issues, source_freshness
from lakestrata.plans.run import Run
from lakestrata.sources.config import LandingConfig, TableConfig, freshness_limits
from lakestrata.sources.landing import BatchRejected, ingest_table
from lakestrata.sources.ledger import Ledger

RUN = "2026-01-10 08:00:00"
CFG = TableConfig("product", "oltp_product", "full_load", None, ("product_id",))


def products(spark, n):
    return spark.range(n).select(F.col("id").alias("product_id"), F.concat(F.lit("s"), "id").alias("sku"))


def test_rules_by_counts():
    assert load_issues(True, 0, 0, 0, None) == ["empty full load"]
    assert load_issues(False, 0, 0, 0, 10) == []
    assert load_issues(True, 5, 4, 1, 10) == []
    assert load_issues(True, 4, 4, 0, 10) == ["row count dropped by more than half"]
    assert load_issues(True, 4, 4, 0, 10, least_share=0.0) == []
    assert load_issues(False, 4, 2, 1, None) == ["extracted differs from inserted plus rejected"]


def test_an_empty_full_load_fails_its_batch(spark, store):
    ledger = Ledger(spark, store.root, clock=lambda: RUN)
    with pytest.raises(BatchRejected, match="empty full load"):
        ingest_table(products(spark, 0), CFG, store, ledger, RUN, judge=True)
    assert not store.exists("bronze", "oltp_product")
    ingest_table(products(spark, 10), CFG, store, ledger, RUN, judge=True)
    with pytest.raises(BatchRejected, match="empty full load"):
        ingest_table(products(spark, 0), CFG, store, ledger, RUN, judge=True)
    states = [r["batch_status"] for r in ledger.frame().orderBy("batch_key").collect()]
    assert states == ["failed", "succeeded", "failed"] and store.versions("bronze", "oltp_product") == [1]


def test_a_load_of_far_fewer_rows_fails_and_leaves_nothing(spark, store):
    ledger = Ledger(spark, store.root, clock=lambda: RUN)
    ingest_table(products(spark, 10), CFG, store, ledger, RUN, judge=True)
    changed = products(spark, 4).withColumn("sku", F.lit("new"))
    with pytest.raises(BatchRejected, match="dropped by more than half"):
        ingest_table(changed, CFG, store, ledger, RUN, judge=True)
    assert store.read("bronze", "oltp_product").count() == 10
    assert len(store.files.names(f"{store.root}/bronze/oltp_product/data")) == 1
    smaller = TableConfig("product", "oltp_product", "full_load", None, ("product_id",), least_share=0.1)
    assert ingest_table(changed, smaller, store, ledger, RUN, judge=True).appended == 4
    # the last full load that succeeded counts, not the largest
    assert ingest_table(products(spark, 3), CFG, store, ledger, RUN, judge=True).extracted == 3


def test_without_judging_the_size_is_the_callers_matter(spark, store):
    ledger = Ledger(spark, store.root, clock=lambda: RUN)
    ingest_table(products(spark, 10), CFG, store, ledger, RUN)
    assert ingest_table(products(spark, 0), CFG, store, ledger, RUN).appended == 0


def test_a_run_fails_on_an_empty_reference_table(spark, store):
    config = LandingConfig(tables=(TableConfig("ref_state", "ref_state", "full_load", None, ("state_code",)),))
    states = spark.createDataFrame([("CA", "California")], "state_code string, state_name string")
    assert Run(store, RUN, config=config).land({"ref_state": states}) == {"ref_state": 1}
    with pytest.raises(BatchRejected, match="ref_state: empty full load"):
        Run(store, RUN, config=config).execute({"ref_state": states.where("false")})
    row = Ledger(spark, store.root).frame().orderBy("batch_key").collect()[-1]
    assert (row["target_table"], row["batch_status"]) == ("ref_state", "failed")


def test_limits_by_source():
    assert freshness_limits("oltp_invoice") == (24, 48)
    assert freshness_limits("ref_tax_rate") == (None, None)
    assert freshness_limits("econ_indicator") == (840, 1080)


def test_states_by_age(spark):
    ages = {"oltp_a": 24, "oltp_b": 25, "oltp_c": 48, "oltp_d": 49, "ref_x": 9999, "econ_indicator": 841, "oltp_e": None}
    rows = spark.createDataFrame(list(ages.items()), "source string, h int").select(
        "source", (F.lit(RUN).cast("timestamp_ntz") - F.make_dt_interval(hours=F.col("h"))).alias("newest"))
    got = {r["source"]: r["status"] for r in source_freshness(rows, {n: freshness_limits(n) for n in ages}, RUN).collect()}
    assert got == {"oltp_a": "pass", "oltp_b": "warn", "oltp_c": "warn", "oltp_d": "error", "oltp_e": "error",
                   "ref_x": "exempt", "econ_indicator": "warn"}


def test_a_run_reads_the_last_batches_alone(spark, store):
    config = LandingConfig(tables=(CFG, TableConfig("ref_state", "ref_state", "full_load", None, ("state_code",))))
    for at, n in (("2026-01-01 08:00:00", 5), ("2026-01-09 07:00:00", 6)):
        run = Run(store, at, config=config)
        run.land({"product": products(spark, n)})
    late = Run(store, RUN, config=config)
    found = late.freshness()
    assert [tuple(r)[:1] + tuple(r)[2:] for r in found.collect()] == [("oltp_product", 25, "warn")]
    assert len(store.newest_value("bronze", "oltp_product", "bronze_loaded_at_timestamp").inputFiles()) < len(
        store.read("bronze", "oltp_product").inputFiles())
