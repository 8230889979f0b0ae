"""Rows without a sound key are set aside while their batch is landed."""

import json

import pytest
from pyspark.sql import functions as F

from lakestrata.sources import landing
from lakestrata.sources.config import TableConfig
from lakestrata.sources.ledger import Ledger
from test_landing_silver import CUSTOMER, RUN, customers
from workload import warehouse as w

AT = "2026-01-01 00:00:00"


def raw_customers(spark, ids):
    rows = customers(spark, [(k, "a", "b", None, None, None, "active", AT) for k in range(len(ids))])
    names = spark.createDataFrame(list(enumerate(ids)), "_k long, _id string")
    return rows.join(names, F.col("customer_id") == F.col("_k")).withColumn("customer_id", F.col("_id")).drop("_k", "_id")


def test_uncastable_and_missing_keys(spark, store):
    ledger = Ledger(spark, store.root, clock=lambda: RUN)
    rows = raw_customers(spark, ["1", "x7", None, "  ", "99999999999999999999", "2", "3.0x"])
    result = landing.ingest_table(rows, CUSTOMER, store, ledger, RUN)
    assert (result.extracted, result.appended, result.rejected) == (7, 2, 5)
    assert sorted(r[0] for r in store.read("bronze", "oltp_customer").select("customer_id").collect()) == [1, 2]
    aside = store.read("quarantine", "oltp_customer").collect()
    reasons = {json.loads(r["raw_row"])["customer_id"]: list(r["reasons"]) for r in aside}
    assert reasons == {"x7": ["uncastable customer_id"], None: ["missing customer_id"], "  ": ["missing customer_id"],
                       "99999999999999999999": ["uncastable customer_id"], "3.0x": ["uncastable customer_id"]}
    assert {r["batch_key"] for r in aside} == {result.batch.key}
    done = ledger.frame().collect()[0]
    assert (done["rows_extracted"], done["rows_inserted"], done["rows_rejected"]) == (7, 2, 5)
    # the mark covers the rejected rows
    assert done["watermark_value_end"] == AT


def test_reasons_name_every_uncastable_column(spark, store):
    ledger = Ledger(spark, store.root, clock=lambda: RUN)
    rows = raw_customers(spark, ["x", "1"]).withColumn("home_store_id", F.when(F.col("customer_id") == "x", "far").otherwise("4"))
    result = landing.ingest_table(rows, CUSTOMER, store, ledger, RUN)
    assert (result.appended, result.rejected) == (1, 1)
    assert sorted(store.read("quarantine", "oltp_customer").first()["reasons"]) == ["uncastable customer_id", "uncastable home_store_id"]


def test_another_column_fails_the_batch(spark, store):
    ledger = Ledger(spark, store.root, clock=lambda: RUN)
    rows = raw_customers(spark, ["1", "2"]).withColumn("home_store_id", F.lit("far"))
    with pytest.raises(Exception):
        landing.ingest_table(rows, CUSTOMER, store, ledger, RUN)
    assert not store.exists("quarantine", "oltp_customer")
    assert [r["batch_status"] for r in ledger.frame().collect()] == ["failed"]


def test_full_loads_set_rows_aside_too(spark, store):
    cfg = TableConfig("product", "oltp_product", "full_load", None, ("product_id",))
    ledger = Ledger(spark, store.root, clock=lambda: RUN)

    def load(ids):
        rows = spark.createDataFrame([(i, f"s{i}") for i in ids], "product_id string, sku string")
        return landing.ingest_table(rows, cfg, store, ledger, RUN)

    first, second, third = load(["1", "2", "bad"]), load(["1", "2", "3", "bad"]), load(["1", "2", "3"])
    assert [(r.extracted, r.appended, r.rejected) for r in (first, second, third)] == [(3, 2, 1), (4, 1, 1), (3, 0, 0)]
    assert store.read("quarantine", "oltp_product").count() == 2


def test_a_run_with_one_uncastable_key_completes(spark, sf, tmp_path):
    from lakestrata.sources.store import TableStore

    store = TableStore(spark, str(tmp_path / "wh"))
    sources = w.sources(spark, sf, 1)
    payments = sources["payment"]
    text = payments.withColumn("payment_id", F.col("payment_id").cast("string"))
    one = text.orderBy(F.col("payment_id").cast("long")).limit(1).withColumns(
        {"payment_id": F.lit("no number"), "surplus": F.lit(1)})
    sources["payment"] = text.withColumn("surplus", F.lit(1)).unionByName(one)
    report = w.new_run(store, w.RUN_1).execute(sources, w.documents(spark, sf), checks=False)
    assert report.rejected["payment"] == 1 and sum(report.rejected.values()) == 1
    assert report.landed["payment"] == payments.count()
    assert report.columns["payment"][0] == ("surplus",)
    assert store.read("quarantine", "oltp_payment").count() == 1
    assert store.read("silver", "payment").count() == payments.count()
    row = w.new_run(store, w.RUN_1).ledger.frame().where("target_table = 'oltp_payment'").first()
    assert (row["batch_status"], row["rows_rejected"]) == ("succeeded", 1)
