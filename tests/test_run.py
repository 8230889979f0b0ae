"""Whole runs against the stored warehouse, and the stream twin."""

import pytest
from pyspark.sql import functions as F

from lakestrata.plans import facts
from lakestrata.plans.run import ChecksFailed, serve
from lakestrata.plans.silver import SPECS
from lakestrata.sources.ledger import gold_watermark
from lakestrata.sources.store import TableStore
from workload import given, warehouse as w
from workload.star import CONFIGS, star

RUN_3 = "2002-01-03 08:00:00"
STAMPS = {"etl_batch_id", "etl_load_timestamp", "etl_updated_timestamp"}


@pytest.fixture(scope="module")
def warehouse(spark, sf, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("wh"))
    buckets = {"silver.invoice": 3, "silver.payment": 2, "gold.fact_retail_sales": 3, "gold.dim_invoice": 2, "gold.fact_payments": 2}
    store = TableStore(spark, root, buckets)
    reports = []
    for wave, ts in ((1, w.RUN_1), (2, w.RUN_2), (2, RUN_3)):
        run = w.new_run(store, ts)
        run.calendar = star(spark, sf).bounds
        run.snapshot_date = "2001-07-31"
        reports.append(run.execute(w.sources(spark, sf, wave), w.documents(spark, sf), checks=wave == 2 and ts == w.RUN_2))
    return store, reports


def same(a, b):
    columns = [c for c in a.columns if c not in STAMPS]
    assert set(b.columns) == set(a.columns)
    assert a.select(columns).exceptAll(b.select(columns)).count() == 0
    assert b.select(columns).exceptAll(a.select(columns)).count() == 0


def test_stored_tables_equal_the_planned_ones(spark, sf, warehouse):
    """Bucketed copy-on-write runs end in the same star as the in-memory plans."""
    store, _ = warehouse
    s = star(spark, sf)
    for name in ("dim_customer", "dim_product", "dim_invoice", "dim_store"):
        same(store.read("gold", name), s.dim(name))
    same(store.read("gold", "fact_retail_sales"), s.sales())
    same(store.read("gold", "fact_payments"), s.payments())


def test_repeated_run_changes_nothing(warehouse):
    _, reports = warehouse
    third = reports[2]
    assert sum(third.merged.values()) == 0
    assert third.star["gold.fact_retail_sales"] == third.star["gold.fact_payments"] == 0
    assert third.star["gold.fact_customer_behavior_snapshot"] == 0
    assert reports[1].star["gold.fact_retail_sales"] > 0 and reports[1].star["gold.fact_payments"] > 0


def test_trail_and_ledger(spark, sf, warehouse):
    store, reports = warehouse
    s = star(spark, sf)
    moved = facts.moved_keys(s.payments(1), s.new_payments()).select(F.col("_old").alias("parent_payment_key"))
    followed = (s.payments(1).join(moved, "parent_payment_key", "left_semi")
                .join(s.changed_payments(), "source_record_id", "left_anti").count())
    trail = store.read("audit", "audit_log")
    counts = {r["table_name"]: r["count"] for r in trail.groupBy("table_name").count().collect()}
    # refunds that follow their reloaded parent to its new key leave a trail as well
    assert followed > 0
    assert counts == {"gold.fact_retail_sales": reports[1].star["gold.fact_retail_sales"],
                      "gold.fact_payments": reports[1].star["gold.fact_payments"] + followed}
    run = w.new_run(store, RUN_3)
    ledger = run.ledger.frame()
    assert ledger.where("batch_status <> 'succeeded'").count() == 0
    joined = store.read("gold", "dim_customer").where("customer_key > 0").join(
        ledger.withColumnRenamed("batch_id", "etl_batch_id"), "etl_batch_id")
    assert joined.count() == store.read("gold", "dim_customer").count() - 1


def test_serving_views(spark, warehouse):
    store, _ = warehouse
    views = serve(w.new_run(store, RUN_3).tables(), register=True)
    assert len(views) == 17
    assert spark.table("bi_fact_payments").where("is_refund").count() > 0
    assert "email" not in " ".join(views["bi_dim_customer"].columns)


def test_staged_tables_go_with_their_scope(spark):
    from lakestrata.session import scratch_root, scratch_scope, stage
    from lakestrata.sources.files import Files

    files, root = Files(spark, scratch_root(spark)), scratch_root(spark)
    outer = stage(spark.range(3), "outer")
    with scratch_scope(spark):
        assert stage(spark.range(5), "inner-scope").count() == 5
        assert [n for n in files.names(root) if n.startswith("inner-scope")]
    assert not [n for n in files.names(root) if n.startswith("inner-scope")]
    assert outer.count() == 3


def test_overlapping_scopes_keep_each_others_tables(spark):
    from concurrent.futures import ThreadPoolExecutor
    from threading import Event

    from lakestrata.session import in_scope, scratch_scope, stage

    began, ended = Event(), Event()

    def first():
        with scratch_scope(spark), ThreadPoolExecutor(1) as pool:
            mine = pool.submit(in_scope(stage), spark.range(7), "first-scope").result()
            began.set()
            assert ended.wait(60)
            return mine.count()

    def second():
        assert began.wait(60)
        with scratch_scope(spark):
            stage(spark.range(3), "second-scope")
        ended.set()

    with ThreadPoolExecutor(2) as pool:
        one, two = pool.submit(first), pool.submit(second)
        two.result()
        assert one.result() == 7


def test_failing_check_holds_the_marks(spark, sf, tmp_path):
    store = TableStore(spark, str(tmp_path))
    run = w.new_run(store, w.RUN_1)
    run.tolerated = ()
    with pytest.raises(ChecksFailed) as err:
        run.execute(w.sources(spark, sf, 1), w.documents(spark, sf))
    assert "series fresh" in str(err.value)
    ledger = run.ledger.frame()
    assert gold_watermark(ledger, "gold.fact_retail_sales") == "1900-01-01 00:00:00"
    state = {r["target_table"]: r["batch_status"] for r in ledger.collect()}
    assert state["gold.fact_payments"] == "failed" and state["silver"] == "succeeded"
    assert "running" not in state.values()


def test_stream_equals_batch(spark, sf, tmp_path):
    from lakestrata.sources.ledger import Ledger
    from lakestrata.streaming.micro_batch import source_stream, start

    drop = str(tmp_path / "drop")
    given.source(spark, sf, "payment", 1).repartition(3).write.parquet(drop)
    store = TableStore(spark, str(tmp_path / "store"))
    tick = iter(range(10, 60))
    ledger = Ledger(spark, store.root, clock=lambda: f"2002-01-01 08:00:{next(tick)}")
    cfg, check = CONFIGS["oltp_payment"], str(tmp_path / "check")
    schema = spark.read.parquet(drop).schema

    def drain():
        q = start(source_stream(spark, drop, schema, 2), store, ledger, cfg, check)
        q.awaitTermination(240)
        assert q.exception() is None

    drain()
    given.source(spark, sf, "payment", 2).write.mode("append").parquet(drop)
    drain()
    want = star(spark, sf).silver("payment").select("silver_payment_id", "silver_row_hash")
    got = store.read("silver", "payment").select("silver_payment_id", "silver_row_hash")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    assert ledger.frame().where(F.col("batch_status") == "succeeded").count() >= 3
    assert "payment" in SPECS
