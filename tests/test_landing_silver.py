import pytest
from pyspark.sql import functions as F

from lakestrata.plans.silver import SPECS, merge_silver, silver_changes, silver_table
from lakestrata.sources import landing
from lakestrata.sources.config import TableConfig, landing_schema
from lakestrata.sources.ledger import Ledger
from lakestrata.sources.series import catalogue, ingest_series, observations

RUN = "2026-01-10 08:00:00"
PRODUCT = TableConfig("product", "oltp_product", "full_load", None, ("product_id",))
CUSTOMER = TableConfig("customer", "oltp_customer", "incremental", "updated_at")


def products(spark, rows):
    df = spark.createDataFrame(rows, "product_id bigint, sku string, brand string, unit_cost decimal(12,2)")
    stamp = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    return df.withColumn("created_at", stamp).withColumn("updated_at", stamp).withColumn("surprise", F.lit(1))


def customers(spark, rows):
    schema = ("customer_id bigint, first_name string, last_name string, business_name string, email string, "
              "phone string, customer_status string, updated_at timestamp_ntz")
    df = spark.createDataFrame(rows, schema.replace("timestamp_ntz", "string"))
    return df.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


def land(spark, cfg, rows, batch, start=0):
    out = landing.standardize(rows, cfg, batch, RUN)
    return out.withColumn("bronze_record_id", F.monotonically_increasing_id() + start + 1)


def test_standardize_renames_stamps_and_reports_gaps(spark):
    rows = products(spark, [(1, "s", "b", None)])
    out = land(spark, PRODUCT, rows, 3)
    assert set(out.columns) == set(landing_schema("oltp_product").fieldNames())
    r = out.first()
    assert r["unit_cost_amount"] is None and r["bronze_source_system"] == "oltp" and r["bronze_batch_id"] == 3
    assert r["bronze_is_deleted_flag"] is False and '"unit_cost":null' in r["bronze_raw_payload_jsonb"]
    dropped, unfilled = landing.column_gap(rows, PRODUCT)
    assert dropped == ["surprise"] and "markup_pct" in unfilled


def test_source_updated_at_wins(spark):
    rows = products(spark, [(1, "s", "b", None), (2, "s", "b", None)]).withColumn(
        "source_updated_at", F.when(F.col("product_id") == 1, F.lit("2026-01-05 00:00:00").cast("timestamp_ntz")))
    out = {r["product_id"]: str(r["updated_at_source_timestamp"]) for r in land(spark, PRODUCT, rows, 1).collect()}
    assert out == {1: "2026-01-05 00:00:00", 2: "2026-01-01 00:00:00"}


def test_full_load_skips_unchanged_and_lands_reverts(spark, store):
    """Current state is the newest hash per key, not the newest batch."""
    ledger = Ledger(spark, store.root, clock=lambda: RUN)

    def load(rows):
        return landing.ingest_table(products(spark, rows), PRODUCT, store, ledger, RUN).appended

    base = [(i, f"s{i}", "b", None) for i in range(40)]
    assert load(base) == 40
    changed = [(i, f"s{i}", "B2" if i < 15 else "b", None) for i in range(40)]
    assert load(changed) == 15
    assert load(changed) == 0  # after a partial batch nothing is landed again
    assert load(base) == 15  # the old value is no longer current
    assert load([]) == 0
    rows = store.read("bronze", "oltp_product")
    assert rows.count() == 70 and rows.select("bronze_record_id").distinct().count() == 70
    done = ledger.frame().orderBy("batch_key").collect()
    assert [(r["rows_extracted"], r["rows_inserted"]) for r in done] == [(40, 40), (40, 15), (40, 0), (40, 15), (0, 0)]


def test_incremental_reads_back_an_hour_and_empty_loads_keep_the_mark(spark, store):
    ledger = Ledger(spark, store.root, clock=lambda: RUN)
    row = lambda i, at: (i, "a", "b", None, None, None, "active", at)
    first = customers(spark, [row(1, "2026-01-01 10:00:00"), row(2, "2026-01-01 12:00:00")])
    assert landing.ingest_table(first, CUSTOMER, store, ledger, RUN).watermark == "2026-01-01 12:00:00"
    late = first.unionByName(customers(spark, [row(3, "2026-01-01 11:30:00"), row(4, "2026-01-01 10:59:00")]))
    # 2 is read again, 3 committed late but inside the hour, 4 is too old
    assert landing.ingest_table(late, CUSTOMER, store, ledger, RUN).appended == 2
    assert landing.ingest_table(first.where("false"), CUSTOMER, store, ledger, RUN).appended == 0
    assert landing.ingest_table(late, CUSTOMER, store, ledger, RUN).appended == 2


def test_failing_extract_closes_its_batch(spark, store):
    ledger = Ledger(spark, store.root, clock=lambda: RUN)
    bad = customers(spark, [(1, "a", "b", None, None, None, "x", "2026-01-01 00:00:00")]).withColumn(
        "default_tax_rate_id", F.lit("not a number"))
    with pytest.raises(Exception):
        landing.ingest_table(bad, CUSTOMER, store, ledger, RUN)
    assert [r["batch_status"] for r in ledger.frame().collect()] == ["failed"]
    assert not store.exists("bronze", "oltp_customer")


def test_customer_cleaning(spark):
    rows = customers(spark, [
        (1, "  MARIA ", "  o'neil   lopez ", " ", "John@X.com ", "(480) 863-7834", " Active ", "2026-01-01 00:00:00"),
        (2, None, None, "  Acme   Print LLC", "", None, "frozen", "2026-01-01 00:00:00"),
        (3, None, None, None, None, "n/a", None, "2026-01-01 00:00:00"),
    ])
    out = {r["silver_customer_id"]: r for r in
           silver_table(SPECS["customer"], land(spark, CUSTOMER, rows, 1), batch_id=1, run_ts=RUN).collect()}
    assert out[1]["silver_customer_name"] == "Maria O'Neil Lopez"
    assert out[1]["silver_email"] == "john@x.com" and out[1]["silver_phone_number"] == "4808637834"
    assert out[1]["silver_is_active_flag"] is True
    assert out[2]["silver_customer_name"] == "Acme Print LLC"
    assert out[2]["silver_email"] is None and out[2]["silver_customer_status"] is None
    assert out[2]["silver_is_active_flag"] is False
    assert out[3]["silver_customer_name"] is None and out[3]["silver_is_active_flag"] is None


def test_ties_go_to_the_highest_record_id(spark):
    rows = [customers(spark, [(1, n, "x", None, None, None, "active", "2026-01-01 00:00:00")]) for n in "abc"]
    landed = [land(spark, CUSTOMER, r, 1, start=i * 100) for i, r in enumerate(rows)]
    out = silver_table(SPECS["customer"], landed[2].unionByName(landed[0]).unionByName(landed[1]), batch_id=1, run_ts=RUN)
    assert [r["silver_first_name"] for r in out.collect()] == ["C"]


def test_merge_is_idempotent_and_keeps_the_creation_stamp(spark, store):
    a = customers(spark, [(i, "a", "b", None, None, None, "active", "2026-01-01 00:00:00") for i in range(5)])
    b = customers(spark, [(1, "a ", " b", None, None, None, "ACTIVE", "2026-02-01 00:00:00"),
                          (2, "new", "b", None, None, None, "active", "2025-01-01 00:00:00"),
                          (9, "z", "z", None, None, None, "active", "2026-02-01 00:00:00")])
    cols = landing_schema("oltp_customer").fieldNames()
    store.append("bronze", "oltp_customer", land(spark, CUSTOMER, a, 1).select(cols), 1)
    assert merge_silver(store, SPECS["customer"], batch_id=10, run_ts="2026-01-10 08:00:00") == 5
    assert merge_silver(store, SPECS["customer"], batch_id=11, run_ts="2026-01-11 08:00:00") == 0
    store.append("bronze", "oltp_customer", land(spark, CUSTOMER, b, 2, 1000).select(cols), 2)
    # 1 only differs in spelling; 2 is older at the source, yet the newer batch wins
    assert merge_silver(store, SPECS["customer"], batch_id=12, run_ts="2026-01-12 08:00:00") == 2
    got = {r["silver_customer_id"]: r for r in store.read("silver", "customer").collect()}
    assert len(got) == 6 and got[2]["silver_first_name"] == "New" and got[1]["silver_batch_id"] == 10
    assert str(got[2]["silver_created_at_timestamp"]).startswith("2026-01-10")
    assert str(got[2]["silver_updated_at_timestamp"]).startswith("2026-01-12")
    assert merge_silver(store, SPECS["customer"], batch_id=13, run_ts="2026-01-13 08:00:00") == 0


def test_batch_id_is_required(spark):
    with pytest.raises(ValueError):
        silver_changes(SPECS["customer"], None, None, batch_id=None, run_ts=RUN)


def test_paid_in_full_for_void_invoice(spark):
    cfg = TableConfig("invoice", "oltp_invoice", "incremental", "updated_at")
    rows = spark.sql("select 1L as invoice_id, 'Void' as status_code, 10.00BD as total_amount, 0.00BD as paid_amount, "
                     "0.00BD as balance_due, timestamp_ntz'2026-01-01 00:00:00' as updated_at")
    r = silver_table(SPECS["invoice"], land(spark, cfg, rows, 1), batch_id=1, run_ts=RUN).first()
    assert r["silver_invoice_status"] == "void"
    assert r["silver_paid_in_full_flag"] is False and r["silver_has_balance_due_flag"] is False


def test_series_documents(spark, store):
    docs = spark.createDataFrame(
        [("CPIAUCSL", [("2025-01-01", "100.5"), ("2025-02-01", "."), ("2025-03-01", "")]), ("WPU0911", [("2025-01-01", "7")])],
        "series_id string, observations array<struct<date: string, value: string>>")
    rows = observations(docs, catalogue(spark), "2025-02-01")
    assert sorted((r["series_id"], str(r["observation_date"]), r["indicator_value"]) for r in rows.collect()) == [
        ("CPIAUCSL", "2025-02-01", None), ("CPIAUCSL", "2025-03-01", None)]
    ledger = Ledger(spark, store.root, clock=lambda: RUN)
    assert ingest_series(docs, store, ledger, RUN).appended == 4
    assert ingest_series(docs, store, ledger, RUN).appended == 1  # the last month is pulled again
    assert merge_silver(store, SPECS["econ_indicator"], batch_id=1, run_ts=RUN) == 4
