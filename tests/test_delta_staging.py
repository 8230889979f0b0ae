"""Dimensions staged for the touched entities equal dimensions compared whole, and move no large table."""

import shutil

import pytest
from pyspark.sql import functions as F

from lakestrata import session
from lakestrata.operators.calendar import dim_date
from lakestrata.operators.merge import without
from lakestrata.operators.scd import scd2_apply
from lakestrata.plans import dimensions as dims
from lakestrata.plans.dimensions import SCD2_DIMENSIONS, STAGES
from lakestrata.session import scratch_scope
from lakestrata.sources.store import TableStore
from workload import warehouse as w

SPEC = {s.name: s for s in SCD2_DIMENSIONS}
LATER = "2002-01-05 08:00:00"
CONTENT = ["source_record_id", "row_version", "is_current", "record_hash", "valid_from", "valid_to"]


BUCKETS = {"silver.invoice": 3, "silver.customer_address": 3, "silver.customer": 4}


@pytest.fixture(scope="module")
def first_load(spark, sf, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("first"))
    w.new_run(TableStore(spark, root, BUCKETS), w.RUN_1).execute(w.sources(spark, sf, 1), w.documents(spark, sf), checks=False)
    return root


@pytest.fixture
def loaded(spark, first_load, tmp_path):
    """A warehouse of its own after the first load: tables name their folders relatively, so they can be copied."""
    shutil.copytree(first_load, tmp_path / "wh")
    return TableStore(spark, str(tmp_path / "wh"), BUCKETS)


def change(store, table, where, **columns):
    """Rows of a current-state table change as a merge would change them."""
    key = dims.SPECS[table].keys[0]
    rows = store.read("silver", table).where(where).withColumns(
        {**{c: F.expr(e).cast(store.read("silver", table).schema[c].dataType) for c, e in columns.items()},
         dims.MERGED_AT: F.lit(LATER).cast("timestamp_ntz")})
    rows = session.stage(rows, "change")
    store.rewrite("silver", table, rows, lambda old: without(old, rows, [key]), rows)
    return rows.count()


def loads_like_a_whole_comparison(spark, store, name):
    """The stored dimension after its load, compared with the plan over whole tables."""
    run = w.new_run(store, LATER)
    t = run.tables()
    want = scd2_apply(SPEC[name], STAGES[name](t), t[name], "b", LATER).select(CONTENT).collect()
    with scratch_scope(spark):
        n = run.dimension(SPEC[name], t, "b", w.RUN_1)
    got = store.read("gold", name).select(CONTENT).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
    return n


def test_address_moves_to_another_customer(spark, loaded):
    moved = change(loaded, "customer_address", "silver_customer_id in (3, 5) and silver_is_primary_flag", silver_customer_id="8")
    assert moved == 2
    # 3 and 5 lose their address, 8 has three, hence the old and both new customers
    assert loads_like_a_whole_comparison(spark, loaded, "dim_customer") >= 4


def test_address_stops_being_primary(spark, loaded):
    assert change(loaded, "customer_address", "silver_customer_id = 4 and silver_is_primary_flag", silver_is_primary_flag="false") == 1
    assert loads_like_a_whole_comparison(spark, loaded, "dim_customer") == 1


def test_a_state_reaches_its_customers_and_stores(spark, loaded):
    assert change(loaded, "state", "upper(trim(silver_state_code)) = 'NC'", silver_state_name="'Elsewhere'") == 1
    assert loads_like_a_whole_comparison(spark, loaded, "dim_customer") > 0
    assert loads_like_a_whole_comparison(spark, loaded, "dim_store") > 0


def test_a_store_reaches_its_invoices(spark, loaded):
    assert change(loaded, "store", "silver_store_id = 2", silver_store_name="'Moved'") == 1
    assert loads_like_a_whole_comparison(spark, loaded, "dim_invoice") > 0


def test_another_calendar_reaches_its_customers(spark, loaded):
    loaded.overwrite("gold", "dim_date", dim_date(spark, LATER, "1990-01-01", "1995-02-28"))
    assert loads_like_a_whole_comparison(spark, loaded, "dim_customer") > 0


def test_nothing_touched(spark, loaded):
    for name in SPEC:
        assert loads_like_a_whole_comparison(spark, loaded, name) == 0


def test_small_batches_move_no_large_table(spark, loaded, monkeypatch):
    """No exchange below which a large table is read whole."""
    assert change(loaded, "invoice", "silver_invoice_id < 100", silver_po_number="'changed'") > 0
    assert change(loaded, "customer", "silver_customer_id = 1", silver_customer_name="'Changed'") == 1
    plans = []

    def stage(df, label="stage"):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return session.stage(df, label)

    monkeypatch.setattr(dims, "stage", stage)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "12k")  # the staged ids fit, the tables don't
    try:
        assert loads_like_a_whole_comparison(spark, loaded, "dim_invoice") > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plans
    for plan in plans:
        assert "SortMergeJoin" not in plan, plan
        lines = plan.splitlines()
        for k, line in enumerate(lines):
            if "Exchange hashpartitioning" in line:
                depth = len(line) - len(line.lstrip(" :+-"))
                below = []
                for other in lines[k + 1:]:
                    if len(other) - len(other.lstrip(" :+-")) <= depth:
                        break
                    below.append(other)
                scans = [x for x in below if "FileScan" in x]
                cut = [x for x in below if "LeftSemi" in x or f"isnotnull({dims.MERGED_AT}" in x]
                assert not scans or cut, plan
