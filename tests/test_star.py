import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import quality as dq
from lakestrata.operators.asof import as_of_lookup
from lakestrata.operators.changelog import change_log, change_reasons
from lakestrata.operators.keys import assign_keys
from lakestrata.operators.ordered import neighbour
from lakestrata.operators.scd import DimensionSpec, scd2_apply, version_changes
from lakestrata.plans import facts, serving

SPEC = DimensionSpec("dim_thing", "thing_key", ("name",), ("'Not Provided'",))


def staged(spark, rows):
    df = spark.createDataFrame(rows, "source_record_id string, name string, updated string")
    return df.select(
        "source_record_id", "name", F.sha2("name", 256).alias("record_hash"), F.lit("oltp").alias("source_system"),
        F.lit(False).alias("is_deleted"), F.col("updated").cast("timestamp_ntz").alias("src_updated_at"))


def chain(dim, ident):
    rows = dim.where(F.col("source_record_id") == ident).orderBy("row_version").collect()
    return [(r["name"], str(r["valid_from"]), str(r["valid_to"]), r["is_current"], r["row_version"]) for r in rows]


def test_type2_over_four_loads(spark):
    one = staged(spark, [("1", "a", "2020-01-01"), ("2", "b", "2020-01-01")])
    d1 = scd2_apply(SPEC, one, None, "b1", "2020-01-02 00:00:00")
    assert d1.count() == 3 and d1.where("thing_key = -1").first()["name"] == "Not Provided"
    again = scd2_apply(SPEC, one, d1, "b2", "2020-02-02 00:00:00")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, d1.collect()))
    two = staged(spark, [("1", "a2", "2023-06-15"), ("2", "b", "2024-01-01"), ("10", "c", "2023-01-01")])
    d2 = scd2_apply(SPEC, two, d1, "b3", "2023-07-01 00:00:00")
    assert chain(d2, "1") == [("a", "1900-01-01", "2023-06-15", False, 1), ("a2", "2023-06-15", "None", True, 2)]
    # an entity that is new on a later load still starts at the beginning of time, version 1
    assert chain(d2, "10") == [("c", "1900-01-01", "None", True, 1)]
    keys = {(r["source_record_id"], r["row_version"]): r["thing_key"] for r in d2.collect()}
    assert keys == {("-1", 1): -1, ("1", 1): 1, ("2", 1): 2, ("1", 2): 3, ("10", 1): 4}
    back = staged(spark, [("1", "a", "2023-09-01"), ("2", "b", "2024-01-01"), ("10", "c", "2023-01-01")])
    d3 = scd2_apply(SPEC, back, d2, "b4", "2023-10-01 00:00:00")
    assert [c[0] for c in chain(d3, "1")] == ["a", "a2", "a"]
    for check in (dq.scd2_overlaps, dq.scd2_one_current, dq.scd2_contiguous, dq.scd2_window_gaps):
        assert check(d3, "d").count() == 0
    log = version_changes(d3, ("name",)).orderBy("row_version").collect()
    assert [(r["old_value"], r["new_value"]) for r in log] == [("a", "a2"), ("a2", "a")]


def test_as_of_lookup_splits_at_the_change_date(spark):
    two = staged(spark, [("1", "a2", "2023-06-15")])
    dim = scd2_apply(SPEC, two, scd2_apply(SPEC, staged(spark, [("1", "a", "2020-01-01")]), None, "b", "2020-01-02 00:00:00"),
                     "b", "2023-07-01 00:00:00")
    rows = spark.createDataFrame([(1, "2023-06-14"), (1, "2023-06-15"), (7, "2023-06-15"), (None, "2023-06-15")], "id bigint, d string")
    rows = rows.withColumn("d", F.to_date("d"))
    for wanted in (None, rows):
        got = as_of_lookup(rows, dim, "id", "d", "thing_key", wanted=wanted)
        assert sorted((r["id"] or 0, str(r["d"]), r["thing_key"]) for r in got.collect()) == [
            (0, "2023-06-15", -1), (1, "2023-06-14", 1), (1, "2023-06-15", 2), (7, "2023-06-15", -1)]


def test_keys_are_dense_ordered_and_continue(spark):
    n = 5000
    df = spark.range(n).repartition(13).withColumn("hot", F.when(F.col("id") % 3 == 0, "x").otherwise(F.col("id").cast("string")))
    got = assign_keys(df, ["hot", "id"], "k", start=100).collect()
    want = {i: k for k, (_, i) in enumerate(sorted(("x" if i % 3 == 0 else str(i), i) for i in range(n)), 101)}
    assert {r["id"]: r["k"] for r in got} == want
    assert assign_keys(df.where("false"), ["hot", "id"], "k").count() == 0


def test_neighbour_matches_a_plain_window(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice("aaab"), rnd.randrange(40), i) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, t int, id int")
    for ahead in (False, True):
        got = neighbour(df, ["k"], ["t", "id"], {"other": "id"}, F.floor(F.col("t") / 7), ahead=ahead).collect()
        ordered = {k: sorted(r for r in rows if r[0] == k) for k in "ab"}
        step = 1 if ahead else -1
        want = {}
        for group in ordered.values():
            group = sorted(group, key=lambda r: (r[1], r[2]))
            for i, r in enumerate(group):
                j = i + step
                want[r[2]] = group[j][2] if 0 <= j < len(group) else None
        assert {r["id"]: r["other"] for r in got} == want


def test_overlaps_agree_with_pairwise_comparison(spark):
    rnd = random.Random(7)
    day = date(2020, 1, 1)
    rows = []
    for e in range(300):
        for v in range(1, rnd.randrange(2, 5)):
            lo = day + timedelta(rnd.randrange(12))
            hi = None if rnd.random() < 0.2 else lo + timedelta(rnd.randrange(-2, 8))
            rows.append((str(e), v, lo, hi, True))
    dim = spark.createDataFrame(rows, "source_record_id string, row_version int, valid_from date, valid_to date, is_current boolean")
    far = date(9999, 12, 31)
    bad = set()
    for a in rows:
        for b in rows:
            if a[0] == b[0] and a[1] < b[1] and a[2] < (b[3] or far) and b[2] < (a[3] or far):
                bad.add(a[0])
    got = {r["source_record_id"] for r in dq.scd2_overlaps(dim, "d").collect()}
    assert got == bad and 0 < len(bad) < 300


def test_change_log_reports_only_the_edited_line(spark):
    cols = "sales_line_key int, invoice_number string, sales_amount decimal(12,2), gross_profit decimal(12,2), source_system string, source_record_id string, etl_batch_id string"
    from decimal import Decimal as D
    before = spark.createDataFrame([(1, "I", D(10), D(4), "s", "a", "1"), (2, "I", D(5), D(1), "s", "b", "1"), (3, "I", D(7), D(1), "s", "gone", "1")], cols)
    after = spark.createDataFrame([(9, "I", D(9), D(3), "s", "a", "2"), (10, "I", D(5), D(1), "s", "b", "2")], cols)
    log = change_log(before, after, table="t", surrogate_key="sales_line_key", record_key="invoice_number", batch_id="2", run_ts="2026-01-01 00:00:00")
    got = sorted(((r["operation_type"], r["changed_columns"], r["new_row"] is None) for r in log.collect()), key=str)
    assert got == [("DELETE", None, True), ("UPDATE", None, False), ("UPDATE", ["gross_profit", "sales_amount"], False)]


def test_change_reasons_are_bounded_but_exact(spark):
    n = 700  # one invoice with more reasons than fit
    adj = spark.createDataFrame([(1, f"r{i:04d}") for i in range(n)] * 2 + [(2, "b"), (2, "a"), (2, None)], "silver_invoice_id bigint, silver_adjustment_reason string")
    inv = spark.createDataFrame([(1, "I1"), (2, "I2")], "silver_invoice_id bigint, silver_invoice_number string")
    got = {r["invoice_number"]: r["change_reason"] for r in change_reasons(adj, inv).collect()}
    assert got["I2"] == "a; b"
    assert got["I1"] == "; ".join(f"r{i:04d}" for i in range(n))[:500]


def test_refund_parent_from_this_or_an_earlier_load(spark):
    new = spark.createDataFrame([(11, "1", None), (12, "2", 1), (13, "3", 99), (14, "4", 50)], "payment_key int, source_record_id string, parent_payment_id bigint")
    old = spark.createDataFrame([(5, "50", None), (6, "1", None)], "payment_key int, source_record_id string, parent_payment_key int")
    got = {r["source_record_id"]: r["parent_payment_key"] for r in facts.resolve_parent(new, old).collect()}
    assert got == {"1": None, "2": 11, "3": None, "4": 5}
    kids = spark.createDataFrame([(7, "70", 6), (8, "80", 5), (9, "90", None)], "payment_key int, source_record_id string, parent_payment_key int")
    moved = facts.moved_keys(old, new)
    assert {r["payment_key"]: r["parent_payment_key"] for r in facts.repoint_children(kids, moved).collect()} == {7: 11, 8: 5, 9: None}


def econ(spark, rows):
    return spark.createDataFrame(rows, "silver_series_id string, d string, silver_indicator_value decimal(18,6)").withColumn("silver_observation_date", F.to_date("d"))


def test_revenue_real_fills_missing_values_and_drops_missing_months(spark):
    from decimal import Decimal as D
    sales = spark.createDataFrame([(20240105, D(100), D(10)), (20240205, D(100), D(20)), (20240305, D(100), D(0)), (20240405, D(100), D(0)), (-1, D(50), D(0))],
                                  "date_key int, sales_amount decimal(12,2), gross_profit decimal(12,2)")
    cpi = econ(spark, [("CPIAUCSL", "2024-01-01", D(100)), ("CPIAUCSL", "2024-02-01", None), ("CPIAUCSL", "2024-04-01", D(110))])
    got = {r["month_key"]: (float(r["cpi_index"]), float(r["real_revenue"]), float(r["inflation_uplift_pct"])) for r in serving.revenue_real(sales, cpi).collect()}
    assert got == {202401: (100.0, 110.0, 10.0), 202402: (100.0, 110.0, 10.0), 202404: (110.0, 100.0, 0.0)}
    ppi = econ(spark, [("WPU0911", "2024-01-01", D(7)), ("WPU0911", "2024-02-01", None)])
    rows = {r["month_key"]: (r["gross_margin_pct"], r["paper_ppi"]) for r in serving.margin_vs_paper(sales, ppi).collect()}
    assert set(rows) == {0, 202401, 202402, 202403, 202404}
    assert rows[202402] == (D("20.00"), D(7)) and rows[202403][1] is None
    assert [r["month_key"] for r in dq.months_without_basis(sales, cpi, "CPIAUCSL").collect()] == [0]
    assert {str(r["month"]) for r in dq.month_gaps(cpi).collect()} == {"2024-03-01"}


def test_never_ordered_customers_have_a_huge_gap(spark):
    from lakestrata.operators.calendar import dim_date
    cal = dim_date(spark, "2024-01-01 00:00:00")
    cols = ", ".join(f"0 as {c}" for c in serving.SNAPSHOT_VIEW if c not in ("snapshot_date_key", "last_order_date_key", "is_active_customer", "customer_status"))
    snap = spark.sql(f"select {cols}, 20240131 as snapshot_date_key, k as last_order_date_key, true as is_active_customer, 'active' as customer_status from values (-1), (20240120) as t(k)")
    got = {r["last_order_date_key"]: (r["days_since_last_order"], r["is_at_risk"]) for r in serving.snapshot_view(snap, cal).collect()}
    assert got == {-1: ((date(2024, 1, 31) - date(1900, 1, 1)).days, True), 20240120: (11, False)}


def test_quarantine_and_flags(spark):
    raw = spark.createDataFrame([("1", "a"), (None, "b"), ("x1", "c"), ("", "d")], "id string, v string")
    good, bad = dq.split_quarantine(raw, "id")
    assert good.count() == 1
    assert sorted((r["reason"], '"v"' in r["raw_row"]) for r in bad.collect()) == [
        ("missing key", True), ("missing key", True), ("uncastable key", True)]


def test_generic_checks_ignore_missing_values(spark):
    df = spark.createDataFrame([(None,), ("a",), ("z",), ("z",)], "v string")
    assert dq.accepted_values(df, "v", ["a"]).collect()[0]["n"] == 2
    assert dq.relationships(df, "v", spark.createDataFrame([("a",)], "p string"), "p").collect()[0]["v"] == "z"
    assert dq.unique(df, ["v"]).count() == 1
    assert dq.not_null(df, "v").count() == 1


def test_narrowing_overflow_is_an_error(spark):
    from decimal import Decimal as D
    df = spark.createDataFrame([(D("99999999999.00"),)], "v decimal(18,2)")
    with pytest.raises(Exception):
        df.select(F.col("v").cast("decimal(12,2)")).collect()
