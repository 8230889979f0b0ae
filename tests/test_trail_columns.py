"""Trail rows meet as plain columns; reasons are gathered for reloaded invoices only."""

import re

from lakestrata.operators import changelog, sieve
from lakestrata.operators.changelog import change_log, change_reasons
from lakestrata.session import stage


def tell(df):
    return sorted(map(str, df.collect()))


def fact(spark, rows, add):
    return spark.range(rows).selectExpr(
        "if(id % 17 = 0, null, cast(id as string)) source_record_id", f"id + {add * 100} sales_line_key",
        "'I' || id % 9 invoice_number", f"cast(id + if(id % 3 = 0, {add}, 0) as decimal(12,2)) sales_amount",
        "if(id % 4 = 0, null, 's') source_system", f"'load:{add}' etl_batch_id")


def trail(spark):
    before, after = stage(fact(spark, 60, 0), "before"), stage(fact(spark, 50, 1), "after")
    return change_log(before, after, table="t", surrogate_key="sales_line_key", record_key="invoice_number", batch_id="load:1",
                      run_ts="2002-01-02 08:00:00")


def test_trail_rows_are_the_same_from_plain_columns(spark):
    got = {}
    for r in trail(spark).collect():
        got.setdefault(r.operation_type, []).append(r)
    # without an id there is no successor; ids 51 to 59 have none either, 51 has no id
    assert len(got["DELETE"]) == 3 + 10 and all(r.new_row is None and r.changed_columns is None for r in got["DELETE"])
    one = next(r for r in got["UPDATE"] if '"source_record_id":"3"' in r.old_row)
    assert one.old_row == ('{"source_record_id":"3","sales_line_key":3,"invoice_number":"I3","sales_amount":3.00,'
                           '"source_system":"s","etl_batch_id":"load:0"}')
    assert '"sales_amount":4.00' in one.new_row and one.changed_columns == ["sales_amount"]
    assert {tuple(r.changed_columns or ()) for r in got["UPDATE"]} == {(), ("sales_amount",)}
    assert {r.source_system for r in got["UPDATE"]} == {None, "s"}


def test_no_structs_travel(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = trail(spark)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below = plan[plan.index("SortMergeJoin"):]
    assert "Exchange hashpartitioning" in below and not re.search(r"struct\(", below)


def test_reasons_of_stored_invoices(spark, monkeypatch):
    adjustments = spark.range(400).selectExpr(
        "if(id % 19 = 0, null, id % 50) silver_invoice_id", "if(id % 5 = 0, null, 'r' || id % 7) silver_adjustment_reason")
    invoices = stage(spark.range(20).selectExpr("id silver_invoice_id", "'I' || id % 15 silver_invoice_number"), "ids")
    want = tell(change_reasons(adjustments, invoices))
    assert tell(change_reasons(adjustments, invoices, stored=True)) == want
    cut, real = [], sieve.possible

    def possible(rows, keys, on):
        out = real(rows, keys, on, 0)
        cut.append((rows.count(), out.count()))
        return out

    monkeypatch.setattr(changelog, "possible", possible)
    assert tell(change_reasons(adjustments, invoices, stored=True)) == want
    assert cut[0][1] < cut[0][0]
