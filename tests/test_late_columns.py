"""What follows from an invoice's parts is derived by the readers of its versions, neither sorted nor stored."""

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import scd
from lakestrata.operators.scd import scd2_apply
from lakestrata.plans.dimensions import INVOICE, invoice_labels, invoice_parts, stage_invoice
from lakestrata.session import stage

FIRST, LATER = "2002-01-01 08:00:00", "2002-01-02 08:00:00"


def tell(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def tables(spark, moved):
    """Invoices (one twice, one without an id) whose customer 2 stands twice, so that its invoices fan out."""
    i = spark.range(30).selectExpr(
        "if(id = 7, null, id % 25) silver_invoice_id", "'I' || id % 25 silver_invoice_number", "if(id = 3, null, 'p') silver_po_number",
        "date'1999-01-01' silver_invoice_date", "'paid' silver_invoice_status",
        f"cast(if(id = {moved}, 2, 1) as decimal(18,2)) silver_total_amount", "id % 4 silver_customer_id",
        "if(id = 9, null, 1L) silver_store_id", "id = 5 silver_is_deleted_flag", "'s' silver_source_system",
        "timestamp_ntz'1999-02-02' silver_source_updated_at_timestamp",
        f"timestamp_ntz'{LATER if moved >= 0 else FIRST}' silver_updated_at_timestamp")
    c = spark.sql(f"select explode(array(0L, 1L, 2L, 2L)) silver_customer_id, timestamp_ntz'{FIRST}' silver_updated_at_timestamp")
    c = c.selectExpr("*", "'A' || silver_customer_id silver_customer_account_no",
                     "repeat('n', 99) || monotonically_increasing_id() silver_customer_name")
    s = spark.sql(f"select 1L silver_store_id, 'S' silver_store_code, 'n' silver_store_name, timestamp_ntz'{FIRST}' silver_updated_at_timestamp")
    return {"invoice": i, "customer": stage(c.coalesce(1), "customers"), "store": s}


def test_invoice_versions_sort_and_store_parts_only(spark, monkeypatch):
    sorted_rows = []
    real = scd.assign_keys
    monkeypatch.setattr(scd, "assign_keys", lambda df, *more: sorted_rows.append(df.columns) or real(df, *more))
    first, later = tables(spark, -1), tables(spark, 12)
    later["customer"] = first["customer"]
    target = scd2_apply(INVOICE, invoice_parts(first), None, "b1", FIRST, late=invoice_labels())
    assert "record_hash" not in sorted_rows[0] and "customer_name" not in sorted_rows[0]
    whole = scd2_apply(INVOICE, stage_invoice(first), None, "b1", FIRST)
    assert tell(target) == tell(whole) and target.schema == whole.schema
    newer = stage(invoice_parts(later, since=FIRST), "newer")
    got = scd2_apply(INVOICE, newer, target, "b2", LATER, stored=True, late=invoice_labels())
    want = scd2_apply(INVOICE, stage_invoice(later), whole, "b2", LATER)
    assert tell(got) == tell(want) and got.where("row_version = 2").count() > 0


def test_totals_that_do_not_fit_fail_the_load(spark):
    t = tables(spark, -1)
    t["invoice"] = t["invoice"].withColumn("silver_total_amount", F.lit("12345678901.00").cast("decimal(18,2)"))
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        scd2_apply(INVOICE, invoice_parts(t), None, "b1", FIRST, late=invoice_labels())
