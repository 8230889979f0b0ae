"""A load versions only invoices that a merged row can have changed, and compares only versions of their ids."""

from pyspark.sql import functions as F

from lakestrata.operators import scd, sieve
from lakestrata.operators.scd import DimensionSpec, scd2_apply
from lakestrata.plans.dimensions import stage_invoice
from lakestrata.session import stage


def tell(df):
    return sorted(map(str, df.collect()))


def invoices(spark, names, numbers, at):
    """Invoices with customer and store; ``numbers`` and ``names`` say what was merged at ``at``, and what for."""
    old, new = "timestamp_ntz'2002-01-01 08:00:00'", f"timestamp_ntz'{at}'"
    i = spark.range(12).selectExpr(
        "if(id = 11, null, id) silver_invoice_id", "'I' || id silver_invoice_number", "'p' silver_po_number",
        "date'1999-01-01' silver_invoice_date", "'paid' silver_invoice_status",
        f"cast(if(id in ({numbers}), 2, 1) as decimal(18,2)) silver_total_amount", "id % 4 silver_customer_id",
        "if(id = 9, null, 1L) silver_store_id", "false silver_is_deleted_flag", "'s' silver_source_system",
        "timestamp_ntz'1999-02-02' silver_source_updated_at_timestamp",
        f"if(id in ({numbers}), {new}, {old}) silver_updated_at_timestamp")
    c = spark.range(3).selectExpr(
        "id silver_customer_id", "'A' || id silver_customer_account_no",
        f"if(id in ({names}), 'new', 'old') || id silver_customer_name",
        f"if(id in ({names}), {new}, {old}) silver_updated_at_timestamp")
    s = spark.sql(f"select 1L silver_store_id, 'S' silver_store_code, 'n' silver_store_name, {old} silver_updated_at_timestamp")
    return {"invoice": i, "customer": c, "store": s}


def test_invoices_are_staged_again_only_where_a_part_was_merged(spark):
    first, later = invoices(spark, "-1", "-1", "2002-01-01 08:00:00"), invoices(spark, "2", "4", "2002-01-02 08:00:00")
    spec = DimensionSpec("d", "k", ("invoice_number", "invoice_total", "customer_name"), ("'x'", "0", "'x'"))
    target = scd2_apply(spec, stage_invoice(first), None, "b1", "2002-01-01 08:00:00")
    newer = stage(stage_invoice(later, since="2002-01-01 08:00:00"), "newer")
    # customer 2: invoices 2, 6 and 10; invoice 4 itself; the one without an id, which no version matches
    assert sorted(r.invoice_number for r in newer.collect()) == ["I10", "I11", "I2", "I4", "I6"]
    want = tell(scd2_apply(spec, stage_invoice(later), target, "b2", "2002-01-02 08:00:00"))
    assert tell(scd2_apply(spec, newer, target, "b2", "2002-01-02 08:00:00", stored=True)) == want


def test_versions_by_bitmap_are_the_same(spark, monkeypatch):
    spec = DimensionSpec("d", "k", ("name",), ("'x'",))
    rows = spark.range(500).selectExpr(
        "if(id = 7, null, cast(id as string)) source_record_id", "'n' || id name", "'h' || id record_hash", "'s' source_system",
        "false is_deleted", "timestamp_ntz'2001-01-01' src_updated_at")
    target = scd2_apply(spec, rows, None, "b1", "2002-01-01 08:00:00")
    changed = rows.where("name < 'n2' or source_record_id is null").withColumn("record_hash", F.concat("record_hash", F.lit("x")))
    staged = stage(changed, "staged")
    want = tell(scd2_apply(spec, changed, target, "b2", "2002-01-02 08:00:00"))
    real = sieve.marked
    monkeypatch.setattr(scd, "marked", lambda r, k, on: real(r, k, on, 0))
    monkeypatch.setattr(scd, "possible", lambda r, k, on: real(r, k, on, 0).where("_maybe").drop("_maybe"))
    assert tell(scd2_apply(spec, staged, target, "b2", "2002-01-02 08:00:00", stored=True)) == want
