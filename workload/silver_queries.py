"""Current-state operators and the 21 tables (SLV*, SNK3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakestrata.functions.text import vocab
from lakestrata.operators.merge import HISTORY_ORDER, dedup_latest
from lakestrata.plans.silver import INVOICE_STATUS, SPECS, clean

from .duck import SILVER
from .registry import query
from .source_sql import RUN_1
from .star import landed, star

_KINDS = {"flag": "b", "id": "l", "num": "l", "number": "l", "qty": "l", "order": "l", "amount": "d", "pct": "d",
          "value": "d"}
_TEXT = ("silver_invoice_number", "silver_po_number", "silver_phone_number", "silver_series_id")


def _spec_of(entity: str) -> str:
    out = []
    for c, _ in SILVER[entity][1]:
        name = f"silver_{c}"
        kind = "s" if name in _TEXT else _KINDS.get(c.rsplit("_", 1)[-1], "s")
        out.append(f"{name}:{kind}")
    return " ".join([*out, "silver_is_deleted_flag:b", "silver_row_hash:s"])


def _register(entity: str) -> None:
    def table(spark, sf):
        return star(spark, sf).silver(entity)

    query(_spec_of(entity), f"SELECT * FROM sv_{entity}", name=f"slv_{entity}")(table)


for _entity in SPECS:
    _register(_entity)


def _versions(spark, sf):
    """Three landed versions of every invoice: two ties on the update time, one older row."""
    base = landed(spark, sf, "oltp_invoice")
    older = base.withColumns({"updated_at_source_timestamp": F.lit(None).cast("timestamp_ntz"),
                              "bronze_record_id": F.col("bronze_record_id") + F.lit(1 << 54), "notes": F.lit("old")})
    tied = base.withColumns({"bronze_record_id": F.col("bronze_record_id") + F.lit(1 << 53), "notes": F.lit("tied")})
    return base.unionByName(older).unionByName(tied)


@query("invoice_id:l notes updated_at_source_timestamp",
       "SELECT invoice_id, 'tied' AS notes, updated_at AS updated_at_source_timestamp FROM src_invoice_1")
def slv_dedup_latest(spark, sf):
    """Missing update times lose, ties go to the highest landing id."""
    return dedup_latest(_versions(spark, sf), ["invoice_id"])


@query("status_history_id:l note", "SELECT status_history_id, 'again' AS note FROM src_invoice_status_history_1")
def slv_history_dedup(spark, sf):
    base = landed(spark, sf, "oltp_invoice_status_history")
    again = base.withColumns({"bronze_record_id": F.col("bronze_record_id") + F.lit(1 << 53), "note": F.lit("again")})
    return dedup_latest(base.unionByName(again), ["status_history_id"], HISTORY_ORDER)


@query("o_orderpriority status:s n:l", """
    SELECT o_orderpriority, CASE trim(lower(s)) WHEN 'paid' THEN 'paid' WHEN 'open' THEN 'open' WHEN 'void' THEN 'void' END AS status, count(*) AS n
    FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN ' PAID ' WHEN 'O' THEN 'Open' ELSE 'unknown' END AS s FROM orders) o GROUP BY 1, 2""")
def slv_vocab_map(spark, sf):
    from . import given

    raw = F.when(F.col("o_orderstatus") == "F", " PAID ").when(F.col("o_orderstatus") == "O", "Open").otherwise("unknown")
    return given.table(spark, sf, "orders").groupBy("o_orderpriority", vocab(raw, INVOICE_STATUS).alias("status")).agg(
        F.count(F.lit(1)).alias("n"))


@query("silver_invoice_id:l silver_has_balance_due_flag:b silver_paid_in_full_flag:b", """
    SELECT invoice_id AS silver_invoice_id, balance_due > 0 AS silver_has_balance_due_flag, paid_amount >= total_amount AS silver_paid_in_full_flag
    FROM src_invoice_1""")
def slv_derived_flags(spark, sf):
    return clean(SPECS["invoice"], landed(spark, sf, "oltp_invoice"), 1, RUN_1)


@query("silver_source_system silver_source_table_name silver_source_record_id silver_source_created_at_timestamp "
       "silver_source_updated_at_timestamp silver_bronze_batch_id:l silver_batch_id:l silver_created_at_timestamp silver_is_deleted_flag:b", f"""
    SELECT 'oltp' AS silver_source_system, 'payment' AS silver_source_table_name, CAST(payment_id AS VARCHAR) AS silver_source_record_id,
      created_at AS silver_source_created_at_timestamp, updated_at AS silver_source_updated_at_timestamp, 1 AS silver_bronze_batch_id,
      7 AS silver_batch_id, TIMESTAMP '{RUN_1}' AS silver_created_at_timestamp, false AS silver_is_deleted_flag FROM src_payment_1""")
def slv_lineage_block(spark, sf):
    return clean(SPECS["payment"], landed(spark, sf, "oltp_payment"), 7, RUN_1)


@query("silver_invoice_id:l silver_row_hash", "SELECT silver_invoice_id, silver_row_hash FROM sv_invoice_1")
def slv_row_hash(spark, sf):
    return clean(SPECS["invoice"], landed(spark, sf, "oltp_invoice"), 1, RUN_1)


@query("silver_invoice_id:l silver_invoice_status silver_balance_due_amount:d", "SELECT * FROM chg_invoice")
def slv_hash_gate(spark, sf):
    """Only invoices whose cleaned content differs from the stored row pass."""
    return star(spark, sf).changes("invoice")


@query("silver_payment_id:l silver_payment_amount:d silver_created_at_timestamp silver_updated_at_timestamp", f"""
    SELECT silver_payment_id, silver_payment_amount, TIMESTAMP '{RUN_1}' AS silver_created_at_timestamp,
      CASE WHEN silver_payment_id IN (SELECT silver_payment_id FROM chg_payment) THEN TIMESTAMP '2002-01-02 08:00:00'
           ELSE TIMESTAMP '{RUN_1}' END AS silver_updated_at_timestamp FROM sv_payment""")
def slv_merge(spark, sf):
    """Updated rows keep their creation stamp."""
    return star(spark, sf).silver("payment")
