"""Current-state layer: one generic operator, driven by 21 table specs.

landing rows not yet processed -> newest per key -> clean and cast -> lineage ->
change hash -> only new or changed keys -> upsert.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.dates import ts
from ..functions.hashing import row_hash
from ..functions.intervals import Intervals
from ..operators.merge import HISTORY_ORDER, LATEST_ORDER, dedup_latest, dedup_stored, hash_gate, without
from ..session import stage
from ..sources.store import TableStore

CREATED = "silver_created_at_timestamp"
HASH = "silver_row_hash"

Rule = Callable[[], Column]


# -- column rules: deferred, because a Column needs a running session ------------
def cast(source: str, kind: str) -> Rule:
    return lambda: F.col(source).cast(kind)


def long(source: str) -> Rule:
    return cast(source, "bigint")


def money(source: str) -> Rule:
    return cast(source, "decimal(18,2)")


def day(source: str) -> Rule:
    return cast(source, "date")


def flag(source: str) -> Rule:
    return cast(source, "boolean")


def words(source: str, width: int) -> Rule:
    """Free text: trimmed, inner blanks squeezed."""
    return lambda: text.clip(text.collapse(F.col(source)), width)


def code(source: str, width: int) -> Rule:
    """Codes keep their case and are only trimmed."""
    return lambda: text.clip(text.blank_to_null(F.col(source)), width)


def trimmed(source: str, width: int) -> Rule:
    """Trimmed, empty text stays empty."""
    return lambda: text.clip(F.trim(F.col(source)), width)


def person(source: str, width: int) -> Rule:
    return lambda: text.clip(text.title_case(text.collapse(F.col(source))), width)


def _full_name() -> Column:
    return text.title_case(text.collapse(F.concat_ws(" ", "first_name", "last_name")))


def full_name(width: int) -> Rule:
    return lambda: text.clip(_full_name(), width)


def customer_name(width: int) -> Rule:
    """The business name as written, otherwise the person's name in title case."""
    return lambda: text.clip(F.coalesce(text.collapse(F.col("business_name")), _full_name()), width)


def phone(source: str) -> Rule:
    return lambda: text.clip(text.digits(F.col(source)), 50)


def email(source: str) -> Rule:
    return lambda: text.clip(text.lower_code(F.col(source)), 255)


def upper(source: str, width: int) -> Rule:
    return lambda: text.clip(text.upper_code(F.col(source)), width)


def upper_key(source: str, width: int) -> Rule:
    return lambda: text.clip(F.upper(F.trim(F.col(source))), width)


def lower(source: str, width: int) -> Rule:
    return lambda: text.clip(text.lower_code(F.col(source)), width)


def one_of(source: str, allowed: tuple[str, ...]) -> Rule:
    return lambda: text.vocab(F.col(source), allowed)


# Closed status and type vocabularies.
CUSTOMER_STATUS = ("active", "inactive")
INVOICE_STATUS = ("open", "partial", "paid", "void")
PAYMENT_STATUS = ("pending", "cleared", "failed", "refunded", "void")
ADDRESS_TYPE = ("billing", "shipping")


@dataclass(frozen=True)
class SilverSpec:
    name: str
    source: str
    source_keys: tuple[str, ...]
    keys: tuple[str, ...]
    columns: dict[str, Rule]
    history: bool = False
    record_id: Rule | None = None

    @property
    def order(self):
        return HISTORY_ORDER if self.history else LATEST_ORDER

    def record(self) -> Column:
        return self.record_id() if self.record_id else F.col(self.source_keys[0]).cast("string")


def _spec(name: str, source: str, source_key: str, columns: dict[str, Rule], **kw) -> SilverSpec:
    return SilverSpec(name, source, (source_key,), (next(iter(columns)),), columns, **kw)


def _transition(name: str, source: str, entity: str, vocabulary: tuple[str, ...], note: tuple[str, str]) -> SilverSpec:
    columns = {
        "silver_status_history_id": long("status_history_id"),
        f"silver_{entity}": long(entity),
        "silver_old_status": one_of("old_status", vocabulary),
        "silver_new_status": one_of("new_status", vocabulary),
        "silver_changed_at_timestamp": cast("changed_at_source_timestamp", "timestamp_ntz"),
        "silver_changed_by_employee_id": long("changed_by"),
        note[1]: words(note[0], 200),
    }
    return _spec(name, source, "status_history_id", columns, history=True)


SPECS: dict[str, SilverSpec] = {
    s.name: s
    for s in (
        _spec("customer", "oltp_customer", "customer_id", {
            "silver_customer_id": long("customer_id"),
            "silver_customer_account_no": code("customer_account_no", 30),
            "silver_business_name": words("business_name", 255),
            "silver_first_name": person("first_name", 100),
            "silver_last_name": person("last_name", 100),
            "silver_customer_name": customer_name(255),
            "silver_email": email("email"),
            "silver_phone_number": phone("phone"),
            "silver_customer_status": one_of("customer_status", CUSTOMER_STATUS),
            "silver_is_active_flag": lambda: F.lower(F.trim("customer_status")) == "active",
            "silver_default_tax_rate_id": long("default_tax_rate_id"),
            "silver_home_store_id": long("home_store_id"),
            "silver_first_order_date": day("first_order_date"),
        }),
        _spec("customer_address", "oltp_customer_address", "address_id", {
            "silver_address_id": long("address_id"),
            "silver_customer_id": long("customer_id"),
            "silver_address_type": one_of("address_type", ADDRESS_TYPE),
            "silver_street_address_line_1": words("street_address", 200),
            "silver_street_address_line_2": words("street_address2", 100),
            "silver_city": words("city", 100),
            "silver_state_code": upper("state_code", 2),
            "silver_zip_code": code("zip_code", 10),
            "silver_is_primary_flag": flag("is_primary_flag"),
        }),
        _transition("customer_status_history", "oltp_customer_status_history", "customer_id", CUSTOMER_STATUS,
                    ("reason", "silver_change_reason")),
        _spec("department", "oltp_department", "department_id", {
            "silver_department_id": long("department_id"),
            "silver_department_code": code("department_code", 20),
            "silver_department_name": words("department_name", 100),
            "silver_department_description": words("description", 200),
            "silver_is_active_flag": flag("is_active_flag"),
        }),
        SilverSpec("econ_indicator", "econ_indicator", ("series_id", "observation_date"),
                   ("silver_series_id", "silver_observation_date"), {
            "silver_series_id": upper_key("series_id", 50),
            "silver_observation_date": day("observation_date"),
            "silver_indicator_value": cast("indicator_value", "decimal(18,6)"),
            "silver_units": code("units", 50),
        }, record_id=lambda: F.concat("series_id", F.lit("-"), F.col("observation_date").cast("string"))),
        _spec("employee", "oltp_employee", "employee_id", {
            "silver_employee_id": long("employee_id"),
            "silver_employee_code": code("employee_code", 30),
            "silver_first_name": person("first_name", 100),
            "silver_last_name": person("last_name", 100),
            "silver_full_name": full_name(200),
            "silver_email": email("email"),
            "silver_phone_number": phone("phone"),
            "silver_role": code("role", 30),
            "silver_store_id": long("store_id"),
            "silver_hire_date": day("hire_date"),
            "silver_is_active_flag": flag("is_active_flag"),
        }),
        _spec("invoice", "oltp_invoice", "invoice_id", {
            "silver_invoice_id": long("invoice_id"),
            "silver_invoice_number": code("invoice_number", 30),
            "silver_customer_id": long("customer_id"),
            "silver_store_id": long("store_id"),
            "silver_employee_id": long("employee_id"),
            "silver_billing_address_id": long("billing_address_id"),
            "silver_shipping_address_id": long("shipping_address_id"),
            "silver_po_number": code("po_number", 50),
            "silver_invoice_date": day("invoice_date"),
            "silver_invoice_due_date": day("invoice_due_date"),
            "silver_invoice_status": one_of("invoice_status", INVOICE_STATUS),
            "silver_tax_rate_id": long("tax_rate_id"),
            "silver_subtotal_amount": money("subtotal_amount"),
            "silver_discount_amount": money("discount_amount"),
            "silver_tax_amount": money("tax_amount"),
            "silver_fee_amount": money("fee_amount"),
            "silver_total_amount": money("total_amount"),
            "silver_paid_amount": money("paid_amount"),
            "silver_balance_due_amount": money("balance_due_amount"),
            "silver_has_balance_due_flag": lambda: F.col("balance_due_amount") > 0,
            "silver_paid_in_full_flag": lambda: F.col("paid_amount") >= F.col("total_amount"),
            "silver_notes": words("notes", 1000),
        }),
        _spec("invoice_adjustment", "oltp_invoice_adjustment", "adjustment_id", {
            "silver_adjustment_id": long("adjustment_id"),
            "silver_invoice_id": long("invoice_id"),
            "silver_adjustment_type": code("adjustment_type", 20),
            "silver_adjustment_amount": money("amount"),
            "silver_adjustment_reason": words("reason", 200),
            "silver_adjusted_by_employee_id": long("adjusted_by"),
            "silver_adjustment_date": day("adjustment_date"),
        }),
        _spec("invoice_line", "oltp_invoice_line", "invoice_line_id", {
            "silver_invoice_line_id": long("invoice_line_id"),
            "silver_invoice_id": long("invoice_id"),
            "silver_line_number": cast("line_number", "smallint"),
            "silver_product_id": long("product_id"),
            "silver_variant_id": long("variant_id"),
            "silver_line_description": words("line_description", 300),
            "silver_color": words("color", 40),
            "silver_order_qty": cast("order_qty", "int"),
            "silver_unit_price_amount": money("unit_price_amount"),
            "silver_unit_cost_amount": money("unit_cost_amount"),
            "silver_discount_amount": money("discount_amount"),
            "silver_line_total_amount": money("line_total_amount"),
        }),
        _spec("invoice_status", "ref_invoice_status", "status_code", {
            "silver_status_code": lower("status_code", 20),
            "silver_status_name": words("status_name", 50),
            "silver_is_terminal_flag": flag("is_terminal_flag"),
            "silver_sort_order": cast("sort_order", "smallint"),
        }),
        _transition("invoice_status_history", "oltp_invoice_status_history", "invoice_id", INVOICE_STATUS,
                    ("note", "silver_change_note")),
        _spec("payment", "oltp_payment", "payment_id", {
            "silver_payment_id": long("payment_id"),
            "silver_invoice_id": long("invoice_id"),
            "silver_customer_id": long("customer_id"),
            "silver_payment_method_id": long("payment_method_id"),
            "silver_payment_type_id": long("payment_type_id"),
            "silver_employee_id": long("employee_id"),
            "silver_store_id": long("store_id"),
            "silver_parent_payment_id": long("parent_payment_id"),
            "silver_payment_sequence_num": cast("payment_sequence_num", "smallint"),
            "silver_payment_status": one_of("payment_status", PAYMENT_STATUS),
            "silver_payment_date": day("payment_date"),
            "silver_payment_amount": money("gross_amount"),
            "silver_tax_amount": money("tax_amount"),
            "silver_fee_amount": money("fee_amount"),
            "silver_net_amount": money("net_amount"),
            "silver_reference_no": code("reference_no", 60),
        }),
        _spec("payment_method", "ref_payment_method", "payment_method_id", {
            "silver_payment_method_id": long("payment_method_id"),
            "silver_method_code": code("method_code", 20),
            "silver_method_name": words("method_name", 50),
            "silver_method_type": code("method_type", 30),
            "silver_is_card_flag": flag("is_card_flag"),
            "silver_is_active_flag": flag("is_active_flag"),
        }),
        _spec("payment_status", "ref_payment_status", "status_code", {
            "silver_status_code": lower("status_code", 20),
            "silver_status_name": words("status_name", 50),
        }),
        _spec("payment_type", "ref_payment_type", "payment_type_id", {
            "silver_payment_type_id": long("payment_type_id"),
            "silver_type_code": code("type_code", 20),
            "silver_type_name": words("type_name", 50),
            "silver_type_description": words("description", 200),
            "silver_affects_balance_flag": flag("affects_balance_flag"),
        }),
        _spec("product", "oltp_product", "product_id", {
            "silver_product_id": long("product_id"),
            "silver_product_sku": trimmed("sku", 50),
            "silver_product_name": trimmed("product_name", 255),
            "silver_product_description": lambda: text.blank_to_null(F.col("description")),
            "silver_department_id": long("department_id"),
            "silver_category_id": long("category_id"),
            "silver_brand_name": trimmed("brand", 100),
            "silver_standard_cost_amount": money("unit_cost_amount"),
            "silver_markup_pct": cast("markup_pct", "decimal(8,4)"),
            "silver_standard_price_amount": money("standard_price_amount"),
            "silver_is_local_made_flag": flag("is_local_made_flag"),
            "silver_is_active_flag": flag("is_active_flag"),
        }),
        _spec("product_category", "oltp_product_category", "category_id", {
            "silver_category_id": long("category_id"),
            "silver_department_id": long("department_id"),
            "silver_category_code": code("category_code", 40),
            "silver_category_name": words("category_name", 100),
            "silver_category_description": words("description", 200),
            "silver_is_active_flag": flag("is_active_flag"),
        }),
        _spec("refund", "oltp_refund", "refund_id", {
            "silver_refund_id": long("refund_id"),
            "silver_payment_id": long("payment_id"),
            "silver_invoice_id": long("invoice_id"),
            "silver_refund_amount": money("refund_amount"),
            "silver_refund_date": day("refund_date"),
            "silver_refund_reason": words("reason", 200),
            "silver_refunded_by_employee_id": long("refunded_by"),
        }),
        _spec("state", "ref_state", "state_code", {
            "silver_state_code": upper_key("state_code", 2),
            "silver_state_name": code("state_name", 50),
        }),
        _spec("store", "oltp_store", "store_id", {
            "silver_store_id": long("store_id"),
            "silver_store_code": code("store_code", 30),
            "silver_store_name": words("store_name", 100),
            "silver_street_address": words("street_address", 200),
            "silver_city": words("city", 100),
            "silver_state_code": upper("state_code", 2),
            "silver_zip_code": code("zip_code", 10),
            "silver_phone_number": phone("phone"),
            "silver_region": words("region", 50),
            "silver_store_type": code("store_type", 50),
            "silver_open_date": day("open_date"),
            "silver_is_active_flag": flag("is_active_flag"),
        }),
        _spec("tax_rate", "ref_tax_rate", "tax_rate_id", {
            "silver_tax_rate_id": long("tax_rate_id"),
            "silver_tax_code": code("tax_code", 20),
            "silver_tax_description": words("description", 100),
            "silver_rate_pct": cast("rate_pct", "decimal(6,4)"),
            "silver_effective_from_date": day("effective_from"),
            "silver_effective_to_date": day("effective_to"),
            "silver_is_active_flag": flag("is_active_flag"),
        }),
    )
}


def lineage(record_id: Column, created: str, updated: str, batch_id: int, run_ts: str) -> list[Column]:
    """The lineage and metadata block every current-state row ends with."""
    return [
        text.clip(F.col("bronze_source_system"), 100).alias("silver_source_system"),
        text.clip(F.col("bronze_source_table_name"), 150).alias("silver_source_table_name"),
        record_id.cast("string").alias("silver_source_record_id"),
        F.col(created).cast("timestamp_ntz").alias("silver_source_created_at_timestamp"),
        F.col(updated).cast("timestamp_ntz").alias("silver_source_updated_at_timestamp"),
        F.col("bronze_record_id").cast("bigint").alias("silver_bronze_record_id"),
        F.col("bronze_batch_id").cast("bigint").alias("silver_bronze_batch_id"),
        F.lit(batch_id).cast("bigint").alias("silver_batch_id"),
        ts(run_ts).alias(CREATED),
        ts(run_ts).alias("silver_updated_at_timestamp"),
        F.col("bronze_is_deleted_flag").cast("boolean").alias("silver_is_deleted_flag"),
    ]


def unprocessed(landed: DataFrame, merged: Intervals) -> DataFrame:
    """Landing rows of batches that aren't merged yet, whatever their number."""
    return landed.where(~merged.holds("bronze_batch_id"))


def clean(spec: SilverSpec, newest: DataFrame, batch_id: int, run_ts: str) -> DataFrame:
    """Apply the column rules, add the lineage block and the change hash."""
    created = updated = "changed_at_source_timestamp"
    if not spec.history:
        created, updated = "created_at_source_timestamp", "updated_at_source_timestamp"
    rows = newest.select(
        *[rule().alias(name) for name, rule in spec.columns.items()],
        *lineage(spec.record(), created, updated, batch_id, run_ts),
    )
    return rows.withColumn(HASH, row_hash(spec.columns))


def cleaned_latest(spec: SilverSpec, landed: DataFrame, batch_id: int, run_ts: str, stored: bool = False) -> DataFrame:
    """The newest landing row of every key, cleaned; ``stored`` landing rows may be read more than once."""
    dedup = dedup_stored if stored else dedup_latest
    return clean(spec, dedup(landed, list(spec.source_keys), spec.order), batch_id, run_ts)


def silver_changes(
    spec: SilverSpec, landed: DataFrame, target: DataFrame | None, *, batch_id: int, run_ts: str, stored: bool = False
) -> DataFrame:
    """Rows to upsert. ``landed`` is already limited to the batches to process.

    ``stored`` landing rows are staged once they are clean, and the target is cut to their keys.
    """
    if batch_id is None:
        raise ValueError("silver_changes needs the id of the batch that writes the rows")
    rows = cleaned_latest(spec, landed, batch_id, run_ts, stored)
    if stored and target is not None:
        rows = stage(rows, f"clean-{spec.name}", "zstd")
    return hash_gate(rows, target, list(spec.keys), HASH, carry=(CREATED,), narrow=stored)


def silver_table(spec: SilverSpec, landed: DataFrame, *, batch_id: int, run_ts: str, stored: bool = False) -> DataFrame:
    """First build: every key is new."""
    return silver_changes(spec, landed, None, batch_id=batch_id, run_ts=run_ts, stored=stored)


MERGED = "merged_batches"


def merged_batches(store: TableStore, spec: SilverSpec) -> Intervals:
    """The landed batches a stored table holds; of a table without a record all up to its highest."""
    meta = store.manifest("silver", spec.name).meta
    if MERGED in meta:
        return Intervals.read(meta[MERGED])
    top = store.read("silver", spec.name).agg(F.coalesce(F.max("silver_bronze_batch_id"), F.lit(0))).first()[0]
    return Intervals(((0, top),))


def settled(ledger: DataFrame, target: str, merged: Intervals) -> Intervals:
    """``merged`` with the numbers in its gaps that can't land any more: those of other targets and of own finished loads.

    What stays a gap is a load that is open, or that failed and may have landed all the same.
    """
    gaps = Intervals(tuple(merged.gaps()))
    if merged.ranges and merged.ranges[0][0] > 1:
        gaps = gaps.add([(1, merged.ranges[0][0] - 1)])
    over = (F.col("target_table") != target) | (F.col("batch_status") == "succeeded")
    done = ledger.where(gaps.holds("batch_key") & over).select("batch_key").collect()  # loads since the last merge
    return merged.add((r[0], r[0]) for r in done)


def not_superseded(landed: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Without the rows of late batches whose key also stands in a merged batch of a higher number.

    Batches merged in any order so end in what they give in the order of their numbers.
    """
    later = after.groupBy(*keys).agg(F.max("bronze_batch_id").alias("_later"))
    kept = landed.join(later, keys, "left").where(F.col("_later").isNull() | (F.col("_later") < F.col("bronze_batch_id")))
    return kept.select(landed.columns)


def merge_silver(store: TableStore, spec: SilverSpec, *, batch_id: int, run_ts: str, ledger: DataFrame | None = None) -> int:
    """Bring one stored table up to date with its landing table; returns the rows written.

    The set of merged batches is committed with the rows. A batch that was opened before others
    and lands after them is merged when it is there. With the ledger, in a state stored before
    the call, the set's gaps are closed where no batch can land any more.
    """
    keys = list(spec.keys)
    numbers = store.batches("bronze", spec.source)

    def note(before: Intervals) -> dict:
        after = before.add((n, n) for n in numbers)
        return {MERGED: (settled(ledger, spec.source, after) if ledger is not None else after).stored()}

    if not store.exists("silver", spec.name):
        rows = silver_table(spec, store.read("bronze", spec.source), batch_id=batch_id, run_ts=run_ts)
        return store.overwrite("silver", spec.name, rows, keys, note(Intervals()))
    merged = merged_batches(store, spec)
    landed = store.read_unmerged("bronze", spec.source, merged)
    if landed is None:
        return 0
    target = store.read("silver", spec.name)
    late = [n for n in numbers if n not in merged and n < merged.top]
    if late:
        after = store.read_since("bronze", spec.source, min(late)).where(merged.holds("bronze_batch_id"))
        landed = not_superseded(landed, after, list(spec.source_keys))
    rows = stage(cleaned_latest(spec, landed, batch_id, run_ts), f"clean-{spec.name}")
    # the gate carries the creation stamp over, so the merge itself needs no second join
    changes = stage(hash_gate(rows, target, keys, HASH, (CREATED,), narrow=True), f"changes-{spec.name}")
    if changes.isEmpty():
        store.note("silver", spec.name, **note(merged))
        return 0
    return store.rewrite("silver", spec.name, changes, lambda old: without(old, changes, keys), changes, note(merged))
