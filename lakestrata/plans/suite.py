"""The check suite that gates a load: generic column tests and warehouse invariants."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality as dq
from ..operators.incremental import Change, relationships_delta, unique_delta
from .dimensions import SCD2_DIMENSIONS
from .serving import PAPER_SERIES, PRICE_SERIES
from .silver import ADDRESS_TYPE, CUSTOMER_STATUS, INVOICE_STATUS, PAYMENT_STATUS, SPECS

Tables = Mapping[str, DataFrame]

# every current-state table must have these filled
SILVER_REQUIRED = ("silver_source_system", "silver_batch_id", "silver_created_at_timestamp",
                   "silver_updated_at_timestamp", "silver_is_deleted_flag", "silver_row_hash")

# Accepted values, (table, column) -> list.
ACCEPTED: dict[tuple[str, str], tuple[str, ...]] = {
    ("state", "silver_state_code"): dq.STATES,
    ("customer", "silver_customer_status"): CUSTOMER_STATUS,
    ("invoice_status", "silver_status_code"): INVOICE_STATUS,
    ("payment_status", "silver_status_code"): PAYMENT_STATUS,
    ("payment", "silver_payment_status"): PAYMENT_STATUS,
    ("invoice", "silver_invoice_status"): INVOICE_STATUS,
    ("invoice_status_history", "silver_old_status"): INVOICE_STATUS,
    ("invoice_status_history", "silver_new_status"): INVOICE_STATUS,
    ("customer_status_history", "silver_old_status"): CUSTOMER_STATUS,
    ("customer_status_history", "silver_new_status"): CUSTOMER_STATUS,
    ("customer_address", "silver_address_type"): ADDRESS_TYPE,
    ("dim_date", "weekday_indicator"): ("Weekday", "Weekend", "Unknown"),
    ("dim_payment_type", "type_code"): ("DEPOSIT", "BALANCE", "FULL", "REFUND", "ADJUSTMENT", "Not Provided"),
    ("dim_product", "local_made_indicator"): ("Local", "Not Local", "Not Provided"),
    ("dim_cashier", "is_active"): ("Yes", "No"),
    ("dim_invoice", "invoice_status"): (*INVOICE_STATUS, "Not Provided"),
    ("fact_customer_behavior_snapshot", "customer_status"): CUSTOMER_STATUS,
}
# References, (child, column, parent, parent column).
REFERENCES = (
    ("product", "silver_department_id", "department", "silver_department_id"),
    ("product", "silver_category_id", "product_category", "silver_category_id"),
    ("customer", "silver_default_tax_rate_id", "tax_rate", "silver_tax_rate_id"),
    ("customer", "silver_home_store_id", "store", "silver_store_id"),
    ("product_category", "silver_department_id", "department", "silver_department_id"),
    ("employee", "silver_store_id", "store", "silver_store_id"),
    ("store", "silver_state_code", "state", "silver_state_code"),
    ("payment", "silver_invoice_id", "invoice", "silver_invoice_id"),
    ("payment", "silver_customer_id", "customer", "silver_customer_id"),
    ("payment", "silver_payment_method_id", "payment_method", "silver_payment_method_id"),
    ("payment", "silver_payment_type_id", "payment_type", "silver_payment_type_id"),
    ("invoice_line", "silver_invoice_id", "invoice", "silver_invoice_id"),
    ("invoice_line", "silver_product_id", "product", "silver_product_id"),
    ("refund", "silver_payment_id", "payment", "silver_payment_id"),
    ("refund", "silver_invoice_id", "invoice", "silver_invoice_id"),
    ("invoice_adjustment", "silver_invoice_id", "invoice", "silver_invoice_id"),
    ("invoice_status_history", "silver_invoice_id", "invoice", "silver_invoice_id"),
    ("customer_status_history", "silver_customer_id", "customer", "silver_customer_id"),
    ("customer_address", "silver_customer_id", "customer", "silver_customer_id"),
    ("customer_address", "silver_state_code", "state", "silver_state_code"),
    ("invoice", "silver_customer_id", "customer", "silver_customer_id"),
    ("invoice", "silver_store_id", "store", "silver_store_id"),
    ("invoice", "silver_employee_id", "employee", "silver_employee_id"),
    ("invoice", "silver_tax_rate_id", "tax_rate", "silver_tax_rate_id"),
    ("dim_customer", "first_order_date_key", "dim_date", "date_key"),
    ("fact_retail_sales", "date_key", "dim_date", "date_key"),
    ("fact_retail_sales", "cashier_key", "dim_cashier", "cashier_key"),
    ("fact_retail_sales", "product_key", "dim_product", "product_key"),
    ("fact_retail_sales", "customer_key", "dim_customer", "customer_key"),
    ("fact_retail_sales", "store_key", "dim_store", "store_key"),
    ("fact_retail_sales", "invoice_key", "dim_invoice", "invoice_key"),
    ("fact_payments", "invoice_key", "dim_invoice", "invoice_key"),
    ("fact_payments", "customer_key", "dim_customer", "customer_key"),
    ("fact_payments", "payment_method_key", "dim_payment_method", "payment_method_key"),
    ("fact_payments", "date_key", "dim_date", "date_key"),
    ("fact_payments", "payment_type_key", "dim_payment_type", "payment_type_key"),
    ("fact_payments", "cashier_key", "dim_cashier", "cashier_key"),
    ("fact_payments", "store_key", "dim_store", "store_key"),
    ("fact_customer_behavior_snapshot", "snapshot_date_key", "dim_date", "date_key"),
    ("fact_customer_behavior_snapshot", "customer_key", "dim_customer", "customer_key"),
    ("fact_customer_behavior_snapshot", "last_order_date_key", "dim_date", "date_key"),
)
# Surrogate key and further required columns of the star tables.
GOLD_KEYS: dict[str, tuple[str, ...]] = {
    "dim_date": ("date_key", "holiday_indicator"),
    "dim_payment_type": ("payment_type_key",),
    "dim_payment_method": ("payment_method_key",),
    "dim_product": ("product_key",),
    "dim_store": ("store_key",),
    "dim_cashier": ("cashier_key",),
    "dim_customer": ("customer_key", "first_order_date_key"),
    "dim_invoice": ("invoice_key",),
    "fact_retail_sales": ("sales_line_key", "date_key"),
    "fact_payments": ("payment_key", "date_key"),
    "fact_customer_behavior_snapshot": ("snapshot_key", "snapshot_date_key", "customer_key"),
}


def column_tests(df: DataFrame, required: Iterable[str], accepted: Mapping[str, Iterable[str]]) -> DataFrame:
    """All not-null and accepted-value tests of one table in a single scan; failing tests only."""
    counts = {f"not_null {c}": F.count_if(F.col(c).isNull()) for c in required}
    for c, values in accepted.items():
        counts[f"accepted_values {c}"] = F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*values))
    one = df.agg(*[v.alias(k) for k, v in counts.items()])
    return one.unpivot([], [F.col(f"`{k}`") for k in counts], "test", "n").where("n > 0")


Check = Callable[[], DataFrame]
Changes = Mapping[str, Change]

# Amount and key that are summarised for each part of a table.
SUMMARISED: dict[str, tuple[str | None, str | None]] = {
    "invoice_line": ("silver_line_total_amount", None),
    "payment": ("silver_payment_amount", None),
    "fact_retail_sales": ("sales_amount", "sales_line_key"),
    "fact_payments": ("payment_amount", "payment_key"),
    "fact_customer_behavior_snapshot": (None, "snapshot_key"),
} | {spec.name: (None, spec.key) for spec in SCD2_DIMENSIONS}


@dataclass(frozen=True)
class Rule:
    """A check over some tables: whole, and on what changed since it passed; ``says`` holds its parameters."""

    tables: tuple[str, ...]
    full: Callable[[Tables], DataFrame]
    delta: Callable[[Changes], DataFrame] | None = None
    says: str = ""
    totals: bool = False


def _added(change: Change) -> DataFrame:
    return change.current.limit(0) if change.added is None else change.added


def generic_rules() -> dict[str, Rule]:
    """Column tests per table, key uniqueness, references."""
    rules: dict[str, Rule] = {}
    required = {name: (*spec.keys, *SILVER_REQUIRED) for name, spec in SPECS.items()} | GOLD_KEYS
    keys = {name: list(spec.keys) for name, spec in SPECS.items()}
    keys |= {name: [columns[0]] for name, columns in GOLD_KEYS.items()}
    for name, columns in required.items():
        accepted = {c: v for (table, c), v in ACCEPTED.items() if table == name}
        rules[f"columns {name}"] = Rule(
            (name,), lambda t, n=name, c=columns, v=accepted: column_tests(t[n], c, v),
            lambda d, n=name, c=columns, v=accepted: column_tests(_added(d[n]), c, v), f"{columns} {accepted}")
        rules[f"unique {name}"] = Rule(
            (name,), lambda t, n=name: dq.unique(t[n], keys[n]), lambda d, n=name: unique_delta(d[n], keys[n]), f"{keys[name]}")
    for child, column, parent, key in REFERENCES:
        rules[f"relationship {child}.{column}"] = Rule(
            (child, parent), lambda t, r=(child, column, parent, key): dq.relationships(t[r[0]], r[1], t[r[2]], r[3]),
            lambda d, r=(child, column, parent, key): relationships_delta(d[r[0]], r[1], d[r[2]], r[3]), f"{parent}.{key}")
    return rules


def invariant_rules(today: str) -> dict[str, Rule]:
    """Reconciliation, Type 2 windows, refund sign, economic series."""
    sales, payments, econ = "fact_retail_sales", "fact_payments", "econ_indicator"
    rules: dict[str, Rule] = {
        "sales reconcile": Rule((sales, "invoice_line"), lambda t: dq.reconcile(
            t[sales], "sales_amount", t["invoice_line"], "silver_line_total_amount"), totals=True),
        "payments reconcile": Rule((payments, "payment"), lambda t: dq.reconcile(
            t[payments], "payment_amount", t["payment"], "silver_payment_amount"), totals=True),
        "refunds negative": Rule((payments,), lambda t: dq.refunds_not_negative(t[payments]),
                                 lambda d: dq.refunds_not_negative(_added(d[payments]))),
        "series fresh": Rule((econ,), lambda t: dq.stale_series(t[econ], today), says=today),
        "series without gaps": Rule((econ,), lambda t: dq.month_gaps(t[econ])),
        "series unique": Rule((econ,), lambda t: dq.unique(t[econ], ["silver_series_id", "silver_observation_date"])),
        "series positive": Rule((econ,), lambda t: dq.non_positive(t[econ])),
    }
    for label, series in (("price", PRICE_SERIES), ("paper", PAPER_SERIES)):
        def covered(d: Changes, series: str = series) -> DataFrame:
            # an index that starts later can uncover any month, so a changed series judges all of them
            rows = d[sales].current if d[econ].removed is not None else _added(d[sales])
            return dq.months_without_basis(rows, d[econ].current, series)

        rules[f"{label} index covers revenue"] = Rule(
            (sales, econ), lambda t, s=series: dq.months_without_basis(t[sales], t[econ], s), covered, series)
    per_dimension = {
        "no overlap": dq.scd2_overlaps,
        "one current": dq.scd2_one_current,
        "contiguous": dq.scd2_contiguous,
        "window gaps": dq.scd2_window_gaps,
    }
    for spec in SCD2_DIMENSIONS:
        for label, check in per_dimension.items():
            # an entity's versions share a bucket, and buckets are rewritten whole
            rules[f"{label} {spec.name}"] = Rule(
                (spec.name,), lambda t, n=spec.name, c=check: c(t[n], n), lambda d, n=spec.name, c=check: c(_added(d[n]), n))
    return rules


def suite_rules(today: str) -> dict[str, Rule]:
    return generic_rules() | invariant_rules(today)


def generic_checks(t: Tables) -> dict[str, Check]:
    return {name: partial(rule.full, t) for name, rule in generic_rules().items()}


def invariant_checks(t: Tables, today: str) -> dict[str, Check]:
    return {name: partial(rule.full, t) for name, rule in invariant_rules(today).items()}
