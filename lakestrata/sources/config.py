"""Which source tables are landed, how, and into which landing schema."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def identifier(name: str, kind: str = "name") -> str:
    """Names are spliced into plans as column and table references, so only plain ones pass."""
    if not _IDENTIFIER.fullmatch(name or ""):
        raise ValueError(f"unsafe {kind}: {name!r}")
    return name


@dataclass(frozen=True)
class TableConfig:
    name: str
    target: str
    strategy: str = "incremental"
    watermark: str | None = None
    keys: tuple[str, ...] = ()
    # a full load that brings less than this share of the rows of the last one fails; 0 accepts any number but none
    least_share: float = 0.5

    @property
    def source_system(self) -> str:
        return "ref" if self.target.startswith("ref_") else "oltp"

    @property
    def load_type(self) -> str:
        return "incremental_append" if self.strategy == "incremental" else "full_load"


def _full(name: str, target: str, key: str) -> TableConfig:
    return TableConfig(name, target, "full_load", None, (key,))


def _incremental(name: str, watermark: str = "updated_at") -> TableConfig:
    return TableConfig(name, f"oltp_{name}", "incremental", watermark)


# Source tables, landing targets, load strategies, watermark and key columns.
DEFAULT_TABLES = (
    _full("ref_state", "ref_state", "state_code"),
    _full("ref_invoice_status", "ref_invoice_status", "status_code"),
    _full("ref_payment_status", "ref_payment_status", "status_code"),
    _full("payment_method", "ref_payment_method", "payment_method_id"),
    _full("payment_type", "ref_payment_type", "payment_type_id"),
    _full("tax_rate", "ref_tax_rate", "tax_rate_id"),
    _full("store", "oltp_store", "store_id"),
    _full("department", "oltp_department", "department_id"),
    _full("product_category", "oltp_product_category", "category_id"),
    _full("employee", "oltp_employee", "employee_id"),
    _full("product", "oltp_product", "product_id"),
    _incremental("customer"),
    _incremental("customer_address"),
    _incremental("customer_status_history", "changed_at"),
    _incremental("invoice"),
    _incremental("invoice_line"),
    _incremental("invoice_status_history", "changed_at"),
    _incremental("payment"),
    _incremental("refund"),
    _incremental("invoice_adjustment"),
)
SERIES_TARGET = "econ_indicator"

# Hours after its newest row at which a source is late and overdue; (None, None) is exempt.
FRESHNESS_HOURS: dict[str, tuple[int | None, int | None]] = {SERIES_TARGET: (35 * 24, 45 * 24)}


def freshness_limits(target: str) -> tuple[int | None, int | None]:
    """Reference tables change rarely and are exempt; what isn't named otherwise is expected daily."""
    if target in FRESHNESS_HOURS:
        return FRESHNESS_HOURS[target]
    return (None, None) if target.startswith("ref_") else (24, 48)

# Source column -> landing column, for every table and per landing table.
COMMON_RENAMES = {
    "created_at": "created_at_source_timestamp",
    "changed_at": "changed_at_source_timestamp",
    "row_version": "source_row_version",
    "is_deleted": "is_deleted_source_flag",
    "deleted_at": "deleted_at_source_timestamp",
}
TABLE_RENAMES: dict[str, dict[str, str]] = {
    "oltp_customer_address": {"is_primary": "is_primary_flag"},
    "oltp_product": {
        "unit_cost": "unit_cost_amount",
        "standard_price": "standard_price_amount",
        "is_local_made": "is_local_made_flag",
        "is_active": "is_active_flag",
    },
    "oltp_product_category": {"is_active": "is_active_flag"},
    "oltp_department": {"is_active": "is_active_flag"},
    "oltp_employee": {"is_active": "is_active_flag"},
    "oltp_store": {"is_active": "is_active_flag"},
    "oltp_invoice": {
        "due_date": "invoice_due_date",
        "status_code": "invoice_status",
        "balance_due": "balance_due_amount",
    },
    "oltp_invoice_line": {
        "description": "line_description",
        "quantity": "order_qty",
        "unit_price": "unit_price_amount",
        "unit_cost": "unit_cost_amount",
        "extended_amount": "line_total_amount",
    },
    "oltp_payment": {"payment_sequence": "payment_sequence_num"},
    "ref_payment_method": {"is_card": "is_card_flag", "is_active": "is_active_flag"},
    "ref_payment_type": {"affects_balance": "affects_balance_flag"},
    "ref_tax_rate": {"is_active": "is_active_flag"},
    "ref_invoice_status": {"is_terminal": "is_terminal_flag"},
}

_CHANGED = "created_at_source_timestamp timestamp_ntz, updated_at_source_timestamp timestamp_ntz"
_DELETED = "is_deleted_source_flag boolean, deleted_at_source_timestamp timestamp_ntz"
_VERSIONED = f"{_CHANGED}, source_row_version int, {_DELETED}"
_PLAIN = f"{_CHANGED}, {_DELETED}"
_MONEY = "decimal(12,2)"

# Business columns of each landing table.
BUSINESS_COLUMNS: dict[str, str] = {
    "oltp_customer": "customer_id bigint, customer_account_no string, business_name string, first_name string, "
    "last_name string, full_name string, email string, phone string, customer_status string, "
    f"default_tax_rate_id bigint, home_store_id bigint, first_order_date date, {_VERSIONED}",
    "oltp_customer_address": "address_id bigint, customer_id bigint, address_type string, street_address string, "
    f"street_address2 string, city string, state_code string, zip_code string, is_primary_flag boolean, {_PLAIN}",
    "oltp_product": "product_id bigint, sku string, product_name string, description string, department_id bigint, "
    f"category_id bigint, brand string, unit_cost_amount {_MONEY}, markup_pct decimal(8,4), "
    f"standard_price_amount {_MONEY}, is_local_made_flag boolean, is_active_flag boolean, {_VERSIONED}",
    "oltp_product_category": "category_id bigint, department_id bigint, category_code string, category_name string, "
    f"description string, is_active_flag boolean, {_PLAIN}",
    "oltp_department": "department_id bigint, department_code string, department_name string, description string, "
    f"is_active_flag boolean, {_PLAIN}",
    "oltp_employee": "employee_id bigint, employee_code string, first_name string, last_name string, "
    "full_name string, email string, phone string, role string, store_id bigint, hire_date date, "
    f"is_active_flag boolean, {_VERSIONED}",
    "oltp_store": "store_id bigint, store_code string, store_name string, street_address string, city string, "
    "state_code string, zip_code string, phone string, region string, store_type string, open_date date, "
    f"is_active_flag boolean, {_VERSIONED}",
    "oltp_invoice": "invoice_id bigint, invoice_number string, customer_id bigint, store_id bigint, "
    "employee_id bigint, billing_address_id bigint, shipping_address_id bigint, po_number string, "
    "invoice_date date, invoice_due_date date, invoice_status string, tax_rate_id bigint, "
    f"subtotal_amount {_MONEY}, discount_amount {_MONEY}, tax_amount {_MONEY}, fee_amount {_MONEY}, "
    f"total_amount {_MONEY}, paid_amount {_MONEY}, balance_due_amount {_MONEY}, notes string, {_VERSIONED}",
    "oltp_invoice_line": "invoice_line_id bigint, invoice_id bigint, line_number smallint, product_id bigint, "
    f"variant_id bigint, line_description string, color string, order_qty int, unit_price_amount {_MONEY}, "
    f"unit_cost_amount {_MONEY}, discount_amount {_MONEY}, line_total_amount {_MONEY}, {_PLAIN}",
    "oltp_payment": "payment_id bigint, invoice_id bigint, customer_id bigint, payment_method_id bigint, "
    "payment_type_id bigint, employee_id bigint, store_id bigint, parent_payment_id bigint, "
    f"payment_sequence_num smallint, payment_status string, payment_date date, gross_amount {_MONEY}, "
    f"tax_amount {_MONEY}, fee_amount {_MONEY}, net_amount {_MONEY}, reference_no string, {_VERSIONED}",
    "oltp_invoice_status_history": "status_history_id bigint, invoice_id bigint, old_status string, "
    "new_status string, changed_at_source_timestamp timestamp_ntz, changed_by bigint, note string",
    "oltp_customer_status_history": "status_history_id bigint, customer_id bigint, old_status string, "
    "new_status string, changed_at_source_timestamp timestamp_ntz, changed_by bigint, reason string",
    "oltp_refund": f"refund_id bigint, payment_id bigint, invoice_id bigint, refund_amount {_MONEY}, "
    f"refund_date date, reason string, refunded_by bigint, {_PLAIN}",
    "oltp_invoice_adjustment": "adjustment_id bigint, invoice_id bigint, adjustment_type string, "
    f"amount {_MONEY}, reason string, adjusted_by bigint, adjustment_date date, {_PLAIN}",
    "ref_payment_method": "payment_method_id bigint, method_code string, method_name string, method_type string, "
    f"is_card_flag boolean, is_active_flag boolean, {_VERSIONED}",
    "ref_payment_type": "payment_type_id bigint, type_code string, type_name string, description string, "
    f"affects_balance_flag boolean, {_PLAIN}",
    "ref_tax_rate": "tax_rate_id bigint, tax_code string, description string, rate_pct decimal(6,4), "
    f"effective_from date, effective_to date, is_active_flag boolean, {_CHANGED}",
    "ref_state": f"state_code string, state_name string, {_CHANGED}",
    "ref_invoice_status": "status_code string, status_name string, is_terminal_flag boolean, "
    f"sort_order smallint, {_CHANGED}",
    "ref_payment_status": f"status_code string, status_name string, {_CHANGED}",
    "econ_indicator": "series_id string, observation_date date, indicator_value decimal(18,6), units string, "
    f"{_CHANGED}",
}

LANDING_METADATA = (
    "bronze_record_id bigint, bronze_batch_id bigint, bronze_loaded_at_timestamp timestamp_ntz, "
    "bronze_extracted_at_timestamp timestamp_ntz, bronze_source_system string, bronze_source_table_name string, "
    "bronze_source_file_name string, bronze_source_row_number bigint, bronze_row_hash string, "
    "bronze_is_deleted_flag boolean, bronze_raw_payload_jsonb string"
)


def landing_schema(target: str) -> T.StructType:
    """Fixed column list and types of a landing table."""
    if target not in BUSINESS_COLUMNS:
        raise ValueError(f"no landing table named {target!r}")
    return T.StructType.fromDDL(f"{BUSINESS_COLUMNS[target]}, {LANDING_METADATA}")


@dataclass(frozen=True)
class LandingConfig:
    source_name: str = "oltp"
    default_load_strategy: str = "incremental"
    default_watermark_column: str = "updated_at"
    target_schema: str = "bronze"
    tables: tuple[TableConfig, ...] = DEFAULT_TABLES
    extra: dict = field(default_factory=dict)

    def table(self, name: str) -> TableConfig:
        for t in self.tables:
            if t.name == name:
                return t
        raise ValueError(f"no landing table mapped for source table {name!r}")


def load_config(path: str | None = None, env: Mapping[str, str] | None = None) -> LandingConfig:
    """Defaults, overlaid by a JSON or YAML file, overlaid by ``INGESTION_*`` variables."""
    values: dict = {}
    if path:
        with open(path, encoding="utf-8") as fh:
            if path.endswith(".json"):
                values = json.load(fh)
            else:
                import yaml

                values = yaml.safe_load(fh) or {}
    for k, v in (os.environ if env is None else env).items():
        if k.startswith("INGESTION_"):
            values[k[len("INGESTION_"):].lower()] = v
    cfg = LandingConfig()
    default = values.get("default_load_strategy", cfg.default_load_strategy)
    if isinstance(values.get("tables"), list):
        rows = values.pop("tables")
        if any(not r.get("bronze_table") for r in rows):
            raise ValueError("every configured table needs a bronze_table")
        tables = tuple(
            TableConfig(r["name"], r["bronze_table"], r.get("load_strategy", default),
                        r.get("watermark_column"), tuple(r.get("key_columns") or ()), float(r.get("least_share", 0.5)))
            for r in rows
        )
        cfg = replace(cfg, tables=tables)
    known = {k: values.pop(k) for k in list(values)
             if k in ("source_name", "default_load_strategy", "default_watermark_column", "target_schema")}
    return replace(cfg, **known, extra=values)
