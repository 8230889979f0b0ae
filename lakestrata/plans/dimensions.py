"""Dimension staging: lookups, casts and the tracked-attribute hash of each dimension."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import ts
from ..functions.hashing import record_hash
from ..functions.text import blank_to_null, clip
from ..operators.incremental import Change
from ..operators.scd import DimensionSpec, scd1_apply
from ..session import WIDE, by_count, stage
from .silver import SPECS

Tables = Mapping[str, DataFrame]
_NP = "'Not Provided'"
MERGED_AT = "silver_updated_at_timestamp"
CALENDAR = "dim_date"

# Dimension keys, attributes and the attribute values of the -1 member.
CUSTOMER = DimensionSpec(
    "dim_customer", "customer_key",
    ("customer_id", "customer_name", "customer_street_address", "customer_city", "customer_county",
     "customer_state", "customer_city_state", "first_order_date_key"),
    (_NP, _NP, _NP, _NP, _NP, _NP, _NP, "-1"),
)
CASHIER = DimensionSpec(
    "dim_cashier", "cashier_key",
    ("cashier_id", "cashier_first_name", "cashier_last_name", "cashier_full_name", "is_active", "store_id",
     "store_name"),
    (_NP, _NP, _NP, _NP, "'No'", _NP, _NP),
)
INVOICE = DimensionSpec(
    "dim_invoice", "invoice_key",
    ("invoice_number", "po_number", "invoice_date", "invoice_status", "invoice_total", "customer_id",
     "customer_name", "store_id", "store_name"),
    (_NP, _NP, "NULL", _NP, "NULL", _NP, _NP, _NP, _NP),
)
PAYMENT_METHOD = DimensionSpec(
    "dim_payment_method", "payment_method_key",
    ("method_code", "method_name", "method_type", "is_active"),
    (_NP, _NP, _NP, "false"),
)
PRODUCT = DimensionSpec(
    "dim_product", "product_key",
    ("sku_number", "product_description", "brand_description", "category_description", "department_number",
     "department_description", "markup", "standard_price", "local_made_indicator"),
    (_NP, _NP, _NP, _NP, _NP, _NP, "NULL", "NULL", _NP),
)
STORE = DimensionSpec(
    "dim_store", "store_key",
    ("store_id", "store_name", "store_city", "store_state", "store_region", "store_type", "open_date"),
    (_NP, _NP, _NP, _NP, _NP, _NP, "NULL"),
)
SCD2_DIMENSIONS = (CUSTOMER, STORE, CASHIER, PRODUCT, INVOICE, PAYMENT_METHOD)


def _versioned(prefix: str, entity: str) -> list[Column]:
    """Columns every staged dimension row carries."""
    return [
        F.col(f"{prefix}.silver_{entity}_id").cast("string").alias("source_record_id"),
        F.col(f"{prefix}.silver_is_deleted_flag").alias("is_deleted"),
        clip(F.col(f"{prefix}.silver_source_system"), 50).alias("source_system"),
        F.col(f"{prefix}.silver_source_updated_at_timestamp").alias("src_updated_at"),
    ]


def _hash(*names: str) -> Column:
    return record_hash(names).alias("record_hash")


def stage_customer(t: Tables) -> DataFrame:
    """Customer with primary address, state name (or its code) and first-order date key."""
    c = t["customer"].alias("c")
    a = t["customer_address"].where("silver_is_primary_flag").alias("a")
    s = t["state"].alias("s")
    d = t["dim_date"].select("date", "date_key").alias("d")
    state = F.coalesce("s.silver_state_name", "a.silver_state_code")
    joined = (
        c.join(a, F.col("a.silver_customer_id") == F.col("c.silver_customer_id"), "left")
        .join(s, F.col("s.silver_state_code") == F.col("a.silver_state_code"), "left")
        .join(d, F.col("d.date") == F.col("c.silver_first_order_date"), "left")
        .withColumn("_state", state)
    )
    return joined.select(
        *_versioned("c", "customer"),
        clip(F.col("silver_customer_account_no"), 30).alias("customer_id"),
        clip(F.col("silver_customer_name"), 100).alias("customer_name"),
        clip(F.col("silver_street_address_line_1"), 200).alias("customer_street_address"),
        clip(F.col("silver_city"), 100).alias("customer_city"),
        F.lit("Not Provided").alias("customer_county"),
        clip(F.col("_state"), 50).alias("customer_state"),
        clip(F.nullif(F.concat_ws(", ", "silver_city", "_state"), F.lit("")), 150).alias("customer_city_state"),
        F.coalesce("date_key", F.lit(-1)).alias("first_order_date_key"),
        _hash("silver_customer_account_no", "silver_customer_name", "silver_street_address_line_1", "silver_city",
              "_state", "date_key", "c.silver_is_deleted_flag"),
    )


def stage_cashier(t: Tables) -> DataFrame:
    """Employee with its store's code and name."""
    e, s = t["employee"].alias("e"), t["store"].alias("s")
    joined = e.join(s, F.col("s.silver_store_id") == F.col("e.silver_store_id"), "left")
    return joined.select(
        *_versioned("e", "employee"),
        clip(F.col("silver_employee_code"), 30).alias("cashier_id"),
        clip(F.col("silver_first_name"), 50).alias("cashier_first_name"),
        clip(F.col("silver_last_name"), 50).alias("cashier_last_name"),
        clip(F.col("silver_full_name"), 100).alias("cashier_full_name"),
        F.when(F.col("e.silver_is_active_flag"), "Yes").otherwise("No").alias("is_active"),
        clip(F.col("silver_store_code"), 30).alias("store_id"),
        clip(F.col("silver_store_name"), 100).alias("store_name"),
        _hash("silver_employee_code", "silver_first_name", "silver_last_name", "silver_full_name",
              "e.silver_is_active_flag", "silver_store_code", "silver_store_name", "e.silver_is_deleted_flag"),
    )


def _merged_after(mark: str, ident: str, *aliases: str) -> Column:
    """Rows of a staging join that have a part merged after the mark; a row without an id matches none, so it counts."""
    newer = reduce(lambda a, b: a | b, [F.col(f"{a}.{MERGED_AT}") > ts(mark) for a in aliases])
    return F.coalesce(newer, F.lit(False)) | F.col(ident).isNull()


def invoice_parts(t: Tables, since: str | None = None) -> DataFrame:
    """Invoice headers with the customer and store columns that ``invoice_labels`` are taken from; the total is
    narrowed here, as a load whose totals don't fit has to fail.

    With ``since`` only invoices whose header or labels were merged after it: the others' rows are the
    last load's, as rows of these tables change or come, but do not go.
    """
    names = ["silver_customer_id", "silver_customer_account_no", "silver_customer_name"] + [MERGED_AT] * (since is not None)
    i, c, s = t["invoice"].alias("i"), by_count(t["customer"].select(*names), times=WIDE).alias("c"), t["store"].alias("s")
    joined = i.join(c, F.col("c.silver_customer_id") == F.col("i.silver_customer_id"), "left").join(
        s, F.col("s.silver_store_id") == F.col("i.silver_store_id"), "left"
    )
    if since is not None:
        joined = joined.where(_merged_after(since, "i.silver_invoice_id", "i", "c", "s"))
    return joined.select(
        *_versioned("i", "invoice"),
        "silver_invoice_number", "silver_po_number", "silver_invoice_date", "silver_invoice_status", "silver_total_amount",
        "silver_customer_account_no", "silver_customer_name", "silver_store_code", "silver_store_name",
        F.col("silver_total_amount").cast("decimal(12,2)").alias("invoice_total"),
    )


def invoice_labels() -> dict[str, Column]:
    """Attributes and hash of an invoice that follow from its parts."""
    return {
        "invoice_number": clip(F.col("silver_invoice_number"), 30),
        "po_number": clip(F.col("silver_po_number"), 50),
        "invoice_date": F.col("silver_invoice_date"),
        "invoice_status": F.col("silver_invoice_status"),
        "customer_id": clip(F.col("silver_customer_account_no"), 30),
        "customer_name": clip(F.col("silver_customer_name"), 100),
        "store_id": clip(F.col("silver_store_code"), 30),
        "store_name": clip(F.col("silver_store_name"), 100),
        "record_hash": record_hash([
            "silver_invoice_number", "silver_po_number", "silver_invoice_date", "silver_invoice_status",
            "silver_total_amount", "silver_customer_account_no", "silver_customer_name", "silver_store_code",
            "silver_store_name", "is_deleted"]),
    }


def stage_invoice(t: Tables, since: str | None = None) -> DataFrame:
    """Invoice header with customer and store labels, all or those with a part merged after ``since``."""
    return invoice_parts(t, since).select(
        "source_record_id", "is_deleted", "source_system", "src_updated_at", "invoice_total",
        *[column.alias(name) for name, column in invoice_labels().items()],
    )


def stage_payment_method(t: Tables) -> DataFrame:
    m = t["payment_method"].alias("m")
    return m.select(
        *_versioned("m", "payment_method"),
        F.col("silver_method_code").alias("method_code"),
        F.col("silver_method_name").alias("method_name"),
        F.col("silver_method_type").alias("method_type"),
        F.col("silver_is_active_flag").alias("is_active"),
        _hash("silver_method_code", "silver_method_name", "silver_method_type", "silver_is_active_flag",
              "silver_is_deleted_flag"),
    )


def stage_product(t: Tables) -> DataFrame:
    """Product with category and department labels."""
    p, c, d = t["product"].alias("p"), t["product_category"].alias("c"), t["department"].alias("d")
    joined = p.join(c, F.col("c.silver_category_id") == F.col("p.silver_category_id"), "left").join(
        d, F.col("d.silver_department_id") == F.col("p.silver_department_id"), "left"
    )
    return joined.select(
        *_versioned("p", "product"),
        clip(F.col("silver_product_sku"), 50).alias("sku_number"),
        clip(F.col("silver_product_description"), 200).alias("product_description"),
        clip(F.col("silver_brand_name"), 100).alias("brand_description"),
        clip(F.col("silver_category_description"), 100).alias("category_description"),
        clip(F.col("silver_department_code"), 20).alias("department_number"),
        clip(F.col("silver_department_description"), 100).alias("department_description"),
        F.col("silver_markup_pct").cast("decimal(8,4)").alias("markup"),
        F.col("silver_standard_price_amount").cast("decimal(12,2)").alias("standard_price"),
        F.when(F.col("silver_is_local_made_flag"), "Local").otherwise("Not Local").alias("local_made_indicator"),
        _hash("silver_product_sku", "silver_product_description", "silver_brand_name",
              "silver_category_description", "silver_department_code", "silver_department_description",
              "silver_markup_pct", "silver_standard_price_amount", "silver_is_local_made_flag",
              "p.silver_is_deleted_flag"),
    )


def stage_store(t: Tables) -> DataFrame:
    """Store with its state's name (or code)."""
    s, st = t["store"].alias("s"), t["state"].alias("st")
    joined = s.join(st, F.col("st.silver_state_code") == F.col("s.silver_state_code"), "left").withColumn(
        "_state", F.coalesce("st.silver_state_name", "s.silver_state_code")
    )
    return joined.select(
        *_versioned("s", "store"),
        clip(F.col("silver_store_code"), 30).alias("store_id"),
        clip(F.col("silver_store_name"), 100).alias("store_name"),
        clip(F.col("silver_city"), 100).alias("store_city"),
        clip(F.col("_state"), 50).alias("store_state"),
        clip(F.col("silver_region"), 50).alias("store_region"),
        clip(F.col("silver_store_type"), 50).alias("store_type"),
        F.col("silver_open_date").alias("open_date"),
        _hash("silver_store_code", "silver_store_name", "silver_city", "_state", "silver_region",
              "silver_store_type", "silver_open_date", "s.silver_is_deleted_flag"),
    )


STAGES: dict[str, Callable[[Tables], DataFrame]] = {
    "dim_customer": stage_customer,
    "dim_store": stage_store,
    "dim_cashier": stage_cashier,
    "dim_product": stage_product,
    "dim_invoice": stage_invoice,
    "dim_payment_method": stage_payment_method,
}


@dataclass(frozen=True)
class Link:
    """Rows of ``child`` depend on the rows of ``parent`` whose ``key`` equals their ``column``."""

    child: str
    column: str
    parent: str
    key: str


# Table and id that a dimension has a row for, and the joins of its staging.
BASES: dict[str, tuple[str, str]] = {
    "dim_customer": ("customer", "silver_customer_id"),
    "dim_store": ("store", "silver_store_id"),
    "dim_cashier": ("employee", "silver_employee_id"),
    "dim_product": ("product", "silver_product_id"),
    "dim_invoice": ("invoice", "silver_invoice_id"),
    "dim_payment_method": ("payment_method", "silver_payment_method_id"),
}
LINKS: dict[str, tuple[Link, ...]] = {
    "dim_customer": (Link("customer", "silver_customer_id", "customer_address", "silver_customer_id"),
                     Link("customer_address", "silver_state_code", "state", "silver_state_code"),
                     Link("customer", "silver_first_order_date", CALENDAR, "date")),
    "dim_store": (Link("store", "silver_state_code", "state", "silver_state_code"),),
    "dim_cashier": (Link("employee", "silver_store_id", "store", "silver_store_id"),),
    "dim_product": (Link("product", "silver_category_id", "product_category", "silver_category_id"),
                    Link("product", "silver_department_id", "department", "silver_department_id")),
    "dim_invoice": (Link("invoice", "silver_customer_id", "customer", "silver_customer_id"),
                    Link("invoice", "silver_store_id", "store", "silver_store_id")),
    "dim_payment_method": (),
}


def source_tables(name: str) -> list[str]:
    """The tables a dimension is staged from."""
    return [BASES[name][0], *(link.parent for link in LINKS[name])]


def touched(name: str, t: Tables, mark: str, before: Callable[[str], Change | None]) -> DataFrame | None:
    """Ids of the entities whose staged row can differ from the last load's; None if that can't be told.

    The delta rule of a join: rows that were merged after the mark, by a filter on each table's own
    scan, and rows that refer to such rows of another table, by semi-joins with the few keys found
    there. A row that isn't found by its table's key but by another column, as an address by its
    customer, counts for the value it had as well; ``before`` tells the parts that went.
    """
    def rows(table: str) -> list[DataFrame]:
        found = [t[table].where(F.col(MERGED_AT) > ts(mark))]
        for link in (k for k in LINKS[name] if k.child == table):
            keys = values(link.parent, link.key)
            if keys is None:
                return []
            if not keys.isEmpty():
                found.append(t[table].join(keys.select(F.col(link.key).alias(link.column)), link.column, "left_semi")
                             .select(t[table].columns))
        return found

    def values(table: str, key: str) -> DataFrame | None:
        """The values of ``key`` in touched rows, staged so that Spark knows how few they are."""
        if table == CALENDAR:
            return dates(before(table))
        found = [df.select(key) for df in rows(table)]
        own = SPECS[table].keys[0]
        change = before(table) if key != own else None
        if not found or key != own and change is None:
            return None
        if change is not None and change.removed is not None:
            gone = change.removed.select(own, key)
            if change.added is not None:
                gone = gone.exceptAll(change.added.select(own, key))
            found.append(gone.select(key))
        return stage(reduce(DataFrame.union, found).where(F.col(key).isNotNull()).distinct(), f"touched-{name}-{table}")

    def dates(change: Change | None) -> DataFrame | None:
        """Days whose key came, went or changed; the calendar is rebuilt whole and has no merge times."""
        if change is None:
            return None
        sides = [None if df is None else df.select("date", "date_key") for df in (change.added, change.removed)]
        pairs = [a if b is None else a.exceptAll(b) for a, b in (sides, sides[::-1]) if a is not None]
        if not pairs:
            return t[CALENDAR].limit(0).select("date")
        return stage(reduce(DataFrame.union, pairs).select("date").distinct(), f"touched-{name}-{CALENDAR}")

    return values(*BASES[name])


def cut(name: str, t: Tables, ids: DataFrame) -> dict[str, DataFrame]:
    """The tables of a dimension's staging, each cut to the rows that belong to the given entities."""
    base, key = BASES[name]
    out = dict(t) | {base: stage(t[base].join(ids, key, "left_semi").select(t[base].columns), f"cut-{base}")}
    for link in LINKS[name]:
        asked = out[link.child].select(F.col(link.column).alias(link.key))
        rows = t[link.parent].join(asked, link.key, "left_semi").select(t[link.parent].columns)
        out[link.parent] = stage(rows, f"cut-{link.parent}")
    return out


def stage_payment_type(t: Tables) -> DataFrame:
    return t["payment_type"].select(
        F.col("silver_type_code").alias("type_code"),
        clip(blank_to_null(F.col("silver_type_name")), 50).alias("type_name"),
        clip(blank_to_null(F.col("silver_type_description")), 200).alias("description"),
        F.col("silver_is_deleted_flag").alias("is_deleted"),
    )


def payment_type_rows(staged: DataFrame, target: DataFrame | None, run_ts: str) -> DataFrame:
    """Type 1 rows to upsert into dim_payment_type, the -1 member included."""
    unknown = {
        "payment_type_key": F.lit(-1),
        "type_code": F.lit("Not Provided"),
        "type_name": F.lit("Not Provided"),
        "description": F.lit("Not Provided"),
        "is_deleted": F.lit(False),
    }
    rows = scd1_apply(staged, target, "type_code", "payment_type_key", run_ts, unknown)
    return rows.select("payment_type_key", "type_code", "type_name", "description", "etl_load_timestamp",
                       "etl_updated_timestamp", "is_deleted")
