"""Operational source tables derived from the given Parquet tables.

One SQL text per table serves both engines, so the Spark queries and the checking SQL
start from the same rows; everything after that is written separately. ``wave`` 1 is
the initial state, wave 2 the rows that changed later.
"""

from __future__ import annotations

from dataclasses import dataclass

RUN_1 = "2002-01-01 08:00:00"
RUN_2 = "2002-01-02 08:00:00"
CHANGE_TS = "1998-06-15 00:00:00"
LATE_TS = "2001-12-20 00:00:00"


@dataclass(frozen=True)
class Dialect:
    ts: str
    spark: bool

    def explode(self, *values: int) -> str:
        inner = ", ".join(map(str, values))
        return f"explode(array({inner}))" if self.spark else f"unnest([{inner}])"

    def hex_id(self, text: str) -> str:
        head = f"substr(md5({text}), 1, 15)"
        return f"CAST(conv({head}, 16, 10) AS BIGINT)" if self.spark else f"CAST('0x' || {head} AS BIGINT)"

    def month(self, d: str) -> str:
        return f"CAST(trunc({d}, 'MM') AS DATE)" if self.spark else f"CAST(date_trunc('month', {d}) AS DATE)"


SPARK = Dialect("timestamp_ntz", True)
DUCK = Dialect("timestamp", False)


def _stamps(d: Dialect, updated: str, created: str | None = None) -> str:
    return (
        f"CAST({created or updated} AS {d.ts}) AS created_at, CAST({updated} AS {d.ts}) AS updated_at, "
        f"CAST(false AS BOOLEAN) AS is_deleted, CAST(NULL AS {d.ts}) AS deleted_at"
    )


def _on(wave: int, condition: str) -> str:
    """True for rows that changed, in the wave that changes them."""
    return f"({'true' if wave == 2 else 'false'} AND {condition})"


def _only(wave: int, condition: str) -> str:
    return condition if wave == 2 else "true"


LINE_ID = ("concat_ws('/', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING), "
           "CAST(l_suppkey AS STRING), CAST(CAST(l_shipdate AS DATE) AS STRING))")


def customer(d: Dialect, wave: int = 1) -> str:
    hit = "c_custkey % 7 = 0"
    updated = (f"CASE WHEN {_on(wave, hit)} THEN CAST('{CHANGE_TS}' AS {d.ts}) "
               f"ELSE CAST(DATE '1995-01-01' + CAST(c_custkey % 365 AS INT) AS {d.ts}) END")
    return f"""
    SELECT c_custkey AS customer_id, '  A' || CAST(c_custkey AS STRING) || ' ' AS customer_account_no,
      CASE c_custkey % 3 WHEN 0 THEN '  ' || c_name || '   Print  LLC ' WHEN 1 THEN '   ' END AS business_name,
      '  ' || upper(c_mktsegment) || ' ' AS first_name,
      'o''' || lower(replace(c_name, '#', '-')) || CASE WHEN {_on(wave, hit)} THEN '  jr' ELSE '' END AS last_name,
      CAST(NULL AS STRING) AS full_name,
      CASE c_custkey % 10 WHEN 3 THEN '  ' WHEN 4 THEN 'No-At-Sign' ELSE ' User' || CAST(c_custkey AS STRING) || '@Example.COM' END AS email,
      CASE WHEN c_custkey % 9 = 5 THEN NULL
           ELSE '(480) ' || CAST(100 + c_custkey % 900 AS STRING) || '-' || CAST(1000 + c_custkey % 9000 AS STRING) END AS phone,
      CASE WHEN c_custkey % 50 = 7 THEN 'dormant' WHEN c_acctbal < 1000 THEN ' Inactive ' ELSE 'ACTIVE' END AS customer_status,
      CAST(c_nationkey % 5 AS BIGINT) AS default_tax_rate_id, CAST(c_nationkey AS BIGINT) AS home_store_id,
      DATE '1995-01-01' + CAST(c_custkey % 3000 AS INT) AS first_order_date,
      CAST(1 AS INT) AS row_version, {_stamps(d, updated)}
    FROM customer WHERE {_only(wave, hit)}"""


def customer_address(d: Dialect, wave: int = 1) -> str:
    return f"""
    SELECT c_custkey * 10 + seq AS address_id, c_custkey AS customer_id,
      CASE seq WHEN 1 THEN ' Billing' ELSE CASE WHEN c_custkey % 20 = 0 THEN 'home' ELSE 'SHIPPING ' END END AS address_type,
      ' ' || CAST(c_custkey AS STRING) || '   Main   St ' AS street_address, CAST('' AS STRING) AS street_address2,
      CASE WHEN c_custkey % 40 = 9 THEN NULL ELSE 'City  ' || CAST(c_nationkey AS STRING) END AS city,
      CASE WHEN c_custkey % 30 = 11 THEN 'zz' ELSE ' n' || lower(chr(CAST(65 + c_nationkey AS INT))) END AS state_code,
      CAST(85000 + c_custkey % 999 AS STRING) AS zip_code, seq = 1 AS is_primary,
      {_stamps(d, "DATE '1995-01-01' + CAST(c_custkey % 365 AS INT)")}
    FROM (SELECT c_custkey, c_nationkey, {d.explode(1, 2)} AS seq FROM customer) x"""


def customer_status_history(d: Dialect, wave: int = 1) -> str:
    return f"""
    SELECT c_custkey * 10 + seq AS status_history_id, c_custkey AS customer_id,
      CASE seq WHEN 1 THEN CAST(NULL AS STRING) ELSE 'Active' END AS old_status,
      CASE seq WHEN 1 THEN ' ACTIVE' ELSE CASE WHEN c_acctbal < 0 THEN 'inactive' ELSE 'paused' END END AS new_status,
      CAST(DATE '1995-01-01' + CAST(c_custkey % 365 + 30 * seq AS INT) AS {d.ts}) AS changed_at,
      CAST(c_custkey % 100 AS BIGINT) AS changed_by, '  no   orders ' AS reason
    FROM (SELECT c_custkey, c_acctbal, {d.explode(1, 2)} AS seq FROM customer) x"""


def ref_state(d: Dialect, wave: int = 1) -> str:
    return f"""
    SELECT ' n' || lower(chr(CAST(65 + n_nationkey AS INT))) AS state_code, ' ' || n_name || ' ' AS state_name,
      CAST('1995-01-01' AS {d.ts}) AS created_at, CAST('1995-01-01' AS {d.ts}) AS updated_at
    FROM nation"""


def store(d: Dialect, wave: int = 1) -> str:
    return f"""
    SELECT CAST(n_nationkey AS BIGINT) AS store_id, ' S' || CAST(n_nationkey AS STRING) AS store_code,
      '  Store   ' || n_name AS store_name, CAST(n_nationkey AS STRING) || '  High   St' AS street_address,
      ' City ' || CAST(n_nationkey AS STRING) AS city, 'N' || chr(CAST(65 + n_nationkey AS INT)) AS state_code,
      ' 85001' AS zip_code, '480.555.' || CAST(1000 + n_nationkey AS STRING) AS phone, r_name AS region,
      CASE WHEN n_nationkey % 2 = 0 THEN 'retail ' ELSE '' END AS store_type,
      DATE '1990-01-01' + CAST(n_nationkey AS INT) AS open_date, true AS is_active, CAST(1 AS INT) AS row_version,
      {_stamps(d, "DATE '1995-01-01'")}
    FROM nation JOIN region ON n_regionkey = r_regionkey"""


def employee(d: Dialect, wave: int = 1) -> str:
    return f"""
    SELECT s_suppkey AS employee_id, ' E' || CAST(s_suppkey AS STRING) AS employee_code,
      ' mary-' || lower(substr(s_name, 1, 4)) AS first_name, ' mc  ' || upper(replace(s_name, '#', ' ')) AS last_name,
      CAST(NULL AS STRING) AS full_name, ' Emp' || CAST(s_suppkey AS STRING) || '@Shop.COM ' AS email,
      '602-' || CAST(5550000 + s_suppkey AS STRING) AS phone, ' cashier' AS role, CAST(s_nationkey AS BIGINT) AS store_id,
      DATE '1994-01-01' + CAST(s_suppkey % 300 AS INT) AS hire_date,
      CASE WHEN s_suppkey % 17 = 0 THEN NULL ELSE s_acctbal > 500 END AS is_active, CAST(1 AS INT) AS row_version,
      {_stamps(d, "DATE '1995-01-01'")}
    FROM supplier"""


def department(d: Dialect, wave: int = 1) -> str:
    return f"""
    SELECT department_id, 'D' || CAST(department_id AS STRING) || ' ' AS department_code,
      '  Department   ' || CAST(department_id AS STRING) AS department_name,
      'Dept  number ' || CAST(department_id AS STRING) AS description, true AS is_active,
      {_stamps(d, "DATE '1995-01-01'")}
    FROM (SELECT DISTINCT CAST(p_size % 5 + 1 AS BIGINT) AS department_id FROM part) x"""


def product_category(d: Dialect, wave: int = 1) -> str:
    return f"""
    SELECT category_id, category_id % 5 + 1 AS department_id, ' C-' || CAST(category_id AS STRING) AS category_code,
      'Category   ' || CAST(category_id AS STRING) AS category_name,
      ' size   ' || CAST(category_id AS STRING) || '  goods' AS description, category_id % 9 <> 0 AS is_active,
      {_stamps(d, "DATE '1995-01-01'")}
    FROM (SELECT DISTINCT CAST(p_size AS BIGINT) AS category_id FROM part) x"""


def product(d: Dialect, wave: int = 1) -> str:
    hit = _on(wave, "p_partkey % 7 = 0")
    return f"""
    SELECT p_partkey AS product_id, ' ' || p_brand || '-' || CAST(p_partkey AS STRING) AS sku, ' ' || p_name || '  ' AS product_name,
      CASE WHEN p_partkey % 8 = 3 THEN '  ' ELSE ' ' || p_type || '  item ' END AS description,
      CAST(p_size % 5 + 1 AS BIGINT) AS department_id, CAST(p_size AS BIGINT) AS category_id,
      CASE WHEN {hit} THEN 'Brand#99 ' ELSE p_brand END AS brand,
      CAST(p_retailprice * 0.5 AS DECIMAL(12,2)) AS unit_cost, CAST(p_size AS DECIMAL(8,4)) AS markup_pct,
      CAST(p_retailprice AS DECIMAL(12,2)) AS standard_price,
      CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size % 2 = 0 END AS is_local_made, true AS is_active,
      CAST(1 AS INT) AS row_version,
      {_stamps(d, f"CASE WHEN {hit} THEN CAST('{CHANGE_TS}' AS {d.ts}) ELSE CAST('1995-01-01' AS {d.ts}) END")}
    FROM part"""


def tax_rate(d: Dialect, wave: int = 1) -> str:
    return f"""
    SELECT CAST(r_regionkey AS BIGINT) AS tax_rate_id, ' T' || CAST(r_regionkey AS STRING) AS tax_code,
      r_name || '   sales  tax' AS description, CAST(0.05 + 0.01 * r_regionkey AS DECIMAL(6,4)) AS rate_pct,
      DATE '1995-01-01' AS effective_from, CASE WHEN r_regionkey = 1 THEN DATE '1999-12-31' END AS effective_to,
      true AS is_active, CAST('1995-01-01' AS {d.ts}) AS created_at, CAST('1995-01-01' AS {d.ts}) AS updated_at
    FROM region"""


def ref_invoice_status(d: Dialect, wave: int = 1) -> str:
    return f"""
    SELECT CASE o_orderstatus WHEN 'F' THEN ' PAID' WHEN 'O' THEN 'Open ' ELSE 'partial' END AS status_code,
      'Status   ' || o_orderstatus AS status_name, o_orderstatus = 'F' AS is_terminal,
      CAST(CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 ELSE 3 END AS SMALLINT) AS sort_order,
      CAST('1995-01-01' AS {d.ts}) AS created_at, CAST('1995-01-01' AS {d.ts}) AS updated_at
    FROM (SELECT DISTINCT o_orderstatus FROM orders) x"""


def ref_payment_status(d: Dialect, wave: int = 1) -> str:
    return f"""
    SELECT CASE o_orderstatus WHEN 'F' THEN ' CLEARED' WHEN 'O' THEN 'Pending ' ELSE 'refunded' END AS status_code,
      'Payment   status ' || o_orderstatus AS status_name,
      CAST('1995-01-01' AS {d.ts}) AS created_at, CAST('1995-01-01' AS {d.ts}) AS updated_at
    FROM (SELECT DISTINCT o_orderstatus FROM orders) x"""


def payment_method(d: Dialect, wave: int = 1) -> str:
    return f"""
    SELECT CAST(left(o_orderpriority, 1) AS BIGINT) AS payment_method_id, ' M' || left(o_orderpriority, 1) AS method_code,
      '  By   ' || substr(o_orderpriority, 3) AS method_name, CASE WHEN o_orderpriority < '3' THEN 'card' ELSE ' cash ' END AS method_type,
      o_orderpriority < '3' AS is_card, true AS is_active, CAST(1 AS INT) AS row_version,
      {_stamps(d, "DATE '1995-01-01'")}
    FROM (SELECT DISTINCT o_orderpriority FROM orders) x"""


def payment_type(d: Dialect, wave: int = 1) -> str:
    return f"""
    SELECT payment_type_id,
      CASE payment_type_id WHEN 1 THEN 'DEPOSIT ' WHEN 2 THEN 'BALANCE' WHEN 3 THEN ' FULL' ELSE 'REFUND' END AS type_code,
      ' Type   ' || CAST(payment_type_id AS STRING) AS type_name, CASE WHEN payment_type_id = 4 THEN ' ' ELSE 'a  payment' END AS description,
      payment_type_id < 4 AS affects_balance, {_stamps(d, "DATE '1995-01-01'")}
    FROM (SELECT DISTINCT payment_type_id FROM ({payment(d)}) p) x"""


def invoice(d: Dialect, wave: int = 1) -> str:
    hit = "o_orderkey % 13 = 0"
    paid = (f"CASE WHEN {_on(wave, hit)} OR o_orderstatus = 'F' THEN total WHEN o_orderkey % 101 = 0 THEN CAST(0 AS DECIMAL(12,2)) "
            "WHEN o_orderstatus = 'P' THEN CAST(round(total * CAST(0.40 AS DECIMAL(4,2)), 2) AS DECIMAL(12,2)) "
            "ELSE CAST(0 AS DECIMAL(12,2)) END")
    return f"""
    SELECT invoice_id, ' INV-' || CAST(invoice_id AS STRING) AS invoice_number, customer_id, store_id, employee_id,
      customer_id * 10 + 1 AS billing_address_id, customer_id * 10 + 2 AS shipping_address_id,
      CASE WHEN invoice_id % 4 = 0 THEN ' PO-' || CAST(invoice_id % 1000 AS STRING) WHEN invoice_id % 4 = 1 THEN 'Not Provided' END AS po_number,
      invoice_date, invoice_date + 30 AS due_date,
      CASE WHEN {_on(wave, "invoice_id % 13 = 0")} THEN 'PAID' WHEN invoice_id % 101 = 0 THEN ' Void' WHEN invoice_id % 97 = 0 THEN 'lost'
           WHEN o_orderstatus = 'F' THEN 'Paid ' WHEN o_orderstatus = 'O' THEN 'OPEN' ELSE 'partial' END AS status_code,
      CAST(customer_id % 5 AS BIGINT) AS tax_rate_id, total AS subtotal_amount,
      CAST(0 AS DECIMAL(12,2)) AS discount_amount, CAST(0 AS DECIMAL(12,2)) AS tax_amount,
      CAST(CASE WHEN invoice_id % 211 = 0 THEN 1 ELSE 0 END AS DECIMAL(12,2)) AS fee_amount,
      total AS total_amount, paid AS paid_amount,
      CAST(CASE WHEN invoice_id % 101 = 0 AND o_orderstatus <> 'F' THEN CAST(0 AS DECIMAL(12,2)) ELSE total - paid END AS DECIMAL(12,2)) AS balance_due,
      ' priority   ' || o_orderpriority || ' ' AS notes, CAST(1 AS INT) AS row_version,
      {_stamps(d, f"CASE WHEN {_on(wave, 'invoice_id % 13 = 0')} THEN CAST('{LATE_TS}' AS {d.ts}) ELSE CAST(invoice_date AS {d.ts}) END", "invoice_date")}
    FROM (SELECT o_orderkey AS invoice_id, o_custkey AS customer_id, CAST(o_custkey % 25 AS BIGINT) AS store_id,
            CAST(o_orderkey % 97 AS BIGINT) AS employee_id, CAST(o_orderdate AS DATE) AS invoice_date, o_orderstatus, o_orderpriority,
            total, {paid} AS paid
          FROM (SELECT *, CAST(o_totalprice AS DECIMAL(12,2)) AS total FROM orders) o WHERE {_only(wave, hit)}) x"""


def invoice_line(d: Dialect, wave: int = 1) -> str:
    hit = "(l_orderkey % 13 = 1 AND l_linenumber = 1)"
    return f"""
    SELECT {d.hex_id(LINE_ID)} AS invoice_line_id, l_orderkey AS invoice_id, CAST(l_linenumber AS SMALLINT) AS line_number,
      l_partkey AS product_id, CAST(NULL AS BIGINT) AS variant_id, ' line   ' || CAST(l_linenumber AS STRING) AS description,
      CASE l_returnflag WHEN 'N' THEN ' red ' WHEN 'A' THEN '' END AS color, CAST(l_quantity AS INT) AS quantity,
      CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
      CAST(p_retailprice * 0.5 AS DECIMAL(12,2)) AS unit_cost, discount AS discount_amount,
      CAST(price - discount - CASE WHEN {_on(wave, hit)} THEN CAST(1 AS DECIMAL(12,2)) ELSE CAST(0 AS DECIMAL(12,2)) END AS DECIMAL(12,2)) AS extended_amount,
      {_stamps(d, f"CASE WHEN {_on(wave, hit)} THEN CAST('{LATE_TS}' AS {d.ts}) ELSE CAST(CAST(l_shipdate AS DATE) AS {d.ts}) END")}
    FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
            CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(12,2)) AS discount
          FROM lineitem WHERE {_only(wave, hit)}) l JOIN part ON p_partkey = l_partkey"""


def payment(d: Dialect, wave: int = 1) -> str:
    hit = "o_orderkey % 13 = 2"
    half = "CAST(round(first_amount * CAST(0.50 AS DECIMAL(4,2)), 2) AS DECIMAL(12,2))"
    extra = f"CASE WHEN {_on(wave, hit)} AND seq <> 9 THEN CAST(1 AS DECIMAL(12,2)) ELSE CAST(0 AS DECIMAL(12,2)) END"
    gross = (f"CAST(CASE seq WHEN 1 THEN first_amount WHEN 2 THEN total - first_amount ELSE -{half} END + {extra} AS DECIMAL(12,2))")
    fee = "CAST(round(gross * CAST(0.02 AS DECIMAL(4,2)), 2) AS DECIMAL(12,2))"
    return f"""
    SELECT o_orderkey * 10 + seq AS payment_id, o_orderkey AS invoice_id, o_custkey AS customer_id,
      CAST(left(o_orderpriority, 1) AS BIGINT) AS payment_method_id,
      CAST(CASE seq WHEN 2 THEN 2 WHEN 9 THEN 4 ELSE CASE WHEN o_orderkey % 3 = 0 THEN 3 ELSE 1 END END AS BIGINT) AS payment_type_id,
      CAST(o_orderkey % 97 AS BIGINT) AS employee_id, CAST(o_custkey % 25 AS BIGINT) AS store_id,
      CASE WHEN seq = 9 THEN o_orderkey * 10 + 1 END AS parent_payment_id, CAST(seq AS SMALLINT) AS payment_sequence,
      CASE seq WHEN 9 THEN 'REFUNDED' ELSE CASE WHEN o_orderkey % 89 = 0 THEN 'bounced' ELSE ' Cleared' END END AS payment_status,
      pay_date AS payment_date, gross AS gross_amount, CAST(0 AS DECIMAL(12,2)) AS tax_amount, {fee} AS fee_amount,
      CAST(gross - {fee} AS DECIMAL(12,2)) AS net_amount, ' REF-' || CAST(o_orderkey AS STRING) AS reference_no, CAST(1 AS INT) AS row_version,
      {_stamps(d, f"CASE WHEN {_on(wave, hit)} THEN CAST('{LATE_TS}' AS {d.ts}) ELSE CAST(pay_date AS {d.ts}) END", "pay_date")}
    FROM (SELECT *, {gross} AS gross,
            CAST(o_orderdate AS DATE) + CASE seq WHEN 1 THEN 0 WHEN 2 THEN 30 ELSE 45 END AS pay_date
          FROM (SELECT *, CAST(CASE WHEN o_orderkey % 3 = 0 THEN total ELSE round(total * CAST(0.40 AS DECIMAL(4,2)), 2) END AS DECIMAL(12,2)) AS first_amount,
                  {d.explode(1, 2, 9)} AS seq
                FROM (SELECT *, CAST(o_totalprice AS DECIMAL(12,2)) AS total FROM orders) o) s
          WHERE {_only(wave, hit)} AND (seq = 1 OR (seq = 2 AND o_orderkey % 3 <> 0) OR (seq = 9 AND o_orderkey % 11 = 0))) x"""


def refund(d: Dialect, wave: int = 1) -> str:
    return f"""
    SELECT payment_id AS refund_id, parent_payment_id AS payment_id, invoice_id, -gross_amount AS refund_amount,
      payment_date AS refund_date, '  returned   goods ' AS reason, employee_id AS refunded_by,
      created_at, updated_at, is_deleted, deleted_at
    FROM ({payment(d)}) p WHERE parent_payment_id IS NOT NULL"""


def invoice_adjustment(d: Dialect, wave: int = 1) -> str:
    return f"""
    SELECT {d.hex_id(LINE_ID)} AS adjustment_id, l_orderkey AS invoice_id, ' Credit ' AS adjustment_type,
      CAST(-l_tax AS DECIMAL(12,2)) AS amount,
      CASE WHEN l_returnflag = 'R' THEN ' goods   returned' WHEN l_linenumber > 5 THEN 'price  match ' ELSE ' ' END AS reason,
      CAST(l_suppkey AS BIGINT) AS adjusted_by, CAST(l_shipdate AS DATE) AS adjustment_date,
      {_stamps(d, "CAST(l_shipdate AS DATE)")}
    FROM lineitem WHERE l_returnflag <> 'N'"""


def invoice_status_history(d: Dialect, wave: int = 1) -> str:
    return f"""
    SELECT o_orderkey * 10 + seq AS status_history_id, o_orderkey AS invoice_id,
      CASE seq WHEN 1 THEN CAST(NULL AS STRING) WHEN 2 THEN 'Open' ELSE 'PARTIAL ' END AS old_status,
      CASE seq WHEN 1 THEN 'OPEN' WHEN 2 THEN ' partial' ELSE 'Paid' END AS new_status,
      CAST(CAST(o_orderdate AS DATE) + CASE seq WHEN 1 THEN 0 WHEN 2 THEN 10 ELSE 40 END AS {d.ts}) AS changed_at,
      CAST(o_orderkey % 97 AS BIGINT) AS changed_by, ' step   ' || CAST(seq AS STRING) AS note
    FROM (SELECT *, {d.explode(1, 2, 3)} AS seq FROM orders) x
    WHERE seq = 1 OR (seq = 2 AND o_orderstatus <> 'O') OR (seq = 3 AND o_orderstatus = 'F')"""


def econ(d: Dialect, wave: int = 1) -> str:
    """Two monthly series measured on the orders; some months are missing a value."""
    return f"""
    SELECT CASE seq WHEN 1 THEN 'CPIAUCSL' ELSE 'WPU0911' END AS series_id, m AS observation_date,
      CASE WHEN (seq = 1 AND (year(m) * 12 + month(m)) % 17 = 0) OR (seq = 2 AND (year(m) * 12 + month(m)) % 11 = 0) THEN NULL
           ELSE CAST(CASE seq WHEN 1 THEN 150 + n % 97 ELSE 200 + n % 13 END AS DECIMAL(18,6)) END AS indicator_value,
      CASE seq WHEN 1 THEN 'index_1982_84' ELSE 'index' END AS units,
      CAST(m AS {d.ts}) AS created_at, CAST(m AS {d.ts}) AS updated_at
    FROM (SELECT m, n, {d.explode(1, 2)} AS seq
          FROM (SELECT {d.month('o_orderdate')} AS m, count(*) AS n FROM orders GROUP BY {d.month('o_orderdate')}) a) x"""


def ledger(d: Dialect, wave: int = 1) -> str:
    """One load batch per event."""
    target = "CASE user_id % 4 WHEN 0 THEN 'gold.dimensions' WHEN 1 THEN 'gold.fact_payments' WHEN 2 THEN 'oltp_invoice' ELSE 'ref_state' END"
    return f"""
    SELECT event_id AS batch_key, {target} || ':' || CAST(event_id AS STRING) AS batch_id,
      CASE WHEN user_id % 4 < 2 THEN 'silver' ELSE 'oltp' END AS source_system, {target} AS target_table,
      CASE WHEN user_id % 4 = 3 THEN 'full_load' ELSE 'incremental_append' END AS load_type, 'updated_at' AS watermark_column,
      CAST(NULL AS STRING) AS watermark_value_start,
      CASE WHEN event_id % 5 <> 0 THEN CAST(CAST(ts AS DATE) AS STRING) || ' 00:00:00' END AS watermark_value_end,
      CASE event_type WHEN 'error' THEN 'failed' WHEN 'click' THEN 'running' ELSE 'succeeded' END AS batch_status,
      ts AS batch_start_timestamp, CASE WHEN event_type <> 'click' THEN ts END AS batch_end_timestamp,
      CAST(floor(value) AS BIGINT) AS rows_extracted, CAST(floor(value) AS BIGINT) - CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END AS rows_inserted,
      CAST(0 AS BIGINT) AS rows_updated, CAST(0 AS BIGINT) AS rows_deleted, CAST(0 AS BIGINT) AS rows_rejected,
      CASE WHEN event_type = 'error' THEN 'boom' END AS error_message, CAST(0 AS INT) AS retry_count,
      CASE WHEN event_id % 2 = 0 THEN 'warehouse_run' ELSE 'other_job' END AS initiated_by
    FROM events"""


SOURCES = {
    "ref_state": ref_state, "ref_invoice_status": ref_invoice_status, "ref_payment_status": ref_payment_status,
    "payment_method": payment_method, "payment_type": payment_type, "tax_rate": tax_rate, "store": store,
    "department": department, "product_category": product_category, "employee": employee, "product": product,
    "customer": customer, "customer_address": customer_address, "customer_status_history": customer_status_history,
    "invoice": invoice, "invoice_line": invoice_line, "invoice_status_history": invoice_status_history,
    "payment": payment, "refund": refund, "invoice_adjustment": invoice_adjustment,
}
# tables in which wave 2 changes something
CHANGING = ("customer", "product", "invoice", "invoice_line", "payment")
