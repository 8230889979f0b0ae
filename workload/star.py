"""The derived warehouse as plans, each piece computed once per session and scale factor.

Pieces that several queries read are written to the shared scratch folder, as a stored
warehouse would hold them. A piece that is a projection of written rows, or a large stored
table with the few rows of a load in the place of others, is not written again: its readers
take the columns they need.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.operators.calendar import dim_date
from lakestrata.operators.keys import max_key
from lakestrata.operators.merge import replace_keys, upsert
from lakestrata.operators.scd import scd2_apply
from lakestrata.plans import facts, serving
from lakestrata.plans.dimensions import (
    SCD2_DIMENSIONS, STAGES, invoice_labels, invoice_parts, payment_type_rows, stage_payment_type,
)
from lakestrata.plans.silver import SPECS, silver_changes, silver_table
from lakestrata.session import stage
from lakestrata.sources.config import DEFAULT_TABLES
from lakestrata.sources.landing import RECORD_ID, standardize
from lakestrata.sources.series import SERIES_CONFIG

from . import given
from .source_sql import CHANGING, RUN_1, RUN_2

RUNS = {1: RUN_1, 2: RUN_2}
BATCH = {1: "load:1", 2: "load:2"}
CONFIGS = {t.target: t for t in DEFAULT_TABLES} | {SERIES_CONFIG.target: SERIES_CONFIG}
DIMENSIONS = {s.name: s for s in SCD2_DIMENSIONS}


def landed(spark: SparkSession, sf: str, target: str, wave: int = 1) -> DataFrame:
    """Landing rows of one batch."""
    return standardized(extracted(spark, sf, target, wave), target, wave)


def extracted(spark: SparkSession, sf: str, target: str, wave: int = 1) -> DataFrame:
    """Source rows of one batch with the id each lands under."""
    rows = given.econ(spark, sf) if target == "econ_indicator" else given.source(spark, sf, CONFIGS[target].name, wave)
    return rows.withColumn(RECORD_ID, F.monotonically_increasing_id() + F.lit(1 + (wave - 1) * (1 << 50)))


def standardized(rows: DataFrame, target: str, wave: int) -> DataFrame:
    system = "api" if target == "econ_indicator" else None
    return standardize(rows, CONFIGS[target], wave, RUNS[wave], system, numbered=True)


PAYLOAD = "bronze_raw_payload_jsonb"


class Star:
    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf
        self._done: dict[str, DataFrame] = {}

    def _once(self, name: str, make) -> DataFrame:
        if name not in self._done:
            self._done[name] = stage(make(), name.replace("/", "-"), "zstd")
        return self._done[name]

    def _view(self, name: str, make) -> DataFrame:
        """A piece that is derived from written ones whenever it is read."""
        if name not in self._done:
            self._done[name] = make()
        return self._done[name]

    # -- landing and current state -------------------------------------------------
    def landing(self, target: str, wave: int = 1) -> DataFrame:
        """Landing rows. Source rows are stored once with their ids, which every later table names; hash, stamps and
        renames follow from them when they are read. The raw payload, which no later table reads, is left to ``landed``."""
        rows = self._once(f"landed/{target}/{wave}", lambda: extracted(self.spark, self.sf, target, wave))
        return self._view(f"landing/{target}/{wave}", lambda: standardized(rows, target, wave).drop(PAYLOAD))

    def silver(self, entity: str, wave: int = 2) -> DataFrame:
        spec = SPECS[entity]
        if wave == 1 or entity not in CHANGING:
            return self._view(f"silver/{entity}/1", lambda: silver_table(
                spec, self.landing(spec.source), batch_id=1, run_ts=RUN_1, stored=True))

        def merged() -> DataFrame:
            return upsert(self.silver(entity, 1), self.changes(entity), list(spec.keys), stored=True)

        return self._view(f"silver/{entity}/2", merged)

    def changes(self, entity: str) -> DataFrame:
        """Rows the second load upserts."""
        spec = SPECS[entity]
        return self._once(f"changes/{entity}", lambda: silver_changes(
            spec, self.landing(spec.source, 2), self.silver(entity, 1), batch_id=2, run_ts=RUN_2, stored=True))

    # -- dimensions --------------------------------------------------------------
    @property
    def bounds(self) -> tuple[str, str]:
        """First day of the first order year to the last day of the year after the last order."""
        if not hasattr(self, "_bounds"):
            o = given.table(self.spark, self.sf, "orders")
            lo, hi = o.agg(F.year(F.min("o_orderdate")), F.year(F.max("o_orderdate"))).first()
            self._bounds = (f"{lo}-01-01", f"{hi + 1}-12-31")
        return self._bounds

    def dim_date(self) -> DataFrame:
        return self._once("dim_date", lambda: dim_date(self.spark, RUN_1, *self.bounds))

    def dim(self, name: str, wave: int = 2) -> DataFrame:
        spec = DIMENSIONS[name]

        def make() -> DataFrame:
            target = None if wave == 1 else self.dim(name, 1)
            if name == "dim_invoice":
                newer = invoice_parts(_Lookup(self, wave), since=RUN_1 if target is not None else None)
                if target is not None:
                    newer = stage(newer, "staged-invoice", "zstd")
                return scd2_apply(spec, newer, target, BATCH[wave], RUNS[wave], stored=target is not None, late=invoice_labels())
            return scd2_apply(spec, self.staged(name, wave), target, BATCH[wave], RUNS[wave])

        # first versions are the keyed rows; of the dimensions only the invoice's is as large as the facts
        keep = self._view if wave == 1 or name == "dim_invoice" else self._once
        return keep(f"{name}/{wave}", make)

    def staged(self, name: str, wave: int = 2) -> DataFrame:
        return STAGES[name](_Lookup(self, wave))

    def dim_payment_type(self) -> DataFrame:
        return self._once("dim_payment_type", lambda: payment_type_rows(
            stage_payment_type({"payment_type": self.silver("payment_type")}), None, RUN_1))

    # -- facts ---------------------------------------------------------------------
    def changed_invoices(self) -> DataFrame:
        return self._once("changed_invoices", lambda: facts.changed_invoices(
            self.silver("invoice"), self.silver("invoice_line"), RUN_1))

    def changed_payments(self) -> DataFrame:
        return self._once("changed_payments", lambda: facts.changed_payments(self.silver("payment"), RUN_1))

    def sales(self, wave: int = 2) -> DataFrame:
        if wave == 1:
            return self._view("sales/1", lambda: facts.sales_fact(_Lookup(self, 1), batch_id=BATCH[1], run_ts=RUN_1))
        return self._view("sales/2", lambda: replace_keys(
            self.sales(1), self.new_sales(), ["invoice_number"], self.changed_invoices(), stored=True))

    def new_sales(self) -> DataFrame:
        return self._view("sales/new", lambda: facts.sales_fact(
            _Lookup(self, 2), batch_id=BATCH[2], run_ts=RUN_2, changed=self.changed_invoices(),
            start=max_key(self.sales(1), "sales_line_key")))

    def payments(self, wave: int = 2) -> DataFrame:
        if wave == 1:
            return self._once("payments/1", lambda: facts.payment_fact(
                _Lookup(self, 1), batch_id=BATCH[1], run_ts=RUN_1))

        def reload() -> DataFrame:
            moved = stage(facts.moved_keys(self.payments(1), self.new_payments()), "moved")
            kept = facts.repoint_children(self.payments(1), moved)
            return replace_keys(kept, self.new_payments(), ["source_record_id"], self.changed_payments())

        return self._view("payments/2", reload)

    def new_payments(self) -> DataFrame:
        return self._once("payments/new", lambda: facts.payment_fact(
            _Lookup(self, 2), batch_id=BATCH[2], run_ts=RUN_2, changed=self.changed_payments(),
            target=self.payments(1), start=max_key(self.payments(1), "payment_key")))

    def snapshot_day(self):
        """Month-end before the month of the newest order."""
        if not hasattr(self, "_snap"):
            newest = given.table(self.spark, self.sf, "orders").agg(F.max("o_orderdate").cast("string")).first()[0]
            self._snap = facts.snapshot_day(newest[:10])
        return self._snap

    def snapshot(self) -> DataFrame:
        return self._view("snapshot", lambda: facts.snapshot_fact(
            _Lookup(self, 2), self.snapshot_day(), batch_id=BATCH[2], run_ts=RUN_2))

    def bi_snapshot(self) -> DataFrame:
        return serving.snapshot_view(self.snapshot(), self.dim_date())

    def bi_payments(self) -> DataFrame:
        return serving.payments_view(self.payments())

    def tables(self, wave: int = 2) -> _Lookup:
        return _Lookup(self, wave)


class _Lookup(dict):
    """Tables by name, built when first asked for."""

    def __init__(self, star: Star, wave: int):
        super().__init__()
        self.star, self.wave = star, wave

    def __missing__(self, name: str) -> DataFrame:
        s = self.star
        if name == "dim_date":
            return s.dim_date()
        if name == "dim_payment_type":
            return s.dim_payment_type()
        if name in DIMENSIONS:
            return s.dim(name, self.wave)
        if name == "fact_retail_sales":
            return s.sales(self.wave)
        if name == "fact_payments":
            return s.payments(self.wave)
        if name == "fact_customer_behavior_snapshot":
            return s.snapshot()
        return s.silver(name, self.wave)


@cache
def star(spark: SparkSession, sf: str) -> Star:
    return Star(spark, sf)


__all__ = ["Star", "extracted", "landed", "standardized", "star"]
