"""One warehouse run: land, merge, build the star, check, and only then advance the marks."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from threading import Lock

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import quality as dq
from ..operators.calendar import dim_date, role_view
from ..operators.changelog import before_image, change_log, change_reasons
from ..operators.incremental import Change
from ..operators.merge import upsert, without
from ..operators.scd import DimensionSpec, close_superseded, new_versions, scd2_apply
from ..session import in_scope, scratch_scope, stage
from ..sources.config import SERIES_TARGET, LandingConfig, freshness_limits
from ..sources.landing import ingest_table
from ..sources.ledger import Ledger, gold_watermark, last_full_loads, latest_watermarks
from ..sources.series import ingest_series
from ..sources.store import TableStore
from . import facts, serving
from .dimensions import SCD2_DIMENSIONS, STAGES, cut, payment_type_rows, source_tables, stage_payment_type, touched
from .gate import Gate, table_change
from .silver import SPECS, merge_silver
from .suite import GOLD_KEYS, suite_rules

JOB = "warehouse_run"
SALES, PAYMENTS, SNAPSHOT = "fact_retail_sales", "fact_payments", "fact_customer_behavior_snapshot"
# Star-schema load targets and their load types.
GOLD_TARGETS = {
    "gold.dimensions": "scd2_merge",
    f"gold.{SALES}": "fact_reload",
    f"gold.{PAYMENTS}": "fact_reload",
    f"gold.{SNAPSHOT}": "snapshot_append",
}
# surrogate keys of the facts, whose highest value the store remembers
TRACKED = {
    f"gold.{SALES}": "sales_line_key",
    f"gold.{PAYMENTS}": "payment_key",
    f"gold.{SNAPSHOT}": "snapshot_key",
}
# The snapshot is kept by day. Large facts are kept by month if the store is opened with MONTHLY as well: a month and
# bucket is then a folder, which is too many files for small facts.
DAILY = {f"gold.{SNAPSHOT}": ("snapshot_date_key", 1)}
MONTHLY = {f"gold.{SALES}": ("date_key", 100), f"gold.{PAYMENTS}": ("date_key", 100)}


@dataclass
class RunReport:
    landed: dict[str, int] = field(default_factory=dict)
    rejected: dict[str, int] = field(default_factory=dict)
    # per landed table, source columns that weren't landed and landing columns that nothing filled
    columns: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = field(default_factory=dict)
    merged: dict[str, int] = field(default_factory=dict)
    star: dict[str, int] = field(default_factory=dict)
    # pass, warn, error or exempt by landing table, from the age of its newest row; it holds no mark back
    freshness: dict[str, str] = field(default_factory=dict)
    failures: list[dq.Failure] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return not self.failures


class ChecksFailed(RuntimeError):
    def __init__(self, report: RunReport):
        super().__init__(", ".join(f"{f.check}: {f.rows}" for f in report.failures))
        self.report = report


@dataclass
class Run:
    """Everything one run needs; ``run_ts`` is the only clock, so a run can be repeated exactly."""

    store: TableStore
    run_ts: str
    calendar: tuple[str, str] = ("2020-01-01", "2030-12-31")
    snapshot_date: str | None = None
    config: LandingConfig = field(default_factory=LandingConfig)
    job: str = JOB
    parallel: int = 8
    # checks whose failure is reported but does not hold the marks back
    tolerated: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        self.ledger = Ledger(self.store.spark, self.store.root, clock=lambda: self.run_ts)
        self.store.tracked |= {f"gold.{s.name}": s.key for s in SCD2_DIMENSIONS} | TRACKED
        self.store.period_plan = DAILY | self.store.period_plan
        self.store.required |= {f"gold.{n}": list(columns[:1]) for n, columns in GOLD_KEYS.items()}
        self._trail_lock = Lock()

    def _each(self, work: Callable[[str], int], names: list[str]) -> dict[str, int]:
        """Independent tables are submitted together, so small jobs fill the cluster."""
        with ThreadPoolExecutor(self.parallel) as pool:
            return dict(zip(names, pool.map(in_scope(work), names), strict=True))

    # -- landing and current state --------------------------------------------------
    def land(self, sources: Mapping[str, DataFrame], documents: DataFrame | None = None,
             report: RunReport | None = None) -> dict[str, int]:
        marks = {r["target_table"]: r["watermark_value_end"] for r in latest_watermarks(self.ledger.frame()).collect()}
        loads = {r["target_table"]: r["rows_extracted"] for r in last_full_loads(self.ledger.frame()).collect()}

        def one(name: str) -> int:
            cfg = self.config.table(name)
            mark = marks.get(cfg.target)
            result = ingest_table(sources[name], cfg, self.store, self.ledger, self.run_ts, job=self.job, mark=mark,
                                  previous=loads.get(cfg.target), judge=True)
            if report is not None:
                report.rejected[name], report.columns[name] = result.rejected, (result.dropped, result.unfilled)
            return result.appended

        counts = self._each(one, [t.name for t in self.config.tables if t.name in sources])
        if documents is not None:
            counts["econ_indicator"] = ingest_series(documents, self.store, self.ledger, self.run_ts,
                                                     job=self.job).appended
        return counts

    def merge(self) -> dict[str, int]:
        batch = self.ledger.start("silver", "bronze", "incremental_merge", initiated_by=self.job)
        names = [n for n, s in SPECS.items() if self.store.exists("bronze", s.source)]
        book = stage(self.ledger.frame().select("batch_key", "target_table", "batch_status"), "ledger")
        counts = self._each(
            lambda n: merge_silver(self.store, SPECS[n], batch_id=batch.key, run_ts=self.run_ts, ledger=book), names
        )
        total = sum(counts.values())
        self.ledger.complete(batch, total, total)
        return counts

    # -- star -------------------------------------------------------------------------
    def tables(self) -> dict[str, DataFrame]:
        """Every committed current-state and star table by name."""
        out = {n: self.store.read("silver", n) for n in SPECS if self.store.exists("silver", n)}
        out |= {n: self.store.read("gold", n) for n in GOLD_KEYS if self.store.exists("gold", n)}
        return out

    def dimension(self, spec: DimensionSpec, t: Mapping[str, DataFrame], batch_id: str, mark: str) -> int:
        """Versions of the entities touched since the last load; which source versions were read is committed with them."""
        layers = {n: "silver" if n in SPECS else "gold" for n in source_tables(spec.name)}
        now = {n: self.store.manifest(layer, n) for n, layer in layers.items()}
        note = {"sources": {n: m.version for n, m in now.items()}}
        if not self.store.exists("gold", spec.name):
            rows = scd2_apply(spec, STAGES[spec.name](t), None, batch_id, self.run_ts)
            return self.store.overwrite("gold", spec.name, rows, ["source_record_id"], note)
        last = self.store.manifest("gold", spec.name).meta.get("sources", {})

        def before(table: str) -> Change | None:
            if last.get(table) not in self.store.versions(layers[table], table):
                return None
            then = self.store.manifest(layers[table], table, last[table])
            return table_change(self.store, layers[table], table, then, now[table])

        ids, target = touched(spec.name, t, mark, before), t[spec.name]
        if ids is None:
            staged = STAGES[spec.name](t)
        elif ids.isEmpty():
            return 0
        else:
            staged = stage(STAGES[spec.name](cut(spec.name, t, ids)), f"staged-{spec.name}")
            target = target.join(staged.select("source_record_id"), "source_record_id", "left_semi").select(target.columns)
        added = new_versions(spec, staged, target, batch_id, self.run_ts, self.store.top("gold", spec.name))
        if added.isEmpty():
            return 0
        return self.store.rewrite(
            "gold", spec.name, added, lambda old: close_superseded(old, added, spec.key, self.run_ts), added, note
        )

    def payment_types(self, t: Mapping[str, DataFrame]) -> int:
        target, key = t.get("dim_payment_type"), ["payment_type_key"]
        rows = payment_type_rows(stage_payment_type(t), target, self.run_ts)
        if target is None:
            return self.store.overwrite("gold", "dim_payment_type", rows, key)
        merged = stage(upsert(target, rows, key, ("etl_load_timestamp",)), "payment-type")
        return self.store.overwrite("gold", "dim_payment_type", merged, key)

    def dimensions(self, batch_id: str) -> int:
        calendar = dim_date(self.store.spark, self.run_ts, *self.calendar)
        n = self.store.overwrite("gold", "dim_date", calendar)
        t = self.tables()
        mark = gold_watermark(self.ledger.frame(), "gold.dimensions")
        work = {s.name: (lambda s=s: self.dimension(s, t, batch_id, mark)) for s in SCD2_DIMENSIONS}
        work["dim_payment_type"] = lambda: self.payment_types(t)
        counts = self._each(lambda name: work[name](), list(work))
        return n + sum(counts.values())

    def sales(self, batch_id: str) -> int:
        t, name = self.tables(), SALES
        if name not in t:
            rows = facts.sales_fact(t, batch_id=batch_id, run_ts=self.run_ts)
            return self.store.overwrite("gold", name, rows, ["invoice_number"])
        mark = gold_watermark(self.ledger.frame(), f"gold.{name}")
        changed = stage(facts.changed_invoices(t["invoice"], t["invoice_line"], mark), "changed-invoices")
        if changed.isEmpty():
            return 0
        new = stage(facts.sales_fact(t, batch_id=batch_id, run_ts=self.run_ts, changed=changed,
                                     start=self.store.top("gold", name)), "sales")
        reasons = None
        if "invoice_adjustment" in t:
            wanted = t["invoice"].join(changed.select(F.col("invoice_number").alias("silver_invoice_number")),
                                       "silver_invoice_number", "left_semi")
            reasons = change_reasons(t["invoice_adjustment"], wanted)
        self._trail(f"gold.{name}", before_image(t[name], changed, "invoice_number", stored=True), new, "sales_line_key",
                    "invoice_number", batch_id, reasons)
        # deleting by the changed set also removes invoices that lost all their lines
        return self.store.rewrite("gold", name, changed, lambda old: without(old, changed, ["invoice_number"], stored=True), new)

    def payments(self, batch_id: str) -> int:
        t, name, key = self.tables(), PAYMENTS, "source_record_id"
        if name not in t:
            rows = facts.payment_fact(t, batch_id=batch_id, run_ts=self.run_ts)
            return self.store.overwrite("gold", name, rows, [key])
        mark = gold_watermark(self.ledger.frame(), f"gold.{name}")
        changed = stage(facts.changed_payments(t["payment"], mark), "changed-payments")
        if changed.isEmpty():
            return 0
        new = stage(facts.payment_fact(t, batch_id=batch_id, run_ts=self.run_ts, changed=changed, target=t[name],
                                       start=self.store.top("gold", name)), "payments")
        moved = stage(facts.moved_keys(t[name], new), "moved-payments")
        parents = moved.select(F.col("_old").alias("parent_payment_key"))
        children = without(t[name].join(parents, "parent_payment_key", "left_semi").select(t[name].columns), changed, [key])
        children = stage(children, "moved-children")
        followed = facts.repoint_children(children, moved, batch_id, self.run_ts)
        self._trail(f"gold.{name}", before_image(t[name], changed, key).unionByName(children), new.unionByName(followed),
                    "payment_key", key, batch_id)
        return self.store.rewrite(
            "gold", name, changed.select(key).unionByName(children.select(key)),
            lambda old: facts.repoint_children(without(old, changed, [key]), moved, batch_id, self.run_ts), new)

    def _trail(self, table: str, before: DataFrame, after: DataFrame, surrogate: str, record: str, batch_id: str,
               reasons: DataFrame | None = None) -> None:
        """Written before the data: a crash in between repeats a trail entry instead of losing it."""
        log = change_log(before, after, table=table, surrogate_key=surrogate, record_key=record,
                         batch_id=batch_id, run_ts=self.run_ts, reasons=reasons, app=self.job)
        with self._trail_lock:
            self.store.append("audit", "audit_log", log)

    def _stored_snapshot(self, t: Mapping[str, DataFrame], on: Column) -> DataFrame | None:
        """The stored snapshots to compare with; of a table kept by day no other date is opened."""
        m = self.store.manifest("gold", SNAPSHOT)
        if m is None or m.period is None:
            return t.get(SNAPSHOT)
        return self.store.read_periods("gold", SNAPSHOT, facts.day_key(t["dim_date"], on))

    def snapshot(self, batch_id: str) -> int:
        t, name = self.tables(), SNAPSHOT
        on = facts.snapshot_day(self.run_ts[:10], self.snapshot_date)
        target = self._stored_snapshot(t, on)
        if target is not None and facts.snapshot_exists(target, on, t["dim_date"]):
            return 0
        rows = facts.snapshot_fact(t, on, batch_id=batch_id, run_ts=self.run_ts, target=target,
                                   start=self.store.top("gold", name))
        return self.store.append("gold", name, rows)

    # -- checks and the whole run -----------------------------------------------------
    def freshness(self) -> DataFrame:
        """State of every landing table by its own limits; only the folders of its last batches are read."""
        targets = sorted({t.target for t in self.config.tables} | {SERIES_TARGET})
        ages = [self._newest(n) for n in targets if self.store.exists("bronze", n)]
        if not ages:
            return self.store.spark.createDataFrame([], "source string, newest timestamp_ntz, age_hours bigint, status string")
        return dq.source_freshness(reduce(DataFrame.unionByName, ages), {n: freshness_limits(n) for n in targets}, self.run_ts)

    def _newest(self, target: str) -> DataFrame:
        at = self.store.newest_value("bronze", target, "bronze_loaded_at_timestamp")
        return at.select(F.lit(target).alias("source"), F.col("bronze_loaded_at_timestamp").alias("newest"))

    def check(self) -> list[dq.Failure]:
        """The failing checks; each judges what changed since it last ran."""
        t = self.tables()
        places = {n: "silver" if n in SPECS else "gold" for n in t}
        return Gate(self.store, suite_rules(self.run_ts[:10]), places).run(t, self.parallel)

    def execute(
        self, sources: Mapping[str, DataFrame], documents: DataFrame | None = None, checks: bool = True
    ) -> RunReport:
        """Land, merge, build, check; star batches succeed only after the checks passed."""
        report = RunReport()
        with scratch_scope(self.store.spark):
            self._execute(report, sources, documents, checks)
        return report

    def _execute(self, report: RunReport, sources: Mapping[str, DataFrame], documents: DataFrame | None,
                 checks: bool) -> None:
        try:
            report.landed = self.land(sources, documents, report)
            report.freshness = {r["source"]: r["status"] for r in self.freshness().collect()} if checks else {}
            report.merged = self.merge()
            batches = {
                target: self.ledger.start(target, "silver", kind, initiated_by=self.job)
                for target, kind in GOLD_TARGETS.items()
            }
            report.star["gold.dimensions"] = self.dimensions(batches["gold.dimensions"].id)
            work = {SALES: self.sales, PAYMENTS: self.payments, SNAPSHOT: self.snapshot}
            counts = self._each(lambda n: work[n](batches[f"gold.{n}"].id), list(work))
            report.star |= {f"gold.{n}": c for n, c in counts.items()}
            report.failures = self.check() if checks else []
            if [f for f in report.failures if f.check not in self.tolerated]:
                raise ChecksFailed(report)
            for target, batch in batches.items():
                self.ledger.complete(batch, report.star[target], report.star[target])
        except Exception:
            self.ledger.fail_open(self.job)
            raise


def serve(t: Mapping[str, DataFrame], register: bool = False) -> dict[str, DataFrame]:
    """The serving views and date roles over the star tables; optionally as temp views."""
    views = {name: serving.dimension_view(name, t) for name in serving.DIMENSION_VIEWS}
    views |= {
        "bi_dim_customer_contact": serving.customer_contact(t["customer"]),
        "bi_fact_sales": serving.sales_view(t[SALES]),
        "bi_fact_payments": serving.payments_view(t[PAYMENTS]),
        "bi_fact_customer_snapshot": serving.snapshot_view(t[SNAPSHOT], t["dim_date"]),
        "bi_revenue_real": serving.revenue_real(t[SALES], t["econ_indicator"]),
        "bi_margin_vs_paper_cost": serving.margin_vs_paper(t[SALES], t["econ_indicator"]),
    }
    for role in ("first_order", "last_order", "snapshot"):
        views[f"vw_{role}_date"] = role_view(t["dim_date"], role)
    if register:
        for name, df in views.items():
            df.createOrReplaceTempView(name)
    return views
