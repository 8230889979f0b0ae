"""Benchmark: whole warehouse runs and the headline queries on the stored star.

Reads $BENCH_SF_DIR, runs on local[$BENCH_CPUS], prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakestrata.operators.calendar import role_view  # noqa: E402
from lakestrata.operators.quality import scd2_overlaps  # noqa: E402
from lakestrata.plans import governance, metrics  # noqa: E402
from lakestrata.plans.run import serve  # noqa: E402
from lakestrata.session import local_session  # noqa: E402
from lakestrata.sources.store import TableStore  # noqa: E402
from workload import warehouse as w  # noqa: E402

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")


def headline(t, v) -> dict:
    cal = t["dim_date"]
    sales, payments, snap = v["bi_fact_sales"], v["bi_fact_payments"], v["bi_fact_customer_snapshot"]
    return {
        "profit_by_month": lambda: metrics.profit_by_month(sales, cal, t["dim_product"]),
        "collections_by_method": lambda: metrics.collections_by_method(t["fact_payments"], t["dim_payment_method"]),
        "top_customers": lambda: metrics.top_customers(
            snap, t["dim_customer"], role_view(cal, "snapshot"), role_view(cal, "last_order")),
        "sales_kpis": lambda: metrics.sales_kpis(sales),
        "sales_by_department": lambda: metrics.sales_by(sales, t["dim_product"], "product_key", "department_description"),
        "yoy_ytd": lambda: metrics.sales_over_time(sales, cal),
        "collections": lambda: metrics.collections(payments),
        "customer_health": lambda: metrics.customer_health(snap),
        "revenue_real": lambda: v["bi_revenue_real"],
        "margin_vs_paper": lambda: v["bi_margin_vs_paper_cost"],
        "mask_contact": lambda: v["bi_dim_customer_contact"],
        "status_cycle_time": lambda: governance.status_cycle_time(t["invoice_status_history"], "silver_invoice_id"),
        "scd2_overlaps": lambda: scd2_overlaps(t["dim_invoice"], "dim_invoice"),
    }


def main() -> None:
    spark = local_session("bench", CPUS, int(CPUS))
    spark.sparkContext.setLogLevel("ERROR")
    store = TableStore(spark, tempfile.mkdtemp(prefix="bench-"), w.bucket_plan(spark))
    times: dict[str, float] = {}

    def timed(name, work):
        t0 = time.perf_counter()
        out = work()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    spark.range(1000).selectExpr("sum(id)").collect()
    for name, wave, run_ts in (("run_full", 1, w.RUN_1), ("run_changes", 2, w.RUN_2),
                               ("run_no_change", 2, "2002-01-03 08:00:00")):
        run = w.new_run(store, run_ts)
        timed(name, lambda r=run, n=wave: r.execute(w.sources(spark, SF, n), w.documents(spark, SF)))
    t = w.new_run(store, w.RUN_2).tables()
    for name, plan in headline(t, serve(t)).items():
        timed(name, lambda p=plan: p().write.format("noop").mode("overwrite").save())
    print(json.dumps({
        "metric": "warehouse runs and headline queries, total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": SF.rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
