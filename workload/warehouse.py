"""Whole runs over the derived sources, for the benchmark and the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.plans.run import Run
from lakestrata.sources.store import TableStore

from . import given
from .source_sql import CHANGING, RUN_1, RUN_2, SOURCES  # noqa: F401

CALENDAR = ("1990-01-01", "2002-12-31")
SNAPSHOT_DAY = "2000-06-30"
# the derived sources contain known violations, which the checks report
TOLERATED = (
    "columns state", "columns dim_product", "relationship customer_address.silver_state_code",
    "relationship invoice.silver_employee_id", "series fresh", "sales reconcile",
    "price index covers revenue", "paper index covers revenue",
    "columns fact_customer_behavior_snapshot",
)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """The economic series as one JSON-shaped document per series."""
    rows = given.econ(spark, sf)
    value = F.coalesce(F.col("indicator_value").cast("string"), F.lit("."))
    one = F.struct(F.col("observation_date").cast("string").alias("date"), value.alias("value"))
    return rows.groupBy("series_id").agg(F.collect_list(one).alias("observations"))


def sources(spark: SparkSession, sf: str, wave: int) -> dict[str, DataFrame]:
    names = SOURCES if wave == 1 else [*CHANGING, *(n for n in SOURCES if n.startswith("ref_"))]
    return {n: given.source(spark, sf, n, wave) for n in names}


def new_run(store: TableStore, run_ts: str) -> Run:
    return Run(store, run_ts, calendar=CALENDAR, snapshot_date=SNAPSHOT_DAY, tolerated=TOLERATED)


def bucket_plan(spark: SparkSession) -> dict[str, int]:
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions", "8")), 1)
    large = ("silver.invoice", "silver.invoice_line", "silver.payment", "gold.fact_retail_sales",
             "gold.fact_payments", "gold.dim_invoice")
    return {name: min(n, 64) for name in large}
