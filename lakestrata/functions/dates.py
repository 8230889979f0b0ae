"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ts(value: str) -> Column:
    """A fixed TIMESTAMP_NTZ instant, e.g. the run time injected into a load."""
    return F.lit(value).cast("timestamp_ntz")


def date_key(d: Column) -> Column:
    """YYYYMMDD as an integer."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_key(d: Column) -> Column:
    """YYYYMM as an integer."""
    return (F.year(d) * 100 + F.month(d)).cast("int")


def month_of_key(key: Column) -> Column:
    """YYYYMM of a YYYYMMDD key (integer division; the -1 member maps to 0)."""
    return F.call_function("div", key, F.lit(100)).cast("int")


def spine(spark: SparkSession, lo: str, hi: str, step: str = "1 day") -> DataFrame:
    """One row per step from ``lo`` to ``hi`` inclusive, in column ``date``."""
    return spark.range(1).select(
        F.explode(F.expr(f"sequence(date'{lo}', date'{hi}', interval {step})")).alias("date")
    )


def previous_month_end(run_date: Column) -> Column:
    """The last month-end strictly before the month of ``run_date``."""
    return F.date_sub(F.trunc(run_date, "MM"), 1)
