"""Generated calendar dimension and its role-playing views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_key, spine, ts

# US federal holidays as the serving layer labels them.
# (month, day) holidays, then (month, weekday with Sunday=1, first and last possible day).
FIXED_HOLIDAYS = (
    (1, 1, "New Year's Day"),
    (6, 19, "Juneteenth"),
    (7, 4, "Independence Day"),
    (11, 11, "Veterans Day"),
    (12, 25, "Christmas Day"),
)
FLOATING_HOLIDAYS = (
    (1, 2, 15, 21, "MLK Day"),
    (2, 2, 15, 21, "Presidents' Day"),
    (5, 2, 25, 31, "Memorial Day"),
    (9, 2, 1, 7, "Labor Day"),
    (10, 2, 8, 14, "Columbus Day"),
    (11, 5, 22, 28, "Thanksgiving"),
)

DATE_ATTRIBUTES = (
    "full_date_description", "day_of_week", "day_number_in_calendar_month", "last_day_in_month_indicator",
    "calendar_week_ending_date", "calendar_month_name", "calendar_month_number_in_year", "calendar_quarter",
    "calendar_year_quarter", "calendar_year", "calendar_year_month", "holiday_indicator", "weekday_indicator",
)


def holiday(d: Column) -> Column:
    month, day, dow = F.month(d), F.dayofmonth(d), F.dayofweek(d)
    label = F.lit("None")
    for m, dd, name in FIXED_HOLIDAYS:
        label = F.when((month == m) & (day == dd), name).otherwise(label)
    for m, wd, lo, hi, name in FLOATING_HOLIDAYS:
        label = F.when((month == m) & (dow == wd) & day.between(lo, hi), name).otherwise(label)
    return label


def calendar_rows(days: DataFrame, run_ts: str) -> DataFrame:
    """Calendar attributes for every row of ``days`` (column ``date``)."""
    d = F.col("date")
    dow = F.dayofweek(d)
    weekend = dow.isin(1, 7)
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.date_format(d, "MMMM d, yyyy").alias("full_date_description"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.dayofmonth(d).cast("short").alias("day_number_in_calendar_month"),
        F.when(d == F.last_day(d), "Yes").otherwise("No").alias("last_day_in_month_indicator"),
        F.date_add(d, F.lit(7) - dow).alias("calendar_week_ending_date"),
        F.date_format(d, "MMMM").alias("calendar_month_name"),
        F.month(d).cast("short").alias("calendar_month_number_in_year"),
        F.quarter(d).cast("short").alias("calendar_quarter"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias("calendar_year_quarter"),
        F.year(d).cast("short").alias("calendar_year"),
        F.date_format(d, "yyyy-MM").alias("calendar_year_month"),
        holiday(d).alias("holiday_indicator"),
        F.when(weekend, "Weekend").otherwise("Weekday").alias("weekday_indicator"),
        ts(run_ts).alias("etl_load_timestamp"),
        ts(run_ts).alias("etl_updated_timestamp"),
    )


def dim_date(spark: SparkSession, run_ts: str, lo: str = "2020-01-01", hi: str = "2030-12-31") -> DataFrame:
    """The calendar from ``lo`` to ``hi`` plus the -1 member dated 1900-01-01."""
    rows = calendar_rows(spine(spark, lo, hi), run_ts)
    fixed = {
        "date_key": F.lit(-1),
        "date": F.lit("1900-01-01"),
        "full_date_description": F.lit("Not Provided"),
        "day_of_week": F.lit("Unknown"),
        "calendar_month_name": F.lit("Unknown"),
        "calendar_year_quarter": F.lit("Unknown"),
        "calendar_year_month": F.lit("Unknown"),
        "holiday_indicator": F.lit("None"),
        "weekday_indicator": F.lit("Unknown"),
        "etl_load_timestamp": ts(run_ts),
        "etl_updated_timestamp": ts(run_ts),
    }
    member = spark.range(1).select(
        *[fixed.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
    )
    return rows.unionByName(member)


def role_view(calendar: DataFrame, role: str) -> DataFrame:
    """The calendar relabelled for one role: first_order, last_order, snapshot, ..."""
    columns = ("date_key", "date", *DATE_ATTRIBUTES)
    return calendar.select(*[F.col(c).alias(f"{role}_{c}") for c in columns])
