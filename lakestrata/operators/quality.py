"""Data-quality checks. Every check returns the failing rows; an empty result passes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import month_key, month_of_key, ts
from ..session import in_scope
from .ordered import neighbour

UNKNOWN_ID = "-1"
STALE_DAYS = 95


# -- generic --------------------------------------------------------------------
def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Duplicated non-null keys with their row count."""
    present = df.dropna(subset=columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return present.where("n > 1")


def accepted_values(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Values outside the list with their row count; NULL is not judged here."""
    bad = df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))
    return bad.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Referenced values without a parent row, with their child row count.

    The child side is reduced to its distinct values before the join, so neither its
    volume nor a hot value reaches the shuffle.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_column).alias("_known"))
    return used.join(known, F.col(column) == F.col("_known"), "left_anti")


# -- reconciliation -------------------------------------------------------------
def reconcile(gold: DataFrame, gold_amount: str, silver: DataFrame, silver_amount: str) -> DataFrame:
    """Row counts and totals of both layers, if they differ; one aggregate over both."""
    both = gold.select(F.lit(True).alias("_gold"), F.col(gold_amount).alias("_amount")).union(
        silver.select(F.lit(False), F.col(silver_amount))
    )

    def totals(side: str, mine: Column) -> list[Column]:
        return [
            F.count_if(mine).alias(f"{side}_rows"),
            F.round(F.coalesce(F.sum(F.when(mine, F.col("_amount"))), F.lit(0)), 2).alias(f"{side}_total"),
        ]

    sums = both.agg(*totals("gold", F.col("_gold")), *totals("silver", ~F.col("_gold")))
    return sums.where("gold_rows <> silver_rows or gold_total <> silver_total").withColumn(
        "total_diff", F.col("gold_total") - F.col("silver_total")
    )


def refunds_not_negative(payments: DataFrame) -> DataFrame:
    return payments.where(
        F.col("parent_payment_key").isNotNull() & (F.col("parent_payment_key") != -1) & (F.col("payment_amount") >= 0)
    ).select("payment_key", "parent_payment_key", "payment_amount")


# -- Type 2 invariants ----------------------------------------------------------
def _entities(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("source_record_id") != UNKNOWN_ID)


def scd2_overlaps(dim: DataFrame, name: str) -> DataFrame:
    """Versions whose window meets another window of the same entity.

    Windows are first reduced to one row per (entity, start day), which bounds an
    entity by the calendar; a running maximum of the window ends then replaces the
    pairwise comparison. Empty or inverted windows only conflict with one around them.
    """
    end = F.coalesce("valid_to", F.lit("9999-12-31").cast("date"))
    real = F.col("valid_from") < end
    at = F.when(real, F.col("valid_from")).otherwise(end)
    days = (
        _entities(dim)
        .select("source_record_id", "valid_from", real.alias("_real"), at.alias("_at"),
                F.when(real, end).alias("_end"), "row_version")
        .groupBy("source_record_id", "_at", "_real", "valid_from")
        .agg(F.max("_end").alias("_end"), F.count(F.lit(1)).alias("_n"), F.max("row_version").alias("row_version"))
    )
    earlier = W.partitionBy("source_record_id").orderBy("_at", "_real", "valid_from").rowsBetween(
        W.unboundedPreceding, -1
    )
    reach = F.max("_end").over(earlier)
    clash = (reach > F.col("valid_from")) | (F.col("_real") & (F.col("_n") > 1))
    return (
        days.withColumn("_clash", F.coalesce(clash, F.lit(False)))
        .where("_clash")
        .select(F.lit(name).alias("dimension"), "source_record_id", "valid_from", "row_version")
    )


def scd2_one_current(dim: DataFrame, name: str) -> DataFrame:
    """Entities without exactly one open version."""
    return (
        _entities(dim)
        .groupBy("source_record_id")
        .agg(F.count_if("is_current").alias("current_versions"))
        .where("current_versions <> 1")
        .select(F.lit(name).alias("dimension"), "source_record_id", "current_versions")
    )


def scd2_contiguous(dim: DataFrame, name: str) -> DataFrame:
    """Entities whose row versions are not exactly 1..n: smallest, largest and different ones tell."""
    v, n = F.col("row_version").cast("bigint"), F.count(F.lit(1))
    seen = F.struct(F.min(v).alias("a"), F.max(v).alias("z"), F.count_distinct(v).alias("d"))
    want = F.struct(F.lit(1).cast("bigint").alias("a"), n.alias("z"), n.alias("d"))
    found = _entities(dim).groupBy("source_record_id").agg(n.alias("version_count"), F.max("row_version").alias("max_version"),
                                                          (seen == want).alias("_ok"))
    return found.where("not _ok").select(F.lit(name).alias("dimension"), "source_record_id", "version_count", "max_version")


def scd2_window_gaps(dim: DataFrame, name: str) -> DataFrame:
    """Versions whose end differs from the start of the next version (or is set without one)."""
    following = _entities(dim).select(
        "source_record_id", (F.col("row_version") - 1).alias("row_version"), F.col("valid_from").alias("next_from")
    )
    return (
        _entities(dim)
        .join(following, ["source_record_id", "row_version"], "left")
        .where(~F.col("valid_to").eqNullSafe(F.col("next_from")))
        .select(F.lit(name).alias("dimension"), "source_record_id", "row_version", "valid_to", "next_from")
    )


# -- time series ----------------------------------------------------------------
def stale_series(econ: DataFrame, today: str | Column, limit: int = STALE_DAYS) -> DataFrame:
    day = F.lit(today).cast("date") if isinstance(today, str) else today
    return (
        econ.groupBy("silver_series_id")
        .agg(F.max("silver_observation_date").alias("latest_observation"))
        .withColumn("days_stale", F.datediff(day, "latest_observation"))
        .where(F.col("days_stale") > limit)
    )


def month_gaps(econ: DataFrame) -> DataFrame:
    """Months between a series' first and last observation that have no row."""
    expected = (
        econ.groupBy("silver_series_id")
        .agg(F.min("silver_observation_date").alias("lo"), F.max("silver_observation_date").alias("hi"))
        .select("silver_series_id", F.explode(F.expr("sequence(lo, hi, interval 1 month)")).alias("month"))
    )
    have = econ.select(
        F.col("silver_series_id").alias("_sid"), F.trunc("silver_observation_date", "MM").alias("_month")
    )
    on = (F.col("silver_series_id") == F.col("_sid")) & (F.trunc("month", "MM") == F.col("_month"))
    return expected.join(have, on, "left_anti")


def non_positive(econ: DataFrame) -> DataFrame:
    return econ.where("silver_indicator_value <= 0").select(
        "silver_series_id", "silver_observation_date", "silver_indicator_value"
    )


def months_without_basis(sales: DataFrame, econ: DataFrame, series_id: str) -> DataFrame:
    """Revenue months with no known index value at or before them.

    The first known index month decides, so one scalar replaces a non-equi anti join.
    """
    months = sales.select(month_of_key(F.col("date_key")).alias("month_key")).distinct()
    known = econ.where((F.col("silver_series_id") == series_id) & F.col("silver_indicator_value").isNotNull())
    first = known.agg(F.min(month_key(F.col("silver_observation_date"))).alias("_first"))
    covered = F.col("month_key") >= first.scalar()
    return months.where(~F.coalesce(covered, F.lit(False)))


def freshness(landed: DataFrame, by: list[str], loaded_at: str, now: str | Column, warn_hours: int = 24,
              error_hours: int = 48) -> DataFrame:
    """pass / warn / error per source by the age of its newest landed row."""
    at = ts(now) if isinstance(now, str) else now
    age = F.timestamp_diff("HOUR", F.col("newest"), at)
    return (
        landed.groupBy(*by)
        .agg(F.max(loaded_at).alias("newest"))
        .withColumn("age_hours", age)
        .withColumn("status", F.when(age > error_hours, "error").when(age > warn_hours, "warn").otherwise("pass"))
    )


def source_freshness(newest: DataFrame, limits: Mapping[str, tuple[int | None, int | None]], now: str | Column) -> DataFrame:
    """pass / warn / error / exempt per source from its newest row, each by its own limits in hours.

    ``newest`` has a row per source (``source``, ``newest``); a source without limits or with none
    of a kind can't reach that state, and one that never got a row is an error unless it is exempt.
    """
    at = ts(now) if isinstance(now, str) else now
    rows = [(s, w, e) for s, (w, e) in limits.items()]
    known = newest.sparkSession.createDataFrame(rows, "source string, warn_hours int, error_hours int")
    age, bounded = F.timestamp_diff("HOUR", F.col("newest"), at), F.coalesce("warn_hours", "error_hours").isNotNull()
    status = (F.when(~bounded, "exempt").when(F.col("newest").isNull(), "error").when(age > F.col("error_hours"), "error")
              .when(age > F.col("warn_hours"), "warn").otherwise("pass"))
    return (newest.join(F.broadcast(known), "source", "left")  # a row for each configured source
            .select("source", "newest", age.alias("age_hours"), status.alias("status")))


# -- row rules: flag and quarantine -----------------------------------------------
@dataclass(frozen=True)
class RowRule:
    """``broken`` is true for rows that violate the rule."""

    name: str
    broken: Column


def flag_rows(df: DataFrame, rules: Iterable[RowRule]) -> DataFrame:
    """Keep every row; mark those that break a rule and say which."""
    names = F.concat_ws("; ", *[F.when(F.coalesce(r.broken, F.lit(False)), F.lit(r.name)) for r in rules])
    return (
        df.withColumn("dq_issue_description", F.nullif(F.left(names, F.lit(500)), F.lit("")))
        .withColumn("dq_issue_flag", F.col("dq_issue_description").isNotNull())
    )


def split_quarantine(df: DataFrame, key: str, kind: str = "bigint") -> tuple[DataFrame, DataFrame]:
    """(rows whose key is present and castable, the others as raw JSON with a reason)."""
    cast = F.col(key).try_cast(kind)
    good = df.where(cast.isNotNull())
    reason = F.when(F.col(key).isNull() | (F.trim(key) == ""), "missing key").otherwise("uncastable key")
    bad = df.where(cast.isNull()).select(
        F.lit(key).alias("key_column"), reason.alias("reason"), F.to_json(F.struct(*df.columns)).alias("raw_row")
    )
    return good, bad


# Valid state codes.
STATES = ("CA", "AZ", "TX")


def invoice_rules() -> list[RowRule]:
    c = F.col
    return [
        RowRule("status outside vocabulary", c("silver_invoice_status").isNull()),
        RowRule("due before invoice date", c("silver_invoice_due_date") < c("silver_invoice_date")),
        RowRule("total does not foot", c("silver_total_amount") != c("silver_subtotal_amount")
                - c("silver_discount_amount") + c("silver_tax_amount") + c("silver_fee_amount")),
        RowRule("balance does not foot",
                c("silver_balance_due_amount") != c("silver_total_amount") - c("silver_paid_amount")),
    ]


def line_rules() -> list[RowRule]:
    c = F.col
    return [
        RowRule("quantity not positive", c("silver_order_qty") <= 0),
        RowRule("negative unit price", c("silver_unit_price_amount") < 0),
        RowRule("line does not foot", c("silver_line_total_amount")
                != c("silver_order_qty") * c("silver_unit_price_amount") - c("silver_discount_amount")),
    ]


def payment_rules(today: str | Column) -> list[RowRule]:
    day = F.lit(today).cast("date") if isinstance(today, str) else today
    return [
        RowRule("status outside vocabulary", F.col("silver_payment_status").isNull()),
        RowRule("payment in the future", F.col("silver_payment_date") > day),
    ]


def customer_rules() -> list[RowRule]:
    return [
        RowRule("status outside vocabulary", F.col("silver_customer_status").isNull()),
        RowRule("email without @", ~F.contains(F.col("silver_email"), F.lit("@"))),
    ]


def address_rules(states: Iterable[str] = STATES) -> list[RowRule]:
    return [
        RowRule("type outside vocabulary", F.col("silver_address_type").isNull()),
        RowRule("unknown state", ~F.col("silver_state_code").isin(*states)),
    ]


def header_vs_lines(invoice: DataFrame, line: DataFrame) -> DataFrame:
    """Invoices whose subtotal differs from the sum of their lines."""
    sums = line.groupBy("silver_invoice_id").agg(F.sum("silver_line_total_amount").alias("line_sum"))
    return (
        invoice.select("silver_invoice_id", "silver_subtotal_amount")
        .join(sums, "silver_invoice_id")
        .where("silver_subtotal_amount <> line_sum")
    )


# -- batch rules ------------------------------------------------------------------
EMPTY_LOAD = "empty full load"
UNEQUAL_COUNTS = "extracted differs from inserted plus rejected"
FEWER_ROWS = "row count dropped by more than half"


def load_issues(full: bool, extracted: int, kept: int, rejected: int, previous: int | None, least_share: float = 0.5) -> list[str]:
    """The batch rules for a load that is about to be committed; ``kept`` are its sound rows, landed now or known already."""
    found = [UNEQUAL_COUNTS] if extracted != kept + rejected else []
    if full and extracted == 0:
        found.append(EMPTY_LOAD)
    elif full and previous is not None and extracted < previous * least_share:
        found.append(FEWER_ROWS)
    return found


def batch_issues(ledger: DataFrame, drop_share: float = 0.5) -> DataFrame:
    """Batches that break a batch-level rule, one row per broken rule."""
    done = ledger.where("batch_status = 'succeeded'")
    full = done.where("load_type = 'full_load'")
    columns = ("batch_key", "target_table")
    empty = full.where("rows_extracted = 0").select(*columns, F.lit(EMPTY_LOAD).alias("issue"))
    counted = F.col("rows_inserted") + F.coalesce("rows_rejected", F.lit(0))
    unequal = done.where(F.col("rows_extracted") != counted).select(
        *columns, F.lit(UNEQUAL_COUNTS).alias("issue")
    )
    previous = neighbour(
        full, ["target_table"], ["batch_end_timestamp", "batch_key"], {"previous_rows": "rows_extracted"},
        F.to_date("batch_end_timestamp"),
    )
    dropped = previous.where(F.col("rows_extracted") < F.col("previous_rows") * (1 - drop_share)).select(
        *columns, F.lit(FEWER_ROWS).alias("issue")
    )
    return empty.unionByName(unequal).unionByName(dropped)


# -- running a suite ----------------------------------------------------------------
@dataclass(frozen=True)
class Failure:
    check: str
    rows: int


def run_checks(checks: Mapping[str, Callable[[], DataFrame]], parallel: int = 4, width: int = 4) -> list[Failure]:
    """Count the failing rows of every check; only the counts reach the driver.

    ``width`` checks are planned by one thread and form one job, so their stages run side by side.
    """

    def counts(group: list[tuple[str, Callable[[], DataFrame]]]) -> list:
        ones = [
            make().agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n") for name, make in group
        ]
        return reduce(DataFrame.union, ones).collect()

    items = list(checks.items())
    groups = [items[i:i + width] for i in range(0, len(items), width)]
    with ThreadPoolExecutor(parallel) as pool:
        rows = [r for found in pool.map(in_scope(counts), groups) for r in found]
    return [Failure(r["check"], r["n"]) for r in rows if r["n"]]
