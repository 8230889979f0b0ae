"""Economic time series delivered as JSON documents of observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import SERIES_TARGET, TableConfig
from .landing import LandingResult, land
from .ledger import Ledger, series_start
from .store import TableStore

# The tracked series with their labels and units.
SERIES = {
    "CPIAUCSL": {"label": "CPI (All Urban Consumers, SA)", "units": "index_1982_84"},
    "WPU0911": {"label": "PPI: Pulp, Paper & Allied Products", "units": "index"},
}
MISSING = (".", "")
OBSERVATIONS = "array<struct<date: string, value: string>>"
SERIES_CONFIG = TableConfig("fred", SERIES_TARGET, "incremental", "updated_at")


def catalogue(spark: SparkSession, series: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Series id, label and units; a handful of configured rows."""
    rows = [(k, v.get("label"), v.get("units")) for k, v in (series or SERIES).items()]
    return spark.createDataFrame(rows, "series_id string, label string, units string")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document per series: ``{"series_id": ..., "observations": [...]}``."""
    schema = f"series_id string, observations {OBSERVATIONS}"
    return spark.read.schema(schema).json(path)


def parse_documents(df: DataFrame, json_col: str) -> DataFrame:
    """The same document held as JSON text in a column."""
    return df.withColumn(
        "observations", F.from_json(json_col, f"struct<observations: {OBSERVATIONS}>")["observations"]
    )


def observations(documents: DataFrame, series: DataFrame, start: str | None = None) -> DataFrame:
    """One row per observation on or after ``start``; placeholder values become NULL."""
    exploded = documents.select("series_id", F.inline("observations"))
    day = F.col("date").cast("date")
    if start is not None:
        exploded = exploded.where(day >= F.lit(start).cast("date"))
    value = F.when(~F.col("value").isin(*MISSING), F.col("value").cast("double"))
    stamp = day.cast("timestamp_ntz")
    return (
        exploded.join(series.select("series_id", "units"), "series_id")
        .select(
            "series_id",
            day.alias("observation_date"),
            value.alias("indicator_value"),
            "units",
            stamp.alias("created_at"),
            stamp.alias("updated_at"),
        )
    )


def ingest_series(
    documents: DataFrame, store: TableStore, ledger: Ledger, run_ts: str, *,
    series: dict[str, dict[str, str]] | None = None, job: str = "warehouse_run",
) -> LandingResult:
    """Append the observations from the last loaded month on; revisions are absorbed downstream."""
    batch = ledger.start(SERIES_TARGET, "api", "incremental_append", initiated_by=job,
                         watermark_column="updated_at_source_timestamp")
    try:
        start = series_start(ledger.frame(), SERIES_TARGET)
        rows = observations(documents, catalogue(store.spark, series), start)
        result = land(store, rows, SERIES_CONFIG, batch, run_ts, skip=False, mark_column="updated_at", system="api")
        ledger.complete(batch, result.extracted, result.appended, result.watermark)
        return result
    except Exception as exc:
        ledger.fail(batch, str(exc))
        raise
