"""Session settings the toolkit relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

from .sources.files import Files

# Runtime settings that are correct at every scale: let AQE size shuffles, split
# skewed join partitions and turn joins into broadcasts from measured sizes.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (never restarts it)."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "lakestrata", cpus: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.ansi.enabled", "true")
    )
    return configure(builder.getOrCreate())


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Intermediate tables have to outlive executors, so on a cluster the setting is
    required; a machine-local folder is chosen only for a local master.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    cached = getattr(scratch_root, "_local", None)
    if cached is None:
        cached = tempfile.mkdtemp(prefix="lakestrata-")
        scratch_root._local = cached
    return cached


#: The tables of the scope that is open in this thread of control; each scope has a list of its own.
_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the tables staged inside the block, and in threads started with its context, once it ends."""
    mine: list[str] = []
    token = _staged.set(mine)
    try:
        yield
    finally:
        _staged.reset(token)
        if mine:
            files = Files(spark, mine[0])
            for path in mine:
                files.delete(path)


def in_scope(work: Callable) -> Callable:
    """``work`` bound to the caller's scope, for a worker thread."""
    context = copy_context()
    return lambda *args, **kwargs: context.copy().run(work, *args, **kwargs)


def observed(seen: Observation, **empty) -> dict:
    """What was observed while a frame was written; a plan that is empty by construction observes nothing."""
    try:
        return seen.get
    except Py4JJavaError:
        return empty


#: Times the threshold that rows may take where the other side of the join is a large table, uncut.
WIDE = 6


def too_many(df: DataFrame, rows: int | None = None, times: int = 1) -> bool:
    """Whether the rows are more than the broadcast threshold allows for; ``rows`` is their number or a bound of it, if known.

    Spark judges a stored table by the size of its files and its columns' share of the widths; the rows of
    compressed or encoded columns take many times as much in the driver's memory.
    """
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    width = 8 + df._jdf.schema().defaultSize()
    return limit >= 0 and (df.count() if rows is None else rows) * width > limit * times


def by_count(df: DataFrame, rows: int | None = None, times: int = 1) -> DataFrame:
    """The right side of a semi, anti or left join, not to be broadcast if its rows are too many."""
    return df.hint("merge") if too_many(df, rows, times) else df


def stage(df: DataFrame, label: str = "stage", codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and return the re-read table.

    Used where a result is consumed more than once, or where partition contents
    must stay fixed between two jobs. Unlike cached blocks it survives executor loss,
    later reads prune columns, and its file size tells Spark whether it may be broadcast.
    ``codec`` names another Parquet compression than the session's, for tables as large as the input; their
    columns with too many values for a dictionary are written as differences (version 2 pages).
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    writer = df.write if codec is None else df.write.option("parquet.writer.version", "PARQUET_2_0")
    writer.parquet(path, compression=codec)
    mine = _staged.get()
    if mine is not None:
        mine.append(path)
    return spark.read.schema(df.schema).parquet(path)
