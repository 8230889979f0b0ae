"""Registry of queries with the SQL that checks them.

The column list of a query gives names and plain result types for both sides:
``l`` bigint, ``d`` double, ``s`` string, ``b`` boolean.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .duck import with_blocks

TYPES = {"l": "bigint", "d": "double", "s": "string", "b": "boolean"}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _columns(spec: str) -> list[tuple[str, str]]:
    out = []
    for item in spec.split():
        name, _, kind = item.partition(":")
        out.append((name, TYPES[kind or "s"]))
    return out


def query(columns: str, sql: str | None, name: str | None = None):
    """Register a function (spark, sf) -> DataFrame under its own name."""
    cols = _columns(columns)

    def register(fn):
        key = name or fn.__name__

        def run(spark: SparkSession, sf: str) -> DataFrame:
            return fn(spark, sf).select(*[F.col(c).cast(t).alias(c) for c, t in cols])

        QUERIES[key] = run
        if sql is not None:
            outer = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in cols)
            ORACLES[key] = with_blocks(f"SELECT {outer} FROM ({sql}) q")
        return fn

    return register
