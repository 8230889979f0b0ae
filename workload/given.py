"""Spark side: the given tables as views, and the derived source tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from lakestrata.session import WIDE, too_many

from . import source_sql as src

GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def run(spark: SparkSession, sf: str, text: str) -> DataFrame:
    """Run a derivation over the given tables of one scale factor."""
    refs = {}

    def bind(m: re.Match) -> str:
        name = m.group(2)
        rows = refs[f"t_{name}"] = table(spark, sf, name)
        used = [c for c in rows.columns if re.search(rf"\b{c}\b", text)]
        if m.group(1) == "JOIN" and too_many(rows.select(*used), times=WIDE):
            refs[f"t_{name}"] = rows.hint("merge")
        return f"{m.group(1)} {{t_{name}}}"

    text = re.sub(rf"\b(FROM|JOIN)\s+({'|'.join(GIVEN)})\b", bind, text)
    return spark.sql(text, **refs)


def source(spark: SparkSession, sf: str, name: str, wave: int = 1) -> DataFrame:
    return run(spark, sf, src.SOURCES[name](src.SPARK, wave))


def econ(spark: SparkSession, sf: str) -> DataFrame:
    return run(spark, sf, src.econ(src.SPARK))


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    return run(spark, sf, src.ledger(src.SPARK))
