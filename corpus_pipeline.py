"""The corpus pipeline: five operators one after the other, each stage written before the next reads it."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm.common import stage, table
from lakestrata.llm.decontamination import contamination
from lakestrata.llm.jaccard_join import jaccard_join
from lakestrata.llm.packing import pack
from lakestrata.llm.pii import pseudonymize
from lakestrata.llm.toxicity import toxicity
from lakestrata.session import scratch_root

#: Some stages learn or judge by id; SQL has no counterpart, so the tests compare with brute-force versions.
ORACLE_SQL = None


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id isn't among ``ids``; rows without an id stay."""
    return docs.join(ids.select(F.col("doc_id").alias("_id")).distinct(), docs.doc_id == F.col("_id"), "left_anti")


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go."""
    scored = toxicity(docs, table(spark, sf_dir, "labels"))
    return _without(docs, stage(scored.where("predicted = 1").select("doc_id"), "toxic"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document of the smallest id stays; rows of an id repeated stay once."""
    groups = jaccard_join(docs)
    return _without(docs, stage(groups.where("component_id < doc_id").select("doc_id"), "copies")).dropDuplicates()


def leaks_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents holding a benchmark item go."""
    return _without(docs, stage(contamination(docs, table(spark, sf_dir, "benchmark")).select("doc_id"), "leaks"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become pseudonyms."""
    return pseudonymize(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in training sequences."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxic_out),
    ("jaccard_join", one_of_near_copies),
    ("decontamination", leaks_out),
    ("pii", pseudonyms),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    root = f"{scratch_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, step) in enumerate(STAGES):
        out = step(spark, docs, sf_dir)
        path = f"{root}/{k}-{name}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
