"""Rows of file sources: where they came from, and files up to the mark stay closed."""

import os
from datetime import datetime

from pyspark.sql import functions as F

from lakestrata.sources import landing
from lakestrata.sources.config import TableConfig
from lakestrata.sources.ledger import Ledger

CFG = TableConfig("product", "oltp_product", "incremental", landing.FILE_TIME, ("product_id",))


def drop_file(spark, folder, name, ids, at, kind="parquet"):
    out = f"{folder}/{name}"
    rows = spark.createDataFrame([(i, f"s{i}") for i in ids], "product_id long, sku string").coalesce(1)
    rows.write.format(kind).save(out)
    for part in os.listdir(out):
        stamp = datetime.fromisoformat(at).timestamp()
        os.utime(f"{out}/{part}", (stamp, stamp))


def files_read(df):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def scan(spark, folder):
    return landing.with_file_lineage(spark.read.schema("product_id long, sku string").parquet(f"{folder}/*"))


def test_only_newer_files_are_opened(spark, store, tmp_path):
    drop = str(tmp_path / "drop")
    drop_file(spark, drop, "a", range(5), "2026-01-01 10:00:00")
    drop_file(spark, drop, "b", range(5, 8), "2026-01-02 10:00:00")
    ledger = Ledger(spark, store.root, clock=lambda: "2026-01-03 00:00:00")
    first = landing.ingest_table(scan(spark, drop), CFG, store, ledger, "2026-01-03 00:00:00")
    assert (first.appended, first.watermark, first.dropped) == (8, "2026-01-02 10:00:00", ())
    drop_file(spark, drop, "c", range(2, 4), "2026-01-04 10:00:00")
    newer = landing.extract(scan(spark, drop), CFG, first.watermark)
    # the file at the mark is read again, as it is within the hour of lookback
    assert newer.count() == 5 and files_read(newer) == 2 and files_read(scan(spark, drop)) == 3
    second = landing.ingest_table(scan(spark, drop), CFG, store, ledger, "2026-01-05 00:00:00")
    assert (second.extracted, second.watermark) == (5, "2026-01-04 10:00:00")


def test_rows_carry_their_place_and_hash_alike(spark, store, tmp_path):
    drop = str(tmp_path / "drop")
    drop_file(spark, drop, "a", [7, 8, 9], "2026-01-01 10:00:00")
    drop_file(spark, drop, "b", [9], "2026-01-02 10:00:00")
    ledger = Ledger(spark, store.root, clock=lambda: "2026-01-03 00:00:00")
    landing.ingest_table(scan(spark, drop), CFG, store, ledger, "2026-01-03 00:00:00")
    rows = store.read("bronze", "oltp_product").select(
        "product_id", F.element_at(F.split("bronze_source_file_name", "/"), -2).alias("folder"), "bronze_source_row_number",
        F.col("updated_at_source_timestamp").cast("string").alias("at"), "bronze_row_hash", "bronze_raw_payload_jsonb")
    found = sorted(tuple(r)[:4] for r in rows.collect())
    assert found == [(7, "a", 1, "2026-01-01 10:00:00"), (8, "a", 2, "2026-01-01 10:00:00"), (9, "a", 3, "2026-01-01 10:00:00"),
                     (9, "b", 1, "2026-01-02 10:00:00")]
    nine = rows.where("product_id = 9").collect()
    assert len({r["bronze_row_hash"] for r in nine}) == 1
    assert {r["bronze_raw_payload_jsonb"] for r in nine} == {'{"product_id":9,"sku":"s9"}'}


def test_formats_without_positions_leave_the_number_unset(spark, tmp_path):
    drop_file(spark, str(tmp_path), "a", [1, 2], "2026-01-01 10:00:00", "csv")
    rows = landing.with_file_lineage(spark.read.schema("product_id long, sku string").csv(f"{tmp_path}/a"))
    assert [r["bronze_source_row_number"] for r in rows.collect()] == [None, None]
