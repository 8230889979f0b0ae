"""Stored tables are compressed with zstd."""

import glob

import pyarrow.parquet as pq


def test_stored_tables_are_written_with_zstd(store):
    rows = store.spark.range(100).selectExpr("id k", "id % 7 v")
    store.bucket_plan = {"l.t": 4}
    store.overwrite("l", "t", rows, ["k"])
    store.append("l", "u", rows)
    gone = rows.where("v = 3").select("k")
    store.rewrite("l", "t", gone, lambda old: old.join(gone, "k", "left_anti"), rows.limit(0))
    files = glob.glob(f"{store.root}/l/**/*.parquet", recursive=True)
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files if pq.ParquetFile(f).metadata.num_rows} == {"ZSTD"}
    assert store.read("l", "t").count() == 86
