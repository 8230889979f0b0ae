"""Hashes that only tell rows apart travel short: five bytes of a key's hash, sixteen of a change hash."""

import re

from pyspark.sql import functions as F

from lakestrata.operators import merge
from lakestrata.operators.merge import dedup_latest, dedup_stored, hash_gate
from lakestrata.operators.scd import detect
from lakestrata.session import stage

KEYS = ["k", "t"]


def tell(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def landed(spark, n, twice):
    rows = spark.range(n).selectExpr("if(id % 40 = 3, null, id) k", "'x' || id % 3 t", "id bronze_record_id")
    rows = rows.unionByName(rows.where(twice).withColumn("bronze_record_id", F.col("bronze_record_id") + 1000))
    stamps = ("updated_at_source_timestamp", "created_at_source_timestamp", "bronze_loaded_at_timestamp")
    return stage(rows.selectExpr("*", *[f"timestamp_ntz'2001-01-01' {c}" for c in stamps]), "landed")


def test_repeated_keys_by_short_hashes(spark, monkeypatch):
    staged = []
    monkeypatch.setattr(merge, "stage", lambda df, label, *more: staged.append((label, df.columns)) or stage(df, label, *more))
    once = landed(spark, 30, "false").where("k is not null")
    assert dedup_stored(once, KEYS) is once
    assert [c for c in staged if c[0].startswith("repeated")] == [("repeated-hashes", ["_short"])]
    for bits in (merge.SHORT, 7, 0):  # with few bits different keys share a value
        monkeypatch.setattr(merge, "SHORT", bits)
        assert dedup_stored(once, KEYS) is once
        rows = landed(spark, 200, "k % 10 = 0 or k is null")
        assert tell(dedup_stored(rows, KEYS)) == tell(dedup_latest(rows, KEYS))


def test_change_hashes_travel_as_bytes(spark):
    rows = spark.range(50).selectExpr("id k", "if(id % 7 = 0, null, sha2(cast(id as string), 256)) h", "'new' c")
    old = spark.range(10, 60).selectExpr("id k", "if(id % 14 = 0 or id % 5 = 0, null, sha2(cast(id as string), 256)) h", "'old' c")
    gated = hash_gate(rows, old, ["k"], "h", ("c",))
    want = [i for i in range(50) if i < 10 or (i % 7 == 0) != (i % 14 == 0 or i % 5 == 0)]
    assert sorted((r.k, r.c) for r in gated.collect()) == [(i, "new" if i < 10 else "old") for i in want]
    staged = rows.selectExpr("cast(k as string) source_record_id", "h record_hash")
    target = old.selectExpr("cast(k as string) source_record_id", "h record_hash", "true is_current", "1 row_version")
    assert sorted(int(r.source_record_id) for r in detect(staged, target).collect()) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (gated, detect(staged, target))]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all(re.search(r"unhex\(md5\(cast\(sha2?\w*\(.*AS (_t_h|_hash)#|unhex\(md5\(.* AS (_t_h|_hash)#", p) for p in plans)
