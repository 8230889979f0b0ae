"""Schemas of stored tables: wider types are taken in, any other drift fails before a commit."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.operators.contract import WIDER, ContractError, admit, drift
from lakestrata.operators.merge import without
from lakestrata.sources.store import TableStore

DECIMALS = [("int", "decimal(12,2)"), ("bigint", "decimal(20,0)"), ("smallint", "decimal(10,0)"),
            ("decimal(9,2)", "decimal(12,2)"), ("decimal(12,2)", "decimal(24,6)"), ("decimal(18,2)", "decimal(38,2)")]
SAFE = [(old, new) for old, wider in WIDER.items() for new in wider] + DECIMALS
LOSSY = [("bigint", "double"), ("int", "float"), ("bigint", "decimal(19,0)"), ("decimal(12,2)", "decimal(13,4)"), ("double", "float"),
         ("timestamp_ntz", "date"), ("string", "int"), ("int", "string"), ("timestamp", "timestamp_ntz")]
LARGEST = {"tinyint": "127", "smallint": "32767", "int": "2147483647", "bigint": "9223372036854775807", "float": "1.5",
           "date": "2024-02-29", "decimal(9,2)": "9999999.99", "decimal(12,2)": "-9999999999.99", "decimal(18,2)": "0.01"}


def kinds(old, new):
    return {d.path: d.kind for d in drift(T.StructType.fromDDL(old), T.StructType.fromDDL(new))}


@pytest.mark.parametrize("old,new", SAFE)
def test_files_of_the_smaller_type_are_read_as_the_wider_one(spark, store, old, new):
    first = spark.range(1).select("id", F.lit(LARGEST[old]).cast(old).alias("v"), F.array(F.lit(LARGEST[old]).cast(old)).alias("a"))
    second = first.select(F.col("id") + 1, F.col("v").cast(new).alias("v"), F.col("a").cast(f"array<{new}>").alias("a")).toDF("id", "v", "a")
    store.append("bronze", "t", first)
    store.append("bronze", "t", second)
    want = spark.range(1).select(F.lit(LARGEST[old]).cast(old).cast(new)).first()[0]
    assert [(r["v"], r["a"]) for r in store.read("bronze", "t").orderBy("id").collect()] == [(want, [want])] * 2
    assert store.read("bronze", "t", 1).schema["v"].dataType.simpleString() == old
    with pytest.raises(ContractError, match="narrowed"):
        store.append("bronze", "t", first)


@pytest.mark.parametrize("old,new", LOSSY)
def test_types_that_lose_values_are_refused(old, new):
    with pytest.raises(ContractError, match="v (narrowed|changed)"):
        admit("t", T.StructType.fromDDL(f"v {old}"), T.StructType.fromDDL(f"v {new}"))


def test_nested_differences_are_named_by_their_path():
    old = "id int, s struct<a:int,b:array<struct<x:date>>,gone:string>, m map<string,int>"
    new = "id int, s struct<a:bigint,b:array<struct<x:timestamp_ntz,y:int>>>, m map<string,smallint>, more int"
    assert kinds(old, new) == {"s.a": "widened", "s.b.element.x": "widened", "s.b.element.y": "added", "s.gone": "removed",
                               "m.value": "narrowed", "more": "added"}
    assert kinds("a int, b int", "b int, a int") == {"columns": "moved"}
    assert kinds("a int not null", "a int") == {}


def test_refused_batches_leave_nothing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), required={"bronze.t": ["k"]})
    rows = spark.createDataFrame([(1, "a")], "k bigint, v string")
    store.append("bronze", "t", rows, 1)
    with pytest.raises(ContractError, match="k is missing in 2 rows"):
        store.append("bronze", "t", spark.createDataFrame([(None, "b"), (2, "c"), (None, "d")], rows.schema), 2)
    with pytest.raises(ContractError, match="k narrowed"):
        store.append("bronze", "t", rows.select(F.col("k").cast("int"), "v"), 2)
    assert store.versions("bronze", "t") == [1] and store.batches("bronze", "t") == [1]
    assert len(store.files.names(f"{tmp_path}/bronze/t/data")) == 1


@pytest.mark.parametrize("buckets", [1, 8])
def test_a_rewrite_widens_kept_rows(spark, tmp_path, buckets):
    store = TableStore(spark, str(tmp_path), {"silver.t": buckets})
    store.overwrite("silver", "t", spark.range(100).select("id", F.col("id").cast("int").alias("v")), ["id"])
    new = spark.createDataFrame([(7, 2**40)], "id bigint, v bigint")
    store.rewrite("silver", "t", new, lambda old: without(old, new, ["id"]), new)
    got = {r["id"]: r["v"] for r in store.read("silver", "t").collect()}
    assert got == {k: k for k in range(100)} | {7: 2**40}
    narrow = new.select("id", F.lit(1).alias("v"))
    with pytest.raises(ContractError, match="v narrowed: bigint -> int"):
        store.rewrite("silver", "t", narrow, lambda old: without(old, narrow, ["id"]), narrow)
