"""What is written and shuffled on the way to the star stays in proportion to what a step changes."""

from pyspark.sql import functions as F

from lakestrata.operators.keys import assign_keys
from lakestrata.operators.merge import dedup_latest, dedup_stored
from lakestrata.plans import facts
from lakestrata.session import stage




def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def landed(spark, keys):
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, bronze_record_id long")
    stamp = F.expr("timestamp_ntz'2001-01-01' + make_dt_interval(bronze_record_id % 3)")
    return stage(rows.select("k", stamp.alias("updated_at_source_timestamp"), stamp.alias("created_at_source_timestamp"),
                             stamp.alias("bronze_loaded_at_timestamp"), "bronze_record_id"), "landed")


def test_unique_keys_are_not_moved(spark):
    rows = landed(spark, [*range(20), None])
    assert dedup_stored(rows, ["k"]) is rows


def test_repeated_and_missing_keys_are_compared(spark):
    rows = landed(spark, [1, 2, 2, None, 3, None, 2, 4, 4])
    want = sorted(map(str, dedup_latest(rows, ["k"]).collect()))
    assert len(want) == 5
    assert sorted(map(str, dedup_stored(rows, ["k"]).collect())) == want
    assert sorted(map(str, dedup_stored(rows, ["k"], most=1).collect())) == want


def test_keyed_rows_are_a_projection(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("hot"), "id").repartition(7)
    out = assign_keys(rows, ["hot", "id"], "k", start=5)
    assert "Join" not in plan_of(out) and "Aggregate" not in plan_of(out)
    got = [(r.hot, r.id) for r in out.orderBy("k").collect()]
    assert got == sorted(got) and [r.k for r in out.orderBy("k").collect()] == list(range(6, 1006))


def test_payments_without_parent_stay_out_of_the_join(spark):
    new = spark.createDataFrame([("1", 11, None), ("2", 12, None), ("19", 13, 1), ("29", 14, 8)],
                                "source_record_id string, payment_key long, parent_payment_id long")
    out = facts.resolve_parent(stage(new, "new"))
    assert {(r.payment_key, r.parent_payment_key) for r in out.collect()} == {(11, None), (12, None), (13, 11), (14, None)}
    assert "isnotnull(parent_payment_id" in plan_of(out)

    stored = stage(out.select("payment_key", "parent_payment_key"), "stored")
    moved = stage(spark.createDataFrame([(11, 21)], "_old long, _new long"), "moved")
    again = facts.repoint_children(stored, moved)
    assert {(r.payment_key, r.parent_payment_key) for r in again.collect()} == {(11, None), (12, None), (13, 21), (14, None)}
    assert "isnotnull(parent_payment_key" in plan_of(again.where("payment_key = 13"))
