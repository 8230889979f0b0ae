"""Sets of merged batches, and merges of batches that land out of order."""

import itertools

from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from lakestrata.functions.intervals import Intervals
from lakestrata.plans.silver import MERGED, SPECS, merge_silver, merged_batches, settled
from lakestrata.session import stage
from lakestrata.sources.config import landing_schema
from lakestrata.sources.ledger import Ledger
from lakestrata.sources.store import TableStore
from test_landing_silver import CUSTOMER, customers, land

COLUMNS = "silver_customer_id silver_first_name silver_row_hash".split()


@given(st.lists(st.integers(1, 60)), st.lists(st.tuples(st.integers(1, 60), st.integers(0, 5))))
def test_intervals_are_sets(numbers, more):
    ranges = [(a, a + n) for a, n in more]
    got = Intervals.of(numbers).add(ranges)
    want = set(numbers) | {x for a, b in ranges for x in range(a, b + 1)}
    assert {x for x in range(0, 70) if x in got} == want
    assert got.top == max(want, default=0) and Intervals.read(got.stored()) == got
    inner = {x for a, b in got.gaps() for x in range(a, b + 1)}
    assert inner == {x for x in range(min(want, default=0), max(want, default=0)) if x not in want}


def test_column_of_a_set(spark):
    s = Intervals(((2, 4), (7, 7)))
    rows = spark.createDataFrame([(1,), (2,), (4,), (5,), (7,), (None,)], "n long")
    assert [r[0] for r in rows.where(s.holds("n")).orderBy("n").collect()] == [2, 4, 7]
    assert rows.where(Intervals().holds("n")).count() == 0


def batch(spark, rows, number):
    at = "2026-01-01 00:00:00"
    df = customers(spark, [(i, name, "x", None, None, None, "active", at) for i, name in rows])
    return land(spark, CUSTOMER, df, number, 1000 * number).select(landing_schema("oltp_customer").fieldNames())


def test_any_order_ends_alike(spark, tmp_path):
    data = {1: [(1, "a"), (2, "a"), (3, "a")], 2: [(1, "b"), (2, "b"), (4, "b")], 3: [(1, "a"), (5, "c")]}  # 3 takes 1 back
    want = None
    for order in itertools.permutations(data):
        store = TableStore(spark, str(tmp_path / "".join(map(str, order))))
        for k in order:
            store.append("bronze", "oltp_customer", batch(spark, data[k], k), k)
            merge_silver(store, SPECS["customer"], batch_id=k, run_ts="2026-01-10 08:00:00")
            assert k in merged_batches(store, SPECS["customer"])
        got = sorted(tuple(r) for r in store.read("silver", "customer").select(COLUMNS).collect())
        want = want or got
        assert got == want and [r[1] for r in got] == ["A", "B", "A", "B", "C"]


def test_two_interleaved_loads(spark, store):
    """A load opened first and landed last is merged by the run after it."""
    ledger = Ledger(spark, store.root, clock=lambda: "2026-01-10 08:00:00")

    def start():
        return ledger.start("oltp_customer", "oltp", "incremental_append", initiated_by="x")

    def merge(number):
        return merge_silver(store, SPECS["customer"], batch_id=number, run_ts="2026-01-10 08:00:00",
                            ledger=stage(ledger.frame(), "ledger"))

    def landed(b, rows):
        store.append("bronze", "oltp_customer", batch(spark, rows, b.key), b.key)
        ledger.complete(b, len(rows), len(rows))

    first, other, slow, quick = start(), ledger.start("oltp_invoice", "oltp", "x", initiated_by="x"), start(), start()
    landed(first, [(1, "a")])
    assert merge(10) == 1
    landed(quick, [(2, "c")])
    assert merge(11) == 1
    kept = Intervals.read(store.manifest("silver", "customer").meta[MERGED])
    assert slow.key not in kept and other.key in kept and quick.key in kept
    landed(slow, [(3, "b"), (2, "old")])
    assert merge(12) == 1
    assert Intervals.read(store.manifest("silver", "customer").meta[MERGED]).ranges == ((1, quick.key),)
    names = {r[0]: r[1] for r in store.read("silver", "customer").select(COLUMNS[:2]).collect()}
    assert names == {1: "A", 2: "C", 3: "B"}
    assert merge(13) == 0


def test_batches_without_changes_are_not_read_again(spark, store):
    for k in (1, 2):
        store.append("bronze", "oltp_customer", batch(spark, [(1, "a")], k), k)
        merge_silver(store, SPECS["customer"], batch_id=k, run_ts="2026-01-10 08:00:00")
    merged = merged_batches(store, SPECS["customer"])
    assert merged.ranges == ((1, 2),) and store.read_unmerged("bronze", "oltp_customer", merged) is None


def test_failed_loads_stay_gaps(spark):
    book = spark.createDataFrame([(1, "t", "succeeded"), (2, "t", "failed"), (3, "u", "failed"), (4, "t", "running"), (6, "u", "running")],
                                 "batch_key long, target_table string, batch_status string")
    assert settled(book, "t", Intervals.of([5, 7])).ranges == ((1, 1), (3, 3), (5, 7))
    assert settled(book.where(F.lit(False)), "t", Intervals.of([5])).ranges == ((5, 5),)
