import pytest
from pyspark.sql import functions as F

from lakestrata.operators.merge import without
from lakestrata.plans.metrics import latest_snapshot
from lakestrata.sources.store import TableStore, period_of

LINES = "invoice string, date_key int, amount int"


def values(df):
    return sorted(tuple(r) for r in df.collect())


def lines(spark, rows):
    return spark.createDataFrame(rows, LINES)


def replace(store, new, removed=()):
    spark = store.spark
    touched = new.select("invoice").union(spark.createDataFrame([(r,) for r in removed], "invoice string"))
    return store.rewrite("gold", "sales", touched, lambda old: without(old, touched, ["invoice"]), new)


@pytest.fixture(params=[1, 4])
def store(spark, tmp_path, request):
    s = TableStore(spark, str(tmp_path), {"gold.sales": request.param}, periods={"gold.sales": ("date_key", 100)})
    rows = [(f"i{k}", 20240100 + 100 * (k % 3) + 1 + k % 28, k) for k in range(300)]
    assert s.overwrite("gold", "sales", lines(spark, rows), ["invoice"]) == 300
    return s


def folders(store, month):
    return {p[0] for p in store.manifest("gold", "sales").parts if period_of(p[0]) == month}


def test_a_batch_of_one_month_rewrites_only_that_month(spark, store):
    before = {m: folders(store, m) for m in store.periods("gold", "sales")}
    assert list(before) == [202401, 202402, 202403]
    assert replace(store, lines(spark, [("i2", 20240305, -1), ("new", 20240306, -2)])) == 2
    assert folders(store, 202401) == before[202401] and folders(store, 202402) == before[202402]
    assert folders(store, 202403) != before[202403]
    got = {r.invoice: r.amount for r in store.read("gold", "sales").collect()}
    assert len(got) == 301 and got["i2"] == -1 and got["new"] == -2


def test_a_late_line_moves_between_months(spark, store):
    before = {m: folders(store, m) for m in store.periods("gold", "sales")}
    replace(store, lines(spark, [("i0", 20240207, -1)]))  # it was of January
    assert folders(store, 202403) == before[202403]
    assert values(store.read("gold", "sales").where("invoice = 'i0'")) == [("i0", 20240207, -1)]
    assert store.read_periods("gold", "sales", 202401).where("invoice = 'i0'").isEmpty()
    assert store.read_periods("gold", "sales", 202401, 202402).count() == 200


def test_invoices_without_lines_and_lines_without_a_date(spark, store):
    replace(store, lines(spark, []), removed=["i0", "unheard of"])
    assert store.read("gold", "sales").count() == 299
    replace(store, lines(spark, [("undated", None, 1), ("unknown", -1, 2)]))
    assert store.read("gold", "sales").count() == 301
    replace(store, lines(spark, [("undated", None, 3), ("unknown", 20240101, 4)]))
    got = {r.invoice: (r.date_key, r.amount) for r in store.read("gold", "sales").where("invoice LIKE 'un%'").collect()}
    assert got == {"undated": (None, 3), "unknown": (20240101, 4)}
    assert store.read("gold", "sales", 1).count() == 300
    store.expire("gold", "sales", keep=1)
    assert store.read("gold", "sales").count() == 301


def test_the_newest_snapshot_opens_one_day(spark, tmp_path):
    s = TableStore(spark, str(tmp_path), periods={"gold.snapshot": ("snapshot_date_key", 1)})
    for batch, day in ((7, 20240131), (8, 20240229)):
        s.append("gold", "snapshot", spark.range(4).select("id", F.lit(day).alias("snapshot_date_key")), batch)
    newest = s.read_newest("gold", "snapshot")
    assert newest.inputFiles() and all("_period=20240229" in f for f in newest.inputFiles())
    assert values(newest) == values(latest_snapshot(s.read("gold", "snapshot")).select(newest.columns))
    assert values(s.read_since("gold", "snapshot", 7)) == values(newest)
    assert s.periods("gold", "nothing") == []


def test_erasure_is_one_write_and_keeps_periods_buckets_and_batches(spark, store):
    subjects = spark.createDataFrame([("i0",), ("i1",), ("i0",), (None,)], "subject_id string")
    untouched = folders(store, 202403)
    assert store.erase("gold", "sales", "invoice", subjects) == 2
    assert folders(store, 202403) == untouched and store.periods("gold", "sales") == [202401, 202402, 202403]
    fresh = {p[0].split("/")[1] for p in store.manifest("gold", "sales").parts if "_replaced=" in p[0]}
    assert len(fresh) == 1
    assert store.read("gold", "sales").count() == 298
    assert store.erase("gold", "sales", "invoice", subjects) == 0
    replace(store, lines(spark, [("i3", 20240101, -9)]))
    assert store.read("gold", "sales").count() == 298
    for batch, key in ((3, "a"), (5, "b"), (6, "c")):
        store.append("bronze", "t", spark.createDataFrame([(key, 1), ("i0", 1)] if batch < 6 else [("i1", 1)], "id string, v int"), batch)
    assert store.erase("bronze", "t", "id", subjects) == 3
    assert values(store.read("bronze", "t")) == [("a", 1), ("b", 1)]
    assert values(store.read_since("bronze", "t", 3)) == [("b", 1)]
    assert store.batches("bronze", "t") == [3, 5]
    store.expire("bronze", "t", keep=1)
    assert store.read("bronze", "t").count() == 2
