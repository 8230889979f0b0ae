"""A bitmap over a set of keys spares most rows the join and changes no result."""

from pyspark.sql import functions as F

from lakestrata.operators import sieve
from lakestrata.operators.changelog import before_image
from lakestrata.operators.merge import replace_keys
from lakestrata.plans import facts
from lakestrata.session import stage


def tell(df):
    return sorted(map(str, df.collect()))


def rows_and_keys(spark):
    rows = spark.range(20000).selectExpr("if(id % 50 = 0, null, 'K' || id % 7000) as k", "id as n")
    keys = spark.range(900).selectExpr("if(id = 3, null, 'K' || id * 11) as k").unionByName(spark.sql("select 'K11' k"))
    return stage(rows, "rows"), stage(keys, "keys")


def test_joins_are_those_of_the_whole_rows(spark):
    rows, keys = rows_and_keys(spark)
    assert tell(sieve.semi(rows, keys, ["k"], few=0)) == tell(rows.join(keys, "k", "left_semi").select("k", "n"))
    assert tell(sieve.anti(rows, keys, ["k"], few=0)) == tell(rows.join(keys, "k", "left_anti").select("k", "n"))


def test_most_other_rows_are_told_apart(spark):
    rows, keys = rows_and_keys(spark)
    hit = rows.join(keys, "k", "left_semi").count()
    assert hit <= sieve.possible(rows, keys, ["k"], few=0).count() < hit + 0.2 * (20000 - hit)
    assert sieve.possible(rows, keys, ["k"]) is rows  # few keys: the join broadcasts them
    assert sieve.marked(rows, keys.select(F.col("k").cast("binary").alias("k")), ["k"], few=0) is None


def test_reload_uses_it(spark, monkeypatch):
    rows, keys = rows_and_keys(spark)
    new = stage(rows.where("n < 30").withColumn("n", F.col("n") + 50000), "new")
    want = tell(replace_keys(rows, new, ["k"], keys)), tell(before_image(rows, keys, "k"))
    monkeypatch.setattr(sieve, "marked", lambda r, k, on, few, real=sieve.marked: real(r, k, on, 0))
    got = replace_keys(rows, new, ["k"], keys, stored=True)
    assert tell(got) == want[0]
    assert "_bits" in got._jdf.queryExecution().optimizedPlan().toString()
    assert tell(before_image(rows, keys, "k", stored=True)) == want[1]


def test_cost_and_profit_are_taken_from_keyed_rows(spark, monkeypatch):
    row = ("select 1L date_key, 1L cashier_key, 1L product_key, 1L customer_key, 1L store_key, 1L invoice_key, 'I' invoice_number, "
           "3 sales_qty, cast(2.5 as decimal(18,2)) silver_unit_price_amount, cast(1.25 as decimal(18,2)) silver_unit_cost_amount, "
           "cast(7 as decimal(18,2)) silver_line_total_amount, 's' source_system, 10L silver_invoice_line_id")
    monkeypatch.setattr(facts, "sales_rows", lambda t, changed: spark.sql(row))
    kept = []
    real = facts.assign_keys
    monkeypatch.setattr(facts, "assign_keys", lambda df, *a: kept.extend(df.columns) or real(df, *a))
    r = facts.sales_fact({}, batch_id="b", run_ts="2002-01-01 08:00:00").first()
    assert "sales_cost" not in kept and "gross_profit" not in kept
    assert (str(r.unit_price), str(r.sales_cost), str(r.gross_profit), r.source_record_id) == ("2.50", "3.75", "3.25", "10")
