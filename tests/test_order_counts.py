"""Orders of few groups are counted apart from the sums, so that no sums travel with the (group, invoice) pairs."""

import re

from pyspark.sql import functions as F

from lakestrata.plans import metrics


def tell(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def sales(spark):
    return spark.range(300).selectExpr(
        "if(id % 11 = 0, null, 'I' || id % 40) invoice_number", "if(id % 5 = 0, null, id % 5) product_key",
        "if(id % 7 = 0, null, 'g' || id % 3) grp", "cast(id as int) sales_qty",
        *[f"cast(if(id % 13 = 0, null, id * {n}) as decimal(12,2)) {c}"
          for n, c in ((3, "sales_amount"), (2, "sales_cost"), (1, "gross_profit"))])


def test_few_groups_have_the_same_measures(spark):
    rows = sales(spark)
    for by in (["grp"], ["grp", "product_key"]):
        assert tell(metrics.sales_kpis(rows, by, few=True)) == tell(metrics.sales_kpis(rows, by))
    assert tell(metrics.sales_kpis(rows)) == tell(metrics.sales_kpis(rows.withColumn("one", F.lit(1)), ["one"]).drop("one"))
    assert [r.order_count for r in metrics.sales_kpis(rows.limit(0)).collect()] == [0]
    assert tell(metrics.sales_kpis(rows.limit(0), ["grp"], few=True)) == []


def test_pairs_travel_without_sums(spark):
    dim = spark.range(5).selectExpr("id product_key", "'d' || id % 2 label")
    plan = metrics.sales_by(sales(spark), dim, "product_key", "label")._jdf.queryExecution().executedPlan().toString()
    pairs = [line for line in plan.split("\n") if re.search(r"Exchange hashpartitioning\(_?label#\d+, invoice_number#", line)]
    aggregates = [line for line in plan.split("\n") if re.search(r"HashAggregate\(keys=\[_?label#\d+, invoice_number#", line)]
    assert pairs and aggregates and not any("sum(" in line for line in aggregates)
