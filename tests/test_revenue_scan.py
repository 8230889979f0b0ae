"""Real revenue reads the fact once and keeps its base: the index of the newest month that has both."""

from lakestrata.plans.serving import revenue_real


def test_base_without_a_second_scan(spark):
    sales = spark.sql("select * from values (19990110, 10.00), (19990201, 5.00), (19990315, 7.00), (19990401, null), (-1, 3.00) "
                      "as t(date_key, amount)").selectExpr("date_key", "cast(amount as decimal(12,2)) sales_amount")
    econ = spark.sql("""select 'CPIAUCSL' silver_series_id, cast(d as date) silver_observation_date,
        cast(v as decimal(18,6)) silver_indicator_value
        from values ('1998-12-01', null), ('1999-01-01', 100), ('1999-02-01', 200), ('1999-03-01', null) as t(d, v)""")
    out = revenue_real(sales, econ)
    assert [(r.month_key, float(r.cpi_index), float(r.base_cpi), float(r.real_revenue)) for r in out.collect()] == [
        (199901, 100, 200, 20), (199902, 200, 200, 5), (199903, 200, 200, 7)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" not in plan and "scalar-subquery" not in plan
    assert revenue_real(sales.limit(0), econ).collect() == [] and revenue_real(sales, econ.limit(0)).collect() == []
