"""Checks on what changed find what checks on whole tables find."""

from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.operators import quality as dq
from lakestrata.operators.incremental import Change, Summary, reconcile_delta, relationships_delta, unique_delta
from lakestrata.operators.merge import without
from lakestrata.plans.gate import Gate
from lakestrata.plans.run import ChecksFailed
from lakestrata.plans.suite import suite_rules
from lakestrata.sources.store import TableStore
from workload import warehouse as w

BUCKETS = {"silver.invoice": 3, "silver.invoice_line": 4, "silver.payment": 2, "gold.fact_retail_sales": 4, "gold.dim_invoice": 3,
           "gold.fact_payments": 3}


def rows(spark, pairs):
    return spark.createDataFrame([(int(k), int(v)) for k, v in pairs], "k int, v int")


@pytest.mark.parametrize("seed", range(4))
def test_random_changes(spark, seed):
    rng = np.random.default_rng(seed)
    parents = rng.permutation(40)
    kept_p, gone_p, new_p = parents[:20], parents[20:30], np.concatenate([parents[20:27], parents[30:33]])
    keys = rng.permutation(200)
    child = [(k, rng.choice(parents[:30])) for k in keys[:100]]
    kept, gone = child[:70], child[70:]
    back = gone[:20] + [(k, rng.choice(parents)) for k in keys[95:115]] + ([(keys[0], 1)] if seed % 2 else [])
    c = Change.of(rows(spark, back), rows(spark, gone), rows(spark, kept))
    p = Change.of(rows(spark, [(x, 0) for x in new_p]), rows(spark, [(x, 0) for x in gone_p]), rows(spark, [(x, 0) for x in kept_p]))
    assert sorted(unique_delta(c, ["k"]).collect()) == sorted(dq.unique(c.current, ["k"]).collect())
    got = relationships_delta(c, "v", p, "k")
    assert sorted(got.collect()) == sorted(dq.relationships(c.current, "v", p.current, "k").collect())


def test_nothing_changed(spark):
    same = Change.of(None, None, rows(spark, [(1, 1)]))
    assert unique_delta(same, ["k"]).count() == 0 and relationships_delta(same, "v", same, "k").count() == 0


def test_summaries_add_up():
    a, b = Summary(2, Decimal("1.10"), 3, 9), Summary(1, Decimal("-0.10"), 1, 1)
    assert a + b == Summary(3, Decimal("1.00"), 1, 9) and Summary() + a == a
    assert reconcile_delta([a, b], [Summary(3, Decimal("1.00"))]) is None
    assert reconcile_delta([a], [b])["total_diff"] == Decimal("1.20")


@pytest.fixture(scope="module")
def warehouse(spark, sf, tmp_path_factory):
    store = TableStore(spark, str(tmp_path_factory.mktemp("gate")), BUCKETS)
    for wave, ts in ((1, w.RUN_1), (2, w.RUN_2)):
        w.new_run(store, ts).execute(w.sources(spark, sf, wave), w.documents(spark, sf))
    return store


def gate(store, today="2002-01-01"):
    run = w.new_run(store, w.RUN_2)
    t = run.tables()
    places = {n: "gold" if n.startswith(("dim_", "fact_")) else "silver" for n in t}
    return Gate(store, suite_rules(today), places), t


def whole(store, today="2002-01-01"):
    """The failing checks over whole tables."""
    _, t = gate(store)
    found = dq.run_checks({n: (lambda r=r: r.full(t)) for n, r in suite_rules(today).items()})
    return {f.check: f.rows for f in found}


def scans(plan):
    return [f for frame in (plan.whole | plan.changed).values() for f in frame().inputFiles()]


def test_recorded_outcomes_equal_whole_checks(warehouse):
    g, _ = gate(warehouse)
    assert {c: o["rows"] for c, o in g.outcomes.items() if o["rows"]} == whole(warehouse)


def test_a_run_without_changes_reads_no_fact(spark, sf, warehouse):
    report = w.new_run(warehouse, "2002-01-03 08:00:00").execute(w.sources(spark, sf, 2), w.documents(spark, sf))
    assert sum(report.merged.values()) == 0
    g, t = gate(warehouse, "2002-01-03")
    plan = g.plan(t)
    assert not plan.whole and not plan.changed
    assert {f.check: f.rows for f in report.failures} == {c: n for c, n in plan.stands.items() if n}
    day_after, t = gate(warehouse, "2002-01-04")
    plan = day_after.plan(t)
    assert set(plan.whole) == {"series fresh"}
    assert not [f for f in scans(plan) if "fact_" in f]


def test_a_rebuilt_calendar_reads_no_fact(warehouse):
    warehouse.overwrite("gold", "dim_date", warehouse.read("gold", "dim_date"))
    g, t = gate(warehouse, "2002-01-03")
    plan = g.plan(t)
    assert "relationship fact_retail_sales.date_key" in plan.changed
    assert not [f for f in scans(plan) if "fact_" in f]
    assert {f.check for f in g.run(t)} == set(whole(warehouse, "2002-01-03"))


def test_a_broken_row_in_one_bucket_is_found(spark, sf, warehouse):
    before = set(whole(warehouse, "2002-01-03"))
    fact = warehouse.read("gold", "fact_payments")
    one = fact.orderBy("payment_key").limit(1)
    bad = one.withColumns({"store_key": F.lit(987654).cast(fact.schema["store_key"].dataType),
                           "payment_amount": (F.col("payment_amount") + 1).cast(fact.schema["payment_amount"].dataType)})
    other = fact.orderBy(F.desc("payment_key")).limit(1).select("payment_key").first()[0]
    bad = bad.withColumn("payment_key", F.lit(other).cast("bigint"))
    keys = ["source_record_id"]
    warehouse.rewrite("gold", "fact_payments", one, lambda old: without(old, one, keys), bad)
    g, t = gate(warehouse, "2002-01-03")
    plan = g.plan(t)
    assert {"unique fact_payments", "relationship fact_payments.store_key"} <= set(plan.changed)
    files = [f for f in plan.changed["columns fact_payments"]().inputFiles()]
    assert files and len({f.rsplit("/", 2)[1] for f in files}) == 1  # one bucket
    new = {"unique fact_payments", "relationship fact_payments.store_key", "payments reconcile"}
    run = w.new_run(warehouse, "2002-01-03 08:00:00")
    with pytest.raises(ChecksFailed) as err:
        run.execute(w.sources(spark, sf, 2), w.documents(spark, sf))
    assert new <= {f.check for f in err.value.report.failures}
    assert set(whole(warehouse, "2002-01-03")) == before | new
    assert run.ledger.frame().where("batch_status = 'failed'").count() == 4


def test_a_lost_record_means_whole_checks(warehouse):
    for n in warehouse.files.names(f"{warehouse.root}/audit/check_record"):
        warehouse.files.delete(f"{warehouse.root}/audit/check_record/{n}")
    g, t = gate(warehouse, "2002-01-03")
    plan = g.plan(t)
    assert len(plan.whole) + 2 == len(g.rules) and not plan.changed
