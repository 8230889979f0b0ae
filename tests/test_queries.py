"""Registered queries against their SQL on the smallest data (the full set: check_queries.py)."""

import pytest

import __spark_entry__ as entry
from check_queries import compare, connect
from workload import catalogue

NAMES = ["slv_customer", "slv_hash_gate", "dim_customer", "fct_replace_by_invoice", "fct_payments_refund_chain",
         "fct_change_log", "bi_revenue_real", "qry_profit_by_month", "dq_scd2_overlap", "dq_batch_rules"]


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, sf, con, name):
    ok, text = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), sf)
    assert ok, text


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(catalogue.QUERIES) > 120


def test_entry(spark):
    assert entry.entry(spark).count() > 0
