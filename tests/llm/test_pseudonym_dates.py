"""Dates of every layout are permuted among themselves; long secrets and mail names are covered whole."""

import pytest
from pyspark.sql import functions as F

from lakestrata.llm import pii


def all_days(spark):
    return spark.sql("SELECT explode(sequence(DATE'1900-01-01', DATE'2099-12-31', INTERVAL 1 DAY)) AS d")


@pytest.mark.parametrize("layouts", [["yyyy-MM-dd"], ["dd.MM.yyyy"], ["dd/MM/yyyy", "MM/dd/yyyy"]])
def test_no_two_dates_of_a_layout_meet(spark, layouts):
    days = all_days(spark)
    values = days.select(F.explode(F.array(*(F.date_format("d", f) for f in layouts))).alias("v")).distinct()
    new = values.select("v", pii.date(F.col("v"), "k").alias("w")).cache()
    n = new.count()
    assert n == (73_049 if len(layouts) == 1 else 117_298)
    assert new.select("w").distinct().count() == n
    # the images are the same strings, and hardly any stays as it is
    assert new.select("w").exceptAll(values).count() == 0
    assert new.where("v = w").count() < 30


def test_one_day_is_one_pseudonym_in_every_unambiguous_layout(spark):
    days = all_days(spark).where("day(d) > 12")
    back = [F.try_to_timestamp(pii.date(F.date_format("d", f), "k"), F.lit(f)).cast("date") for f in
            ("yyyy-MM-dd", "dd.MM.yyyy", "dd/MM/yyyy", "MM/dd/yyyy")]
    assert days.where((back[0] != back[1]) | (back[1] != back[2]) | (back[2] != back[3])).count() == 0


def test_invalid_dates_stay(spark):
    bad = ["2021-02-30", "29/02/1900", "31/04/2000", "13/13/2000", "2100-01-01", "00/01/2000", "31.06.1999", "1899-12-31"]
    rows = spark.createDataFrame([(v,) for v in bad], "v string")
    assert rows.where(pii.date(F.col("v"), "k") != F.col("v")).count() == 0


@pytest.mark.parametrize("n", [32, 33, 127, 128, 129, 130, 200, 1001])
def test_secrets_of_any_length(spark, n):
    text = ("0123456789abcdef" * 63)[:n]
    rows = spark.createDataFrame([(1, f"key {text}, upper {text.upper()} end"), (2, f"key {text[:-1]}{'0' if text[-1] != '0' else '1'} end")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.pseudonymize(rows).collect()}
    low, up = got[1].split()[1][:-1], got[1].split()[3]
    assert len(low) == n and low != text and up == low.upper() and text not in got[1]
    assert got[2].split()[1] != low


def test_long_mail_names(spark):
    name = "a." * 100 + "z"
    rows = spark.createDataFrame([(1, f"write to {name}@mail.example.com now")], "doc_id long, text string")
    got = pii.pseudonymize(rows).first()["text"]
    assert name not in got and got.endswith("@mail.example.com now")
