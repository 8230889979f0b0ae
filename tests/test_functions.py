from pyspark.sql import functions as F

from lakestrata.functions import dates, hashing, masking, text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_text_rules(spark):
    lit = F.lit
    assert one(spark, text.title_case(text.collapse(lit("  MARIA   lopez ")))) == "Maria Lopez"
    assert one(spark, text.title_case(lit("O'NEIL mc-donald 3RD"))) == "O'Neil Mc-Donald 3rd"
    assert one(spark, text.title_case(lit("ÉLAN d'été"))) == "Élan D'Été"
    assert one(spark, text.digits(lit("(480) 863-7834"))) == "4808637834"
    assert one(spark, text.digits(lit("n/a"))) is None
    assert one(spark, text.lower_code(lit(" John@X.com "))) == "john@x.com"
    assert one(spark, text.collapse(lit("   "))) is None
    assert one(spark, text.vocab(lit(" PAID "), ("open", "paid"))) == "paid"
    assert one(spark, text.vocab(lit("weird"), ("open", "paid"))) is None
    assert one(spark, text.clip(lit("abcdef"), 3)) == "abc"


def test_masks(spark):
    assert one(spark, masking.mask_email(F.lit("alice@example.com"))) == "a***@example.com"
    assert one(spark, masking.mask_email(F.lit(""))) is None
    assert one(spark, masking.mask_email(F.lit("nobody"))) == "n***@"
    assert one(spark, masking.mask_phone(F.lit("4805551234"))) == "***-***-1234"
    assert one(spark, masking.mask_phone(F.lit(None).cast("string"))) is None


def test_row_hash_treats_null_and_empty_alike_but_landing_hash_does_not(spark):
    df = spark.createDataFrame([(1, None), (1, "")], "a int, b string")
    assert df.select(hashing.row_hash(["a", "b"]).alias("h")).distinct().count() == 1
    assert df.select(hashing.landing_hash(["a", "b"]).alias("h")).distinct().count() == 2


def test_month_key_of_unknown_member_is_zero(spark):
    assert one(spark, dates.month_of_key(F.lit(-1))) == 0
    assert one(spark, dates.month_of_key(F.lit(20240131))) == 202401


def test_previous_month_end(spark):
    for day, expected in (("2024-03-01", "2024-02-29"), ("2024-03-31", "2024-02-29"), ("2024-01-15", "2023-12-31")):
        assert str(one(spark, dates.previous_month_end(F.lit(day).cast("date")))) == expected


def test_calendar(spark):
    from lakestrata.operators.calendar import dim_date, role_view

    cal = dim_date(spark, "2024-01-01 00:00:00")
    assert cal.count() == 4019
    rows = {r["date_key"]: r for r in cal.where("date_key in (20240115, 20241128, 20240704, 20240706, -1)").collect()}
    assert rows[20240115]["holiday_indicator"] == "MLK Day"
    assert rows[20241128]["holiday_indicator"] == "Thanksgiving"
    assert rows[20240704]["calendar_week_ending_date"].isoformat() == "2024-07-06"
    assert rows[20240706]["calendar_week_ending_date"].isoformat() == "2024-07-06"
    assert rows[20240706]["weekday_indicator"] == "Weekend"
    assert rows[20240115]["full_date_description"] == "January 15, 2024"
    assert rows[20240115]["calendar_year_quarter"] == "2024-Q1"
    assert rows[-1]["date"].isoformat() == "1900-01-01"
    assert role_view(cal, "snapshot").columns[:2] == ["snapshot_date_key", "snapshot_date"]
