"""Landing rows of the star are stored as their source gave them; the rest follows when they are read."""

import pytest

from workload.star import PAYLOAD, Star, landed


def tell(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("target, wave", [("oltp_invoice_line", 1), ("oltp_customer", 2), ("econ_indicator", 1)])
def test_landing_rows_are_stored_without_their_hash(spark, sf, target, wave):
    s = Star(spark, sf)
    rows = s.landing(target, wave)
    stored = spark.read.parquet(*rows.inputFiles())
    assert "bronze_record_id" in stored.columns and "bronze_row_hash" not in stored.columns
    assert tell(rows) == tell(landed(spark, sf, target, wave).drop(PAYLOAD))
