"""Masking of contact data for serving views."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_email(c: Column) -> Column:
    """First character and domain survive; missing or empty -> NULL."""
    masked = F.concat(F.left(c, F.lit(1)), F.lit("***@"), F.split_part(c, F.lit("@"), F.lit(2)))
    return F.when(c.isNull() | (c == ""), None).otherwise(F.left(masked, F.lit(120)))


def mask_phone(c: Column) -> Column:
    """Only the last four digits survive."""
    tail = F.right(F.regexp_replace(c, r"\D", ""), F.lit(4))
    return F.when(c.isNotNull(), F.concat(F.lit("***-***-"), tail))
