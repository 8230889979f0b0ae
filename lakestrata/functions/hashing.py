"""Change-detection hashes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _joined(cols: Iterable[str], missing: str = "") -> Column:
    """Text of the columns joined by '|', built as one expression string (wide tables, one call)."""
    parts = ", ".join(f"coalesce(cast({c} as string), '{missing}')" for c in cols)
    return F.expr(f"concat_ws('|', {parts})")


def row_hash(cols: Iterable[str]) -> Column:
    """MD5 over the cleaned business columns, in order; NULL and '' count as equal."""
    return F.md5(_joined(cols))


def record_hash(cols: Iterable[str]) -> Column:
    """SHA-256 over the tracked attributes of a dimension version."""
    return F.sha2(_joined(cols), 256)


def landing_hash(cols: Iterable[str]) -> Column:
    """MD5 over raw business columns in column-name order; NULL is a distinct value."""
    return F.md5(_joined(sorted(cols), missing="None"))


def digest(value: Column) -> Column:
    """A change hash as 16 bytes: hashes that are only compared travel at a quarter or half of their text."""
    return F.unhex(F.md5(value))
