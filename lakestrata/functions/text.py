"""Text standardisation rules. All of them are built-in expressions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks the start of a word that follows punctuation; never present in clean text.
_WORD_MARK = "\u0001"


def clip(c: Column, n: int | None) -> Column:
    """Keep the first ``n`` characters (a bounded VARCHAR truncates, it does not fail)."""
    return c if n is None else F.left(c, F.lit(n))


def blank_to_null(c: Column) -> Column:
    """Trim; an empty result is missing."""
    return F.nullif(F.trim(c), F.lit(""))


def collapse(c: Column) -> Column:
    """Trim, squeeze inner white space to one blank, empty -> NULL."""
    return F.nullif(F.regexp_replace(F.trim(c), r"\s+", " "), F.lit(""))


def digits(c: Column) -> Column:
    """Keep digits only, empty -> NULL."""
    return F.nullif(F.regexp_replace(c, "[^0-9]", ""), F.lit(""))


def title_case(c: Column) -> Column:
    """Upper-case the first letter of every alphanumeric run, lower-case the rest.

    Spark's ``initcap`` only starts words at blanks, so a mark plus a blank is put
    before each run that follows punctuation, and taken out again afterwards.
    """
    marked = F.regexp_replace(c, r"(?<=[^\p{L}\p{N} ])(?=[\p{L}\p{N}])", f"{_WORD_MARK} ")
    return F.replace(F.initcap(marked), F.lit(f"{_WORD_MARK} "), F.lit(""))


def vocab(c: Column, allowed: tuple[str, ...]) -> Column:
    """Closed lower-case vocabulary; anything else becomes NULL."""
    v = F.lower(F.trim(c))
    return F.when(v.isin(*allowed), v)


def lower_code(c: Column) -> Column:
    return F.nullif(F.lower(F.trim(c)), F.lit(""))


def upper_code(c: Column) -> Column:
    return F.nullif(F.upper(F.trim(c)), F.lit(""))
