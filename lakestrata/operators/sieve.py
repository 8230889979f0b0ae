"""A bitmap over a set of keys, by which rows that cannot hold one of them are told without a shuffle.

It only spares work: rows that may hold one go through an exact join, so the result is that join's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, StringType

from ..session import by_count, stage

FEW = 1 << 16  # a smaller set is broadcast in the join itself
BITS_PER_KEY = 16
MOST_BITS = 1 << 26  # 8 MB of bits; a larger set lets more rows through, never fewer
WORDS = 32  # 64-bit words of a row of the bitmap, which as a row each would take the driver many times their size
_MAYBE = "_maybe"


def marked(rows: DataFrame, keys: DataFrame, on: list[str], few: int = FEW) -> DataFrame | None:
    """``rows`` with a flag that is false where the key is not among ``keys``; None if a bitmap would not help.

    ``keys`` are stored rows, read once for their number and once for the bitmap. The bitmap is
    an aggregate of bounded size, so it may be broadcast.
    """
    kinds = [(rows.schema[c].dataType, keys.schema[c].dataType) for c in on]
    if any(a != b or not isinstance(a, (IntegralType, StringType, DateType)) for a, b in kinds):
        return None  # equal values of other types may have different hashes
    n = keys.count()
    if n < few:
        return None
    bits = min(max(n * BITS_PER_KEY, 64), MOST_BITS)
    place = f"pmod(xxhash64({', '.join(f'`{c}`' for c in on)}), {bits}L)"
    word, bit = f"shiftright({place}, 6)", F.expr(f"shiftleft(1L, cast({place} & 63 as int))")
    block, slot = F.expr(f"{word} div {WORDS}"), F.expr(f"cast(pmod({word}, {WORDS}L) as int)")
    words = keys.select(block.alias("_block"), slot.alias("_slot"), bit.alias("_bit")).groupBy("_block", "_slot")
    words = words.agg(F.bit_or("_bit").alias("_bits")).groupBy("_block")
    words = words.agg(F.map_from_entries(F.collect_list(F.struct("_slot", "_bits"))).alias("_words"))  # WORDS at most
    dense = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda i: F.coalesce(F.try_element_at("_words", i), F.lit(0)))
    blocks = F.broadcast(stage(words.select("_block", dense.alias("_bits")), "sieve"))
    maybe = F.coalesce(F.get("_bits", slot).bitwiseAND(bit) != 0, F.lit(False))
    return rows.join(blocks, block == F.col("_block"), "left").select(*rows.columns, maybe.alias(_MAYBE))


def possible(rows: DataFrame, keys: DataFrame, on: list[str], few: int = FEW) -> DataFrame:
    """``rows`` without most of those whose key is not among ``keys``; an exact join has to follow."""
    flagged = marked(rows, keys, on, few)
    return rows if flagged is None else flagged.where(_MAYBE).select(rows.columns)


def semi(rows: DataFrame, keys: DataFrame, on: list[str], few: int = FEW) -> DataFrame:
    """Rows whose key is among ``keys`` (stored rows)."""
    return possible(rows, keys, on, few).join(by_count(keys.select(*on)), on, "left_semi").select(rows.columns)


def anti(rows: DataFrame, keys: DataFrame, on: list[str], few: int = FEW) -> DataFrame:
    """Rows whose key is not among ``keys`` (stored rows); only those that may be there are joined."""
    flagged, exact = marked(rows, keys, on, few), by_count(keys.select(*on))
    if flagged is None:
        return rows.join(exact, on, "left_anti").select(rows.columns)
    checked = flagged.where(_MAYBE).join(exact, on, "left_anti")
    return flagged.where(~F.col(_MAYBE)).select(rows.columns).unionByName(checked.select(rows.columns))
