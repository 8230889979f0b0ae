"""Latest-version dedup, hash gate, upsert and replace-by-key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.hashing import digest
from ..session import stage
from .sieve import anti, semi

# newest first; the landing record id breaks every remaining tie
LATEST_ORDER = (
    ("updated_at_source_timestamp", True),
    ("created_at_source_timestamp", True),
    ("bronze_loaded_at_timestamp", False),
    ("bronze_record_id", False),
)
# more repeated keys than this aren't worth cutting out of a table
MOST_REPEATED = 1 << 20
# of a key's hash; in a thousand million keys half a million pairs differ and share these
SHORT = (1 << 40) - 1
HISTORY_ORDER = (
    ("changed_at_source_timestamp", True),
    ("bronze_loaded_at_timestamp", False),
    ("bronze_record_id", False),
)


def _newest_first(order) -> list[Column]:
    return [F.desc_nulls_last(c) if nulls_last else F.desc_nulls_first(c) for c, nulls_last in order]


def dedup_latest(df: DataFrame, keys: list[str], order=LATEST_ORDER) -> DataFrame:
    """One row per key. Spark limits each group before the shuffle, so hot keys stay small."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*_newest_first(order)))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def dedup_stored(df: DataFrame, keys: list[str], order=LATEST_ORDER, most: int = MOST_REPEATED) -> DataFrame:
    """``dedup_latest`` of stored rows: only the rows of keys that occur more than once are compared.

    The other rows stay where they are; to find them only five bytes of each key's hash are shuffled,
    and the keys themselves where such a value stands twice. With more than ``most`` repeated values
    all rows are compared, which then costs less than cutting them out.
    The result is ``df`` itself or staged, so that it may be read more than once as well.
    """
    short = F.xxhash64(*keys).bitwiseAND(F.lit(SHORT))
    count = F.count(F.lit(1)).alias("_n")
    alike = df.groupBy(short.alias("_short")).agg(count).where("_n > 1").select("_short")
    alike = stage(alike, "repeated-hashes")
    n = alike.limit(most + 1).count()
    if n == 0:
        return df
    if n > most:
        return stage(dedup_latest(df, keys, order), "newest", "zstd")
    suspects = df.select(*keys).join(alike, short == F.col("_short"), "left_semi").groupBy(*keys).agg(count)
    repeated = stage(suspects.where("_n > 1").select(*[F.col(k).alias(f"_r_{k}") for k in keys]), "repeated-keys")
    if repeated.isEmpty():
        return df
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    newest = dedup_latest(df.join(repeated, same, "left_semi"), keys, order)
    return stage(df.join(repeated, same, "left_anti").unionByName(newest), "newest", "zstd")


def hash_gate(
    rows: DataFrame, target: DataFrame | None, keys: list[str], hash_col: str, carry: tuple[str, ...] = (),
    narrow: bool = False,
) -> DataFrame:
    """Rows whose key is new or whose hash differs; ``carry`` columns keep the target's value.

    Only keys, hash (as 16 bytes) and carried columns of the target are read. ``narrow`` (for staged
    ``rows``) first cuts the target to the keys at hand with a semi join, which Spark
    broadcasts when the rows are few; of more rows a bitmap over their keys spares most of the
    target the shuffle.
    """
    if target is None:
        return rows
    t = target.select(*keys, hash_col, *carry)
    if narrow:
        t = semi(t, rows, keys)
    t = t.select(*[F.col(k).alias(f"_t_{k}") for k in (*keys, *carry)], digest(F.col(hash_col)).alias(f"_t_{hash_col}"))
    on = [F.col(k) == F.col(f"_t_{k}") for k in keys]
    changed = F.col(f"_t_{keys[0]}").isNull() | ~digest(F.col(hash_col)).eqNullSafe(F.col(f"_t_{hash_col}"))
    out = rows.join(t, on, "left").where(changed)
    for c in carry:
        out = out.withColumn(c, F.coalesce(F.col(f"_t_{c}"), F.col(c)))
    return out.select(rows.columns)


def upsert(
    target: DataFrame, changes: DataFrame, keys: list[str], preserve: tuple[str, ...] = (), stored: bool = False
) -> DataFrame:
    """Full new table: unmatched target rows plus every change row. ``stored`` changes may be read more than once."""
    kept = without(target, changes, keys, stored)
    if preserve:
        old = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in preserve])
        merged = changes.join(old, keys, "left")
        for c in preserve:
            merged = merged.withColumn(c, F.coalesce(F.col(f"_t_{c}"), F.col(c)))
        changes = merged
    return kept.unionByName(changes.select(target.columns))


def without(target: DataFrame, gone: DataFrame, keys: list[str], stored: bool = False) -> DataFrame:
    """Target rows whose key is not in ``gone``; of ``stored`` keys a bitmap spares most rows the join."""
    if stored:
        return anti(target, gone.select(*keys), keys)
    return target.join(gone.select(*keys), keys, "left_anti").select(target.columns)


def replace_keys(
    target: DataFrame, new: DataFrame, keys: list[str], removed: DataFrame | None = None, stored: bool = False
) -> DataFrame:
    """Delete every target row whose key is in ``new`` (or in ``removed``), then add ``new``.

    Passing the changed-key set as ``removed`` also deletes keys that lost all their rows.
    ``stored`` new rows and keys may be read more than once.
    """
    gone = new.select(*keys) if removed is None else new.select(*keys).unionByName(removed.select(*keys))
    return without(target, gone, keys, stored).unionByName(new.select(target.columns))


def append_once(target: DataFrame | None, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose load key (e.g. the snapshot date) is not in ``target`` yet."""
    if target is None:
        return new
    return new.join(target.select(*keys).distinct(), keys, "left_anti").select(new.columns)
