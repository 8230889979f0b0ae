"""Type 1 and Type 2 dimension maintenance."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import ts
from ..functions.hashing import digest
from ..session import by_count
from .keys import assign_keys, max_key
from .sieve import marked, possible

BEGINNING = "1900-01-01"  # first versions are valid from here


@dataclass(frozen=True)
class DimensionSpec:
    name: str
    key: str
    attributes: tuple[str, ...]
    # attribute values of the -1 member, as SQL literals
    unknown: tuple[str, ...]


META = (
    "record_hash", "source_system", "source_record_id", "etl_batch_id", "etl_load_timestamp",
    "etl_updated_timestamp", "valid_from", "valid_to", "is_current", "row_version", "is_complete",
    "is_validated", "dq_issue_flag", "dq_issue_description", "is_deleted", "deleted_timestamp",
)


def detect(
    staged: DataFrame, target: DataFrame | None, stored: bool = False, record_hash: Column | None = None
) -> DataFrame:
    """New or changed entities, with the row version they supersede (0 when new).

    Of ``stored`` staged rows, which may be fewer than the target's, a bitmap cuts the target to their ids.
    ``record_hash`` is given for staged rows that don't hold it.
    """
    own = F.col("record_hash") if record_hash is None else record_hash
    if target is None:
        return staged.withColumn("current_row_version", F.lit(0))
    current = target.where("is_current").select(
        F.col("source_record_id").alias("_id"), digest(F.col("record_hash")).alias("_hash"), "row_version"
    )
    if stored:
        ids = staged.select(F.col("source_record_id").alias("_id"))
        current = possible(current, ids, ["_id"])
    changed = F.col("_id").isNull() | ~digest(own).eqNullSafe(F.col("_hash"))
    return (
        staged.join(current, F.col("source_record_id") == F.col("_id"), "left")
        .where(changed)
        .withColumn("current_row_version", F.coalesce("row_version", F.lit(0)))
        .drop("_id", "_hash", "row_version")
    )


def effective_from(version: Column, updated: Column) -> Column:
    """Version 1 covers all earlier time; later versions start on the source change date."""
    return F.when(version == 1, F.lit(BEGINNING).cast("date")).otherwise(updated.cast("date"))


def new_versions(
    spec: DimensionSpec, staged: DataFrame, target: DataFrame | None, batch_id: str, run_ts: str,
    start: int | None = None, stored: bool = False, late: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Open version rows for every new or changed entity, keys continuing after the target's.

    ``start`` is the highest key in use, if the caller knows it. Staged rows sharing an id (a fan-out in a lookup) are ordered by their hash as well.
    ``late`` columns, the hash among them, follow from the staged ones: they are taken from the keyed
    rows, so that they are neither sorted nor stored with them.
    """
    own = late["record_hash"] if late else F.col("record_hash")
    changed = detect(staged, target, stored, own)
    if start is None:
        start = 0 if target is None else max_key(target, spec.key)
    keyed = assign_keys(changed, ["source_record_id", own], spec.key, start)
    if late:
        keyed = keyed.withColumns(dict(late))
    version = F.col("current_row_version") + 1
    return keyed.select(
        F.col(spec.key).cast("bigint").alias(spec.key),
        *spec.attributes,
        "record_hash",
        "source_system",
        "source_record_id",
        F.lit(batch_id).alias("etl_batch_id"),
        ts(run_ts).alias("etl_load_timestamp"),
        ts(run_ts).alias("etl_updated_timestamp"),
        effective_from(version, F.col("src_updated_at")).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
        version.cast("int").alias("row_version"),
        F.lit(True).alias("is_complete"),
        F.lit(False).alias("is_validated"),
        F.lit(False).alias("dq_issue_flag"),
        F.lit(None).cast("string").alias("dq_issue_description"),
        "is_deleted",
        F.lit(None).cast("timestamp_ntz").alias("deleted_timestamp"),
    )


def unknown_member(spec: DimensionSpec, like: DataFrame, run_ts: str) -> DataFrame:
    """The -1 'Not Provided' row, typed like the dimension it joins."""
    fixed = {
        spec.key: F.lit(-1),
        **{a: F.expr(v) for a, v in zip(spec.attributes, spec.unknown, strict=True)},
        "record_hash": F.lit(None),
        "source_system": F.lit("system"),
        "source_record_id": F.lit("-1"),
        "etl_batch_id": F.lit(None),
        "etl_load_timestamp": ts(run_ts),
        "etl_updated_timestamp": ts(run_ts),
        "valid_from": F.lit(BEGINNING),
        "valid_to": F.lit(None),
        "is_current": F.lit(True),
        "row_version": F.lit(1),
        "is_complete": F.lit(True),
        "is_validated": F.lit(False),
        "dq_issue_flag": F.lit(False),
        "dq_issue_description": F.lit(None),
        "is_deleted": F.lit(False),
        "deleted_timestamp": F.lit(None),
    }
    row = like.sparkSession.range(1)
    return row.select(*[fixed[f.name].cast(f.dataType).alias(f.name) for f in like.schema.fields])


def close_superseded(target: DataFrame, added: DataFrame, key: str, run_ts: str, rows: int | None = None) -> DataFrame:
    """End the open version of every entity that received the next row version; ``rows`` is the number added, if known."""
    successor = added.groupBy(
        F.col("source_record_id").alias("_id"), (F.col("row_version") - 1).alias("_ver")
    ).agg(F.min("valid_from").alias("_next_from"))
    if rows is not None:
        successor = by_count(successor, rows)
    on = [
        F.col("source_record_id") == F.col("_id"),
        F.col("row_version") == F.col("_ver"),
        F.col("is_current"),
        F.col(key) != -1,
    ]
    hit = F.col("_id").isNotNull()
    return (
        target.join(successor, on, "left")
        .withColumn("is_current", F.when(hit, F.lit(False)).otherwise(F.col("is_current")))
        .withColumn("valid_to", F.when(hit, F.col("_next_from")).otherwise(F.col("valid_to")))
        .withColumn("etl_updated_timestamp", F.when(hit, ts(run_ts)).otherwise(F.col("etl_updated_timestamp")))
        .select(target.columns)
    )


def scd2_apply(
    spec: DimensionSpec, staged: DataFrame, target: DataFrame | None, batch_id: str, run_ts: str, stored: bool = False,
    late: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The whole dimension after one load: old versions (closed where superseded) plus new ones.

    ``stored`` staged rows may be read more than once; entities that cannot have changed may be missing among them.
    ``late`` columns follow from the staged ones (``new_versions``).
    """
    added = new_versions(spec, staged, target, batch_id, run_ts, stored=stored, late=late)
    if target is None:
        return added.unionByName(unknown_member(spec, added, run_ts))
    n = added.count()  # new rows are a projection of written ones
    if stored:
        # most versions have no successor and stay out of the join
        ids = added.select("source_record_id")
        flagged = marked(target, ids, ["source_record_id"])
        if flagged is not None:
            rest = flagged.where("not _maybe").select(target.columns)
            closed = close_superseded(flagged.where("_maybe").select(target.columns), added, spec.key, run_ts, n)
            return rest.unionByName(closed).unionByName(added)
    return close_superseded(target, added, spec.key, run_ts, n).unionByName(added)


def scd1_apply(
    staged: DataFrame, target: DataFrame | None, natural: str, key: str, run_ts: str, unknown: dict[str, Column]
) -> DataFrame:
    """Type 1 rows to upsert: known natural keys keep their key, new ones continue after the highest."""
    if target is None:
        fresh, known, start = staged, None, 0
    else:
        old = target.select(natural, key)
        matched = staged.join(old, natural, "left")
        known = matched.where(F.col(key).isNotNull())
        fresh = matched.where(F.col(key).isNull()).drop(key)
        start = max_key(target, key)
    rows = assign_keys(fresh, [natural], key, start)
    if known is not None:
        rows = rows.unionByName(known)
    rows = rows.withColumn(key, F.col(key).cast("bigint"))
    member = rows.sparkSession.range(1).select(
        *[unknown[f.name].cast(f.dataType).alias(f.name) for f in rows.schema.fields]
    )
    stamped = rows.unionByName(member)
    return stamped.withColumn("etl_load_timestamp", ts(run_ts)).withColumn("etl_updated_timestamp", ts(run_ts))


def version_changes(dim: DataFrame, attributes: tuple[str, ...]) -> DataFrame:
    """Old -> new value of every attribute that changed between consecutive versions."""
    ident = ["source_record_id", "row_version"]
    prev = dim.select(
        F.col("source_record_id"), (F.col("row_version") + 1).alias("row_version"),
        *[F.col(a).alias(f"_old_{a}") for a in attributes],
    )
    pairs = dim.join(prev, ident)
    entries = F.array(
        *[
            F.struct(
                F.lit(a).alias("column_name"),
                F.col(f"_old_{a}").cast("string").alias("old_value"),
                F.col(a).cast("string").alias("new_value"),
            )
            for a in attributes
        ]
    )
    return (
        pairs.select(*ident, "valid_from", "etl_batch_id", F.inline(entries))
        .where(~F.col("old_value").eqNullSafe(F.col("new_value")))
    )
