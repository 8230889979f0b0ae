"""Table contracts: exact columns and types, required columns, key; and how a schema may drift."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ContractError(ValueError):
    pass


# -- drift of schemas -------------------------------------------------------------
WIDENED, NARROWED, CHANGED, ADDED, REMOVED, MOVED = "widened", "narrowed", "changed", "added", "removed", "moved"
# Types that hold all values of a smaller one and that Parquet files of the smaller one can be read as.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"),
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}
# decimal digits that every whole number fits as Parquet holds it, in 32 or 64 bits
DIGITS = {"tinyint": 10, "smallint": 10, "int": 10, "bigint": 20}


@dataclass(frozen=True)
class Drift:
    """One difference between two schemas; fields within structs, arrays and maps are named by their path."""

    path: str
    kind: str
    old: str | None
    new: str | None

    def __str__(self) -> str:
        return f"{self.path} {self.kind}: {self.old} -> {self.new}"


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of ``old`` is a value of the different type ``new``, in files as well."""
    if isinstance(new, T.DecimalType):
        whole, scale = new.precision - new.scale, new.scale
        if isinstance(old, T.DecimalType):
            return whole >= old.precision - old.scale and scale >= old.scale
        return whole >= DIGITS.get(old.simpleString(), whole + 1)
    return new.simpleString() in WIDER.get(old.simpleString(), ())


def drift(old: T.DataType, new: T.DataType, path: str = "") -> Iterator[Drift]:
    """The differences of two types, down to nested fields; a schema is a struct.

    Whether values may be missing isn't compared: Spark calls most computed columns nullable
    though no value is missing, so required columns are judged by their values.
    """
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        before, after = ({f.name: f.dataType for f in s.fields} for s in (old, new))
        at = {n: f"{path}.{n}" if path else n for n in before | after}
        for name in before:
            if name in after:
                yield from drift(before[name], after[name], at[name])
            else:
                yield Drift(at[name], REMOVED, before[name].simpleString(), None)
        for name in after:
            if name not in before:
                yield Drift(at[name], ADDED, None, after[name].simpleString())
        if list(before) != list(after) and set(before) == set(after):
            yield Drift(path or "columns", MOVED, ",".join(before), ",".join(after))
    elif isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        yield from drift(old.elementType, new.elementType, f"{path}.element")
    elif isinstance(old, T.MapType) and isinstance(new, T.MapType):
        yield from drift(old.keyType, new.keyType, f"{path}.key")
        yield from drift(old.valueType, new.valueType, f"{path}.value")
    elif old != new:
        kind = WIDENED if widens(old, new) else NARROWED if widens(new, old) else CHANGED
        yield Drift(path, kind, old.simpleString(), new.simpleString())


def admit(name: str, old: T.StructType, new: T.StructType) -> T.StructType:
    """The schema of a table after rows of ``new`` join those of ``old``: widened types are accepted, all else raises."""
    found = list(drift(old, new))
    broken = [str(d) for d in found if d.kind != WIDENED]
    if broken:
        raise ContractError(f"schema drift on {name}: {'; '.join(broken)}")
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in new.fields]) if found else old


# -- whole tables -------------------------------------------------------------------
def check_shape(df: DataFrame, schema: T.StructType) -> None:
    """Fail on any drift in names, order or types."""
    have = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    if have != want:
        drift = [f"{h} instead of {w}" for h, w in zip(have, want) if h != w]
        raise ContractError(f"schema drift: {drift or (have, want)}")


def violations(df: DataFrame, required: list[str], key: list[str]) -> DataFrame:
    """Broken rules with their row counts: missing required values, duplicated key."""
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    missing = nulls.unpivot([], required, "rule", "n").withColumn("rule", F.concat(F.lit("null "), "rule"))
    twice = df.groupBy(*key).agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    duplicated = twice.agg(F.count(F.lit(1)).alias("n")).select(F.lit("duplicate key").alias("rule"), "n")
    return missing.unionByName(duplicated).where("n > 0")


def enforce_contract(df: DataFrame, schema: T.StructType, required: list[str], key: list[str]) -> DataFrame:
    """Return ``df`` unchanged if it satisfies the contract, else raise."""
    check_shape(df, schema)
    broken = violations(df, required, key).collect()  # at most one row per rule
    if broken:
        raise ContractError("; ".join(f"{r['rule']}: {r['n']} rows" for r in broken))
    return df
