"""Versioned Parquet tables with atomic commits.

No transactional table format is on the class path, so a table is a folder of
immutable data folders plus one small JSON manifest per version. Creating manifest
``n+1`` is the commit: readers see the old version or the new one, never a mix, and
a failed load leaves only unreferenced files. Keyed tables are hash-bucketed on their
key and a change rewrites only the buckets it touches; every other bucket is carried
over by reference. A table with a period (the month or day of a date key) has a folder for each
period and bucket: a change rewrites only the folders that hold its keys and those of its new
rows, and readers of a few periods open no others. Old versions stay readable, which is also what supplies before
images and snapshots.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.intervals import Intervals
from ..operators.contract import ContractError, admit
from ..session import observed
from .files import Files

BUCKET, PERIOD, REPLACED = "_bucket", "_period", "_replaced"
#: Tables are as large as their sources and written more than once; readers go by the file.
CODEC = "zstd"
#: A part's folder within the path of one of its files.
PART = r"/(data/[^/]+(?:/_[a-z]+=[^/]+)*)/[^/]+$"


def part_file() -> Column:
    """The part that a row was read from."""
    return F.regexp_extract(F.col("_metadata.file_path"), PART, 1)


def period_of(folder: str) -> int | None:
    """The period of a part's folder; None for a table without periods and for rows without a date."""
    found = re.search(rf"/{PERIOD}=(-?\d+)(?:/|$)", folder)
    return int(found[1]) if found else None


@dataclass
class Manifest:
    version: int
    schema: T.StructType
    keys: list[str] = field(default_factory=list)
    buckets: int = 1
    # [date key column, divisor that makes it a period], if rows are kept by period
    period: list | None = None
    # [folder, bucket or None] pairs, relative to the table folder
    parts: list[list] = field(default_factory=list)
    meta: dict = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(
            {
                "version": self.version,
                "schema": self.schema.jsonValue(),
                "keys": self.keys,
                "buckets": self.buckets,
                "period": self.period,
                "parts": self.parts,
                "meta": self.meta,
            }
        )

    @staticmethod
    def from_json(text: str) -> Manifest:
        d = json.loads(text)
        d["schema"] = T.StructType.fromJson(d["schema"])
        return Manifest(**d)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


class TableStore:
    """Tables addressed as (layer, table) below one shared root folder."""

    def __init__(
        self, spark: SparkSession, root: str, buckets: dict[str, int] | None = None,
        tracked: dict[str, str] | None = None, periods: dict[str, tuple[str, int]] | None = None,
        required: dict[str, list[str]] | None = None,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = Files(spark, self.root)
        # buckets per "layer.table"; sized so that one bucket fits an executor comfortably
        self.bucket_plan = dict(buckets or {})
        # a committed version never changes, so its read plan (and file listing) is kept
        self._plans: dict[tuple[str, str, int], DataFrame] = {}
        # column per "layer.table" whose highest value is kept in the manifest (surrogate keys)
        self.tracked = dict(tracked or {})
        # date key column and divisor per "layer.table": 100 keeps a key of the form yyyymmdd by month, 1 by day;
        # it holds for tables built from then on
        self.period_plan = dict(periods or {})
        # columns per "layer.table" in which no written row may miss a value; tracked ones are required as well
        self.required = dict(required or {})

    # -- layout ---------------------------------------------------------------
    def _dir(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def versions(self, layer: str, table: str) -> list[int]:
        names = self.files.names(f"{self._dir(layer, table)}/_versions")
        return [int(n[1:9]) for n in names if n.startswith("v") and n.endswith(".json")]

    def exists(self, layer: str, table: str) -> bool:
        return bool(self.versions(layer, table))

    def manifest(self, layer: str, table: str, version: int | None = None) -> Manifest | None:
        if version is None:
            found = self.versions(layer, table)
            if not found:
                return None
            version = found[-1]
        text = self.files.read_text(f"{self._dir(layer, table)}/_versions/v{version:08d}.json")
        return Manifest.from_json(text)

    def _commit(self, layer: str, table: str, manifest: Manifest) -> Manifest:
        path = f"{self._dir(layer, table)}/_versions/v{manifest.version:08d}.json"
        self.files.create_text(path, manifest.to_json())
        return manifest

    # -- reading --------------------------------------------------------------
    def _read_parts(self, layer: str, table: str, m: Manifest, parts: list[list]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], m.schema)
        base = self._dir(layer, table)
        return self.spark.read.schema(m.schema).parquet(*[f"{base}/{folder}" for folder, _ in parts])

    def read(self, layer: str, table: str, version: int | None = None) -> DataFrame:
        found = self.versions(layer, table)
        if not found:
            raise FileNotFoundError(f"{layer}.{table} has no committed version")
        at = (layer, table, version or found[-1])
        if at not in self._plans:
            m = self.manifest(*at)
            self._plans[at] = self._read_parts(layer, table, m, m.parts)
        return self._plans[at]

    def read_parts(self, layer: str, table: str, parts: list[list], of: Manifest | None = None) -> DataFrame:
        """Rows of some parts, of the newest version or of the one that ``of`` describes."""
        return self._read_parts(layer, table, of or self.manifest(layer, table), parts)

    def periods(self, layer: str, table: str) -> list[int]:
        """The periods that the newest version holds, in order, from its folders alone."""
        m = self.manifest(layer, table)
        return sorted({period_of(p[0]) for p in m.parts} - {None}) if m else []

    def read_periods(self, layer: str, table: str, low: int, high: int | None = None) -> DataFrame:
        """Rows of the periods from ``low`` to ``high`` (else of that one); no other folder is opened."""
        m = self.manifest(layer, table)
        if m.period is None:
            raise ValueError(f"{layer}.{table} isn't kept by period")
        wanted = range(low, (low if high is None else high) + 1)
        return self._read_parts(layer, table, m, [p for p in m.parts if period_of(p[0]) in wanted])

    def read_newest(self, layer: str, table: str) -> DataFrame:
        """Rows of the newest period, as a snapshot table's last snapshot."""
        found = self.periods(layer, table)
        if not found:
            return self.read(layer, table).limit(0)
        return self.read_periods(layer, table, found[-1])

    def read_since(self, layer: str, table: str, batch: int) -> DataFrame | None:
        """Rows of appended batches above ``batch`` (None if there are none); older ones are not opened."""
        m = self.manifest(layer, table)
        if m is None:
            raise FileNotFoundError(f"{layer}.{table} has no committed version")
        ids = m.meta.get("batches", {})
        live = [p for p in m.parts if ids.get(p[0]) is None or ids[p[0]] > batch]
        if not live:
            return None
        return self._read_parts(layer, table, m, live)

    def batches(self, layer: str, table: str) -> list[int]:
        """The numbers of the appended batches, in order."""
        m = self.manifest(layer, table)
        return sorted(set(m.meta.get("batches", {}).values())) if m else []

    def newest_value(self, layer: str, table: str, column: str) -> DataFrame:
        """The highest value of a column that grows with the batches, from the folders of the last and the latest one."""
        m = self.manifest(layer, table)
        if m is None or not m.parts:
            return self.spark.createDataFrame([(None,)], f"{column} {m.schema[column].dataType.simpleString() if m else 'void'}")
        ids = m.meta.get("batches", {})
        last = {ids.get(m.parts[-1][0]), max(ids.values(), default=None)}
        wanted = [p for p in m.parts if ids.get(p[0]) in last or p[0] == m.parts[-1][0]]
        return self._read_parts(layer, table, m, wanted).agg(F.max(column).alias(column))

    def read_unmerged(self, layer: str, table: str, merged: Intervals) -> DataFrame | None:
        """Rows of appended batches outside a set (None if there are none); folders without a number always count."""
        m = self.manifest(layer, table)
        if m is None:
            raise FileNotFoundError(f"{layer}.{table} has no committed version")
        ids = m.meta.get("batches", {})
        live = [p for p in m.parts if ids.get(p[0]) is None or ids[p[0]] not in merged]
        return self._read_parts(layer, table, m, live) if live else None

    def view(self, layer: str, table: str, name: str | None = None) -> str:
        name = name or f"{layer}_{table}"
        self.read(layer, table).createOrReplaceTempView(name)
        return name

    # -- writing --------------------------------------------------------------
    @staticmethod
    def _places(keys: list[str], buckets: int, period: list | None) -> dict[str, Column]:
        """What names the folder of a row: its period and its bucket, as far as the table has them."""
        out = {}
        if period:
            out[PERIOD] = F.floor(F.col(period[0]) / F.lit(period[1])).cast("bigint")
        if buckets > 1:
            out[BUCKET] = F.pmod(F.hash(*keys), F.lit(buckets))
        return out

    def _leaves(self, path: str, depth: int) -> list[str]:
        """The folders ``depth`` levels below a path, relative to it."""
        names = [n for n in self.files.names(path) if n.startswith("_") and "=" in n]
        if depth == 1:
            return names
        return [f"{n}/{leaf}" for n in names for leaf in self._leaves(f"{path}/{n}", depth - 1)]

    def _write(
        self, layer: str, table: str, new: DataFrame, keys: list[str], buckets: int, kept: DataFrame | None = None,
        period: list | None = None,
    ) -> tuple[list[list], dict]:
        """Write rows to a fresh folder; returns its parts and what was seen while writing.

        New rows are grouped by period and bucket (a hot one is split over several tasks); kept
        rows come from files that hold one of them each, so they are not shuffled again.
        """
        folder = f"data/{uuid.uuid4().hex}"
        path = f"{self._dir(layer, table)}/{folder}"
        tracked = self.tracked.get(f"{layer}.{table}")
        top = F.max(tracked) if tracked else F.max(F.lit(None).cast("bigint"))
        needed = sorted({*self.required.get(f"{layer}.{table}", ()), *([tracked] if tracked else [])} & set(new.columns))
        seen = Observation()
        new = new.observe(seen, F.count(F.lit(1)).alias("rows"), top.cast("bigint").alias("top"),
                          *[F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in needed])
        places = self._places(keys, buckets, period)
        if not places:
            rows = new if kept is None else kept.unionByName(new)
            rows.write.parquet(path, compression=CODEC)
            parts = [[folder, None]]
        else:
            rows = new.withColumns(places).hint("rebalance", *places)
            if kept is not None:
                rows = kept.withColumns(places).unionByName(rows)
            rows.write.partitionBy(*places).parquet(path, compression=CODEC)
            parts = [[f"{folder}/{n}", self._bucket_of(n)] for n in self._leaves(path, len(places))]
        found = observed(seen, rows=0, top=None, **{f"null {c}": 0 for c in needed})
        broken = [f"{c} is missing in {found[f'null {c}']} rows" for c in needed if found[f"null {c}"]]
        if broken:
            self.files.delete(path)
            raise ContractError(f"contract of {layer}.{table}: {'; '.join(broken)}")
        return parts, found

    @staticmethod
    def _bucket_of(folder: str) -> int | None:
        found = re.search(rf"(?:^|/){BUCKET}=(\d+)(?:/|$)", folder)
        return int(found[1]) if found else None

    def _next(self, layer: str, table: str) -> int:
        found = self.versions(layer, table)
        return (found[-1] + 1) if found else 1

    @staticmethod
    def _with_top(meta: dict, top: int | None) -> dict:
        return meta if top is None else {**meta, "top": max(top, meta.get("top", 0))}

    def top(self, layer: str, table: str) -> int:
        """Highest value ever written to the tracked column, without reading the table."""
        m = self.manifest(layer, table)
        return 0 if m is None else m.meta.get("top", 0)

    def append(self, layer: str, table: str, df: DataFrame, batch: int | None = None,
               approve: Callable[[int, DataFrame], int] | None = None) -> int:
        """Add one immutable folder of rows; an empty one only creates the table. Returns the row count.

        ``approve`` is called with the number of rows and the rows as written, before they are
        committed: it gives the number that counts, or raises and the rows are gone.
        """
        old = self.manifest(layer, table)
        schema = admit(f"{layer}.{table}", old.schema, df.schema) if old else _nullable(df.schema)
        period = old.period if old else self._period_plan(layer, table)
        parts, seen = self._write(layer, table, df, [], 1, period=period)
        if approve is not None:
            of = Manifest(0, schema)
            try:
                seen = {**seen, "rows": approve(seen["rows"], self._read_parts(layer, table, of, parts))}
            except Exception:
                for folder in {"/".join(p[0].split("/")[:2]) for p in parts}:
                    self.files.delete(f"{self._dir(layer, table)}/{folder}")
                raise
        meta = self._with_top(dict(old.meta) if old else {}, seen["top"])
        if seen["rows"] == 0:
            if old is None:
                self._commit(layer, table, Manifest(1, schema, period=period, meta=meta))
            return 0
        if batch is not None:
            meta["batches"] = meta.get("batches", {}) | {folder: batch for folder, _ in parts}
        self._commit(layer, table, Manifest(self._next(layer, table), schema, [], 1, period,
                                            (old.parts if old else []) + parts, meta))
        return seen["rows"]

    def _period_plan(self, layer: str, table: str) -> list | None:
        plan = self.period_plan.get(f"{layer}.{table}")
        return list(plan) if plan else None

    def note(self, layer: str, table: str, **facts) -> None:
        """Record facts about a table in a new version of the same parts."""
        m = self.manifest(layer, table)
        self._commit(layer, table, replace(m, version=self._next(layer, table), meta={**m.meta, **facts}))

    def overwrite(self, layer: str, table: str, df: DataFrame, keys: list[str] | None = None, note: dict | None = None) -> int:
        """Replace the whole table (first build or full rebuild); returns the row count. ``note`` is committed with it."""
        keys = list(keys or [])
        buckets = self.bucket_plan.get(f"{layer}.{table}", 1) if keys else 1
        period = self._period_plan(layer, table)
        parts, seen = self._write(layer, table, df, keys, buckets, period=period)
        meta = self._with_top(dict(note or {}), seen["top"])
        self._commit(layer, table, Manifest(self._next(layer, table), _nullable(df.schema), keys, buckets, period,
                                            parts, meta))
        return seen["rows"]

    def rewrite(
        self,
        layer: str,
        table: str,
        touched: DataFrame,
        keep: Callable[[DataFrame], DataFrame],
        new: DataFrame,
        note: dict | None = None,
    ) -> int:
        """Replace the folders that hold the keys in ``touched``; returns the number of new rows.

        Without periods these are the keys' buckets. With periods the stored rows of the keys are
        looked up in their buckets, reading the keys alone: the folders they stand in are replaced,
        and those of the same period and bucket as a new row. A row that moves to another period
        so leaves its old folder, and periods without a change are neither read whole nor written.

        ``keep`` maps the current rows of those buckets to the ones that stay, row by row
        (it may join, but not regroup them); ``new`` rows are added and the facts of ``note``
        recorded in the same commit. Only numbers of buckets and names of folders, which the
        manifest holds as well, come to the driver.
        """
        old = self.manifest(layer, table)
        columns = [f.name for f in old.schema]
        new = new.select(columns)
        # kept rows are read with the types of the new ones if those are wider
        old = replace(old, schema=admit(f"{layer}.{table}", old.schema, new.schema))
        if old.buckets == 1:
            current = self._read_parts(layer, table, old, old.parts)
            others: list[list] = []
        else:
            number = F.pmod(F.hash(*old.keys), F.lit(old.buckets)).alias(BUCKET)
            hit = {r[0] for r in touched.select(number).distinct().collect()}
            if not hit:
                return 0
            current = self._read_parts(layer, table, old, [p for p in old.parts if p[1] in hit])
            others = [p for p in old.parts if p[1] not in hit]
        if old.period:
            gone = self._replaced(old, touched, new, current)
            others = [p for p in old.parts if p[0] not in gone]
            current = self._read_parts(layer, table, old, [p for p in old.parts if p[0] in gone])
        parts, seen = self._write(layer, table, new, old.keys, old.buckets,
                                  keep(current).select(columns), old.period)
        meta = self._with_top(dict(old.meta) | (note or {}), seen["top"])
        self._commit(layer, table, Manifest(self._next(layer, table), old.schema, old.keys, old.buckets, old.period,
                                            others + parts, meta))
        return seen["rows"]

    def _replaced(self, m: Manifest, touched: DataFrame, new: DataFrame, current: DataFrame) -> set[str]:
        """The folders of a table by period that hold touched keys, or share period and bucket with a new row."""
        keys = touched.select(*m.keys).distinct()
        held = current.select(*m.keys, part_file().alias("part")).join(keys, m.keys, "left_semi")
        gone = {r[0] for r in held.select("part").distinct().collect()}
        places = self._places(m.keys, m.buckets, m.period)
        taken = {(r[PERIOD], r[BUCKET] if m.buckets > 1 else None)
                 for r in new.select(*[c.alias(n) for n, c in places.items()]).distinct().collect()}
        return gone | {p[0] for p in m.parts if (period_of(p[0]), p[1]) in taken}

    def erase(self, layer: str, table: str, column: str, subjects: DataFrame) -> int:
        """Rewrite the folders that hold rows of the given ids; returns how many folders that were.

        One distributed pass finds the folders with hits, one job writes the rows that stay of all
        of them, each to a folder of its own below the same period and bucket. Only names of
        folders, which the manifest holds as well, come to the driver. Batch numbers of appended
        folders move to their replacements; a folder that loses all its rows has none.
        """
        old = self.manifest(layer, table)
        ids = subjects.select(F.col("subject_id").alias("_sid")).where("_sid is not null").distinct()
        match = F.col(column).cast("string") == F.col("_sid")
        found = self._read_parts(layer, table, old, old.parts).select(column, part_file().alias("part"))
        hit = {r[0] for r in found.join(ids, match, "left_semi").select("part").distinct().collect()}
        if not hit:
            return 0
        going = [p for p in old.parts if p[0] in hit]
        numbers = self.spark.createDataFrame([(p[0], k) for k, p in enumerate(going)], f"part string, {REPLACED} int")
        places = self._places(old.keys, old.buckets, old.period)
        columns = [f.name for f in old.schema]
        rows = (self._read_parts(layer, table, old, going).withColumn("part", part_file())
                .join(F.broadcast(numbers), "part").join(ids, match, "left_anti")  # a row for each folder in the manifest
                .select(*columns, *[c.alias(n) for n, c in places.items()], REPLACED))
        folder = f"data/{uuid.uuid4().hex}"
        path = f"{self._dir(layer, table)}/{folder}"
        rows.write.partitionBy(*places, REPLACED).parquet(path, compression=CODEC)
        meta, batches = dict(old.meta), dict(old.meta.get("batches", {}))
        parts = [p for p in old.parts if p[0] not in hit]
        for leaf in self._leaves(path, len(places) + 1):
            fresh, was = f"{folder}/{leaf}", going[int(leaf.rsplit("=", 1)[1])]
            parts.append([fresh, was[1]])
            if was[0] in batches:
                batches[fresh] = batches[was[0]]
        if batches:
            meta["batches"] = {f: n for f, n in batches.items() if f not in hit}
        self._commit(layer, table, replace(old, version=self._next(layer, table), parts=parts, meta=meta))
        return len(going)

    def expire(self, layer: str, table: str, keep: int = 2) -> int:
        """Drop all but the newest ``keep`` versions and the folders only they used."""
        found = self.versions(layer, table)
        live = {"/".join(p[0].split("/")[:2]) for v in found[-keep:] for p in self.manifest(layer, table, v).parts}
        base = self._dir(layer, table)
        for v in found[:-keep]:
            self._plans.pop((layer, table, v), None)
            self.files.delete(f"{base}/_versions/v{v:08d}.json")
        dead = [n for n in self.files.names(f"{base}/data") if f"data/{n}" not in live]
        for n in dead:
            self.files.delete(f"{base}/data/{n}")
        return len(dead)
