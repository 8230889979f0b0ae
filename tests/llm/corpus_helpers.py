"""Rows with every odd case, and plain versions of what the operators compute."""

from __future__ import annotations

import re
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, shard int, component_id string"
BASE = " ".join(f"w{k}" for k in range(60))
LONG = " ".join(f"longword{k % 977}" for k in range(60_000))
TEXTS = [
    (1, BASE), (2, BASE), (2, BASE), (3, BASE + " tail"), (4, None), (5, ""), (6, "  \n\t "), (7, "one"), (8, "ONE"),
    (9, "two words"), (10, LONG), (11, LONG + " more"), (None, BASE), (None, None), (12, "é" * 5000), (13, BASE.upper()),
    (14, "mail x.y@mail.example.com card 4845168114407329 decoy 9807915762804490"),
    (15, "again card 4845168114407329 and ip 10.20.30.40 on 2021-02-28, never 2021-02-30"),
]


def odd_documents(spark: SparkSession) -> DataFrame:
    rows = [(i, t, "en" if i else None, "src0", len(t or ""), 99, "clash") for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def shingles(text: str | None, width: int = 5) -> frozenset:
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def smallest_reachable(rows: list[tuple[int, str | None]]) -> dict[int, int]:
    """The component of each id, by comparing all documents that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    lists = defaultdict(list)
    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for g in s:
            for j in lists[g]:
                shared[j] += 1
            lists[g].append(i)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
    low: dict[int, int] = {}
    for i, (d, _) in enumerate(rows):
        low[root(i)] = min(low.get(root(i), d), d)
    return {d: low[root(i)] for i, (d, _) in enumerate(rows)}
