"""Best-fit packing of token sequences by exact-complement hashing.

Documents are tokenized once into pieces of at most ``capacity`` tokens. Only the number
of pieces of each length is planned: a table of at most ``capacity`` numbers whatever the
corpus. The longest remaining piece opens a sequence; its gap is looked up among single
lengths, sums of two and sums of three lengths still available, and the first exact
complement is consumed as often as the counts allow. Where no exact one is left, the
longest length that fits is taken and the smaller gap is looked up again (best fit). The
plan is a list of patterns with multiplicities; pieces are then numbered within their
length and take the places of that length in order.

Numbering needs no single task: pieces of a length are dealt over hash buckets, numbered
within them, and shifted by the counts of the earlier buckets.

Defined cases: a null or empty text is one piece holding the end token alone; a longer
document has its odd remainder first and full pieces after it; repeated rows are packed
each; a null id is kept; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, ship, stage
from .encode import encoder

CAPACITY = 1024
END = 2
STEP_CHARS = 1 << 22


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece of a document of ``total`` tokens."""
    first = total % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, total, capacity))]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked for, the ids as little-endian bytes."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * ids
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode

        def some(rows: list, texts: list[str]) -> pa.RecordBatch:
            out = []
            for d, data in zip(rows, encode(texts), strict=True):
                data += tail
                for k, (start, n) in enumerate(cut(len(data) // 4, capacity)):
                    own = data[4 * start:4 * (start + n)]
                    out.append((d, k, start, n, zlib.crc32(own), own))
            cols = list(zip(*out, strict=True))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)][:len(names)],
                                              names=names)

        for batch in batches:
            rows, texts, size = [], [], 0
            for d, t in zip(batch.column(0).to_pylist(), pc.fill_null(batch.column(1), "").to_pylist(), strict=True):
                rows.append(d)
                texts.append(t)
                size += len(t)
                if size >= STEP_CHARS:
                    yield some(rows, texts)
                    rows, texts, size = [], [], 0
            if rows:
                yield some(rows, texts)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def complement(have: np.ndarray, gap: int) -> list[int]:
    """Up to three available lengths that fill the gap exactly, the longest first; none if there are none."""
    if have[gap]:
        return [gap]
    there = have > 0

    def pair(g: int, more: int = 0) -> list[int]:
        """Two lengths of sum g; ``more`` is a length already taken once from the counts."""
        a = np.arange(g - 1, (g - 1) // 2, -1)
        b = g - a
        need_a = 1 + (a == b) + (a == more)
        need_b = 1 + (a == b) + (b == more)
        ok = (have[a] >= need_a) & (have[b] >= need_b)
        k = int(np.argmax(ok)) if len(a) and ok.any() else -1
        return [int(a[k]), int(b[k])] if k >= 0 else []

    if gap > 1 and (two := pair(gap)):
        return two
    for a in np.flatnonzero(there[:max(0, gap - 1)])[::-1]:
        if 3 * a < gap:
            break
        if two := pair(gap - int(a), int(a)):
            return [int(a), *two]
    return []


def plan(counts: np.ndarray, capacity: int) -> list[tuple[int, list[int]]]:
    """Patterns ``(times, lengths)`` that use every piece once; ``counts[n]`` pieces have length n."""
    have = counts.astype(np.int64).copy()
    have[0] = 0
    out = []
    for top in range(capacity, 0, -1):
        while have[top] > 0:
            left, used, gap = have.copy(), [top], capacity - top
            left[top] -= 1
            while gap:
                more = complement(left, gap)
                if not more:
                    fits = np.flatnonzero(left[:gap + 1])
                    if not len(fits):
                        break
                    more = [int(fits[-1])]
                for n in more:
                    left[n] -= 1
                used += more
                gap = capacity - sum(used)
            spent = have - left
            at = np.flatnonzero(spent)
            times = int((have[at] // spent[at]).min())
            have[at] -= times * spent[at]
            out.append((times, used))
    return out


def places(patterns: list[tuple[int, list[int]]], capacity: int) -> tuple[np.ndarray, ...]:
    """Ranges of numbers within a length: key (length, first number), the first one's sequence, and the offset."""
    taken = np.zeros(capacity + 1, np.int64)
    rows, base = [], 0
    for times, lengths in patterns:
        at = 0
        for n in lengths:
            rows.append((n, taken[n], base, at))
            taken[n] += times
            at += n
        base += times
    rows.sort()
    t = np.array(rows, np.int64).reshape(-1, 4)
    return (t[:, 0] << 48) + t[:, 1], t[:, 2], t[:, 3]


def numbered(cuts: DataFrame) -> DataFrame:
    """Adds ``number``: gapless from 0 within each length."""
    spark = cuts.sparkSession
    key = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(partitions(spark))).alias("bucket")
    dealt = cuts.select("*", key)
    sums = dealt.groupBy("length", "bucket").agg(F.count("*").alias("size"))
    before = sums.select("length", "bucket", (F.sum("size").over(
        Window.partitionBy("length").orderBy("bucket")) - F.col("size")).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32"))
    return (dealt.withColumn("within", within).join(before, ["length", "bucket"])
            .withColumn("number", F.col("before") + F.col("within") - 1).drop("bucket", "within", "before"))


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: a row for each piece."""
    spark = ship(docs.sparkSession)
    cuts = stage(pieces(docs, path, capacity, end), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for r in cuts.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["count"]
    where = spark.sparkContext.broadcast(places(plan(counts, capacity), capacity))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, base, offset = where.value
        for batch in batches:
            n, number = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 5))
            key = (n << 48) + number
            at = np.searchsorted(keys, key, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(base[at] + key - keys[at]), pa.array(offset[at])], names=names)

    return numbered(cuts).select(*names[:5], "number").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def sequences(docs: DataFrame, placed: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """``sequence_id, input_ids, doc_ids, offsets``: the packed sequences themselves, at most ``capacity`` ids each."""
    own = pieces(docs, path, capacity, end, ids=True)
    rows = placed.join(own.select("doc_id", "piece", "ids_crc32", "ids").dropDuplicates(["doc_id", "piece", "ids_crc32"]),
                       ["doc_id", "piece", "ids_crc32"])
    grouped = (rows.groupBy("sequence_id")
               .agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(b"".join(p["ids"] for p in parts), "<u4").astype(np.int32)
                   for parts in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())),
                 *(pa.array([[p[k] for p in parts] for parts in batch.column(1).to_pylist()], pa.list_(pa.int64()))
                   for k in ("doc_id", "offset"))],
                names=["sequence_id", "input_ids", "doc_ids", "offsets"])

    return grouped.mapInArrow(run, "sequence_id long, input_ids array<int>, doc_ids array<long>, offsets array<long>")
