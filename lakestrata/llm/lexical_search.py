"""Ranked lexical search over a length-stratified index.

A document's score for an item sums w * impact(tf, m) over the item's distinct terms: w is a
term's weight from its document frequency, m the document's length normaliser, a small integer.
Documents of equal m form a stratum. Within it a posting's impact depends on tf alone, so the
postings of a term are kept in runs of equal tf, the highest first, and an impact is computed
once for each tf. The first run of each term bounds what any document of the stratum can score.

1. Texts are cut into terms once; what remains of a document is its length and the items' terms
   in it with their counts. Numbers of documents and terms and document frequencies are counted
   over all documents.
2. Documents are exchanged by range of m; each range is written as strata, a stratum of many
   documents as several pieces of bounded size.
3. Bounds of all pieces are computed. Each item first visits its pieces of the highest bounds;
   its kth score there is the floor below which other pieces are not visited any more. A task
   visits the rest in the order of their bounds, and its floors rise as it goes.
4. The best k of all visits are the exact result.

Items are taken in blocks by a hash of their id, so that a block's terms (about ``block_terms``)
fit a broadcast; each block is a pass over the documents, its statistics cover all of them.

Defined cases: null and empty texts have no terms and count nowhere. Items without terms have no
rows. Rows repeating an item's id, null included, are one item with the terms of all; rows
repeating a document's id are documents of their own. A null document id ranks after all others
of its score. Empty tables give no rows; other columns are ignored. Terms are compared by 64-bit
hashes. Scores have to fit a long.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernel
from .common import partitions, settled, ship, stage
from .terms import binaries, find, joined, ranges, terms

K = 50
BLOCK_TERMS = 1 << 18
PIECE_DOCS = 4096
RANGE_DOCS = 1 << 15
FIRST = 3
VISIT = 1 << 21
HELD = 1 << 16
EXACT = 1 << 53
FORWARD = "doc_id long, n long, terms binary, tfs binary"
PIECES = "piece long, m long, ids binary, nameless binary, terms binary, tfs binary, ends binary, docs binary"
FOUND = "item int, item_id long, doc_id long, score long"


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def weight(df: int, n: int) -> int:
    return floor(1000 * log((2 * n + 2) / (2 * df + 1)))


@dataclass
class Asked:
    """A block of items: item i has the terms ``at[starts[i]:starts[i + 1]]``, numbers in ``vocabulary``."""

    ids: list
    starts: np.ndarray
    at: np.ndarray
    vocabulary: np.ndarray


def asked(block: DataFrame) -> Asked:
    own = block.select("item_id", "term").toArrow()
    pairs = sorted(zip(((i is not None, i or 0) for i in own.column(0).to_pylist()), own.column(1).to_pylist(), strict=True))
    ids = sorted({i for i, _ in pairs})
    hashes = np.array([t for _, t in pairs], np.int64).view(np.uint64)
    vocabulary = np.unique(hashes)
    number = {i: k for k, i in enumerate(ids)}
    owner = np.array([number[i] for i, _ in pairs], np.int64)
    return Asked([i if known else None for known, i in ids], np.searchsorted(owner, np.arange(len(ids) + 1)),
                 np.searchsorted(vocabulary, hashes), vocabulary)


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term``: the distinct terms of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw, offs in kernel.chunks(batch.column(1)):
                w = terms(raw, offs)
                row = np.repeat(np.arange(lo, hi), np.diff(w.at))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(w.hashes.view(np.int64))],
                                                 names=["item_id", "term"])

    return items.select(F.col("item_id").cast("long"), "text").mapInArrow(run, "item_id long, term long").distinct()


def forward(docs: DataFrame, block) -> DataFrame:
    """Each document's length and, of the block's terms in it, number and count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = block.value.vocabulary
        for batch in batches:
            for lo, hi, raw, offs in kernel.chunks(batch.column(1)):
                w = terms(raw, offs)
                n = np.diff(w.at)
                at = find(own, w.hashes)
                hit = at >= 0
                key, tf = np.unique(np.repeat(np.arange(hi - lo), n)[hit] * len(own) + at[hit], return_counts=True)
                doc, term = np.divmod(key, len(own))
                cuts = np.searchsorted(doc, np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), binaries(term.astype("<i4"), cuts),
                     binaries(tf.astype("<i4"), cuts)], names=["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, FORWARD)


def document_frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """In how many documents each of ``size`` terms occurs; a task adds up its own documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(joined(batch.column(0), "<i4")[0], minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["term", "df"])

    sums = rows.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(size, np.int64)
    out[sums.column(0).to_numpy()] = sums.column(1).to_numpy()
    return out


def piece_of(number: int, m: int, rows: list[pa.RecordBatch]) -> tuple:
    """A piece's documents and its postings: by term, the highest tf first, in runs of equal tf."""
    ids = pa.concat_arrays([r.column(0) for r in rows])
    term, size = joined(pa.concat_arrays([r.column(2) for r in rows]), "<i4")
    tf, _ = joined(pa.concat_arrays([r.column(3) for r in rows]), "<i4")
    doc = np.repeat(np.arange(len(ids), dtype="<i4"), size)
    order = np.lexsort((doc, -tf, term))
    term, tf, doc = term[order], tf[order], doc[order]
    last = np.append((term[1:] != term[:-1]) | (tf[1:] != tf[:-1]), True)
    ends = np.flatnonzero(last) + 1
    nameless = ids.is_null().to_numpy(zero_copy_only=False)
    return (number, m, ids.fill_null(0).to_numpy().astype("<i8").tobytes(), nameless.astype(np.uint8).tobytes(),
            term[ends - 1].tobytes(), tf[ends - 1].tobytes(), ends.astype("<i4").tobytes(), doc.tobytes())


def strata(rows: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """The index: the documents that hold a term, by m."""
    m = F.expr(f"50 + (50 * n * {n_docs}L) div {n_terms}L")
    spread = max(partitions(rows.sparkSession), -(-n_docs // RANGE_DOCS))
    dealt = (rows.where(F.octet_length("terms") > 0).select("doc_id", m.alias("m"), "terms", "tfs", F.rand(11).alias("salt"))
             .repartitionByRange(spread, "m", "salt").sortWithinPartitions("m", "salt").drop("salt"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        at, docs = None, 0

        def out() -> pa.RecordBatch:
            nonlocal number, docs
            row = piece_of(number, at, held)
            number, docs = number + 1, 0
            held.clear()
            kinds = [pa.int64()] * 2 + [pa.binary()] * 6
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)],
                                              names=[x.split()[0] for x in PIECES.split(", ")])

        for batch in batches:
            own = batch.column(1).to_numpy()
            edges = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                while a < b:
                    if held and (at != own[a] or docs >= PIECE_DOCS):
                        yield out()
                    at = int(own[a])
                    take = min(b - a, PIECE_DOCS - docs)
                    held.append(batch.slice(a, take))
                    a, docs = a + take, docs + take
        if held:
            yield out()

    return stage(dealt.mapInArrow(run, PIECES), "strata")


class Piece:
    """A piece of a stratum, ready to be visited by the items of a block."""

    def __init__(self, row: dict, weights: np.ndarray):
        def read(name: str, dtype: str) -> np.ndarray:
            return np.frombuffer(row[name], dtype)

        self.number = row["piece"]
        self.ids, self.nameless = read("ids", "<i8"), read("nameless", "u1")
        self.terms, self.ends, self.docs = read("terms", "<i4"), read("ends", "<i4").astype(np.int64), read("docs", "<i4")
        tf, back = np.unique(read("tfs", "<i4").astype(np.int64), return_inverse=True)
        self.gains = impact(tf, row["m"])[back] * weights[self.terms]  # what a posting of each run adds to a score
        self.first = np.flatnonzero(np.append(True, self.terms[1:] != self.terms[:-1]))

    def bounds(self, block: Asked, room: np.ndarray) -> np.ndarray:
        """The most that a document of this piece can score for each item; ``room`` is all zero."""
        heads = self.terms[self.first]
        room[heads] = self.gains[self.first]
        out = np.add.reduceat(room[block.at], block.starts[:-1])
        room[heads] = 0
        return out

    def visit(self, block: Asked, chosen: np.ndarray, bounds: np.ndarray, floors: np.ndarray) -> Iterator[tuple]:
        """Item, score, null flag and id of the documents that reach the floors of the chosen items."""
        step = max(1, VISIT // max(1, len(self.docs)))
        for k in range(0, len(chosen), step):
            own = chosen[k:k + step]
            many = block.starts[own + 1] - block.starts[own]
            term, row = block.at[ranges(block.starts[own], many)], np.repeat(np.arange(len(own)), many)
            a, b = np.searchsorted(self.terms, term), np.searchsorted(self.terms, term, "right")
            runs, row = ranges(a, b - a), np.repeat(row, b - a)
            starts = np.where(runs > 0, self.ends[runs - 1], 0)
            size = self.ends[runs] - starts
            cell = np.repeat(row * len(self.ids), size) + self.docs[ranges(starts, size)]
            gain = np.repeat(self.gains[runs], size)
            if bounds[own].max() < EXACT:
                score = np.bincount(cell, gain, len(own) * len(self.ids)).astype(np.int64)
            else:
                score = np.zeros(len(own) * len(self.ids), np.int64)
                np.add.at(score, cell, gain)
            at = np.flatnonzero(score.reshape(len(own), -1) >= floors[own][:, None])
            row, doc = np.divmod(at, len(self.ids))
            yield own[row], score[at], self.nameless[doc], self.ids[doc]


class Best:
    """The best k documents of each item so far, and the score that another has to reach."""

    def __init__(self, floors: np.ndarray, k: int):
        self.floors, self.k = floors, k
        self.held: list[tuple] = []
        self.size = self.kept = 0

    def push(self, rows: tuple) -> None:
        self.held.append(rows)
        self.size += len(rows[0])
        if self.size > 2 * self.kept + HELD:
            self.rows()

    def rows(self) -> tuple:
        item, score, nameless, ids = map(np.concatenate, zip(*self.held, strict=True)) if self.held else (np.zeros(0, np.int64),) * 4
        order = np.lexsort((ids, nameless, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        full = place == self.k - 1
        self.floors[item[full]] = np.maximum(self.floors[item[full]], score[order][full])
        order, item = order[place < self.k], item[place < self.k]
        self.held = [(item, score[order], nameless[order], ids[order])]
        self.size = self.kept = len(item)
        return self.held[0]


def pieces(batches: Iterable[pa.RecordBatch], weights: np.ndarray) -> Iterator[list[Piece]]:
    for batch in batches:
        yield [Piece(row, weights) for row in batch.to_pylist()]


def found(block: Asked, rows: tuple) -> pa.RecordBatch:
    item, score, nameless, ids = rows
    named = pa.array(block.ids, pa.int64()).take(pa.array(item))
    return pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), named, pa.array(ids, pa.int64(), mask=nameless.astype(bool)),
                                       pa.array(score, pa.int64())], names=["item", "item_id", "doc_id", "score"])


def by_rank(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked(index: DataFrame, block: Asked, weights: np.ndarray, k: int) -> DataFrame:
    """The best k documents of each item of a block."""
    context = index.sparkSession.sparkContext
    plan = context.broadcast((block, weights))

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weights = plan.value
        room = np.zeros(len(weights), np.int64)
        top = np.zeros((FIRST, len(block.ids)), np.int64)
        at = np.zeros_like(top)
        for own in pieces(batches, weights):
            for p in own:
                bounds = np.vstack([top, p.bounds(block, room)])
                order = np.argsort(-bounds, axis=0, kind="stable")[:FIRST]
                at = np.take_along_axis(np.vstack([at, np.full(len(block.ids), p.number)]), order, 0)
                top = np.take_along_axis(bounds, order, 0)
        _, item = np.nonzero(top > 0)
        yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(at[top > 0]), pa.array(top[top > 0])],
                                         names=["item", "piece", "bound"])

    order = Window.partitionBy("item").orderBy(F.desc("bound"), "piece")
    head = (index.mapInArrow(bound, "item int, piece long, bound long").withColumn("r", F.row_number().over(order))
            .where(F.col("r") <= FIRST).select("item", "piece").toArrow())  # FIRST rows an item of the block
    visits = defaultdict(set)
    for i, p in zip(head.column(0).to_pylist(), head.column(1).to_pylist(), strict=True):
        visits[p].add(i)
    first = context.broadcast({p: np.array(sorted(own), np.int64) for p, own in visits.items()})

    def visit(batches: Iterator[pa.RecordBatch], known: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        """The pieces chosen first (without ``known`` floors), or the others that can reach an item's floor."""
        block, weights = plan.value
        room = np.zeros(len(weights), np.int64)
        top = Best(np.ones(len(block.ids), np.int64) if known is None else known.copy(), k)
        none = np.zeros(0, np.int64)
        for own in pieces(batches, weights):
            calls = []
            for p in own:
                chosen = first.value.get(p.number, none)
                if known is None and not len(chosen):
                    continue
                bounds = p.bounds(block, room)
                if known is not None:
                    chosen = np.setdiff1d(np.flatnonzero(bounds >= top.floors), chosen)
                if len(chosen):
                    calls.append((int(bounds[chosen].max()), p.number, p, chosen, bounds))
            for _, _, p, chosen, bounds in sorted(calls, key=lambda c: (-c[0], c[1])):
                for rows in p.visit(block, chosen[bounds[chosen] >= top.floors[chosen]], bounds, top.floors):
                    top.push(rows)
            top.rows()
        yield found(block, top.rows())

    head_rows = stage(index.where(F.col("piece").isin(list(visits))).mapInArrow(lambda b: visit(b, None), FOUND), "found")
    kth = by_rank(head_rows, k).where(F.col("rank") == k).select("item", "score").toArrow()  # at most a row an item
    floors = np.ones(len(block.ids), np.int64)
    floors[kth.column(0).to_numpy()] = kth.column(1).to_numpy()
    known = context.broadcast(floors)
    rest = index.mapInArrow(lambda b: visit(b, known.value), FOUND)
    return by_rank(head_rows.union(rest), k).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the best k documents of each item."""
    spark = ship(docs.sparkSession)
    none = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")

    def work() -> DataFrame:
        wanted = stage(item_terms(items), "asked")
        blocks = -(-wanted.count() // block_terms)
        out, total = [], None
        for b in range(blocks):
            own = asked(wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b))
            if not own.ids:
                continue
            held = spark.sparkContext.broadcast(own)
            rows = stage(forward(docs, held), "forward")
            if total is None:
                total = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
            if not total[0]:
                break
            df = document_frequencies(rows, len(own.vocabulary))
            weights = np.array([weight(int(x), total[0]) for x in df], np.int64)
            out.append(stage(ranked(strata(rows, *total), own, weights, k), "ranked"))
        return reduce(DataFrame.union, out, none)

    return settled(spark, work, "search")
