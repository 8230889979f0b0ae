"""N-gram Jaccard join by T-occurrence search over inverted lists.

A document is the set of its word shingles. Two documents of sizes m and n link when
their sets share at least T = threshold / (1 + threshold) * (m + n) shingles. As in
DivideSkip, the lists of a document are divided: its T - 1 longest lists are left out of
the merge, because a partner must also be met in one of the remaining short lists.

1. One scan gives each document the size and a digest of its set, and counts over all
   documents in how many of them a shingle of the lower half of the hash space occurs.
   Documents of equal sets become one class, represented by its smallest id.
2. Lists are ordered by length: shingles known as frequent go last, others by hash. Any
   fixed order gives the same links; this one keeps the merged lists short. Of each
   representative only the short lists (the first n - T + 1 shingles) are inverted.
3. Each task merges the lists of its hash range. Lists of up to ``SHORT`` members give
   their pairs.
4. Pairs are settled by probing the longer sorted set for the shingles of the shorter one.
5. Members of longer lists are searched whole: documents that share such lists form
   clusters, a cluster is cut into bands of sizes and blocks of bounded size, and each pair of
   blocks that may hold partners is one task. It inverts one block and queries it with the
   other by T-occurrence: the short lists of a query are merged, the longest ones are probed
   by binary search for the documents still able to reach T. The task counts each
   document's links and sends on the counts and the edges of a spanning forest only. Pairs of
   one cluster are counted here and nowhere else.
6. Components of the links are found with label propagation over tables.

Shingles are compared by 64-bit hashes. Defined cases: a null or wordless text has an
empty set, links with nothing and is its own component; a text of fewer words than the
width is one shingle; repeated rows each get a row; rows of one id and different texts are
judged each by its text; a null id gets the smallest id of its equal texts, else null. Other
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel
from .common import id_bitmap, in_bitmap, partitions, ship, stage
from .components import components

WIDTH = 5
SHORT = 16
#: Shingles and documents of a block, about.
BLOCK = 1 << 19
BLOCK_DOCS = 2048
FREQUENT = 16
#: Entries of the table of frequent shingles that every task holds: 8 bytes each. It only
#: orders lists; shingles beyond it count as infrequent, which costs time but no link.
FREQUENT_ENTRIES = 1 << 20
HALF = np.uint64(1 << 63)
FLUSH = 1 << 20


def binary(values: list) -> pa.Array:
    return pa.array(values, pa.binary())


def _unique_counts(parts: list[np.ndarray], counts: list[np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
    v = np.concatenate(parts)
    order = np.argsort(v, kind="stable") if counts else None
    v = v[order] if counts else np.sort(v)
    if not len(v):
        return v, np.zeros(0, np.int64)
    at = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
    c = np.concatenate(counts)[order] if counts else np.ones(len(v), np.int64)
    return v[at], np.add.reduceat(c, at)


def _bucket_edges(buckets: int, top: int) -> np.ndarray:
    """The last hash of each of the buckets below ``top``."""
    return np.array([(k + 1) * top // buckets - 1 for k in range(buckets)], np.uint64)


def digests(docs: DataFrame, width: int, buckets: int) -> DataFrame:
    """Rows of two kinds: a document's size and digest, and counted shingles of a hash range."""
    edges = _bucket_edges(buckets, 1 << 63)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            v, c = _unique_counts(held, None)
            cut = np.concatenate([[0], np.searchsorted(v, edges, "right")])
            own = [k for k in range(buckets) if cut[k] < cut[k + 1]]
            return pa.RecordBatch.from_arrays([
                pa.nulls(len(own), pa.int64()), pa.nulls(len(own), pa.int64()), pa.nulls(len(own), pa.binary()),
                pa.array(own, pa.int32()), binary([v[cut[k]:cut[k + 1]].tobytes() for k in own]),
                binary([c[cut[k]:cut[k + 1]].astype(np.int32).tobytes() for k in own])], names=names)

        names = ["doc_id", "n", "digest", "bucket", "shingles", "counts"]
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, raw, offs in kernel.chunks(batch.column(1)):
                n, digest = [], []
                for s in kernel.shingle_sets(kernel.words(raw, offs), width):
                    n.append(len(s))
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    low = s[:np.searchsorted(s, HALF)]
                    held.append(low)
                    size += len(low)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(n, pa.int64()), binary(digest), pa.nulls(hi - lo, pa.int32()),
                     pa.nulls(hi - lo, pa.binary()), pa.nulls(hi - lo, pa.binary())], names=names)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    rows = docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n long, digest binary, bucket int, shingles binary, counts binary")
    # a document's row goes to a random place, so that copies don't meet in one task
    key = F.when(F.col("bucket").isNull(), F.xxhash64("doc_id", "n")).otherwise(F.xxhash64("bucket"))
    return rows.repartition(partitions(docs.sparkSession), key)


def frequent(rows: DataFrame) -> DataFrame:
    """Sums the counts of each hash range; keeps the rows of documents and shingles over FREQUENT."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, counts = None, [], []

        def flush() -> pa.RecordBatch:
            v, c = _unique_counts(parts, counts)
            v, c = v[c > FREQUENT], c[c > FREQUENT]
            return pa.RecordBatch.from_arrays([pa.nulls(len(v), pa.int64()), pa.nulls(len(v), pa.int64()),
                                               pa.nulls(len(v), pa.binary()), pa.array(v.view(np.int64)), pa.array(c)],
                                              names=["doc_id", "n", "digest", "shingle", "count"])

        for batch in batches:
            doc = batch.filter(pa.compute.is_null(batch.column(3)))
            if doc.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [*doc.columns[:3], pa.nulls(doc.num_rows, pa.int64()), pa.nulls(doc.num_rows, pa.int64())],
                    names=["doc_id", "n", "digest", "shingle", "count"])
            rest = batch.filter(pa.compute.is_valid(batch.column(3)))
            for k, v, c in zip(*(rest.column(i).to_pylist() for i in (3, 4, 5)), strict=True):
                if k != at and parts:
                    yield flush()
                    parts, counts = [], []
                at = k
                parts.append(np.frombuffer(v, np.uint64))
                counts.append(np.frombuffer(c, np.int32).astype(np.int64))
        if parts:
            yield flush()

    return rows.sortWithinPartitions("bucket").mapInArrow(
        run, "doc_id long, n long, digest binary, shingle long, count long")


def short_lists(docs: DataFrame, width: int, percent: int, hot) -> DataFrame:
    """``doc_id, digest, n, prefix``: the shingles whose lists a document is merged in, in list order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = hot.value
        for batch in batches:
            for lo, hi, raw, offs in kernel.chunks(batch.column(1)):
                digest, size, prefix = [], [], []
                for s in kernel.shingle_sets(kernel.words(raw, offs), width):
                    n = len(s)
                    keep = n - -(-percent * n // 100) + 1
                    if n:
                        low = s[:np.searchsorted(s, HALF)]
                        at = np.searchsorted(last, low)
                        late = np.zeros(n, bool)
                        if len(last):
                            late[:len(low)] = last[np.minimum(at, len(last) - 1)] == low
                        p = np.concatenate([s[~late], s[late]])[:keep]
                    else:
                        p = s
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if n else None)
                    size.append(n)
                    prefix.append(p.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), binary(digest), pa.array(size, pa.int64()), binary(prefix)],
                    names=["doc_id", "digest", "n", "prefix"])

    out = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    return out.mapInArrow(run, "doc_id long, digest binary, n long, prefix binary").where("n > 0")


def inverted(prefixes: DataFrame, buckets: int) -> DataFrame:
    """Postings of each hash range, packed: shingles, ids, sizes and places in list order."""
    edges = _bucket_edges(buckets, 1 << 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            h = np.concatenate([x[0] for x in held])
            rest = [np.concatenate([np.full(len(x[0]), x[k], t) for x in held]) for k, t in ((1, np.int64), (2, np.int32))]
            rest.append(np.concatenate([np.arange(len(x[0]), dtype=np.int32) for x in held]))
            order = np.argsort(h)
            h, rest = h[order], [r[order] for r in rest]
            cut = np.concatenate([[0], np.searchsorted(h, edges, "right")])
            own = [k for k in range(buckets) if cut[k] < cut[k + 1]]
            return pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int32()), *(binary([x[cut[k]:cut[k + 1]].tobytes() for k in own]) for x in (h, *rest))],
                names=["bucket", "h", "id", "n", "place"])

        for batch in batches:
            for i, n, p in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2)), strict=True):
                held.append((np.frombuffer(p, np.uint64), i, n))
                size += len(p) // 8
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return (prefixes.select("doc_id", "n", "prefix")
            .mapInArrow(run, "bucket int, h binary, id binary, n binary, place binary")
            .repartition(partitions(prefixes.sparkSession), F.xxhash64("bucket")).sortWithinPartitions("bucket"))


def merge_list(ids: np.ndarray, n: np.ndarray, place: np.ndarray, percent: int, most: int = SHORT) -> tuple[np.ndarray, np.ndarray, bool]:
    """Candidate pairs of one list, and whether it is short enough to give them here."""
    if len(ids) > most:
        return ids[:0], ids[:0], False
    a, b = np.triu_indices(len(ids), 1)
    na, nb = n[a].astype(np.int64), n[b].astype(np.int64)
    need = -(-percent * (na + nb) // (100 + percent))
    left = 1 + np.minimum(na - place[a], nb - place[b]) - 1
    ok = (left >= need) & (np.minimum(na, nb) >= need) & (ids[a] != ids[b])
    a, b = ids[a[ok]], ids[b[ok]]
    return np.minimum(a, b), np.maximum(a, b), True


def merged(postings: DataFrame, percent: int, most: int = SHORT) -> DataFrame:
    """Rows ``h, a, b, n``: candidate pairs (h null), and members of longer lists (b null)."""
    names = ["h", "a", "b", "n", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            h, ids, n, place = (np.concatenate([p[k] for p in parts]) for k in range(4))
            order = np.lexsort((ids, n, h))
            h, ids, n, place = h[order], ids[order], n[order], place[order]
            cut = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1], [True]]))
            many = np.flatnonzero(np.diff(cut) > 1)
            a, b, long = [], [], []
            for k in many:
                s = slice(cut[k], cut[k + 1])
                x, y, whole = merge_list(ids[s], n[s], place[s], percent, most)
                a.append(x)
                b.append(y)
                if not whole:
                    long.append(np.arange(cut[k], cut[k + 1]))
            if a:
                pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1)
                m = pairs.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(m, pa.int64()), pa.array(pairs[0]), pa.array(pairs[1]), pa.nulls(m, pa.int64()),
                     pa.nulls(m, pa.int64())], names=names)
            if long:
                k = np.concatenate(long)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[k].view(np.int64)), pa.array(ids[k]), pa.nulls(len(k), pa.int64()),
                     pa.array(n[k].astype(np.int64)), pa.array(place[k].astype(np.int64))], names=names)

        for batch in batches:
            for k, *cols in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != at and parts:
                    yield from flush()
                    parts = []
                at = k
                parts.append([np.frombuffer(c, t) for c, t in zip(cols, (np.uint64, np.int64, np.int32, np.int32),
                                                                   strict=True)])
        if parts:
            yield from flush()

    return postings.mapInArrow(run, "h long, a long, b long, n long, place long")


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Shared values of two sorted sets: the longer one is probed by binary search."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    return int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))


def shingled(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """``doc_id, set`` of at least the documents in ``ids`` (one column ``a``)."""
    wanted = docs.sparkSession.sparkContext.broadcast(id_bitmap(ids, "a"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(wanted.value, np.uint8)
        for batch in batches:
            slot = batch.column(2).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1, pa.uint8()).cast(pa.bool_()))
            for lo, hi, raw, offs in kernel.chunks(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo),
                     binary([s.tobytes() for s in kernel.shingle_sets(kernel.words(raw, offs), width)])],
                    names=["doc_id", "set"])

    return (docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text", in_bitmap("doc_id").alias("slot"))
            .mapInArrow(run, "doc_id long, set binary"))


def links(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose whole sets reach the threshold."""
    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                o = overlap(x, y)
                keep.append(100 * o >= percent * (len(x) + len(y) - o) and o > 0)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    sets = shingled(docs, pairs.select("a").union(pairs.select(F.col("b").alias("a"))), width)
    left = sets.select(F.col("doc_id").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("set").alias("set_b"))
    both = pairs.hint("merge").join(right.hint("merge"), "b").join(left.hint("merge"), "a")
    return both.select("a", "b", "set_a", "set_b").mapInArrow(settle, "a long, b long")


def jaccard_join(docs: DataFrame, width: int = WIDTH, percent: int = 80, short: int = SHORT) -> DataFrame:
    """``doc_id, n_shingles, component_id, links`` for each row of ``docs`` (columns doc_id, text).

    ``links`` counts the classes of other texts that the document's class links with.
    """
    spark = ship(docs.sparkSession)
    parts = partitions(spark)
    first = stage(frequent(digests(docs, width, 4 * parts)), "shingles")
    classes = first.where("shingle IS NULL").select("doc_id", "n", "digest")
    top = (first.where("shingle IS NOT NULL").select("shingle", "count")
           .orderBy(F.desc("count"), "shingle").limit(FREQUENT_ENTRIES).select("shingle").toArrow())
    hot = spark.sparkContext.broadcast(np.sort(np.array(top.column(0).to_numpy(), np.int64).view(np.uint64)))

    reps = stage(classes.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    prefixes = short_lists(docs, width, percent, hot)
    own = prefixes.join(reps.where("rep IS NOT NULL").withColumnRenamed("rep", "doc_id"), ["digest", "doc_id"], "left_semi")
    found = stage(merged(inverted(own, 4 * parts), percent, short), "candidates")

    clusters = clustered(found.where("b IS NULL").select("h", "a", "n"))
    pairs = apart(found.where("b IS NOT NULL").select("a", "b").distinct(), clusters)
    near = stage(links(docs, pairs, width, percent).distinct(), "links")
    counts = near.select("a").union(near.select("b")).groupBy("a").agg(F.count("*").alias("links"))
    if clusters.limit(1).count():
        more = stage(searched(docs, clusters, width, percent), "links")
        near = near.union(more.where("b IS NOT NULL").select("a", "b"))
        counts = counts.union(more.where("b IS NULL").select("a", "links"))
    labels = components(near)
    degree = counts.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    known = (reps.join(labels.withColumnRenamed("node", "rep"), "rep", "left").join(degree, "rep", "left")
             .select("digest", F.coalesce("component", "rep").alias("component"), F.coalesce("links", F.lit(0)).alias("links")))
    # rows of one text share a digest; the pieces of a hot digest are salted by its document
    return (classes.join(known, "digest", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
                    F.coalesce("links", F.lit(0)).cast("long").alias("links")))


def clustered(members: DataFrame) -> DataFrame:
    """``a, n, cluster`` of the members of longer lists; members of one list are in one cluster."""
    lists = members.groupBy("h").agg(F.min("a").alias("first"))
    edges = members.join(lists, "h").select(F.col("first").alias("x"), "a")
    clusters = components(edges, "x", "a")
    return stage(members.select("a", "n").distinct().join(clusters.withColumnRenamed("node", "a"), "a")
                 .select("a", "n", F.col("component").alias("cluster")), "clusters")


def apart(pairs: DataFrame, clusters: DataFrame) -> DataFrame:
    """The pairs whose ends aren't in one cluster, which is searched whole."""
    x = clusters.select("a", F.col("cluster").alias("x"))
    y = clusters.select(F.col("a").alias("b"), F.col("cluster").alias("y"))
    return pairs.join(x, "a", "left").join(y, "b", "left").where("x IS NULL OR y IS NULL OR x <> y").select("a", "b")


def block_pairs(members: DataFrame, percent: int) -> DataFrame:
    """``a, cluster, band, i, other, j, side``: a row for each block pair that a member takes part in.

    Partners have sizes within 100 / percent, so they are in one band or in neighbouring ones.
    """
    base = 100 / percent
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(base)) + 1e-9).cast("int")
    rows = members.withColumn("band", band)
    sizes = rows.groupBy("cluster", "band").agg(
        F.ceil(F.greatest(F.sum("n") / F.lit(float(BLOCK)), F.count("*") / F.lit(float(BLOCK_DOCS)))).cast("int").alias("blocks"))
    place = F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int")
    rows = rows.join(sizes, ["cluster", "band"]).withColumn("i", place)
    up = sizes.select("cluster", (F.col("band") - 1).alias("band"), F.col("blocks").alias("above"))
    down = sizes.select("cluster", (F.col("band") + 1).alias("band"), F.col("blocks").alias("below"))
    rows = rows.join(up, ["cluster", "band"], "left").join(down, ["cluster", "band"], "left")

    def pair(band, i, other, j, side):
        return F.struct(band.cast("int").alias("band"), i.alias("i"), other.cast("int").alias("other"), j.alias("j"),
                        F.lit(side).alias("side"))

    def numbers(n):
        return F.when(F.coalesce(n, F.lit(0)) > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    k, i = F.col("band"), F.col("i")
    tasks = F.concat(
        F.transform(F.sequence(i, F.col("blocks") - 1), lambda j: pair(k, i, k, j, 0)),
        F.transform(numbers(F.col("i")), lambda j: pair(k, j, k, i, 1)),
        F.transform(numbers(F.col("above")), lambda j: pair(k, i, k + 1, j, 0)),
        F.transform(numbers(F.col("below")), lambda j: pair(k - 1, j, k, i, 1)))
    return rows.select("a", "cluster", F.explode(tasks).alias("t")).select("a", "cluster", "t.*")


def t_occurrence(queries: list[np.ndarray], rows: list[np.ndarray], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each query the rows whose sets reach the threshold with it."""
    sizes = np.array([len(r) for r in rows], np.int64)
    keys = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(rows)), sizes)
    order = np.lexsort((owner, keys))
    keys, owner = keys[order], owner[order]
    smallest = int(sizes.min()) if len(sizes) else 0
    for q, s in enumerate(queries):
        n = len(s)
        least = -(-percent * (n + max(smallest, -(-percent * n // 100))) // (100 + percent))
        lo, hi = np.searchsorted(keys, s, "left"), np.searchsorted(keys, s, "right")
        size = hi - lo
        used = np.flatnonzero(size)
        if len(used) < least:
            continue
        used = used[np.argsort(size[used], kind="stable")]
        # the more lists are left to probing, the weaker the merge filters; half of the threshold balances them
        long = min(least // 2, len(used) - 1)
        short, probe = used[:len(used) - long], used[len(used) - long:]
        total = int(size[short].sum())
        at = np.repeat(lo[short] - np.concatenate([[0], np.cumsum(size[short])[:-1]]), size[short]) + np.arange(total)
        count = np.bincount(owner[at], minlength=len(rows))
        need = -(-percent * (n + sizes) // (100 + percent))
        alive = (count >= need - long) & (np.minimum(n, sizes) >= need)
        found = np.flatnonzero(alive)
        for k, p in enumerate(probe):
            if not len(found):
                break
            own = owner[lo[p]:hi[p]]
            place = np.minimum(np.searchsorted(own, found), len(own) - 1)
            count[found] += own[place] == found
            found = found[count[found] >= need[found] - (long - 1 - k)]
        if len(found):
            yield q, found[100 * count[found] >= percent * (n + sizes[found] - count[found])]


def searched(docs: DataFrame, members: DataFrame, width: int, percent: int) -> DataFrame:
    """Of the members of a cluster the numbers of links ``a, links`` and edges ``a, b`` that connect what links connect."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(x, np.uint64) for x in pdf["set"]]
        ids, side = (pdf[k].to_numpy() for k in ("a", "side"))
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        within = pdf["band"].iloc[0] == pdf["other"].iloc[0] and pdf["i"].iloc[0] == pdf["j"].iloc[0]
        if within:
            left = right = np.arange(len(ids))
        count, tree, edges = np.zeros(len(ids), np.int64), np.arange(len(ids)), []
        for q, found in t_occurrence([sets[k] for k in left], [sets[k] for k in right], percent):
            x, y = left[q], right[found]
            y = y[y != x]
            count[x] += len(y)
            if not within:  # within a block each of the two is a query
                count[y] += 1
            own, at = np.unique(tree[y], return_index=True)
            at = at[own != tree[x]]
            if len(at):
                edges += [(min(ids[x], ids[k]), max(ids[x], ids[k])) for k in y[at]]
                tree[np.isin(tree, own)] = tree[x]
        some = np.flatnonzero(count)
        a, b = zip(*edges, strict=True) if edges else ((), ())
        return pd.DataFrame({"a": np.concatenate([np.array(a, np.int64), ids[some]]),
                             "b": pd.array([*b, *[None] * len(some)], "Int64"),
                             "links": np.concatenate([np.zeros(len(a), np.int64), count[some]])})

    sets = shingled(docs, members.select("a"), width).withColumnRenamed("doc_id", "a")
    return (block_pairs(members, percent).join(sets, "a").groupBy("cluster", "band", "i", "other", "j")
            .applyInPandas(run, "a long, b long, links long"))
