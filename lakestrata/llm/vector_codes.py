"""Vector codes: each part of a vector becomes the number of its codebook's nearest entry.

Vectors become integers, floor(1024 x) of each component, and are cut into equal parts. A part
position's codebook starts as that part of the vectors of the smallest ids; each round assigns
every part to its nearest entry and moves each entry to the floored mean of its parts.

Assignment goes through metric trees, built once for every run of ``shard_rows`` rows and part
position and stored. A tree is built from the middle out by the anchors hierarchy: anchors are the
points farthest from the anchors so far, each takes the points that are nearer to it, passing over
those that the triangle inequality keeps with their owner; anchors are then joined bottom-up into
ever larger balls, and each anchor's own points are divided in the same way. A ball caches the sum and
the number of its points. A round walks each tree from its root with all entries as candidates;
a ball hands on to its children only the entries that can still be nearest to one of its points,
and once a single one is left the ball belongs to it whole: its cached sum and count are added
and its points aren't looked at.

A ball (p, r) rules entry c out against the entry b nearest to p if every x with |x - p| <= r is
nearer to b: |x - b|^2 - |x - c|^2 is linear in x and at most its value at p plus 2 r |b - c|. A
margin covers rounding, so ties are always decided point by point, in integers, by the lower index.

Defined cases: null vectors and those with null or non-finite components are dropped, also those of
another length than the smallest id's, and all if that length isn't a multiple of the number of
parts; rows without an id are dropped. Rows repeating an id are rows as others; among them the smaller
vector begins the codebook. With fewer rows than entries every row is an entry. Equal entries: the
first one gets the points, the others stay as they are. Null labels are equal to each other. Empty
tables give no rows; other columns are ignored. Squared distances have to stay below 2^53 and sums of
components fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled, ship, stage

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024.0
SHARD_ROWS = 8192
LEAF = 32
MARGIN = 1e-6
TREES = "ids binary, points binary, orders array<binary>, nodes array<binary>, pivots array<binary>, sums array<binary>"


def usable(df: DataFrame, id_column: str, vector: str, label: str) -> DataFrame:
    """``vec_id, label, v`` of the rows that take part, whatever their length."""
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(F.col(vector), lambda x: F.floor(F.lit(SCALE) * x.cast("double")).cast("long"))
    return (df.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull()).where(~bad)
            .select(F.col(id_column).cast("long").alias("vec_id"), F.col(label).alias("label"), whole.alias("v")))


def distances(points: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - pivot) ** 2).sum(axis=-1))


class Builder:
    """A metric tree over the rows of ``points``; node k is (from, to, left, right, radius), children come before their parent."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.leaf = points.astype(float), leaf
        self.order: list[np.ndarray] = []
        self.filled = 0
        self.nodes: list[tuple] = []
        self.pivots: list[np.ndarray] = []
        self.members: list[np.ndarray] = []
        self.root = self._grow(np.arange(len(points)))

    def _ball(self, rows: np.ndarray, left: int = -1, right: int = -1) -> int:
        pivot = self.points[rows].mean(axis=0)
        radius = distances(self.points[rows], pivot).max()
        if left < 0:
            self.order.append(rows)
            span = self.filled, self.filled + len(rows)
            self.filled = span[1]
        else:
            span = -1, -1
        self.nodes.append((*span, left, right, radius))
        self.pivots.append(pivot)
        self.members.append(rows)
        return len(self.nodes) - 1

    def _grow(self, rows: np.ndarray) -> int:
        own = self.points[rows]
        if len(rows) <= self.leaf or (own == own[0]).all():
            return self._ball(rows)
        groups = self._anchors(rows)
        return self._joined([self._grow(g) for g in groups])

    def _anchors(self, rows: np.ndarray) -> list[np.ndarray]:
        """The rows of about sqrt(n) anchors; each anchor's rows run from the farthest to the nearest."""
        many = max(2, isqrt(len(rows)))
        far = distances(self.points[rows], self.points[rows[0]])
        at = np.argsort(-far, kind="stable")
        centers, owned, reach = [self.points[rows[0]]], [rows[at]], [far[at]]
        while len(centers) < many:
            widest = max(range(len(centers)), key=lambda k: reach[k][0])
            if reach[widest][0] == 0:
                break
            center = self.points[owned[widest][0]]
            taken, took = [], []
            for k, (gap, mine, dist) in enumerate(zip(distances(np.array(centers), center), owned, reach, strict=True)):
                asked = int(np.searchsorted(-dist, -gap / 2))  # those nearer than half the gap stay with their owner
                if not asked:
                    continue
                to = distances(self.points[mine[:asked]], center)
                goes = to < dist[:asked]
                taken.append(mine[:asked][goes])
                took.append(to[goes])
                stays = np.append(~goes, np.ones(len(mine) - asked, bool))
                owned[k], reach[k] = mine[stays], dist[stays]
            mine, dist = np.concatenate(taken), np.concatenate(took)
            at = np.argsort(-dist, kind="stable")
            centers.append(center)
            owned.append(mine[at])
            reach.append(dist[at])
        return owned

    def _joined(self, balls: list[int]) -> int:
        """One tree of the balls: the two that make the smallest ball are joined, again and again."""
        balls = list(balls)
        centers = np.array([self.pivots[b] for b in balls])
        radii = np.array([self.nodes[b][4] for b in balls])
        wide = (np.sqrt(((centers[:, None] - centers[None]) ** 2).sum(-1)) + radii[:, None] + radii[None]) / 2
        np.fill_diagonal(wide, np.inf)
        for _ in range(len(balls) - 1):
            a, b = divmod(int(np.argmin(wide)), len(balls))
            new = self._ball(np.concatenate([self.members[balls[a]], self.members[balls[b]]]), balls[a], balls[b])
            balls[a] = new
            centers[a], radii[a] = self.pivots[new], self.nodes[new][4]
            wide[b], wide[:, b] = np.inf, np.inf
            gone = np.isinf(wide[a])
            wide[a] = (distances(centers, centers[a]) + radii + radii[a]) / 2
            wide[a, gone] = np.inf
            wide[:, a] = wide[a]
        return balls[a] if len(balls) > 1 else balls[0]


class Tree:
    """A stored tree: leaves' points lie next to each other in ``order``; node k's children have lower numbers."""

    def __init__(self, points: np.ndarray, order: np.ndarray, nodes: np.ndarray, pivots: np.ndarray, sums: np.ndarray):
        self.points, self.order, self.nodes, self.pivots, self.sums = points, order, nodes, pivots, sums

    @staticmethod
    def packed(points: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
        grown = Builder(points)
        nodes = np.array(grown.nodes, float)
        sums = np.array([points[m].sum(axis=0) for m in grown.members], np.int64)
        return (np.concatenate(grown.order).astype("<i4").tobytes(), nodes.astype("<f8").tobytes(),
                np.array(grown.pivots).astype("<f8").tobytes(), sums.astype("<i8").tobytes())

    @staticmethod
    def read(points: np.ndarray, order: bytes, nodes: bytes, pivots: bytes, sums: bytes) -> Tree:
        width = points.shape[1]
        return Tree(points, np.frombuffer(order, "<i4"), np.frombuffer(nodes, "<f8").reshape(-1, 5),
                    np.frombuffer(pivots, "<f8").reshape(-1, width), np.frombuffer(sums, "<i8").reshape(-1, width))

    def owners(self, book: np.ndarray) -> Iterator[tuple[int, int, np.ndarray | int]]:
        """Balls and what they belong to: (node, entry, -1) for a ball owned whole, (node, -1, entries) for a leaf's points."""
        entries = book.astype(float)
        norm = (entries ** 2).sum(axis=1)
        apart = np.sqrt(np.maximum(0, norm[:, None] + norm[None] - 2 * entries @ entries.T))
        once = np.sort(np.unique(book, axis=0, return_index=True)[1])  # of equal entries only the first can win
        todo = [(len(self.nodes) - 1, once)]
        while todo:
            node, left = todo.pop()
            low, high, a, b, radius = self.nodes[node]
            value = norm[left] - 2 * entries[left] @ self.pivots[node]
            near = int(np.argmin(value))
            slack = MARGIN * (1 + np.abs(value).max() + norm[left].max())
            left = left[value - value[near] <= 2 * radius * apart[left[near], left] + slack]
            if len(left) == 1:
                yield node, int(left[0]), -1
            elif a >= 0:
                todo += [(int(a), left), (int(b), left)]
            else:
                own = self.points[self.order[int(low):int(high)]]
                gap = ((own[:, None, :] - book[left][None]) ** 2).sum(axis=-1)
                yield node, -1, left[np.argmin(gap, axis=1)]

    def rows_of(self, node: int) -> np.ndarray:
        """The rows of all leaves below a node."""
        out, todo = [], [node]
        while todo:
            low, high, a, b, _ = self.nodes[todo.pop()]
            if a >= 0:
                todo += [int(a), int(b)]
            else:
                out.append(self.order[int(low):int(high)])
        return np.concatenate(out)

    def totals(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and sum of the points of each entry."""
        count, sums = np.zeros(len(book), np.int64), np.zeros(book.shape, np.int64)
        size = np.array([0] * len(self.nodes))
        for k, (low, high, a, b, _) in enumerate(self.nodes):
            size[k] = high - low if a < 0 else size[int(a)] + size[int(b)]
        for node, entry, each in self.owners(book):
            if entry >= 0:
                count[entry] += size[node]
                sums[entry] += self.sums[node]
            else:
                low, high = int(self.nodes[node][0]), int(self.nodes[node][1])
                np.add.at(count, each, 1)
                np.add.at(sums, each, self.points[self.order[low:high]])
        return count, sums

    def nearest(self, book: np.ndarray) -> np.ndarray:
        """Each row's entry."""
        out = np.empty(len(self.points), np.int64)
        for node, entry, each in self.owners(book):
            out[self.rows_of(node)] = entry if entry >= 0 else each
        return out


def forest(rows: DataFrame, parts: int, shard_rows: int) -> DataFrame:
    """A row for each run of ``shard_rows`` rows with its vectors and a tree for each part; rows stay in their tasks."""
    schema = f"{TREES}, labels array<{dict(rows.dtypes)['label']}>"

    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).combine_chunks()
        ids, labels = whole.column(0).combine_chunks(), whole.column(1).combine_chunks()
        points = np.array(whole.column(2).combine_chunks().flatten().to_numpy(), "<i8").reshape(len(ids), -1)
        trees = [Tree.packed(p) for p in np.split(points, parts, axis=1)]
        cells = [ids.to_numpy().astype("<i8").tobytes(), points.tobytes(), *(list(c) for c in zip(*trees, strict=True))]
        kinds = [pa.binary()] * 2 + [pa.list_(pa.binary())] * 4
        listed = pa.ListArray.from_arrays(pa.array([0, len(labels)], pa.int32()), labels)
        return pa.RecordBatch.from_arrays([*(pa.array([c], k) for c, k in zip(cells, kinds, strict=True)), listed],
                                          names=["ids", "points", "orders", "nodes", "pivots", "sums", "labels"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0
        for batch in batches:
            while batch.num_rows:
                held.append(batch.slice(0, shard_rows - many))
                many += held[-1].num_rows
                batch = batch.slice(held[-1].num_rows)
                if many == shard_rows:
                    yield pack(held)
                    held, many = [], 0
        if held:
            yield pack(held)

    return stage(rows.select("vec_id", "label", "v").mapInArrow(run, schema), "trees")


def read_trees(batch: pa.RecordBatch, k: int, parts: int) -> tuple[np.ndarray, list[Tree]]:
    ids = np.frombuffer(batch.column(0)[k].as_buffer(), "<i8")
    points = np.frombuffer(batch.column(1)[k].as_buffer(), "<i8").reshape(len(ids), -1)
    stored = zip(*(batch.column(c)[k].as_py() for c in (2, 3, 4, 5)), strict=True)
    return ids, [Tree.read(p, *t) for p, t in zip(np.split(points, parts, axis=1), stored, strict=True)]


def moved(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks (part, entry, component) after one round; a task sends one row an entry it met."""
    parts, entries, width = books.shape
    held = trees.sparkSession.sparkContext.broadcast(books)
    names = [f"s{j}" for j in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                for p, tree in enumerate(read_trees(batch, k, parts)[1]):
                    n, s = tree.totals(held.value[p])
                    count[p] += n
                    sums[p] += s
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(count[p, e]), *(pa.array(c) for c in sums[p, e].T)],
                                         names=["part", "entry", "n", *names])

    schema = "part long, entry long, n long, " + ", ".join(f"{c} long" for c in names)
    met = (trees.select(*(x.split()[0] for x in TREES.split(", "))).mapInArrow(run, schema).groupBy("part", "entry")
           .agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in names)).toArrow())  # at most a row an entry
    out = books.copy()
    p, e, n, *sums = (c.to_numpy() for c in met.columns)
    out[p, e] = np.stack(sums, axis=1) // n[:, None]
    return out


def written_out(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def coded(trees: DataFrame, books: np.ndarray, label: str) -> DataFrame:
    """``vec_id, label, code, error`` of every row."""
    held = trees.sparkSession.sparkContext.broadcast(books)
    parts, entries, _ = books.shape
    digits = max(2, len(f"{entries - 1:x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, own = read_trees(batch, k, parts)
                at = [t.nearest(b) for t, b in zip(own, held.value, strict=True)]
                error = sum(((t.points - b[a]) ** 2).sum(axis=1) for t, b, a in zip(own, held.value, at, strict=True))
                code = ["".join(f"{x:0{digits}x}" for x in row) for row in np.stack(at, axis=1).tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(ids), batch.column(6)[k].values, pa.array(code), pa.array(error)],
                                                 names=["vec_id", "label", "code", "error"])

    return trees.mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def vector_codes(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_column: str = "vec_id",
                 vector: str = "embedding", label: str = "label", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every vector."""
    spark = ship(df.sparkSession)

    def work() -> DataFrame:
        rows = usable(df, id_column, vector, label)
        seeds = rows.orderBy("vec_id", "v").limit(1).collect()
        dim = len(seeds[0]["v"]) if seeds else 0
        if not dim or dim % parts:
            return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
        rows = rows.where(F.size("v") == dim)
        first = np.array([r["v"] for r in rows.orderBy("vec_id", "v").limit(entries).collect()], np.int64)
        books = np.stack(np.split(first, parts, axis=1))
        trees = forest(rows, parts, shard_rows)
        for _ in range(rounds):
            books = moved(trees, books)
        out = stage(coded(trees, books, dict(rows.dtypes)["label"]), "codes")
        sums = out.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
        return out.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
            "vec_id", "code", "error", "label_error", F.lit(written_out(books)).alias("codebooks_sha256"))

    return settled(spark, work, "vector-codes")
