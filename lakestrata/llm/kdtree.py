"""Exact top-k by inner product with a KD-tree per shard.

Vectors become integers, floor(256 x) of each component. Rows are dealt into shards by a hash
of their id; each shard builds a tree by median splits along its widest axis and keeps the
tight bounding box of every node. A query is searched best first: nodes are taken by the
largest inner product their box admits, and the search ends once that is below the kth score
known so far. Queries travel in blocks. Each block first visits one shard; its kth scores go
with it to all other shards, where most nodes then fall below them. The best k of all visits
are the exact result; equal scores go to the smaller id.

Vectors of another length than a query's are no candidates of it. Null vectors, vectors with
null or non-finite components and rows with a null id take no part; of rows repeating an id
each is a candidate, but none of that id's own queries, and the smallest vector is its query.
Fewer candidates than k give fewer rows; an empty table gives none. Other columns are ignored.
Scores have to fit a long.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stage

K = 5
SHARD_ROWS = 8192
BLOCK = 512
BLOCKS_A_TASK = 8
LEAF = 64
EXACT = 1 << 53


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer matrix product; through floating point where that is exact."""
    if not a.size or not b.size:
        return np.zeros((a.shape[0], b.shape[1]), np.int64)
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    return (a.astype(float) @ b.astype(float)).astype(np.int64) if most < EXACT else a @ b


class Tree:
    """Nodes in arrays: a box each, the two children or a range of points."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        order = np.arange(len(ids))
        lo, hi, kids, spans = [], [], [], []

        def grow(a: int, b: int) -> int:
            own = points[order[a:b]]
            k = len(lo)
            lo.append(own.min(axis=0))
            hi.append(own.max(axis=0))
            kids.append((-1, -1))
            spans.append((a, b))
            axis = int(np.argmax(hi[k] - lo[k]))
            if b - a > LEAF and hi[k][axis] > lo[k][axis]:
                mid = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(own[:, axis], mid)]
                kids[k] = (grow(a, a + mid), grow(a + mid, b))
            return k

        grow(0, len(ids))
        self.ids, self.points = ids[order], points[order]
        self.lo, self.hi, self.kids, self.spans = np.array(lo), np.array(hi), kids, spans

    def search(self, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
        """Query number, id and score of each query's best k that reach its floor."""
        bound = product(np.maximum(queries, 0), self.hi.T) + product(np.minimum(queries, 0), self.lo.T)
        for q in range(len(queries)):
            best: list[tuple[int, int]] = []  # (score, -id), smallest first
            kth = int(floor[q])
            row = bound[q]
            heap = [(-int(row[0]), 0)]
            while heap:
                top, node = heapq.heappop(heap)
                if -top < kth:
                    break
                left, right = self.kids[node]
                if left >= 0:
                    for child in (left, right):
                        if row[child] >= kth:
                            heapq.heappush(heap, (-int(row[child]), child))
                    continue
                a, b = self.spans[node]
                score = product(self.points[a:b], queries[q][:, None])[:, 0]
                for i in np.flatnonzero((score >= kth) & (self.ids[a:b] != own[q])):
                    item = (int(score[i]), -int(self.ids[a + i]))
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
                if len(best) == k:
                    kth = max(kth, best[0][0])
            for score, neg in best:
                yield q, -neg, score


def codes(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("long"))


def usable(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (df.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull()).where(~bad)
            .select(F.col(id_column).cast("long").alias("vec_id"), codes(F.col(vector)).alias("v"))
            .withColumn("dim", F.size("v")).where("dim > 0"))


def packed(pdf: pd.DataFrame) -> bytes:
    return np.array(pdf["v"].tolist(), "<i8").tobytes()


def top_k(df: DataFrame, queries: DataFrame, k: int = K, id_column: str = "vec_id", vector: str = "embedding",
          shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each row of ``queries`` against every row of ``df``."""
    spark = ship(df.sparkSession)
    rows = usable(df, id_column, vector)
    n, m = rows.count(), queries.count()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-m // BLOCK))

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        ids = pdf["vec_id"].to_numpy()
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "ids": [ids.astype("<i8").tobytes()], "points": [packed(pdf)]})

    shard = F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int").alias("shard")
    trees = stage(rows.select("*", shard).groupBy("dim", "shard").applyInPandas(
        build, "dim int, shard int, ids binary, points binary"), "trees")

    asked = usable(queries, id_column, vector).groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("x"))
    asked = asked.select("vec_id", "x.dim", "x.v", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"))

    def gather(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"dim": [key[0]], "block": [key[1]], "ids": [pdf["vec_id"].to_numpy().astype("<i8").tobytes()],
                             "points": [packed(pdf)]})

    whole = asked.groupBy("dim", "block").applyInPandas(gather, "dim int, block int, ids binary, points binary")
    whole = stage(whole.withColumn("home", F.pmod(F.xxhash64("block"), F.lit(shards)).cast("int")), "blocks")

    nothing = F.lit(None).cast("array<struct<query_id:long,score:long>>")

    def visit(visits: DataFrame) -> DataFrame:
        """Searches (block, shard) pairs; a task holds one tree and a few blocks."""

        def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            out, dim = [], int(key[0])
            left, right = pdf[pdf["is_tree"]], pdf[~pdf["is_tree"]]
            ids, points = (np.frombuffer(left[c].iloc[0], "<i8") for c in ("ids", "points"))
            tree = Tree(ids, points.reshape(-1, dim))
            for own, vectors, floors in zip(right["ids"], right["points"], right["floors"], strict=True):
                own, vectors = np.frombuffer(own, "<i8"), np.frombuffer(vectors, "<i8").reshape(-1, dim)
                floor = np.full(len(own), np.iinfo(np.int64).min)
                if floors is not None and len(floors):
                    known = {f["query_id"]: f["score"] for f in floors}
                    floor = np.array([known.get(int(i), f) for i, f in zip(own, floor, strict=True)], np.int64)
                out += [(int(own[q]), i, s) for q, i, s in tree.search(vectors, own, floor, k)]
            return pd.DataFrame(out, columns=["query_id", "vec_id", "score"], dtype="int64")

        columns = ["dim", "shard", "group", "ids", "points", "floors", "is_tree"]
        visits = visits.withColumn("group", F.floor(F.col("block") / BLOCKS_A_TASK).cast("int")).withColumn(
            "is_tree", F.lit(False))
        keys = visits.select("dim", "shard", "group").distinct()
        met = trees.join(keys, ["dim", "shard"]).withColumns({"floors": nothing, "is_tree": F.lit(True)})
        return (met.select(*columns).union(visits.join(trees.select("dim", "shard"), ["dim", "shard"], "left_semi").select(*columns))
                .groupBy("dim", "shard", "group").applyInPandas(run, "query_id long, vec_id long, score long"))

    first = stage(visit(whole.select("dim", "block", "ids", "points", F.col("home").alias("shard"), nothing.alias("floors"))),
                  "first")
    kth = (first.groupBy("query_id").agg(F.min("score").alias("score"), F.count("*").alias("found")).where(F.col("found") >= k)
           .select(F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"), F.struct("query_id", "score").alias("f"))
           .groupBy("block").agg(F.collect_list("f").alias("floors")))
    others = (whole.join(kth, "block", "left")
              .select("*", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")).where("shard != home"))
    found = first.union(visit(others.select("dim", "block", "ids", "points", "shard", "floors"))) if shards > 1 else first
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
