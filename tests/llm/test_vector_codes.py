import hashlib
from collections import defaultdict

import numpy as np

import __spark_entry__ as entry
from check_queries import compare, connect
from lakestrata.llm.vector_codes import Builder, Tree, vector_codes

SCHEMA = "vec_id long, embedding array<double>, label string, code string, error int"


def plain(rows, parts, entries, rounds):
    """Every part compared with every entry."""
    rows = sorted(rows, key=lambda r: (r[0], r[1]))
    x = np.floor(1024 * np.array([v for _, v, _ in rows])).astype(np.int64).reshape(len(rows), parts, -1)
    books = x[:entries].copy()  # entry, part, component

    def nearest():
        gap = ((x[:, None] - books[None]) ** 2).sum(-1)  # row, entry, part
        return gap.argmin(axis=1), gap.min(axis=1).sum(axis=1)

    for _ in range(rounds):
        at, _ = nearest()
        for p in range(parts):
            for e in range(len(books)):
                own = x[at[:, p] == e, p]
                if len(own):
                    books[e, p] = own.sum(axis=0) // len(own)
    at, error = nearest()
    sums = defaultdict(int)
    for (_, _, label), e in zip(rows, error, strict=True):
        sums[label] += int(e)
    text = ",".join(map(str, books.transpose(1, 0, 2).ravel().tolist()))
    sha = hashlib.sha256(text.encode()).hexdigest()
    return sorted((i, "".join(f"{e:02x}" for e in a), int(d), sums[label], sha)
                  for (i, _, label), a, d in zip(rows, at.tolist(), error, strict=True))


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], SCHEMA).repartition(3)


def test_query_matches_sql(spark, sf):
    ok, text = compare(spark, connect(sf), "op13", entry.queries()["op13_vector_codes"], entry.oracle_sql()["op13_vector_codes"], sf)
    assert ok, text


def test_equals_plain_rounds(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(12, 8))
    rows = [(int(i), (centers[i % 12] + rng.normal(size=8) / 50).tolist(), ["a", "b", None][i % 3]) for i in range(900)]
    got = vector_codes(frame(spark, rows), entries=40, shard_rows=150)
    assert sorted(map(tuple, got.collect())) == plain(rows, 4, 40, 4)


def test_ties_copies_and_unused_entries(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.integers(-2, 3, 8) / 4).tolist(), "x") for i in range(500)]       # a grid: many equal distances
    rows += [(1000 + i, rows[7][1], "hot") for i in range(600)] + [(3, rows[3][1], None)]  # one large group of one vector
    got = vector_codes(frame(spark, rows), entries=64, shard_rows=256)
    assert sorted(map(tuple, got.collect())) == plain(rows, 4, 64, 4)


def test_odd_rows(spark):
    rows = [(5, [0.5] * 8, "a"), (6, [0.25] * 8, None), (7, [-1e-9] * 8, None)]
    odd = [(1, None, "a"), (2, [1.0, None] * 4, "a"), (3, [float("nan")] * 8, "a"), (4, [float("inf")] + [0.0] * 7, "a"),
           (None, [0.5] * 8, "a"), (9, [0.5] * 4, "a"), (10, [], "a")]
    got = vector_codes(frame(spark, rows + odd)).collect()
    assert sorted(map(tuple, got)) == plain(rows, 4, 256, 4)
    assert [r["error"] for r in got] == [0, 0, 0] and sorted(r["code"] for r in got) == ["00000000", "01010101", "02020202"]
    assert vector_codes(frame(spark, rows).limit(0)).count() == 0
    assert vector_codes(frame(spark, [(1, [1.0] * 6, "a")])).count() == 0


def test_most_balls_are_owned_whole():
    rng = np.random.default_rng(6)
    book = np.floor(rng.normal(size=(16, 4)) * 10_000).astype(np.int64)
    points = (book[rng.integers(0, 16, 4000)] + rng.integers(-50, 51, (4000, 4))).astype(np.int64)
    tree = Tree.read(points, *Tree.packed(points))
    owners = list(tree.owners(book))
    looked_at = sum(len(each) for _, entry, each in owners if entry < 0)
    assert looked_at < 400 and len(owners) < 1000
    assert np.array_equal(tree.nearest(book), ((points[:, None] - book[None]) ** 2).sum(-1).argmin(1))


def test_tree_covers_its_points():
    points = np.random.default_rng(7).integers(-9, 10, (700, 3))
    grown = Builder(points)
    assert sorted(np.concatenate(grown.order).tolist()) == list(range(700))
    assert len(grown.members[grown.root]) == 700 and grown.root == len(grown.nodes) - 1
    for node, pivot, members in zip(grown.nodes, grown.pivots, grown.members, strict=True):
        assert np.sqrt(((points[members] - pivot) ** 2).sum(1)).max() <= node[4] + 1e-9
