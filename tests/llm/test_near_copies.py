from corpus_helpers import LONG, TEXTS, no_documents, odd_documents, shingles, smallest_reachable

import numpy as np
from lakestrata.llm import kernel
from lakestrata.llm.components import components
from lakestrata.llm.jaccard_join import jaccard_join, t_occurrence


def rows_of(spark, sf):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def test_sets_have_the_size_of_plain_ones():
    texts = [t for _, t in TEXTS] + ["a b c d e a b c d e", "x\x0by z", "Ünï cödé"]
    data = [(t or "").encode() for t in texts]
    offs = np.cumsum([0, *map(len, data)])
    sets = kernel.shingle_sets(kernel.words(np.frombuffer(b"".join(data), np.uint8), offs), 5)
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]


def test_same_components_as_comparing_everything(spark, sf):
    want = smallest_reachable(rows_of(spark, sf))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for short in (1, 16):  # 1: every list takes the way of the long ones
        got = {r["doc_id"]: r["component_id"] for r in jaccard_join(docs, short=short).collect()}
        assert got == want


def test_odd_rows(spark):
    got = jaccard_join(odd_documents(spark)).collect()
    assert len(got) == len(TEXTS)
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert {by[i]["component_id"] for i in (1, 2, 3, 13)} == {1}
    assert (by[4]["n_shingles"], by[4]["component_id"]) == (0, 4) and by[6]["n_shingles"] == 0
    assert by[7]["component_id"] == by[8]["component_id"] == 7 and by[7]["n_shingles"] == 1
    assert by[10]["component_id"] == by[11]["component_id"] == 10
    assert by[10]["n_shingles"] == len(shingles(LONG))
    assert sorted((r["component_id"] for r in got if r["doc_id"] is None), key=str) == [1, None]


def test_empty_table(spark):
    assert jaccard_join(no_documents(spark)).count() == 0


def test_t_occurrence_finds_all_and_only_links():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 1 << 40, 80, dtype=np.uint64))
    sets = [np.unique(np.where(rng.random(len(base)) < p, rng.integers(0, 1 << 40, len(base), dtype=np.uint64), base))
            for p in rng.uniform(0, 0.3, 60)]
    got = {(q, int(j)) for q, found in t_occurrence(sets, sets, 80) for j in found}
    want = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets)
            if 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))}
    assert got == want


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (None, 5)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
