import numpy as np
import pytest
from corpus_helpers import smallest_reachable

import __spark_entry__ as entry
import corpus_pipeline
from check_queries import compare, connect
from lakestrata.llm.kdtree import top_k
from lakestrata.llm.url_filter import Judge, RULES, SOFT, STRICT, url_filter


@pytest.mark.parametrize("name", ["op8_kdtree_top_k", "op9_url_vocabulary"])
def test_query_matches_sql(spark, sf, name):
    ok, text = compare(spark, connect(sf), name, entry.queries()[name], entry.oracle_sql()[name], sf)
    assert ok, text


def test_urls():
    judge = Judge(RULES, STRICT, SOFT, 2)
    for url, want in {
        "https://m.a.Example.ORG/es/1?x": ("m.a.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org": ("example.org", "", None, "allow"),
        "http://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://badexample.org/es/": ("badexample.org", "/es/", "org/", "allow"),
        "x://y.net/free-casino": ("y.net", "/free-casino", None, "block"),
        "x://y.net/free-freedom/free": ("y.net", "/free-freedom/free", None, "allow"),
        "x://xxx.net/": ("xxx.net", "/", None, "block"), "no scheme/xxx": ("", "", None, "block"), None: ("", "", None, "allow"),
        "http://a.com#/de/": ("a.com", "", None, "allow"),
    }.items():
        assert judge(url)[:2] + judge(url)[2:4] == want[:2] + want[2:], url


def test_odd_pages(spark):
    rows = spark.createDataFrame([(1, None, 5), (None, "http://a.com/de/x", 6), (2, "", 7), (2, "", 7)],
                                 "page_id long, url string, host int")
    got = url_filter(rows).collect()
    assert len(got) == 4 and [r["verdict"] for r in got if r["page_id"] is None] == ["block"]
    assert url_filter(rows.limit(0)).count() == 0


def test_top_k_of_odd_vectors(spark):
    rng = np.random.default_rng(0)
    vectors = [(i, [float(x) for x in rng.integers(-3, 4, 6) / 4], "x") for i in range(300)]
    odd = [(1000, None, "x"), (1001, [1.0, None, 1.0, 1.0, 1.0, 1.0], "x"), (1002, [float("nan")] * 6, "x"),
           (1003, [float("inf")] * 6, "x"), (None, [9.0] * 6, "x"), (1050, [1.0, 2.0], "x"), (7, vectors[7][1], "x"), (1051, [], "x")]
    df = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>, score string")
    got = {}
    for r in top_k(df, df.where("vec_id % 50 = 0"), shard_rows=40).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    code = {i: np.floor(256 * np.array(v)) for i, v, _ in vectors}
    for q in range(0, 300, 50):
        rows = [(-int(code[q] @ code[i]), i) for i in [*code, 7] if i != q]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(sorted(rows)[:5])]
    assert 1050 not in got and 1000 not in got
    assert top_k(df.limit(0), df.limit(0)).count() == 0


def test_pipeline_equals_its_plain_parts(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    columns, left = docs.columns, dict(texts)
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, sf).write.parquet(str(tmp_path / f"{k}"))
        docs = spark.read.parquet(str(tmp_path / f"{k}"))
        rows = docs.collect()
        if name == "packing":
            assert {r["doc_id"] for r in rows} == set(left)
            continue
        assert docs.columns == columns
        now = {r["doc_id"]: r["text"] for r in rows}
        assert len(rows) == len(now)
        if name == "jaccard_join":
            low = smallest_reachable(sorted(left.items()))
            assert set(now) == {i for i in left if low[i] == i}
        if name == "decontamination":
            assert not any(t in x for x in now.values() for t in items)
            assert len(left) - len(now) <= 2 + sum(any(t in x for t in items) for x in left.values())
        if name == "pii":
            assert set(now) == set(left) and any(now[i] != left[i] for i in left)
        left = now
    assert corpus_pipeline.run(spark, sf).count() == len(rows)
