import re
from collections import Counter, defaultdict
from math import floor, log

import numpy as np
import pytest
from corpus_helpers import TEXTS, no_documents, odd_documents

import __spark_entry__ as entry
from check_queries import compare, connect
from lakestrata.llm import lexical_search
from lakestrata.llm.lexical_search import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain(docs, items, k):
    """Every document scored for every item, from the stated formula."""
    bags = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    bags = [b for b in bags if b[2]]
    n_docs, n_terms = len(bags), sum(b[2] for b in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(terms(t))
    out = {}
    for i, own in asked.items():
        rows = []
        for d, bag, n in bags:
            m = 50 + 50 * n * n_docs // n_terms
            score = sum(floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 20 * m))
                        for t in own if bag[t])
            if score > 0:
                rows.append((-score, d is None, d))
        rows = sorted(rows, key=lambda r: (r[0], r[1], r[2] or 0))[:k]
        if rows:
            out[i] = [(r + 1, d, -s) for r, (s, _, d) in enumerate(rows)]
    return out


def result(df):
    got = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        got[r["item_id"]].append((r["rank"], r["doc_id"], r["score"]))
    return dict(got)


def test_query_matches_sql(spark, sf):
    ok, text = compare(spark, connect(sf), "op11", entry.queries()["op11_lexical_search"],
                       entry.oracle_sql()["op11_lexical_search"], sf)
    assert ok, text


@pytest.mark.parametrize("block_terms", [1 << 18, 9])
@pytest.mark.parametrize("piece", [4096, 3])
def test_equals_plain_search_over_odd_rows(spark, monkeypatch, block_terms, piece):
    monkeypatch.setattr(lexical_search, "PIECE_DOCS", piece)
    monkeypatch.setattr(lexical_search, "FIRST", 1)
    items = [(1, "w1 w2 W3, w59"), (2, "one two ÉÉ nothing"), (3, None), (4, " ,;"), (None, "longword5 tail"), (5, "w7 w8"),
             (5, "w9 w9 card"), (6, "é" * 5000)]
    asked = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, rank int, doc_id string")
    assert result(search(odd_documents(spark), asked, k=3, block_terms=block_terms)) == plain(TEXTS, items, 3)


def test_equal_lengths_and_many_ties(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "PIECE_DOCS", 64)
    monkeypatch.setattr(lexical_search, "HELD", 16)
    rng = np.random.default_rng(5)
    docs = [(int(i), " ".join(f"t{x}" for x in rng.zipf(1.5, rng.choice([4, 4, 4, 12, 40])) % 50)) for i in rng.permutation(1500)]
    docs += [(i, "t1 t2 t3 t49") for i in range(5000, 5700)]  # a large group of one text
    items = [(i, " ".join(f"t{x}" for x in rng.integers(0, 50, 6))) for i in range(12)]
    got = search(spark.createDataFrame(docs, "doc_id long, text string").repartition(6),
                 spark.createDataFrame(items, "item_id long, text string"), k=20)
    assert result(got) == plain(docs, items, 20)


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert search(no_documents(spark), items).count() == 0
    assert search(odd_documents(spark), items.limit(0)).count() == 0
    assert search(odd_documents(spark).where("text is null"), items).count() == 0
