import re
from zlib import crc32

import numpy as np
from corpus_helpers import TEXTS, no_documents, odd_documents

from lakestrata.llm import pii, toxicity as tox
from lakestrata.llm.cross_entropy import cross_entropy_difference
from lakestrata.llm.decontamination import build, contamination, wand
from lakestrata.llm.quality_rules import quality, rules_of
from lakestrata.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int"


def luhn(s: str) -> bool:
    d = [int(c) for c in s[::-1]]
    return sum(sum(divmod(2 * x, 10)) if i % 2 else x for i, x in enumerate(d)) % 10 == 0


def auc(rows, label):
    one = [r["score"] for r in rows if label[r["doc_id"]] == 1]
    zero = [r["score"] for r in rows if label[r["doc_id"]] == 0]
    return np.mean([(a > b) + 0.5 * (a == b) for a in one for b in zero])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    for name, column, least in (("op1_toxicity", "toxic", 0.75), ("op4_rule_quality", "quality", 0.95)):
        label = {r["doc_id"]: r[column] for r in labels}
        rows = QUERIES[name](spark, sf).collect()
        assert len(rows) == 1000 and all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
        held = [r for r in rows if r["held_out"] and r["doc_id"] in label]
        assert auc(held, label) > least


def test_odd_rows_are_scored(spark):
    docs = odd_documents(spark)
    for labels in ([], [(1, 1, 0), (7, 0, 1), (3, None, None), (None, 1, 1), (99, 0, 0)]):
        table = spark.createDataFrame(labels, LABELS)
        for operator in (tox.toxicity, quality):
            rows = operator(docs, table).collect()
            assert len(rows) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
            assert not any(r["held_out"] for r in rows if r["doc_id"] is None)
            assert operator(no_documents(spark), table).count() == 0


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_walk_equals_edit_distance():
    rng = np.random.default_rng(2)
    terms = {"".join(rng.choice(list("abc"), n)) for n in rng.integers(1, 7, 60)}
    trie: dict = {}
    for t in terms:
        node = trie
        for c in t:
            node = node.setdefault(c, {})
        node[""] = t
    for word in ["".join(rng.choice(list("abc"), n)) for n in rng.integers(0, 7, 40)]:
        for most in (0, 1, 2):
            assert set(tox.automaton_walk(trie, word, most)) == {t for t in terms if distance(t, word) <= most}


def test_misspelling_and_quotation():
    lex = tox.Lexicon({"worthless": 5.0}, {})
    assert lex.judge("w0rthless!!")[0] == "term" and lex.judge("wortless")[0] == "near" and lex.judge("worth") is None
    from lakestrata.llm import kernel

    texts = [b"you are worthless here", b'he said "worthless" here', b"plain text"]
    offs = np.cumsum([0, *map(len, texts)])
    x = tox.Scorer(lex).features(kernel.words(np.frombuffer(b"".join(texts), np.uint8), offs))
    k = tox.FEATURES.index("abuse"), tox.FEATURES.index("quotation")
    assert x[0, k[0]] > x[1, k[0]] > 0 and x[1, k[1]] > x[0, k[1]] == 0 and not x[2].any()


def test_pseudonyms(spark):
    docs = odd_documents(spark)
    out = pii.pseudonymize(docs)
    assert out.columns == docs.columns
    new = {r["doc_id"]: r["text"] for r in out.collect() if r["doc_id"] is not None}
    old = {i: t for i, t in TEXTS if i is not None}
    assert all(new[i] == old[i] for i in old if i < 14)
    cards = [re.search(r"card ([0-9]{16})", new[i])[1] for i in (14, 15)]
    assert cards[0] == cards[1] != "4845168114407329" and luhn(cards[0])
    assert "9807915762804490" in new[14] and "x.y@" not in new[14] and "@mail.example.com" in new[14]
    assert "10.20.30.40" not in new[15] and "2021-02-28" not in new[15] and "2021-02-30" in new[15]
    assert pii.pseudonymize(no_documents(spark)).count() == 0


def test_permutations_are_one_to_one(spark):
    from pyspark.sql import functions as F

    days = spark.sql("SELECT explode(sequence(DATE'1900-01-01', DATE'2099-12-31', INTERVAL 3 DAY)) AS d").select(
        F.date_format("d", "yyyy-MM-dd").alias("v"))
    got = days.select(pii.date(F.col("v"), "k").alias("v")).distinct().count()
    assert got == days.count()
    numbers = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("v"))
    got = numbers.select(pii.permuted_digits(F.col("v"), "t", "k").alias("v")).distinct().collect()
    assert len(got) == 1000 and all(re.fullmatch("[0-9]{3}", r["v"]) for r in got)


def test_leaks_equal_plain_search(spark, sf):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r["doc_id"], r["item_id"]) for r in contamination(docs, items).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = {(d, r["item_id"]) for r in items.collect() for d, t in texts.items() if r["text"] in t}
    assert want and want <= got and len(got - want) <= 2
    parts = {(r["doc_id"], r["item_id"]) for r in contamination(docs, items, part_words=300).collect()}
    assert want <= parts


def test_wand_equals_scoring_everything():
    rng = np.random.default_rng(4)
    items = [(k, " ".join(f"t{x}" for x in rng.integers(0, 12, 30))) for k in range(300)]
    index = build(items)
    for _ in range(30):
        terms = np.unique(rng.integers(0, len(index.terms), 40))
        score = np.zeros(300)
        for t in terms:
            s = slice(index.first[t], index.first[t + 1])
            score[index.segments[s]] += index.weights[s]
        got = dict(wand(index, terms, 0.2))
        assert set(got) == set(np.flatnonzero(score >= 0.2 - 1e-9).tolist())
        assert all(abs(score[k] - v) < 1e-9 for k, v in got.items())


def test_leaks_of_odd_rows(spark):
    items = spark.createDataFrame([(1, TEXTS[0][1]), (2, None), (3, ""), (4, "one"), (4, "one")], "item_id long, text string")
    got = contamination(odd_documents(spark), items).collect()
    assert {r["doc_id"] for r in got if r["item_id"] == 1} == {1, 2, 3, 13, None}
    assert {r["doc_id"] for r in got if r["item_id"] == 4} == {7, 8}
    assert contamination(no_documents(spark), items).count() == 0
    assert contamination(odd_documents(spark), items.where("item_id = 9")).count() == 0


def test_cross_entropy_equals_a_plain_model(spark):
    texts = [(1, "a b a b c"), (2, "a b a b d"), (3, "c d c d c d"), (4, None), (None, "a zzz"), (5, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    target = spark.createDataFrame([(1,), (2,), (None,)], "doc_id long")
    got = {r["doc_id"]: r for r in cross_entropy_difference(docs, target).collect()}
    from collections import Counter

    def model(rows):
        words, pairs = Counter(), Counter()
        for t in rows:
            w = (t or "").split()
            words.update(w)
            pairs.update(zip(["<s>", *w], w, strict=False))
        return words, pairs

    every, some = model([t for _, t in texts]), model([t for i, t in texts if i in (1, 2)])
    known = {w for w, n in every[0].items() if n > 1}
    name = lambda w: w if w in known else "?"

    def loss(text, m):
        words, pairs = Counter(), Counter()
        for w, n in m[0].items():
            words[name(w)] += n
        for (u, w), n in m[1].items():
            pairs[u if u == "<s>" else name(u), name(w)] += n
        shared = Counter()
        for (u, w), n in every[1].items():
            shared[u if u == "<s>" else name(u), name(w)] += n
        kept = {p for p, n in shared.items() if n > 1}
        total, out, before = sum(words.values()), 0.0, "<s>"
        size = Counter()
        for (u, _), n in ((p, pairs[p]) for p in kept):
            size[u] += n
        for w in map(name, (text or "").split()):
            context = max(size[before], words[before]) if before != "<s>" else size[before]
            part = {p: max(pairs[p] - 0.75, 0) / max(context, 1) for p in kept if p[0] == before}
            left = max(1 - sum(part.values()), 1e-6)
            uni = (words[w] + 0.5) / (total + 0.5 * (len(known) + 1))
            out -= np.log(left * uni + part.get((before, w), 0))
            before = w
        return out

    for i, t in texts:
        n = len((t or "").split())
        assert got[i]["tokens"] == n
        if n:
            assert abs(got[i]["target_loss"] - loss(t, some) / n) < 1e-9
            assert abs(got[i]["background_loss"] - loss(t, every) / n) < 1e-9
        else:
            assert got[i]["score"] == 0
    assert cross_entropy_difference(no_documents(spark), target).count() == 0


def test_rules_of_a_description():
    text = """RandomForestClassificationModel
  Tree 0 (weight 1.0):
    If (feature 3 <= 0.5)
     If (feature 4 <= 0.1)
      Predict: 0.0
     Else (feature 4 > 0.1)
      Predict: 1.0
    Else (feature 3 > 0.5)
     Predict: 1.0
"""
    low, high = float("-inf"), float("inf")
    assert rules_of(text) == {(("upper", low, 0.5),), (("upper", 0.5, high),), (("digits", low, 0.1), ("upper", low, 0.5)),
                              (("digits", 0.1, high), ("upper", low, 0.5))}
