from collections import Counter

import numpy as np

from lakestrata.llm.cross_entropy import cross_entropy_difference, good_documents


def plain(texts, target):
    """Losses of a model with every word and bigram, by plain dictionaries."""
    out = {}
    models = []
    for rows in ([t for i, t in texts if i in target], [t for _, t in texts]):
        words, pairs = Counter(), Counter()
        for t in rows:
            w = t.split()
            words.update(w)
            pairs.update(zip(["<s>", *w], w, strict=False))
        sums, kinds = Counter(), Counter()
        for (u, _), n in pairs.items():
            sums[u] += n
            kinds[u] += 1
        models.append((words, pairs, sums, kinds))
    known = len(models[1][0])
    for i, t in texts:
        w = t.split()
        loss = []
        for words, pairs, sums, kinds in models:
            x = 0.0
            for u, v in zip(["<s>", *w], w, strict=False):
                size = max(words[u], sums[u], 1)
                left = max(1 - (sums[u] - 0.75 * kinds[u]) / size, 1e-6)
                x -= np.log(left * (words[v] + 0.5) / (sum(words.values()) + 0.5 * (known + 1)) + max(pairs[u, v] - 0.75, 0) / size)
            loss.append(x / len(w))
        out[i] = loss
    return out


def test_every_word_and_bigram_counts(spark):
    rng = np.random.default_rng(5)
    texts = [(k, " ".join(f"w{x}" for x in rng.zipf(1.3, 60) % 5000)) for k in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([(k,) for k in range(0, 60, 3)], "doc_id long")
    want = plain(texts, set(range(0, 60, 3)))
    # what is broadcast and which words are dealt by bigram changes nothing
    for words, pairs, tokens in ((8, 8, 1 << 20), (1 << 16, 1 << 20, 1 << 20), (8, 8, 40), (1 << 16, 1 << 20, 40), (1, 1, 4)):
        got = cross_entropy_difference(docs, target, words, pairs, least=1, range_tokens=tokens).collect()
        assert len(got) == 60
        for r in got:
            assert np.allclose([r["target_loss"], r["background_loss"]], want[r["doc_id"]], atol=1e-9)


def test_rare_words_are_known_whatever_is_broadcast(spark):
    texts = [(k, f"often often rare{k % 3} word{k % 3} often") for k in range(9)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    target = spark.createDataFrame([(0,), (3,)], "doc_id long")
    few, many, hot = ({r["doc_id"]: r["score"] for r in cross_entropy_difference(docs, target, n, n, range_tokens=r).collect()}
                      for n, r in ((1, 1 << 20), (1 << 16, 1 << 20), (1, 6)))
    assert all(abs(few[k] - many[k]) < 1e-9 and abs(few[k] - hot[k]) < 1e-9 for k in few) and few[0] < few[1]


def test_all_good_labels_are_the_target(spark):
    labels = spark.range(60_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    assert good_documents(labels).count() > 40_000
