from collections import Counter

import numpy as np
from corpus_helpers import shingles

from lakestrata.llm.jaccard_join import jaccard_join


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    reps, n = sorted(first.values()), Counter()
    for k, a in enumerate(reps):
        for b in reps[k + 1:]:
            o = len(sets[a] & sets[b])
            if 100 * o >= 80 * len(sets[a] | sets[b]) and o:
                n[a] += 1
                n[b] += 1
    return {i: n[first[s]] for i, s in sets.items()}


def test_links_equal_comparing_everything(spark):
    rng = np.random.default_rng(6)
    base = [f"w{k}" for k in range(80)]
    rows = []
    for k in range(40):  # different texts of one group, more than a short list holds
        words = base + [f"only{k}"]
        if k % 4 == 0:
            words[rng.integers(0, 80)] = f"x{k}"
        rows.append((k, " ".join(words)))
    rows += [(100 + k, " ".join([f"v{x}" for x in range(60)] + [f"end{k // 2}"])) for k in range(6)]
    rows += [(200 + k, " ".join(base[:10] + [f"r{k}_{x}" for x in range(50)])) for k in range(30)]  # a common line
    want = brute(rows)
    assert max(want.values()) > 16
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for short in (1, 16):
        assert {r["doc_id"]: r["links"] for r in jaccard_join(docs, short=short).collect()} == want
