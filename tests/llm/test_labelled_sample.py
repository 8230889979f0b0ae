import pickle

from lakestrata.llm.common import held_out, labelled_sample
from lakestrata.llm.toxicity import Lexicon, form, learn, term_counts


def learned_ids(spark, n):
    rows = spark.range(200).withColumnRenamed("id", "doc_id")
    return [r.doc_id for r in rows.where(~held_out(rows.doc_id)).orderBy("doc_id").limit(n).collect()]


def test_a_repeated_id_counts_once(spark):
    a, b, c = learned_ids(spark, 3)
    docs = spark.createDataFrame([(a, f"text {k % 7}") for k in range(500)] + [(b, None), (b, None), (c, "own")],
                                 "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(a, 1), (b, 0), (c, 0)], "doc_id long, toxic int")
    rows = labelled_sample(docs, labels, "toxic", 10).collect()
    assert sorted((r.doc_id, r.y) for r in rows) == [(a, 1), (b, 0), (c, 0)]
    assert {r.doc_id: r.text for r in rows}[b] == ""
    assert labelled_sample(docs, labels, "toxic", 2).count() == 2
    again = labelled_sample(docs.repartition(3), labels, "toxic", 10).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_terms_of_any_form_and_length(spark):
    long = "z" * 300
    rows = spark.createDataFrame([(1, f"Ab, x-ray {long} 1diot! o'er"), (0, "")], "y int, text string")
    found = {r.term for r in term_counts(rows).collect() if not r.stem}
    assert found == {"ab", "x-ray", long, "idiot", "o'er"}
    lex = Lexicon({"x-ray": 5.0, long: 4.0, "ab": 3.0}, {})
    assert lex.judge("X-ray.")[0] == lex.judge(long)[0] == lex.judge("(ab)")[0] == "term"
    assert lex.judge("x-rays")[0] == lex.judge(long[:-1])[0] == "near"
    deep = pickle.loads(pickle.dumps(Lexicon({"q" * 20_000: 1.0}, {})))
    assert deep.judge("q" * 19_999)[0] == "near"


def test_outer_marks_go_and_inner_ones_stay():
    assert form("((x-ray))!") == "x-ray" and form("...") == "" and form("St0p.") == "stop"
    assert form("-" * 200_000 + "a" + "-" * 200_000 + "b") == "a" + "-" * 200_000 + "b"


def test_every_learned_term_is_kept(spark):
    ids = learned_ids(spark, 60)
    bad = " ".join(f"vile{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(400))
    texts = [(i, f"{bad} note{k} only{k} here{k} and{k} now{k}" if k % 2 else f"plain words of day{k} are{k} fine{k} as{k} ever{k}")
             for k, i in enumerate(ids)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, toxic int")
    # near copies count once, so the toxic texts are told apart by an order of their own
    docs = docs.selectExpr("doc_id", "array_join(transform(array_sort(transform(split(text, ' '), "
                           "w -> struct(xxhash64(w, doc_id) AS h, w AS w))), s -> s.w), ' ') AS text")
    lex, _ = learn(docs, labels)
    assert sum(t.startswith("vile") for t in lex.terms) == 400
