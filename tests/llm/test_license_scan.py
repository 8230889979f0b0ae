import pytest
from corpus_helpers import no_documents, odd_documents

import __spark_entry__ as entry
from check_queries import compare, connect
from lakestrata.llm.license_scan import PHRASES, TEMPLATES, Automaton, Scanner, digest, license_scan, tree

MIT = dict(TEMPLATES)["mit-text"]
BSD = dict(TEMPLATES)["bsd-text"]


def scanned(spark, texts, **kw):
    docs = spark.createDataFrame([(k, t, "x", "y") for k, t in enumerate(texts)], "doc_id long, text string, labels string, places string")
    return {r["doc_id"]: r for r in license_scan(docs, **kw).collect()}


def labels(row):
    return [(p["label"], p["first"], p["last"]) for p in row["places"]]


def test_query_matches_sql(spark, sf):
    ok, text = compare(spark, connect(sf), "op12", entry.queries()["op12_license_scan"], entry.oracle_sql()["op12_license_scan"], sf)
    assert ok, text


def test_regions(spark):
    templates = [("t", "alpha [beta [gamma]] <x:0-2> delta"), ("u", "<who:1-1> signs [it]")]
    got = scanned(spark, ["Alpha, delta", "alpha beta gamma one two delta.", "alpha beta one two three delta", "alpha gamma beta x delta",
                          "alpha alpha delta delta", "he signs it; she signs", "signs it", "alpha one two", "delta alpha",
                          "x alpha delta alpha beta delta"], phrases=[], templates=templates)
    assert [labels(got[k]) for k in range(10)] == [
        [("t", 0, 1)], [("t", 0, 5)], [], [], [("t", 0, 3)], [("u", 0, 2), ("u", 3, 4)], [], [], [], [("t", 1, 2), ("t", 3, 5)]]


def test_mandatory_wording_is_exact(spark):
    text = MIT.replace("[including the next paragraph]", "(including the next paragraph)")
    whole = "Copyright 2020. " + text.capitalize() + ". THE SOFTWARE IS PROVIDED AS IS"
    without = MIT.replace("[including the next paragraph] ", "")
    changed = without.replace("free of charge", "free of all charge")
    got = scanned(spark, [whole, without, changed, without.rsplit(" ", 1)[0], "a " * 50_000 + without])
    assert [("mit-text" in [p["label"] for p in got[k]["places"]]) for k in range(5)] == [True, True, False, False, True]
    assert labels(got[0])[0][1] == 2 and labels(got[4])[0][1] == 50_000


def test_nested_optional_clause(spark):
    clause = "3 neither the name of the Example Project nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"
    head = BSD[:BSD.index(" [[3]")].replace("[1]", "1.").replace("[2]", "")
    a, b = (labels(scanned(spark, [t])[0]) for t in (head, f"{head} {clause}"))
    assert a[0][0] == b[0][0] == "bsd-text" and b[0][2] - a[0][2] == len(clause.split())


def test_base_places_and_labels(spark):
    text = "MIT License mit-license Apache License, GNU General Public License version 3; released under the MIT License. mit licenses"
    docs = spark.createDataFrame([(1, text), (2, None), (3, ""), (None, "apache license"), (3, "general public licence")], "doc_id long, text string")
    rows = {r["n_words"]: r for r in digest(license_scan(docs)).collect()}
    one = rows[19]
    assert (one["n_base"], one["first_word"], one["last_word"]) == (5, 0, 15)
    assert (one["base_labels"], one["labels"]) == ("apache,gpl,mit", "apache,gpl,mit,mit-grant")
    assert 0 < one["score"] < 1 and rows[2]["labels"] == "apache" and rows[2]["doc_id"] is None
    assert (rows[0]["n_base"], rows[0]["first_word"], rows[0]["labels"], rows[0]["score"]) == (0, None, "", 0.0)
    assert rows[3]["labels"] == "" and len(digest(license_scan(docs)).collect()) == 5


def test_odd_documents(spark):
    docs = odd_documents(spark)
    assert digest(license_scan(docs)).count() == docs.count()
    assert license_scan(no_documents(spark)).count() == 0


def test_markup_errors():
    for bad in ("a [b", "a ] b", "[] a", "<x:1-2>", "[a]"):
        with pytest.raises(ValueError):
            Automaton("x", bad, False, {"a": 1, "b": 2})
    assert tree("a [b [c]] <x:0-3>") == ["a", ["b", ["c"]], (0, 3)]
    assert {a.label for a in Scanner(PHRASES, TEMPLATES).automata} == {k for k, _ in PHRASES + TEMPLATES}
