from lakestrata.llm.toxicity import Lexicon


def test_terms_with_a_learned_beginning_may_be_misspelled():
    lex = Lexicon({"idiot": 5.0, "idiots": 4.0}, {"idio": 3.0})
    for token in ("ldiot", "iddiots", "idlots"):
        assert lex.judge(token)[0] == "near"
    assert lex.judge("idiot") == ("term", "idiot", 5.0)
    assert lex.judge("idiotic") == ("stem", "idio", 3.0)
    assert lex.judge("idea") is None and lex.judge("patriot") is None
