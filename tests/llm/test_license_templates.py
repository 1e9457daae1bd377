import itertools
import random

import pytest

from corpusflow.llm import license_templates as L
from corpusflow.llm import q_llm


def test_oracle_sql(spark, sf, duck):
    got = q_llm.op9_license_templates(spark, sf).toPandas().sort_values("doc_id").reset_index(drop=True)
    want = duck.sql(q_llm.ORACLE_SQL["op9_license_templates"]).df()[list(got.columns)].sort_values("doc_id").reset_index(drop=True)
    assert got.equals(want.astype(got.dtypes.to_dict()))
    assert (got.score == 1).any() and got.labels.str.contains("cc-by-nc-4.0").any()


def language(parts):
    """All word sequences of a template, '*' for any word."""
    out = [[]]
    for p in parts:
        if isinstance(p, str):
            more = [[p]]
        elif p[0] == "optional":
            more = [[]] + language(p[1])
        else:
            more = [["*"] * n for n in range(p[1], p[2] + 1)]
        out = [a + b for a in out for b in more]
    return out


@pytest.mark.parametrize("markup", ["a b<<beginOptional>> c <<beginOptional>>d<<endOptional>> e<<endOptional>> f",
                                    "a b <<var;name=x;words=0-2>> c", "a b <<var;name=x;words=1-2>><<beginOptional>> a<<endOptional>>"])
def test_automaton_accepts_its_language(markup):
    rng, auto, lang = random.Random(1), L.TokenAutomaton(markup), language(L.parse(markup))
    for n in range(1, 6):
        for seq in itertools.islice(itertools.product("abcdef", repeat=n), 0, 4000, 3):
            seq = ["a", "b", *seq] if rng.random() < 0.7 else list(seq)
            want = max((len(x) for x in lang if len(x) <= len(seq) and all(p in ("*", w) for p, w in zip(x, seq))), default=0)
            assert auto.longest(seq) == want


def test_bad_markup():
    for bad in ("<<beginOptional>>a", "a<<endOptional>>", "a b <<var;name=x>>"):
        with pytest.raises(ValueError):
            L.parse(bad)
    with pytest.raises(ValueError):
        L.Scanner([("x", "<<var;words=1-2>> a b")])


def test_wording_must_match(spark, odd_docs, no_docs):
    mit = dict(L.TEMPLATES)["mit-text"].replace("<<var;name=work;words=1-8>>", "this fine software").replace(
        "<<beginOptional>> (including the next paragraph)<<endOptional>>", "")
    rows = [(1, "X " + mit.upper()), (2, mit.replace("without restriction", "with restriction")), (3, "gnu general public license"),
            (4, "Licensed under the Apache License 2.0; licensed under the apache license, version 2.0"), (5, None), (6, "mit mit license")]
    got = {r["doc_id"]: r for r in L.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["labels"] == "mit-text" and got[2]["labels"] == "" and got[1]["places"][0]["from"] == 1
    assert (got[3]["base_labels"], got[3]["score"], got[3]["n_base"]) == ("gpl", 0.5, 1)
    assert got[4]["labels"] == "apache,apache-2.0" and len(got[4]["places"]) == 2 and (got[4]["first_word"], got[4]["last_word"]) == (3, 10)
    assert got[5]["n_words"] == 0 and got[5]["first_word"] is None and got[6]["first_word"] == 1
    odd = L.scan(odd_docs)
    assert odd.count() == odd_docs.count() and odd.filter("score > 0").count() == 0 and L.scan(no_docs).count() == 0
