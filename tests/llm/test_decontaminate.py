import hashlib
import random
import re

import numpy as np
import pytest

from corpusflow.llm import arrays as A
from corpusflow.llm import decontaminate as D
from corpusflow.llm import q_llm

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(text, items):
    w, hit, ids = words(text), set(), set()
    for item, t in items:
        x = words(t)
        k = min(10, len(x))
        wins = {tuple(x[i:i + k]) for i in range(len(x) - k + 1)} if k else set()
        for i in range(len(w) - k + 1) if k else ():
            if tuple(w[i:i + k]) in wins:
                hit |= set(range(i, i + k))
                ids.add("" if item is None else str(item))
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)


def table(df):
    return sorted((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in df.collect())


def test_oracle_sql(spark, sf, duck):
    got = q_llm.op3_suffix_automaton(spark, sf).toPandas().sort_values("doc_id").reset_index(drop=True)
    want = duck.sql(q_llm.ORACLE_SQL["op3_suffix_automaton"]).df().sort_values("doc_id").reset_index(drop=True)
    assert got.equals(want[got.columns]) and got.contaminated.any()


@pytest.mark.parametrize("block", [1_000_000, 40])
def test_few_words_many_matches(spark, block):
    rng = random.Random(block)

    def text(n):
        return " ".join(rng.choice("ab") for _ in range(n))

    items = [(i, text(rng.choice([1, 2, 4, 9, 10, 11, 14]))) for i in range(2, 9)] + [(None, text(12)), (3, text(3)), (50, ""), (51, None)]
    docs = [(i, text(rng.randrange(0, 60))) for i in range(40)] + [(98, None), (99, "")]
    got = D.contamination_table(spark.createDataFrame(docs, "doc_id long, text string"),
                                spark.createDataFrame(items, "item_id long, text string"), block_words=block)
    assert table(got) == sorted((i, *brute(t, items)) for i, t in docs)


def test_longest_match_is_the_longest(spark):
    rng = random.Random(3)
    items = [("x", [rng.randrange(4) for _ in range(30)]), ("y", [rng.randrange(4) for _ in range(25)])]
    auto = D.Automaton([(i, A.hash_words([f"w{c}" for c in s])) for i, s in items], 5, 1.0)
    seq = [rng.randrange(4) for _ in range(200)]
    numbers = np.searchsorted(auto.vocab, A.hash_words([f"w{c}" for c in seq])).tolist()
    runs = {tuple(s[a:b]) for _, s in items for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
    want = max(b - a for a in range(200) for b in range(a + 1, min(200, a + 31) + 1) if tuple(seq[a:b]) in runs)
    assert auto.stream(numbers)[1] == want


def test_odd_rows_and_cutting(spark, odd_docs, no_docs):
    items = spark.createDataFrame([("i1", " ".join(f"tok{i}" for i in range(20, 45))), ("i2", "one")], "item_id string, text string")
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    pairs = [("i1", " ".join(f"tok{i}" for i in range(20, 45))), ("i2", "one")]
    got = D.contamination_table(odd_docs, items)
    assert sorted(map(str, [tuple(r)[:6] for r in got.collect()])) == sorted(str((i, *brute(t, pairs))) for i, t in rows)
    cut = D.remove_spans(odd_docs, items)
    assert cut.columns == odd_docs.columns
    by = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert 7 not in by and 8 not in by  # mostly such a passage
    assert "tok19" in by[12] and "tok45" in by[12] and "tok30" not in by[12] and by[1] is None and by[2] == ""
    assert not any(brute(t, pairs)[4] for t in by.values())
    assert D.contamination_table(no_docs, items).count() == 0 and D.remove_spans(no_docs, items).count() == 0
    none = D.contamination_table(odd_docs, items.filter("false"))
    assert none.filter("contaminated OR n_items > 0").count() == 0 and none.count() == len(rows)


def test_item_coverage(spark):
    docs = spark.createDataFrame([(1, "a b c d e z"), (2, "a b c z")], "doc_id long, text string")
    items = spark.createDataFrame([("i", "a b c d e f g h")], "item_id string, text string")
    found = {r["doc_id"]: r["n_hit"] for r in D.contamination_table(docs, items, item_coverage=0.5).collect()}
    assert found == {1: 5, 2: 0}


def test_flat_automaton_is_small_and_blocks_agree():
    import pickle

    rng = np.random.default_rng(5)
    items = [(f"i{n}", A.hash_words([f"w{c}" for c in rng.zipf(1.3, 400) % 20_000])) for n in range(250)]
    auto = D.Automaton(items, 10, 1.0)
    words_ = sum(len(h) for _, h in items)
    assert words_ == 100_000 and len(pickle.dumps(auto)) < 100 * words_
    h = np.concatenate([items[3][1], items[100][1][50:90], A.hash_words(["zzz"]), items[200][1][5:14]])
    found = D.matches(auto, np.zeros(len(h), dtype=np.int64), h)[0]
    parts = [D.matches(D.Automaton(items[a:a + 50], 10, 1.0), np.zeros(len(h), dtype=np.int64), h) for a in range(0, 250, 50)]
    assert found[1] == set().union(*[p[0][1] for p in parts if p]) >= {"i3", "i100"} and "i200" not in found[1]
    assert found[0] == D._merged([x for p in parts if p for x in p[0][0]])
