import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import lexical_search as L
from corpusflow.llm.q_llm import OP12_SQL, QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))


def brute(docs, items, k=50):
    words = [(i, collections.Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in words)
    total = sum(sum(c.values()) for _, c in words)
    df = collections.Counter(x for _, c in words for x in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in words:
            n, s = sum(c.values()), 0
            for x in set(terms(text)) & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                s += w * ((10**9 * c[x]) // (1000 * c[x] + 20 * (50 + 50 * n * n_docs // total)))
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def test_query_equals_brute_force_and_sql(spark, sf, duck):
    got = rows(QUERIES["op12_term_at_a_time"](spark, sf))
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert got == brute(docs, items)
    assert got == sorted(duck.execute(f"SELECT item_id, rank, doc_id, score FROM ({OP12_SQL})").fetchall(), key=str)


@pytest.mark.parametrize("docs_per_block,terms_per_block", [(3, 1), (1000, 5)])
def test_blocks_change_nothing(spark, monkeypatch, docs_per_block, terms_per_block):
    monkeypatch.setattr(L, "BLOCK_DOCS", docs_per_block)
    rng = np.random.default_rng(docs_per_block)
    vocab = np.array([f"w{i}" for i in range(60)])
    p = 1 / np.arange(1, 61)
    docs = [(int(i), " ".join(rng.choice(vocab, size=rng.integers(1, 40), p=p / p.sum()))) for i in range(200)]
    items = [(int(i), " ".join(rng.choice(vocab, size=8))) for i in range(6)]
    got = L.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                   spark.createDataFrame(items, "item_id long, text string"), k=5, block_terms=terms_per_block)
    assert rows(got) == brute(docs, items, 5)


def test_accumulators_stop_and_survivors_stay_exact():
    """With rare terms that fill the first k, documents that have only the common one get no accumulator."""
    n = 300
    rare, common = np.arange(10), np.arange(n)
    parts = [(np.arange(n), np.full(n, 3), np.concatenate((np.zeros(10), np.ones(n))).astype(np.int64),
              np.concatenate((rare, common)))]
    block = L.Block(parts, np.array([9000, 5]), n, 3 * n)
    ids, score = L.best_of(block, np.array([0, 1]), 10)
    part = 10**9 // (1000 + 20 * 100)
    assert sorted(ids.tolist()) == list(range(10)) and set(score.tolist()) == {9005 * part}
    # an outside bar above all bounds ends at once
    assert len(L.best_of(block, np.array([0, 1]), 10, 10**12)[0]) == 0


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "TOK1 tok2"), (1, "TOK1 tok2"), (None, "word5 one"), (3, ""), (4, None), (5, "nowhere")],
                                  "item_id long, text string").withColumn("score", F.lit("x"))
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert rows(L.search(odd_docs, items)) == brute(docs, [(r.item_id, r.text) for r in items.collect()])
    assert L.search(no_docs, items).count() == 0
    assert L.search(odd_docs, items.limit(0)).count() == 0


def test_ties_go_by_document_id(spark):
    docs = spark.createDataFrame([(i, "same words") for i in range(120, 0, -1)] + [(None, "same words"), (500, "other")],
                                 "doc_id long, text string").repartition(7)
    got = L.search(docs, spark.createDataFrame([(1, "same")], "item_id long, text string"), k=10).orderBy("rank").collect()
    assert [r.doc_id for r in got] == list(range(1, 11))
