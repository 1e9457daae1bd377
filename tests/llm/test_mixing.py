import itertools
import random
import re

import numpy as np
import pytest

from corpusflow.llm import mixing as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water(sizes, weights):
    """Targets by the rule's own words: share, cut at twice the size, share the excess again."""
    budget, capped = 1.5 * sum(sizes.values()), {}
    while True:
        free = {s: w for s, w in weights.items() if s not in capped}
        rate = (budget - sum(capped.values())) / sum(free.values()) if free else 0
        over = [s for s in free if rate * free[s] >= 2 * sizes[s]]
        if not over:
            return capped | {s: rate * w for s, w in free.items()}
        capped |= {s: 2.0 * sizes[s] for s in over}


def test_fixture(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = M.mix_table(docs).toPandas().merge(docs.select("doc_id", "source", "text").toPandas(), on="doc_id")
    assert (got["size"] == [len(WORD.findall(t)) for t in got.text]).all() and len(got) == docs.count()
    sizes = got.groupby("source")["size"].sum().to_dict()
    want = water(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes))})
    for s, g in got.groupby("source"):
        assert g.source_size.iloc[0] == sizes[s] and g.target.iloc[0] == pytest.approx(want[s])
        assert abs(g.taken.sum() - want[s]) <= max(2, 0.01 * want[s])
    assert (got.taken <= 2 * got["size"]).all() and (got.taken % got["size"].clip(lower=1) == 0).all()
    again = M.mix_table(docs.repartition(7)).toPandas()
    assert sorted(again.itertuples(index=False, name=None)) == sorted(got[again.columns].itertuples(index=False, name=None))


def test_fit_is_the_best_subset_sum():
    rng = random.Random(1)
    for _ in range(60):
        size = np.array(rng.sample(range(1, 30), 4))
        count = np.array([rng.randrange(1, 4) for _ in size])
        total = int((size * count).sum())
        target = rng.uniform(0, 2 * total)
        base, extra = M.fit_lengths(size, count, target)
        rest = round(target - base * total)
        sums = {int((size * np.array(k)).sum()) for k in itertools.product(*[range(c + 1) for c in count])}
        assert base == int(target // total) and (extra <= count).all() and (extra >= 0).all()
        top = rest + int(size.min())
        assert abs(int((size * extra).sum()) - rest) == min(abs(s - rest) for s in sums if s <= top)


def test_large_budget_is_met():
    rng = np.random.default_rng(2)
    size = np.unique(rng.integers(5, 3000, 800))
    count = rng.integers(1, 400, len(size))
    total = int((size * count).sum())
    for part in (0.3, 0.77, 1.4):
        base, extra = M.fit_lengths(size, count, part * total)
        assert abs(base * total + int((size * extra).sum()) - part * total) <= 1 and (extra <= count).all()
    assert M.fit_lengths(np.array([0]), np.array([3]), 0.0)[0] == 1


def test_hot_length_is_ranked_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(M, "BUCKET_ROWS", 16)
    docs = spark.createDataFrame([(i, "a b c", "x") for i in range(300)] + [(1000 + i, "a " * (i + 1), "y") for i in range(30)],
                                 "doc_id long, text string, source string")
    got = M.mix_table(docs).toPandas()
    for n in (900, 465):
        g = got[got.source_size == n]
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 3


def test_given_weights_and_odd_rows(spark, odd_docs, no_docs, rows_of):
    got = M.mix_table(odd_docs).toPandas()
    texts = odd_docs.select("text").toPandas().text
    assert sorted(got["size"]) == sorted(len(WORD.findall(t or "")) for t in texts)
    assert (got.taken <= 2 * got["size"]).all()
    mixed = M.mix(odd_docs)
    assert mixed.columns == odd_docs.columns
    words = sum(len(WORD.findall(r["text"] or "")) for r in mixed.collect())
    assert words == got.taken.sum()
    assert rows_of(mixed) == rows_of(M.mix(odd_docs.repartition(5)))
    assert M.mix_table(no_docs).count() == 0 and M.mix(no_docs).count() == 0
    weights = spark.createDataFrame([("s0", 1.0)], "source string, weight double")
    only = M.mix_table(odd_docs, weights=weights).toPandas()
    assert (only[only.target == 0].taken == 0).all() and only.taken.sum() > 0


def test_mix_follows_the_plan_row_by_row(spark, monkeypatch):
    """Copies of each row as planned, with lengths ranked in buckets and equal rows at a rule's border."""
    monkeypatch.setattr(M, "BUCKET_ROWS", 8)
    rows = [(i, f"w{i} b c", "x") for i in range(100)] + [(7, "same row here", "y")] * 90 + [(1000 + i, "a " * (i + 1), "y") for i in range(9)]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, source string, k long").repartition(6)
    plan = {}
    for r in M.plan_mix(docs).collect():
        plan.setdefault(r.id, []).append(r.copies)
    got = {}
    for r in M.mix(docs).collect():
        got.setdefault(r.doc_id, {}).setdefault(r.k, 0)
        got[r.doc_id][r.k] += 1
    for i, copies in plan.items():
        assert sorted(c for c in copies if c) == sorted(got.get(i, {}).values())
    assert len(set(plan[7])) == 2  # the border runs through equal rows
    mixed = M.mix(docs)
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, M.mix(docs.repartition(3)).collect()))
    plan_text = M.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan_text
