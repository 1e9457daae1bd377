"""Invariants for operators checked by rows (sequential, model-dependent or approximate)."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.operators import chunking as C
from corpusflow.operators import retrieval as H
from corpusflow.operators.preferences import lcs_length
from corpusflow.operators.select import three_way_split
from corpusflow.operators.tokens import pack
from corpusflow.plans.dense_index import with_index
from corpusflow.sources.tables import table


def _lcs_dp(a, b):
    m = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            m[i][j] = m[i - 1][j - 1] + 1 if a[i - 1] == b[j - 1] else max(m[i - 1][j], m[i][j - 1])
    return m[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=30), st.lists(st.integers(0, 5), max_size=30))
def test_bit_parallel_lcs_equals_dp(a, b):
    assert lcs_length(a, b) == _lcs_dp(a, b)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab \n.", max_size=300), st.integers(5, 60))
def test_recursive_chunks_bounded_and_substrings(text, size):
    overlap = size // 5
    seps = ["\n\n", "\n", " ", ""]
    for c in C.chunk_text(text, size, overlap, seps):
        assert len(c) <= size
        assert c in text
    spans = C.chunk_spans(text, size, overlap, seps)
    # every visible character is in a chunk; chunks go forward, and share no more than the overlap
    inside = {i for a, b in spans for i in range(a, b)}
    assert all(i in inside for i, x in enumerate(text) if not x.isspace())
    for (a, b), (c, d) in zip(spans, spans[1:]):
        assert a < c and b < d and b - c <= overlap
    # a chunk ends only where the next span would not fit
    cuts = C.cut_spans(text, size, seps)
    for (a, b), _ in zip(spans, spans[1:]):
        after = next(e for _, e in cuts if e > b)
        assert after - a > size


def test_chunks_by_hand():
    seps = ["\n\n", "\n", " ", ""]
    assert C.chunk_text("one two three four", 9, 0, seps) == ["one two", "three", "four"]
    assert C.chunk_text("one two three four", 9, 4, seps) == ["one two", "two three", "four"]
    assert C.chunk_text("aa bb\n\ncc dd", 7, 0, seps) == ["aa bb", "cc dd"]
    assert C.chunk_text("abcdefgh", 3, 1, seps) == ["abc", "cde", "efg", "gh"]
    assert C.chunk_text("a;bbbbbb;c", 4, 0, [";"]) == ["a", "bbbbbb", "c"]
    assert C.chunk_text(" \n ", 2, 0, seps) == [] == C.chunk_text("", 5, 1, seps)


def test_recursive_chunking_on_documents(spark, sf):
    docs = table(spark, sf, "documents")
    ch = C.chunk_recursive(docs, "doc_id", "text", 500, 50)
    j = ch.join(docs.select("doc_id", "text"), "doc_id")
    bad = j.filter((F.length("chunk") > 500) | (F.instr("text", F.col("chunk")) == 0)).count()
    assert bad == 0


def test_dense_index_is_partition_independent(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    a = {r.doc_id: r.idx for r in with_index(docs, ["doc_id"], "idx", partitions=1).collect()}
    b = {r.doc_id: r.idx for r in with_index(docs, ["doc_id"], "idx", partitions=7).collect()}
    assert a == b
    assert sorted(a.values()) == list(range(len(a)))


def test_packing_rejoins_to_token_stream(spark):
    rows = [(i, [i * 100 + k for k in range(random.Random(i).randint(0, 40))]) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    out = sorted((r.chunk, r.input_ids) for r in pack(df, ["doc_id"], "ids", 16).collect())
    stream = [x for _, ids in rows for x in ids]
    flat = [x for _, ids in out for x in ids]
    assert [c for c, _ in out] == list(range(len(out)))
    assert len(flat) == (len(stream) // 16) * 16
    assert flat == stream[: len(flat)]


def test_splits_disjoint_and_complete(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    s = three_way_split(docs, "doc_id", 0.8, 0.1, 0.1, 3)
    assert s.count() == docs.count()
    assert s.select("doc_id").distinct().count() == docs.count()


def _qc(spark, sf):
    e = table(spark, sf, "embeddings")
    q = e.filter(F.col("vec_id") < 10).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("qv"))
    c = e.filter(F.col("vec_id") >= 10).select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("cv"))
    return q, c


def test_mmr_first_pick_is_nearest_and_no_repeats(spark, sf):
    q, c = _qc(spark, sf)
    cand = H.attach_vectors(H.knn(q, c, 10, "dot"), q, c)
    m = H.mmr(cand, 4, 0.5).collect()
    first = {r.query_id: r.item_id for r in m if r.rank == 1}
    best = {r.query_id: r.item_id for r in cand.filter(F.col("rank") == 1).collect()}
    assert first == best
    seen = [(r.query_id, r.item_id) for r in m]
    assert len(seen) == len(set(seen))


def test_ann_recall_reported(spark, sf):
    from corpusflow.queries.registry import load_all

    rows = load_all()["approx_knn"].fn(spark, sf).collect()
    assert len({r.recall for r in rows}) == 1 and rows[0].recall >= 0.9


def test_knn_in_blocks_is_exact(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    qv, cv = rng.integers(-3, 4, (7, 4)).astype(float), rng.integers(-3, 4, (60, 4)).astype(float)
    q = spark.createDataFrame([(i, v.tolist(), f"m{i}") for i, v in enumerate(qv)], "query_id long, qv array<double>, meta string")
    c = spark.createDataFrame([(i, v.tolist(), i % 2) for i, v in enumerate(cv)], "item_id long, cv array<double>, label int").repartition(5)
    score = {"dot": qv @ cv.T, "ip_distance": 1 - qv @ cv.T, "l2": ((qv[:, None] - cv[None]) ** 2).sum(-1)}
    for metric, s in score.items():
        sign = -1 if metric == "dot" else 1
        want = {(i, r + 1, j) for i in range(7) for r, j in enumerate(sorted(range(60), key=lambda j: (sign * s[i, j], j))[:5])}
        for block in (2, 100):
            got = H.knn(q, c, 5, metric, block=block)
            assert {(r.query_id, r["rank"], r.item_id) for r in got.collect()} == want
            assert set(got.columns) == {"item_id", "label", "query_id", "meta", "score", "rank"}
    assert H.knn(q.filter("false"), c, 5).count() == 0 and H.knn(q, c.filter("false"), 5).count() == 0
    one = {r.query_id: (r.n_positive, r.max_dot) for r in H.product_summary(q, c, block=3).collect()}
    assert one == {i: (int((score["dot"][i] > 0).sum()), score["dot"][i].max()) for i in range(7)}


def test_separator_chunks_cover_the_text(spark, sf):
    docs = table(spark, sf, "documents")
    ch = C.chunk_by_separator(docs, "doc_id", "text", "\n", 2000, 400)
    text = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    seen = {}
    for r in ch.collect():
        assert r.chunk in text[r.doc_id]
        seen.setdefault(r.doc_id, set()).update(r.chunk.split("\n"))
    for i, t in text.items():
        assert {x.strip() for x in t.split("\n") if x.strip()} <= {x.strip() for x in seen.get(i, ())}


def test_rouge_l_on_the_fixture_equals_dp(spark, sf):
    import re

    from corpusflow.queries.registry import load_all

    got = {r.doc_id: r.lcs for r in load_all()["rouge_l"].fn(spark, sf).collect()}
    small = [r for r in table(spark, sf, "documents").collect() if len(r.text) < 900][:15]
    for r in small:
        w = r.text.split()
        a, b = (re.findall("[a-z0-9]+", x.lower()) for x in (" ".join(w[:len(w) // 2]), r.text))
        assert got[r.doc_id] == _lcs_dp(a, b)


@settings(max_examples=100, deadline=None)
@given(*[st.lists(st.lists(st.integers(0, 3), max_size=6), max_size=3)] * 2)
def test_union_lcs(pred, ref):
    from collections import Counter

    from corpusflow.operators.preferences import _lcs_places, union_lcs

    for r in ref:
        for p in pred:
            places = sorted(_lcs_places(r, p))
            assert len(places) == _lcs_dp(r, p)
            it = iter(p)
            assert all(r[i] in it for i in places)  # a subsequence of p
    n = union_lcs(pred, ref)
    common = sum((Counter(t for s in pred for t in s) & Counter(t for s in ref for t in s)).values())
    assert max([_lcs_dp(r, p) for r in ref for p in pred], default=0) <= n <= common


def test_index_within_splits_and_weights(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "b", "c", None]), rng.randrange(5)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, s string, w long")
    for n in (1, 6):
        got = {r.id: r.x for r in with_index(df.filter("s IS NOT NULL"), ["id"], "x", within=["s"], weight="w", partitions=n).collect()}
        for split in "abc":
            total = 0
            for i, s, w in rows:
                if s == split:
                    assert got[i] == total
                    total += w


def test_upsert_rerun_with_other_tasks(spark, sf):
    from corpusflow.queries.registry import load_all

    rows = load_all()["bulk_upsert_vectors"].fn(spark, sf)
    assert rows.count() == rows.distinct().count() == table(spark, sf, "embeddings").count()


def test_stream_sink_has_each_new_item_once(spark, sf):
    from corpusflow.queries.registry import load_all

    got = load_all()["stream_new_only"].fn(spark, sf)
    assert got.count() == got.distinct().count() > 0


def test_missing_sink_is_an_error(spark, tmp_path):
    import pytest

    from corpusflow.streaming.runner import read_sink

    with pytest.raises(FileNotFoundError):
        read_sink(spark, str(tmp_path / "none"), "a int")
    (tmp_path / "empty").mkdir()
    assert read_sink(spark, str(tmp_path / "empty"), "a int").count() == 0


def test_shuffle_order_follows_the_seeded_key(spark, sf):
    from corpusflow.queries.registry import load_all

    keys = [r.shuffle_key for r in load_all()["shuffle_rows"].fn(spark, sf).collect()]
    assert keys == sorted(keys)
