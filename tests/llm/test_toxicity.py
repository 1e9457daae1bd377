import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest

from corpusflow.llm import q_llm
from corpusflow.llm import toxicity as X


def brute_vector(unit):
    """All three-byte subsequences with their decayed weights, written out."""
    s, v = b"\0" + unit + b"\0", np.zeros(1 << X.BITS)
    norm = 0.0
    for i, j, k in itertools.combinations(range(len(s)), 3):
        if j - i <= X.GAP and k - j <= X.GAP:
            w = X.DECAY ** (k - i - 2)
            f = ((s[i] << 16 | s[j] << 8 | s[k]) * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - X.BITS)
            v[f] += w
            norm += w * w
    return v / np.sqrt(norm) if norm else v


def test_vectors_match_brute_force():
    units = [b"idiot", b"i.d.i.o.t", b"a", "vequé".encode(), b"banana"]
    got = X.vectors(units)
    for g, u in zip(got, units):
        assert np.allclose(g, brute_vector(u.lower()), atol=1e-5)


def test_kernel_tolerates_gaps_and_insertions():
    a, b, c, d = X.vectors([b"pathetic", b"path-etic", b"pat.h.etic", b"theblering"])
    assert a @ b > 0.7 and a @ c > 0.45 and a @ d < 0.2


def test_text_margins_match_unit_vectors():
    rng = np.random.default_rng(0)
    w = rng.normal(size=1 << X.BITS)
    texts = ["Idiot you a", None, "", "x i d i o t y", "z" * 100]
    units = [[b"idiot", b"you", b"a"], [], [], [b"x", b"i", b"d", b"i", b"o", b"t", b"y", b"xidioty"],
             [b"z" * 32] * 5 + [b"z" * 20]]
    got = X.text_features(pa.array(texts), w, 0.1)
    for g, us in zip(got, units):
        m = [X.vectors([u])[0] @ w + 0.1 for u in us if len(u) >= X.LEAST_BYTES]
        assert g[0] == pytest.approx(max([max(x, X.FLOOR) for x in m], default=X.FLOOR), abs=1e-3)
        assert g[2] == pytest.approx(np.log1p(len(us)), abs=0.2)


def test_a_text_does_not_depend_on_its_neighbours():
    w = np.random.default_rng(1).normal(size=1 << X.BITS)
    texts = ["a", "x i d i o t y", "b c", "Idiot you a", " ".join("abcdefgh" * 12), "x", "i d", None, "q w e r"]
    alone = np.concatenate([X.text_features(pa.array([t], pa.string()), w, 0.1) for t in texts])
    assert np.allclose(X.text_features(pa.array(texts), w, 0.1), alone)
    assert np.allclose(X.text_features(pa.array(texts[::-1]), w, 0.1), alone[::-1])


def test_spelled_words_are_whole_in_some_window():
    for lead in range(40):
        buf, starts, ends, _ = X.units_of(pa.array([" ".join("z" * lead + "idiot" + "z" * 40)]))
        assert any(b"idiot" in buf[a:b].tobytes() for a, b in zip(starts, ends))


def test_held_out_accuracy(spark, sf):
    big = sf.replace("0.001", "0.01")
    got = q_llm.op7_string_kernel(spark, big).toPandas()
    labels = spark.read.parquet(f"{big}/labels.parquet").toPandas()
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(got.doc_id, got.held_out))
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    x = got.merge(labels, on="doc_id")
    x = x[x.held_out]
    pos, neg = x[x.toxic == 1].score.to_numpy(), x[x.toxic == 0].score.to_numpy()
    auc = (pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean()
    # some toxic texts of the fixture hold no insult at all
    assert auc > 0.85 and (neg >= 0.7).mean() < 0.02 and (pos >= 0.7).mean() > 0.6


def test_labels_of_held_out_rows_do_not_matter(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    a, b = (sorted(map(tuple, X.toxicity_table(docs, x).collect())) for x in (labels, flipped))
    assert a == b


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in (1, 2, 3, 4, 5, 6, 10, 12)] + [(7, None), (None, 1)], "doc_id long, toxic int")
    got = X.toxicity_table(odd_docs, labels)
    assert got.count() == odd_docs.count() and got.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert X.toxicity_table(no_docs, labels).count() == 0
    none = X.toxicity_table(odd_docs, labels.filter("false")).collect()
    assert {r["score"] for r in none} == {0.0} and {r["predicted"] for r in none} == {0}


def test_few_toxic_groups_train_a_model(spark):
    rng = np.random.default_rng(3)
    words = [f"{a}{b}{c}" for a in ("lor", "mag", "tem", "sun", "vel") for b in ("i", "o", "ea") for c in ("dan", "pur", "nis", "ter")]

    def text(extra=""):
        return " ".join([*rng.choice(words, 20), extra, *rng.choice(words, 20)])

    copied = text("grubwozzle")
    rows = [(text(), 0) for _ in range(300)] + [(copied, 1)] * 60 + [(text("snarkvik"), 1) for _ in range(3)]
    model = X.fit(spark.createDataFrame(rows, "text string, toxic int"))
    tests = [(i, text(w)) for i, w in enumerate(["grubwozzle", "snarkvik"] * 5 + [""] * 30)]
    got = {r["doc_id"]: r["score"] for r in X.score(spark.createDataFrame(tests, "doc_id long, text string"), model).collect()}
    assert min(got[i] for i in range(10)) > max(got[i] for i in range(10, 40))
