import collections
import math
import re

import numpy as np
import pyarrow as pa
import pytest

from corpusflow.llm import arrays as A
from corpusflow.llm import perplexity as P

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_rules(text):
    words = WORD.findall(text or "")
    wins = collections.Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i in range(len(words) - 2):
        if wins[tuple(words[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)]


class Brute:
    """Modified Kneser-Ney written out over tuples, as a check of the DataFrame model."""

    def __init__(self, texts):
        self.c = {k: collections.Counter() for k in range(1, 5)}
        for t in texts:
            for g in self.grams(t):
                self.c[len(g)][g] += 1
        for k in (3, 2, 1):
            for g in list(self.c[k + 1]):
                if not (k > 1 and g[1:][0] == P.BEGIN):
                    self.c[k][g[1:]] += 1
        self.d, self.ctx = {}, {}
        for k, c in self.c.items():
            n = [sum(v == i for v in c.values()) for i in range(1, 5)]
            y = n[0] / max(1, n[0] + 2 * n[1])
            self.d[k] = [min(i, max(0.0, i - (i + 1) * y * n[i] / n[i - 1])) if n[i - 1] and n[i] else i / 2 for i in (1, 2, 3)]
            self.ctx[k] = collections.defaultdict(lambda: [0, 0.0])
            for g, v in c.items():
                self.ctx[k][g[:-1]][0] += v
                self.ctx[k][g[:-1]][1] += self.d[k][min(v, 3) - 1]

    @staticmethod
    def grams(text):
        for w in WORD.findall(text or ""):
            s = [P.BEGIN, *w.encode(), P.END]
            for i in range(1, len(s)):
                yield tuple(s[max(0, i - 3):i + 1])

    def p(self, g):
        k = len(g)
        low = 1 / 256 if k == 1 else self.p(g[1:])
        total, off = self.ctx[k].get(g[:-1], (0, 0.0))
        if not total:
            return low
        v = self.c[k].get(g, 0)
        return (v - self.d[k][min(v, 3) - 1] if v else 0) / total + off / total * low

    def log_ppl(self, text):
        got = [math.log(self.p(g)) for g in self.grams(text)]
        return round(-sum(got) / len(got), 3) if got else None


def test_model_and_rules_match_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").limit(60).collect()
    docs = spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string, lang string")
    brute = Brute([r["text"] for r in rows])
    got = {r["doc_id"]: r for r in P.quality_table(docs).collect()}
    joined = {r["doc_id"]: r for r in P.quality_table(docs, limit=200).collect()}  # most n-grams of order 4 stay a table
    for r in rows:
        g = got[r["doc_id"]]
        if g["perplexity"] is not None:
            assert math.log(joined[r["doc_id"]]["perplexity"]) == pytest.approx(math.log(g["perplexity"]), abs=0.0011)
        assert [g[c] for c in P.MEASURES] == base_rules(r["text"])
        want = brute.log_ppl(r["text"])
        assert (g["perplexity"] is None) == (want is None)
        if want is not None:
            assert math.log(g["perplexity"]) == pytest.approx(want, abs=0.0021)
        assert not (g["kept"] and g["base_failed"])
    for lang in {r["lang"] for r in rows}:
        ppl = [math.log(got[r["doc_id"]]["perplexity"]) for r in rows if r["lang"] == lang and not got[r["doc_id"]]["base_failed"]]
        low, high = next((math.log(got[r["doc_id"]]["low"]), math.log(got[r["doc_id"]]["high"])) for r in rows if r["lang"] == lang)
        q1, q3 = np.quantile(ppl, [0.25, 0.75])
        assert low == pytest.approx(q1 - 3 * (q3 - q1), abs=1e-3) and high == pytest.approx(q3 + 3 * (q3 - q1), abs=1e-3)


def test_rejects_junk_keeps_clean(spark, sf):
    out = P.quality_table(spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet"))
    got = out.join(spark.read.parquet(f"{sf.replace('0.001', '0.01')}/labels.parquet"), "doc_id").filter("NOT base_failed").toPandas()
    assert got[got.quality == 1].kept.mean() > 0.97
    assert got[got.quality == 0].kept.mean() < 0.6


def test_odd_rows(spark, odd_docs, no_docs):
    out = P.quality_table(odd_docs).collect()
    assert len(out) == odd_docs.count()
    by = {r["doc_id"]: r for r in out}
    texts = {r["doc_id"]: r["text"] for r in odd_docs.collect()}
    assert all([by[i][c] for c in P.MEASURES] == base_rules(texts[i]) for i in texts)
    assert by[1]["perplexity"] is None and not by[1]["kept"] and by[1]["base_failed"]
    kept = P.quality_filter(odd_docs)
    assert kept.columns == odd_docs.columns
    assert {r["doc_id"] for r in kept.collect()} <= {r["doc_id"] for r in out if r["kept"]}
    assert P.quality_table(no_docs).count() == 0 and P.quality_filter(no_docs).count() == 0


def test_model_keys_are_exact_and_the_frequent_ones_are_broadcast(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    (whole, none), (part, tail) = P.fit(docs), P.fit(docs, limit=101)
    assert none is None and all((np.diff(k.astype(int)) > 0).all() for k, _ in whole.values())
    n = {r["g"]: r["n"] for r in P.ngram_counts(docs).collect()}
    full = {g for g in n if g >> 8 != P.BEGIN and g >> 16 != P.BEGIN}
    rest = {r["g"] for r in tail.collect()}
    assert set(whole["p4"][0].tolist()) == full and 0 < len(part["p4"][0]) <= 101
    assert rest | set(part["p4"][0].tolist()) == full and max(n[g] for g in rest) < min(n[g] for g in part["p4"][0].tolist())
    assert all((whole[k][0] == part[k][0]).all() for k in whole if k != "p4")
    assert np.isfinite(P.log_probs(np.unique(P._grams(*A.text_bytes(pa.array(["abc def é"])))[0]), part)).all()


def test_joined_and_broadcast_models_agree_on_odd_rows(spark, odd_docs, no_docs):
    few, many = (sorted(map(str, P.quality_table(odd_docs, limit=n).drop("perplexity", "low", "high").collect())) for n in (0, P.LIMIT))
    assert few == many and P.quality_filter(odd_docs, limit=0).columns == odd_docs.columns
    assert P.quality_filter(odd_docs, limit=0).count() == P.quality_filter(odd_docs).count() and P.quality_table(no_docs, limit=0).count() == 0


def test_copies_do_not_close_the_band(spark, sf):
    rows = (spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
            .filter("lang = 'en' AND quality = 1 AND size(split(text, ' ')) >= 80").dropDuplicates(["text"]).orderBy("doc_id")
            .select("doc_id", "text", "lang").limit(50).collect())
    copies = [(1_000_000 + i, rows[0]["text"], "en") for i in range(200)]
    docs = spark.createDataFrame([tuple(r) for r in rows] + copies, "doc_id long, text string, lang string")
    out = P.quality_table(docs).filter("doc_id < 1000000 AND NOT base_failed").toPandas()
    assert len(out) > 30 and out.kept.mean() > 0.8
    assert P.quality_filter(docs).filter("doc_id < 1000000").count() == out.kept.sum()


def test_bands_have_a_least_width(spark):
    rows = [("a", i, 1.5, False) for i in range(9)] + [("a", 9, 1.53, False), ("a", 10, 3.0, True), (None, 1, 2.0, False)]
    got = {r["lang"]: r for r in P.bands(spark.createDataFrame(rows, "lang string, text_hash long, log_ppl double, base_failed boolean")).collect()}
    assert got["a"]["low"] == pytest.approx(1.5 - 3 * P.LEAST_SPREAD) and got["a"]["high"] == pytest.approx(1.5 + 3 * P.LEAST_SPREAD)
    assert got[None]["low"] < 2.0 < got[None]["high"]
