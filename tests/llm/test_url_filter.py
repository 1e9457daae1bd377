import math
import re

import pytest
import xxhash

from corpusflow.llm import url_filter as U

LABELLED = [(f"http://ads{i}.track.example.com/click/{i}/banner", 1) for i in range(40)] + [
    (f"https://docs{i}.library.example.org/article/{i}/page", 0) for i in range(60)]


def spark_hash(*parts):
    h = 42
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), seed=h)
    return h - (1 << 64) if h >> 63 else h


def brute_features(host, path):
    out = set()
    for kind, s in (("host", f"^{host}$"), ("path", f"^{path}$")):
        out |= {spark_hash(kind, s[i:i + 3]) % U.N_FEATURES + 1 for i in range(max(1, len(s) - 2))}
    return sorted(out)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1])
    return m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]


def brute_rule(host, path):
    fits = [(len(h + p), h + p, a) for a, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def brute_fit(rows):
    feats = [(brute_features(*split(u)), y) for u, y in rows]
    n, pos = len(rows), sum(y for _, y in rows)
    w, seen, b = [0.0] * U.N_FEATURES, [1e-6] * U.N_FEATURES, math.log((pos + 1) / (n - pos + 1))
    for _ in range(U.STEPS):
        g = [0.0] * U.N_FEATURES
        for f, y in feats:
            e = 1 / (1 + math.exp(-(b + sum(w[i - 1] for i in f) / math.sqrt(len(f))))) - y
            for i in f:
                g[i - 1] += e / math.sqrt(len(f)) / n
        for i in range(U.N_FEATURES):
            x = round(g[i], 12) + U.PENALTY * w[i] / n
            if x:
                seen[i] += x * x
                w[i] -= U.RATE * x / math.sqrt(seen[i]) / math.sqrt(n)
    return w, b


def test_matches_brute_force_and_separates(spark):
    labelled = spark.createDataFrame(LABELLED, "url string, label int")
    urls = [u for u, _ in LABELLED[::7]] + ["http://ads99.track.example.com/click/7", "https://docs7.library.example.org/article/zz",
            "http://www.Example.com/en/1", "http://m.example.com/en/2", "http://x.net/fr/3?u", "http://net/es/", "com", None, "ftp://a.com", "x://a.com/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    w, b = brute_fit(LABELLED)
    got = {r["page_id"]: r for r in U.judge(pages, labelled).collect()}
    for i, u in enumerate(urls):
        host, path = split(u)
        rule, action = brute_rule(host, path)
        f = brute_features(host, path)
        score = 1 / (1 + math.exp(-(b + sum(w[j - 1] for j in f) / math.sqrt(len(f)))))
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["score"] == pytest.approx(score, abs=1e-6)
        assert r["verdict"] == (action or ("block" if r["score"] > 0.5 else "allow"))
    scores = {u: got[i]["score"] for i, u in enumerate(urls)}
    assert scores["http://ads99.track.example.com/click/7"] > 0.5 > scores["https://docs7.library.example.org/article/zz"]


def test_odd_rows(spark):
    labelled = spark.createDataFrame([(None, 1), ("a", None)], "url string, label int")
    pages = spark.createDataFrame([(1, None, "x", 1), (None, "http://é.com/" + "p" * 30_000, None, 2), (2, "", "y", 3), (2, "", "y", 3)],
                                  "page_id long, url string, host string, score int")
    got = U.judge(pages, labelled)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict", "score"] and got.count() == 4
    assert U.judge(pages, labelled.filter("false")).filter("rule IS NULL AND (score <> 0.5 OR verdict <> 'allow')").count() == 0
    assert U.judge(pages.filter("false"), labelled).count() == 0
    assert not re.search("Python|Pandas|Arrow", got._jdf.queryExecution().executedPlan().toString())


def test_query_rules(spark, sf):
    from corpusflow.llm import q_llm

    got = q_llm.op2_url_regression(spark, sf).collect()
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()}
    assert len(got) == len(urls)
    for r in got:
        assert (r["host"], r["path"]) == split(urls[r["page_id"]])
        rule, action = brute_rule(r["host"], r["path"])
        assert r["rule"] == rule and r["verdict"] == (action or ("block" if r["score"] > 0.5 else "allow"))
