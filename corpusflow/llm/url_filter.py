"""URL filter: host and path rules, and logistic regression on hashed character n-grams of host and path.

Rules. A rule (action, host, path) fits its host and all subdomains if the url's path starts with the
rule's; the longest rule wins. A url that no rule fits is judged by the model.

Model. The distinct character n-grams of ``^host$`` and ``^path$`` (told apart) are hashed to
``n_features`` numbers, each weighing one over the root of their count. Weights are fitted by gradient
descent with a penalty on a small labelled table of urls: each step is one aggregate over that table,
and its result has at most ``n_features`` rows. Everything is DataFrame functions.

Defined cases: a null url, or one without ``://``, has an empty host and path, no rule and the model's
verdict on those; without labelled rows the model gives one half and ``allow``; repeated rows are
judged alike; an empty table gives no rows. Extra columns are kept; ones with the names of the outputs
are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.site_lines import host_of
from corpusflow.session import ensure_checkpoint_dir

RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
N_FEATURES = 4096
GRAM = 3
STEPS = 15
RATE = 4.0
PENALTY = 0.01
MAX_LABELLED = 2000


def path_of(url: Column) -> Column:
    """Path: behind the host up to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def features(host: Column, path: Column, n_features: int = N_FEATURES, gram: int = GRAM) -> Column:
    """Sorted distinct feature numbers, from 1 on."""

    def grams(s: Column, kind: str) -> Column:
        s = F.concat(F.lit("^"), s, F.lit("$"))
        starts = F.sequence(F.lit(1), F.greatest(F.length(s) - gram + 1, F.lit(1)))
        return F.transform(starts, lambda i: (F.pmod(F.xxhash64(F.lit(kind), F.substring(s, i, F.lit(gram))),
                                                     F.lit(n_features)) + 1).cast("int"))

    return F.array_sort(F.array_distinct(F.concat(grams(host, "host"), grams(path, "path"))))


def margin(f: Column, weights: Sequence[float], bias: float) -> Column:
    """Bias and weights of the features; equal for equal features, as they are summed in order."""
    w = F.split(F.lit(",".join(map(repr, map(float, weights)))), ",").cast("array<double>")  # folded to one literal
    total = F.aggregate(f, F.lit(0.0), lambda acc, i: acc + F.element_at(w, i))
    return F.lit(float(bias)) + total / F.sqrt(F.size(f))


def fit(labelled: DataFrame, n_features: int = N_FEATURES, gram: int = GRAM, steps: int = STEPS, rate: float = RATE,
        penalty: float = PENALTY, max_labelled: int = MAX_LABELLED) -> tuple[list[float], float]:
    """Weights and bias from (url, label), label 1 for urls to block.

    At most ``max_labelled`` rows are used, those with the smallest hashes of (url, label).
    """
    ensure_checkpoint_dir(labelled.sparkSession)
    rows = labelled.select(F.coalesce("url", F.lit("")).alias("url"), F.col("label").cast("double").alias("y")).filter("y is not null")
    rows = (rows.orderBy(F.xxhash64("url", "y"), "url", "y").limit(max_labelled).coalesce(1)  # a bounded table
            .select("y", features(host_of(F.col("url")), path_of(F.col("url")), n_features, gram).alias("f")).checkpoint())
    n, positive = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    weights, seen = [0.0] * n_features, [1e-6] * n_features
    if not n:
        return weights, 0.0
    bias = math.log((positive + 1) / (n - positive + 1))
    for _ in range(steps):
        z = margin(F.col("f"), weights, bias)
        err = rows.select((F.lit(1.0) / (F.lit(1.0) + F.exp(-z)) - F.col("y")).alias("e"), "f")
        per = err.select(F.explode("f").alias("i"), (F.col("e") / F.sqrt(F.size("f"))).alias("g"))
        grad = {r["i"]: r["g"] for r in per.groupBy("i").agg((F.sum("g") / n).alias("g")).collect()}
        for i in range(n_features):
            g = round(grad.get(i + 1, 0.0), 12) + penalty * weights[i] / n
            if g:
                seen[i] += g * g
                weights[i] -= rate * g / math.sqrt(seen[i]) / math.sqrt(n)
    return weights, bias


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as a struct (n, rule, action), or null. Rules are a short list from the caller."""
    none = F.lit(None).cast("struct<n:int,rule:string,action:string>")
    if not rules:
        return none
    found = [F.when(((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
                    F.struct(F.lit(len(h + p)).alias("n"), F.lit(h + p).alias("rule"), F.lit(a).alias("action"))).otherwise(none)
             for a, h, p in rules]
    return found[0] if len(found) == 1 else F.greatest(*found)


def judge(pages: DataFrame, labelled: DataFrame, url: str = "url", rules=RULES, n_features: int = N_FEATURES,
          gram: int = GRAM, **how) -> DataFrame:
    """Every input column, and ``host``, ``path``, ``rule``, ``verdict`` and ``score`` (the model's, 1 for block)."""
    weights, bias = fit(labelled, n_features, gram, **how)
    own = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict", "score")]
    u = F.col(url).cast("string")
    out = pages.select(*own, host_of(u).alias("host"), path_of(u).alias("path"))
    z = margin(features(F.col("host"), F.col("path"), n_features, gram), weights, bias)
    score = F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), 9)
    out = out.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("score", score)
    model = F.when(F.col("score") > 0.5, "block").otherwise("allow")
    return out.select(*own, "host", "path", F.col("rule.rule").alias("rule"),
                      F.coalesce("rule.action", model).alias("verdict"), "score")
