"""Mixing sources to target weights by subset-sum budget fitting.

Method. Documents are counted by source and exact length. A source's target is met by ``base`` whole
copies of it and a remaining budget of less than its size. Of each length, longest first, the share of
documents that the budget asks for is taken (what a length can't take is carried to the next), up to
``DP_WORDS`` words below the budget; a bounded-knapsack dynamic program over the lengths that are left
then finds the sum nearest to the rest. Of each length the documents with the smallest seeded
hashes are taken.

Plan. One scan makes a narrow table (id, source, size, hash). A source's histogram has a row per
distinct length, so the task that fits it grows with the longest document, not with the documents.
Documents are ranked by hash inside (source, size, bucket), with a bucket for about ``BUCKET_ROWS``
documents of one length, so a length that holds a third of all rows is ranked in many tasks.

Defined cases: null text has size 0; documents of size 0 are taken as often as their source's base;
a null source is a source of its own and comes last; a source without words has the target 0; repeated
rows are documents of their own; an empty table gives no rows. Extra columns are ignored by
``mix_table`` and kept by ``mix``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm import arrays as A
from corpusflow.plans.dense_index import with_index
from corpusflow.session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
BUDGET_PERCENT = 150
MOST_TIMES = 2
SEED = 20
DP_WORDS = 20_000
BUCKET_ROWS = 50_000
#: rules (a row per source and length) up to which they are broadcast
BROADCAST_RULES = 1_000_000


def sized(docs: DataFrame, id_col: str, text: str, source: str, seed: int = SEED) -> DataFrame:
    """(id, source, size, h): the length in words and the seeded hash of each document."""
    t = F.col(text).cast("string")
    return docs.select(F.col(id_col).alias("id"), F.col(source).alias("source"),
                       F.coalesce(F.regexp_count(t, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.xxhash64(F.lit(seed), F.col(id_col), t).alias("h"))


def cycled_weights(sources: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """(source, source_size, weight): weights dealt in turn to the sources by code point, null last."""
    ranked = with_index(sources, [F.col("source").isNull(), "source"], "place")
    w = F.element_at(F.lit(list(weights)), (F.col("place") % len(weights) + 1).cast("int"))
    return ranked.select("source", "source_size", w.cast("double").alias("weight"))


def targets(sources: DataFrame, budget_percent: float = BUDGET_PERCENT, most_times: int = MOST_TIMES) -> DataFrame:
    """(source, source_size, target) from (source, source_size, weight).

    A target is ``rate * weight``, but ``most_times * source_size`` at most; the rate rises until the
    targets sum to the budget. Each round is one aggregate over the sources (a row each).
    """
    sources = sources.checkpoint()
    cap = F.col("source_size").cast("double") * most_times
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    budget, rate, full = total * budget_percent / 100, 0.0, -1
    while True:
        at_cap = cap <= F.lit(rate) * F.col("weight")
        n, capped, weight = sources.agg(F.count(F.when(at_cap, 1)), F.coalesce(F.sum(F.when(at_cap, cap)), F.lit(0.0)),
                                        F.coalesce(F.sum(F.when(~at_cap, F.col("weight"))), F.lit(0.0))).first()
        if n == full or not weight:
            break
        full, rate = n, max(0.0, budget - capped) / weight
    return sources.select("source", "source_size", F.least(cap, F.lit(rate) * F.col("weight")).alias("target"))


def fit_lengths(size: np.ndarray, count: np.ndarray, target: float) -> tuple[int, np.ndarray]:
    """Whole copies of the source, and of each length the number of documents taken once more."""
    order = np.argsort(-size, kind="stable")
    length, have = [int(x) for x in size[order]], [int(x) for x in count[order]]
    total = sum(a * b for a, b in zip(length, have))
    extra = np.zeros(len(size), dtype=np.int64)
    if not total:
        return 1, extra
    base = int(target // total)
    rest = round(target - base * total)
    share, carry, take = max(0, rest - DP_WORDS) / total, 0.0, []
    for n, c in zip(length, have):
        carry += n * c * share
        k = min(c, int(carry // n)) if n else 0
        carry -= k * n
        take.append(k)
    rest -= sum(a * b for a, b in zip(length, take))
    # bounded knapsack over bits: bit s of sums says whether s words can be had; lengths in binary bundles
    top = rest + min([n for n, c, k in zip(length, have, take) if n and c > k], default=0)
    mask, sums, steps = (1 << (top + 1)) - 1, 1, []
    for i, n in enumerate(length):
        spare, bundle = have[i] - take[i], 1
        while spare and n and not sums >> rest & 1:
            k = min(bundle, spare)
            if k * n <= top:
                steps.append((i, k, sums))
                sums |= sums << (k * n) & mask
            spare -= k
            bundle *= 2
    # the nearest sum: the largest up to the rest, unless one above it is nearer
    best = (sums & ((1 << (rest + 1)) - 1)).bit_length() - 1
    above = sums >> (rest + 1)
    if above and (above & -above).bit_length() < rest - best:
        best = rest + (above & -above).bit_length()
    for i, k, before in reversed(steps):
        if not before >> best & 1:
            take[i] += k
            best -= k * length[i]
    extra[order] = take
    return base, extra


def _fit(group: pd.DataFrame) -> pd.DataFrame:
    base, extra = fit_lengths(group["size"].to_numpy(), group["c"].to_numpy(), float(group["target"].iloc[0]))
    return group.assign(base=base, extra=extra)[["source", "size", "c", "source_size", "target", "base", "extra"]]


def copies(table: DataFrame, aims: DataFrame) -> DataFrame:
    """(id, source, size, h, source_size, target, copies) from the narrow table and the targets."""
    kind = table.schema["source"].dataType.simpleString()
    hist = table.groupBy("source", "size").agg(F.count(F.lit(1)).alias("c"))
    aims = aims.select(F.col("source").alias("of"), "source_size", "target")
    plan = (hist.join(aims, F.col("source").eqNullSafe(F.col("of"))).drop("of").groupBy("source")
            .applyInPandas(_fit, f"source {kind}, size long, c long, source_size long, target double, base long, extra long")
            .withColumnsRenamed({"source": "of", "size": "len"}).checkpoint())
    one = table.join(plan, F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("len"))).drop("of", "len")
    # documents of a length are ranked by hash, in buckets of hashes
    one = one.withColumn("bucket", F.pmod("h", F.ceil(F.col("c") / BUCKET_ROWS).cast("long"))).checkpoint()
    part = one.filter((F.col("extra") > 0) & (F.col("extra") < F.col("c")))
    key = ["source", "size", "bucket"]
    counts = part.groupBy(*key).agg(F.count(F.lit(1)).alias("m"), F.first("extra").alias("extra"))
    before = F.sum("m").over(Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    quota = (counts.withColumn("quota", F.col("extra") - F.coalesce(before, F.lit(0)))
             .select(F.col("source").alias("of"), F.col("size").alias("len"), F.col("bucket").alias("b"), "quota"))
    rank = F.row_number().over(Window.partitionBy(*key).orderBy("h", F.col("id").isNull(), "id"))
    part = (part.withColumn("place", rank)
            .join(quota, F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("len")) & (F.col("bucket") == F.col("b")))
            .withColumn("copies", F.col("base") + (F.col("place") <= F.col("quota")).cast("long")))
    even = one.filter((F.col("extra") == 0) | (F.col("extra") == F.col("c"))).withColumn(
        "copies", F.col("base") + (F.col("extra") > 0).cast("long"))
    cols = ["id", "source", "size", "h", "source_size", "target", "copies"]
    return part.select(*cols).unionByName(even.select(*cols))


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
             weights: DataFrame | None = None, budget_percent: float = BUDGET_PERCENT, most_times: int = MOST_TIMES,
             seed: int = SEED) -> DataFrame:
    """``copies`` of each document; ``weights`` is a frame (source, weight), by default weights are dealt in turn."""
    ensure_checkpoint_dir(docs.sparkSession)
    table = sized(docs, id_col, text, source, seed).checkpoint()
    sources = table.groupBy("source").agg(F.sum("size").alias("source_size"))
    if weights is None:
        weighed = cycled_weights(sources)
    else:
        given = weights.select(F.col("source").alias("of"), F.col("weight").cast("double").alias("weight"))
        weighed = sources.join(given, F.col("source").eqNullSafe(F.col("of")), "left").select(
            "source", "source_size", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    return copies(table, targets(weighed, budget_percent, most_times).checkpoint())


def mix_table(docs: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """One row per document: id, size, source_size, target, taken."""
    got = plan_mix(docs, id_col, **how)
    return got.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def cuts(got: DataFrame) -> DataFrame:
    """One row per (source, size): what :func:`copies` gives its documents, as a rule on their hashes.

    Documents before the place (``cut_bucket``, ``cut_h``) come ``base`` + 1 times, those behind it ``base`` times. Of the
    ``m`` at the place itself ``ties`` come once more: more than one only where rows share id and text.
    """
    key = ["source", "size"]
    counts = got.groupBy(*key).agg(F.count(F.lit(1)).alias("c"), F.min("copies").alias("base"), F.max("copies").alias("top"))
    counts = counts.withColumn("buckets", F.ceil(F.col("c") / BUCKET_ROWS).cast("long"))
    by = counts.select(F.col("source").alias("of"), F.col("size").alias("len"), "base", "top", "buckets")
    x = got.join(by, F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("len")) & (F.col("top") > F.col("base")))
    x = x.withColumn("place", F.struct(F.pmod("h", "buckets").alias("b"), "h"))
    each = x.groupBy(*key, "place").agg(F.count(F.lit(1)).alias("m"), F.sum((F.col("copies") > F.col("base")).cast("long")).alias("ties"))
    last = each.filter(F.col("ties") > 0).groupBy(*key).agg(F.max(F.struct("place", "m", "ties")).alias("cut"))
    last = last.select(F.col("source").alias("of"), F.col("size").alias("len"), "cut")
    return (counts.join(last, F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("len")), "left")
            .select(*key, "base", "buckets", F.col("cut.place.b").alias("cut_bucket"), F.col("cut.place.h").alias("cut_h"),
                    F.col("cut.m").alias("m"), F.col("cut.ties").alias("ties")))


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED, **how) -> DataFrame:
    """The mixed documents: each as often as the plan takes it, with the input's columns.

    No text is shuffled: the plan is a rule per (source, length), looked up in the scan. Only rows that
    share id and text at such a rule's very border are numbered, in as many tasks as there are partitions.
    """
    names = docs.columns
    rule = cuts(plan_mix(docs, id_col, text, source, seed=seed, **how).checkpoint()).checkpoint()
    new = {c: A.fresh(names, "_" + c) for c in ("source", "size", "base", "buckets", "cut_bucket", "cut_h", "m", "ties", "h", "row", "turn")}
    rule = rule.withColumnsRenamed({c: new[c] for c in rule.columns})
    if rule.count() <= BROADCAST_RULES:
        rule = F.broadcast(rule)
    t = F.col(text).cast("string")
    size = F.coalesce(F.regexp_count(t, F.lit(WORD)), F.lit(0)).cast("long")
    x = docs.withColumn(new["h"], F.xxhash64(F.lit(seed), F.col(id_col), t)).join(
        rule, F.col(source).eqNullSafe(F.col(new["source"])) & (size == F.col(new["size"])))
    h, bucket = F.col(new["h"]), F.pmod(new["h"], new["buckets"])
    before = (bucket < F.col(new["cut_bucket"])) | ((bucket == F.col(new["cut_bucket"])) & (h < F.col(new["cut_h"])))
    at_cut = F.coalesce(h == F.col(new["cut_h"]), F.lit(False))
    shared = at_cut & (F.col(new["ties"]) < F.col(new["m"]))
    more = F.coalesce(before, F.lit(False)) | at_cut
    n = F.col(new["base"]) + more.cast("long")
    out = x.filter(~shared).withColumn(new["row"], n)
    if not rule.filter(F.col(new["ties"]) < F.col(new["m"])).isEmpty():
        tied = x.filter(shared).withColumn(new["row"], F.monotonically_increasing_id())
        tied = with_index(tied, [F.xxhash64(*names), new["row"]], new["turn"], within=[new["h"]])
        out = out.unionByName(tied.withColumn(new["row"], F.col(new["base"]) + (F.col(new["turn"]) < F.col(new["ties"])).cast("long")).drop(new["turn"]))
    return out.select(*names, F.explode(F.array_repeat(F.lit(0), F.col(new["row"]).cast("int"))).alias(new["row"])).select(*names)
