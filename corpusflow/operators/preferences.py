"""Preference and feedback data (group N) and evaluation metrics (group O)."""

from collections import Counter
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions.text import col_

RANKING_SCHEMA = ("inputContent struct<taskObject: struct<prompt: string, responses: array<string>>>, "
                  "humanAnswers array<struct<answerContent: map<string, int>>>")


def parse_rankings(df: DataFrame, col: str, key: str) -> DataFrame:
    """Labelling output JSON -> (key, prompt, pos, response, ranking).

    The ranking of response i is read from ``response_{i}_ranking`` or ``ranking_{i}`` of the first answer.
    """
    j = df.select(key, F.from_json(F.col(col), RANKING_SCHEMA).alias("j"))
    ex = j.select(key, F.col("j.inputContent.taskObject.prompt").alias("prompt"),
                  F.col("j.humanAnswers")[0]["answerContent"].alias("ans"),
                  F.posexplode("j.inputContent.taskObject.responses").alias("pos", "response"))
    n = (F.col("pos") + 1).cast("string")
    rank = F.coalesce(F.try_element_at(F.col("ans"), F.concat(F.lit("response_"), n, F.lit("_ranking"))),
                      F.try_element_at(F.col("ans"), F.concat(F.lit("ranking_"), n)))
    return ex.select(key, "prompt", "pos", "response", rank.alias("ranking"))


def rank_to_reward(ranking: Column, n: Column) -> Column:
    return F.abs(ranking - n)


def to_pairs(responses: Column, rankings: Column) -> tuple[Column, Column, Column]:
    """Two responses ranked 0 (preferred) and 1 -> (text_j, text_k, error)."""
    ok = (F.size(responses) == 2) & (F.array_sort(rankings) == F.array(F.lit(0), F.lit(1)))
    j = F.when(ok, responses[F.array_position(rankings, 0) - 1])
    k = F.when(ok, responses[F.array_position(rankings, 1) - 1])
    return j, k, F.when(~ok, F.lit("expected two responses ranked 0 and 1"))


def softplus_neg(x: Column) -> Column:
    """log(1 + exp(-x)), stable for large |x|."""
    return F.greatest(-x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def class_score(scores: Column, label: str) -> Column:
    return F.filter(scores, lambda s: s["label"] == label)[0]["score"]


def softmax_score(scores: Column, label: str) -> Column:
    den = F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + F.exp(s["score"]))
    return F.exp(class_score(scores, label)) / den


def rouge_tokens(text: Column | str) -> Column:
    """Tokens of the ROUGE scorer: lower case, runs of [a-z0-9]."""
    return F.regexp_extract_all(F.lower(col_(text)), F.lit("[a-z0-9]+"), 0)


def _overlaps(lists: list, n: int) -> tuple[list, list]:
    """N-grams that a row has in common (the smaller count of each) in the first and each other list column; n-grams per row of every column.

    Counted for all rows of the batch at once: equal tokens get equal numbers, an n-gram is the number made of its tokens'.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    height = len(lists[0])
    lens = [pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False).astype(np.int64) for x in lists]
    words = pa.concat_arrays([x.flatten() for x in lists]).dictionary_encode()
    code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(height * len(lists)), np.concatenate(lens))  # counts on through the columns
    base = size = max(1, len(words.dictionary))
    gram = code
    for k in range(1, n):
        if size * base >= _MANY:
            seen, gram = np.unique(gram, return_inverse=True)
            size = max(1, len(seen))
        gram, size = gram[:-1] * base + code[k:], size * base
    if size * height >= _MANY:
        seen, gram = np.unique(gram, return_inverse=True)
        size = max(1, len(seen))
    start = row[:len(gram)]
    whole = start == row[n - 1:]  # n-grams don't reach into the next row
    key, start = (start % max(1, height) * size + gram)[whole], start[whole]
    ends = np.searchsorted(start, np.arange(len(lists) + 1) * height)
    (first, times), *others = [np.unique(key[i:j], return_counts=True) for i, j in zip(ends, ends[1:])]
    common = []
    for keys, counts in others:
        same, i, j = np.intersect1d(first, keys, assume_unique=True, return_indices=True)
        common.append(np.bincount(same // size, np.minimum(times[i], counts[j]), height).astype(np.int64))
    return common, [np.maximum(x - n + 1, 0) for x in lens]


_MANY = 1 << 62  # below this, numbers of n-grams fit


def _rouge_counts(df: DataFrame, key: str, preds: Sequence[str], ref: str, ns: Sequence[int]) -> DataFrame:
    """(key, ov_i_n, np_i_n, nr_n): n-grams in common, of the i-th prediction, and of the reference.

    All sides stand in one row, so the counts are made there, per Arrow batch of token lists: no shuffle, and the
    reference is cut into tokens once for all predictions.
    """
    import pyarrow as pa

    fields = [f for n in ns for f in (f"nr_{n}", *[f"{x}_{i}_{n}" for i in range(len(preds)) for x in ("ov", "np")])]

    @F.arrow_udf("struct<" + ", ".join(f"{f}: long" for f in fields) + ">")
    def counts(*lists: pa.Array) -> pa.Array:
        cols = []
        for n in ns:
            common, (whole, *sizes) = _overlaps(list(lists), n)
            cols += [whole, *[x for pair in zip(common, sizes) for x in pair]]
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in cols], names=fields)

    return df.select(key, counts(*[rouge_tokens(c) for c in (ref, *preds)]).alias("c")).select(key, "c.*")


def _rouge_columns(i: int, n: int) -> dict[str, Column]:
    """Scores of the i-th prediction from the counts."""
    p = F.when(F.col(f"np_{i}_{n}") > 0, F.col(f"ov_{i}_{n}") / F.col(f"np_{i}_{n}")).otherwise(F.lit(0.0))
    r = F.when(F.col(f"nr_{n}") > 0, F.col(f"ov_{i}_{n}") / F.col(f"nr_{n}")).otherwise(F.lit(0.0))
    return {"precision": p, "recall": r, "f1": F.when((p + r) > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))}


def rouge_wide(df: DataFrame, key: str, pred: str, ref: str, ns=(1, 2)) -> DataFrame:
    """Per row ROUGE-n precision_n / recall_n / f1_n for every n in ``ns`` from multiset n-gram overlap."""
    x = _rouge_counts(df, key, [pred], ref, ns)
    return x.select(key, *[c.alias(f"{name}_{n}") for n in ns for name, c in _rouge_columns(0, n).items()])


def rouge_scores(df: DataFrame, key: str, pred: str, ref: str, ns=(1, 2)) -> DataFrame:
    """The same with a row per ``n``: (key, n, precision, recall, f1)."""
    w = rouge_wide(df, key, pred, ref, ns)
    each = [F.struct(F.lit(n).alias("n"), *[F.col(f"{c}_{n}").alias(c) for c in ("precision", "recall", "f1")]) for n in ns]
    return w.select(key, F.inline(F.array(*each)))


def rouge_n(df: DataFrame, key: str, pred: str | Mapping[str, str], ref: str, n: int) -> DataFrame:
    """ROUGE-n for one n: (key, precision, recall, f1); with a prediction column per model, (key, model, ...) in one pass."""
    if not isinstance(pred, str):
        x = _rouge_counts(df, key, list(pred.values()), ref, (n,))
        each = [F.struct(F.lit(m).alias("model"), *[c.alias(name) for name, c in _rouge_columns(i, n).items()]) for i, m in enumerate(pred)]
        return x.select(key, F.inline(F.array(*each)))
    return rouge_scores(df, key, pred, ref, (n,)).drop("n")


def _lcs_places(a: list, b: list) -> set[int]:
    """Places in ``a`` of one longest common subsequence with ``b``.

    One bit row per element of ``a`` (a zero bit where the length grows along ``b``), so memory is len(a) * len(b) bits;
    the way back reads lengths off these rows.
    """
    masks: dict = {}
    for j, y in enumerate(b):
        masks[y] = masks.get(y, 0) | (1 << j)
    full = (1 << len(b)) - 1
    rows = [full]
    for x in a:
        v = rows[-1]
        u = v & masks.get(x, 0)
        rows.append(((v + u) | (v - u)) & full)
    i, j, out = len(a), len(b), set()
    left = len(b) - rows[-1].bit_count()  # length of the best subsequence of a[:i] and b[:j]
    while left:
        if a[i - 1] == b[j - 1]:
            out.add(i - 1)
            i, j, left = i - 1, j - 1, left - 1
        elif j - (rows[i - 1] & ((1 << j) - 1)).bit_count() == left:
            i -= 1
        else:
            j -= 1
    return out


def union_lcs(pred: list[list], ref: list[list]) -> int:
    """ROUGE-Lsum hits: per reference sentence the union of its LCS places with every predicted sentence,
    each token counted at most as often as both sides have it."""
    left, right = (Counter(t for s in x for t in s) for x in (pred, ref))
    hits = 0
    for r in ref:
        places = set().union(*[_lcs_places(r, p) for p in pred]) if pred else set()
        for i in sorted(places):
            if left[r[i]] > 0 and right[r[i]] > 0:
                hits += 1
                left[r[i]] -= 1
                right[r[i]] -= 1
    return hits


def rouge_lsum(df: DataFrame, key: str, pred: str, ref: str) -> DataFrame:
    """ROUGE-Lsum precision / recall / F1 per row; sentences are the text's lines."""
    import pandas as pd

    @F.pandas_udf("struct<hits: long, np: long, nr: long>")
    def hits_udf(p: pd.Series, r: pd.Series) -> pd.DataFrame:
        rows = []
        for x, y in zip(p, r):
            a, b = [list(s) for s in x], [list(s) for s in y]
            rows.append((union_lcs(a, b), sum(map(len, a)), sum(map(len, b))))
        return pd.DataFrame(rows, columns=["hits", "np", "nr"])

    def lines(c):
        return F.transform(F.split(F.coalesce(F.col(c), F.lit("")), "\n", -1), rouge_tokens)

    x = df.select(key, hits_udf(lines(pred), lines(ref)).alias("l"))
    p = F.when(F.col("l.np") > 0, F.col("l.hits") / F.col("l.np")).otherwise(F.lit(0.0))
    r = F.when(F.col("l.nr") > 0, F.col("l.hits") / F.col("l.nr")).otherwise(F.lit(0.0))
    f = F.when((p + r) > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return x.select(key, F.col("l.hits").alias("hits"), p.alias("precision"), r.alias("recall"), f.alias("f1"))


def lcs_length(a: list, b: list) -> int:
    """Longest common subsequence length, bit-parallel (Hyyro): O(len(a) * len(b) / word) on whole texts."""
    if not a or not b:
        return 0
    masks: dict = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for y in b:
        u = v & masks.get(y, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def rouge_l(df: DataFrame, key: str, pred: str, ref: str) -> DataFrame:
    """ROUGE-L precision / recall / F1 per row; LCS in an Arrow-batched pandas UDF over whole token lists."""
    import pandas as pd

    @F.pandas_udf("struct<lcs: long, np: long, nr: long>")
    def lcs_udf(p: pd.Series, r: pd.Series) -> pd.DataFrame:
        rows = [(lcs_length(list(x), list(y)), len(x), len(y)) for x, y in zip(p, r)]
        return pd.DataFrame(rows, columns=["lcs", "np", "nr"])

    x = df.select(key, lcs_udf(rouge_tokens(pred), rouge_tokens(ref)).alias("l"))
    p = F.when(F.col("l.np") > 0, F.col("l.lcs") / F.col("l.np")).otherwise(F.lit(0.0))
    r = F.when(F.col("l.nr") > 0, F.col("l.lcs") / F.col("l.nr")).otherwise(F.lit(0.0))
    f = F.when((p + r) > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return x.select(key, F.col("l.lcs").alias("lcs"), p.alias("precision"), r.alias("recall"), f.alias("f1"))
