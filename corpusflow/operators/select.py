"""Projections, filters, samples and splits (group C).

Row filters are plain predicates so Catalyst pushes them into the parquet scan.
Order-dependent operators take an explicit order key and use the dense index plan
(never a window over the whole table); random ones use md5 buckets, never rand().
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions.text import col_, contains_any, nonempty, seeded_unit, tokens
from corpusflow.plans.dense_index import total_rows, with_index


def filter_label(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) == value)


def filter_length(df: DataFrame, col: str, lo: int, hi: int) -> DataFrame:
    """Keep ``lo < length <= hi`` characters."""
    n = F.length(col)
    return df.filter((n > lo) & (n <= hi))


def filter_tokens(df: DataFrame, cols: Sequence[str], max_len: int, inclusive: bool = False) -> DataFrame:
    """Keep rows whose token arrays are all shorter than ``max_len`` (or ``<=`` when inclusive)."""
    cond = None
    for c in cols:
        p = F.size(c) <= max_len if inclusive else F.size(c) < max_len
        cond = p if cond is None else cond & p
    return df.filter(cond)


def filter_pair_chars(df: DataFrame, max_chars: int, prompt: str = "prompt", chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    lp = F.length(prompt)
    return df.filter((lp + F.length(chosen) <= max_chars) & (lp + F.length(rejected) <= max_chars))


def filter_nonempty(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cond = None
    for c in cols:
        cond = nonempty(c) if cond is None else cond & nonempty(c)
    return df.filter(cond)


def filter_keywords(df: DataFrame, col: str, keywords: Sequence[str]) -> DataFrame:
    return df.filter(contains_any(col, keywords))


def keyword_retention(df: DataFrame, pred: Column) -> DataFrame:
    """Share of rows the predicate keeps, in one aggregate pass."""
    return df.agg(F.count(F.lit(1)).alias("total"), F.sum(pred.cast("int")).cast("bigint").alias("kept"),
                  F.avg(pred.cast("double")).alias("retention"))


def filter_score(df: DataFrame, path: str, threshold: float) -> DataFrame:
    """Nested score above a threshold; a null score drops the row."""
    return df.filter(F.col(path) > threshold)


def filter_domains(df: DataFrame, col: str, blocked: Sequence[str], per: str, order: Sequence[str], limit: int = 10) -> DataFrame:
    """Drop rows whose link contains a blocked domain, then keep the first ``limit`` per group.

    The per-group limit is a ``row_number`` filter that Spark plans as a window group
    limit before the shuffle.
    """
    ok = ~contains_any(col, blocked) if blocked else F.lit(True)
    w = Window.partitionBy(per).orderBy(*order)
    return df.filter(ok).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= limit).drop("_rn")


def with_hostname(df: DataFrame, col: str, out: str = "hostname") -> DataFrame:
    """Parse the URL host; rows whose URL does not parse are dropped."""
    return df.withColumn(out, F.try_parse_url(F.col(col), F.lit("HOST"))).filter(F.col(out).isNotNull())


def visible_to(df: DataFrame, user=None, session=None, user_col: str = "user_id", session_col: str = "session_id") -> DataFrame:
    """Rows a caller may see: by user id when logged in, else by session id with no user id."""
    if user is not None:
        return df.filter(F.col(user_col) == user)
    return df.filter((F.col(session_col) == session) & F.col(user_col).isNull())


def head_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First n rows in dataset order (a top-n: TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def every_nth(df: DataFrame, order: Sequence[str], n: int, within: Sequence[str] = ()) -> DataFrame:
    """Rows whose 0-based index (counted inside each split) is a multiple of n."""
    return with_index(df, order, "_idx", within=within).filter(F.pmod("_idx", F.lit(n)) == 0).drop("_idx")


def shuffle_take(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Seeded shuffle then take n: order by md5(seed|id), deterministic and SQL-checkable."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string"))), key).limit(n)


def slice_rows(df: DataFrame, order: Sequence[str], lo, hi, pct: bool = False) -> DataFrame:
    """Rows ``[lo, hi)`` by dense index; with ``pct`` the bounds are shares of the row count (rounded)."""
    ix = with_index(df, order, "_idx")
    if not pct:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col("_idx") >= lo)
        if hi is not None:
            cond = cond & (F.col("_idx") < hi)
        return ix.filter(cond).drop("_idx")
    ix = ix.crossJoin(F.broadcast(total_rows(df)))
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col("_idx") >= F.round(F.col("_total") * lo))
    if hi is not None:
        cond = cond & (F.col("_idx") < F.round(F.col("_total") * hi))
    return ix.filter(cond).drop("_idx", "_total")


def ensure_validation(df: DataFrame, order: Sequence[str], pct: float = 0.05) -> DataFrame:
    """First ``pct`` of rows (by order) become validation, the rest train."""
    ix = with_index(df, order, "_idx").crossJoin(F.broadcast(total_rows(df)))
    return ix.withColumn("split", F.when(F.col("_idx") < F.round(F.col("_total") * pct), "validation").otherwise("train")).drop("_idx", "_total")


def train_test_split(df: DataFrame, key: str, test: float, seed: int) -> DataFrame:
    """Seeded split by hash threshold: no shuffle, stable when data grows."""
    return df.withColumn("split", F.when(seeded_unit(seed, F.col(key)) < test, "test").otherwise("train"))


def ordered_split(df: DataFrame, order: Sequence[str], test: float) -> DataFrame:
    """Unshuffled split: the last ``ceil(test * N)`` rows in order are test."""
    ix = with_index(df, order, "_idx").crossJoin(F.broadcast(total_rows(df)))
    n_train = F.col("_total") - F.ceil(F.col("_total") * test)
    return ix.withColumn("split", F.when(F.col("_idx") < n_train, "train").otherwise("test")).drop("_idx", "_total")


def three_way_split(df: DataFrame, key: str, train: float, validation: float, test: float, seed: int) -> DataFrame:
    """train / validation / test from one hash bucket and two thresholds: disjoint and exhaustive."""
    u = seeded_unit(seed, F.col(key))
    total = train + validation + test
    return df.withColumn("split", F.when(u < train / total, "train").when(u < (train + validation) / total, "validation").otherwise("test"))


def label_text(df: DataFrame, col: str, names: Sequence[str], out: str = "label_text") -> DataFrame:
    """Integer label to class name, underscores shown as spaces."""
    arr = F.array(*[F.lit(n.replace("_", " ")) for n in names])
    return df.withColumn(out, F.element_at(arr, F.col(col) + 1))


# fixed values: user-count display buckets (inclusive bounds, label)
COUNT_BUCKETS = [(0, 1, "1"), (2, 9, "1-10"), (10, 49, "10+"), (50, 99, "50+"), (100, 299, "100+"),
                 (300, 499, "300+"), (500, 999, "500+"), (1000, 2999, "1k+"), (3000, 4999, "3k+"),
                 (5000, 9999, "5k+"), (10000, None, "10k+")]


def bucket_label(c: Column | str) -> Column:
    """Display bucket of a count; empty string outside every bucket."""
    c = col_(c)
    expr = None
    for lo, hi, label in COUNT_BUCKETS:
        cond = (c >= lo) if hi is None else (c >= lo) & (c <= hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise("")
