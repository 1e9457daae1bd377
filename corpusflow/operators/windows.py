"""Window operators and ordering inside groups (groups K, L, M helpers).

Windows are always partitioned by a bounded group (a thread, a query) or run over
a frame that was first cut to a bounded size per group (top-B tails); a whole-table
order goes through the range-partitioned dense index instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def topk(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """k best rows per group; ``row_number <= k`` is planned as a window group limit before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def last_k_turns(df: DataFrame, conv: str, turn: str, k: int) -> DataFrame:
    """Last k exchanges (2k turns) of every conversation."""
    return topk(df, [conv], [F.col(turn).desc()], 2 * k).drop("rank")


def previous_rows(df: DataFrame, group: str, order: str, value: str, out: str = "previous") -> DataFrame:
    """Earlier values of the group, in order (frame unbounded preceding .. -1)."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.collect_list(value).over(w))


def last_by(df: DataFrame, group: str, order: str, value: str, default: str = "") -> DataFrame:
    return df.groupBy(group).agg(F.coalesce(F.max_by(value, order), F.lit(default)).alias(value))


def per_prompt_advantages(df: DataFrame, prompt: str, epoch: str, order: str, reward: str,
                          buffer: int = 16, min_count: int = 16, eps: float = 1e-6) -> DataFrame:
    """(reward - mean) / (std + eps) with mean/std over the last ``buffer`` rewards of the prompt up to the end of
    this epoch (batch included); whole-batch statistics while the buffer holds fewer than ``min_count``.

    Only the last ``buffer`` rows of each (prompt, epoch) can be in any buffer, so those tails are cut
    first (window group limit, bounded per group); the rolling frame then runs over the tails of one
    prompt (at most buffer x epochs rows), never over all rows of a hot prompt.
    """
    tail = topk(df.select(prompt, epoch, order, reward), [prompt, epoch], [F.col(order).desc()], buffer)
    w = Window.partitionBy(prompt).orderBy(epoch, order).rowsBetween(-(buffer - 1), 0)
    rolled = tail.select(prompt, epoch, "rank", F.avg(reward).over(w).alias("_m"), F.stddev_pop(reward).over(w).alias("_s"),
                         F.count(F.lit(1)).over(w).alias("_n"))
    at_end = rolled.filter(F.col("rank") == 1).drop("rank")
    batch = df.groupBy(epoch).agg(F.avg(reward).alias("_bm"), F.stddev_pop(reward).alias("_bs"))
    stats = (at_end.join(batch, epoch)
             .select(prompt, epoch, F.when(F.col("_n") < min_count, F.col("_bm")).otherwise(F.col("_m")).alias("mean"),
                     F.when(F.col("_n") < min_count, F.col("_bs")).otherwise(F.col("_s")).alias("std")))
    return df.join(stats, [prompt, epoch]).withColumn("advantage", (F.col(reward) - F.col("mean")) / (F.col("std") + eps))


def global_advantages(df: DataFrame, epoch: str, reward: str, eps: float = 1e-8) -> DataFrame:
    """(reward - mean) / (std + eps) over the batch: a grouped aggregate joined back, not an unpartitioned window."""
    stats = df.groupBy(epoch).agg(F.avg(reward).alias("mean"), F.stddev_pop(reward).alias("std"))
    return df.join(stats, epoch).withColumn("advantage", (F.col(reward) - F.col("mean")) / (F.col("std") + eps))


def prompt_stats(df: DataFrame, prompt: str, order: Sequence[str], reward: str, buffer: int = 16) -> DataFrame:
    """Mean, std and count of each prompt's final buffer (its last ``buffer`` rewards)."""
    last = topk(df, [prompt], [F.col(c).desc() for c in order], buffer)
    return last.groupBy(prompt).agg(F.avg(reward).alias("mean"), F.stddev_pop(reward).alias("std"), F.count(F.lit(1)).alias("count"))


def to_tree(df: DataFrame, conv: str, order: str, id_col: str) -> DataFrame:
    """Linear thread to tree links: ancestors = earlier ids in order, children = the next id (or none)."""
    w = Window.partitionBy(conv).orderBy(order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    nxt = F.lead(id_col).over(w)
    return (df.withColumn("ancestors", F.collect_list(id_col).over(before))
            .withColumn("children", F.when(nxt.isNull(), F.array().cast("array<string>")).otherwise(F.array(nxt))))


def concat_datasets(sets: dict[str, DataFrame], name: str = "dataset") -> DataFrame:
    """All rows of the named datasets, one scan each and no shuffle; ``name`` tells where a row is from.

    Columns meet by name; one that a dataset lacks is null in its rows.
    """
    parts = [df.withColumn(name, F.lit(k)) for k, df in sets.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
