"""Streaming operators (group Q): the same logic as the batch operators, on unbounded input.

Event time comes with a watermark (10 minutes by default, longer where a period must stay open);
late rows beyond it are dropped by Spark and counted in the query progress.  Keyed state uses
``applyInPandasWithState``: the rate limit frees idle keys by event-time timers; packing keeps a bounded buffer
per key for as long as the stream runs.  Operators with lists and several timers per key are in ``stateful``.
"""

from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from corpusflow.functions.text import contains_any

WATERMARK = "10 minutes"


def stream_filter(sdf: DataFrame, col: str, keywords: Sequence[str]) -> DataFrame:
    """Keyword filter with the retention share reported as observed metrics of each batch."""
    pred = contains_any(col, keywords)
    seen = sdf.observe("keyword_retention", F.count(F.lit(1)).alias("total"), F.sum(pred.cast("int")).alias("kept"))
    return seen.filter(pred)


def rate_windows(sdf: DataFrame, key: str, ts: str, window: str = "60 seconds", slide: str = "30 seconds",
                 watermark: str = WATERMARK) -> DataFrame:
    """Events per key in sliding windows (update mode)."""
    return (sdf.withWatermark(ts, watermark).groupBy(key, F.window(ts, window, slide).alias("w"))
            .agg(F.count(F.lit(1)).alias("n")))


def tumbling_counts(sdf: DataFrame, ts: str, period: str = "1 day", watermark: str = "1 day") -> DataFrame:
    return sdf.withWatermark(ts, watermark).groupBy(F.window(ts, period).alias("w")).agg(F.count(F.lit(1)).alias("n"))


def distinct_actors(sdf: DataFrame, ts: str, actor: str, watermark: str = "2 days") -> DataFrame:
    """First (day, actor) occurrences: dedupe kept in state only within the watermark (at least one period)."""
    return (sdf.withWatermark(ts, watermark).withColumn("day", F.date_format(ts, "yyyy-MM-dd"))
            .dropDuplicatesWithinWatermark(["day", actor]).select("day", actor))


def sessions(sdf: DataFrame, key: str, ts: str, gap: str, watermark: str = WATERMARK) -> DataFrame:
    """Gap-based sessions per key (session windows)."""
    return (sdf.withWatermark(ts, watermark).groupBy(key, F.session_window(ts, gap).alias("s"))
            .agg(F.count(F.lit(1)).alias("n")))


def token_counters(sdf: DataFrame, chain: str, kind: str, n: str, ts: str, watermark: str = WATERMARK) -> DataFrame:
    """Tokens per chain and kind; ``ts`` is the chain's time, so a chain's counts come out, and leave the state,
    once the watermark has passed it (append mode)."""
    return sdf.withWatermark(ts, watermark).groupBy(ts, chain, kind).agg(F.sum(n).alias("tokens"))


def scale_signal(sdf: DataFrame, endpoint: str, ts: str, util: str, target: float, period: str = "5 minutes") -> DataFrame:
    """Average utilisation per endpoint and period against a target: scale_out above, scale_in below half."""
    a = (sdf.withWatermark(ts, WATERMARK).groupBy(endpoint, F.window(ts, period).alias("w")).agg(F.avg(util).alias("avg_util")))
    sig = F.when(F.col("avg_util") > target, "scale_out").when(F.col("avg_util") < target / 2, "scale_in").otherwise("hold")
    return a.withColumn("signal", sig)


def pack_stream(sdf: DataFrame, shard: str, order: Sequence[str], ids: str, n: int, eos: int | None = None, wrap: bool = True) -> DataFrame:
    """Endless documents to chunks of n tokens: one buffer per shard, full chunks out, remainder kept in state.

    ``eos`` ends each document.  Without ``wrap`` the rest of a document that fills a chunk is dropped.  A shard's state is less than a chunk; spread a hot key over several shards.
    """
    key_t = sdf.schema[shard].dataType.simpleString()
    ord_cols = list(order)

    def fn(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        buf, done = (list(state.get[0]), int(state.get[1])) if state.exists else ([], 0)
        pdf = pd.concat(list(pdfs)).sort_values(ord_cols)
        end = [] if eos is None else [np.array([eos], np.int32)]
        held, size, chunks = [np.array(buf, np.int32)], len(buf), []  # arrays of the open chunk, their length
        for arr in pdf[ids]:
            held += [arr, *end]
            size += len(arr) + len(end)
            if not wrap and size >= n:
                chunks.append(np.concatenate(held)[:n])
                held, size = [np.array([], np.int32)], 0
        flat = np.concatenate(held)
        full = size // n * n
        chunks += list(flat[:full].reshape(-1, n))
        state.update((flat[full:].tolist(), done + len(chunks)))
        yield pd.DataFrame({shard: [key[0]] * len(chunks), "chunk": list(range(done, done + len(chunks))), "input_ids": chunks})

    x = sdf.select(shard, *ord_cols, F.col(ids).cast("array<int>").alias(ids))
    return x.groupBy(shard).applyInPandasWithState(
        fn, f"{shard} {key_t}, chunk long, input_ids array<int>", "buf array<int>, done long", "append", GroupStateTimeout.NoTimeout)


def rate_limit(sdf: DataFrame, key: str, ts: str, order: str, window_s: int = 60, limit: int = 2,
               watermark: str = WATERMARK) -> DataFrame:
    """Exact per-event rate: events of the same key in (ts - window, ts], flagged above ``limit``.

    Keyed state holds only the key's event times inside the window (bounded by the rate): old ones leave at
    the front of a queue, and an event-time timer drops a key once the watermark has passed its window.
    Rows of a batch are taken in event-time order.
    """
    key_t = sdf.schema[key].dataType.simpleString()
    span_us = window_s * 1_000_000

    def fn(k, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        buf = deque(state.get[0] if state.exists else ())
        pdf = pd.concat(list(pdfs)).sort_values(["_us", order])
        counts = []
        for t in pdf["_us"]:
            buf.append(int(t))
            while buf[0] <= t - span_us:
                buf.popleft()
            counts.append(len(buf))
        state.update((list(buf),))
        state.setTimeoutTimestamp(max((buf[-1] + span_us) // 1000, state.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame({key: k[0], order: pdf[order].to_numpy(), "n": counts, "over_limit": [c > limit for c in counts]})

    x = sdf.withWatermark(ts, watermark).select(key, order, ts, F.unix_micros(F.col(ts).cast("timestamp")).alias("_us"))
    return x.groupBy(key).applyInPandasWithState(
        fn, f"{key} {key_t}, {order} bigint, n long, over_limit boolean", "times array<long>", "append", GroupStateTimeout.EventTimeTimeout)
