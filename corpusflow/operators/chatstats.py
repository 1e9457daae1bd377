"""Chat-log statistics (group J): period counts, distinct actors, facets, merges.

All facets run as one expand-then-aggregate plan: every row is expanded into
(span, facet, key) tuples, a first aggregation de-duplicates keys map-side,
a second one counts.  One scan, two shuffles of already-reduced data, whatever
the number of spans and facets.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.time import SPANS, period_start, period_start_any

FACETS = ("userId", "sessionId", "userOrSessionId", "_id")
STATS_KEYS = ["at", "type", "span", "field", "distinct"]


def _facet_struct(tag: str, key: Column) -> Column:
    return F.struct(F.lit(tag).alias("tag"), key.cast("string").alias("key"))


def facet_stats(df: DataFrame, ts: str = "created_at", user: str = "user_id", session: str = "session_id",
                spans: Sequence[str] = SPANS, facets: Sequence[str] = FACETS,
                type_: str = "message", field: str = "createdAt", min_date: Column | None = None,
                span_col: str | None = None) -> DataFrame:
    """Counts per period for each facet: rows (``_id``), distinct users, sessions, user-or-session.

    ``userId`` / ``sessionId`` facets skip rows where that id is missing; ``userOrSessionId``
    counts a row with neither id as one group (as a group-by on a null key does).
    With ``span_col`` each row already names its one span (rows expanded upstream).
    Output: ``at`` (timestamp), ``span``, ``field``, ``type``, ``distinct``, ``count`` (bigint).
    """
    extra = [F.col(span_col).alias("_span")] if span_col else []
    base = df.select(F.col(ts).cast("timestamp").alias("_ts"), F.col(user).alias("_u"), F.col(session).alias("_s"), *extra)
    if min_date is not None:
        base = base.filter(F.col("_ts") >= min_date)
    if span_col:
        per_span = F.array(F.struct(F.col("_span").alias("span"), period_start_any(F.col("_ts"), F.col("_span")).alias("at")))
    else:
        per_span = F.array(*[F.struct(F.lit(s).alias("span"), period_start(F.col("_ts"), s).alias("at")) for s in spans])
    choices = {
        "userId": _facet_struct("userId", F.col("_u")),
        "sessionId": _facet_struct("sessionId", F.col("_s")),
        "userOrSessionId": _facet_struct("userOrSessionId", F.coalesce(F.col("_u").cast("string"), F.col("_s"))),
        # every row is its own id: no key needed, the first aggregation counts
        "_id": _facet_struct("_id", F.lit(None)),
    }
    exploded = (base
                .select(F.explode(per_span).alias("p"), F.array(*[choices[f] for f in facets]).alias("fs"))
                .select(F.col("p.span").alias("span"), F.col("p.at").alias("at"), F.explode("fs").alias("f"))
                .select("span", "at", F.col("f.tag").alias("tag"), F.col("f.key").alias("key"))
                .filter(~(F.col("tag").isin("userId", "sessionId") & F.col("key").isNull())))
    keyed = exploded.groupBy("span", "at", "tag", "key").agg(F.count(F.lit(1)).alias("_n"))
    out = (keyed.groupBy("span", "at", "tag")
           .agg(F.sum(F.when(F.col("tag") == "_id", F.col("_n")).otherwise(F.lit(1))).cast("bigint").alias("count")))
    return out.select("at", "span", F.lit(field).alias("field"), F.lit(type_).alias("type"),
                      F.col("tag").alias("distinct"), "count")


def period_activity_counts(df: DataFrame, ts: str = "created_at", span: str = "day") -> DataFrame:
    """Rows per period."""
    return (df.groupBy(period_start(F.col(ts), span).alias("at"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("count")))


def period_distinct(df: DataFrame, key: Column, ts: str = "created_at", span: str = "day",
                    null_is_group: bool = False, approximate: bool = False) -> DataFrame:
    """Distinct keys per period.  ``null_is_group`` counts a missing key once (group-by semantics)."""
    at = period_start(F.col(ts), span).alias("at")
    k = df.select(at, key.alias("_k"))
    if not null_is_group:
        k = k.filter(F.col("_k").isNotNull())
        agg = F.approx_count_distinct("_k") if approximate else F.countDistinct("_k")
    else:
        # struct(null) is a value, so a missing key is counted as one group
        agg = F.countDistinct(F.struct("_k"))
    return k.groupBy("at").agg(agg.cast("bigint").alias("count"))


def nest_messages(df: DataFrame, conv_key: str, order: str) -> DataFrame:
    """Flat messages -> one document per conversation with a sorted ``messages`` array."""
    cols = [c for c in df.columns if c != conv_key]
    return (df.groupBy(conv_key)
            .agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), *cols))).alias("messages")))


def message_level_stats(conversations: DataFrame, min_date: Column | None = None, **kw) -> DataFrame:
    """Facets over messages of nested conversation documents.

    Documents are first kept when any message is new enough (a whole-document match),
    then unwound to the messages that are new enough themselves.
    """
    docs = conversations
    if min_date is not None:
        new = F.filter("messages", lambda m: m["created_at"] >= min_date)
        docs = docs.filter(F.exists("messages", lambda m: m["created_at"] >= min_date)).withColumn("messages", new)
    flat = docs.select(F.inline("messages"))
    return facet_stats(flat, min_date=min_date, type_="message", **kw)


def merge_stats(target: DataFrame, updates: DataFrame, keys: Sequence[str] = STATS_KEYS) -> DataFrame:
    """Upsert on a composite key: matched rows take the update, others are inserted, untouched rows stay.

    Without a catalog table to MERGE into, this is a full outer join on the keys;
    the caller writes the result to a new path and swaps it in.
    """
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in target.columns if c not in keys])
    u = updates.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_u_{c}") for c in updates.columns if c not in keys])
    j = t.join(u, list(keys), "full_outer")
    vals = [c for c in target.columns if c not in keys]
    return j.select(*keys, *[F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(f"_t_{c}")).alias(c) for c in vals])


def touched(target: DataFrame, part: str, periods: list) -> DataFrame:
    """Rows of the given periods: a filter on the partition column, so that other folders are not listed or read."""
    some = F.col(part).isin([p for p in periods if p is not None])
    return target.filter(some | F.col(part).isNull() if None in periods else some)


def merge_into(path: str, updates: DataFrame, keys: Sequence[str], part: str) -> DataFrame:
    """Upsert into the Parquet table at ``path``, partitioned by the period column ``part`` (one of its key's parts).

    Only the periods that ``updates`` has are read, merged and written, by dynamic partition overwrite; all other history stays
    as it is.  Null keys are equal to each other.  The merged rows are checkpointed before the write, so a rerun after a failure gives the same
    table.  A period that the table doesn't have is added; without a table at ``path`` the updates are the table.
    Returns the whole table.
    """
    spark = updates.sparkSession
    keys = list(dict.fromkeys([part, *keys]))
    periods = [r[0] for r in updates.select(part).distinct().collect()]  # periods of one run, not rows
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    exists = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    new = updates
    if exists:
        old = touched(spark.read.schema(updates.schema).parquet(path), part, periods)
        mine = updates.select(*[F.col(k).alias(f"_u_{k}") for k in keys])
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_u_{k}")) for k in keys])
        new = updates.unionByName(old.join(mine, same, "left_anti")).checkpoint()
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)
    return spark.read.schema(updates.schema).parquet(path)


def incremental_stats(messages: DataFrame, stored: DataFrame, spans: Sequence[str] = SPANS,
                      type_: str = "message", field: str = "createdAt") -> DataFrame:
    """Recompute facets from the latest stored period on (``>=``: the last bucket is redone), then merge.

    The bound of each span is one row of a tiny table (spans x fields x types), joined
    by span; no value goes through the driver.  Missing history starts at the epoch.
    """
    bounds = (stored.filter((F.col("type") == type_) & (F.col("field") == field))
              .groupBy("span").agg(F.max("at").alias("_from")))
    base = messages.select(F.col("created_at").cast("timestamp").alias("_ts"), "user_id", "session_id")
    # history before the lowest bound goes before rows are expanded (one scalar; none if a span has no bound)
    lowest = bounds.agg(F.when(F.count(F.lit(1)) == len(spans), F.min("_from")).alias("low"))
    base = base.filter(F.col("_ts") >= F.coalesce(lowest.scalar(), F.lit("1970-01-01 00:00:00").cast("timestamp")))
    expanded = base.select("*", F.explode(F.array(*[F.lit(s) for s in spans])).alias("span"))
    kept = (expanded.join(F.broadcast(bounds), "span", "left")
            .filter(F.col("_ts") >= F.coalesce(F.col("_from"), F.lit("1970-01-01 00:00:00").cast("timestamp"))))
    # one facet pass over all spans: each kept row carries its span
    fresh = facet_stats(kept, ts="_ts", span_col="span", type_=type_, field=field)
    return merge_stats(stored, fresh)


def guest_usage(messages: DataFrame, caller: str, conv: str, role: str = "role", n: int = 10, limit: int = 20) -> DataFrame:
    """Assistant messages over a caller's first ``n + 1`` conversations (by id) that hold one, vs a limit."""
    from pyspark.sql import Window

    per_conv = (messages.filter(F.col(role) == "assistant")
                .groupBy(caller, conv).agg(F.count(F.lit(1)).alias("_m")))
    w = Window.partitionBy(caller).orderBy(conv)
    first = per_conv.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n + 1)
    return (first.groupBy(caller).agg(F.sum("_m").cast("bigint").alias("assistant_messages"))
            .withColumn("over_limit", F.col("assistant_messages") > limit))


def subscriber_counts(events: DataFrame, user: str, item: str, action: str, order: Sequence[str],
                      subscribe: str = "subscribe") -> DataFrame:
    """Subscribers per item after replaying +1/-1 only on state changes = users whose last action subscribes."""
    last = (events.groupBy(user, item)
            .agg(F.max_by(F.col(action), F.struct(*[F.col(c) for c in order])).alias("_last")))
    return (last.groupBy(item)
            .agg(F.sum(F.when(F.col("_last") == subscribe, 1).otherwise(0)).cast("bigint").alias("subscribers")))


def latest_votes(votes: DataFrame, message: str, score: str, order: Sequence[str]) -> DataFrame:
    """Latest valid vote per message; scores outside -1..1 are rejected; 0 clears the vote (null)."""
    valid = votes.filter(F.col(score).isin(-1, 0, 1))
    last = valid.groupBy(message).agg(F.max_by(F.col(score), F.struct(*[F.col(c) for c in order])).alias("_s"))
    return last.select(message, F.when(F.col("_s") != 0, F.col("_s")).cast("int").alias("score"))
