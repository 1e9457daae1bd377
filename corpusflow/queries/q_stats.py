"""Group J: aggregations over the chat log and sales tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from corpusflow.operators import chatstats as cs
from corpusflow.operators.reports import revenue_extremes, revenue_totals
from corpusflow.plans.dense_index import with_index
from corpusflow.queries.common import day, r6, t
from corpusflow.queries.registry import register
from corpusflow.queries.sqlparts import CHAT, SALES, facets_sql, period
from corpusflow.sources.readers import scratch_path
from corpusflow.sources.derived import chat_log, sales

G = "J"


def _fmt(df):
    return df.withColumn("at", day("at"))


register("period_activity_counts", G, sql=f"""
WITH {CHAT}
SELECT strftime({period('created_at', 'week')}, '%Y-%m-%d') AS at, count(*) AS "count" FROM chat GROUP BY 1
""")(lambda spark, d: _fmt(cs.period_activity_counts(chat_log(t(spark, d, "events")), span="week")))

register("period_distinct_users", G, sql=f"""
WITH {CHAT}
SELECT strftime({period('created_at', 'day')}, '%Y-%m-%d') AS at, count(DISTINCT user_id) AS "count"
FROM chat WHERE user_id IS NOT NULL GROUP BY 1
""")(lambda spark, d: _fmt(cs.period_distinct(chat_log(t(spark, d, "events")), F.col("user_id"), span="day")))

register("period_distinct_sessions", G, sql=f"""
WITH {CHAT}
SELECT strftime({period('created_at', 'month')}, '%Y-%m-%d') AS at, count(DISTINCT session_id) AS "count"
FROM chat WHERE session_id IS NOT NULL GROUP BY 1
""")(lambda spark, d: _fmt(cs.period_distinct(chat_log(t(spark, d, "events")), F.col("session_id"), span="month")))

register("period_distinct_user_or_session", G, sql=f"""
WITH {CHAT}
SELECT strftime({period('created_at', 'week')}, '%Y-%m-%d') AS at,
       count(DISTINCT coalesce(CAST(user_id AS VARCHAR), session_id))
       + max(CASE WHEN user_id IS NULL AND session_id IS NULL THEN 1 ELSE 0 END) AS "count"
FROM chat GROUP BY 1
""")(lambda spark, d: _fmt(cs.period_distinct(
    chat_log(t(spark, d, "events")), F.coalesce(F.col("user_id").cast("string"), F.col("session_id")),
    span="week", null_is_group=True)))


@register("facet_stats", G, sql=f"WITH {CHAT} {facets_sql('chat')}")
def q_facet_stats(spark, d):
    return _fmt(cs.facet_stats(chat_log(t(spark, d, "events"))))


@register("message_level_stats", G, sql=f"WITH {CHAT} {facets_sql('chat', where='created_at >= TIMESTAMP ' + chr(39) + '2024-01-10 00:00:00' + chr(39))}")
def q_message_level_stats(spark, d):
    chat = chat_log(t(spark, d, "events"))
    # the fixture's events name no conversation: 32 consecutive ids are one, so none grows with the table
    docs = cs.nest_messages(chat.withColumn("conv", F.floor(F.col("message_id") / 32)), "conv", "message_id")
    bound = F.lit("2024-01-10 00:00:00").cast("timestamp")
    return _fmt(cs.message_level_stats(docs, min_date=bound))


@register("incremental_stats", G, sql=f"WITH {CHAT} {facets_sql('chat')}")
def q_incremental_stats(spark, d):
    chat = chat_log(t(spark, d, "events"))
    first_slice = chat.filter(F.col("created_at") < F.lit("2024-01-15 00:00:00").cast("timestamp"))
    stored = cs.facet_stats(first_slice)
    return _fmt(cs.incremental_stats(chat, stored))


@register("merge_stats_table", "B", sql=f"""
WITH {CHAT},
old AS (SELECT strftime(date_trunc('day', created_at), '%Y-%m-%d') AS at, count(*) AS n FROM chat
        WHERE created_at < TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1),
new AS (SELECT strftime(date_trunc('day', created_at), '%Y-%m-%d') AS at, count(*) AS n FROM chat
        WHERE created_at >= TIMESTAMP '2024-01-10 00:00:00' GROUP BY 1)
SELECT coalesce(new.at, old.at) AS at, coalesce(new.n, old.n) AS n, new.at IS NOT NULL AS updated
FROM old FULL OUTER JOIN new ON old.at = new.at
""")
def q_merge_stats_table(spark, d):
    chat = chat_log(t(spark, d, "events"))
    dayc = lambda df: df.groupBy(day(F.date_trunc("day", "created_at")).alias("at")).agg(F.count(F.lit(1)).alias("n"))
    week = day(F.date_trunc("week", F.col("at").cast("timestamp"))).alias("week")
    old = dayc(chat.filter(F.col("created_at") < F.lit("2024-01-20 00:00:00").cast("timestamp")))
    new = dayc(chat.filter(F.col("created_at") >= F.lit("2024-01-10 00:00:00").cast("timestamp")))
    # the stored table is partitioned by week: weeks without news are neither read nor written
    path = scratch_path(spark, "stats")
    cs.merge_into(path, old.select("at", "n", F.lit(False).alias("updated"), week), ["at"], "week")
    merged = cs.merge_into(path, new.select("at", "n", F.lit(True).alias("updated"), week), ["at"], "week")
    return merged.select("at", "n", "updated")


@register("count_assistant_messages", G, sql="""
WITH per AS (SELECT conv_id // 10 AS caller, conv_id, count(*) AS m FROM conversations WHERE role = 'assistant' GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY caller ORDER BY conv_id) AS rn FROM per)
SELECT caller, CAST(sum(m) AS BIGINT) AS assistant_messages, sum(m) > 5 AS over_limit FROM r WHERE rn <= 3 GROUP BY caller
""")
def q_count_assistant_messages(spark, d):
    conv = t(spark, d, "conversations").withColumn("caller", F.expr("conv_id div 10"))
    return cs.guest_usage(conv, "caller", "conv_id", n=2, limit=5)


@register("subscriber_counts", G, sql="""
WITH a AS (SELECT json_extract_string(props, '$.k') AS item, event_type,
                  row_number() OVER (PARTITION BY user_id, json_extract_string(props, '$.k') ORDER BY ts DESC, event_id DESC) AS rn
           FROM events WHERE event_type IN ('signup', 'click'))
SELECT item, CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS subscribers FROM a WHERE rn = 1 GROUP BY item
""")
def q_subscriber_counts(spark, d):
    ev = (t(spark, d, "events")
          .select("user_id", "ts", "event_id", F.get_json_object("props", "$.k").alias("item"),
                  F.when(F.col("event_type") == "signup", "subscribe").when(F.col("event_type") == "click", "unsubscribe").alias("action"))
          .filter(F.col("action").isNotNull()))
    return cs.subscriber_counts(ev, "user_id", "item", "action", ["ts", "event_id"])


@register("vote_upsert", G, sql="""
WITH v AS (SELECT json_extract_string(props, '$.k') AS message_id, CAST(floor(value) AS BIGINT) % 4 - 1 AS s, ts, event_id FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY ts DESC, event_id DESC) AS rn FROM v WHERE s IN (-1, 0, 1))
SELECT message_id, CAST(nullif(s, 0) AS INTEGER) AS score FROM r WHERE rn = 1
""")
def q_vote_upsert(spark, d):
    ev = t(spark, d, "events").select(F.get_json_object("props", "$.k").alias("message_id"),
                                      (F.pmod(F.floor("value"), F.lit(4)) - 1).alias("s"), "ts", "event_id")
    return cs.latest_votes(ev, "message_id", "s", ["ts", "event_id"])


@register("mean_std_by_model", G, sql="""
SELECT lang AS model_id, round(avg(toxic), 6) AS mean_toxicity, round(stddev_pop(toxic), 6) AS std_toxicity, count(*) AS n
FROM labels JOIN documents USING (doc_id) GROUP BY lang
""")
def q_mean_std_by_model(spark, d):
    lab = t(spark, d, "labels")
    docs = t(spark, d, "documents").select("doc_id", "lang")
    return (lab.join(docs, "doc_id").groupBy(F.col("lang").alias("model_id"))
            .agg(r6(F.avg("toxic")).alias("mean_toxicity"), r6(F.stddev_pop("toxic")).alias("std_toxicity"),
                 F.count(F.lit(1)).alias("n")))


@register("batch_reward_stats", G, sql="""
SELECT strftime(ts, '%Y-%m-%d') AS epoch, round(avg(value), 6) AS reward_mean, round(stddev_pop(value), 6) AS reward_std, count(*) AS n
FROM events GROUP BY 1
""")
def q_batch_reward_stats(spark, d):
    ev = t(spark, d, "events")
    return (ev.groupBy(day("ts").alias("epoch"))
            .agg(r6(F.avg("value")).alias("reward_mean"), r6(F.stddev_pop("value")).alias("reward_std"),
                 F.count(F.lit(1)).alias("n")))


@register("mean_loss_perplexity", G, sql="""
WITH shard AS (SELECT event_type, user_id, avg(value / 100) AS loss, count(*) AS n FROM events GROUP BY ALL)
SELECT event_type, round(sum(loss * n) / sum(n), 6) AS mean_loss,
       round(coalesce(exp(sum(loss * n) / sum(n)), -1), 6) AS perplexity FROM shard GROUP BY event_type
""")
def q_mean_loss_perplexity(spark, d):
    ev = t(spark, d, "events")
    shards = ev.groupBy("event_type", "user_id").agg(F.avg(F.col("value") / 100).alias("loss"), F.count(F.lit(1)).alias("n"))
    return (shards.groupBy("event_type")
            .agg((F.sum(F.col("loss") * F.col("n")) / F.sum("n")).alias("m"))
            .select("event_type", r6("m").alias("mean_loss"), r6(F.coalesce(F.exp("m"), F.lit(-1.0))).alias("perplexity")))


@register("revenue_totals", G, sql=f"""
WITH {SALES}
SELECT 'total' AS level, NULL::BIGINT AS product_id, NULL::VARCHAR AS month, CAST(sum(revenue) AS DOUBLE) AS revenue FROM sales
UNION ALL SELECT 'product', product_id, NULL, CAST(sum(revenue) AS DOUBLE) FROM sales GROUP BY product_id
UNION ALL SELECT 'month', NULL, strftime(date, '%Y-%m'), CAST(sum(revenue) AS DOUBLE) FROM sales GROUP BY 3
""")
def q_revenue_totals(spark, d):
    return revenue_totals(sales(t(spark, d, "lineitem"), t(spark, d, "part")))


@register("revenue_extremes", G, sql=f"""
WITH {SALES},
p AS (SELECT product_id, CAST(sum(revenue) AS DOUBLE) AS rev FROM sales GROUP BY 1),
d AS (SELECT date, CAST(sum(revenue) AS DOUBLE) AS rev FROM sales GROUP BY 1)
SELECT (SELECT product_id FROM p ORDER BY rev DESC, product_id LIMIT 1) AS best_product,
       (SELECT round(max(rev), 6) FROM p) AS best_product_revenue,
       (SELECT strftime(date, '%Y-%m-%d') FROM d ORDER BY rev DESC, date LIMIT 1) AS best_date,
       (SELECT round(max(rev), 6) FROM d) AS best_date_revenue
""")
def q_revenue_extremes(spark, d):
    return revenue_extremes(sales(t(spark, d, "lineitem"), t(spark, d, "part")))


PERCENTILES = (25, 50, 75, 90)
_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("feature_distribution", G, sql="\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, count({c}) AS n, round(min({c}), 6) AS min, round(max({c}), 6) AS max, "
    f"round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
    + ", ".join(f"(SELECT round({c}, 6) FROM (SELECT {c}, row_number() OVER (ORDER BY {c}) - 1 AS i, count(*) OVER () AS n FROM lineitem "
                f"WHERE {c} IS NOT NULL) WHERE i = (n - 1) * {p} // 100) AS p{p}" for p in PERCENTILES)
    + " FROM lineitem" for c in _NUM))
def q_feature_distribution(spark, d):
    li = t(spark, d, "lineitem").select(*_NUM)
    long = li.unpivot([], _NUM, "feature", "v").filter("v IS NOT NULL")
    stats = (long.groupBy("feature")
             .agg(F.count("v").alias("n"), r6(F.min("v")).alias("min"), r6(F.max("v")).alias("max"),
                  r6(F.avg("v")).alias("mean"), r6(F.stddev_samp("v")).alias("std")))
    # exact percentiles: the rows at those places of a range-partitioned index (equal values may stand for one another)
    placed = with_index(long, ["v"], "i", within=["feature"]).join(stats.select("feature", "n"), "feature")
    at = [F.floor((F.col("n") - 1) * p / 100) for p in PERCENTILES]
    ranks = placed.filter(reduce(lambda a, b: a | b, [F.col("i") == x for x in at]))
    found = ranks.groupBy("feature").agg(*[r6(F.max(F.when(F.col("i") == x, F.col("v")))).alias(f"p{p}") for p, x in zip(PERCENTILES, at)])
    return stats.join(found, "feature")
