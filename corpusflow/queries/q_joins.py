"""Group I: joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.operators import joins as J
from corpusflow.queries.common import r6, t, ts_str
from corpusflow.queries.registry import register
from corpusflow.queries.sqlparts import CHAT, SETTINGS
from corpusflow.sources.derived import chat_log, settings

G = "I"


@register("lookup_consented_anonymous", G, sql=f"""
WITH {CHAT}, {SETTINGS}
SELECT c.session_id, c.message_id, strftime(c.created_at, '%Y-%m-%d %H:%M:%S') AS created_at
FROM chat c JOIN settings s ON c.session_id = s.session_id
WHERE s.consent AND s.user_id IS NULL AND c.model = 'click' AND c.user_id IS NULL
""")
def q_consented_anon(spark, d):
    r = J.consented_anonymous(settings(t(spark, d, "customer")), chat_log(t(spark, d, "events")), "click")
    return r.select("session_id", "message_id", ts_str("created_at").alias("created_at"))


@register("lookup_consented_users", G, sql=f"""
WITH {CHAT}, {SETTINGS}
SELECT CAST(c.user_id AS VARCHAR) AS owner, c.message_id, 'user' AS branch
FROM chat c WHERE c.model = 'click' AND c.user_id IN (SELECT user_id FROM settings WHERE consent AND user_id IS NOT NULL)
UNION ALL
SELECT c.session_id, c.message_id, 'session'
FROM chat c JOIN settings s ON c.session_id = s.session_id
WHERE s.consent AND s.user_id IS NULL AND c.model = 'click' AND c.user_id IS NULL
""")
def q_consented_users(spark, d):
    return J.consented_users(settings(t(spark, d, "customer")), chat_log(t(spark, d, "events")), "click")


@register("semi_join_ids", G, sql="""
SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '2001-06-01 00:00:00')
""")
def q_semi_join(spark, d):
    ids = t(spark, d, "lineitem").filter((F.col("l_returnflag") == "R") & (F.col("l_shipdate") >= F.lit("2001-06-01").cast("timestamp_ntz")))
    return J.semi_join_ids(t(spark, d, "part").select("p_partkey", "p_name"), ids, "p_partkey", "l_partkey")


@register("left_lookup_attribute", G, sql="""
SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey
""")
def q_left_lookup(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey")
    return J.left_lookup(o, t(spark, d, "customer"), "o_custkey", "c_custkey", ["c_name", "c_mktsegment"]).drop("o_custkey")


@register("anti_join_existing", G, sql="""
SELECT DISTINCT user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-03 00:00:00'
EXCEPT
SELECT user_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-03 00:00:00'
""")
def q_anti_join(spark, d):
    ev = t(spark, d, "events").select("user_id", "event_type", "ts")
    cut = F.lit("2024-01-03 00:00:00").cast("timestamp_ntz")
    return J.insert_new(ev.filter(F.col("ts") < cut), ev.filter(F.col("ts") >= cut).select("user_id", "event_type"),
                        ["user_id", "event_type"])


@register("migrate_owner", G, sql=f"""
WITH {CHAT}, {SETTINGS},
logins AS (SELECT session_id, user_id FROM settings WHERE user_id IS NOT NULL)
SELECT c.message_id, coalesce(c.user_id, l.user_id) AS user_id,
       CASE WHEN l.user_id IS NOT NULL THEN NULL ELSE c.session_id END AS session_id
FROM chat c LEFT JOIN logins l ON c.session_id = l.session_id AND c.user_id IS NULL
""")
def q_migrate_owner(spark, d):
    chat = chat_log(t(spark, d, "events")).select("message_id", "user_id", "session_id")
    logins = settings(t(spark, d, "customer")).filter(F.col("user_id").isNotNull()).select("session_id", "user_id")
    return J.migrate_owner(chat, logins)


@register("cascade_remove", G, sql="""
WITH ids AS (SELECT conv_id, turn, role, conv_id || '-' || turn AS mid FROM conversations)
SELECT conv_id, coalesce(string_agg(mid, ',' ORDER BY turn) FILTER (WHERE role <> 'system'), '') AS message_ids
FROM ids GROUP BY conv_id
""")
def q_cascade_remove(spark, d):
    conv = t(spark, d, "conversations").withColumn("mid", F.concat_ws("-", "conv_id", "turn"))
    holders = conv.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "mid"))), lambda x: x["mid"]).alias("ids"))
    removed = conv.filter(F.col("role") == "system").select("mid")
    _, stripped = J.remove_everywhere(conv.select("mid"), holders, removed, "mid", "ids")
    return stripped.select("conv_id", F.array_join("ids", ",").alias("message_ids"))


@register("self_join_pairs", G, sql="""
WITH a AS (SELECT conv_id, turn, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS nxt FROM conversations WHERE role = 'assistant')
SELECT conv_id, turn AS chosen_turn, nxt AS rejected_turn FROM a WHERE nxt IS NOT NULL
""")
def q_self_join_pairs(spark, d):
    # consecutive ranks only (n - 1 pairs per prompt): the order is the same, no quadratic expansion
    a = t(spark, d, "conversations").filter(F.col("role") == "assistant").select("conv_id", "turn")
    p = J.adjacent_pairs(a, "conv_id", "turn", [])
    return p.select("conv_id", F.col("pos_a").alias("chosen_turn"), F.col("pos_b").alias("rejected_turn"))


@register("cross_join_product", G, sql="""
WITH q AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 20 = 0),
c AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT q.vec_id AS query_id, list_dot_product(q.v, c.v) AS dot FROM q, c)
SELECT query_id, count(*) FILTER (WHERE dot > 0) AS n_positive, round(max(dot), 5) AS max_dot FROM s GROUP BY query_id
""")
def q_cross_join(spark, d):
    # the product is scored in blocks and reduced inside each task: no pair list is materialised
    from corpusflow.operators.retrieval import product_summary

    e = t(spark, d, "embeddings")
    q = e.filter(F.col("vec_id") % 20 == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("qv"))
    c = e.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("cv"))
    return product_summary(q, c).withColumn("max_dot", F.round("max_dot", 5))


@register("multi_table_join", G, sql="""
SELECT c_name AS patient, s_name AS doctor, p_name AS medication, strftime(o_orderdate, '%Y-%m-%d') AS date, l_quantity AS quantity
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
""")
def q_multi_join(spark, d):
    c, o, l, p, s = (t(spark, d, n) for n in ("customer", "orders", "lineitem", "part", "supplier"))
    j = (l.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
         .join(o.select("o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
         .join(c.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
         .join(p.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
         .join(s.select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey")))
    return j.select(F.col("c_name").alias("patient"), F.col("s_name").alias("doctor"), F.col("p_name").alias("medication"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("l_quantity").alias("quantity"))
