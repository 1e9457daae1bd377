"""Groups K, L, M: windows, sort / limit / paging, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.operators import windows as W
from corpusflow.operators.select import three_way_split
from corpusflow.operators.text import extract_links
from corpusflow.plans.dense_index import total_rows, with_index
from corpusflow.queries.common import day, r6, t
from corpusflow.queries.registry import register

B, M_MIN = 16, 16


@register("last_k_turns", "K", sql="""
SELECT conv_id, turn FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations) WHERE rn <= 4
""")
def q_last_k(spark, d):
    return W.last_k_turns(t(spark, d, "conversations"), "conv_id", "turn", 2).select("conv_id", "turn")


@register("previous_user_questions", "K", sql="""
SELECT conv_id, turn, coalesce(array_to_string(list(text) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ' | '), '') AS previous,
       coalesce(len(list(text) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 0) AS n_previous
FROM conversations WHERE role = 'user'
""")
def q_prev_questions(spark, d):
    u = t(spark, d, "conversations").filter(F.col("role") == "user")
    p = W.previous_rows(u, "conv_id", "turn", "text")
    return p.select("conv_id", "turn", F.array_join("previous", " | ").alias("previous"), F.size("previous").cast("bigint").alias("n_previous"))


@register("last_user_message", "K", sql="""
SELECT c.conv_id, coalesce(u.text, '') AS text FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN (SELECT conv_id, arg_max(text, turn) AS text FROM conversations WHERE role = 'user' GROUP BY conv_id) u USING (conv_id)
""")
def q_last_user(spark, d):
    c = t(spark, d, "conversations")
    last = c.filter(F.col("role") == "user").groupBy("conv_id").agg(F.max_by("text", "turn").alias("text"))
    return c.select("conv_id").distinct().join(last, "conv_id", "left").select("conv_id", F.coalesce("text", F.lit("")).alias("text"))


def _rewards(spark, d):
    return t(spark, d, "events").select(F.col("event_type").alias("prompt"), day("ts").alias("epoch"), "event_id", F.col("value").alias("reward"))


@register("per_prompt_advantage", "K", sql=f"""
WITH r AS (SELECT event_type AS prompt, strftime(ts, '%Y-%m-%d') AS epoch, event_id, value AS reward FROM events),
tail AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY prompt, epoch ORDER BY event_id DESC) AS rk FROM r) WHERE rk <= {B}),
roll AS (SELECT prompt, epoch, rk, avg(reward) OVER w AS m, stddev_pop(reward) OVER w AS s, count(*) OVER w AS n FROM tail
         WINDOW w AS (PARTITION BY prompt ORDER BY epoch, event_id ROWS BETWEEN {B - 1} PRECEDING AND CURRENT ROW)),
batch AS (SELECT epoch, avg(reward) AS bm, stddev_pop(reward) AS bs FROM r GROUP BY epoch),
st AS (SELECT prompt, epoch, CASE WHEN n < {M_MIN} THEN bm ELSE m END AS mean, CASE WHEN n < {M_MIN} THEN bs ELSE s END AS std
       FROM roll JOIN batch USING (epoch) WHERE rk = 1)
SELECT event_id, prompt, epoch, round((reward - mean) / (std + 1e-6), 6) AS advantage FROM r JOIN st USING (prompt, epoch)
""")
def q_prompt_adv(spark, d):
    a = W.per_prompt_advantages(_rewards(spark, d), "prompt", "epoch", "event_id", "reward", B, M_MIN)
    return a.select("event_id", "prompt", "epoch", r6("advantage").alias("advantage"))


@register("global_advantage", "K", sql="""
WITH r AS (SELECT strftime(ts, '%Y-%m-%d') AS epoch, event_id, value AS reward FROM events),
s AS (SELECT epoch, avg(reward) AS m, stddev_pop(reward) AS sd FROM r GROUP BY epoch)
SELECT event_id, epoch, round((reward - m) / (sd + 1e-8), 6) AS advantage FROM r JOIN s USING (epoch)
""")
def q_global_adv(spark, d):
    a = W.global_advantages(_rewards(spark, d), "epoch", "reward")
    return a.select("event_id", "epoch", r6("advantage").alias("advantage"))


@register("per_prompt_stats", "K", sql=f"""
SELECT prompt, round(avg(reward), 6) AS mean, round(stddev_pop(reward), 6) AS std, count(*) AS count FROM
 (SELECT event_type AS prompt, value AS reward, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn <= {B} GROUP BY prompt
""")
def q_prompt_stats(spark, d):
    ev = t(spark, d, "events").select(F.col("event_type").alias("prompt"), "ts", "event_id", F.col("value").alias("reward"))
    s = W.prompt_stats(ev, "prompt", ["ts", "event_id"], "reward", B)
    return s.select("prompt", r6("mean").alias("mean"), r6("std").alias("std"), "count")


@register("linear_parent_child", "K", sql="""
WITH i AS (SELECT conv_id, turn, CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS id FROM conversations)
SELECT conv_id, id, coalesce(array_to_string(list(id) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ','), '') AS ancestors,
       coalesce(lead(id) OVER (PARTITION BY conv_id ORDER BY turn), '') AS children FROM i
""")
def q_tree_links(spark, d):
    c = t(spark, d, "conversations").withColumn("id", F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")))
    tr = W.to_tree(c, "conv_id", "turn", "id")
    return tr.select("conv_id", "id", F.array_join("ancestors", ",").alias("ancestors"), F.array_join("children", ",").alias("children"))


@register("dense_row_index", "K", sql="SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents")
def q_dense(spark, d):
    return with_index(t(spark, d, "documents").select("doc_id"), ["doc_id"], "idx")


# --- L: sort, limit, paging


@register("order_limit", "L", sql="SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders ORDER BY orders.o_orderdate DESC, o_orderkey DESC LIMIT 20")
def q_order_limit(spark, d):
    o = t(spark, d, "orders")
    return o.orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(20).select("o_orderkey", day("o_orderdate").alias("o_orderdate"))


@register("page", "L", sql="""
SELECT p_partkey, p_retailprice, (SELECT count(*) FROM part WHERE p_size > 10) AS total FROM part WHERE p_size > 10
ORDER BY p_retailprice DESC, p_partkey LIMIT 15 OFFSET 30
""")
def q_page(spark, d):
    p = t(spark, d, "part").filter(F.col("p_size") > 10)
    pg = p.orderBy(F.desc("p_retailprice"), "p_partkey").offset(2 * 15).limit(15).select("p_partkey", "p_retailprice")
    return pg.crossJoin(F.broadcast(total_rows(p, "total")))


@register("sort_by_diff", "L", sql="""
SELECT doc_id, quality - toxic AS diff, row_number() OVER (ORDER BY quality - toxic DESC, doc_id) - 1 AS rank FROM labels
""")
def q_sort_diff(spark, d):
    lab = t(spark, d, "labels").withColumn("diff", F.col("quality") - F.col("toxic"))
    return with_index(lab, [F.col("diff").desc(), F.col("doc_id")], "rank").select("doc_id", "diff", "rank")


@register("shuffle_rows", "L", sql="SELECT doc_id, md5('3|' || CAST(doc_id AS VARCHAR)) AS shuffle_key FROM documents")
def q_shuffle(spark, d):
    docs = t(spark, d, "documents").select("doc_id")
    key = F.md5(F.concat(F.lit("3|"), F.col("doc_id").cast("string")))
    # ranges of the seeded key, sorted inside: partitions in turn are the shuffled order, whatever their number
    return docs.withColumn("shuffle_key", key).repartitionByRange("shuffle_key", "doc_id").sortWithinPartitions("shuffle_key", "doc_id")


# --- M: set operations


@register("concat_datasets", "M", sql="""
SELECT 'documents' AS dataset, CAST(doc_id AS VARCHAR) AS id, lang, CAST(NULL AS VARCHAR) AS role, length(text) AS n_chars FROM documents
UNION ALL SELECT 'conversations', conv_id || '-' || turn, NULL, role, length(text) FROM conversations
UNION ALL SELECT 'pages', CAST(page_id AS VARCHAR), NULL, NULL, length(html) FROM pages
UNION ALL SELECT 'benchmark', CAST(item_id AS VARCHAR), NULL, NULL, length(text) FROM benchmark
""")
def q_concat(spark, d):
    sets = {"documents": t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), "text", "lang"),
            "conversations": t(spark, d, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("id"), "text", "role"),
            "pages": t(spark, d, "pages").select(F.col("page_id").cast("string").alias("id"), F.col("html").alias("text")),
            "benchmark": t(spark, d, "benchmark").select(F.col("item_id").cast("string").alias("id"), "text")}
    return W.concat_datasets(sets).select("dataset", "id", "lang", "role", F.length("text").cast("long").alias("n_chars"))


@register("union_branches", "M", sql="""
SELECT event_id, 'click' AS branch FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, 'purchase' FROM events WHERE event_type = 'purchase'
""")
def q_union(spark, d):
    ev = t(spark, d, "events")
    a = ev.filter(F.col("event_type") == "click").select("event_id", F.lit("click").alias("branch"))
    b = ev.filter(F.col("event_type") == "purchase").select("event_id", F.lit("purchase").alias("branch"))
    return a.unionByName(b)


@register("distinct_links", "M", sql="""
WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a\\b[^>]*\\bhref="([^"]*)"', 1)) AS href,
                  generate_subscripts(regexp_extract_all(html, '(?i)<a\\b[^>]*\\bhref="([^"]*)"', 1), 1) - 1 AS pos FROM pages),
l AS (SELECT page_id, split_part(substr(href, 2), '&sa=', 1) AS link, min(pos) AS first_pos
      FROM a WHERE starts_with(href, '/') AND NOT contains(href, 'google.com/') GROUP BY 1, 2)
SELECT link, arg_min(page_id, page_id * 100000 + first_pos) AS first_page, arg_min(first_pos, page_id * 100000 + first_pos) AS first_pos FROM l GROUP BY link
""")
def q_distinct_links(spark, d):
    l = extract_links(t(spark, d, "pages"), "html", "page_id", prefix="/")
    first = F.min(F.struct("page_id", "first_pos"))
    return l.groupBy("link").agg(first.alias("f")).select("link", F.col("f.page_id").alias("first_page"), F.col("f.first_pos").alias("first_pos"))


@register("set_add_remove", "M", sql="""
WITH r AS (SELECT conv_id, list(DISTINCT role) AS roles FROM conversations GROUP BY conv_id)
SELECT conv_id, array_to_string(list_sort(list_distinct(list_concat(roles, ['tool']))), ',') AS added,
       array_to_string(list_sort(list_filter(roles, lambda x: x <> 'system')), ',') AS removed FROM r
""")
def q_set_ops(spark, d):
    r = t(spark, d, "conversations").groupBy("conv_id").agg(F.collect_set("role").alias("roles"))
    return r.select("conv_id", F.array_join(F.array_sort(F.array_union("roles", F.array(F.lit("tool")))), ",").alias("added"),
                    F.array_join(F.array_sort(F.array_except("roles", F.array(F.lit("system")))), ",").alias("removed"))


@register("split_disjointness", "M", sql="""
WITH s AS (SELECT doc_id, CASE WHEN u < 0.9 THEN 'train' WHEN u < 0.95 THEN 'validation' ELSE 'test' END AS split
           FROM (SELECT doc_id, CAST(('0x' || substr(md5('7|' || CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0 AS u FROM documents))
SELECT 'train/validation' AS pair, (SELECT count(*) FROM (SELECT doc_id FROM s WHERE split = 'train' INTERSECT SELECT doc_id FROM s WHERE split = 'validation')) AS overlap,
       (SELECT count(*) FROM documents) - (SELECT count(*) FROM s) AS missing
UNION ALL SELECT 'train/test', (SELECT count(*) FROM (SELECT doc_id FROM s WHERE split = 'train' INTERSECT SELECT doc_id FROM s WHERE split = 'test')), 0
UNION ALL SELECT 'validation/test', (SELECT count(*) FROM (SELECT doc_id FROM s WHERE split = 'validation' INTERSECT SELECT doc_id FROM s WHERE split = 'test')), 0
""")
def q_disjoint(spark, d):
    docs = t(spark, d, "documents").select("doc_id")
    s = three_way_split(docs, "doc_id", 0.90, 0.05, 0.05, 7)
    part = lambda n: s.filter(F.col("split") == n).select("doc_id")
    rows = []
    for a, b in (("train", "validation"), ("train", "test"), ("validation", "test")):
        ov = part(a).intersect(part(b)).agg(F.count(F.lit(1)).alias("overlap"))
        rows.append(ov.select(F.lit(f"{a}/{b}").alias("pair"), "overlap"))
    out = rows[0].unionByName(rows[1]).unionByName(rows[2])
    # completeness: every input row lands in exactly one split (exceptAll both ways)
    missing = docs.exceptAll(s.select("doc_id")).agg(F.count(F.lit(1)).alias("missing"))
    return out.crossJoin(missing).withColumn("missing", F.when(F.col("pair") == "train/validation", F.col("missing")).otherwise(F.lit(0)).cast("bigint"))
