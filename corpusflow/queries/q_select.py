"""Group C: projections, filters, samples and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions.text import contains_any, seeded_unit, tokens
from corpusflow.operators import select as S
from corpusflow.queries.common import r6, t
from corpusflow.queries.registry import register
from corpusflow.queries.sqlparts import CHAT, PAIRS, QA
from corpusflow.queries.sqlparts_text import tokens as sql_tokens, unit
from corpusflow.sources.derived import chat_log, preference_pairs, qa_pairs

G = "C"
KEYWORDS = ["License", "license", "password", "@"]
BLOCKED = ["ads-track.example.org"]
LABEL_NAMES = [f"class_{i}" for i in range(10)]


@register("select_rename_drop", G, sql="SELECT doc_id AS id, text AS dialogue, lang AS topic FROM documents")
def q_select(spark, d):
    return (t(spark, d, "documents").drop("n_chars", "source")
            .withColumnsRenamed({"doc_id": "id", "text": "dialogue", "lang": "topic"}))


@register("filter_by_label", G, sql="SELECT doc_id, quality FROM labels WHERE toxic = 1")
def q_filter_label(spark, d):
    return S.filter_label(t(spark, d, "labels"), "toxic", 1).select("doc_id", "quality")


@register("filter_text_length", G, sql="SELECT doc_id, length(text) AS n FROM documents WHERE length(text) > 200 AND length(text) <= 1000")
def q_filter_len(spark, d):
    return S.filter_length(t(spark, d, "documents"), "text", 200, 1000).select("doc_id", F.length("text").cast("bigint").alias("n"))


@register("filter_token_length", G, sql=f"""
SELECT doc_id, len({sql_tokens('text')}) AS n_tokens FROM documents WHERE len({sql_tokens('text')}) < 512
""")
def q_filter_tokens(spark, d):
    docs = t(spark, d, "documents").select("doc_id", tokens("text").alias("ids"))
    return S.filter_tokens(docs, ["ids"], 512).select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"))


@register("filter_pair_chars", G, sql=f"""
WITH {PAIRS}
SELECT conv_id FROM pairs WHERE length(question) + length(response_j) <= 2000 AND length(question) + length(response_k) <= 2000
""")
def q_filter_pair_chars(spark, d):
    p = preference_pairs(t(spark, d, "conversations"))
    return S.filter_pair_chars(p, 2000, "question", "response_j", "response_k").select("conv_id")


@register("filter_nonempty_pair", G, sql=f"""
WITH {QA}
SELECT conv_id, turn FROM qa WHERE coalesce(length(question), 0) > 0 AND coalesce(length(answer), 0) > 0
""")
def q_filter_nonempty(spark, d):
    return S.filter_nonempty(qa_pairs(t(spark, d, "conversations")), ["question", "answer"]).select("conv_id", "turn")


_KW_SQL = " OR ".join(f"contains(text, '{k}')" for k in KEYWORDS)


@register("filter_keywords", G, sql=f"SELECT doc_id FROM documents WHERE {_KW_SQL}")
def q_filter_keywords(spark, d):
    return S.filter_keywords(t(spark, d, "documents"), "text", KEYWORDS).select("doc_id")


@register("keyword_retention_rate", G, sql=f"""
SELECT count(*) AS total, CAST(sum(CASE WHEN {_KW_SQL} THEN 1 ELSE 0 END) AS BIGINT) AS kept,
       round(avg(CASE WHEN {_KW_SQL} THEN 1.0 ELSE 0.0 END), 6) AS retention FROM documents
""")
def q_retention(spark, d):
    r = S.keyword_retention(t(spark, d, "documents"), contains_any("text", KEYWORDS))
    return r.select("total", "kept", r6("retention").alias("retention"))


@register("filter_nested_score", G, sql="SELECT doc_id FROM labels WHERE toxic > 0.3")
def q_nested_score(spark, d):
    lab = t(spark, d, "labels").select("doc_id", F.struct("quality", F.col("toxic").alias("toxicity")).alias("prompt"))
    return S.filter_score(lab, "prompt.toxicity", 0.3).select("doc_id")


_LANG_SQL = "regexp_extract(url, '/([a-z][a-z])/', 1)"


@register("filter_domain_blocklist", G, sql=f"""
SELECT page_id, query FROM (
  SELECT page_id, {_LANG_SQL} AS query, row_number() OVER (PARTITION BY {_LANG_SQL} ORDER BY page_id) AS rn
  FROM pages WHERE NOT contains(url, '{BLOCKED[0]}')) WHERE rn <= 10
""")
def q_domains(spark, d):
    p = t(spark, d, "pages").select("page_id", "url", F.regexp_extract("url", "/([a-z][a-z])/", 1).alias("query"))
    return S.filter_domains(p, "url", BLOCKED, "query", ["page_id"], 10).select("page_id", "query")


@register("filter_valid_url", G, sql="""
SELECT page_id, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:@]+)', 1) AS hostname FROM pages
WHERE regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:@]+)', 1) <> ''
""")
def q_valid_url(spark, d):
    return S.with_hostname(t(spark, d, "pages"), "url").select("page_id", "hostname")


@register("owner_predicate", G, sql=f"""
WITH {CHAT}
SELECT message_id, 'user' AS caller FROM chat WHERE user_id = 7
UNION ALL SELECT message_id, 'session' FROM chat WHERE session_id = '42' AND user_id IS NULL
""")
def q_owner(spark, d):
    chat = chat_log(t(spark, d, "events"))
    u = S.visible_to(chat, user=7).select("message_id", F.lit("user").alias("caller"))
    s = S.visible_to(chat, session="42").select("message_id", F.lit("session").alias("caller"))
    return u.unionByName(s)


@register("head_n", G, sql="SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 25")
def q_head(spark, d):
    return S.head_n(t(spark, d, "documents"), ["doc_id"], 25).select("doc_id", "lang")


@register("every_nth", G, sql="""
SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i FROM documents)
WHERE i % 7 = 0
""")
def q_every_nth(spark, d):
    return S.every_nth(t(spark, d, "documents").select("doc_id", "lang"), ["doc_id"], 7, within=["lang"])


@register("shuffle_sample", G, sql="SELECT doc_id FROM documents ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 20")
def q_shuffle_sample(spark, d):
    return S.shuffle_take(t(spark, d, "documents"), "doc_id", 20, 42).select("doc_id")


@register("slice_split", G, sql="""
SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents)
WHERE i >= round(n * 0.05) AND i < round(n * 0.2)
""")
def q_slice(spark, d):
    return S.slice_rows(t(spark, d, "documents").select("doc_id"), ["doc_id"], 0.05, 0.2, pct=True)


@register("carve_missing_validation", G, sql="""
SELECT doc_id, CASE WHEN i < round(n * 0.05) THEN 'validation' ELSE 'train' END AS split
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents)
""")
def q_carve(spark, d):
    return S.ensure_validation(t(spark, d, "documents").select("doc_id"), ["doc_id"], 0.05)


@register("train_test_split", G, sql=f"""
SELECT doc_id, CASE WHEN {unit(42, 'doc_id')} < 0.2 THEN 'test' ELSE 'train' END AS split FROM documents
""")
def q_tts(spark, d):
    return S.train_test_split(t(spark, d, "documents").select("doc_id"), "doc_id", 0.2, 42)


@register("ordered_split", G, sql="""
SELECT doc_id, CASE WHEN i < n - ceil(n * 0.2) THEN 'train' ELSE 'test' END AS split
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents)
""")
def q_ordered_split(spark, d):
    return S.ordered_split(t(spark, d, "documents").select("doc_id"), ["doc_id"], 0.2)


@register("train_val_test_split", G, sql=f"""
SELECT doc_id, CASE WHEN {unit(7, 'doc_id')} < 0.9 THEN 'train' WHEN {unit(7, 'doc_id')} < 0.95 THEN 'validation' ELSE 'test' END AS split
FROM documents
""")
def q_three_way(spark, d):
    return S.three_way_split(t(spark, d, "documents").select("doc_id"), "doc_id", 0.90, 0.05, 0.05, 7)


@register("label_id_to_text", G, sql="SELECT vec_id, label, 'class ' || CAST(label AS VARCHAR) AS label_text FROM embeddings")
def q_label_text(spark, d):
    return S.label_text(t(spark, d, "embeddings").select("vec_id", "label"), "label", LABEL_NAMES)


@register("range_bucket_label", G, sql="""
SELECT user_id, n, CASE WHEN n BETWEEN 0 AND 1 THEN '1' WHEN n BETWEEN 2 AND 9 THEN '1-10' WHEN n BETWEEN 10 AND 49 THEN '10+'
  WHEN n BETWEEN 50 AND 99 THEN '50+' WHEN n BETWEEN 100 AND 299 THEN '100+' WHEN n BETWEEN 300 AND 499 THEN '300+'
  WHEN n BETWEEN 500 AND 999 THEN '500+' WHEN n BETWEEN 1000 AND 2999 THEN '1k+' WHEN n BETWEEN 3000 AND 4999 THEN '3k+'
  WHEN n BETWEEN 5000 AND 9999 THEN '5k+' WHEN n >= 10000 THEN '10k+' ELSE '' END AS label
FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)
""")
def q_bucket(spark, d):
    c = t(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("label", S.bucket_label("n"))
