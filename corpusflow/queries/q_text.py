"""Group E: text cleaning and scalar extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions.text import word_count
from corpusflow.operators import text as X
from corpusflow.plans.dense_index import with_index
from corpusflow.queries.common import r6, t
from corpusflow.queries.registry import register
from corpusflow.queries.sqlparts import lit
from corpusflow.queries.sqlparts_text import words as sql_words

G = "E"


def _decode_sql(x):
    for a, b in X.ENTITIES:
        x = f"replace({x}, '{a}', {lit(b)})"
    return x


PARAS_SQL = f"""c AS (SELECT page_id, url, regexp_replace(html, '{X.DROP_BLOCKS}', '', 'g') AS h FROM pages),
p AS (SELECT page_id, url, list_transform(regexp_extract_all(h, '(?is)<p\\b[^>]*>(.*?)</p>', 1),
        lambda x: {_decode_sql("regexp_replace(x, '<[^>]*>', '', 'g')")}) AS ps FROM c)"""


_PS_SQL = f"""list_transform(regexp_extract_all(regexp_replace(html, '{X.DROP_BLOCKS}', '', 'g'), '(?is)<p\\b[^>]*>(.*?)</p>', 1),
        lambda x: {_decode_sql("regexp_replace(x, '<[^>]*>', '', 'g')")})"""
#: SQL over a column html: last first-level heading, last title, paragraph text (null without one)
H1_SQL = "coalesce(regexp_extract_all(html, '(?is)<h1\\b[^>]*>(.*?)</h1>', 1)[-1], '')"
TITLE_SQL = "regexp_extract_all(html, '(?is)<title\\b[^>]*>(.*?)</title>', 1)[-1]"
PARAGRAPHS_SQL = f"CASE WHEN len({_PS_SQL}) > 0 THEN regexp_replace(array_to_string({_PS_SQL}, ' '), ' {{2}}|\\r\\n|\\n|\\r', '', 'g') END"


@register("extract_paragraph_text", G, sql=f"""
WITH {PARAS_SQL}
SELECT page_id, CASE WHEN len(ps) > 0 THEN regexp_replace(array_to_string(ps, ' '), ' {{2}}|\\r\\n|\\n|\\r', '', 'g') END AS text,
       len(ps) = 0 AS error FROM p
""")
def q_paragraphs(spark, d):
    p = t(spark, d, "pages")
    return p.select("page_id", X.html_paragraphs("html").alias("text"), (F.size(X.paragraph_texts("html")) == 0).alias("error"))


@register("extract_links", G, sql="""
WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a\\b[^>]*\\bhref="([^"]*)"', 1)) AS href,
                  generate_subscripts(regexp_extract_all(html, '(?i)<a\\b[^>]*\\bhref="([^"]*)"', 1), 1) - 1 AS pos FROM pages)
SELECT page_id, split_part(substr(href, 2), '&sa=', 1) AS link, min(pos) AS first_pos
FROM a WHERE starts_with(href, '/') AND NOT contains(href, 'google.com/') GROUP BY 1, 2
""")
def q_links(spark, d):
    return X.extract_links(t(spark, d, "pages"), "html", "page_id", prefix="/")


@register("extract_by_tag", G, sql="""
SELECT page_id, regexp_extract_all(html, '(?is)<h1\\b[^>]*>(.*?)</h1>', 1)[-1] AS h1,
       array_to_string(regexp_extract_all(html, '(?is)<title\\b[^>]*>(.*?)</title>', 1), '|') AS titles FROM pages
""")
def q_tag(spark, d):
    p = t(spark, d, "pages")
    return p.select("page_id", X.extract_tag("html", "h1").alias("h1"), F.array_join(X.extract_tag("html", "title", all_=True), "|").alias("titles"))


def _answer_spark():
    return F.concat(F.lit("Doc: "), (F.col("label") + 1).cast("string"), F.lit(", Relevance: "), F.pmod("vec_id", F.lit(10)).cast("string"),
                    F.lit("\nDoc: "), (F.col("label") + 5).cast("string"), F.lit(", Relevance: 7, extra"),
                    F.lit("\nDoc: "), F.pmod("vec_id", F.lit(13)).cast("string"), F.lit(", Relevance: high"), F.lit("\nno comma here"))
_ANSWER_SQL = ("'Doc: ' || CAST(label + 1 AS VARCHAR) || ', Relevance: ' || CAST(vec_id % 10 AS VARCHAR) || chr(10) || 'Doc: ' || CAST(label + 5 AS VARCHAR) "
               "|| ', Relevance: 7, extra' || chr(10) || 'Doc: ' || CAST(vec_id % 13 AS VARCHAR) || ', Relevance: high' || chr(10) || 'no comma here'")


@register("parse_choice_select", G, sql=f"""
WITH a AS (SELECT vec_id, unnest(string_split({_ANSWER_SQL}, chr(10))) AS line,
                  generate_subscripts(string_split({_ANSWER_SQL}, chr(10)), 1) - 1 AS line_no FROM embeddings),
b AS (SELECT vec_id, line_no, string_split(line, ',') AS parts FROM a WHERE len(string_split(line, ',')) = 2)
SELECT vec_id, line_no, TRY_CAST(trim(string_split(parts[1], ':')[-1]) AS INTEGER) AS doc,
       TRY_CAST(trim(string_split(parts[2], ':')[-1]) AS DOUBLE) AS relevance
FROM b WHERE TRY_CAST(trim(string_split(parts[1], ':')[-1]) AS INTEGER) <= 10
""")
def q_choices(spark, d):
    e = t(spark, d, "embeddings").select("vec_id", _answer_spark().alias("answer"))
    return X.parse_choices(e, "answer", 10, "vec_id")


@register("parse_guard_verdict", G, sql="""
WITH v AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'unsafe' || chr(10) || 'O' || CAST(quality + 1 AS VARCHAR) || ',O6' ELSE 'safe' END AS answer FROM labels)
SELECT doc_id, trim(string_split(answer, chr(10))[1]) AS verdict,
       trim(unnest(CASE WHEN len(string_split(answer, chr(10))) > 1 THEN string_split(string_split(answer, chr(10))[2], ',') ELSE [NULL] END)) AS category
FROM v
""")
def q_verdict(spark, d):
    lab = t(spark, d, "labels")
    ans = F.when(F.col("toxic") == 1, F.concat(F.lit("unsafe\nO"), (F.col("quality") + 1).cast("string"), F.lit(",O6"))).otherwise(F.lit("safe"))
    return X.parse_verdict(lab.select("doc_id", ans.alias("answer")), "answer", "doc_id")


@register("strip_prompt_echo", G, sql="SELECT doc_id, replace(text, substr(text, 1, 40), '') AS generated FROM documents")
def q_echo(spark, d):
    return t(spark, d, "documents").select("doc_id", X.strip_echo("text", F.substring("text", 1, 40)).alias("generated"))


@register("truncate_chars", G, sql="SELECT doc_id, substr(text, 1, 2000) AS text FROM documents")
def q_trunc(spark, d):
    return t(spark, d, "documents").select("doc_id", F.substring("text", 1, 2000).alias("text"))


@register("title_fallback", G, sql="""
SELECT conv_id, array_to_string(string_split_regex(arg_min(text, turn), '\\s+')[1:5], ' ') AS title
FROM conversations WHERE role = 'user' GROUP BY conv_id
""")
def q_title(spark, d):
    first = t(spark, d, "conversations").filter(F.col("role") == "user").groupBy("conv_id").agg(F.min_by("text", "turn").alias("m"))
    return first.select("conv_id", X.fallback_title("m").alias("title"))


@register("title_marker", G, sql=f"""
WITH f AS (SELECT conv_id, array_to_string(string_split_regex(arg_min(text, turn), '\\s+')[1:5], ' ') AS title
           FROM conversations WHERE role = 'user' GROUP BY conv_id)
SELECT conv_id, CASE WHEN regexp_matches(substr(title, 1, 3), '{X.EMOJI_CLASS}') THEN title ELSE {lit(X.TITLE_MARK)} || title END AS title FROM f
""")
def q_marker(spark, d):
    first = t(spark, d, "conversations").filter(F.col("role") == "user").groupBy("conv_id").agg(F.min_by("text", "turn").alias("m"))
    return first.select("conv_id", X.mark_title(X.fallback_title("m")).alias("title"))


@register("content_hash", G, sql="SELECT doc_id, sha256(text) AS sha, CAST(doc_id AS VARCHAR) || '-' || sha256(text) AS file_key FROM documents")
def q_hash(spark, d):
    docs = t(spark, d, "documents")
    h = F.sha2("text", 256)
    return docs.select("doc_id", h.alias("sha"), F.concat_ws("-", F.col("doc_id").cast("string"), h).alias("file_key"))


@register("word_count_by_file", G, sql=f"""
SELECT source, CAST(sum(len({sql_words('text')})) AS BIGINT) AS words FROM documents GROUP BY ROLLUP (source)
""")
def q_words(spark, d):
    return X.word_counts(t(spark, d, "documents"), "text", "source")


@register("avg_document_length", G, sql="""
SELECT 'documents' AS stage, count(*) AS n, CAST(floor(sum(length(text)) / count(*)) AS BIGINT) AS avg_chars FROM documents
UNION ALL
SELECT 'chunks', count(*), CAST(floor(sum(length(c)) / count(*)) AS BIGINT) FROM
  (SELECT substr(text, s, 1000) AS c FROM documents, LATERAL (SELECT unnest(range(1, length(text) + 1, 1000)) AS s))
""")
def q_doc_stats(spark, d):
    docs = t(spark, d, "documents")
    from corpusflow.operators.chunking import chunk_fixed

    a = X.doc_stats(docs, "text").select(F.lit("documents").alias("stage"), "n", "avg_chars")
    b = X.doc_stats(chunk_fixed(docs, "text", 1000), "chunk").select(F.lit("chunks").alias("stage"), "n", "avg_chars")
    return a.unionByName(b)


_UUID = "concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), substr(h, 13, 4), substr(h, 17, 4), substr(h, 21, 12))"


@register("is_message_id", G, sql=f"""
WITH i AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN {_UUID} ELSE CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) END AS id
           FROM (SELECT *, md5(CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR)) AS h FROM conversations))
SELECT conv_id, turn, id, len(string_split(id, '-')) = 5 AS is_id FROM i
""")
def q_is_id(spark, d):
    c = t(spark, d, "conversations").withColumn("h", F.md5(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))))
    uuid = F.concat_ws("-", *[F.substring("h", a, b) for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    ids = c.select("conv_id", "turn", F.when(F.col("turn") % 2 == 0, uuid).otherwise(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))).alias("id"))
    return ids.withColumn("is_id", X.is_message_id("id"))


def _log_spark(v):
    d3 = lambda c: c.cast("decimal(18,3)").cast("string")
    return F.concat(F.lit('total_time="'), d3(v * 10), F.lit('ms" validation_time="'), d3(v * 7), F.lit('us" queue_time="'),
                    d3(v / 1000), F.lit('s" inference_time="'), d3(v * 9), F.lit('ms" time_per_token="'), d3(v / 7), F.lit('ms"'))


def _d3(x):
    return f"CAST(CAST({x} AS DECIMAL(18, 3)) AS VARCHAR)"


_LOG_SQL = (f"""'total_time="' || {_d3('value * 10')} || 'ms" validation_time="' || {_d3('value * 7')} || 'us" queue_time="' || {_d3('value / 1000')}"""
            f"""|| 's" inference_time="' || {_d3('value * 9')} || 'ms" time_per_token="' || {_d3('value / 7')} || 'ms"'""")


def _field_sql(f):
    num = f"""TRY_CAST(regexp_extract(line, '{f}="([0-9.]+)([a-zµ]+)"', 1) AS DOUBLE)"""
    unit = f"""regexp_extract(line, '{f}="([0-9.]+)([a-zµ]+)"', 2)"""
    return f"{num} * CASE {unit} WHEN 's' THEN 1000.0 WHEN 'ms' THEN 1.0 WHEN 'us' THEN 0.001 WHEN 'µs' THEN 0.001 END"


@register("parse_serving_log", G, sql=f"""
WITH l AS (SELECT event_id, {_LOG_SQL} AS line FROM events)
SELECT event_id, round({_field_sql('total_time')}, 6) AS total_time_ms,
       round({_field_sql('validation_time')} + {_field_sql('queue_time')} + {_field_sql('time_per_token')}, 6) AS ttft_ms FROM l
""")
def q_log(spark, d):
    ev = t(spark, d, "events").select("event_id", _log_spark(F.col("value")).alias("line"))
    p = X.parse_serving_log(ev, "line")
    return p.select("event_id", r6("total_time_ms").alias("total_time_ms"), r6("ttft_ms").alias("ttft_ms"))


@register("generation_cost", G, sql="""
SELECT event_type, round(CAST(sum(CAST(value AS DECIMAL(38, 6))) AS DOUBLE) * 1.21 / 3600000.0, 9) AS cost_usd FROM events GROUP BY 1
""")
def q_cost(spark, d):
    ev = t(spark, d, "events")
    ms = ev.groupBy("event_type").agg(F.sum(F.col("value").cast("decimal(38,6)")).cast("double").alias("ms"))
    return ms.select("event_type", F.round(X.generation_cost(F.col("ms"), 1.21), 9).alias("cost_usd"))


@register("flag_search_hits_by_text_len", G, sql=f"""
WITH {PARAS_SQL},
h AS (SELECT page_id, regexp_extract(url, '/([a-z][a-z])/', 1) AS query, length(coalesce(array_to_string(ps, chr(10)), '')) AS text_len FROM p)
SELECT page_id, query, text_len, row_number() OVER (PARTITION BY query ORDER BY text_len DESC, page_id) - 1 AS rank FROM h
""")
def q_hits(spark, d):
    p = t(spark, d, "pages").select("page_id", F.regexp_extract("url", "/([a-z][a-z])/", 1).alias("query"),
                                    F.length(F.coalesce(F.array_join(X.paragraph_texts("html"), "\n"), F.lit(""))).cast("bigint").alias("text_len"))
    # rank inside each query through the range-partitioned index: a hot query spans many tasks
    return with_index(p, [F.col("text_len").desc(), F.col("page_id")], "rank", within=["query"]).select("page_id", "query", "text_len", "rank")
