"""Group H (and K1, D13): embeddings and retrieval over the ``embeddings`` table.

Queries are the rows whose vec_id is divisible by 20, against all rows (a query's own row among them).
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusflow.functions.vectors import embed_with, hash_model, norm, vec_str, with_hash_embedding, with_normalized
from corpusflow.operators import ivf
from corpusflow.operators import retrieval as H
from corpusflow.operators.chunking import chunk_fixed
from corpusflow.operators.text import extract_tag, html_paragraphs
from corpusflow.queries.common import t
from corpusflow.queries.q_text import H1_SQL, PARAGRAPHS_SQL, TITLE_SQL
from corpusflow.queries.registry import register
from corpusflow.queries.sqlparts_text import tokens as sql_tokens

G = "H"
DIM = 32
#: what stands before a text that is stored, for models that tell it from a query
PASSAGE = "passage: "
MEDIA = ["text", "image", "audio"]
RAG_TEMPLATE = ("Use the following pieces of context to answer the question at the end.\n\n{context}\n\n"
                "Question: {question}\nHelpful Answer:")


def _qc(spark, d):
    e = t(spark, d, "embeddings")
    q = e.filter(F.col("vec_id") % 20 == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("qv"))
    c = e.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("cv"), "label")
    return q, c


QC = """q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS qv FROM embeddings WHERE vec_id % 20 = 0),
c AS (SELECT vec_id AS item_id, CAST(embedding AS DOUBLE[]) AS cv, label FROM embeddings)"""
L2 = "list_sum(list_transform(range(len(qv)), lambda i: (qv[i + 1] - cv[i + 1]) * (qv[i + 1] - cv[i + 1])))"


def _emb_sql(name, src, key, text, where="TRUE"):
    return f"""{name}_b AS (SELECT {key}, list_transform({sql_tokens(f'lower({text})')}, lambda tk: CAST(('0x' || substr(md5(tk), 1, 8)) AS BIGINT) % {DIM}) AS b FROM {src} WHERE {where}),
{name}_c AS (SELECT {key}, list_transform(range({DIM}), lambda i: CAST(len(list_filter(b, lambda x: x = i)) AS DOUBLE)) AS c FROM {name}_b),
{name} AS (SELECT {key}, list_transform(c, lambda v: CASE WHEN n > 0 THEN v / n ELSE 0.0 END) AS v
           FROM (SELECT {key}, c, sqrt(list_sum(list_transform(c, lambda z: z * z))) AS n FROM {name}_c))"""


def _vec_sql(v):
    return f"array_to_string(list_transform({v}, lambda x: printf('%.6f', round(x, 6))), ',')"


@register("embed_documents", G, sql=f"""
WITH pt AS (SELECT doc_id, '{PASSAGE}' || coalesce(text, '') AS text FROM documents),
{_emb_sql('e', 'pt', 'doc_id', 'text')}
SELECT doc_id, {_vec_sql('v')} AS embedding FROM e
""")
def q_embed(spark, d):
    e = embed_with(t(spark, d, "documents").select("doc_id", "text"), ["text"], "v", hash_model(DIM), prefix=PASSAGE)
    return e.select("doc_id", vec_str("v").alias("embedding"))


@register("l2_normalize", G, sql="""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
n AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda z: z * z)))) AS u FROM v)
SELECT vec_id, round(sqrt(list_sum(list_transform(u, lambda z: z * z))), 6) AS norm, round(u[1], 6) AS u0 FROM n
""")
def q_normalize(spark, d):
    u = with_normalized(t(spark, d, "embeddings").select("vec_id", "embedding"), "embedding", "u")
    return u.select("vec_id", F.round(norm("u"), 6).alias("norm"), F.round(F.col("u")[0], 6).alias("u0"))


@register("inner_product_distance", G, sql=f"""
WITH {QC}
SELECT query_id, item_id, round(score, 5) AS distance FROM
 (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9), item_id) AS rank FROM
   (SELECT query_id, item_id, 1 - list_dot_product(qv, cv) AS score FROM q, c)) WHERE rank <= 20
""")
def q_ip(spark, d):
    q, c = _qc(spark, d)
    # the 20 smallest distances of each query, not a row per pair
    return H.knn(q, c, 20, "ip_distance").select("query_id", "item_id", F.round("score", 5).alias("distance"))


def _knn_sql(score, order, k, where="TRUE"):
    return f"""WITH {QC}, s AS (SELECT query_id, item_id, label, {score} AS score FROM q, c WHERE {where})
SELECT query_id, item_id, rank, round(score, 5) AS score FROM
 (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) {order}, item_id) AS rank FROM s) WHERE rank <= {k}"""


def _knn_out(df):
    return df.select("query_id", "item_id", F.col("rank").cast("bigint").alias("rank"), F.round("score", 5).alias("score"))


@register("topk_per_query", "K", sql=_knn_sql("1 - list_dot_product(qv, cv)", "ASC", 3))
def q_topk(spark, d):
    q, c = _qc(spark, d)
    return _knn_out(H.knn(q, c, 3, "ip_distance"))


@register("l2_distance_search", G, sql=_knn_sql(L2, "ASC", 5))
def q_l2(spark, d):
    q, c = _qc(spark, d)
    return _knn_out(H.knn(q, c, 5, "l2"))


@register("dot_product_search", G, sql=_knn_sql("list_dot_product(qv, cv)", "DESC", 5))
def q_dot(spark, d):
    q, c = _qc(spark, d)
    return _knn_out(H.knn(q, c, 5, "dot"))


@register("knn_with_prefilter", G, sql=_knn_sql("list_dot_product(qv, cv)", "DESC", 5, "label = 3"))
def q_pre(spark, d):
    q, c = _qc(spark, d)
    return _knn_out(H.knn(q, c, 5, "dot", where={"label": 3}))


@register("knn_with_postfilter", G, sql=f"""
WITH {QC}, s AS (SELECT query_id, item_id, label, list_dot_product(qv, cv) AS score FROM q, c),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, item_id) AS r0 FROM s) WHERE r0 <= 20 AND label = 3)
SELECT query_id, item_id, rank, round(score, 5) AS score FROM
 (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM f) WHERE rank <= 5
""")
def q_post(spark, d):
    q, c = _qc(spark, d)
    return _knn_out(H.knn_post(q, c, 5, 20, {"label": 3}))


@register("cosine_similarity_matrix", G, sql="""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS item_id,
             list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) AS cosine
      FROM v a, v b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, item_id, rank, round(cosine, 5) AS cosine FROM
 (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(cosine, 9) DESC, item_id) AS rank FROM s) WHERE rank <= 3
""")
def q_cosine(spark, d):
    # rows of the matrix for the query set (ids divisible by 20) against all items, top 3 of each
    e = t(spark, d, "embeddings")
    asked = e.filter(F.col("vec_id") % 20 == 0)
    q = with_normalized(asked.select(F.col("vec_id").alias("query_id"), "embedding"), "embedding", "qv").drop("embedding")
    c = with_normalized(e.select(F.col("vec_id").alias("item_id"), "embedding"), "embedding", "cv").drop("embedding")
    hits = H.knn(q, c, 4, "dot")
    hits = hits.filter(F.col("query_id") != F.col("item_id"))
    w = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), "item_id")
    hits = hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= 3)
    return hits.select("query_id", "item_id", F.col("rank").cast("bigint").alias("rank"), F.round("score", 5).alias("cosine"))


@register("mmr_search", G)
def q_mmr(spark, d):
    q, c = _qc(spark, d)
    cand = H.attach_vectors(H.knn(q, c, 20, "dot"), q, c)
    return H.mmr(cand, 5, 0.5)


@register("knn_field_projection", G, sql=f"""
WITH {QC}, s AS (SELECT query_id, item_id, label, list_dot_product(qv, cv) AS score FROM q, c)
SELECT query_id, item_id, label FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM s) WHERE rank <= 3
""")
def q_fields(spark, d):
    q, c = _qc(spark, d)
    # k = 10 fetched, only 3 returned, and only the chosen fields
    return H.knn(q, c, 10, "dot").filter(F.col("rank") <= 3).select("query_id", "item_id", "label")


@register("cross_modal_search", G, sql=f"""
WITH {QC}, s AS (SELECT query_id, item_id, ['text', 'image', 'audio'][label % 3 + 1] AS media_type, list_dot_product(qv, cv) AS score FROM q, c)
SELECT query_id, item_id, media_type, round(score, 5) AS score FROM
 (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM s) WHERE rank <= 4
""")
def q_modal(spark, d):
    q, c = _qc(spark, d)
    c = c.withColumn("media_type", F.element_at(F.array(*[F.lit(m) for m in MEDIA]), (F.pmod("label", F.lit(3)) + 1).cast("int")))
    return H.knn(q, c, 4, "dot").select("query_id", "item_id", "media_type", F.round("score", 5).alias("score"))


@register("approx_knn", G)
def q_ann(spark, d):
    q, c = _qc(spark, d)
    index = ivf.build(c)
    hits, recall = ivf.search(q, index, 5)
    return hits.select("query_id", "item_id", F.col("rank").cast("bigint").alias("rank"), F.round("score", 5).alias("score"),
                       F.lit(round(recall, 6)).alias("recall"))


@register("rerank_top_n", G, sql=f"""
WITH {QC}, s AS (SELECT query_id, item_id, list_dot_product(qv, cv) AS score FROM q, c),
h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM s) WHERE rank <= 10),
r AS (SELECT *, (item_id * 7) % 10 AS relevance FROM h)
SELECT query_id, item_id, rank, rerank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY relevance DESC, rank) AS rerank FROM r)
WHERE rerank <= 3
""")
def q_rerank(spark, d):
    q, c = _qc(spark, d)
    hits = H.knn(q, c, 10, "dot")
    # the model's parsed answer per (query, batch, choice): relevance derived from the item id
    scores = (hits.select("query_id", F.floor((F.col("rank") - 1) / 5).alias("batch"), ((F.col("rank") - 1) % 5 + 1).alias("choice"),
                          F.pmod(F.col("item_id") * 7, F.lit(10)).alias("relevance")))
    r = H.rerank(hits, scores, 3)
    return r.select("query_id", "item_id", F.col("rank").cast("bigint").alias("rank"), F.col("rerank").cast("bigint").alias("rerank"))


@register("store_statistics", G, sql="""
SELECT label, count(*) AS n, max(len(embedding)) AS dim FROM embeddings GROUP BY ROLLUP (label)
""")
def q_store(spark, d):
    return H.index_stats(t(spark, d, "embeddings"), "embedding", "label").select("label", "n", F.col("dim").cast("bigint").alias("dim"))


def _doc_vectors(spark, d):
    # ids and vectors only: texts are joined back after the top-k, never carried through the scoring
    docs = t(spark, d, "documents").select(F.col("doc_id").alias("item_id"), "text")
    return with_hash_embedding(docs, "text", "cv", DIM).drop("text")


def _with_text(spark, d, hits):
    docs = t(spark, d, "documents").select(F.col("doc_id").alias("item_id"), "text")
    return hits.drop("score").join(docs, "item_id")


def _bench_vectors(spark, d):
    b = t(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))
    return with_hash_embedding(b, "question", "qv", DIM)


_QA_SQL = f"""{_emb_sql('dv', 'documents', 'doc_id', 'text')}, {_emb_sql('bv', 'benchmark', 'item_id', 'text')},
s AS (SELECT bv.item_id AS query_id, dv.doc_id AS item_id, list_dot_product(bv.v, dv.v) AS score FROM bv, dv),
h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM s) WHERE rank <= 5)"""


@register("retrieval_qa_table", G, sql=f"""
WITH {_QA_SQL}
SELECT query_id, string_agg(CAST(h.item_id AS VARCHAR), ',' ORDER BY rank) AS sources,
       replace(replace({"'" + RAG_TEMPLATE.replace(chr(10), "' || chr(10) || '") + "'"}, '{{context}}', string_agg(d.text, chr(10) || chr(10) ORDER BY rank)), '{{question}}', b.text) AS prompt
FROM h JOIN documents d ON d.doc_id = h.item_id JOIN benchmark b ON b.item_id = h.query_id GROUP BY query_id, b.text
""")
def q_rqa(spark, d):
    bench = _bench_vectors(spark, d)
    hits = _with_text(spark, d, H.knn(bench, _doc_vectors(spark, d), 5, "dot"))
    # one group per question: its k hits in rank order give the sources and the prompt
    g = hits.groupBy("query_id", "question").agg(F.array_sort(F.collect_list(F.struct("rank", "item_id", "text"))).alias("h"))
    context = F.array_join(F.transform("h", lambda x: x["text"]), "\n\n")
    prompt = F.replace(F.replace(F.lit(RAG_TEMPLATE), F.lit("{context}"), context), F.lit("{question}"), F.col("question"))
    return g.select("query_id", F.array_join(F.transform("h", lambda x: x["item_id"].cast("string")), ",").alias("sources"), prompt.alias("prompt"))


@register("rag_prompt", "D", sql=f"""
WITH {_QA_SQL}
SELECT query_id, replace({"'" + RAG_TEMPLATE.replace(chr(10), "' || chr(10) || '") + "'"}, '{{context}}', string_agg(d.text, chr(10) || chr(10) ORDER BY rank)) AS prompt
FROM h JOIN documents d ON d.doc_id = h.item_id GROUP BY query_id
""")
def q_rag_prompt(spark, d):
    hits = _with_text(spark, d, H.knn(_bench_vectors(spark, d).drop("question"), _doc_vectors(spark, d), 5, "dot"))
    return H.stuff_prompt(hits, "query_id", "rank", "text", RAG_TEMPLATE).select("query_id", "prompt")


@register("document_summary_index", G, sql=f"""
WITH su AS (SELECT doc_id, regexp_extract(text, '^[^.!?]*[.!?]?', 0) AS summary FROM documents),
{_emb_sql('sv', 'su', 'doc_id', 'summary')}, {_emb_sql('bv', 'benchmark', 'item_id', 'text')},
s AS (SELECT bv.item_id AS query_id, sv.doc_id, list_dot_product(bv.v, sv.v) AS score FROM bv, sv),
h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM s) WHERE rank <= 2)
SELECT query_id, h.doc_id, rank, CAST(s.pos AS BIGINT) AS pos FROM h JOIN documents d ON d.doc_id = h.doc_id,
  LATERAL (SELECT unnest(range(0, (length(d.text) + 999) // 1000)) AS pos) s
""")
def q_summary_index(spark, d):
    docs = t(spark, d, "documents")
    summ = with_hash_embedding(docs.select(F.col("doc_id").alias("item_id"), H.lead_sentence("text").alias("summary")), "summary", "cv", DIM).drop("summary")
    hits = H.knn(_bench_vectors(spark, d).drop("question"), summ, 2, "dot").select("query_id", F.col("item_id").alias("doc_id"), "rank")
    chunks = chunk_fixed(docs.select("doc_id", "text"), "text", 1000).select("doc_id", "pos")
    return hits.join(chunks, "doc_id").select("query_id", "doc_id", F.col("rank").cast("bigint").alias("rank"), F.col("pos").cast("bigint").alias("pos"))


@register("map_reduce_summary", G, sql="""
WITH ch AS (SELECT doc_id, s, regexp_extract(substr(text, s, 2000), '^[^.!?]*[.!?]?', 0) AS part FROM documents,
            LATERAL (SELECT unnest(range(1, length(text) + 1, 2000)) AS s)),
comb AS (SELECT doc_id, string_agg(part, ' ' ORDER BY s) AS combined, count(*) AS n_chunks FROM ch GROUP BY doc_id)
SELECT doc_id, regexp_extract(combined, '^[^.!?]*[.!?]?', 0) AS summary, n_chunks FROM comb
""")
def q_map_reduce(spark, d):
    docs = t(spark, d, "documents").select("doc_id", "text")
    ch = chunk_fixed(docs, "text", 2000).select("doc_id", "pos", H.lead_sentence("chunk").alias("part"))
    comb = ch.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "part"))), lambda x: x["part"]), " ").alias("combined"),
                                    F.count(F.lit(1)).alias("n_chunks"))
    return comb.select("doc_id", H.lead_sentence("combined").alias("summary"), "n_chunks")


def _web_hits(spark, d):
    """Pages per query (language path), first 10 pages, 100 chunks per page, first 5 pages, top 8 chunks."""
    p = t(spark, d, "pages").select("page_id", "url", "html", F.regexp_extract("url", "/([a-z][a-z])/", 1).alias("query"))
    w = Window.partitionBy("query").orderBy("page_id")
    p = p.withColumn("page_rank", F.row_number().over(w)).filter(F.col("page_rank") <= 10)
    qtext = p.filter(F.col("page_rank") == 1).select("query", F.coalesce(extract_tag("html", "h1"), F.lit("")).alias("qtext"))
    qv = with_hash_embedding(qtext.select(F.col("query").alias("query_id"), "qtext"), "qtext", "qv", DIM).drop("qtext")
    txt = p.filter(F.col("page_rank") <= 5).select("query", "page_id", "url", F.coalesce(html_paragraphs("html"), F.lit("")).alias("text"))
    ch = chunk_fixed(txt, "text", 512, max_chunks=100)
    cv = ch.select(F.concat_ws("#", F.col("page_id").cast("string"), F.lpad(F.col("pos").cast("string"), 4, "0")).alias("item_id"),
                   "query", "url", "chunk")
    cv = with_hash_embedding(cv, "chunk", "cv", DIM)
    return H.knn_within(qv.withColumn("query", F.col("query_id")), cv, "query", 8)


_WEB_SQL = f"""p AS (SELECT page_id, url, html, regexp_extract(url, '/([a-z][a-z])/', 1) AS query,
       row_number() OVER (PARTITION BY regexp_extract(url, '/([a-z][a-z])/', 1) ORDER BY page_id) AS page_rank FROM pages),
qt AS (SELECT query, {H1_SQL} AS qtext FROM p WHERE page_rank = 1),
tx AS (SELECT query, page_id, url, coalesce({PARAGRAPHS_SQL}, '') AS text FROM p WHERE page_rank <= 5),
ch AS (SELECT query, url, CAST(page_id AS VARCHAR) || '#' || lpad(CAST(pos AS VARCHAR), 4, '0') AS item_id, substr(text, CAST(pos * 512 + 1 AS BIGINT), 512) AS chunk
       FROM tx, LATERAL (SELECT unnest(range(0, least((length(text) + 511) // 512, 100))) AS pos)),
{_emb_sql('qe', 'qt', 'query', 'qtext')}, {_emb_sql('ce', 'ch', 'item_id', 'chunk')},
h AS (SELECT * FROM (SELECT ch.query, url, chunk, row_number() OVER (PARTITION BY ch.query ORDER BY round(list_dot_product(qe.v, ce.v), 9) DESC, item_id) AS rank
      FROM ch JOIN ce USING (item_id) JOIN qe ON qe.query = ch.query) WHERE rank <= 8)"""


@register("retrieval_cutoffs_pipeline", G, sql=f"""
WITH {_WEB_SQL} SELECT query, string_agg(chunk, chr(10) || chr(10) ORDER BY rank) AS context FROM h GROUP BY query
""")
def q_web_retrieve(spark, d):
    hits = _web_hits(spark, d)
    return H.stuff_prompt(hits, "query_id", "rank", "chunk", "{context}").select(F.col("query_id").alias("query"), F.col("prompt").alias("context"))


@register("context_sources_dedupe", G, sql=f"""
WITH {_WEB_SQL}, s AS (SELECT query, url, min(rank) AS best_rank FROM h GROUP BY query, url)
SELECT query, url, best_rank, row_number() OVER (PARTITION BY query ORDER BY best_rank) AS place FROM s
""")
def q_sources(spark, d):
    hits = _web_hits(spark, d)
    best = hits.groupBy("query_id", "url").agg(F.min("rank").cast("bigint").alias("best_rank")).withColumnRenamed("query_id", "query")
    # at most 8 sources per query, numbered in rank order
    place = F.row_number().over(Window.partitionBy("query").orderBy("best_rank")).cast("bigint")
    return best.withColumn("place", place)


@register("embed_pair", G, sql=f"""
WITH pt AS (SELECT page_id, array_to_string(list_filter([coalesce({TITLE_SQL}, ''), coalesce({PARAGRAPHS_SQL}, '')], lambda x: x IS NOT NULL), ' ') AS joined FROM pages),
{_emb_sql('e', 'pt', 'page_id', 'joined')}
SELECT page_id, {_vec_sql('v')} AS embedding FROM e
""")
def q_embed_pair(spark, d):
    p = t(spark, d, "pages")
    # one vector for two columns, caption and content: the model gets both
    both = p.select("page_id", extract_tag("html", "title").alias("caption"), html_paragraphs("html").alias("content"))
    e = embed_with(both, ["caption", "content"], "v", hash_model(DIM))
    return e.select("page_id", vec_str("v").alias("embedding"))
