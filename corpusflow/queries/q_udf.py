"""Group P: map / UDF / UDTF surface."""

import pandas as pd
from pyspark.sql import functions as F

from corpusflow.operators import udf as U
from corpusflow.plans.dense_index import with_index
from corpusflow.queries.common import t
from corpusflow.queries.registry import register
from corpusflow.queries.sqlparts_text import words as swords

G = "P"


@register("map_batches", G, sql="SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars FROM documents")
def q_map_batches(spark, d):
    fn = lambda pdf: pd.DataFrame({"doc_id": pdf["doc_id"], "n_chars": pdf["text"].str.len().astype("int64")})
    return U.map_batches(t(spark, d, "documents").select("doc_id", "text"), fn, "doc_id bigint, n_chars bigint")


@register("map_with_index", G, sql="SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx, (row_number() OVER (ORDER BY doc_id) - 1) % 2 = 0 AS keep FROM documents")
def q_map_index(spark, d):
    ix = with_index(t(spark, d, "documents").select("doc_id"), ["doc_id"], "idx")
    return ix.withColumn("keep", F.pmod("idx", F.lit(2)) == 0)


@register("batch_score", G, sql=f"""
WITH w AS (SELECT doc_id, {swords('lower(text)')} AS w FROM documents)
SELECT doc_id, round(CASE WHEN len(w) > 0 THEN 1.0 - CAST(len(list_filter(w, lambda x: list_contains({U.LEXICON!r}, trim(x, '.,!?;:')))) AS DOUBLE) / len(w)
       ELSE 1.0 END, 9) AS nothate FROM w
""")
def q_batch_score(spark, d):
    s = U.batch_score(t(spark, d, "documents").select("doc_id", "text"), "text")
    return s.select("doc_id", F.filter("scores", lambda x: x["label"] == "nothate")[0]["score"].alias("nothate")).withColumn("nothate", F.round("nothate", 9))


@register("batch_generate", G, sql="""
SELECT doc_id, string_split(rtrim('Summarize:' || chr(10) || text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), chr(10))[-1] AS generated,
       CAST(NULL AS VARCHAR) AS error FROM documents
""")
def q_generate(spark, d):
    docs = t(spark, d, "documents").select("doc_id", F.concat(F.lit("Summarize:\n"), "text").alias("prompt"))
    return U.batch_generate(docs, "doc_id", "prompt")


@register("batch_transcribe", G, sql="SELECT page_id, CAST(octet_length(encode(html)) AS VARCHAR) || ' bytes' AS text FROM pages")
def q_transcribe(spark, d):
    p = t(spark, d, "pages").select("page_id", F.encode("html", "UTF-8").alias("content"))
    return U.map_files(p, "page_id", "content", lambda b: f"{len(b)} bytes")


@register("aggregate_udaf", G, sql="""
WITH e AS (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
m AS (SELECT label, i, avg(x) AS m, count(*) AS n FROM e GROUP BY label, i)
SELECT CAST(label AS INTEGER) AS label, max(n) AS n, round(sqrt(sum(m * m)), 6) AS centroid_norm FROM m GROUP BY label
""")
def q_udaf(spark, d):
    e = t(spark, d, "embeddings").select(F.col("label").cast("int").alias("label"), "embedding")
    mean = U.vector_means(e, "label", "embedding")
    norm = F.sqrt(F.aggregate("mean", F.lit(0.0), lambda a, x: a + x * x))
    return mean.select("label", "n", F.round(norm, 6).alias("centroid_norm"))


@register("table_function_chunks", G, sql="""
SELECT doc_id, CAST(pos AS INTEGER) AS pos, substr(text, CAST(pos * 1000 + 1 AS BIGINT), 1000) AS chunk FROM documents,
  LATERAL (SELECT unnest(range(0, (length(text) + 999) // 1000)) AS pos) WHERE length(text) > 0
""")
def q_udtf(spark, d):
    import uuid

    from pyspark.sql.functions import udtf

    @udtf(returnType="pos: int, chunk: string", useArrow=True)
    class ChunkText:
        def eval(self, text: str, n: int):
            if text:
                for i in range(0, len(text), n):
                    yield i // n, text[i:i + n]

    spark.udtf.register("chunk_text", ChunkText)
    view = f"docs_{uuid.uuid4().hex}"
    t(spark, d, "documents").select("doc_id", "text").createOrReplaceTempView(view)
    return spark.sql(f"SELECT d.doc_id, c.pos, c.chunk FROM {view} d, LATERAL chunk_text(d.text, 1000) c")
