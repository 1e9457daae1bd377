"""Group G: chunking."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.operators import chunking as C
from corpusflow.queries.common import t
from corpusflow.queries.registry import register

G = "G"


@register("chunk_fixed", G, sql="""
SELECT doc_id, CAST(pos AS BIGINT) AS pos, substr(text, CAST(pos * 1000 + 1 AS BIGINT), 1000) AS chunk FROM documents,
  LATERAL (SELECT unnest(range(0, (length(text) + 999) // 1000)) AS pos) WHERE length(text) > 0
""")
def q_fixed(spark, d):
    c = C.chunk_fixed(t(spark, d, "documents").select("doc_id", "text"), "text", 1000)
    return c.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "chunk")


@register("chunk_sliding", G, sql="""
SELECT doc_id, CAST(pos AS BIGINT) AS pos, substr(text, CAST(pos * 900 + 1 AS BIGINT), 1000) AS chunk FROM documents,
  LATERAL (SELECT unnest(range(0, greatest(length(text) - 100, 1), 900)) AS s, generate_subscripts(range(0, greatest(length(text) - 100, 1), 900), 1) - 1 AS pos)
WHERE length(text) > 0
""")
def q_sliding(spark, d):
    c = C.chunk_sliding(t(spark, d, "documents").select("doc_id", "text"), "text", 1000, 100)
    return c.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "chunk")


@register("chunk_recursive", G)
def q_recursive(spark, d):
    return C.chunk_recursive(t(spark, d, "documents"), "doc_id", "text", 1000, 100)


@register("chunk_by_separator", G)
def q_by_sep(spark, d):
    return C.chunk_by_separator(t(spark, d, "documents"), "doc_id", "text", "\n", 2000, 400)


def _pages(spark, d):
    from corpusflow.sources.readers import page_numbers

    docs = t(spark, d, "documents").select("doc_id", "text", "lang", "source")
    # page number = rank of the document inside its source file (range-partitioned index over the ids only)
    pages = page_numbers(docs.select("doc_id", "source"), "source", "doc_id").select("doc_id", "page")
    return docs.join(pages, "doc_id")


@register("chunk_metadata", G, sql="""
WITH p AS (SELECT doc_id, text, lang, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS page FROM documents)
SELECT doc_id, source, CAST(page AS INTEGER) AS page, lang, CAST(pos AS BIGINT) AS pos, length(substr(text, CAST(pos * 1000 + 1 AS BIGINT), 1000)) AS n_chars
FROM p, LATERAL (SELECT unnest(range(0, (length(text) + 999) // 1000)) AS pos) WHERE length(text) > 0
""")
def q_meta(spark, d):
    c = C.chunk_fixed(_pages(spark, d), "text", 1000)
    return c.select("doc_id", "source", "page", "lang", F.col("pos").cast("bigint").alias("pos"), F.length("chunk").cast("bigint").alias("n_chars"))


@register("chunk_counts", G, sql="""
SELECT source, count(DISTINCT doc_id) AS pages, count(*) AS chunks FROM documents,
  LATERAL (SELECT unnest(range(0, (length(text) + 999) // 1000)) AS pos) WHERE length(text) > 0 GROUP BY source
""")
def q_counts(spark, d):
    c = C.chunk_fixed(t(spark, d, "documents").select("doc_id", "text", "source"), "text", 1000)
    return C.chunk_summary(c, "source", "doc_id")


@register("chunk_to_training_rows", G, sql="""
SELECT doc_id, CAST(pos AS BIGINT) AS pos, substr(text, CAST(pos * 2000 + 1 AS BIGINT), 2000) AS input FROM documents,
  LATERAL (SELECT unnest(range(0, (length(text) + 1999) // 2000)) AS pos) WHERE length(text) > 0
""")
def q_training_rows(spark, d):
    c = C.chunk_fixed(t(spark, d, "documents").select("doc_id", "text"), "text", 2000)
    # written with write.json as {"input": ...} lines by sinks.write_jsonl
    return c.select("doc_id", F.col("pos").cast("bigint").alias("pos"), F.col("chunk").alias("input"))
