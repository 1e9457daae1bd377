"""Groups A and B: sources and sinks.  Round trips write derived data under the shared scratch folder."""

from functools import reduce

from pyspark.sql import functions as F

from corpusflow.operators.select import three_way_split
from corpusflow.queries.common import r6, t
from corpusflow.queries.registry import register
from corpusflow.queries.sqlparts_text import tokens as sql_tokens
from corpusflow.sources import readers as A
from corpusflow.sources.derived import settings
from corpusflow.sources import writers as B
from corpusflow.sources.upsert import bulk_upsert

SPLIT_SQL = """s AS (SELECT doc_id, lang, CASE WHEN u < 0.9 THEN 'train' WHEN u < 0.95 THEN 'validation' ELSE 'test' END AS split
           FROM (SELECT doc_id, lang, CAST(('0x' || substr(md5('7|' || CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0 AS u FROM documents))"""


def _splits(spark, d):
    return three_way_split(t(spark, d, "documents").select("doc_id", "lang"), "doc_id", 0.90, 0.05, 0.05, 7)


@register("read_parquet_splits", "A", sql=f"WITH {SPLIT_SQL} SELECT doc_id, split FROM s WHERE split IN ('test', 'validation')")
def q_read_splits(spark, d):
    root = A.scratch_path(spark, "splits")
    B.write_splits(_splits(spark, d), root)
    return A.read_parquet_splits(spark, root, ["test", "validation"]).select("doc_id", "split")


@register("write_parquet_splits", "B", sql=f"WITH {SPLIT_SQL} SELECT split, count(*) AS n FROM s GROUP BY split")
def q_write_splits(spark, d):
    root = A.scratch_path(spark, "splits")
    B.write_splits(_splits(spark, d), root)
    B.write_splits(_splits(spark, d), root)  # rerun: overwrite, no duplicates
    return A.read_parquet_splits(spark, root).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


PART_SCHEMA = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


@register("read_csv_table", "A", sql="SELECT * FROM part")
def q_csv(spark, d):
    path = A.scratch_path(spark, "part_csv")
    B.write_csv(t(spark, d, "part"), path)
    return A.read_csv(spark, path, PART_SCHEMA)


CONV_SCHEMA = "conv_id bigint, turn bigint, role string, text string"


@register("read_jsonl", "A", sql="SELECT * FROM conversations")
def q_jsonl(spark, d):
    path = A.scratch_path(spark, "conv_jsonl")
    B.write_jsonl(t(spark, d, "conversations"), path)
    return A.read_jsonl(spark, path, CONV_SCHEMA)


@register("read_pretokenized_jsonl", "A", sql=f"""
SELECT array_to_string(list_transform(tk, lambda x: CAST(length(x) AS VARCHAR)), ' ') AS input_ids, CAST(len(tk) AS BIGINT) AS mask_sum
FROM (SELECT {sql_tokens('text')} AS tk FROM documents)
""")
def q_pretok(spark, d):
    from corpusflow.functions.text import tokens

    path = A.scratch_path(spark, "tokens")
    docs = t(spark, d, "documents").select(F.transform(tokens("text"), lambda x: F.length(x)).alias("input_ids"))
    B.write_jsonl(docs.withColumn("attention_mask", F.transform("input_ids", lambda _: F.lit(1))), path)
    back = A.read_tokens(spark, [path])
    mask = F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x)
    return back.select(F.array_join(F.transform("input_ids", lambda x: x.cast("string")), " ").alias("input_ids"), mask.cast("bigint").alias("mask_sum"))


@register("read_nested_json_doc", "A", sql="""
SELECT conv_id, turn, text FROM conversations WHERE role = 'system'
""")
def q_nested(spark, d):
    c = t(spark, d, "conversations")
    # a nested document per thread: data[] = its thread, with paragraphs[] = turns
    doc = (c.groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role", "text")).alias("paragraphs"))
           .select(F.array(F.struct("conv_id", "paragraphs")).alias("data")))
    path = A.scratch_path(spark, "nested")
    doc.write.mode("overwrite").json(path)
    back = spark.read.schema("data array<struct<conv_id: bigint, paragraphs: array<struct<turn: bigint, role: string, text: string>>>>").json(path)
    flat = A.flatten_nested(back, "data", "paragraphs", F.col("role") == "system")
    return flat.select("conv_id", "turn", "text")


@register("json_normalize", "A", sql="SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def q_json_norm(spark, d):
    return A.json_normalize(t(spark, d, "events").select("event_id", "props"), "props", "k int")


FILE_DOCS = 100  # documents in one written file: the number of files follows the table


def _text_files(spark, d, table, key, text):
    """Texts of a table written as files of ``FILE_DOCS`` rows each, below one folder per file."""
    path = A.scratch_path(spark, "texts")
    rows = t(spark, d, table).select(F.floor(F.col(key) / FILE_DOCS).cast("bigint").alias("part"), F.col(text).alias("value"))
    rows.repartition("part").write.mode("overwrite").partitionBy("part").text(path)
    return path + "/*/*.txt"


@register("read_whole_text", "A", sql=f"""
SELECT CAST(doc_id // {FILE_DOCS} AS BIGINT) AS part, CAST(sum(length(text) + 1) AS BIGINT) AS n_chars FROM documents GROUP BY 1
""")
def q_whole_text(spark, d):
    files = A.read_documents(spark, _text_files(spark, d, "documents", "doc_id", "text"))
    return files.select(F.regexp_extract("path", "part=([0-9]+)", 1).cast("bigint").alias("part"), F.length("text").cast("bigint").alias("n_chars"))


@register("csv_rows_to_documents", "A", sql="""
SELECT n_nationkey, 'n_nationkey: ' || CAST(n_nationkey AS VARCHAR) || chr(10) || 'n_name: ' || n_name || chr(10) || 'n_regionkey: ' || CAST(n_regionkey AS VARCHAR) AS page_content FROM nation
""")
def q_rows_docs(spark, d):
    return A.rows_to_documents(t(spark, d, "nation")).select("n_nationkey", "page_content")


@register("read_pages_with_metadata", "A", sql="""
WITH p AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS page,
                  row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS from_end FROM documents),
m AS (SELECT source, 2020 + CAST(regexp_extract(source, '([0-9]+)', 1) AS INTEGER) % 4 AS year FROM (SELECT DISTINCT source FROM documents))
SELECT doc_id, source, CAST(page AS INTEGER) AS page, year FROM p JOIN m USING (source) WHERE from_end > 3
""")
def q_pages_meta(spark, d):
    docs = t(spark, d, "documents").select("doc_id", "source")
    pages = A.page_numbers(docs, "source", "doc_id")
    meta = docs.select("source").distinct().withColumn("year", (F.lit(2020) + F.pmod(F.regexp_extract("source", "([0-9]+)", 1).cast("int"), F.lit(4))).cast("int"))
    return A.load_pages(pages, meta, "source", "page").select("doc_id", "source", "page", "year")


@register("read_binary_media", "A", sql=f"""
SELECT CAST(page_id // {FILE_DOCS} AS BIGINT) AS part, 'text/plain' AS media_type,
       CAST((sum(octet_length(encode(html)) + 1) + 2) // 3 * 4 AS BIGINT) AS b64_len FROM pages GROUP BY 1
""")
def q_media(spark, d):
    files = A.read_media(spark, _text_files(spark, d, "pages", "page_id", "html"))
    b64 = F.length(F.regexp_replace("content_b64", "[\r\n]", "")).cast("bigint")
    return files.select(F.regexp_extract("path", "part=([0-9]+)", 1).cast("bigint").alias("part"), "media_type", b64.alias("b64_len"))


@register("load_document_collections", "A", sql="""
SELECT 'conversations' AS collection, count(DISTINCT conv_id) AS n, count(*) AS items FROM conversations
UNION ALL SELECT 'sharedConversations', count(DISTINCT conv_id), count(*) FROM conversations WHERE conv_id % 5 = 0
UNION ALL SELECT 'conversationStats', count(DISTINCT CAST(ts AS DATE)), count(*) FROM events
UNION ALL SELECT 'assistants', count(*), count(*) FROM supplier
UNION ALL SELECT 'reports', count(*), count(*) FROM labels WHERE toxic = 1
UNION ALL SELECT 'abortedGenerations', count(*), count(*) FROM events WHERE event_type = 'error'
UNION ALL SELECT 'settings', count(*), count(*) FROM customer
UNION ALL SELECT 'users', count(*), count(*) FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
UNION ALL SELECT 'sessions', count(DISTINCT json_extract_string(props, '$.k')), count(*) FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL
UNION ALL SELECT 'messageEvents', count(*), count(*) FROM events
UNION ALL SELECT 'files', count(*), count(*) FROM pages
""")
def q_collections(spark, d):
    c, e, cust = (t(spark, d, n) for n in ("conversations", "events", "customer"))

    def threads(x):
        m = F.struct("turn", F.col("role").alias("from"), F.col("text").alias("content"))
        return x.groupBy("conv_id").agg(F.array_sort(F.collect_list(m)).alias("messages")).withColumn("items", F.size("messages"))

    k = F.get_json_object("props", "$.k")
    shapes = {
        "conversations": threads(c), "sharedConversations": threads(c.filter("conv_id % 5 = 0")),
        "conversationStats": e.groupBy(F.to_date("ts").alias("at")).agg(F.count(F.lit(1)).alias("items")),
        "assistants": t(spark, d, "supplier"), "reports": t(spark, d, "labels").filter("toxic = 1"),
        "abortedGenerations": e.filter("event_type = 'error'"), "settings": settings(cust), "users": cust.filter("c_mktsegment <> 'HOUSEHOLD'"),
        "sessions": e.filter(k.isNotNull()).groupBy(k.alias("session_id")).agg(F.count(F.lit(1)).alias("items")),
        "messageEvents": e, "files": t(spark, d, "pages"),
    }
    path = A.scratch_path(spark, "collections")
    for name, df in shapes.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    back = A.load_collections(spark, path)
    counts = [df.agg(F.lit(name).alias("collection"), F.count(F.lit(1)).alias("n"),
                     (F.coalesce(F.sum("items"), F.lit(0)).cast("bigint") if "items" in df.columns else F.count(F.lit(1))).alias("items"))
              for name, df in back.items()]
    return reduce(lambda a, b: a.unionByName(b), counts)


@register("shard_by_rank", "A", sql="""
SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents)
WHERE i % 4 = 1 AND i < (n // 4) * 4
""")
def q_shard(spark, d):
    return A.shard_by_rank(t(spark, d, "documents").select("doc_id"), ["doc_id"], 4, 1)


@register("write_jsonl", "B", sql="SELECT doc_id, 'Summarize: ' || text AS prompt, lang AS completion FROM documents")
def q_write_jsonl(spark, d):
    path = A.scratch_path(spark, "prompts")
    df = t(spark, d, "documents").select("doc_id", F.concat(F.lit("Summarize: "), "text").alias("prompt"), F.col("lang").alias("completion"))
    B.write_jsonl(df, path)
    return A.read_jsonl(spark, path, "doc_id bigint, prompt string, completion string")


@register("write_csv_metrics", "B", sql="""
SELECT lang AS model_id, round(avg(toxic), 6) AS mean_toxicity, round(stddev_pop(toxic), 6) AS std_toxicity FROM labels JOIN documents USING (doc_id) GROUP BY lang
""")
def q_write_csv(spark, d):
    m = (t(spark, d, "labels").join(t(spark, d, "documents").select("doc_id", "lang"), "doc_id")
         .groupBy(F.col("lang").alias("model_id")).agg(r6(F.avg("toxic")).alias("mean_toxicity"), r6(F.stddev_pop("toxic")).alias("std_toxicity")))
    path = A.scratch_path(spark, "metrics_csv")
    B.write_csv(m, path)
    return A.read_csv(spark, path, "model_id string, mean_toxicity double, std_toxicity double")


@register("export_conversations_parquet", "B", sql="""
WITH ok AS (SELECT c_custkey AS conv_id FROM customer WHERE c_mktsegment <> 'HOUSEHOLD' AND c_acctbal > 0),
m AS (SELECT conv_id, turn, (turn % 3) - 1 AS score FROM conversations WHERE conv_id IN (SELECT conv_id FROM ok))
SELECT conv_id, count(*) AS n_messages, count(*) FILTER (WHERE score <> 0) AS n_scored FROM m GROUP BY conv_id
""")
def q_export(spark, d):
    c = t(spark, d, "conversations").withColumn("score", (F.col("turn") % 3) - 1)
    users = (t(spark, d, "customer").filter((F.col("c_mktsegment") != "HOUSEHOLD") & (F.col("c_acctbal") > 0))
             .select(F.col("c_custkey").alias("conv_id")))
    ex = B.export_conversations(c, users)
    path = A.scratch_path(spark, "export")
    ex.write.mode("overwrite").parquet(path)
    back = spark.read.parquet(path)
    return back.select("conv_id", F.size("messages").cast("bigint").alias("n_messages"),
                       F.size(F.filter("messages", lambda m: m["score"].isNotNull())).cast("bigint").alias("n_scored"))


@register("bulk_upsert_vectors", "B", sql="SELECT vec_id, round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS s FROM embeddings")
def q_upsert(spark, d):
    path = A.scratch_path(spark, "upsert")
    e = t(spark, d, "embeddings").select("vec_id", "embedding")
    bulk_upsert(e, "vec_id", path)
    bulk_upsert(e.repartition(3), "vec_id", path)  # a rerun with other tasks replaces the same rows
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return spark.read.parquet(path).select("vec_id", F.round(total, 4).alias("s"))


@register("save_load_vector_index", "B", sql="SELECT label AS bucket, count(*) AS n, round(sum(list_sum(CAST(embedding AS DOUBLE[]))), 4) AS s FROM embeddings GROUP BY label")
def q_index(spark, d):
    path = A.scratch_path(spark, "index")
    e = t(spark, d, "embeddings").withColumnRenamed("label", "bucket")
    B.save_index(e, path, "bucket")
    back = spark.read.parquet(path)
    s = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return back.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(s), 4).alias("s"))
