"""Training-data pipeline over ``documents``: rules, near-duplicates, benchmark passages, mixing, token ids.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet in the shared folder and reread as the next stage's ``docs``. All but the last return
the columns of ``documents``. Extra columns and null values are carried along; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import decontaminate, hyperminhash, mixing, perplexity, token_store
from corpusflow.llm.q_llm import tokenizer_path
from corpusflow.sources.readers import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their language's perplexity band."""
    return perplexity.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each near-duplicate group."""
    return hyperminhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out (``n_chars`` follows the text); documents that are mostly such passages go."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    out = decontaminate.remove_spans(docs, items)
    if "n_chars" in out.columns:
        kind = out.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their target words."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id shards written and read back: doc_id, start, n_tokens, ids_crc32."""
    return token_store.encode_table(docs, tokenizer_path())


STAGES = [("quality rules", quality), ("near duplicates", near_duplicates), ("benchmark decontamination", decontamination),
          ("mixing", mixture), ("token ids", token_ids)]

#: SQL can't state the perplexity model, the budget fit or the token ids
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
