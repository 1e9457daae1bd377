"""Sinks (group B).  Every writer is idempotent: rerunning a job replaces, never duplicates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_splits(df: DataFrame, root: str) -> None:
    df.write.mode("overwrite").partitionBy("split").parquet(root)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def save_index(df: DataFrame, path: str, bucket: str) -> None:
    df.write.mode("overwrite").partitionBy(bucket).parquet(path)


def export_conversations(conv: DataFrame, consented_users: DataFrame) -> DataFrame:
    """Consented conversations with ``messages{from, content, score}``; a 0 score is no vote (null)."""
    nested = (conv.groupBy("conv_id")
              .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "score"))).alias("_m")))
    nested = nested.join(consented_users, "conv_id", "left_semi")
    msgs = F.transform("_m", lambda m: F.struct(m["role"].alias("from"), m["text"].alias("content"),
                                                F.when(m["score"] != 0, m["score"]).cast("byte").alias("score")))
    return nested.select("conv_id", msgs.alias("messages"))
