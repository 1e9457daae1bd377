"""Fixture tables: one parquet file per table under a scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# time columns stored as TIMESTAMP_NTZ; session zone is UTC so the cast keeps wall time
_TIME_COLUMNS = {"events": ["ts"], "orders": ["o_orderdate"], "lineitem": ["l_shipdate"]}


# tables whose rows carry whole texts: per-row work (regex, tokenising, UDFs) dominates
_TEXT_TABLES = {"documents", "pages", "conversations", "benchmark"}


TEXT_PARTITIONS = "corpusflow.textPartitions"


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a text table over ``corpusflow.textPartitions`` tasks, if the session sets that.

    Unset by default: real inputs have many files and row groups. The fixture's tables are one row
    group each, that is one scan task, so the bench sets it to its number of cores.
    """
    n = int(df.sparkSession.conf.get(TEXT_PARTITIONS, "0"))
    return df.repartition(n) if n > 0 else df


def table(spark: SparkSession, sf_dir: str, name: str, zoned: bool = False) -> DataFrame:
    """Read one table. ``zoned=True`` casts NTZ time columns to TIMESTAMP (needed by watermarks)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if name in _TEXT_TABLES:
        df = spread(df)
    if zoned:
        for c in _TIME_COLUMNS.get(name, []):
            df = df.withColumn(c, F.col(c).cast("timestamp"))
    return df
