"""Helpers used by the query modules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.sources.tables import table


def t(spark: SparkSession, sf_dir: str, name: str, zoned: bool = False) -> DataFrame:
    return table(spark, sf_dir, name, zoned)


def r6(c: Column | str) -> Column:
    """Round a float for hashing against the oracle (sum order varies with partitions)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def day(c: Column | str) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd")


def ts_str(c: Column | str) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd HH:mm:ss")


def dsum(c: Column | str) -> Column:
    """Exact sum of a money-like double (decimal accumulator), returned as double."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast("decimal(38,6)")).cast("double")
