"""How the reference's document shapes are read off the fixture tables.

Every mapping here is a plain projection of a fixture table, so work grows with it.
Fixed choices (kept identical in the DuckDB oracles):

* chat message / conversation document  = one ``events`` row:
  id ``event_id``, user ``user_id`` (anonymous when ``value < 10``), session ``props.k``,
  created at ``ts``, model ``event_type``
* settings = one ``customer`` row: user ``c_custkey`` (none for segment HOUSEHOLD),
  session ``c_custkey`` as text, consent ``c_acctbal > 0``
* sales = ``lineitem`` x ``part``: date ``l_shipdate``, product ``l_partkey``,
  price ``p_retailprice``, units ``l_quantity``
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def chat_log(events: DataFrame) -> DataFrame:
    """events -> (message_id, user_id, session_id, created_at, model, value)."""
    return events.select(
        F.col("event_id").alias("message_id"),
        F.when(F.col("value") < 10, F.lit(None).cast("bigint")).otherwise(F.col("user_id")).alias("user_id"),
        F.get_json_object("props", "$.k").alias("session_id"),
        F.col("ts").cast("timestamp").alias("created_at"),
        F.col("event_type").alias("model"),
        F.col("value"),
    )


def settings(customer: DataFrame) -> DataFrame:
    """customer -> (user_id, session_id, consent)."""
    return customer.select(
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(None).cast("bigint")).otherwise(F.col("c_custkey")).alias("user_id"),
        F.col("c_custkey").cast("string").alias("session_id"),
        (F.col("c_acctbal") > 0).alias("consent"),
    )


def sales(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """lineitem x part -> (date, product_id, price, units, revenue).

    Revenue is DECIMAL(18,2) so that sums are exact whatever the partitioning.
    """
    li = lineitem.select("l_partkey", "l_quantity", "l_shipdate")
    p = part.select("p_partkey", "p_retailprice")
    return (li.join(p, li.l_partkey == p.p_partkey)
            .select(F.to_date("l_shipdate").alias("date"), F.col("l_partkey").alias("product_id"),
                    F.col("p_retailprice").alias("price"), F.col("l_quantity").alias("units"),
                    (F.col("p_retailprice") * F.col("l_quantity")).cast("decimal(18,2)").alias("revenue")))


def qa_pairs(conversations: DataFrame) -> DataFrame:
    """User turn followed by an assistant turn of the same thread -> (conv_id, turn, question, answer).

    The answer is the turn right after (``turn + 1``), found by an equi-join, not a window.
    """
    c = conversations
    u = c.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    a = c.filter(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return u.join(a, ["conv_id", "turn"])


def preference_pairs(conversations: DataFrame) -> DataFrame:
    """Per thread: question = first user turn, response_j / response_k = first / second assistant turn.

    Threads with fewer than two assistant turns give no pair.
    """
    c = conversations
    q = c.filter(F.col("role") == "user").groupBy("conv_id").agg(F.min_by("text", "turn").alias("question"))
    two = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn"))
    a = c.filter(F.col("role") == "assistant").withColumn("_r", two).filter("_r <= 2")
    a = (a.groupBy("conv_id").agg(F.max(F.when(F.col("_r") == 1, F.col("text"))).alias("response_j"),
                                  F.max(F.when(F.col("_r") == 2, F.col("text"))).alias("response_k"), F.count(F.lit(1)).alias("_n"))
         .filter("_n = 2").drop("_n"))
    return q.join(a, "conv_id")
