"""Whole queries asked for in words (group S) and the sales summaries they build on (J15, J16)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def revenue_totals(sales: DataFrame) -> DataFrame:
    """Total, per product and per month revenue in one grouping-sets pass (one scan, one shuffle)."""
    s = sales.withColumn("month", F.date_format("date", "yyyy-MM"))
    g = (s.groupingSets([[], ["product_id"], ["month"]], "product_id", "month")
         .agg(F.sum("revenue").cast("double").alias("revenue"), F.grouping_id().alias("_g")))
    # grouping_id bits: product_id is the high bit, month the low bit (1 = rolled up)
    level = F.when(F.col("_g") == 1, "product").when(F.col("_g") == 2, "month").otherwise("total")
    return g.select(level.alias("level"), "product_id", "month", F.round("revenue", 6).alias("revenue"))


def revenue_extremes(sales: DataFrame) -> DataFrame:
    """Best product and best day by revenue (the day's own revenue); ties go to the smaller id / earlier day."""
    by_p = sales.groupBy("product_id").agg(F.sum("revenue").cast("double").alias("rev"))
    by_d = sales.groupBy("date").agg(F.sum("revenue").cast("double").alias("rev"))
    bp = by_p.agg(F.max_by("product_id", F.struct("rev", -F.col("product_id"))).alias("best_product"),
                  F.max("rev").alias("best_product_revenue"))
    bd = by_d.agg(F.max_by("date", F.struct("rev", -F.datediff("date", F.lit("1970-01-01")))).alias("best_date"),
                  F.max("rev").alias("best_date_revenue"))
    return bp.crossJoin(bd).select("best_product", F.round("best_product_revenue", 6).alias("best_product_revenue"),
                                   F.date_format("best_date", "yyyy-MM-dd").alias("best_date"),
                                   F.round("best_date_revenue", 6).alias("best_date_revenue"))


def sales_report(sales: DataFrame) -> DataFrame:
    """Total revenue, best product, best date and revenue per month as (metric, key, value) rows.

    One grouping-sets pass over the facts gives all four levels; the two best rows come from its
    (already aggregated) products and days as partial maxima.
    """
    s = sales.withColumn("month", F.date_format("date", "yyyy-MM"))
    g = (s.groupingSets([[], ["product_id"], ["date"], ["month"]], "product_id", "date", "month")
         .agg(F.sum("revenue").cast("double").alias("revenue"), F.grouping_id().alias("_g")))
    # grouping_id bits: product 4, date 2, month 1 (1 = rolled up)
    level = F.when(F.col("_g") == 3, "best_product").when(F.col("_g") == 5, "best_date").when(F.col("_g") == 6, "month_revenue").otherwise("total_revenue")
    key = F.coalesce(F.col("product_id").cast("string"), F.date_format("date", "yyyy-MM-dd"), F.col("month"))
    # ties go to the smaller product or the earlier day
    tie = F.coalesce(-F.col("product_id"), -F.datediff("date", F.lit("1970-01-01")).cast("bigint"), F.lit(0).cast("bigint"))
    rows = g.select(level.alias("metric"), key.alias("key"), F.round("revenue", 6).alias("value"), "revenue", tie.alias("tie"))
    rows = rows.withColumn("of", F.when(F.col("metric") == "month_revenue", F.col("key")))
    return (rows.groupBy("metric", "of").agg(F.max(F.struct("revenue", "tie", "key", "value")).alias("m"))
            .select("metric", "m.key", "m.value"))


def _year(date: str, year: int):
    """A range on the date, which reaches the scan (a call of year() does not)."""
    return (F.col(date) >= F.lit(f"{year}-01-01")) & (F.col(date) < F.lit(f"{year + 1}-01-01"))


def top_products(line_sales: DataFrame, part: DataFrame, year: int, k: int = 5) -> DataFrame:
    """Top k products by total sales in a year (the limit is the feature: a top-k report)."""
    y = line_sales.filter(_year("date", year)).groupBy("product_id").agg(F.sum("sales").cast("double").alias("total_sales"))
    known = y.join(part.select(F.col("p_partkey").alias("product_id")), "product_id", "left_semi")
    top = known.orderBy(F.desc("total_sales"), "product_id").limit(k)
    return (F.broadcast(top).join(part.select(F.col("p_partkey").alias("product_id"), "p_name"), "product_id")  # k rows
            .orderBy(F.desc("total_sales"), "product_id"))


def monthly_average(line_sales: DataFrame, year: int) -> DataFrame:
    """Average sale per month of a year."""
    return (line_sales.filter(_year("date", year))
            .groupBy(F.date_format("date", "yyyy-MM").alias("month"))
            .agg((F.sum("sales").cast("double") / F.count(F.lit(1))).alias("avg_sales")))


def many_items_on_one_day(customer, orders, lineitem, part, min_distinct: int = 5) -> DataFrame:
    """Patients (customers) given more than ``min_distinct`` different medications (parts) on one date."""
    j = (lineitem.select("l_orderkey", "l_partkey")
         .join(orders.select("o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
         .join(part.select("p_partkey"), F.col("l_partkey") == F.col("p_partkey"), "left_semi"))
    many = (j.groupBy("o_custkey", F.to_date("o_orderdate").alias("date"))
            .agg(F.countDistinct("l_partkey").alias("n_medications"))
            .filter(F.col("n_medications") > min_distinct))
    return (many.join(customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
            .select("c_custkey", "c_name", "date", "n_medications"))


def stock_questions(prices: DataFrame, ticker: str, ts: str, price: str, order: str) -> DataFrame:
    """Per ticker: latest close, highest close and its day, last day-to-day change.

    Closing price of a day = last price of that day; the change needs ``lag`` over
    the ticker's days, a window partitioned by ticker (never a global order).
    """
    daily = (prices.groupBy(ticker, F.to_date(ts).alias("date"))
             .agg(F.max_by(price, F.struct(F.col(ts), F.col(order))).alias("close")))
    w = Window.partitionBy(ticker).orderBy("date")
    daily = daily.withColumn("change", F.col("close") - F.lag("close").over(w))
    return (daily.groupBy(ticker)
            .agg(F.max("date").alias("latest_date"),
                 F.max_by("close", "date").alias("latest_close"),
                 F.max("close").alias("highest_close"),
                 F.max_by("date", F.struct("close", -F.datediff("date", F.lit("1970-01-01")))).alias("highest_date"),
                 F.max_by("change", "date").alias("last_change")))


def failure_candidates(failures: DataFrame, machine: str, ts: str) -> DataFrame:
    """Per machine: failure count, mean gap between consecutive failures, last failure, expected next failure.

    The consecutive gaps telescope (their sum is last - first), so the mean gap is
    (max - min) / (n - 1): a plain partial aggregate, with no per-machine sort, so a machine
    holding a third of all rows is still reduced map-side.
    """
    e = failures.select(machine, F.unix_micros(F.col(ts).cast("timestamp")).alias("_us"))
    agg = e.groupBy(machine).agg(F.count(F.lit(1)).alias("n_failures"), F.min("_us").alias("_first"), F.max("_us").alias("_last"))
    gap = F.when(F.col("n_failures") > 1, (F.col("_last") - F.col("_first")) / (F.col("n_failures") - 1))
    return agg.select(machine, "n_failures", (gap / 3.6e9).alias("avg_gap_hours"),
                      (F.col("_last") / 1e6).alias("last_failure_epoch"),
                      ((F.col("_last") + gap) / 1e6).alias("next_failure_epoch"))
