"""Group S: whole queries asked for in the examples."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.operators import reports as R
from corpusflow.queries.common import r6, t
from corpusflow.queries.registry import register
from corpusflow.queries.sqlparts import SALES, dsum
from corpusflow.sources.derived import sales

G = "S"
YEAR = 1998


def _line_sales(spark, d):
    li = t(spark, d, "lineitem")
    return li.select(F.col("l_shipdate").alias("date"), F.col("l_partkey").alias("product_id"),
                     (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(38,6)").alias("sales"))


@register("top5_products_by_sales", G, sql=f"""
SELECT l_partkey AS product_id, p_name, {dsum('l_extendedprice * (1 - l_discount)')} AS total_sales
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE year(l_shipdate) = {YEAR}
GROUP BY l_partkey, p_name ORDER BY total_sales DESC, product_id LIMIT 5
""")
def q_top5(spark, d):
    return R.top_products(_line_sales(spark, d), t(spark, d, "part"), YEAR).select("product_id", "p_name", "total_sales")


@register("monthly_average_sales", G, sql=f"""
SELECT strftime(l_shipdate, '%Y-%m') AS month, round({dsum('l_extendedprice * (1 - l_discount)')} / count(*), 6) AS avg_sales
FROM lineitem WHERE year(l_shipdate) = {YEAR} GROUP BY 1
""")
def q_monthly(spark, d):
    return R.monthly_average(_line_sales(spark, d), YEAR).select("month", r6("avg_sales").alias("avg_sales"))


@register("many_items_on_one_day", G, sql="""
SELECT c_custkey, c_name, strftime(o_orderdate, '%Y-%m-%d') AS date, count(DISTINCT p_partkey) AS n_medications
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
GROUP BY c_custkey, c_name, 3 HAVING count(DISTINCT p_partkey) > 5
""")
def q_many_items(spark, d):
    r = R.many_items_on_one_day(*(t(spark, d, n) for n in ("customer", "orders", "lineitem", "part")))
    return r.select("c_custkey", "c_name", F.date_format("date", "yyyy-MM-dd").alias("date"), "n_medications")


@register("sales_report", G, sql=f"""
WITH {SALES},
p AS (SELECT product_id, CAST(sum(revenue) AS DOUBLE) AS rev FROM sales GROUP BY 1),
d AS (SELECT date, CAST(sum(revenue) AS DOUBLE) AS rev FROM sales GROUP BY 1)
SELECT 'total_revenue' AS metric, NULL::VARCHAR AS key, CAST(sum(revenue) AS DOUBLE) AS value FROM sales
UNION ALL SELECT 'month_revenue', strftime(date, '%Y-%m'), CAST(sum(revenue) AS DOUBLE) FROM sales GROUP BY 2
UNION ALL (SELECT 'best_product', CAST(product_id AS VARCHAR), rev FROM p ORDER BY rev DESC, product_id LIMIT 1)
UNION ALL (SELECT 'best_date', strftime(date, '%Y-%m-%d'), rev FROM d ORDER BY rev DESC, date LIMIT 1)
""")
def q_sales_report(spark, d):
    return R.sales_report(sales(t(spark, d, "lineitem"), t(spark, d, "part")))


@register("stock_price_questions", G, sql="""
WITH r AS (SELECT user_id AS ticker, CAST(ts AS DATE) AS date, value,
                  row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn FROM events),
daily AS (SELECT ticker, date, value AS close FROM r WHERE rn = 1),
ch AS (SELECT *, close - lag(close) OVER (PARTITION BY ticker ORDER BY date) AS change,
              row_number() OVER (PARTITION BY ticker ORDER BY close DESC, date) AS hi,
              row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS lt FROM daily)
SELECT ticker, strftime(max(date), '%Y-%m-%d') AS latest_date, max(close) FILTER (WHERE lt = 1) AS latest_close,
       max(close) AS highest_close, strftime(max(date) FILTER (WHERE hi = 1), '%Y-%m-%d') AS highest_date,
       round(max(change) FILTER (WHERE lt = 1), 6) AS last_change
FROM ch GROUP BY ticker
""")
def q_stocks(spark, d):
    ev = t(spark, d, "events").select(F.col("user_id").alias("ticker"), "ts", "value", "event_id")
    r = R.stock_questions(ev, "ticker", "ts", "value", "event_id")
    return r.select("ticker", F.date_format("latest_date", "yyyy-MM-dd").alias("latest_date"), "latest_close", "highest_close",
                    F.date_format("highest_date", "yyyy-MM-dd").alias("highest_date"), r6("last_change").alias("last_change"))


@register("hotel_lookup", G, sql="""
SELECT s_suppkey, s_name, n_name, s_acctbal FROM supplier JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE' AND s_acctbal > 0
ORDER BY s_acctbal DESC, s_suppkey LIMIT 10
""")
def q_hotels(spark, d):
    s, n, r = (t(spark, d, x) for x in ("supplier", "nation", "region"))
    j = (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
         .filter((F.col("r_name") == "EUROPE") & (F.col("s_acctbal") > 0)))
    return j.select("s_suppkey", "s_name", "n_name", "s_acctbal").orderBy(F.desc("s_acctbal"), "s_suppkey").limit(10)


@register("open_claims", G, sql="""
SELECT o_orderkey AS claim_id, c_name AS holder, o_totalprice AS amount FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus = 'O'
""")
def q_open_claims(spark, d):
    o = t(spark, d, "orders").filter(F.col("o_orderstatus") == "O")
    c = t(spark, d, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(F.col("o_orderkey").alias("claim_id"), F.col("c_name").alias("holder"),
                                                        F.col("o_totalprice").alias("amount"))


@register("next_failure_candidates", G, sql="""
WITH e AS (SELECT user_id, epoch_us(ts) AS us FROM events WHERE event_type = 'error'),
g AS (SELECT user_id, us, us - lag(us) OVER (PARTITION BY user_id ORDER BY us) AS gap FROM e)
SELECT user_id, count(*) AS n_failures, round(avg(gap) / 3.6e9, 6) AS avg_gap_hours,
       round(max(us) / 1e6, 3) AS last_failure_epoch, round((max(us) + avg(gap)) / 1e6, 3) AS next_failure_epoch
FROM g GROUP BY user_id
""")
def q_failures(spark, d):
    ev = t(spark, d, "events").filter(F.col("event_type") == "error")
    r = R.failure_candidates(ev, "user_id", "ts")
    return r.select("user_id", "n_failures", r6("avg_gap_hours").alias("avg_gap_hours"),
                    F.round("last_failure_epoch", 3).alias("last_failure_epoch"),
                    F.round("next_failure_epoch", 3).alias("next_failure_epoch"))
