"""Window analytics over sales, orders and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions.measures import mean, total
from tidewell.operators import windows
from tidewell.plans.oracle_views import EVENTS, ORDERS, SALES, USER_CHANGES, davg, dsum, with_views
from tidewell.plans.registry import query

TIES = ["session_id", "line", "product_id", "supplier_id", "total_amount"]
SALES_COLUMNS = ("user_id", "timestamp", "total_amount", "session_id", "line", "product_id", "supplier_id")
ORDER = "timestamp, session_id, line, product_id, supplier_id, total_amount"
OUT = "user_id, timestamp, total_amount, session_id, line, product_id, supplier_id"


@query("win_01_purchase_sequence", with_views(SALES) + f"""
, w AS (SELECT {OUT}, ROW_NUMBER() OVER o AS user_order_number, LAG(total_amount) OVER o AS previous_purchase, LEAD(total_amount) OVER o AS next_purchase
  FROM sales WINDOW o AS (PARTITION BY user_id ORDER BY {ORDER}))
SELECT *, user_order_number = 1 AS is_first_purchase,
  CASE WHEN previous_purchase IS NOT NULL THEN ROUND((total_amount - previous_purchase) / previous_purchase * 100, 2) + 0.0::DOUBLE ELSE 0 END AS purchase_growth FROM w""")
def win_01(t):
    return windows.purchase_sequence(t.sales(*SALES_COLUMNS), TIES)


@query("win_02_ranked_orders", with_views(SALES) + """
SELECT category, strftime(timestamp, '%Y-%m-%d') AS date, total_amount, session_id, line, product_id, supplier_id,
  RANK() OVER (PARTITION BY category ORDER BY total_amount DESC) AS category_rank,
  DENSE_RANK() OVER (PARTITION BY CAST(timestamp AS DATE) ORDER BY total_amount DESC) AS daily_rank FROM sales""")
def win_02(t):
    sales = t.sales("category", "timestamp", "total_amount", "session_id", "line", "product_id", "supplier_id")
    sales = sales.withColumn("date", F.date_format("timestamp", "yyyy-MM-dd")).drop("timestamp")
    return windows.ranked_orders(sales, ["session_id", "line", "product_id", "supplier_id"])


@query("win_03_running_total", with_views(SALES) + f"""
SELECT {OUT}, CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) OVER (o ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total,
  ROW_NUMBER() OVER o AS order_sequence, LAG(total_amount) OVER o AS previous_order_value, LEAD(total_amount) OVER o AS next_order_value
FROM sales WHERE user_id IN (SELECT user_id FROM sales GROUP BY user_id HAVING COUNT(*) >= 40)
WINDOW o AS (PARTITION BY user_id ORDER BY {ORDER})""")
def win_03(t):
    return windows.running_total(t.sales(*SALES_COLUMNS), 40, TIES)


@query("win_04_moving_avg", """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) / COUNT(*) OVER w AS moving_avg
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def win_04(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return windows.moving_avg(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice", 3).drop("o_orderdate")


@query("win_05_cumulative_clv", with_views(EVENTS) + """
, h AS (SELECT user_id, date_trunc('hour', event_time) AS window_start, SUM(CAST(total_amount AS DECIMAL(18,2))) AS b FROM ev WHERE action = 'purchase' GROUP BY 1, 2)
SELECT user_id, window_start, CAST(b AS DOUBLE) AS bucket_amount, CAST(SUM(b) OVER (o ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cumulative_clv,
  COUNT(*) OVER (o ROWS UNBOUNDED PRECEDING) AS total_transactions,
  CAST(SUM(b) OVER (o ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS DOUBLE) / COUNT(*) OVER (o ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS recent_avg_order_value
FROM h WINDOW o AS (PARTITION BY user_id ORDER BY window_start)""")
def win_05(t):
    return windows.cumulative_clv(t.events)


@query("win_06_share_of_partition", with_views(SALES) + f"""
, r AS (SELECT region, category, {dsum('total_amount')} AS revenue FROM sales GROUP BY 1, 2)
SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY region ORDER BY revenue DESC, category) AS rank,
  CAST(SUM(CAST(revenue AS DECIMAL(18,2))) OVER (PARTITION BY region) AS DOUBLE) AS partition_total,
  revenue / CAST(SUM(CAST(revenue AS DECIMAL(18,2))) OVER (PARTITION BY region) AS DOUBLE) * 100 AS share_pct FROM r) WHERE rank <= 3""")
def win_06(t):
    revenue = t.sales("region", "category", "total_amount").groupBy("region", "category").agg(total("total_amount").alias("revenue"))
    return windows.share_of_partition(revenue, "region", "revenue", 3, ["category"])


@query("win_07_daily_trend", with_views(ORDERS) + f"""
, d AS (SELECT CAST(order_date AS DATE) AS order_date, COUNT(*) AS daily_orders, {dsum('amount')} AS daily_revenue, {davg('amount')} AS avg_order_value,
  COUNT(DISTINCT user_id) AS unique_customers FROM user_orders WHERE status = 'completed' GROUP BY 1),
l AS (SELECT *, LAG(daily_revenue) OVER (ORDER BY order_date) AS prev_day_revenue,
  CAST(SUM(CAST(daily_revenue AS DECIMAL(18,2))) OVER w AS DOUBLE) / COUNT(*) OVER w AS three_day_avg FROM d WINDOW w AS (ORDER BY order_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
SELECT *, CASE WHEN prev_day_revenue IS NULL THEN 'N/A' WHEN daily_revenue > prev_day_revenue THEN 'Up' WHEN daily_revenue < prev_day_revenue THEN 'Down' ELSE 'Same' END AS revenue_trend FROM l""")
def win_07(t):
    return windows.daily_trend(t.user_orders)


@query("win_08_terciles", with_views(ORDERS) + f"""
, c AS (SELECT user_id, COUNT(*) AS total_orders, {dsum('amount')} AS total_spent, date_diff('day', MIN(order_date), MAX(order_date)) AS customer_lifetime_days
  FROM user_orders WHERE status = 'completed' GROUP BY 1),
s AS (SELECT *, NTILE(3) OVER (ORDER BY total_spent DESC, user_id) AS spending_tercile, NTILE(3) OVER (ORDER BY total_orders DESC, user_id) AS frequency_tercile FROM c)
SELECT *, CASE spending_tercile WHEN 1 THEN 'High Spender' WHEN 2 THEN 'Medium Spender' ELSE 'Low Spender' END AS spending_segment,
  CASE frequency_tercile WHEN 1 THEN 'High Frequency' WHEN 2 THEN 'Medium Frequency' ELSE 'Low Frequency' END AS frequency_segment,
  CASE WHEN customer_lifetime_days = 0 THEN 'Single Purchase' WHEN customer_lifetime_days <= 7 THEN 'New Customer'
    WHEN customer_lifetime_days <= 30 THEN 'Regular Customer' ELSE 'Loyal Customer' END AS lifecycle_stage FROM s""")
def win_08(t):
    customers = t.user_orders.filter("status = 'completed'").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_orders"), total("amount").alias("total_spent"),
        F.datediff(F.max("order_date"), F.min("order_date")).alias("customer_lifetime_days"),
    )
    return windows.terciles(customers)


@query("win_09_spending_rank", with_views(SALES) + f"""
, u AS (SELECT user_id, COUNT(*) AS total_orders, {dsum('total_amount')} AS total_spent, {davg('total_amount')} AS avg_order_value FROM sales GROUP BY 1)
SELECT *, ROW_NUMBER() OVER (ORDER BY total_spent DESC, user_id) AS spending_rank,
  CASE WHEN total_spent >= 1000 THEN 'High Value' WHEN total_spent >= 500 THEN 'Medium Value' ELSE 'Low Value' END AS customer_tier FROM u""")
def win_09(t):
    return windows.spending_rank(t.sales("user_id", "total_amount"))


@query("win_09_peak_hours", with_views(EVENTS) + f"""
SELECT *, RANK() OVER (ORDER BY total_revenue DESC) AS revenue_rank
FROM (SELECT hour(event_time) AS hour, COUNT(*) AS total_transactions, {dsum('total_amount')} AS total_revenue FROM ev GROUP BY 1)""")
def win_09b(t):
    return windows.peak_hours(t.events, "event_time")


@query("win_10_change_events", with_views(USER_CHANGES) + """
, l AS (SELECT *, LAG(user_status) OVER w AS ps, LAG(user_tier) OVER w AS pt, LAG(total_spent) OVER w AS pa FROM user_changes
  WINDOW w AS (PARTITION BY user_id ORDER BY version))
SELECT user_id, version, ps AS previous_status, pt AS previous_tier, pa AS previous_spent,
  CASE WHEN user_status <> ps THEN 'STATUS_CHANGE' WHEN user_tier <> pt THEN 'TIER_CHANGE' WHEN total_spent - COALESCE(pa, 0) > 400 THEN 'HIGH_VALUE_PURCHASE' ELSE 'UPDATE' END AS event_type,
  CASE WHEN user_status <> ps THEN 'Status changed from ' || ps || ' to ' || user_status WHEN user_tier <> pt THEN 'Tier changed from ' || pt || ' to ' || user_tier
    WHEN total_spent - COALESCE(pa, 0) > 400 THEN 'High value purchase detected' ELSE 'Regular update' END AS change_reason FROM l""")
def win_10(t):
    out = windows.change_events(
        t.user_changes, "user_id", ["version"], {"user_status": "STATUS_CHANGE", "user_tier": "TIER_CHANGE"}, "total_spent", 400
    )
    previous = F.col("previous_state")
    return out.select(
        "user_id", "version", previous["user_status"].alias("previous_status"), previous["user_tier"].alias("previous_tier"),
        previous["total_spent"].alias("previous_spent"), "event_type", "change_reason",
    )


@query("win_11_position_stats", """
SELECT o_orderkey, o_orderpriority, o_totalprice, percent_rank() OVER w AS percent_rank, cume_dist() OVER w AS cume_dist,
  first_value(o_totalprice) OVER f AS first_value, last_value(o_totalprice) OVER f AS last_value, nth_value(o_totalprice, 2) OVER f AS nth_value
FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_totalprice),
  f AS (PARTITION BY o_orderpriority ORDER BY o_totalprice, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def win_11(t):
    return windows.position_stats(
        t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), ["o_orderpriority"], "o_totalprice", ["o_orderkey"]
    )


@query("win_12_daily_growth", with_views(SALES) + f"""
, c AS (SELECT region, category, date_trunc('day', timestamp) AS period, {dsum('total_amount')} AS r, COUNT(*) AS n, CAST(SUM(quantity) AS BIGINT) AS q FROM sales GROUP BY ALL),
b AS (SELECT region, category, UNNEST(generate_series(MIN(period), MAX(period), INTERVAL 1 DAY)) AS period FROM c GROUP BY 1, 2),
f AS (SELECT b.region, b.category, b.period, COALESCE(r, 0) AS revenue_sum, COALESCE(n, 0) AS revenue_count, COALESCE(q, 0) AS quantity_sum
  FROM b LEFT JOIN c ON b.region = c.region AND b.category = c.category AND b.period = c.period)
SELECT *, ROUND((revenue_sum - LAG(revenue_sum) OVER w) / NULLIF(LAG(revenue_sum) OVER w, 0), 4) + 0.0::DOUBLE AS revenue_growth
FROM f WINDOW w AS (PARTITION BY region, category ORDER BY period)""")
def win_12(t):
    return windows.daily_growth(t.sales("region", "category", "timestamp", "total_amount", "quantity"), ["region", "category"])
