"""Cleaning, joins and aggregates over the sales tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions import tiers
from tidewell.operators import aggregates as agg
from tidewell.operators import clean, enrich, joins, ordering
from tidewell.plans.oracle_views import EVENTS, ORDERS, PRODUCTS, SALES, USERS, davg, dsum, with_views
from tidewell.plans.registry import query

AS_OF = "2001-12-01"
CLEAN_COLUMNS = ("user_id", "product_id", "category", "action", "timestamp", "price", "quantity", "session_id", "line", "supplier_id")
SALES_CLEAN = """clean AS (
  SELECT DISTINCT user_id, product_id, upper(trim(category)) AS category, lower(trim(action)) AS action, timestamp,
    price, quantity, session_id, line, supplier_id, ROUND(price * quantity, 2) AS total_amount,
    strftime(timestamp, '%Y-%m-%d') AS date, hour(timestamp) AS hour
  FROM sales WHERE price > 0 AND quantity > 0)"""
FACT = """fact AS (
  SELECT *, CAST(CAST(total_amount AS DECIMAL(18,2)) - discount_amount AS DECIMAL(18,4)) AS final_amount,
    CAST(CAST(CAST(total_amount AS DECIMAL(18,2)) - discount_amount AS DECIMAL(18,4)) * 0.30 AS DECIMAL(18,6)) AS estimated_profit
  FROM (SELECT CAST(user_id AS VARCHAR) AS customer_id, category, timestamp, product_id, session_id, line, supplier_id, quantity,
    ROUND(price * quantity, 2) AS total_amount, strftime(timestamp, '%Y-%m-%d') AS sale_date,
    CAST(CASE WHEN ROUND(price * quantity, 2) > 1000 THEN CAST(ROUND(price * quantity, 2) AS DECIMAL(18,2)) * 0.10
      WHEN ROUND(price * quantity, 2) > 500 THEN CAST(ROUND(price * quantity, 2) AS DECIMAL(18,2)) * 0.05 ELSE 0 END AS DECIMAL(18,4)) AS discount_amount
    FROM sales WHERE price > 0 AND quantity > 0))"""


def _sales(t, *columns):
    return t.sales(*columns)


def _clean(t):
    return clean.clean_sales(t.sales(*CLEAN_COLUMNS))


def _fact(t):
    return clean.sales_fact(
        t.sales("user_id", "category", "timestamp", "price", "quantity", "product_id", "session_id", "line", "supplier_id")
    )


# --- cleaning and projection -------------------------------------------------

@query("prj_01_clean_sales", with_views(SALES, SALES_CLEAN) + "SELECT * FROM clean")
def prj_01(t):
    return _clean(t)


@query("prj_02_sales_fact", with_views(SALES, FACT) + """
SELECT customer_id, category, sale_date, product_id, session_id, line, supplier_id, quantity, total_amount,
  CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(final_amount AS DOUBLE) AS final_amount,
  CAST(estimated_profit AS DOUBLE) AS estimated_profit, 'ORD-' || strftime(timestamp, '%Y%m%d') AS order_day
FROM fact""")
def prj_02(t):
    return _fact(t).select(
        "customer_id", "category", "sale_date", "product_id", "session_id", "line", "supplier_id", "quantity", "total_amount",
        "discount_amount", "final_amount", "estimated_profit",
        F.regexp_extract("order_id", r"^(ORD-\d{8})-\d+$", 1).alias("order_day"),
    )


@query("prj_03_customer_dim", f"""
WITH base AS (
  SELECT c_custkey AS customer_id, c_name AS full_name, lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example' AS email,
    '+1 (' || (100 + c_nationkey) || ') ' || c_custkey AS phone, c_acctbal AS lifetime_value,
    MIN(o_orderdate) AS registration_date, MAX(o_orderdate) AS last_login
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY ALL),
days AS (SELECT *, date_diff('day', CAST(registration_date AS DATE), DATE '{AS_OF}') AS days_since_registration,
  date_diff('day', CAST(last_login AS DATE), DATE '{AS_OF}') AS days_since_last_login FROM base)
SELECT customer_id, upper(substr(full_name, 1, 1)) || lower(substr(full_name, 2)) AS full_name_clean,
  regexp_extract(email, '@(.+)', 1) AS email_domain, regexp_replace(phone, '[^0-9]', '', 'g') AS phone_clean,
  days_since_registration, days_since_last_login,
  CASE WHEN days_since_registration < 30 THEN 'New' WHEN days_since_registration < 365 THEN 'Regular' ELSE 'Veteran' END AS customer_age_category,
  CASE WHEN days_since_last_login <= 7 THEN 'Highly Active' WHEN days_since_last_login <= 30 THEN 'Active'
    WHEN days_since_last_login <= 90 THEN 'Inactive' ELSE 'Dormant' END AS activity_status,
  CASE WHEN lifetime_value >= 1000 THEN 'High Value' WHEN lifetime_value >= 500 THEN 'Medium Value' ELSE 'Low Value' END AS lifetime_value_tier
FROM days""")
def prj_03(t):
    seen = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("registration_date"), F.max("o_orderdate").alias("last_login"))
    base = t.customer.join(seen, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@"), F.lower("c_mktsegment"), F.lit(".example")).alias("email"),
        F.concat(F.lit("+1 ("), F.col("c_nationkey") + 100, F.lit(") "), "c_custkey").alias("phone"),
        F.col("c_acctbal").alias("lifetime_value"), "registration_date", "last_login",
    )
    return clean.customer_dim(base, AS_OF).select(
        "customer_id", "full_name_clean", "email_domain", "phone_clean", "days_since_registration", "days_since_last_login",
        "customer_age_category", "activity_status", "lifetime_value_tier",
    )


@query("prj_04_product_dim", f"""
SELECT p_partkey AS product_id,
  CASE WHEN p_size % 9 = 0 THEN NULL ELSE 0 END IS NULL AS no_cost,
  CASE WHEN p_retailprice >= 500 THEN 'Premium' WHEN p_retailprice >= 100 THEN 'Standard' ELSE 'Budget' END AS price_tier,
  CASE WHEN p_size - 1 = 0 THEN 'Out of Stock' WHEN p_size - 1 < 10 THEN 'Low Stock' WHEN p_size - 1 < 50 THEN 'Medium Stock' ELSE 'High Stock' END AS availability_status,
  CAST(p_size * 30 AS INTEGER) AS product_age_days,
  CASE WHEN p_size * 30 < 30 THEN 'New Launch' WHEN p_size * 30 < 365 THEN 'Current' WHEN p_size * 30 < 1095 THEN 'Mature' ELSE 'Legacy' END AS product_lifecycle,
  substr(p_brand, 1, 3) AS sku_category,
  CASE WHEN p_size / 8.0 < 1 THEN 'Light' WHEN p_size / 8.0 < 5 THEN 'Medium' ELSE 'Heavy' END AS weight_category
FROM part""")
def prj_04(t):
    base = t.part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("sku"),
        F.when(F.col("p_size") % 9 == 0, 0.0).otherwise(F.col("p_retailprice") * 0.7).alias("cost_price"),
        F.col("p_retailprice").alias("retail_price"), (F.col("p_size") - 1).alias("stock_quantity"),
        F.expr(f"date_sub(date'{AS_OF}', p_size * 30)").alias("created_date"), (F.col("p_size") / 8.0).alias("weight_kg"),
    )
    return clean.product_dim(base, AS_OF).select(
        "product_id", F.col("markup_percentage").isNull().alias("no_cost"), "price_tier", "availability_status",
        "product_age_days", "product_lifecycle", "sku_category", "weight_category",
    )


@query("prj_05_web_fact", """
WITH visits AS (
  SELECT event_id, ts, CASE WHEN k % 5 = 0 THEN 'https://google.example/q' WHEN k % 5 = 1 THEN 'https://facebook.example/p'
      WHEN k % 5 = 2 THEN 'direct' WHEN k % 5 = 3 THEN 'email' ELSE 'https://other.example' END AS referrer,
    CASE WHEN k % 3 = 0 THEN 'mobile' WHEN k % 3 = 1 THEN 'tablet' ELSE 'pc' END AS device_type,
    '/' || event_type || '/' || k AS page_url, value AS duration_seconds
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))
SELECT event_id, strftime(ts, '%Y-%m-%d') AS session_date, hour(ts) AS session_hour,
  CASE WHEN duration_seconds < 30 THEN 'Quick View' WHEN duration_seconds < 120 THEN 'Browse' WHEN duration_seconds < 300 THEN 'Engaged' ELSE 'Deep Dive' END AS duration_category,
  CASE WHEN referrer LIKE '%google%' THEN 'Search' WHEN referrer LIKE '%facebook%' THEN 'Social' WHEN referrer = 'direct' THEN 'Direct' WHEN referrer = 'email' THEN 'Email' ELSE 'Other' END AS traffic_source,
  CASE WHEN device_type = 'mobile' THEN 'Mobile' WHEN device_type = 'tablet' THEN 'Tablet' ELSE 'Desktop' END AS device_category,
  regexp_extract(page_url, '/([^/]+)/', 1) AS page_category, dayofweek(ts) IN (0, 6) AS is_weekend
FROM visits""")
def prj_05(t):
    k = F.get_json_object("props", "$.k").cast("long")
    visits = t.read("events").select(
        "event_id", F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(k % 5 == 0, "https://google.example/q").when(k % 5 == 1, "https://facebook.example/p")
        .when(k % 5 == 2, "direct").when(k % 5 == 3, "email").otherwise("https://other.example").alias("referrer"),
        F.when(k % 3 == 0, "mobile").when(k % 3 == 1, "tablet").otherwise("pc").alias("device_type"),
        F.concat(F.lit("/"), "event_type", F.lit("/"), k).alias("page_url"), F.col("value").alias("duration_seconds"),
    )
    return clean.web_fact(visits).drop("timestamp", "referrer", "device_type", "page_url", "duration_seconds")


@query("prj_06_enrich_event", with_views(EVENTS) + """
SELECT event_id, action, total_amount AS value, true AS enriched,
  CASE WHEN action IN ('view', 'search') THEN 'browse' WHEN action IN ('add_to_cart', 'remove_from_cart') THEN 'cart'
    WHEN action = 'purchase' THEN 'transaction' ELSE 'other' END AS action_category,
  CASE WHEN total_amount < 50 THEN 'low' WHEN total_amount < 200 THEN 'medium' ELSE 'high' END AS value_tier
FROM ev""")
def prj_06(t):
    return enrich.enrich_event(t.events.select("event_id", "action", F.col("total_amount").alias("value")))


@query("prj_07_filter_events", with_views(EVENTS) + """
SELECT event_id, action, total_amount AS value FROM ev WHERE total_amount >= 40 AND action IN ('purchase', 'view')""")
def prj_07(t):
    return enrich.filter_events(t.events.select("event_id", "action", F.col("total_amount").alias("value")), 40, ["purchase", "view"])


@query("prj_08_route_events", with_views(EVENTS) + """
SELECT event_id, action, total_amount AS value,
  CASE WHEN action = 'purchase' OR total_amount > 100 THEN 'high' ELSE 'normal' END AS priority,
  CASE WHEN action = 'purchase' THEN 'transactions' WHEN total_amount > 100 THEN 'high_value'
    WHEN action IN ('view', 'search') THEN 'analytics' ELSE 'general' END AS route
FROM ev""")
def prj_08(t):
    return enrich.route_events(t.events.select("event_id", "action", F.col("total_amount").alias("value")))


@query("prj_09_change_topics", """
SELECT table_name, CASE table_name WHEN 'customer' THEN 'users' WHEN 'orders' THEN 'orders' ELSE 'other' END AS topic, n AS records
FROM (SELECT 'customer' AS table_name, COUNT(*) AS n FROM customer UNION ALL SELECT 'orders', COUNT(*) FROM orders
  UNION ALL SELECT 'supplier', COUNT(*) FROM supplier)""")
def prj_09(t):
    records = [t.read(n).select(F.lit(n).alias("table_name")) for n in ("customer", "orders", "supplier")]
    changes = records[0].union(records[1]).union(records[2])
    return enrich.change_topic(changes, {"customer": "users", "orders": "orders"}).groupBy("table_name", "topic").agg(
        agg.rows().alias("records")
    )


@query("prj_10_conditional_samples", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS INTEGER) AS value,
  CASE WHEN CAST(l_quantity AS INTEGER) % 2 = 0 THEN 'Even' ELSE 'Odd' END AS even_or_odd,
  CASE WHEN l_quantity > 5 THEN 'Large' ELSE 'Small' END AS size_category,
  COALESCE(NULLIF(CAST(l_quantity AS INTEGER), 5), 999) AS coalesced,
  10 / NULLIF(CAST(l_quantity AS INTEGER) - 5, 0) AS safe_division
FROM lineitem""")
def prj_10(t):
    df = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("int").alias("value"))
    return clean.conditional_samples(df, "value")


@query("prj_11_predicates", with_views(ORDERS) + f"""
SELECT order_id, user_id, status, amount, payment_method FROM user_orders
WHERE order_date >= DATE '{AS_OF}' - INTERVAL 1200 DAY AND status IN ('completed', 'shipped') AND amount BETWEEN 1000 AND 400000
  AND payment_method LIKE '%-%' AND payment_method NOT LIKE '%LOW%'
  AND (regexp_matches(payment_method, '^[12]-') OR amount IS NULL OR amount > 250000)""")
def prj_11(t):
    return clean.predicates(t.user_orders, AS_OF, 1200).select("order_id", "user_id", "status", "amount", "payment_method")


@query("prj_12_repeat_buyers", with_views(ORDERS) + """
SELECT order_id, user_id, amount FROM user_orders
WHERE user_id IN (SELECT user_id FROM user_orders GROUP BY user_id HAVING COUNT(*) >= 12)""")
def prj_12(t):
    return clean.repeat_buyers(t.user_orders.select("order_id", "user_id", "amount"), 12)


@query("prj_13_derived_chain", with_views(SALES) + f""", per_user AS (
  SELECT region, user_id, {dsum('total_amount')} AS spent FROM sales GROUP BY region, user_id),
big AS (SELECT region, spent FROM per_user WHERE spent > 1000000)
SELECT region, COUNT(*) AS big_spenders, MAX(spent) AS best FROM big GROUP BY region""")
def prj_13(t):
    per_user = t.sales("region", "user_id", "total_amount").groupBy("region", "user_id").agg(agg.total("total_amount").alias("spent"))
    return per_user.filter("spent > 1000000").groupBy("region").agg(agg.rows().alias("big_spenders"), F.max("spent").alias("best"))


@query("prj_14_literal_rows", """
WITH status(code, label, open) AS (VALUES ('O', 'completed', false), ('F', 'shipped', false), ('P', 'pending', true))
SELECT label, open, COUNT(*) AS orders FROM orders JOIN status ON o_orderstatus = code GROUP BY label, open""")
def prj_14(t):
    lookup = clean.literal_rows(
        t.spark, [("O", "completed", False), ("F", "shipped", False), ("P", "pending", True)], "code string, label string, open boolean"
    )
    return t.orders.join(lookup, F.col("o_orderstatus") == F.col("code")).groupBy("label", "open").agg(agg.rows().alias("orders"))


@query("prj_15_mask_columns", """
SELECT sha256(c_name) AS c_name, regexp_replace(CAST(c_custkey + 1000000 AS VARCHAR), '.', '*', '') AS first_hidden,
  repeat('*', length(CAST(c_custkey + 1000000 AS VARCHAR)) - 4) || right(CAST(c_custkey + 1000000 AS VARCHAR), 4) AS account,
  '***@' || lower(c_mktsegment) || '.example' AS email
FROM customer""")
def prj_15(t):
    df = t.customer.select(
        "c_name", (F.col("c_custkey") + 1000000).alias("account"), "c_acctbal",
        F.concat(F.lit("u"), "c_custkey", F.lit("@"), F.lower("c_mktsegment"), F.lit(".example")).alias("email"),
        F.concat(F.lit("*"), F.expr("substring(cast(c_custkey + 1000000 as string), 2)")).alias("first_hidden"),
    )
    return clean.mask_columns(df, {"c_name": "hash", "account": "partial", "email": "email", "c_acctbal": "drop"})


# --- joins ---------------------------------------------------------------------

@query("join_01_top_customers", with_views(SALES, USERS) + f"""
SELECT s.user_id, name, u.country, tier, balance, u.is_premium, COUNT(*) AS total_orders, {dsum('total_amount')} AS total_spent,
  {davg('total_amount')} AS avg_order_value
FROM sales s JOIN users u ON s.user_id = u.user_id GROUP BY s.user_id, name, u.country, tier, balance, u.is_premium
ORDER BY total_spent DESC, s.user_id LIMIT 20""")
def join_01(t):
    return joins.top_customers(t.sales("user_id", "total_amount"), t.users, 20)


@query("join_02_product_performance", with_views(SALES, PRODUCTS) + f"""
, perf AS (SELECT p.product_id, name, p.category, base_price, COUNT(s.product_id) AS times_sold, CAST(SUM(s.quantity) AS BIGINT) AS total_quantity_sold,
  {dsum('s.total_amount')} AS total_revenue, ROUND(AVG(s.price), 4) AS avg_selling_price
FROM products p LEFT JOIN sales s ON p.product_id = s.product_id GROUP BY ALL HAVING COUNT(s.product_id) > 0)
SELECT *, ROUND((avg_selling_price - base_price) / base_price * 100, 4) AS price_markup_pct FROM perf
ORDER BY total_revenue DESC, product_id LIMIT 50""")
def join_02(t):
    products = t.products.select("product_id", "name", "category", "base_price")
    return joins.product_performance(products, t.sales("product_id", "quantity", "total_amount", "price"), 50)


@query("join_03_join_on_live", with_views(USERS, ORDERS) + f"""
SELECT u.user_id, name, COUNT(order_id) AS order_count, COALESCE({dsum('amount')}, 0) AS total_spent, MAX(order_date) AS last_order_date
FROM users u LEFT JOIN user_orders o ON u.user_id = o.user_id AND status IN ('completed', 'shipped') GROUP BY ALL""")
def join_03(t):
    return joins.join_on_live(t.users.select("user_id", "name"), t.user_orders, ["completed", "shipped"])


@query("join_03_completed_only", with_views(USERS, ORDERS) + f"""
SELECT u.user_id, name, COUNT(order_id) AS order_count, COALESCE({dsum('amount')}, 0) AS total_spent, MAX(order_date) AS last_order_date
FROM users u LEFT JOIN user_orders o ON u.user_id = o.user_id WHERE status = 'completed' GROUP BY ALL""")
def join_03b(t):
    return joins.completed_only(t.users.select("user_id", "name"), t.user_orders, "completed")


@query("join_04_full_outer_reconcile", """
WITH a AS (SELECT o_custkey AS user_id, COUNT(*) AS orders FROM orders GROUP BY 1),
b AS (SELECT user_id, COUNT(*) AS events FROM events GROUP BY 1)
SELECT COALESCE(a.user_id, b.user_id) AS user_id, orders, events,
  CASE WHEN a.user_id IS NULL THEN 'right_only' WHEN b.user_id IS NULL THEN 'left_only' ELSE 'both' END AS presence
FROM a FULL OUTER JOIN b ON a.user_id = b.user_id""")
def join_04(t):
    a = t.orders.groupBy(F.col("o_custkey").alias("user_id")).agg(agg.rows().alias("orders"))
    b = t.read("events").groupBy("user_id").agg(agg.rows().alias("events"))
    return joins.full_outer_reconcile(a, b, ["user_id"])


@query("join_05_cross_one_row", """
SELECT old_n, new_n, new_n - old_n AS grown FROM (SELECT COUNT(*) AS old_n FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
(SELECT COUNT(*) AS new_n FROM orders)""")
def join_05(t):
    old = t.orders.filter("o_orderdate < timestamp_ntz'1998-01-01 00:00:00'").agg(agg.rows().alias("old_n"))
    return joins.cross_one_row(old, t.orders.agg(agg.rows().alias("new_n"))).withColumn("grown", F.col("new_n") - F.col("old_n"))


@query("join_06_broadcast_join", with_views(SALES, USERS) + f"""
SELECT s.category, u.country, COUNT(*) AS order_count, {dsum('total_amount')} AS total_revenue
FROM sales s JOIN users u ON s.user_id = u.user_id GROUP BY s.category, u.country""")
def join_06(t):
    joined = joins.broadcast_join(t.sales("user_id", "category", "total_amount"), t.users.select("user_id", "country"), ["user_id"])
    return joined.groupBy("category", "country").agg(agg.rows().alias("order_count"), agg.total("total_amount").alias("total_revenue"))


@query("join_07_semi", """
SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)""")
def join_07(t):
    big = t.orders.filter("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.semi(t.customer.select("c_custkey", "c_name"), big, ["c_custkey"])


@query("join_07_anti", """
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')""")
def join_07b(t):
    shipped = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.anti(t.customer.select("c_custkey", "c_name"), shipped, ["c_custkey"])


@query("join_09_join_aggregate", with_views(PRODUCTS, SALES) + f"""
SELECT p.product_id, p.inventory, CAST(SUM(quantity) AS BIGINT) AS ordered, {dsum('total_amount')} AS revenue,
  p.inventory - COALESCE(CAST(SUM(quantity) AS BIGINT), 0) AS remaining
FROM products p LEFT JOIN sales s ON p.product_id = s.product_id AND action IN ('O', 'F') GROUP BY p.product_id, p.inventory""")
def join_09(t):
    sold = t.sales("product_id", "quantity", "total_amount", "action").filter(F.col("action").isin("O", "F"))
    out = joins.join_aggregate(
        t.products.select("product_id", "inventory"), sold, "product_id", ordered=F.sum("quantity"), revenue=agg.total("total_amount")
    )
    return out.withColumn("remaining", F.col("inventory") - F.coalesce("ordered", F.lit(0)))


@query("join_10_link_lookup", """
SELECT DISTINCT l_partkey AS part, l_suppkey AS supplier, p_name AS part_name, s_name AS supplier_name
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""")
def join_10(t):
    links = t.lineitem.select(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier")).distinct()
    nodes = t.part.select(F.concat(F.lit("p"), "p_partkey").alias("id"), F.col("p_name").alias("name")).unionByName(
        t.supplier.select(F.concat(F.lit("s"), "s_suppkey").alias("id"), F.col("s_name").alias("name"))
    )
    links = links.select(F.concat(F.lit("p"), "part").alias("part"), F.concat(F.lit("s"), "supplier").alias("supplier"))
    out = joins.link_lookup(nodes, links, "id", "part", "supplier", "name")
    return out.withColumns({c: F.expr(f"cast(substring({c}, 2) as bigint)") for c in ("part", "supplier")})


@query("join_12_interval_join", with_views(EVENTS) + """
SELECT v.event_id AS view_id, p.event_id AS purchase_id, v.user_id
FROM ev v JOIN ev p ON v.user_id = p.user_id AND p.event_time BETWEEN v.event_time AND v.event_time + INTERVAL 6 HOUR
WHERE v.action = 'view' AND p.action = 'purchase'""")
def join_12(t):
    views = t.events.filter("action = 'view'").select(F.col("event_id").alias("view_id"), "user_id", F.col("event_time").alias("viewed_at"))
    buys = t.events.filter("action = 'purchase'").select(F.col("event_id").alias("purchase_id"), F.col("user_id").alias("user_id"), F.col("event_time").alias("bought_at"))
    out = joins.interval_join(views, buys.withColumnRenamed("user_id", "buyer").withColumn("user_id", F.col("buyer")), "user_id", "viewed_at", "bought_at", 0, 6 * 3600)
    return out.select("view_id", "purchase_id", F.col("buyer").alias("user_id"))


@query("join_13_enrich_static", with_views(EVENTS, USERS) + """
SELECT event_id, ev.user_id, action, name, country, tier FROM ev LEFT JOIN users ON ev.user_id = users.user_id""")
def join_13(t):
    return joins.enrich_static(t.events.select("event_id", "user_id", "action"), t.users.select("user_id", "name", "country", "tier"), ["user_id"])


@query("join_14_salted_agg", with_views(SALES) + f"SELECT category, COUNT(*) AS n, {dsum('total_amount')} AS revenue FROM sales GROUP BY category")
def join_14(t):
    return joins.salted_agg(
        t.sales("category", "total_amount"), ["category"],
        {"n": agg.rows(), "s": F.sum(F.col("total_amount").cast("decimal(18,2)"))},
        {"n": F.sum("n"), "revenue": F.sum("s").cast("double")},
    ).select("category", "n", "revenue")


# --- aggregates ------------------------------------------------------------------

@query("agg_01_basic_stats", with_views(SALES) + f"""
SELECT COUNT(*) AS total_records, {dsum('total_amount')} AS total_revenue, {davg('total_amount')} AS avg_order_value,
  MAX(total_amount) AS max_order_value, MIN(total_amount) AS min_order_value, COUNT(DISTINCT user_id) AS total_users FROM sales""")
def agg_01(t):
    return agg.basic_stats(t.sales("user_id", "total_amount"))


@query("agg_02_revenue_by_category", with_views(SALES) + f"""
SELECT category, COUNT(*) AS order_count, {dsum('total_amount')} AS total_revenue, {davg('total_amount')} AS avg_order_value,
  MIN(total_amount) AS min_order_value, MAX(total_amount) AS max_order_value
FROM sales WHERE price > 0 AND quantity > 0 GROUP BY category""")
def agg_02(t):
    return agg.revenue_by_category(t.sales("category", "price", "quantity", "total_amount"))


@query("agg_03_daily_trends", with_views(SALES) + f"""
SELECT CAST(timestamp AS DATE) AS sale_date, COUNT(*) AS daily_orders, {dsum('total_amount')} AS daily_revenue,
  COUNT(DISTINCT user_id) AS unique_customers, {davg('total_amount')} AS avg_order_value
FROM sales GROUP BY 1 ORDER BY sale_date DESC LIMIT 30""")
def agg_03(t):
    return agg.daily_trends(t.sales("timestamp", "user_id", "total_amount"), 30)


@query("agg_04_hourly_patterns", with_views(EVENTS) + f"""
SELECT hour(event_time) AS hour, COUNT(*) AS orders, {dsum('total_amount')} AS revenue FROM ev GROUP BY 1""")
def agg_04(t):
    return agg.hourly_patterns(t.events, "event_time")


@query("agg_05_user_behavior", with_views(SALES) + f"""
, per AS (SELECT user_id, action, COUNT(*) AS n FROM sales GROUP BY ALL),
acts AS (SELECT user_id, string_agg(action || 'x' || n, ',' ORDER BY action) AS actions FROM per GROUP BY user_id)
SELECT s.user_id, COUNT(*) AS total_orders, {dsum('total_amount')} AS total_spent, COUNT(DISTINCT session_id) AS total_sessions,
  ANY_VALUE(actions) AS actions, CAST((2 * CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) * 100 AS HUGEINT) + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 100 AS avg_order_value
FROM sales s JOIN acts USING (user_id) GROUP BY s.user_id""")
def agg_05(t):
    out = agg.user_behavior(t.sales("user_id", "action", "total_amount", "session_id"))
    text = F.transform("actions", lambda a: F.concat(a["action"], F.lit("x"), a["n"].cast("string")))
    return out.withColumn("actions", F.array_join(text, ","))


@query("agg_06_customer_segments", with_views(ORDERS) + f"""
, u AS (SELECT user_id, COUNT(*) AS total_orders, {dsum('amount')} AS total_spent FROM user_orders GROUP BY 1)
SELECT CASE WHEN total_spent > 4000000 THEN 'Premium' WHEN total_spent > 2500000 THEN 'Gold' WHEN total_spent > 1000000 THEN 'Silver' ELSE 'Bronze' END AS segment,
  COUNT(*) AS customer_count, {davg('total_spent')} AS avg_spent, SUM(total_orders) / COUNT(*) AS avg_orders FROM u GROUP BY 1""")
def agg_06(t):
    orders = t.user_orders.select("user_id", F.col("amount").alias("total_amount"))
    return agg.customer_segments(orders, [(4000000, "Premium"), (2500000, "Gold"), (1000000, "Silver")])


@query("agg_07_customer_behavior", with_views(SALES) + f"""
, u AS (SELECT user_id, COUNT(*) AS total_orders, {dsum('total_amount')} AS total_spent, COUNT(DISTINCT category) AS categories FROM sales GROUP BY 1)
SELECT CASE WHEN total_spent >= 2000000 THEN 'High Value' WHEN total_spent >= 1000000 THEN 'Medium Value' ELSE 'Low Value' END AS customer_tier,
  CASE WHEN total_orders >= 45 THEN 'Frequent' WHEN total_orders >= 30 THEN 'Regular' ELSE 'Occasional' END AS purchase_frequency,
  COUNT(*) AS customer_count, {davg('total_spent')} AS avg_spending, SUM(total_orders) / COUNT(*) AS avg_orders, SUM(categories) / COUNT(*) AS avg_categories
FROM u GROUP BY 1, 2""")
def agg_07(t):
    return agg.customer_behavior(
        t.sales("user_id", "total_amount", "category"), [(2000000, "High Value"), (1000000, "Medium Value")], [(45, "Frequent"), (30, "Regular")]
    )


@query("agg_08_daily_sales_agg", with_views(SALES, FACT) + f"""
SELECT sale_date, category, COUNT(*) AS transaction_count, {dsum('final_amount', 4)} AS total_revenue, {dsum('estimated_profit', 6)} AS total_profit,
  {davg('final_amount', 4)} AS avg_transaction_value, COUNT(DISTINCT customer_id) AS unique_customers FROM fact GROUP BY 1, 2""")
def agg_08(t):
    return agg.daily_sales_agg(_fact(t))


@query("agg_09_customer_summary", with_views(SALES, FACT) + f"""
, s AS (SELECT customer_id, COUNT(*) AS total_orders, {dsum('final_amount', 4)} AS total_spent, {dsum('estimated_profit', 6)} AS total_profit_generated,
  {davg('final_amount', 4)} AS avg_order_value, MAX(timestamp) AS last_order_date, MIN(timestamp) AS first_order_date,
  string_agg(DISTINCT category, ',' ORDER BY category) AS purchased_categories FROM fact GROUP BY 1)
SELECT *, date_diff('day', first_order_date, last_order_date) AS customer_tenure_days,
  ROUND(CASE WHEN date_diff('day', first_order_date, last_order_date) > 0 THEN total_orders / (date_diff('day', first_order_date, last_order_date) / 30)
    ELSE total_orders END, 6) AS order_frequency FROM s""")
def agg_09(t):
    out = agg.customer_summary(_fact(t))
    return out.withColumns({"purchased_categories": F.array_join("purchased_categories", ","), "order_frequency": F.round("order_frequency", 6)})


@query("agg_10_business_summary", with_views(SALES, FACT) + f"""
, d AS (SELECT sale_date, category, COUNT(*) AS n, {dsum('final_amount', 4)} AS r, {davg('final_amount', 4)} AS a FROM fact GROUP BY 1, 2)
SELECT category, {dsum('r', 4)} AS category_revenue, CAST(SUM(n) AS BIGINT) AS category_transactions, ROUND(AVG(a), 4) AS mean_of_daily_means,
  {dsum('r', 4)} / SUM(n) AS avg_transaction_value FROM d GROUP BY category""")
def agg_10(t):
    return agg.business_summary(agg.daily_sales_agg(_fact(t)))


@query("agg_11_cohort_analysis", with_views(SALES) + f"""
, f AS (SELECT user_id, date_trunc('month', MIN(timestamp)) AS cohort_month FROM sales GROUP BY 1),
m AS (SELECT user_id, date_trunc('month', timestamp) AS activity_month, SUM(CAST(total_amount AS DECIMAL(18,2))) AS r FROM sales GROUP BY 1, 2)
SELECT cohort_month, activity_month, COUNT(DISTINCT user_id) AS active_users, CAST(SUM(r) AS DOUBLE) AS cohort_revenue,
  CAST(SUM(r) AS DOUBLE) / COUNT(*) AS avg_revenue_per_user FROM m JOIN f USING (user_id) GROUP BY 1, 2""")
def agg_11(t):
    return agg.cohort_analysis(t.sales("user_id", "timestamp", "total_amount"))


_GROUPED = f"""COUNT(*) AS transaction_count, {dsum('total_amount')} AS total_revenue, {davg('total_amount')} AS avg_transaction_value,
  CAST(GROUPING(category, action, is_premium) AS INTEGER) AS grouping_id FROM sales"""


@query("agg_12_cube_revenue", with_views(SALES) + f"SELECT category, action, is_premium, {_GROUPED} GROUP BY CUBE (category, action, is_premium)")
def agg_12(t):
    return agg.cube_revenue(t.sales("category", "action", "is_premium", "total_amount"))


@query("agg_13_rollup_revenue", with_views(SALES) + f"SELECT category, action, is_premium, {_GROUPED} GROUP BY ROLLUP (category, action, is_premium)")
def agg_13(t):
    return agg.rollup_revenue(t.sales("category", "action", "is_premium", "total_amount"))


@query("agg_13_grouping_sets", with_views(SALES) + f"""
SELECT category, action, is_premium, {_GROUPED} GROUP BY GROUPING SETS ((category), (action, is_premium), ())""")
def agg_13b(t):
    return agg.grouping_sets_revenue(
        t.sales("category", "action", "is_premium", "total_amount"), ["category", "action", "is_premium"], [["category"], ["action", "is_premium"], []]
    )


@query("agg_14_exact_quantiles", with_views(SALES) + """
SELECT category, """ + ", ".join(
    f"quantile_disc(total_amount, {q}) AS {n}" for n, q in agg.QUANTILES.items()) + " FROM sales GROUP BY category")
def agg_14(t):
    return agg.exact_quantiles(t.sales("category", "total_amount"), "category", "total_amount")


@query("agg_14_distribution_stats", with_views(SALES) + f"""
SELECT category, COUNT(*) AS sample_size, {davg('total_amount')} AS mean_value, ROUND(STDDEV(total_amount), 2) AS std_deviation, {', '.join(f'TRUE AS {q}_close' for q in agg.QUANTILES)}
FROM sales GROUP BY category""")
def agg_14b(t):
    """The sketch's quantiles, each compared with the exact one."""
    sales = t.sales("category", "total_amount")
    exact = agg.exact_quantiles(sales, "category", "total_amount").withColumnsRenamed({q: f"exact_{q}" for q in agg.QUANTILES})
    both = joins.join_same(agg.distribution_stats(sales, "category", "total_amount"), exact, ["category"])
    close = [(F.abs(F.col(q) - F.col(f"exact_{q}")) <= 0.01 * F.col(f"exact_{q}")).alias(f"{q}_close") for q in agg.QUANTILES]
    return both.select("category", "sample_size", "mean_value", "std_deviation", *close)


@query("agg_15_text_counts", with_views(SALES) + """
SELECT category, COUNT(*) AS total_records, COUNT(CASE WHEN regexp_matches(CAST(user_id AS VARCHAR), '^[0-9]+$') THEN 1 END) AS valid_user_ids,
  COUNT(CASE WHEN length(CAST(session_id AS VARCHAR)) > 3 THEN 1 END) AS long_sessions,
  string_agg(DISTINCT substr(CAST(user_id AS VARCHAR), 1, 1), ',' ORDER BY substr(CAST(user_id AS VARCHAR), 1, 1)) AS user_id_prefixes,
  SUM(length(CAST(quantity AS VARCHAR))) / COUNT(*) AS avg_quantity_digits FROM sales GROUP BY category""")
def agg_15(t):
    out = agg.text_counts(t.sales("category", "user_id", "session_id", "quantity"))
    return out.withColumn("user_id_prefixes", F.array_join("user_id_prefixes", ","))


@query("agg_16_category_action_stats", with_views(SALES) + f"""
SELECT category, action, COUNT(*) AS event_count, COUNT(DISTINCT user_id) AS unique_users, MIN(total_amount) AS min_value,
  MAX(total_amount) AS max_value, {davg('total_amount')} AS avg_value, ROUND(STDDEV(total_amount), 2) AS std_value FROM sales GROUP BY 1, 2""")
def agg_16(t):
    return agg.category_action_stats(t.sales("category", "action", "user_id", "total_amount"))


@query("agg_16_recent_category_days", with_views(SALES) + f"""
SELECT category, CAST(timestamp AS DATE) AS date, COUNT(*) AS daily_orders, {dsum('total_amount')} AS daily_revenue
FROM sales WHERE timestamp >= DATE '2001-08-01' - INTERVAL 60 DAY GROUP BY 1, 2""")
def agg_16b(t):
    return agg.recent_category_days(t.sales("category", "timestamp", "total_amount"), "2001-08-01", 60)


@query("agg_17_string_agg", """
SELECT n_name AS country, COUNT(*) AS n, COUNT(DISTINCT c_mktsegment) AS distinct_n, string_agg(DISTINCT c_mktsegment, ', ' ORDER BY c_mktsegment) AS joined
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def agg_17(t):
    return agg.string_agg(t.users, "country", "tier", distinct=True)


@query("agg_17_string_agg_all", """
SELECT l_orderkey, COUNT(*) AS n, string_agg(l_returnflag, ', ' ORDER BY l_returnflag) AS joined FROM lineitem GROUP BY 1""")
def agg_17b(t):
    return agg.string_agg(t.lineitem, "l_orderkey", "l_returnflag")


@query("agg_18_country_revenue", with_views(ORDERS, USERS) + f"""
, c AS (SELECT country, COUNT(*) AS orders_count, {dsum('amount')} AS total_revenue, COUNT(DISTINCT o.user_id) AS unique_customers
  FROM user_orders o JOIN users u ON o.user_id = u.user_id WHERE status = 'completed' GROUP BY 1)
SELECT *, total_revenue / orders_count AS avg_order_amount, total_revenue / unique_customers AS revenue_per_customer FROM c""")
def agg_18(t):
    return agg.country_revenue(t.user_orders, t.users.select("user_id", "country"))


@query("agg_19_price_band_histogram", with_views(EVENTS) + """
SELECT category, COUNT(*) FILTER (total_amount <= 50) AS band_0_50, COUNT(*) FILTER (total_amount > 50 AND total_amount <= 100) AS band_50_100,
  COUNT(*) FILTER (total_amount > 100 AND total_amount <= 200) AS band_100_200, COUNT(*) FILTER (total_amount > 200 AND total_amount <= 500) AS band_200_500,
  COUNT(*) FILTER (total_amount > 500) AS band_500_up FROM ev GROUP BY category""")
def agg_19(t):
    return agg.price_band_histogram(t.events, ["category"])


@query("agg_19_breakdown_maps", with_views(EVENTS) + f"""
, c AS (SELECT user_id, string_agg(category || '=' || CAST(CAST(s AS DECIMAL(18,2)) AS VARCHAR), ';' ORDER BY category) AS by_category FROM
   (SELECT user_id, category, SUM(CAST(total_amount AS DECIMAL(18,2))) AS s FROM ev GROUP BY 1, 2) GROUP BY 1),
a AS (SELECT user_id, string_agg(action || '=' || n, ';' ORDER BY action) AS by_action FROM (SELECT user_id, action, COUNT(*) AS n FROM ev GROUP BY 1, 2) GROUP BY 1),
h AS (SELECT user_id, string_agg(h || '=' || CAST(CAST(s AS DECIMAL(18,2)) AS VARCHAR), ';' ORDER BY h) AS by_hour FROM
   (SELECT user_id, hour(event_time) AS h, SUM(CAST(total_amount AS DECIMAL(18,2))) AS s FROM ev GROUP BY 1, 2) GROUP BY 1)
SELECT * FROM c JOIN a USING (user_id) JOIN h USING (user_id)""")
def agg_19b(t):
    out = agg.breakdown_maps(t.events, ["user_id"])

    def text(name, kind):
        entry = F.transform(name, lambda e: F.concat(e["name"].cast("string"), F.lit("="), e["value"].cast(kind).cast("string")))
        return F.array_join(entry, ";").alias(name)

    return out.select("user_id", text("by_category", "decimal(18,2)"), text("by_action", "long"), text("by_hour", "decimal(18,2)"))


@query("agg_20_extreme_orders", with_views(EVENTS) + """
, r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY category ORDER BY total_amount DESC, event_id) AS hi,
  ROW_NUMBER() OVER (PARTITION BY category ORDER BY total_amount, event_id) AS lo FROM ev)
SELECT a.category, a.total_amount AS max_amount, a.user_id AS max_user, a.event_id AS max_event, b.total_amount AS min_amount, b.user_id AS min_user, b.event_id AS min_event
FROM r a JOIN r b ON a.category = b.category WHERE a.hi = 1 AND b.lo = 1""")
def agg_20(t):
    return agg.extreme_orders(t.events, ["category"]).select(
        "category",
        *[F.col(f"{s}_order.{f}").alias(f"{s}_{n}") for s in ("max", "min") for f, n in (("amount", "amount"), ("user_id", "user"), ("id", "event"))],
    )


@query("agg_21_activity_rates", with_views(EVENTS) + f"""
, a AS (SELECT category, COUNT(*) AS order_count, {dsum('total_amount')} AS total_revenue, COUNT(DISTINCT user_id) AS unique_users,
  (epoch_us(MAX(event_time)) - epoch_us(MIN(event_time))) // 1000 AS span_ms FROM ev GROUP BY 1)
SELECT *, total_revenue / order_count AS avg_order_value, total_revenue / unique_users AS revenue_per_user, order_count / unique_users AS orders_per_user,
  ROUND(order_count / GREATEST(span_ms, 1) * 1000, 9) AS events_per_second FROM a""")
def agg_21(t):
    return agg.activity_rates(t.events, ["category"]).withColumn("events_per_second", F.round("events_per_second", 9))


@query("agg_22_event_table_stats", with_views(EVENTS) + """
SELECT date_trunc('hour', event_time) AS hour, COUNT(*) AS event_count, COUNT(DISTINCT user_id) AS unique_users, COUNT(DISTINCT event_type) AS event_types,
  MIN(event_time) AS first_event, MAX(event_time) AS last_event FROM ev GROUP BY 1""")
def agg_22(t):
    return agg.event_table_stats(t.events, [F.date_trunc("hour", "event_time").alias("hour")])


@query("agg_23_table_health", """
SELECT COUNT(*) AS total_rows, COUNT(DISTINCT o_custkey) AS distinct_o_custkey, MIN(o_orderdate) AS earliest, MAX(o_orderdate) AS latest,
  1 AS file_count, true AS small_file_warning FROM orders""")
def agg_23(t):
    return agg.table_health(t.orders, ["o_custkey"], "o_orderdate").select(
        "total_rows", "distinct_o_custkey", "earliest", "latest", "file_count", "small_file_warning"
    )


@query("agg_24_approx_unique", with_views(SALES) + """
SELECT category, COUNT(DISTINCT user_id) AS unique_users, TRUE AS within_bound FROM sales GROUP BY category""")
def agg_24(t):
    """The estimate, compared with the exact number: three standard errors are allowed."""
    sales = t.sales("category", "user_id")
    exact = sales.groupBy("category").agg(F.count_distinct("user_id").alias("unique_users"))
    both = joins.join_same(exact, agg.approx_unique(sales, "category", "user_id"), ["category"])
    return both.select("category", "unique_users", (F.abs(F.col("approx_unique") - F.col("unique_users")) <= 0.06 * F.col("unique_users")).alias("within_bound"))


@query("agg_25_region_product_summary", with_views(SALES) + f"""
SELECT region, product_id, COUNT(*) AS transaction_count, {dsum('total_amount')} AS total_revenue, {davg('total_amount')} AS avg_revenue,
  ROUND(STDDEV(total_amount), 2) AS revenue_std, CAST(SUM(quantity) AS BIGINT) AS total_quantity, MIN(timestamp) AS first_sale, MAX(timestamp) AS last_sale
FROM sales GROUP BY 1, 2""")
def agg_25(t):
    return agg.region_product_summary(t.sales("region", "product_id", "total_amount", "quantity", "timestamp"))


@query("agg_26_bucket_agg", with_views(SALES) + f"""
, c AS (SELECT date_trunc('month', timestamp) AS bucket, category, COUNT(*) AS n, SUM(CAST(total_amount AS DECIMAL(18,2))) AS s FROM sales GROUP BY 1, 2),
b AS (SELECT bucket, CAST(SUM(n) AS BIGINT) AS bucket_count, CAST(SUM(s) AS DOUBLE) / SUM(n) AS bucket_avg FROM c GROUP BY 1),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY bucket ORDER BY n DESC, category) AS term_rank FROM c)
SELECT bucket, bucket_count, bucket_avg, category, n AS term_count, CAST(s AS DOUBLE) / n AS term_avg, term_rank FROM r JOIN b USING (bucket) WHERE term_rank <= 3""")
def agg_26(t):
    return agg.bucket_agg(t.sales("timestamp", "category", "total_amount"), "timestamp", "month", "category", "total_amount", 3)


@query("agg_27_significant_terms", with_views(EVENTS) + """
, c AS (SELECT product_id, COUNT(*) FILTER (event_time >= TIMESTAMP '2024-01-24') AS fg_count, COUNT(*) AS bg_count FROM ev GROUP BY 1),
t AS (SELECT COUNT(*) FILTER (event_time >= TIMESTAMP '2024-01-24') AS fg_total, COUNT(*) AS bg_total FROM ev)
SELECT product_id, fg_count, bg_count, ROUND((fg_count / fg_total) / (bg_count / bg_total), 4) AS score FROM c, t WHERE fg_count > 0""")
def agg_27(t):
    return agg.significant_terms(t.events, "product_id", F.col("event_time") >= F.lit("2024-01-24").cast("timestamp"))


@query("agg_28_tier_summary", with_views(ORDERS) + f"""
, u AS (SELECT user_id, {dsum('amount')} AS spent FROM user_orders GROUP BY 1)
SELECT CASE WHEN spent / 1000.0::DOUBLE >= 5000 THEN 'Platinum' WHEN spent / 1000.0::DOUBLE >= 2000 THEN 'Gold' WHEN spent / 1000.0::DOUBLE >= 500 THEN 'Silver' ELSE 'Bronze' END AS customer_tier,
  COUNT(*) AS customer_count, {davg('spent')} AS avg_spending, MIN(spent) AS min_spending, MAX(spent) AS max_spending FROM u GROUP BY 1""")
def agg_28(t):
    return agg.tier_summary(t.user_orders.select("user_id", F.col("amount").alias("total_amount")), 1000.0)


@query("agg_29_word_count", r"""
SELECT word, COUNT(*) AS n FROM (SELECT UNNEST(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+')) AS word FROM documents) WHERE word <> '' GROUP BY 1""")
def agg_29(t):
    return agg.word_count(t.documents, "text")


@query("udf_02_price_category_performance", with_views(SALES) + f"""
SELECT category, CASE WHEN price IS NULL THEN 'Unknown' WHEN price >= 500 THEN 'Premium' WHEN price >= 100 THEN 'Standard' ELSE 'Budget' END AS price_tier,
  COUNT(*) AS transaction_count, {dsum('total_amount')} AS total_revenue, SUM(quantity) / COUNT(*) AS avg_quantity FROM sales GROUP BY 1, 2""")
def udf_02(t):
    return agg.price_category_performance(t.sales("category", "price", "total_amount", "quantity"))


@query("udf_03_complexity_analysis", with_views(EVENTS) + f"""
, s AS (SELECT category, total_amount, CAST(trunc(quantity * (price / 100) * CASE category WHEN 'ELECTRONICS' THEN 1.5::DOUBLE WHEN 'CLOTHING' THEN 1.0::DOUBLE
  WHEN 'BOOKS' THEN 0.8::DOUBLE WHEN 'HOME' THEN 1.2::DOUBLE WHEN 'SPORTS' THEN 1.1::DOUBLE ELSE 1.0::DOUBLE END) AS INTEGER) AS complexity FROM ev)
SELECT category, complexity, COUNT(*) AS order_count, {davg('total_amount')} AS avg_order_value, {dsum('total_amount')} AS total_revenue FROM s GROUP BY 1, 2 HAVING complexity > 0""")
def udf_03(t):
    return agg.complexity_analysis(t.events)


# --- order and sets -----------------------------------------------------------------

@query("ord_01_order_nulls_last", with_views(USERS, ORDERS) + f"""
SELECT u.user_id, country, spent FROM users u LEFT JOIN (SELECT user_id, {dsum('amount')} AS spent FROM user_orders WHERE status = 'shipped' GROUP BY 1) o
  ON u.user_id = o.user_id ORDER BY spent DESC NULLS LAST, u.user_id""")
def ord_01(t):
    shipped = t.user_orders.filter("status = 'shipped'")
    joined = joins.join_aggregate(t.users.select("user_id", "country"), shipped, "user_id", spent=agg.total("amount"))
    return ordering.order_nulls_last(joined, ["-spent", "user_id"])


@query("ord_02_top_k", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def ord_02(t):
    return ordering.top_k(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), ["-o_totalprice", "o_orderkey"], 100)


@query("ord_03_top_k_per", with_views(SALES) + f"""
, r AS (SELECT category, product_id, {dsum('total_amount')} AS revenue FROM sales GROUP BY 1, 2)
SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY category ORDER BY revenue DESC, product_id) AS rank FROM r) WHERE rank <= 5""")
def ord_03(t):
    revenue = t.sales("category", "product_id", "total_amount").groupBy("category", "product_id").agg(agg.total("total_amount").alias("revenue"))
    return ordering.top_k_per(revenue, ["category"], ["-revenue", "product_id"], 5)


@query("ord_04_last_n_per", """
SELECT * FROM (SELECT o_custkey, o_orderkey, o_orderdate, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS recency FROM orders) WHERE recency <= 3""")
def ord_04(t):
    return ordering.last_n_per(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), "o_custkey", ["o_orderdate", "o_orderkey"], 3)


@query("set_01_labelled_counts", """
SELECT 'orders' AS source, COUNT(*) AS row_count FROM orders UNION ALL SELECT 'lines', COUNT(*) FROM lineitem UNION ALL SELECT 'events', COUNT(*) FROM events""")
def set_01(t):
    return ordering.labelled_counts({"orders": t.orders, "lines": t.lineitem, "events": t.read("events")})


@query("set_02_dedupe", """
SELECT o_custkey, o_orderpriority, o_orderkey FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) AS r FROM orders) WHERE r = 1""")
def set_02(t):
    kept = ordering.dedupe(t.orders, ["o_custkey", "o_orderpriority"], ["-o_orderdate", "o_orderkey"])
    return kept.select("o_custkey", "o_orderpriority", "o_orderkey")


@query("set_03_snapshot_diff", """
SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'removed' WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 'added' ELSE 'changed' END AS change
FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' OR o_orderdate >= TIMESTAMP '2000-01-01' OR o_orderstatus = 'P'""")
def set_03(t):
    base = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    old = base.filter("o_orderdate < timestamp_ntz'2000-01-01 00:00:00'")
    new = base.filter("o_orderdate >= timestamp_ntz'1996-01-01 00:00:00'").withColumn(
        "o_orderstatus", F.when(F.col("o_orderstatus") == "P", "F").otherwise(F.col("o_orderstatus"))
    )
    return ordering.snapshot_diff(old, new, ["o_orderkey"]).select("o_orderkey", "change")
