"""Data quality, change logs, history tables and table layout."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators import aggregates as agg
from tidewell.operators import cdc, joins, lake, quality
from tidewell.plans.oracle_views import (
    EVENTS, ORDERS, PRODUCT_CHANGES, SALES, USER_CHANGES, USERS, davg, dsum, with_views,
)
from tidewell.plans.registry import query
from tidewell.session import scratch_path

AS_OF = "2001-12-01"
CATEGORIES = ["ECONOMY", "MEDIUM", "SMALL", "LARGE"]


def _dirty(t):
    """Order amounts with missing values, taken from the orders themselves."""
    return t.orders.select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_totalprice") < 490000, F.col("o_totalprice")).alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_custkey").alias("user_id"),
    )


DIRTY = """dirty AS (SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority,
  CASE WHEN o_totalprice < 490000 THEN o_totalprice END AS amount, o_orderstatus AS status, o_custkey AS user_id FROM orders)"""


@query("dq_01_null_profile", with_views(DIRTY) + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count, ROUND((COUNT(*) - COUNT({c})) / COUNT(*) * 100, 2) AS null_percentage FROM dirty"
    for c in ("priority", "amount", "status", "user_id")))
def dq_01(t):
    return quality.null_profile(_dirty(t))


@query("dq_02_duplicate_profile", """
WITH g AS (SELECT l_partkey, l_quantity, l_discount, COUNT(*) AS n FROM lineitem GROUP BY ALL)
SELECT CAST(SUM(n) AS BIGINT) AS total_records, COUNT(*) AS unique_records, CAST(SUM(n) - COUNT(*) AS BIGINT) AS duplicate_count,
  ROUND(CAST(SUM(n) - COUNT(*) AS DOUBLE) / CAST(SUM(n) AS DOUBLE) * 100, 2) AS duplicate_percentage FROM g""")
def dq_02(t):
    return quality.duplicate_profile(t.lineitem.select("l_partkey", "l_quantity", "l_discount"))


def _rules():
    return quality.sales_rules(CATEGORIES, "2001-01-01", 2500)


_RULE_SQL = {
    "positive_prices": "price <= 0", "positive_quantities": "quantity <= 0",
    "valid_categories": "category NOT IN ('ECONOMY', 'MEDIUM', 'SMALL', 'LARGE')",
    "future_dates": "timestamp > TIMESTAMP '2001-01-01'", "reasonable_prices": "price < 1 OR price > 2500",
}


@query("dq_03_rule_counts", with_views(SALES) + " UNION ALL ".join(
    f"SELECT '{n}' AS rule, COUNT(*) FILTER ({c}) AS violations FROM sales" for n, c in _RULE_SQL.items()))
def dq_03(t):
    return quality.rule_counts(t.sales("price", "quantity", "category", "timestamp"), _rules())


@query("dq_04_quality_score", with_views(DIRTY) + """
, u AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT * FROM dirty)),
p AS (SELECT COUNT(*) AS total, COUNT(*) FILTER (priority IS NULL) AS np, COUNT(*) FILTER (amount IS NULL) AS na, COUNT(*) FILTER (amount > 400000) AS big FROM dirty),
i AS (SELECT total, total - n + big + CASE WHEN ROUND(np / total * 100, 2) > 5 THEN np ELSE 0 END + CASE WHEN ROUND(na / total * 100, 2) > 5 THEN na ELSE 0 END AS issues FROM p, u),
c AS (SELECT (SELECT total FROM i) + (SELECT COUNT(*) FROM customer) AS total_records, (SELECT issues FROM i) + (SELECT COUNT(*) FROM customer WHERE c_acctbal < 0) AS total_issues)
SELECT total_records, total_issues, ROUND(GREATEST(0, 100 - total_issues / total_records * 100), 2) AS quality_score FROM c""")
def dq_04(t):
    return quality.quality_score(
        {"orders": (_dirty(t), {"big": F.col("amount") > 400000}), "customers": (t.customer, {"debt": F.col("c_acctbal") < 0})}
    )


@query("dq_05_value_distribution", with_views(SALES) + """
SELECT 'category' AS column_name, category AS value, COUNT(*) AS n FROM sales GROUP BY 2 UNION ALL SELECT 'action', action, COUNT(*) FROM sales GROUP BY 2""")
def dq_05(t):
    return quality.value_distribution(t.sales("category", "action"), ["category", "action"])


@query("dq_06_numeric_summary", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(COUNT({c}) AS DOUBLE) AS count, ROUND(AVG({c}), 4) AS mean, ROUND(STDDEV({c}), 4) AS stddev, CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE) AS max FROM lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_discount")))
def dq_06(t):
    return quality.numeric_summary(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"])


@query("dq_07_user_alerts", """
WITH u AS (SELECT c_custkey AS user_id, CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 'broken' ELSE 'a@b.example' END AS email,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_name END AS username, c_name AS first_name, c_mktsegment AS user_tier, c_acctbal AS total_spent FROM customer)
SELECT user_id, CASE WHEN email IS NULL THEN 'MISSING_EMAIL' WHEN email NOT LIKE '%@%.%' THEN 'INVALID_EMAIL_FORMAT' WHEN username = '' THEN 'MISSING_USERNAME' ELSE 'INVALID_USER_TIER' END AS quality_issue,
  CASE WHEN email IS NULL OR email NOT LIKE '%@%.%' THEN 'HIGH' WHEN username = '' THEN 'MEDIUM' ELSE 'LOW' END AS severity,
  CASE WHEN email IS NULL OR email NOT LIKE '%@%.%' THEN 'email' WHEN username = '' THEN 'username' ELSE 'user_tier' END AS field_name,
  CASE WHEN email IS NULL OR email NOT LIKE '%@%.%' THEN COALESCE(email, 'NULL') WHEN username = '' THEN username ELSE user_tier END AS invalid_value,
  CASE WHEN email IS NULL OR email NOT LIKE '%@%.%' THEN 'valid email format (user@domain.com)' WHEN username = '' THEN 'non-empty username' ELSE 'BRONZE, SILVER, GOLD, or PLATINUM' END AS expected_format
FROM u""")
def dq_07(t):
    c = F.col("c_custkey")
    users = t.customer.select(
        c.alias("user_id"), F.when(c % 11 == 0, None).when(c % 13 == 0, "broken").otherwise("a@b.example").alias("email"),
        F.when(c % 7 == 0, "").otherwise(F.col("c_name")).alias("username"), F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("user_tier"), F.col("c_acctbal").alias("total_spent"),
    )
    return quality.user_alerts(users, ["user_id"])


@query("dq_07_product_alerts", with_views(PRODUCT_CHANGES) + """
SELECT product_id, version, CASE WHEN cost >= price THEN 'COST_EXCEEDS_PRICE' ELSE 'NEGATIVE_INVENTORY' END AS quality_issue,
  CASE WHEN cost >= price THEN 'HIGH' ELSE 'MEDIUM' END AS severity, CASE WHEN cost >= price THEN 'cost' ELSE 'inventory_count' END AS field_name,
  CASE WHEN cost >= price THEN 'cost less than price' ELSE 'non-negative inventory count' END AS expected_format
FROM product_changes WHERE cost >= price OR inventory_count < 0""")
def dq_07b(t):
    return quality.product_alerts(t.product_changes, ["product_id", "version"]).drop("invalid_value")


@query("dq_08_profile_drift", with_views(EVENTS) + """
, b AS (SELECT CAST(total_amount >= 10 AS INT) + CAST(total_amount >= 30 AS INT) + CAST(total_amount >= 70 AS INT) + CAST(total_amount >= 200 AS INT) AS bucket, event_time < TIMESTAMP '2024-01-16' AS old FROM ev),
c AS (SELECT bucket, COUNT(*) FILTER (old) AS old_n, COUNT(*) FILTER (NOT old) AS new_n FROM b GROUP BY 1),
s AS (SELECT *, GREATEST(old_n, 0.5)::DOUBLE / SUM(old_n) OVER () AS o, GREATEST(new_n, 0.5)::DOUBLE / SUM(new_n) OVER () AS n FROM c)
SELECT bucket, old_n, new_n, ROUND((n - o) * ln(n / o), 6) AS stability FROM s""")
def dq_08(t):
    middle = F.lit("2024-01-16").cast("timestamp")
    return quality.profile_drift(
        t.events.filter(F.col("event_time") < middle), t.events.filter(F.col("event_time") >= middle), "total_amount", [10, 30, 70, 200]
    )


@query("dq_09_orphans", with_views(EVENTS) + """
SELECT event_id, user_id FROM ev WHERE user_id NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 350000)""")
def dq_09(t):
    good = t.orders.filter("o_orderstatus = 'F' AND o_totalprice > 350000").select(F.col("o_custkey").alias("user_id"))
    return quality.orphans(t.events.select("event_id", "user_id"), good, "user_id")


@query("dq_09_repeated_keys", "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1")
def dq_09b(t):
    return quality.repeated_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


# --- as-of joins and change logs ------------------------------------------------------

@query("join_08_asof_join", with_views(EVENTS) + """
, b AS (SELECT event_id, user_id, event_time, total_amount FROM ev WHERE action = 'purchase'),
v AS (SELECT user_id, event_time AS viewed_at, product_id AS viewed_product FROM ev WHERE action = 'view')
SELECT event_id, b.user_id, event_time, total_amount, CASE WHEN viewed_at >= event_time - INTERVAL 2 DAY THEN viewed_at END AS viewed_at,
  CASE WHEN viewed_at >= event_time - INTERVAL 2 DAY THEN viewed_product END AS viewed_product
FROM b ASOF LEFT JOIN v ON b.user_id = v.user_id AND b.event_time >= v.viewed_at""")
def join_08(t):
    buys = t.events.filter("action = 'purchase'").select("event_id", "user_id", "event_time", "total_amount")
    views = t.events.filter("action = 'view'").select("user_id", F.col("event_time").alias("viewed_at"), F.col("product_id").alias("viewed_product"))
    return joins.asof_join(buys, views, "user_id", "event_time", "viewed_at", tolerance="2 days")


_LAST_USER = """last_user AS (SELECT * FROM user_changes QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY version DESC) = 1)"""


@query("cdc_01_latest_image", with_views(USER_CHANGES, _LAST_USER) + "SELECT * FROM last_user WHERE NOT is_deleted")
def cdc_01(t):
    return cdc.latest_image(t.user_changes, ["user_id"], ["version"])


@query("cdc_02_enhanced_orders", with_views(USER_CHANGES, ORDERS) + """
, v AS (SELECT * FROM user_changes QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, updated_at ORDER BY version DESC) = 1),
r AS (SELECT user_id, MIN(updated_at) AS registration_date FROM user_changes GROUP BY 1),
j AS (SELECT o.order_id, o.user_id, o.order_date, o.amount, v.version, v.user_status, v.user_tier, v.is_deleted,
  date_diff('day', registration_date, o.order_date) AS days_since_registration
  FROM user_orders o ASOF LEFT JOIN v ON o.user_id = v.user_id AND o.order_date >= v.updated_at LEFT JOIN r ON o.user_id = r.user_id)
SELECT * EXCLUDE (is_deleted), CASE WHEN days_since_registration <= 30 THEN 'NEW_CUSTOMER' WHEN days_since_registration <= 365 THEN 'EXISTING_CUSTOMER' ELSE 'LOYAL_CUSTOMER' END AS customer_segment
FROM j WHERE NOT is_deleted""")
def cdc_02(t):
    changes = t.user_changes
    registered = changes.groupBy("user_id").agg(F.min("updated_at").alias("registration_date"))
    orders = t.user_orders.select("order_id", "user_id", "order_date", "amount")
    return cdc.enhanced_orders(orders, changes, registered).select(
        "order_id", "user_id", "order_date", "amount", "version", "user_status", "user_tier", "days_since_registration", "customer_segment"
    )


def _items(t):
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), F.col("l_suppkey").alias("supplier_id"),
        F.col("l_partkey").alias("product_id"), F.col("l_shipdate").cast("timestamp").alias("item_time"), F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"), F.col("l_extendedprice").alias("total_price"),
    )


_DETAILS = """details AS (
  SELECT l.*, v.version, v.price, v.cost, v.product_name, v.category, ROUND(total_price - v.cost * quantity, 2) AS profit_amount,
    ROUND((total_price - v.cost * quantity) / NULLIF(total_price, 0) * 100, 4) AS profit_margin_percent,
    CASE WHEN unit_price < v.price * 0.8::DOUBLE THEN 'HIGH_DISCOUNT' WHEN unit_price < v.price * 0.9::DOUBLE THEN 'MEDIUM_DISCOUNT' WHEN unit_price < v.price THEN 'LOW_DISCOUNT' ELSE 'NO_DISCOUNT' END AS discount_category
  FROM (SELECT l_orderkey AS order_id, l_linenumber AS line, l_suppkey AS supplier_id, l_partkey AS product_id, l_shipdate AS item_time, l_quantity AS quantity,
    l_extendedprice / l_quantity AS unit_price, l_extendedprice AS total_price FROM lineitem) l
  ASOF JOIN product_changes v ON l.product_id = v.product_id AND l.item_time >= v.updated_at WHERE NOT v.is_deleted)"""


@query("cdc_02_order_details", with_views(PRODUCT_CHANGES, _DETAILS) + """
SELECT order_id, line, supplier_id, product_id, item_time, total_price, version, price, cost, category, profit_amount, profit_margin_percent, discount_category FROM details""")
def cdc_02b(t):
    return cdc.order_details(_items(t), t.product_changes).select(
        "order_id", "line", "supplier_id", "product_id", "item_time", "total_price", "version", "price", "cost", "category",
        F.round("profit_amount", 2).alias("profit_amount"), F.round("profit_margin_percent", 4).alias("profit_margin_percent"), "discount_category",
    )


@query("cdc_03_customer_analytics", with_views(USER_CHANGES, _LAST_USER, ORDERS) + f"""
, r AS (SELECT user_id, MIN(updated_at) AS registration_date FROM user_changes GROUP BY 1),
j AS (SELECT u.user_id, u.email, u.user_tier, registration_date, COUNT(order_id) AS total_orders, COALESCE({dsum('amount')}, 0) AS total_spent, MAX(order_date) AS last_order_date
  FROM last_user u JOIN r ON u.user_id = r.user_id LEFT JOIN user_orders o ON u.user_id = o.user_id AND status IN ('completed', 'shipped', 'delivered') WHERE NOT is_deleted GROUP BY ALL)
SELECT user_id, email, user_tier, total_orders, total_spent, last_order_date, COALESCE(total_spent / NULLIF(total_orders, 0), 0) AS avg_order_value,
  COALESCE(date_diff('day', last_order_date, TIMESTAMP '{AS_OF}'), 999) AS days_since_last_order, date_diff('day', registration_date, TIMESTAMP '{AS_OF}') AS customer_lifetime_days,
  COALESCE(last_order_date >= TIMESTAMP '{AS_OF}' - INTERVAL 200 DAY, false) AS is_active FROM j""")
def cdc_03(t):
    changes = t.user_changes
    registered = changes.groupBy("user_id").agg(F.min("updated_at").alias("registration_date"))
    users = cdc.latest_image(changes, ["user_id"], ["version"]).select("user_id", "email", "user_tier").join(registered, "user_id")
    return cdc.customer_analytics(users, t.user_orders, AS_OF, active_days=200).drop("registration_date")


_LAST_PRODUCT = """last_product AS (SELECT * FROM product_changes QUALIFY ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY version DESC) = 1)"""


@query("cdc_04_product_analytics", with_views(PRODUCT_CHANGES, _DETAILS, _LAST_PRODUCT) + f"""
, s AS (SELECT product_id, SUM(quantity) AS total_sold, {dsum('total_price')} AS total_revenue, ROUND(AVG(unit_price), 4) AS avg_sale_price, MAX(item_time) AS last_sale_date FROM details GROUP BY 1)
SELECT p.product_id, product_name, category, price AS current_price, inventory_count AS current_inventory, COALESCE(total_sold, 0) AS total_sold,
  COALESCE(total_revenue, 0) AS total_revenue, COALESCE(avg_sale_price, price) AS avg_sale_price,
  CASE WHEN inventory_count > 0 THEN COALESCE(total_sold, 0) / inventory_count ELSE 0 END AS inventory_turnover_rate,
  ROUND(CASE WHEN price > 0 THEN (price - cost) / price * 100 ELSE 0 END, 4) AS profit_margin, last_sale_date, inventory_count <= reorder_level AS reorder_needed
FROM last_product p LEFT JOIN s ON p.product_id = s.product_id WHERE NOT is_deleted""")
def cdc_04(t):
    changes = t.product_changes
    products = cdc.latest_image(changes, ["product_id"], ["version"])
    out = cdc.product_analytics(products, cdc.order_details(_items(t), changes))
    return out.withColumn("profit_margin", F.round("profit_margin", 4))


@query("cdc_06_inventory_alerts", with_views(PRODUCT_CHANGES, _LAST_PRODUCT) + """
SELECT product_id, product_name, category, CASE WHEN inventory_count <= 0 THEN 'OUT_OF_STOCK' WHEN inventory_count <= reorder_level THEN 'LOW_STOCK' ELSE 'APPROACHING_REORDER' END AS alert_type,
  inventory_count AS current_inventory, reorder_level, CASE WHEN inventory_count <= 0 THEN reorder_level * 3 WHEN inventory_count <= reorder_level THEN reorder_level * 2 ELSE reorder_level END AS recommended_order_quantity,
  updated_at AS alert_timestamp FROM last_product WHERE inventory_count <= reorder_level * 1.5 AND product_status = 'ACTIVE' AND NOT is_deleted""")
def cdc_06(t):
    return cdc.inventory_alerts(cdc.latest_image(t.product_changes, ["product_id"], ["version"], None))


@query("cdc_07_merge_upsert", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def cdc_07(t):
    base = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    target = base.filter("o_orderdate < timestamp_ntz'2000-06-01 00:00:00'").drop("o_orderdate")
    updates = base.filter("o_orderdate >= timestamp_ntz'1999-01-01 00:00:00'").withColumn("o_orderstatus", F.lit("X")).drop("o_orderdate")
    return cdc.merge_upsert(target, updates, ["o_orderkey"])


@query("cdc_08_update_where", """
SELECT o_orderkey, CASE WHEN o_totalprice > 400000 AND o_orderstatus = 'P' THEN 'H' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_totalprice > 400000 AND o_orderstatus = 'P' THEN 0 ELSE o_totalprice END AS o_totalprice FROM orders""")
def cdc_08(t):
    df = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return cdc.update_where(
        df, (F.col("o_totalprice") > 400000) & (F.col("o_orderstatus") == "P"), {"o_orderstatus": F.lit("H"), "o_totalprice": F.lit(0.0)}
    )


@query("cdc_08_update_from", """
SELECT c_custkey, c_name, COALESCE(m, c_acctbal) AS c_acctbal FROM customer LEFT JOIN (SELECT o_custkey, MAX(o_totalprice) AS m FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) ON c_custkey = o_custkey""")
def cdc_08b(t):
    best = t.orders.filter("o_orderstatus = 'O'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal"))
    return cdc.update_from(t.customer.select("c_custkey", "c_name", "c_acctbal"), best, ["c_custkey"], ["c_acctbal"])


@query("cdc_09_delete_where", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1996-01-01' THEN 'deleted' ELSE 'kept' END AS fate FROM orders""")
def cdc_09(t):
    kept, deleted = cdc.delete_where(t.orders, F.expr("o_orderstatus = 'P' AND o_orderdate < timestamp_ntz'1996-01-01 00:00:00'"))
    label = lambda df, name: df.select("o_orderkey", "o_custkey", F.lit(name).alias("fate"))
    return label(kept, "kept").unionByName(label(deleted, "deleted"))


@query("cdc_10_scd2", with_views(USER_CHANGES) + """
, m AS (SELECT *, LAG(user_status || '/' || user_tier) OVER (PARTITION BY user_id ORDER BY version) AS b FROM user_changes),
s AS (SELECT * FROM m WHERE b IS NULL OR b <> user_status || '/' || user_tier)
SELECT user_id, user_status, user_tier, updated_at AS valid_from, LEAD(updated_at) OVER w AS valid_to, LEAD(updated_at) OVER w IS NULL AS is_current
FROM s WINDOW w AS (PARTITION BY user_id ORDER BY version)""")
def cdc_10(t):
    return cdc.scd2(t.user_changes, ["user_id"], "updated_at", ["user_status", "user_tier"], ["version"])


@query("cdc_11_state_as_of", with_views(USER_CHANGES) + """
, l AS (SELECT * FROM user_changes WHERE updated_at <= TIMESTAMP '1998-06-30' QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY version DESC) = 1)
SELECT * FROM l WHERE NOT is_deleted""")
def cdc_11(t):
    return cdc.state_as_of(t.user_changes, ["user_id"], ["version"], "updated_at", "1998-06-30")


@query("cdc_12_evolve", "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, NULL AS population, n_regionkey FROM nation")
def cdc_12(t):
    wanted = T.StructType([T.StructField("n_nationkey", T.LongType()), T.StructField("n_name", T.StringType()), T.StructField("population", T.LongType())])
    return cdc.evolve(t.nation, wanted)


# --- table layout ---------------------------------------------------------------------

@query("lak_01_compact", "SELECT o_orderpriority, COUNT(*) AS n, CAST(SUM(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1")
def lak_01(t):
    small = scratch_path(t.spark, "small-files")
    t.orders.select("o_orderkey", "o_orderpriority").repartition(24).write.parquet(small)
    packed = lake.compact(t.spark, small, scratch_path(t.spark, "packed"), 256, ["o_orderpriority"])
    return packed.groupBy("o_orderpriority").agg(agg.rows().alias("n"), F.sum("o_orderkey").alias("keys"))


_EDGES = [[10.0, 20.0, 30.0], [20000.0, 40000.0, 60000.0]]


@query("lak_02_z_value", """
WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity >= 10 AS INT) + CAST(l_quantity >= 20 AS INT) + CAST(l_quantity >= 30 AS INT) AS a,
  CAST(l_extendedprice >= 20000 AS INT) + CAST(l_extendedprice >= 40000 AS INT) + CAST(l_extendedprice >= 60000 AS INT) AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (a & 1) + 2 * (b & 1) + 4 * (a >> 1) + 8 * (b >> 1) AS z FROM c""")
def lak_02(t):
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return lake.z_value(df, ["l_quantity", "l_extendedprice"], _EDGES).drop("l_quantity", "l_extendedprice")


@query("lak_02_zorder", "SELECT COUNT(*) AS n, COUNT(DISTINCT o_orderkey) AS keys FROM orders")
def lak_02b(t):
    ordered = lake.zorder(t.orders, ["o_custkey", "o_totalprice"], bits=4)
    return ordered.agg(agg.rows().alias("n"), F.count_distinct("o_orderkey").alias("keys"))


@query("lak_03_retain", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= DATE '2001-08-01' - INTERVAL 90 DAY")
def lak_03(t):
    return lake.retain(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "2001-08-01", 90)


@query("lak_03_storage_tier", """
SELECT CASE WHEN a <= 90 THEN 'hot' WHEN a <= 720 THEN 'warm' ELSE 'cold' END AS storage_tier, COUNT(*) AS n
FROM (SELECT date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') AS a FROM orders) GROUP BY 1""")
def lak_03b(t):
    return lake.storage_tier(t.orders, "o_orderdate", "2001-08-01", 90, 720).groupBy("storage_tier").agg(agg.rows().alias("n"))


@query("lak_04_medallion", with_views(EVENTS) + f"""
SELECT date_trunc('day', event_time) AS day, category, COUNT(*) AS events, {dsum('total_amount')} AS revenue FROM ev WHERE total_amount > 0 AND product_id IS NOT NULL GROUP BY 1, 2""")
def lak_04(t):
    flow = lake.Medallion(
        silver=lambda b: b.filter((F.col("total_amount") > 0) & F.col("product_id").isNotNull()),
        gold=lambda s: s.groupBy(F.date_trunc("day", "event_time").alias("day"), "category").agg(
            agg.rows().alias("events"), agg.total("total_amount").alias("revenue")
        ),
    )
    return flow.apply(t.events)[1]
