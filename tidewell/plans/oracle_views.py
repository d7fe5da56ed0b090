"""The adapted views as SQL, for the comparison queries only."""

from __future__ import annotations

SALES = """sales AS (
  SELECT o_custkey AS user_id, l_partkey AS product_id, p_type AS category, o_orderstatus AS action,
    o_orderdate AS timestamp, l_extendedprice / l_quantity AS price, CAST(l_quantity AS INTEGER) AS quantity,
    l_extendedprice AS total_amount, l_orderkey AS session_id, c_acctbal > 5000 AS is_premium, r_name AS region,
    n_name AS country, p_name AS product_name, l_linenumber AS line, l_suppkey AS supplier_id
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
    LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey)"""

USERS = """users AS (
  SELECT c_custkey AS user_id, c_name AS name, n_name AS country, c_mktsegment AS tier, c_acctbal AS balance,
    c_acctbal > 5000 AS is_premium
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

PRODUCTS = """products AS (
  SELECT p_partkey AS product_id, p_name AS name, p_brand AS brand, p_type AS category, p_size AS size,
    p_retailprice AS base_price, ROUND(p_retailprice * 0.7, 2) AS cost,
    CAST((p_size * 7 + p_partkey) % 120 AS INTEGER) AS inventory
  FROM part)"""

ORDERS = """user_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id,
    CASE o_orderstatus WHEN 'O' THEN 'completed' WHEN 'F' THEN 'shipped' WHEN 'P' THEN 'pending' END AS status,
    o_totalprice AS amount, o_orderdate AS order_date, o_orderpriority AS payment_method
  FROM orders)"""

EVENTS = """ev AS (
  SELECT event_id, ts AS event_time, user_id, event_type,
    CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'add_to_cart' WHEN 'purchase' THEN 'purchase'
      WHEN 'signup' THEN 'login' WHEN 'error' THEN 'remove' END AS action,
    k AS product_id, ['ELECTRONICS','CLOTHING','BOOKS','HOME','SPORTS'][CAST(k % 5 + 1 AS INTEGER)] AS category,
    value AS price, 1 AS quantity, value AS total_amount,
    user_id || '-' || strftime(ts, '%Y%m%d') AS session_id, '10.0.0.' || (k % 7) AS ip_address, props
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""

USER_CHANGES = """user_changes_base AS (
  SELECT o_custkey AS user_id, o_orderkey, o_orderdate AS updated_at,
    CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'SUSPENDED' WHEN 'P' THEN 'INACTIVE' END AS user_status,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.001 AS DECIMAL(18,5)) AS spent FROM orders),
user_changes_run AS (
  SELECT *, ROW_NUMBER() OVER w AS version, SUM(spent) OVER (w ROWS UNBOUNDED PRECEDING) AS running
  FROM user_changes_base WINDOW w AS (PARTITION BY user_id ORDER BY updated_at, o_orderkey)),
user_changes AS (
  SELECT user_id, version, updated_at, user_status,
    CASE WHEN running >= 5000 THEN 'PLATINUM' WHEN running >= 2000 THEN 'GOLD' WHEN running >= 500 THEN 'SILVER'
      ELSE 'BRONZE' END AS user_tier,
    CAST(running AS DOUBLE) AS total_spent, 'user' || user_id || '@mail.example' AS email,
    o_orderkey % 97 = 0 AS is_deleted
  FROM user_changes_run)"""

PRODUCT_CHANGES = """product_changes_base AS (
  SELECT p_partkey AS product_id, version, TIMESTAMP '1995-01-01' + to_days(CAST(version * 800 AS INTEGER)) AS updated_at,
    p_name AS product_name, p_type AS category, p_brand AS subcategory,
    CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(1 + version * 0.25 AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS price, p_size
  FROM part, (SELECT UNNEST([0, 1, 2]) AS version)),
product_changes AS (
  SELECT product_id, CAST(version AS BIGINT) AS version, updated_at, product_name, category, subcategory, CAST(price AS DOUBLE) AS price,
    CAST(CAST(price * CASE WHEN p_size % 17 = 0 THEN 1.1 ELSE 0.7 END AS DECIMAL(18,2)) AS DOUBLE) AS cost,
    CAST((p_size * 7 + product_id + version * 31) % 120 - 3 AS INTEGER) AS inventory_count, 20 AS reorder_level,
    CASE WHEN product_id % 10 = 0 THEN 'RETIRED' ELSE 'ACTIVE' END AS product_status,
    product_id % 50 = 0 AND version = 2 AS is_deleted
  FROM product_changes_base)"""

TRANSFERS = """transfers AS (
  SELECT event_id AS transfer_id, user_id AS src, product_id AS dst, total_amount AS amount, event_time AS sent_at
  FROM ev WHERE action = 'purchase')"""


def dsum(value: str, scale: int = 2) -> str:
    """Exact sum of an amount."""
    return f"CAST(SUM(CAST({value} AS DECIMAL(18,{scale}))) AS DOUBLE)"


def davg(value: str, scale: int = 2) -> str:
    return f"({dsum(value, scale)} / NULLIF(COUNT({value}), 0))"


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"
