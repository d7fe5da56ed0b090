"""Event-time windows, sessions and keyed state: table form beside its SQL, stream form over the same files."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators import enrich, joins, keyed_state
from tidewell.plans.oracle_views import EVENTS, USER_CHANGES, davg, dsum, with_views
from tidewell.plans.registry import query
from tidewell.streaming import lateness, sessions, windows
from tidewell.streaming.run import in_order, run_available, run_batches
from tidewell.session import scratch_path


def bucket(size: str) -> str:
    return f"time_bucket(INTERVAL {size}, event_time, TIMESTAMP '1970-01-01')"


def tumble(size: str, by: str, body: str, where: str = "true", having: str = "true", source: str = "ev") -> str:
    return (f"SELECT {bucket(size)} AS window_start, {bucket(size)} + INTERVAL {size} AS window_end, {by}, {body} "
            f"FROM {source} WHERE {where} GROUP BY ALL HAVING {having}")


def sliding(size_min: int, slide_min: int, source: str = "ev") -> str:
    """Every event once per window that holds it."""
    n = size_min // slide_min
    return (f"slid AS (SELECT {source}.*, time_bucket(INTERVAL {slide_min} MINUTE, event_time, TIMESTAMP '1970-01-01') - to_minutes(CAST(i * {slide_min} AS INTEGER)) AS window_start, "
            f"time_bucket(INTERVAL {slide_min} MINUTE, event_time, TIMESTAMP '1970-01-01') - to_minutes(CAST(i * {slide_min} AS INTEGER)) + INTERVAL {size_min} MINUTE AS window_end "
            f"FROM {source}, (SELECT UNNEST(range(0, {n})) AS i))")


def closed(delay: str) -> str:
    """Windows a stream has finished: the watermark is the latest time minus the delay."""
    return f"window_end <= (SELECT MAX(event_time) FROM ev) - INTERVAL {delay}"


_COUNTS = tumble("1 HOUR", "event_type", f"COUNT(*) AS event_count, {dsum('total_amount')} AS total_revenue")


@query("str_01_tumbling_counts", with_views(EVENTS) + tumble("1 MINUTE", "event_type", f"COUNT(*) AS event_count, {dsum('total_amount')} AS total_revenue"))
def str_01(t):
    return windows.tumbling_counts(t.events)


@query("str_01_tumbling_counts_stream", with_views(EVENTS) + f"SELECT * FROM ({_COUNTS}) WHERE {closed('2 MINUTE')}")
def str_01s(t):
    return run_available(windows.tumbling_counts(t.event_stream, "1 hour"), "tumbling-counts")


@query("str_02_sliding_revenue", with_views(EVENTS, sliding(5, 1)) + f"""
SELECT window_start, window_end, category, {dsum('total_amount')} AS revenue, COUNT(*) AS order_count, {davg('total_amount')} AS avg_order_value FROM slid GROUP BY ALL""")
def str_02(t):
    return windows.sliding_revenue(t.events)


@query("str_03_active_users", with_views(EVENTS, sliding(10, 2)) + f"""
SELECT window_start, window_end, user_id, COUNT(*) AS activity_count, {dsum('total_amount')} AS total_spent, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS events,
  COUNT(DISTINCT event_type) AS unique_events FROM slid GROUP BY ALL""")
def str_03(t):
    return windows.active_users(t.events).withColumn("events", F.array_join("events", ","))


@query("str_04_high_value_alerts", with_views(EVENTS) + """
SELECT event_id, user_id, total_amount, category, event_time, 'HIGH_VALUE_TRANSACTION' AS alert_type, 200.0::DOUBLE AS threshold FROM ev WHERE total_amount > 200""")
def str_04(t):
    return enrich.high_value_alerts(t.events, 200.0)


@query("str_04_high_value_alerts_stream", with_views(EVENTS) + """
SELECT event_id, user_id, total_amount, category, event_time, 'HIGH_VALUE_TRANSACTION' AS alert_type, 200.0::DOUBLE AS threshold FROM ev WHERE total_amount > 200""")
def str_04s(t):
    return run_available(enrich.high_value_alerts(t.event_stream, 200.0), "alerts")


@query("str_05_session_sliding", with_views(EVENTS, sliding(30, 5)) + f"""
SELECT window_start, window_end, session_id, COUNT(*) AS events_in_session, {dsum('total_amount')} AS session_value, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS session_events,
  MIN(event_time) AS session_start, MAX(event_time) AS session_end,
  (floor(epoch_us(MAX(event_time)) / 1000000) - floor(epoch_us(MIN(event_time)) / 1000000)) / 60 AS session_duration_minutes FROM slid GROUP BY ALL""")
def str_05(t):
    return windows.session_sliding(t.events).withColumn("session_events", F.array_join("session_events", ","))


@query("str_06_fraud_window", with_views(EVENTS) + f"""
, w AS ({tumble('1 DAY', 'user_id', f"COUNT(*) AS transaction_count, {dsum('total_amount')} AS window_amount, COUNT(DISTINCT ip_address) AS unique_ips")})
SELECT *, CASE WHEN transaction_count > 5 THEN 'HIGH_FREQUENCY' WHEN window_amount > 300 THEN 'HIGH_VALUE' ELSE 'MULTIPLE_IPS' END AS fraud_type
FROM w WHERE transaction_count > 5 OR window_amount > 300 OR unique_ips > 3""")
def str_06(t):
    return windows.fraud_window(t.events, "1 day", max_count=5, max_amount=300, max_ips=3)


REVENUE = f"{dsum('total_amount')} AS total_revenue, COUNT(*) AS order_count, COUNT(DISTINCT user_id) AS unique_users, {davg('total_amount')} AS avg_order_value, MAX(total_amount) AS max_order_value"


@query("str_07_tumble_revenue", with_views(EVENTS) + tumble("1 MINUTE", "category", REVENUE, "price > 0 AND quantity > 0"))
def str_07(t):
    return windows.tumble_revenue(t.events)


@query("str_07_tumble_revenue_purchases", with_views(EVENTS) + tumble("1 MINUTE", "category", REVENUE, "price > 0 AND quantity > 0 AND action = 'purchase'"))
def str_07b(t):
    return windows.tumble_revenue(t.events, purchases_only=True)


@query("str_08_event_fraud_rules", with_views(EVENTS) + """
SELECT 'fraud_' || event_id AS alert_id, user_id, event_id, CASE WHEN total_amount > 300 THEN 80 WHEN total_amount > 150 THEN 60 WHEN category = 'ELECTRONICS' AND total_amount > 80 THEN 50 ELSE 30 END AS fraud_score,
  CASE WHEN total_amount > 300 THEN 'HIGH_VALUE_TRANSACTION' WHEN total_amount > 150 THEN 'MEDIUM_VALUE_TRANSACTION' ELSE 'SUSPICIOUS_PATTERN' END AS alert_type, total_amount AS event_amount
FROM ev WHERE total_amount > 150 OR (category = 'ELECTRONICS' AND total_amount > 80) OR (action = 'purchase' AND hour(event_time) BETWEEN 0 AND 6)""")
def str_08(t):
    return enrich.event_fraud_rules(t.events, 300, 150, 80)


@query("str_09_fraud_score_additive", with_views(EVENTS) + """
, s AS (SELECT *, CASE WHEN total_amount > 150 THEN 20 ELSE 0 END + CASE WHEN category IN ('ELECTRONICS', 'JEWELRY') THEN 15 ELSE 0 END + CASE WHEN hour(event_time) < 6 OR hour(event_time) >= 23 THEN 10 ELSE 0 END
  + CASE WHEN total_amount IN (10.0, 20.0, 50.0) THEN 30 ELSE 0 END AS fraud_score FROM ev)
SELECT event_id, user_id, total_amount, event_time, fraud_score, concat_ws(',', CASE WHEN total_amount IN (10.0, 20.0, 50.0) THEN 'suspicious_amount' END, CASE WHEN total_amount > 150 THEN 'high_value' END,
  CASE WHEN category IN ('ELECTRONICS', 'JEWELRY') THEN 'high_risk_category' END, CASE WHEN hour(event_time) < 6 OR hour(event_time) >= 23 THEN 'unusual_time' END) AS fraud_reasons, 'POTENTIAL_FRAUD' AS alert_type
FROM s WHERE fraud_score >= 25""")
def str_09(t):
    out = enrich.fraud_score_additive(t.events, [10.0, 20.0, 50.0], 150, 25)
    return out.withColumn("fraud_reasons", F.array_join("fraud_reasons", ","))


def marked(gap: str, where: str = "true", key: str = "user_id") -> str:
    return f"""flagged AS (SELECT *, CASE WHEN LAG(event_time) OVER w IS NULL OR event_time - LAG(event_time) OVER w > INTERVAL {gap} THEN 1 ELSE 0 END AS f
  FROM ev WHERE {where} WINDOW w AS (PARTITION BY {key} ORDER BY event_time, event_id)),
numbered AS (SELECT *, SUM(f) OVER (PARTITION BY {key} ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) AS session_no FROM flagged)"""


_SESSIONS = f"""SELECT user_id, MIN(event_time) AS session_start, MAX(event_time) + INTERVAL 6 HOUR AS session_end, COUNT(*) AS event_count, {dsum('total_amount')} AS total_spent,
  COUNT(DISTINCT product_id) AS unique_products, (epoch_us(MAX(event_time)) - epoch_us(MIN(event_time)) + 21600000000) / 60000000 AS session_duration_minutes
FROM numbered GROUP BY user_id, session_no HAVING COUNT(*) > 1"""


@query("str_10_session_windows", with_views(EVENTS, marked("6 HOUR", "action IN ('view', 'add_to_cart', 'purchase')")) + _SESSIONS)
def str_10(t):
    return sessions.session_windows(t.events, 6 * 3600)


@query("str_10_session_windows_stream", with_views(EVENTS, marked("6 HOUR", "action IN ('view', 'add_to_cart', 'purchase')")) + f"""
SELECT user_id, session_start, session_end, event_count, total_spent FROM ({_SESSIONS})
WHERE session_end <= (SELECT MAX(event_time) FROM ev WHERE action IN ('view', 'add_to_cart', 'purchase')) - INTERVAL 30 SECOND""")
def str_10s(t):
    # Columns are chosen before the stream runs, so that no session holds a sketch of its products that nobody reads.
    found = sessions.session_windows(t.event_view(in_order(t.read("events"), "ts", "sessions")), 6 * 3600)
    return run_available(found.select("user_id", "session_start", "session_end", "event_count", "total_spent"), "sessions")


@query("str_11_session_profile", with_views(EVENTS, marked("12 HOUR")) + f"""
, p AS (SELECT user_id, session_no, MIN(event_time) AS session_start, MAX(event_time) AS last_event, COUNT(*) AS event_count, {dsum('total_amount')} AS total_amount, COUNT(DISTINCT product_id) AS unique_products,
  COUNT(DISTINCT category) AS unique_categories, COUNT(*) FILTER (action = 'purchase') AS purchase_count, COUNT(*) FILTER (action = 'view') AS view_count,
  (epoch_us(MAX(event_time)) - epoch_us(MIN(event_time))) // 1000 AS session_duration_ms FROM numbered GROUP BY 1, 2)
SELECT *, total_amount / GREATEST(purchase_count, 1) AS avg_order_value, purchase_count / event_count AS conv_per_event, CASE WHEN view_count > 0 THEN purchase_count / view_count ELSE 0 END AS conv_per_view,
  session_duration_ms / GREATEST(event_count - 1, 1) AS avg_time_between_events_ms,
  CASE WHEN total_amount > 500 THEN 'HIGH_VALUE' WHEN event_count > 10 THEN 'HIGH_ENGAGEMENT' WHEN unique_categories > 2 THEN 'CROSS_CATEGORY' WHEN purchase_count / event_count > 0.5 THEN 'HIGH_CONVERSION' ELSE 'REGULAR' END AS session_type FROM p""")
def str_11(t):
    return sessions.session_profile(t.events, 12 * 3600)


@query("str_11_session_steps", with_views(EVENTS, marked("12 HOUR")) + """
SELECT user_id, session_no, ROW_NUMBER() OVER (PARTITION BY user_id, session_no ORDER BY event_time, event_id) AS position, event_id, action FROM numbered""")
def str_11b(t):
    return sessions.session_steps(t.events, 12 * 3600)


HOURLY = f"{dsum('total_amount')} AS total_revenue, COUNT(*) AS order_count, COUNT(DISTINCT user_id) AS unique_users, {davg('total_amount')} AS avg_order_value"


@query("str_12_hourly_rollup", with_views(EVENTS) + tumble("1 HOUR", "category", HOURLY, "price > 0 AND quantity > 0"))
def str_12(t):
    return windows.hourly_rollup(t.events)


_PRODUCT = tumble("1 DAY", "product_id, category", f"{dsum('total_amount')} AS total_revenue, COUNT(*) AS order_count", "action = 'purchase'")
_RANKED = f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY window_start, category ORDER BY total_revenue DESC, product_id) AS popularity_rank FROM ({_PRODUCT}) WHERE total_revenue > 0) WHERE popularity_rank <= 3"""


@query("str_13_product_rank_per_window", with_views(EVENTS) + _RANKED)
def str_13(t):
    return windows.rank_products(windows.product_revenue(t.events, "1 day"), 3)


@query("str_13_product_rank_stream", with_views(EVENTS) + _RANKED + " AND window_end <= (SELECT MAX(event_time) FROM ev WHERE action = 'purchase') - INTERVAL 30 SECOND")
def str_13s(t):
    out = scratch_path(t.spark, "product-rank")

    def write(batch, batch_id):
        windows.rank_products(batch, 3).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    cells = windows.product_revenue(t.event_stream, "1 day")
    run_batches(cells, write, "product-rank")
    return t.spark.read.parquet(out).drop("batch_id")


@query("str_14_product_popularity", with_views(EVENTS, sliding(5, 1)) + f"""
SELECT window_start, window_end, product_id, COUNT(*) FILTER (action = 'view') AS views, COUNT(*) FILTER (action = 'purchase') AS purchases,
  COALESCE({dsum("CASE WHEN action = 'purchase' THEN total_amount END")}, 0) AS revenue, COUNT(DISTINCT user_id) AS unique_users,
  COUNT(*) FILTER (action = 'purchase') / GREATEST(COUNT(*) FILTER (action = 'view'), 1) AS conversion_rate FROM slid GROUP BY ALL""")
def str_14(t):
    return windows.product_popularity(t.events)


LEVELS = {"minute": "1 MINUTE", "five_minute": "5 MINUTE", "fifteen_minute": "15 MINUTE", "hourly": "1 HOUR"}


@query("str_15_multi_level_windows", with_views(EVENTS) + " UNION ALL ".join(
    tumble(s, f"'{n}' AS level, category", f"COUNT(*) AS order_count, {dsum('total_amount')} AS total_revenue") for n, s in LEVELS.items()))
def str_15(t):
    return windows.all_levels(t.events, {n: s.lower() for n, s in LEVELS.items()})


@query("str_16_count_trigger", with_views(EVENTS) + f"""
SELECT user_id, batch_no, COUNT(*) AS event_count, {dsum('total_amount')} AS total_amount, MIN(event_time) AS first_event, MAX(event_time) AS last_event
FROM (SELECT *, (ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_time, event_id) - 1) // 10 + 1 AS batch_no FROM ev) GROUP BY 1, 2""")
def str_16(t):
    return windows.count_trigger(t.events, "user_id", 10)


PATTERNS = f"""WITH g AS (SELECT window_start, window_end, user_id, COUNT(*) AS event_count, COUNT(*) FILTER (action = 'purchase') AS p, COUNT(*) FILTER (action = 'view') AS v, COUNT(*) FILTER (action = 'add_to_cart') AS a,
  COUNT(*) FILTER (action = 'remove') AS r, COALESCE({dsum("CASE WHEN action = 'purchase' THEN total_amount END")}, 0) AS total_spent, COUNT(DISTINCT category) AS unique_categories FROM slid GROUP BY ALL HAVING COUNT(*) >= 2),
q AS (SELECT *, concat_ws(';', CASE WHEN p >= 2 THEN 'RAPID_PURCHASING:' || p || ' purchases in window:' || CASE WHEN p > 3 THEN 'HIGH' ELSE 'MEDIUM' END END,
  CASE WHEN total_spent > 150 THEN 'HIGH_VALUE_PURCHASING:$' || printf('%.2f', total_spent) || ' spent in window:HIGH' END,
  CASE WHEN unique_categories >= 4 THEN 'CATEGORY_SWITCHING:' || unique_categories || ' different categories:MEDIUM' END,
  CASE WHEN a - p - r > 0 THEN 'ABANDONED_CART:' || (a - p - r) || ' items left in cart:LOW' END,
  CASE WHEN v > 2 AND p = 0 THEN 'PRICE_SENSITIVE_BROWSING:' || v || ' views but no purchases:MEDIUM' END) AS patterns FROM g)
SELECT window_start, window_end, user_id, event_count, total_spent, unique_categories, patterns FROM q WHERE patterns <> ''"""


def patterns(events, delay: str = "20 seconds"):
    out = windows.behavior_patterns(events, "1 day", "6 hours", delay, rapid=2, very_rapid=3, high_value=150, browsing=2)
    text = F.transform("patterns", lambda p: F.concat_ws(":", p["type"], p["description"], p["severity"]))
    return out.withColumn("patterns", F.array_join(text, ";"))


@query("str_17_behavior_patterns", with_views(EVENTS, sliding(1440, 360)) + f"SELECT * FROM ({PATTERNS})")
def str_17(t):
    return patterns(t.events)


@query("str_18_premium_analytics", with_views(EVENTS, USER_CHANGES) + f"""
, v AS (SELECT user_id, updated_at + to_days(9131) AS since, user_tier FROM user_changes QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, updated_at ORDER BY version DESC) = 1),
e AS (SELECT ev.*, COALESCE(user_tier, 'UNKNOWN') AS user_tier FROM ev ASOF LEFT JOIN v ON ev.user_id = v.user_id AND ev.event_time >= v.since)
{tumble('1 HOUR', 'user_tier', f"{dsum('total_amount')} AS total_revenue, {davg('total_amount')} AS avg_order_value, COUNT(DISTINCT user_id) AS user_count", "action = 'purchase'", source='e')}""")
def str_18(t):
    # Order dates end before the events begin; the change log is moved 25 years so that they overlap.
    versions = t.user_changes.select(
        "user_id", (F.col("updated_at") + F.expr("INTERVAL 9131 DAYS")).alias("since"), "version", "user_tier"
    )
    enriched = joins.asof_join(t.events, versions, "user_id", "event_time", "since", ["version"])
    return windows.premium_analytics(enriched, "1 hour")


@query("str_19_inventory_signal", with_views(EVENTS) + f"""
, w AS ({tumble('1 DAY', 'product_id, category', "COUNT(*) AS purchase_count, MAX(event_time) AS last_purchase_time", "action = 'purchase'", 'COUNT(*) > 1')})
SELECT *, GREATEST(0, 100 - purchase_count) AS estimated_remaining_stock, CASE WHEN purchase_count > 4 THEN 'CRITICAL' WHEN purchase_count > 3 THEN 'LOW' WHEN purchase_count > 2 THEN 'MEDIUM' ELSE 'OK' END AS alert_level FROM w""")
def str_19(t):
    return windows.inventory_signal(t.events, "1 day", at_least=1, levels=[(4, "CRITICAL"), (3, "LOW"), (2, "MEDIUM")])


@query("str_20_cross_category", with_views(EVENTS) + f"""
, w AS ({tumble('1 DAY', 'user_id', f"string_agg(DISTINCT category, ',' ORDER BY category) AS categories_purchased, COUNT(DISTINCT category) AS category_count, {dsum('total_amount')} AS total_spent", "action = 'purchase'")})
SELECT *, category_count * total_spent / 1000.0::DOUBLE AS cross_category_score FROM w WHERE category_count > 1""")
def str_20(t):
    out = windows.cross_category(t.events, "1 day")
    return out.withColumn("categories_purchased", F.array_join("categories_purchased", ","))


CHURN = """WITH w AS (SELECT date_trunc('day', event_time) AS window_start, user_id, MAX(event_time) AS signal_timestamp, floor(epoch_us(MAX(event_time)) / 1000000) - floor(epoch_us(MIN(event_time)) / 1000000) AS s,
  COUNT(*) AS n, COUNT(DISTINCT session_id) AS k FROM ev GROUP BY ALL)
SELECT window_start, user_id, signal_timestamp, floor(s / 86400) AS days_since_last_purchase, s / 3600.0::DOUBLE / GREATEST(k, 1) AS avg_session_gap_hours, n / GREATEST(k, 1) AS recent_engagement_score,
  CASE WHEN n < 3 THEN 'HIGH_RISK' WHEN n < 7 THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END AS churn_risk_level FROM w"""


@query("str_21_churn_signals", with_views(EVENTS) + f"SELECT * FROM ({CHURN})")
def str_21(t):
    return windows.churn_signals(t.events)


@query("str_24_dedupe_within_watermark", with_views(EVENTS) + "SELECT COUNT(*) AS n, COUNT(DISTINCT event_id) AS ids FROM ev")
def str_24(t):
    doubled = t.event_stream.unionByName(t.event_stream)
    out = run_available(lateness.dedupe_within_watermark(doubled, ["event_id"], "event_time", "1 hour"), "dedupe")
    return out.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids"))


@query("str_25_window_metadata", with_views(EVENTS) + f"""
SELECT *, category AS window_key, 120000 AS window_duration_ms, 'tumbling' AS window_type FROM ({tumble('2 MINUTE', 'category', REVENUE, "price > 0 AND quantity > 0")})""")
def str_25(t):
    return windows.window_metadata(windows.tumble_revenue(t.events, "2 minutes"), "category")


@query("str_26_page_view_windows", with_views(EVENTS) + tumble("1 DAY", "user_id", "COUNT(*) AS page_views, COUNT(DISTINCT product_id) AS unique_pages", "event_type = 'view'"))
def str_26(t):
    return windows.page_view_windows(nested(t.events), "1 day")


def nested(events):
    return events.select("user_id", "event_time", F.struct(F.col("event_type").alias("type"), F.col("product_id").alias("page")).alias("event"))


@query("str_28_user_amounts", with_views(EVENTS) + tumble("5 MINUTE", "user_id", f"COUNT(*) AS event_count, {dsum('total_amount')} AS amount"))
def str_28(t):
    return windows.user_amounts(t.events)


# --- keyed state, table form ----------------------------------------------------------------

@query("sta_01_user_profile", with_views(EVENTS) + f"""
, b AS (SELECT user_id, COUNT(*) FILTER (action = 'login') AS session_count, COALESCE({dsum("CASE WHEN action = 'purchase' THEN total_amount END")}, 0) AS total_spent, MAX(event_time) AS last_activity FROM ev GROUP BY 1),
p AS (SELECT user_id, string_agg(category || '=' || n, ',' ORDER BY category) AS preferences FROM (SELECT user_id, category, COUNT(*) AS n FROM ev WHERE action = 'view' GROUP BY 1, 2) GROUP BY 1),
r AS (SELECT user_id, string_agg(product_id, ',' ORDER BY k) AS recent_purchases FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_time DESC, event_id DESC) AS k FROM ev WHERE action = 'purchase') WHERE k <= 10 GROUP BY 1)
SELECT *, CASE WHEN total_spent >= 5000 THEN 'PLATINUM' WHEN total_spent >= 2000 THEN 'GOLD' WHEN total_spent >= 500 THEN 'SILVER' ELSE 'BRONZE' END AS tier FROM b LEFT JOIN p USING (user_id) LEFT JOIN r USING (user_id)""")
def sta_01(t):
    out = keyed_state.user_profile(t.events)
    entries = F.transform(F.map_entries("preferences"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return out.withColumns(
        {"preferences": F.array_join(entries, ","), "recent_purchases": F.array_join(F.col("recent_purchases.product_id").cast("array<string>"), ",")}
    )


@query("sta_01_tier_activations", with_views(EVENTS) + """
, r AS (SELECT *, SUM(CAST(total_amount AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) AS running FROM ev WHERE action = 'purchase'),
l AS (SELECT *, CAST(running >= 500 AS INT) + CAST(running >= 2000 AS INT) + CAST(running >= 5000 AS INT) AS lv FROM r),
b AS (SELECT *, COALESCE(LAG(lv) OVER (PARTITION BY user_id ORDER BY event_time, event_id), 0) AS before FROM l)
SELECT user_id, CASE lv WHEN 3 THEN 'PLATINUM' WHEN 2 THEN 'GOLD' ELSE 'SILVER' END AS new_tier, CAST(running AS DOUBLE) AS total_spent, event_time + INTERVAL 24 HOUR AS activation_time,
  CASE lv WHEN 3 THEN 'VIP support|15% discount|Free shipping|Early access' WHEN 2 THEN 'Priority support|10% discount|Free shipping' ELSE 'Basic support|5% discount' END AS benefits FROM b WHERE lv > before""")
def sta_01b(t):
    return keyed_state.tier_activations(t.events).withColumn("benefits", F.array_join("benefits", "|"))


@query("sta_02_session_tracker", with_views(EVENTS, marked("12 HOUR")) + f"""
, s AS (SELECT user_id, session_no, MIN(event_time) AS session_start, MAX(event_time) AS last_event, COUNT(*) AS event_count, COUNT(DISTINCT category) AS unique_categories,
  COALESCE({dsum("CASE WHEN action = 'purchase' THEN total_amount END")}, 0) AS total_spent, COUNT(*) FILTER (action = 'view') AS view_count, COUNT(*) FILTER (action = 'add_to_cart') AS cart_count,
  COUNT(*) FILTER (action = 'purchase') AS purchase_count FROM numbered GROUP BY 1, 2)
SELECT *, view_count + 3 * cart_count + 5 * purchase_count + 2 * unique_categories AS engagement_score FROM s""")
def sta_02(t):
    return sessions.session_tracker(t.events, 12 * 3600)


@query("sta_03_product_popularity", with_views(EVENTS) + f"""
, c AS (SELECT product_id, CAST(floor(epoch_us(event_time) / 3600000000) AS BIGINT) AS h, COUNT(*) FILTER (action = 'view') AS v, COUNT(*) FILTER (action = 'purchase') AS p,
  COALESCE(SUM(CAST(CASE WHEN action = 'purchase' THEN total_amount END AS DECIMAL(18,2))), 0) AS r FROM ev GROUP BY 1, 2),
u AS (SELECT DISTINCT product_id, user_id, CAST(floor(epoch_us(event_time) / 3600000000) AS BIGINT) AS h FROM ev),
n AS (SELECT c.product_id, c.h, COUNT(DISTINCT u.user_id) AS unique_users FROM c JOIN u ON u.product_id = c.product_id AND u.h BETWEEN c.h - 24 AND c.h GROUP BY 1, 2),
s AS (SELECT product_id, h, CAST(SUM(v) OVER w AS BIGINT) AS total_views, CAST(SUM(p) OVER w AS BIGINT) AS total_purchases, CAST(SUM(r) OVER w AS DOUBLE) AS total_revenue,
  CAST(SUM(CASE WHEN v > 0 OR p > 0 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS hours_with_activity FROM c WINDOW w AS (PARTITION BY product_id ORDER BY h RANGE BETWEEN 24 PRECEDING AND CURRENT ROW))
SELECT product_id, make_timestamp(h * 3600000000) AS hour, total_views, total_purchases, total_revenue, unique_users, hours_with_activity, total_purchases / GREATEST(total_views, 1) AS conversion_rate,
  total_views + total_purchases * 5 + unique_users * 3 + hours_with_activity * 2 AS popularity_score FROM s JOIN n USING (product_id, h)""")
def sta_03(t):
    return keyed_state.product_popularity(t.events)


def running(key: str) -> str:
    return f"(PARTITION BY {key} ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING)"


SPENT = "CAST(CASE WHEN action = 'purchase' THEN total_amount ELSE 0 END AS DECIMAL(18,2))"


@query("sta_04_online_features", with_views(EVENTS) + f"""
, f AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, category ORDER BY event_time, event_id) = 1 AS a, ROW_NUMBER() OVER (PARTITION BY product_id, user_id ORDER BY event_time, event_id) = 1 AS b,
  ROW_NUMBER() OVER (PARTITION BY session_id, category ORDER BY event_time, event_id) = 1 AS c FROM ev)
SELECT event_id, COUNT(*) OVER {running('user_id')} AS user_events, CAST(SUM({SPENT}) OVER {running('user_id')} AS DOUBLE) AS user_spent, CAST(SUM(CAST(a AS INT)) OVER {running('user_id')} AS BIGINT) AS user_categories,
  COALESCE((epoch_us(event_time) - epoch_us(LAG(event_time) OVER (PARTITION BY user_id ORDER BY event_time, event_id))) // 1000, 0) AS since_last_activity_ms,
  CAST(SUM(CAST(action = 'view' AS INT)) OVER {running('product_id')} AS BIGINT) AS product_views, CAST(SUM(CAST(action = 'purchase' AS INT)) OVER {running('product_id')} AS BIGINT) AS product_purchases,
  CAST(SUM(CAST(b AS INT)) OVER {running('product_id')} AS BIGINT) AS product_viewers, CAST(SUM({SPENT}) OVER {running('product_id')} AS DOUBLE) AS product_revenue,
  COUNT(*) OVER {running('session_id')} AS session_events, CAST(SUM(CAST(c AS INT)) OVER {running('session_id')} AS BIGINT) AS session_categories,
  (epoch_us(event_time) - epoch_us(MIN(event_time) OVER {running('session_id')})) // 1000 AS session_duration_ms,
  SUM(CAST(action = 'purchase' AS INT)) OVER {running('session_id')} > 0 AS has_purchase, hour(event_time) AS hour_of_day FROM f""")
def sta_04(t):
    return keyed_state.online_features(t.events).select(
        "event_id", "user_events", "user_spent", "user_categories", "since_last_activity_ms", "product_views", "product_purchases", "product_viewers",
        "product_revenue", "session_events", "session_categories", "session_duration_ms", "has_purchase", "hour_of_day",
    )


@query("sta_05_user_behavior_state", with_views(EVENTS) + f"""
, s AS (SELECT event_id, user_id, event_time, COUNT(*) OVER {running('user_id')} AS total_events, SUM({SPENT}) OVER {running('user_id')} AS spent FROM ev)
SELECT event_id, user_id, event_time, total_events, CAST(spent AS DOUBLE) AS total_spent, CASE WHEN spent >= 1000 THEN 'GOLD' WHEN spent >= 300 THEN 'SILVER' ELSE 'BRONZE' END AS user_tier FROM s""")
def sta_05(t):
    return keyed_state.user_behavior_state(t.events, 300, 1000)


@query("sta_06_fraud_state", with_views(EVENTS) + """
, k AS (SELECT *, event_time - LAG(event_time) OVER w AS gap FROM ev WHERE total_amount > 50 WINDOW w AS (PARTITION BY user_id ORDER BY event_time, event_id)),
i AS (SELECT *, SUM(CASE WHEN gap IS NULL OR gap > INTERVAL 1 DAY THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) AS island FROM k),
s AS (SELECT *, SUM(CAST(total_amount AS DECIMAL(18,2))) OVER (PARTITION BY user_id, island ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) AS spending FROM i),
c AS (SELECT *, CASE WHEN total_amount > 150 THEN 50 ELSE 0 END + CASE WHEN spending > 200 THEN 30 ELSE 0 END + CASE WHEN gap < INTERVAL 2 HOUR THEN 40 ELSE 0 END AS fraud_score FROM s)
SELECT event_id, user_id, event_time, total_amount AS amount, CAST(spending AS DOUBLE) AS recent_spending, fraud_score,
  CASE WHEN gap < INTERVAL 2 HOUR THEN 'RAPID_TRANSACTIONS' WHEN spending > 200 THEN 'HIGH_VOLUME' WHEN total_amount > 150 THEN 'HIGH_VALUE' ELSE 'SUSPICIOUS' END AS alert_type FROM c WHERE fraud_score >= 40""")
def sta_06(t):
    return keyed_state.fraud_state(t.events, 50, 150, 200, 86400, 7200)


@query("sta_07_type_counters", with_views(EVENTS) + f"""
SELECT event_type, CAST(event_time AS DATE) AS day, hour(event_time) AS hour, COUNT(*) AS n, {dsum('total_amount')} AS amount FROM ev GROUP BY ALL""")
def sta_07(t):
    return keyed_state.type_counters(t.events)


@query("sta_07_recent_activity", with_views(EVENTS) + """
SELECT * FROM (SELECT user_id, event_id, action, event_time, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_time DESC, event_id DESC) AS recency FROM ev) WHERE recency <= 20""")
def sta_07b(t):
    return keyed_state.recent_activity(t.events, 20)
