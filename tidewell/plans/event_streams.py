"""Streams over files that come out of order, each beside the SQL of its table form for the time its watermark has passed."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators import joins, lake
from tidewell.operators import aggregates as agg
from tidewell.plans.oracle_views import EVENTS, USER_CHANGES, USERS, davg, dsum, with_views
from tidewell.plans.registry import query
from tidewell.plans.streams import CHURN, HOURLY, LEVELS, PATTERNS, REVENUE, SPENT, marked, nested, patterns, running, sliding, tumble
from tidewell.session import scratch_path
from tidewell.streaming import lateness, stateful, windows
from tidewell.streaming.asof import asof_stream
from tidewell.streaming.run import ROWS_PER_BATCH, medallion_stream, replay, run_available, run_batches

LATENESS_SECONDS, PARTS = 86_400, 5
DELAY = f"{LATENESS_SECONDS + 1} seconds"
REAL, BOUGHT, VIEWED = "price > 0 AND quantity > 0", "action = 'purchase'", "action = 'view'"


def out_of_order(t, most: int | None = None, rows_per_batch: int = ROWS_PER_BATCH):
    """The events as a stream of several batches in which rows come up to a day late, in an order that says nothing about their time.

    There are ``PARTS`` batches, and more where they would have too many rows: what a batch adds to the state before the watermark moves does not
    grow with the table. ``most`` limits their number for queries whose result depends on it.
    """
    events = t.read("events")
    late = F.pmod(F.col("event_id") * 7919, F.lit(LATENESS_SECONDS + 1)) * 1_000_000
    parts = most or max(PARTS, -(-events.count() // rows_per_batch))
    return t.event_view(replay(events, "ts", parts, late, "events"))


def mark(where: str = "true", source: str = "ev", delay_us: int = (LATENESS_SECONDS + 1) * 1_000_000) -> str:
    """The last watermark of a stream of these rows, in microseconds."""
    return f"(SELECT epoch_us(MAX(event_time)) // 1000 * 1000 - {delay_us} FROM {source} WHERE {where})"


BOTH_MARK = f"least({mark(BOUGHT)}, {mark(VIEWED)})"


# --- windows ----------------------------------------------------------------------------------

def windows_stream(name: str, views: str, body: str, build, where: str = "true", end: str = "epoch_us(window_end)") -> None:
    """Register the stream form of a window query: the rows of the table form whose windows the watermark has passed."""
    query(name, f"{views} SELECT * FROM ({body}) WHERE {end} <= {mark(where)}")(lambda t: run_available(build(out_of_order(t)), name))


windows_stream("str_02_sliding_revenue_stream", with_views(EVENTS, sliding(60, 20)), f"""
SELECT window_start, window_end, category, {dsum('total_amount')} AS revenue, COUNT(*) AS order_count, {davg('total_amount')} AS avg_order_value FROM slid GROUP BY ALL""",
    lambda s: windows.sliding_revenue(s, "60 minutes", "20 minutes", DELAY))

windows_stream("str_03_active_users_stream", with_views(EVENTS, sliding(60, 20)), f"""
SELECT window_start, window_end, user_id, COUNT(*) AS activity_count, {dsum('total_amount')} AS total_spent, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS events,
  COUNT(DISTINCT event_type) AS unique_events FROM slid GROUP BY ALL""",
    lambda s: windows.active_users(s, "60 minutes", "20 minutes", DELAY).withColumn("events", F.array_join("events", ",")))

windows_stream("str_05_session_sliding_stream", with_views(EVENTS, sliding(120, 60)), f"""
SELECT window_start, window_end, session_id, COUNT(*) AS events_in_session, {dsum('total_amount')} AS session_value, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS session_events,
  MIN(event_time) AS session_start, MAX(event_time) AS session_end,
  (floor(epoch_us(MAX(event_time)) / 1000000) - floor(epoch_us(MIN(event_time)) / 1000000)) / 60 AS session_duration_minutes FROM slid GROUP BY ALL""",
    lambda s: windows.session_sliding(s, "120 minutes", "60 minutes", DELAY).withColumn("session_events", F.array_join("session_events", ",")))

windows_stream("str_06_fraud_window_stream", with_views(EVENTS), f"""
SELECT *, CASE WHEN transaction_count > 5 THEN 'HIGH_FREQUENCY' WHEN window_amount > 300 THEN 'HIGH_VALUE' ELSE 'MULTIPLE_IPS' END AS fraud_type
FROM ({tumble('1 DAY', 'user_id', f"COUNT(*) AS transaction_count, {dsum('total_amount')} AS window_amount, COUNT(DISTINCT ip_address) AS unique_ips")})
WHERE transaction_count > 5 OR window_amount > 300 OR unique_ips > 2""",
    lambda s: windows.fraud_window(s, "1 day", DELAY, max_count=5, max_amount=300, max_ips=2))

windows_stream("str_07_tumble_revenue_stream", with_views(EVENTS), tumble("1 HOUR", "category", REVENUE, REAL),
    lambda s: windows.tumble_revenue(s, "1 hour", DELAY), REAL)

windows_stream("str_12_hourly_rollup_stream", with_views(EVENTS), tumble("1 HOUR", "category, action", HOURLY, REAL),
    lambda s: windows.hourly_rollup(s, ("category", "action"), DELAY), REAL)

windows_stream("str_14_product_popularity_stream", with_views(EVENTS, sliding(60, 20)), f"""
SELECT window_start, window_end, product_id, COUNT(*) FILTER (action = 'view') AS views, COUNT(*) FILTER (action = 'purchase') AS purchases,
  COALESCE({dsum("CASE WHEN action = 'purchase' THEN total_amount END")}, 0) AS revenue, COUNT(DISTINCT user_id) AS unique_users,
  COUNT(*) FILTER (action = 'purchase') / GREATEST(COUNT(*) FILTER (action = 'view'), 1) AS conversion_rate FROM slid GROUP BY ALL""",
    lambda s: windows.product_popularity(s, "60 minutes", "20 minutes", DELAY))


windows_stream("str_15_multi_level_windows_stream", with_views(EVENTS), " UNION ALL ".join(
    tumble(s, f"'{n}' AS level, category", f"COUNT(*) AS order_count, {dsum('total_amount')} AS total_revenue") for n, s in LEVELS.items()),
    lambda s: windows.all_levels(s, {n: size.lower() for n, size in LEVELS.items()}, delay=DELAY))

windows_stream("str_17_behavior_patterns_stream", with_views(EVENTS, sliding(1440, 360)), PATTERNS, lambda s: patterns(s, DELAY))

windows_stream("str_19_inventory_signal_stream", with_views(EVENTS), f"""
SELECT *, GREATEST(0, 100 - purchase_count) AS estimated_remaining_stock,
  CASE WHEN purchase_count > 4 THEN 'CRITICAL' WHEN purchase_count > 3 THEN 'LOW' WHEN purchase_count > 2 THEN 'MEDIUM' ELSE 'OK' END AS alert_level
FROM ({tumble('1 DAY', 'product_id, category', "COUNT(*) AS purchase_count, MAX(event_time) AS last_purchase_time", BOUGHT, 'COUNT(*) > 1')})""",
    lambda s: windows.inventory_signal(s, "1 day", DELAY, at_least=1, levels=[(4, "CRITICAL"), (3, "LOW"), (2, "MEDIUM")]), BOUGHT)

windows_stream("str_20_cross_category_stream", with_views(EVENTS), f"""
SELECT *, category_count * total_spent / 1000.0::DOUBLE AS cross_category_score
FROM ({tumble('1 DAY', 'user_id', f"string_agg(DISTINCT category, ',' ORDER BY category) AS categories_purchased, COUNT(DISTINCT category) AS category_count, {dsum('total_amount')} AS total_spent", BOUGHT)})
WHERE category_count > 1""",
    lambda s: windows.cross_category(s, "1 day", DELAY).withColumn("categories_purchased", F.array_join("categories_purchased", ",")), BOUGHT)

windows_stream("str_21_churn_signals_stream", with_views(EVENTS), CHURN, lambda s: windows.churn_signals(s, DELAY), end="epoch_us(window_start) + 86400000000")

windows_stream("str_25_window_metadata_stream", with_views(EVENTS), f"""
SELECT *, category AS window_key, 1800000 AS window_duration_ms, 'tumbling' AS window_type FROM ({tumble('30 MINUTE', 'category', REVENUE, REAL)})""",
    lambda s: windows.window_metadata(windows.tumble_revenue(s, "30 minutes", DELAY), "category"), REAL)

windows_stream("str_26_page_view_windows_stream", with_views(EVENTS),
    tumble("1 DAY", "user_id", "COUNT(*) AS page_views, COUNT(DISTINCT product_id) AS unique_pages", "event_type = 'view'"),
    lambda s: windows.page_view_windows(nested(s), "1 day", DELAY), VIEWED)

windows_stream("str_28_user_amounts_stream", with_views(EVENTS), tumble("1 HOUR", "user_id", f"COUNT(*) AS event_count, {dsum('total_amount')} AS amount"),
    lambda s: windows.user_amounts(s, "1 hour", DELAY))


# --- late rows --------------------------------------------------------------------------------

@query("str_23_split_late", with_views(EVENTS) + f"""
, a AS (SELECT event_id, epoch_us(event_time) AS us, epoch_us(event_time) + event_id * 7919 % {LATENESS_SECONDS + 1} * 1000000 AS arrival FROM ev),
b AS (SELECT MIN(arrival) AS low, MAX(arrival) + 1 - MIN(arrival) AS span FROM a),
c AS (SELECT event_id, us, list_sum([CAST(arrival >= low + span * k // {PARTS} AS INT) FOR k IN range(1, {PARTS})]) AS part FROM a, b),
h AS (SELECT part, MAX(MAX(us)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM c GROUP BY part)
SELECT CASE WHEN us < high - 21600000000 THEN 'late' ELSE 'on_time' END AS side, COUNT(*) AS n FROM c JOIN h USING (part) GROUP BY 1""")
def str_23(t):
    """Rows more than six hours behind the batches before theirs leave by the side."""
    out = scratch_path(t.spark, "late")

    def writer(side):
        return lambda df, batch_id: df.write.mode("overwrite").parquet(f"{out}/side={side}/batch_id={batch_id}")

    splitter = lateness.LateSplitter(scratch_path(t.spark, "marks"), "event_time", 6 * 3600, writer("on_time"), writer("late"))
    run_batches(out_of_order(t, PARTS).select("event_id", "event_time"), splitter, "split-late")
    return t.spark.read.parquet(out).groupBy("side").agg(F.count(F.lit(1)).alias("n"))


@query("str_22_with_lateness_stream", with_views(EVENTS) + f"""
SELECT * FROM ({tumble('1 HOUR', 'event_type', f"COUNT(*) AS event_count, {dsum('total_amount')} AS total_revenue")}) WHERE epoch_us(window_end) <= {mark()}""")
def str_22s(t):
    """Half of the delay for disorder, the rest as extra lateness."""
    half = LATENESS_SECONDS // 2
    stream = lateness.with_lateness(out_of_order(t), "event_time", half, half + 1)
    counts = stream.groupBy(F.window("event_time", "1 hour"), "event_type").agg(agg.rows().alias("event_count"), agg.total("total_amount").alias("total_revenue"))
    return run_available(counts.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "event_type", "event_count", "total_revenue"), "lateness")


# --- joins ------------------------------------------------------------------------------------

def sides(events):
    """Purchases and views."""
    buys = events.filter(BOUGHT).select("event_id", "user_id", "event_time", "total_amount")
    views = events.filter(VIEWED).select("user_id", F.col("event_time").alias("viewed_at"), F.col("product_id").alias("viewed_product"))
    return buys, views


@query("join_08_asof_join_stream", with_views(EVENTS) + f"""
, b AS (SELECT event_id, user_id, event_time, total_amount FROM ev WHERE action = 'purchase'),
v AS (SELECT user_id, event_time AS viewed_at, product_id AS viewed_product FROM ev WHERE action = 'view')
SELECT event_id, b.user_id, event_time, total_amount, CASE WHEN viewed_at >= event_time - INTERVAL 2 DAY THEN viewed_at END AS viewed_at,
  CASE WHEN viewed_at >= event_time - INTERVAL 2 DAY THEN viewed_product END AS viewed_product
FROM b ASOF LEFT JOIN v ON b.user_id = v.user_id AND b.event_time >= v.viewed_at WHERE epoch_us(event_time) <= {BOTH_MARK}""")
def join_08s(t):
    """Two streams, each out of order and from files of its own."""
    buys, views = sides(out_of_order(t))[0], sides(out_of_order(t))[1]
    return run_available(asof_stream(buys, views, "user_id", "event_time", "viewed_at", delay=DELAY, tolerance_seconds=2 * 86400), "asof")


@query("join_12_interval_join_stream", with_views(EVENTS) + f"""
, v AS (SELECT event_id AS view_id, user_id, event_time AS viewed_at FROM ev WHERE action = 'view'),
p AS (SELECT event_id AS purchase_id, user_id AS buyer, event_time AS bought_at FROM ev WHERE action = 'purchase'),
j AS (SELECT view_id, purchase_id, user_id, viewed_at FROM v LEFT JOIN p ON user_id = buyer AND bought_at BETWEEN viewed_at AND viewed_at + INTERVAL 6 HOUR)
SELECT view_id, purchase_id, user_id AS viewer FROM j WHERE purchase_id IS NOT NULL OR epoch_us(viewed_at) + 21600000000 < {BOTH_MARK}""")
def join_12s(t):
    """Views with the purchases of the six hours after them, and views without any, once no purchase can come."""
    events = out_of_order(t)
    out = joins.interval_join(*_views_and_buys(events, events), "user_id", "viewed_at", "bought_at", 0, 6 * 3600, "left", DELAY)
    return run_available(out.select("view_id", "purchase_id", "viewer"), "interval-join")


@query("join_12_interval_join_left", with_views(EVENTS) + """
SELECT v.event_id AS view_id, p.event_id AS purchase_id, v.user_id AS viewer FROM (SELECT * FROM ev WHERE action = 'view') v
LEFT JOIN (SELECT * FROM ev WHERE action = 'purchase') p ON v.user_id = p.user_id AND p.event_time BETWEEN v.event_time AND v.event_time + INTERVAL 6 HOUR""")
def join_12l(t):
    out = joins.interval_join(*_views_and_buys(t.events, t.events), "user_id", "viewed_at", "bought_at", 0, 6 * 3600, "left")
    return out.select("view_id", "purchase_id", "viewer")


def _views_and_buys(first, second):
    views = first.filter(VIEWED).select(F.col("event_id").alias("view_id"), F.col("user_id").alias("viewer"), "user_id", F.col("event_time").alias("viewed_at"))
    return views, second.filter(BOUGHT).select(F.col("event_id").alias("purchase_id"), "user_id", F.col("event_time").alias("bought_at"))


@query("join_13_enrich_static_stream", with_views(EVENTS, USERS) + """
SELECT event_id, ev.user_id, action, name, country, tier FROM ev LEFT JOIN users ON ev.user_id = users.user_id""")
def join_13s(t):
    dim = t.users.select("user_id", "name", "country", "tier")
    return run_available(joins.enrich_static(out_of_order(t).select("event_id", "user_id", "action"), dim, ["user_id"]), "enrich")


VERSIONS = "v AS (SELECT user_id, updated_at + to_days(9131) AS since, user_tier FROM user_changes QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, updated_at ORDER BY version DESC) = 1)"


@query("str_18_premium_analytics_stream", with_views(EVENTS, USER_CHANGES, VERSIONS) + f"""
, m AS (SELECT least({mark()}, (SELECT epoch_us(MAX(updated_at + to_days(9131))) - 86401000000 FROM user_changes)) AS us),
e AS (SELECT ev.*, COALESCE(user_tier, 'UNKNOWN') AS user_tier FROM ev ASOF LEFT JOIN v ON ev.user_id = v.user_id AND ev.event_time >= v.since WHERE epoch_us(event_time) <= (SELECT us FROM m))
SELECT * FROM ({tumble('1 HOUR', 'user_tier', f"{dsum('total_amount')} AS total_revenue, {davg('total_amount')} AS avg_order_value, COUNT(DISTINCT user_id) AS user_count", BOUGHT, source='e')})
WHERE epoch_us(window_end) <= {mark(BOUGHT, 'e', 30_000_000)}""")
def str_18s(t):
    """The as-of join of the events with the change stream, and windows over the stream of its results."""
    versions = t.user_changes.select("user_id", (F.col("updated_at") + F.expr("INTERVAL 9131 DAYS")).alias("since"), "version", "user_tier")
    changes = replay(versions, "since", 3, F.pmod(F.col("user_id"), F.lit(3600)) * 1_000_000, "changes")
    enriched = asof_stream(out_of_order(t), changes, "user_id", "event_time", "since", ["version"], delay=DELAY)
    path = scratch_path(t.spark, "enriched")
    schema = run_available(enriched, "enriched", out=path).schema
    return run_available(windows.premium_analytics(t.spark.readStream.schema(schema).parquet(path), "1 hour"), "premium")


@query("lak_04_medallion_stream", with_views(EVENTS) + f"""
SELECT date_trunc('day', event_time) AS day, category, COUNT(*) AS events, {dsum('total_amount')} AS revenue FROM ev
WHERE total_amount > 0 AND product_id IS NOT NULL GROUP BY 1, 2 HAVING epoch_us(date_trunc('day', event_time)) + 86400000000 <= {mark("total_amount > 0 AND product_id IS NOT NULL")}""")
def lak_04s(t):
    """Bronze, silver and gold as three streams, each over the files of the one before."""
    def gold(s):
        days = s.withWatermark("event_time", DELAY).groupBy(F.window("event_time", "1 day").alias("window"), "category").agg(agg.rows().alias("events"), agg.total("total_amount").alias("revenue"))
        return days.select(F.col("window.start").alias("day"), "category", "events", "revenue")

    flow = lake.Medallion(silver=lambda b: b.filter((F.col("total_amount") > 0) & F.col("product_id").isNotNull()), gold=gold)
    return medallion_stream(flow, out_of_order(t), scratch_path(t.spark, "medallion"))[2]


# --- keyed state ------------------------------------------------------------------------------

PAST = f"epoch_us(event_time) <= {mark()}"
_LIFE = "86400000000"


@query("sta_01_user_profile_stream", with_views(EVENTS) + f"""
, g AS (SELECT *, CASE WHEN epoch_us(event_time) - epoch_us(LAG(event_time) OVER w) > {_LIFE} THEN 1 ELSE 0 END AS away FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY event_time, event_id)),
l AS (SELECT *, SUM(away) OVER (PARTITION BY user_id ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) AS life FROM g),
r AS (SELECT *, COUNT(*) FILTER (action = 'login') OVER w AS logins, COALESCE(SUM(CAST(total_amount AS DECIMAL(18,2))) FILTER (action = 'purchase') OVER w, 0) AS spent,
  list(product_id) FILTER (action = 'purchase') OVER w AS bought, list(category) FILTER (action = 'view') OVER w AS viewed,
  MAX(epoch_us(event_time)) OVER (PARTITION BY user_id, life) AS last_us FROM l WINDOW w AS (PARTITION BY user_id, life ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING)),
t AS (SELECT *, CAST(spent >= 60 AS INT) + CAST(spent >= 120 AS INT) + CAST(spent >= 180 AS INT) AS lv FROM r),
u AS (SELECT *, COALESCE(LAG(lv) OVER (PARTITION BY user_id, life ORDER BY event_time, event_id), 0) AS lv_before FROM t)
SELECT user_id, 'PROFILE' AS kind, event_id, epoch_us(event_time) // 1000 AS at_ms, logins AS session_count, CAST(spent AS DOUBLE) AS total_spent, ['BRONZE', 'SILVER', 'GOLD', 'PLATINUM'][lv + 1] AS tier,
  COALESCE(array_to_string(bought[-10:], ','), '') AS recent_purchases,
  COALESCE(array_to_string(list_transform(map_entries(list_aggregate(viewed, 'histogram')), lambda e: e.key || '=' || e.value), ','), '') AS preferences, '' AS benefits FROM u WHERE {PAST}
UNION ALL
SELECT user_id, 'TIER_ACTIVATED', NULL, (epoch_us(event_time) + 86400000000) // 1000, logins, CAST(spent AS DOUBLE), ['BRONZE', 'SILVER', 'GOLD', 'PLATINUM'][lv + 1], '', '',
  ['', 'Basic support|5% discount', 'Priority support|10% discount|Free shipping', 'VIP support|15% discount|Free shipping|Early access'][lv + 1]
FROM u WHERE lv > lv_before AND epoch_us(event_time) + 86400000000 <= least(last_us + {_LIFE}, {mark()})""")
def sta_01s(t):
    """Profiles that are forgotten after a day, with steps low enough for several upgrades in a day."""
    out = run_available(stateful.user_profiles(out_of_order(t), DELAY, ttl_hours=24, steps=((60, "SILVER"), (120, "GOLD"), (180, "PLATINUM"))), "user-profile")
    entries = F.transform(F.array_sort(F.map_entries("preferences")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    texts = {"preferences": F.array_join(entries, ","), "recent_purchases": F.array_join(F.col("recent_purchases").cast("array<string>"), ","), "benefits": F.array_join("benefits", "|")}
    return out.withColumns({n: F.coalesce(c, F.lit("")) for n, c in texts.items()})


@query("sta_02_session_tracker_stream", with_views(EVENTS, marked("12 HOUR")) + f"""
, s AS (SELECT user_id, session_no, CAST(floor(epoch_us(MIN(event_time)) / 1000) AS BIGINT) AS session_start_ms, CAST(floor(epoch_us(MAX(event_time)) / 1000) AS BIGINT) AS last_event_ms,
  COUNT(*) AS event_count, COUNT(DISTINCT category) AS unique_categories, COALESCE({dsum("CASE WHEN action = 'purchase' THEN total_amount END")}, 0) AS total_spent,
  COUNT(*) FILTER (action = 'view') AS view_count, COUNT(*) FILTER (action = 'add_to_cart') AS cart_count, COUNT(*) FILTER (action = 'purchase') AS purchase_count, MAX(epoch_us(event_time)) AS last_us
  FROM numbered GROUP BY 1, 2)
SELECT * EXCLUDE (session_no, last_us), view_count + 3 * cart_count + 5 * purchase_count + 2 * unique_categories AS engagement_score FROM s WHERE last_us + 43200000000 < {mark()}""")
def sta_02s(t):
    return run_available(stateful.track_sessions(out_of_order(t), 12 * 3600, DELAY, running=False), "session-state").drop("is_final")


@query("sta_03_product_popularity_stream", with_views(EVENTS) + f"""
, c AS (SELECT product_id, CAST(floor(epoch_us(event_time) / 3600000000) AS BIGINT) AS h, COUNT(*) FILTER (action = 'view') AS v, COUNT(*) FILTER (action = 'purchase') AS p,
  COALESCE(SUM(CAST(CASE WHEN action = 'purchase' THEN total_amount END AS DECIMAL(18,2))), 0) AS r FROM ev GROUP BY 1, 2),
u AS (SELECT DISTINCT product_id, user_id, CAST(floor(epoch_us(event_time) / 3600000000) AS BIGINT) AS h FROM ev),
n AS (SELECT c.product_id, c.h, COUNT(DISTINCT u.user_id) AS unique_users FROM c JOIN u ON u.product_id = c.product_id AND u.h BETWEEN c.h - 24 AND c.h GROUP BY 1, 2),
s AS (SELECT product_id, h, CAST(SUM(v) OVER w AS BIGINT) AS total_views, CAST(SUM(p) OVER w AS BIGINT) AS total_purchases, CAST(SUM(r) OVER w AS DOUBLE) AS total_revenue,
  CAST(SUM(CASE WHEN v > 0 OR p > 0 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS hours_with_activity FROM c WINDOW w AS (PARTITION BY product_id ORDER BY h RANGE BETWEEN 24 PRECEDING AND CURRENT ROW))
SELECT product_id, make_timestamp(h * 3600000000) AS hour, total_views, total_purchases, total_revenue, unique_users, hours_with_activity, total_purchases / GREATEST(total_views, 1) AS conversion_rate,
  total_views + total_purchases * 5 + unique_users * 3 + hours_with_activity * 2 AS popularity_score FROM s JOIN n USING (product_id, h) WHERE (h + 1) * 3600000000 <= {mark()}""")
def sta_03s(t):
    return run_available(stateful.popularity(out_of_order(t), 24, DELAY), "popularity")


@query("sta_04_online_features_stream", with_views(EVENTS) + f"""
, f AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, category ORDER BY event_time, event_id) = 1 AS a, ROW_NUMBER() OVER (PARTITION BY product_id, user_id ORDER BY event_time, event_id) = 1 AS b,
  ROW_NUMBER() OVER (PARTITION BY session_id, category ORDER BY event_time, event_id) = 1 AS c FROM ev)
SELECT event_id, COUNT(*) OVER {running('user_id')} AS user_events, CAST(SUM({SPENT}) OVER {running('user_id')} AS DOUBLE) AS user_spent, CAST(SUM(CAST(a AS INT)) OVER {running('user_id')} AS BIGINT) AS user_categories,
  COALESCE((epoch_us(event_time) - epoch_us(LAG(event_time) OVER (PARTITION BY user_id ORDER BY event_time, event_id))) // 1000, 0) AS since_last_activity_ms,
  CAST(SUM(CAST(action = 'view' AS INT)) OVER {running('product_id')} AS BIGINT) AS product_views, CAST(SUM(CAST(action = 'purchase' AS INT)) OVER {running('product_id')} AS BIGINT) AS product_purchases,
  CAST(SUM(CAST(b AS INT)) OVER {running('product_id')} AS BIGINT) AS product_viewers, CAST(SUM({SPENT}) OVER {running('product_id')} AS DOUBLE) AS product_revenue,
  COUNT(*) OVER {running('session_id')} AS session_events, CAST(SUM(CAST(c AS INT)) OVER {running('session_id')} AS BIGINT) AS session_categories,
  (epoch_us(event_time) - epoch_us(MIN(event_time) OVER {running('session_id')})) // 1000 AS session_duration_ms FROM f QUALIFY {PAST}""")
def sta_04s(t):
    """User, product and session features as three streams, one row per event with all three."""
    u, p, s = (run_available(stateful.feature_stream(out_of_order(t), kind, DELAY), f"{kind}-features") for kind in stateful.FEATURES)
    users = u.select("event_id", F.col("events").alias("user_events"), F.col("spent").alias("user_spent"), F.col("members").alias("user_categories"), F.col("since_last_ms").alias("since_last_activity_ms"))
    products = p.select("event_id", F.col("views").alias("product_views"), F.col("purchases").alias("product_purchases"), F.col("members").alias("product_viewers"), F.col("spent").alias("product_revenue"))
    sessions = s.select("event_id", F.col("events").alias("session_events"), F.col("members").alias("session_categories"), F.col("since_first_ms").alias("session_duration_ms"))
    return users.join(products, "event_id").join(sessions, "event_id")


@query("sta_05_user_behavior_state_stream", with_views(EVENTS) + f"""
, s AS (SELECT event_id, user_id, event_time, COUNT(*) OVER {running('user_id')} AS total_events, SUM({SPENT}) OVER {running('user_id')} AS spent FROM ev)
SELECT event_id, user_id, event_time, total_events, CAST(spent AS DOUBLE) AS total_spent, CASE WHEN spent >= 1000 THEN 'GOLD' WHEN spent >= 300 THEN 'SILVER' ELSE 'BRONZE' END AS user_tier FROM s WHERE {PAST}""")
def sta_05s(t):
    return run_available(stateful.behavior_states(out_of_order(t), 300, 1000, DELAY), "behavior-state")


@query("sta_06_fraud_state_stream", with_views(EVENTS) + f"""
, k AS (SELECT *, event_time - LAG(event_time) OVER w AS gap FROM ev WHERE total_amount > 50 WINDOW w AS (PARTITION BY user_id ORDER BY event_time, event_id)),
i AS (SELECT *, SUM(CASE WHEN gap IS NULL OR gap > INTERVAL 1 DAY THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) AS island FROM k),
s AS (SELECT *, SUM(CAST(total_amount AS DECIMAL(18,2))) OVER (PARTITION BY user_id, island ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) AS spending FROM i),
c AS (SELECT *, CASE WHEN total_amount > 150 THEN 50 ELSE 0 END + CASE WHEN spending > 200 THEN 30 ELSE 0 END + CASE WHEN gap < INTERVAL 2 HOUR THEN 40 ELSE 0 END AS fraud_score FROM s)
SELECT event_id, user_id, event_time, total_amount AS amount, CAST(spending AS DOUBLE) AS recent_spending, fraud_score,
  CASE WHEN gap < INTERVAL 2 HOUR THEN 'RAPID_TRANSACTIONS' WHEN spending > 200 THEN 'HIGH_VOLUME' WHEN total_amount > 150 THEN 'HIGH_VALUE' ELSE 'SUSPICIOUS' END AS alert_type
FROM c WHERE fraud_score >= 40 AND epoch_us(event_time) <= {mark('total_amount > 50')}""")
def sta_06s(t):
    return run_available(stateful.fraud_alerts(out_of_order(t), DELAY, floor=50, high=150, volume=200, reset_seconds=86400, rapid_seconds=7200), "fraud-state")


@query("str_16_count_trigger_stream", with_views(EVENTS) + f"""
, r AS (SELECT *, CASE WHEN event_time - LAG(event_time) OVER w >= INTERVAL 1 DAY THEN 1 ELSE 0 END AS pause FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY event_time, event_id)),
g AS (SELECT *, SUM(pause) OVER (PARTITION BY user_id ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) AS run FROM r),
b AS (SELECT *, (ROW_NUMBER() OVER (PARTITION BY user_id, run ORDER BY event_time, event_id) - 1) // 4 AS k, MAX(epoch_us(event_time)) OVER (PARTITION BY user_id, run) AS run_end FROM g),
o AS (SELECT user_id, run, k, COUNT(*) AS event_count, {dsum('total_amount')} AS total_amount, MIN(epoch_us(event_time)) // 1000 AS first_ms, MAX(epoch_us(event_time)) AS last_us, ANY_VALUE(run_end) AS run_end FROM b GROUP BY ALL)
SELECT user_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY run, k) AS batch_no, event_count, total_amount, first_ms, last_us // 1000 AS last_ms, event_count < 4 AS is_partial
FROM o QUALIFY CASE WHEN event_count = 4 THEN last_us ELSE run_end + 86400000000 END <= {mark()}""")
def str_16s(t):
    """An aggregate for every four events of a user, the rest after a day without events."""
    return run_available(stateful.count_batches(out_of_order(t), 4, 86400, DELAY), "count-trigger")
