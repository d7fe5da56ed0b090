"""Features, models, graphs, time series and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions.measures import total
from tidewell.operators import features, graph, ml, search, timeseries
from tidewell.plans.oracle_views import EVENTS, ORDERS, SALES, TRANSFERS, dsum, with_views
from tidewell.plans.registry import query


def _views(t):
    daily = t.events.filter("action = 'purchase'").groupBy(
        "user_id", F.date_trunc("day", "event_time").alias("ready_at")
    ).agg(total("total_amount").alias("spent"), F.count(F.lit(1)).alias("orders"))
    daily = daily.withColumn("ready_at", F.col("ready_at") + F.expr("INTERVAL 1 DAY"))
    seen = t.events.filter("action = 'view'").select("user_id", F.col("event_time").alias("seen_at"), "category", "event_id")
    return [
        features.FeatureView("daily", daily, "user_id", "ready_at", "5 days"),
        features.FeatureView("seen", seen, "user_id", "seen_at", None, ("event_id",)),
    ]


@query("fea_01_historical_features", with_views(EVENTS) + f"""
, d AS (SELECT user_id, date_trunc('day', event_time) + INTERVAL 1 DAY AS ready_at, {dsum('total_amount')} AS spent, COUNT(*) AS orders FROM ev WHERE action = 'purchase' GROUP BY 1, 2),
s AS (SELECT user_id, event_time AS seen_at, category FROM ev WHERE action = 'view'),
e AS (SELECT event_id, user_id, event_time FROM ev WHERE action = 'add_to_cart')
SELECT e.event_id, e.user_id, e.event_time, CASE WHEN ready_at >= event_time - INTERVAL 5 DAY THEN spent END AS daily__spent,
  CASE WHEN ready_at >= event_time - INTERVAL 5 DAY THEN orders END AS daily__orders, s.category AS seen__category
FROM e ASOF LEFT JOIN d ON e.user_id = d.user_id AND e.event_time >= d.ready_at ASOF LEFT JOIN s ON e.user_id = s.user_id AND e.event_time >= s.seen_at""")
def fea_01(t):
    entities = t.events.filter("action = 'add_to_cart'").select("event_id", "user_id", "event_time")
    return features.historical_features(entities, "event_time", _views(t))


@query("fea_02_materialize_latest", with_views(EVENTS) + f"""
, d AS (SELECT user_id, date_trunc('day', event_time) + INTERVAL 1 DAY AS ready_at, {dsum('total_amount')} AS spent, COUNT(*) AS orders FROM ev WHERE action = 'purchase' GROUP BY 1, 2)
SELECT * FROM d WHERE ready_at >= TIMESTAMP '2024-01-05' AND ready_at < TIMESTAMP '2024-01-20' QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ready_at DESC) = 1""")
def fea_02(t):
    return features.materialize_latest(_views(t)[0], "2024-01-05", "2024-01-20")


def _spans(name, interval):
    frame = f"OVER (PARTITION BY user_id ORDER BY event_time RANGE BETWEEN INTERVAL {interval} PRECEDING AND CURRENT ROW)"
    s = f"CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) {frame} AS DOUBLE)"
    return f"COUNT(*) {frame} AS count_{name}, {s} AS sum_{name}, {s} / COUNT(*) {frame} AS avg_{name}"


@query("fea_03_rolling_features", with_views(EVENTS) + f"""
SELECT event_id, user_id, event_time, total_amount, {_spans('1h', '1 HOUR')}, {_spans('24h', '24 HOUR')}, {_spans('7d', '7 DAY')},
  date_diff('day', MIN(event_time) OVER (PARTITION BY user_id ORDER BY event_time), event_time) AS account_age_days FROM ev""")
def fea_03(t):
    tx = t.events.select("event_id", "user_id", "event_time", "total_amount")
    return features.rolling_features(tx, "user_id", "event_time", "event_id", "total_amount", {"1h": 3600, "24h": 86400, "7d": 604800})


@query("fea_04_rfm", with_views(ORDERS) + f"""
, b AS (SELECT user_id, date_diff('day', CAST(MAX(order_date) AS DATE), DATE '2001-12-01') AS recency_days, COUNT(*) AS frequency, {dsum('amount')} AS monetary, COUNT(DISTINCT payment_method) AS diversity FROM user_orders GROUP BY 1)
SELECT *, monetary / frequency AS avg_order_value, NTILE(5) OVER (ORDER BY recency_days DESC, user_id) AS r_score, NTILE(5) OVER (ORDER BY frequency, user_id) AS f_score,
  NTILE(5) OVER (ORDER BY monetary, user_id) AS m_score FROM b""")
def fea_04(t):
    return features.rfm(t.user_orders, "2001-12-01", kind="payment_method")


@query("ml_01_train_tabular", """
WITH d AS (SELECT CAST(l_orderkey AS BIGINT) AS k, CAST(l_quantity AS DOUBLE) AS x, CAST(p_retailprice AS DOUBLE) AS z, CAST(l_extendedprice AS DOUBLE) AS y FROM lineitem JOIN part ON l_partkey = p_partkey),
m AS (SELECT AVG(x) AS mx, AVG(z) AS mz, AVG(y) AS my, var_pop(x) AS xx, var_pop(z) AS zz, covar_pop(x, z) AS xz, covar_pop(x, y) AS xy, covar_pop(z, y) AS zy FROM d WHERE k % 5 <> 0),
b AS (SELECT *, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS bx, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS bz FROM m),
c AS (SELECT bx, bz, my - bx * mx - bz * mz AS b0 FROM b)
SELECT ROUND(ANY_VALUE(bx), 4) AS per_unit, ROUND(ANY_VALUE(bz), 4) AS per_price, ROUND(ANY_VALUE(b0), 2) AS intercept, ROUND(sqrt(AVG(pow(y - b0 - bx * x - bz * z, 2))), 2) AS rmse, COUNT(*) AS held_out
FROM d, c WHERE k % 5 = 0""")
def ml_01(t):
    """Least squares on four fifths of the orders against its closed form."""
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("id"), F.col("l_quantity").cast("double").alias("quantity"), F.col("p_retailprice").cast("double").alias("price"), F.col("l_extendedprice").cast("double").alias("label"),
    )
    model, rmse = ml.train_tabular(lines, ["quantity", "price"], "label", "linear", holdout=F.col("id") % 5 == 0)
    fitted = model.stages[-1]
    scored = ml.predict(model, lines.filter(F.col("id") % 5 == 0), ["quantity", "price"])
    error = F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("label"), 2)))
    return scored.agg(
        F.round(F.lit(float(fitted.coefficients[0])), 4).alias("per_unit"), F.round(F.lit(float(fitted.coefficients[1])), 4).alias("per_price"),
        F.round(F.lit(float(fitted.intercept)), 2).alias("intercept"), F.round(F.greatest(error, F.lit(float(rmse))), 2).alias("rmse"), F.count(F.lit(1)).alias("held_out"),
    )


@query("ml_02_fraud_training_set", with_views(EVENTS) + """
, v AS (SELECT event_id, user_id, total_amount AS amount, COUNT(*) OVER (PARTITION BY user_id ORDER BY event_time RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS velocity_1h,
  COUNT(*) OVER (PARTITION BY user_id ORDER BY event_time RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS velocity_24h FROM ev)
SELECT *, CASE WHEN amount > 150 OR velocity_1h > 1 THEN 1 ELSE 0 END AS is_fraud FROM v""")
def ml_02(t):
    return ml.fraud_training_set(t.events, "user_id", "event_time", "event_id", "total_amount", 150, 1)


@query("ml_03_cluster_users", with_views(ORDERS) + """
SELECT COUNT(DISTINCT user_id) AS users, 5 AS clusters, 0 AS unassigned, 0 AS not_nearest, TRUE AS tighter_than_one FROM user_orders""")
def ml_03(t):
    """Every user is with the nearest centre, and the clusters are less than half as wide as all users together."""
    rfm = features.rfm(t.user_orders, "2001-12-01")
    clustered, model = ml.cluster_users(rfm, ["recency_days", "frequency", "monetary"], 5)
    near = ml.centre_distances(model, rfm)
    own, least = F.get("distances", F.col("cluster")), F.array_min("distances")
    # In the scaled space all users together have a mean squared distance of one per feature.
    checks = near.agg(F.count_if(own > least + 1e-9).alias("not_nearest"), (F.avg(least) < 0.5 * 3).alias("tighter_than_one"))
    counts = clustered.agg(F.count(F.lit(1)).alias("users"), F.count_distinct("cluster").alias("clusters"), F.count_if(F.col("cluster").isNull()).alias("unassigned"))
    return counts.join(F.broadcast(checks))


# --- graph ------------------------------------------------------------------------------

@query("gra_01_degree_topk", with_views(EVENTS, TRANSFERS) + """
SELECT node, COUNT(*) AS degree FROM (SELECT src AS node FROM transfers UNION ALL SELECT dst FROM transfers) GROUP BY 1 ORDER BY degree DESC, node LIMIT 10""")
def gra_01(t):
    return graph.degree_topk(t.transfers, 10)


_LINKS = """links AS (SELECT DISTINCT src, dst FROM (SELECT src, dst FROM transfers UNION ALL SELECT dst, src FROM transfers) WHERE src <> dst)"""


def _label_rounds(n):
    parts = ["l0 AS (SELECT DISTINCT src AS node, src AS label FROM links)"]
    for i in range(1, n + 1):
        parts.append(
            f"l{i} AS (SELECT src AS node, label FROM (SELECT src, label, COUNT(*) AS n FROM links JOIN l{i - 1} ON dst = node GROUP BY 1, 2) "
            "QUALIFY ROW_NUMBER() OVER (PARTITION BY src ORDER BY n DESC, label) = 1)"
        )
    return ",\n".join(parts)


@query("gra_02_label_propagation", with_views(EVENTS, TRANSFERS, _LINKS, _label_rounds(5)) + "SELECT node, label FROM l5")
def gra_02(t):
    return graph.label_propagation(t.transfers, 5)


def _rank_rounds(n):
    parts = [
        "e AS (SELECT DISTINCT src, dst FROM transfers)",
        "d AS (SELECT src, COUNT(*) AS k FROM e GROUP BY 1)",
        "nodes AS (SELECT node, k FROM (SELECT src AS node FROM e UNION SELECT dst FROM e) LEFT JOIN d ON node = src)",
        "c AS (SELECT COUNT(*) AS n FROM nodes)",
        "r0 AS (SELECT node, k, 1.0::DOUBLE / n AS rank FROM nodes, c)",
    ]
    for i in range(1, n + 1):
        parts.append(
            f"g{i} AS (SELECT dst, SUM(rank / k) AS got FROM e JOIN r{i - 1} ON src = node GROUP BY 1),"
            f"r{i} AS (SELECT nodes.node, nodes.k, 0.15::DOUBLE / n + 0.85::DOUBLE * (COALESCE(got, 0) + (SELECT COALESCE(SUM(rank), 0) FROM r{i - 1} WHERE k IS NULL) / n) AS rank "
            f"FROM nodes LEFT JOIN g{i} ON nodes.node = dst, c)"
        )
    return ",\n".join(parts)


@query("gra_03_pagerank", with_views(EVENTS, TRANSFERS, _rank_rounds(6)) + "SELECT node, ROUND(rank, 9) AS rank FROM r6")
def gra_03(t):
    return graph.pagerank(t.transfers, 0.85, 6).select("node", F.round("rank", 9).alias("rank"))


@query("gra_04_transfer_chains", with_views(EVENTS, TRANSFERS) + """
, r AS (SELECT * FROM transfers WHERE amount > 120 AND sent_at > TIMESTAMP '2024-01-20'),
p2 AS (SELECT [a.transfer_id, b.transfer_id] AS path, a.src AS first, b.dst AS last, CAST(a.amount AS DECIMAL(24,2)) + CAST(b.amount AS DECIMAL(24,2)) AS total FROM r a JOIN r b ON a.dst = b.src AND a.transfer_id <> b.transfer_id),
p3 AS (SELECT list_append(path, transfer_id) AS path, first, dst AS last, total + CAST(amount AS DECIMAL(24,2)) AS total FROM p2 JOIN r ON last = src WHERE NOT list_contains(path, transfer_id)),
p4 AS (SELECT list_append(path, transfer_id) AS path, first, dst AS last, total + CAST(amount AS DECIMAL(24,2)) AS total FROM p3 JOIN r ON last = src WHERE NOT list_contains(path, transfer_id))
SELECT array_to_string(path, '>') AS path, first, last, CAST(total AS DOUBLE) AS total_amount, len(path) AS hops
FROM (SELECT * FROM p2 UNION ALL SELECT * FROM p3 UNION ALL SELECT * FROM p4) WHERE first <> last""")
def gra_04(t):
    chains = graph.transfer_chains(t.transfers, 120, "2024-01-20", 2, 4)
    return chains.withColumn("path", F.array_join(F.col("path").cast("array<string>"), ">"))


@query("gra_05_co_purchase", with_views(SALES) + """
, p AS (SELECT DISTINCT user_id, product_id FROM sales)
SELECT c.product_id, COUNT(*) AS score FROM p a JOIN p b ON a.product_id = b.product_id AND b.user_id <> 1 JOIN p c ON b.user_id = c.user_id
WHERE a.user_id = 1 AND c.product_id NOT IN (SELECT product_id FROM p WHERE user_id = 1) GROUP BY 1 ORDER BY score DESC, c.product_id LIMIT 10""")
def gra_05(t):
    return graph.co_purchase(t.purchases, 1, 10)


@query("gra_06_graph_features", with_views(EVENTS, TRANSFERS, _LINKS, SALES) + """
SELECT c_custkey AS user_id, COALESCE(f, 0) AS friend_count, COALESCE(p, 0) AS purchase_count FROM customer
LEFT JOIN (SELECT src, COUNT(*) AS f FROM links GROUP BY 1) ON c_custkey = src
LEFT JOIN (SELECT user_id, COUNT(DISTINCT product_id) AS p FROM sales GROUP BY 1) s ON c_custkey = s.user_id""")
def gra_06(t):
    return graph.graph_features(t.customer.select(F.col("c_custkey").alias("user_id")), t.transfers, t.sales("user_id", "product_id"))


@query("gra_07_build_graph", with_views(EVENTS) + """
SELECT 'edge' AS part, upper(action) AS label, COUNT(*) AS n FROM (SELECT DISTINCT user_id, product_id, action FROM ev) GROUP BY 2
UNION ALL SELECT 'vertex', 'User', COUNT(DISTINCT user_id) FROM ev UNION ALL SELECT 'vertex', 'Product', COUNT(DISTINCT product_id) FROM ev""")
def gra_07(t):
    vertices, edges = graph.build_graph(t.events, "user_id", "product_id", "action")
    count = F.count(F.lit(1)).alias("n")
    return edges.groupBy(F.lit("edge").alias("part"), F.col("kind").alias("label")).agg(count).unionByName(
        vertices.groupBy(F.lit("vertex").alias("part"), "label").agg(count)
    )


@query("gra_08_components", f"WITH RECURSIVE {EVENTS}, {TRANSFERS}, {_LINKS}," + """
reach(node, other) AS (SELECT DISTINCT src, src FROM links UNION SELECT links.src, other FROM reach JOIN links ON links.dst = reach.node)
SELECT node, MIN(other) AS component FROM reach GROUP BY 1""")
def gra_08(t):
    return graph.components(t.transfers)


@query("gra_08_shortest_hops", f"WITH RECURSIVE {EVENTS}, {TRANSFERS}," + """
hop(node, hops) AS (SELECT MIN(src), 0 FROM transfers UNION SELECT dst, hops + 1 FROM hop JOIN transfers ON src = node WHERE hops < 3)
SELECT node, MIN(hops) AS hops FROM hop GROUP BY 1""")
def gra_08b(t):
    return graph.shortest_hops(t.transfers, t.transfers.agg(F.min("src").alias("node")), 3)


# --- time series -------------------------------------------------------------------------

def _frame(k):
    return f"list(total_amount) OVER (PARTITION BY category ORDER BY event_time, event_id ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"


@query("ts_01_indicators", with_views(EVENTS).replace("WITH ", "WITH RECURSIVE ", 1) + f"""
, w AS (SELECT event_id, category, total_amount AS p, ROW_NUMBER() OVER (PARTITION BY category ORDER BY event_time, event_id) AS rn, {_frame(14)} AS l, {_frame(15)} AS d FROM ev),
e AS (SELECT event_id, category, rn, p AS e14, p AS e12, p AS e26 FROM w WHERE rn = 1
  UNION ALL SELECT w.event_id, w.category, w.rn, e14 + (w.p - e14) * 2 / 15, e12 + (w.p - e12) * 2 / 13, e26 + (w.p - e26) * 2 / 27 FROM e JOIN w ON w.category = e.category AND w.rn = e.rn + 1),
x AS (SELECT *, list_transform(range(2, len(d) + 1), lambda i: d[i] - d[i - 1]) AS s FROM w),
y AS (SELECT *, COALESCE(list_sum(list_transform(s, lambda v: GREATEST(v, 0))), 0) AS gain, COALESCE(list_sum(list_transform(s, lambda v: GREATEST(-v, 0))), 0) AS loss FROM x)
SELECT y.event_id, y.category, ROUND(list_avg(l), 6) AS sma, ROUND(list_sum(list_transform(range(1, len(l) + 1), lambda i: l[i] * i)) / (len(l) * (len(l) + 1) / 2), 6) AS wma,
  ROUND(e14, 6) AS ema, ROUND(CASE WHEN y.rn <= 1 THEN NULL WHEN loss = 0 THEN 100 ELSE 100 - 100 / (1 + gain / loss) END, 6) AS rsi,
  ROUND(e12 - e26, 6) AS macd, ROUND(list_avg(l) + 2 * list_stddev_pop(l), 6) AS bollinger_upper, ROUND(list_avg(l) - 2 * list_stddev_pop(l), 6) AS bollinger_lower FROM y JOIN e USING (event_id)""")
def ts_01(t):
    ticks = t.events.select("event_id", "category", "event_time", "total_amount")
    out = timeseries.indicators(ticks, "category", ["event_time", "event_id"], "total_amount")
    names = ["sma", "wma", "ema", "rsi", "macd", "bollinger_upper", "bollinger_lower"]
    return out.select("event_id", "category", *[F.round(n, 6).alias(n) for n in names])


@query("ts_02_historical_var", with_views(EVENTS) + """
, r AS (SELECT category, (total_amount - LAG(total_amount) OVER w) / LAG(total_amount) OVER w AS ret FROM ev WINDOW w AS (PARTITION BY category ORDER BY event_time, event_id))
SELECT category, ROUND(-quantile_disc(ret, 0.05), 9) AS value_at_risk FROM r GROUP BY 1""")
def ts_02(t):
    ticks = t.events.select("event_id", "category", "event_time", "total_amount")
    series = timeseries.returns(ticks, "category", ["event_time", "event_id"], "total_amount")
    return timeseries.historical_var(series, "category").select("category", F.round("value_at_risk", 9).alias("value_at_risk"))


@query("ts_02_running_pnl", with_views(EVENTS) + """
SELECT event_id, user_id, CAST(SUM(CAST(CASE WHEN action = 'purchase' THEN total_amount ELSE -total_amount END AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS pnl
FROM ev WHERE action IN ('purchase', 'remove')""")
def ts_02b(t):
    trades = t.events.filter("action IN ('purchase', 'remove')").select("event_id", "user_id", "event_time", "action", "total_amount")
    signed = F.when(F.col("action") == "purchase", F.col("total_amount")).otherwise(-F.col("total_amount"))
    return timeseries.running_pnl(trades, "user_id", ["event_time", "event_id"], signed).select("event_id", "user_id", "pnl")


@query("ts_03_sensor_zscore", with_views(EVENTS) + """
, z AS (SELECT event_id, user_id, (total_amount - AVG(total_amount) OVER w) / NULLIF(STDDEV_POP(total_amount) OVER w, 0) AS z
  FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY event_time, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
SELECT event_id, user_id, ROUND(z, 5) AS zscore, COALESCE(ABS(z) > 2.5, false) AS is_anomaly FROM z""")
def ts_03(t):
    readings = t.events.select("event_id", "user_id", "event_time", "total_amount")
    out = timeseries.sensor_zscore(readings, "user_id", ["event_time", "event_id"], "total_amount", 20, 2.5)
    return out.select("event_id", "user_id", F.round("zscore", 5).alias("zscore"), "is_anomaly")


@query("ts_03_downsample", with_views(EVENTS) + """
SELECT category, time_bucket(INTERVAL 6 HOUR, event_time, TIMESTAMP '1970-01-01') AS bucket, COUNT(*) AS n, ROUND(AVG(total_amount), 6) AS mean_value, MIN(total_amount) AS min_value, MAX(total_amount) AS max_value FROM ev GROUP BY 1, 2""")
def ts_03b(t):
    return timeseries.downsample(t.events, "category", "event_time", "total_amount", "6 hours")


@query("ts_03_gap_fill", with_views(EVENTS) + """
, b AS (SELECT user_id, date_trunc('day', event_time) AS bucket, MAX(total_amount) AS v FROM ev GROUP BY 1, 2),
c AS (SELECT user_id, UNNEST(generate_series(MIN(bucket), MAX(bucket), INTERVAL 1 DAY)) AS bucket FROM b GROUP BY 1)
SELECT c.user_id, c.bucket, v IS NULL AS is_filled, LAST_VALUE(v IGNORE NULLS) OVER (PARTITION BY c.user_id ORDER BY c.bucket ROWS UNBOUNDED PRECEDING) AS v
FROM c LEFT JOIN b ON c.user_id = b.user_id AND c.bucket = b.bucket""")
def ts_03c(t):
    buckets = t.events.groupBy("user_id", F.date_trunc("day", "event_time").alias("bucket")).agg(F.max("total_amount").alias("v"))
    return timeseries.gap_fill(buckets, "user_id", "bucket", "v", "1 DAY")


@query("ts_04_rule_checks", with_views(EVENTS) + """
, p AS (SELECT *, 40.0::DOUBLE + product_id % 10 AS lat, -70.0::DOUBLE + product_id % 7 AS lon FROM ev),
q AS (SELECT *, COUNT(*) OVER (PARTITION BY user_id ORDER BY event_time RANGE BETWEEN INTERVAL 1 MINUTE PRECEDING AND CURRENT ROW) AS last_minute,
  LAG(lat) OVER w AS a, LAG(lon) OVER w AS b, LAG(event_time) OVER w AS before FROM p WINDOW w AS (PARTITION BY user_id ORDER BY event_time, event_id)),
d AS (SELECT *, 2 * 6371 * asin(sqrt(LEAST(1, pow(sin(radians(lat - a) / 2), 2) + cos(radians(a)) * cos(radians(lat)) * pow(sin(radians(lon - b) / 2), 2)))) AS km,
  (epoch_us(event_time) - epoch_us(before)) / 3600000000 AS hours FROM q)
SELECT event_id, last_minute, ROUND(km / NULLIF(hours, 0), 3) AS speed_kmh, last_minute > 1 AS velocity_flag, COALESCE(km / NULLIF(hours, 0) > 200, false) AS travel_flag, hour(event_time) BETWEEN 0 AND 5 AS off_hours_flag FROM d""")
def ts_04(t):
    place = t.events.withColumns({"lat": F.col("product_id") % 10 + 40.0, "lon": F.col("product_id") % 7 - 70.0})
    out = timeseries.rule_checks(place.select("event_id", "user_id", "event_time", "lat", "lon"), "user_id", "event_time", "event_id", "lat", "lon", 1, 200.0)
    return out.select("event_id", "last_minute", F.round("speed_kmh", 3).alias("speed_kmh"), "velocity_flag", "travel_flag", "off_hours_flag")


@query("ts_05_cart_abandonment", with_views(EVENTS) + """
, a AS (SELECT event_id, user_id, product_id, event_time FROM ev WHERE action = 'add_to_cart'),
n AS (SELECT a.*, (SELECT MIN(b.event_time) FROM ev b WHERE b.action = 'purchase' AND b.user_id = a.user_id AND b.product_id = a.product_id AND b.event_time >= a.event_time) AS next_purchase FROM a)
SELECT * FROM n WHERE next_purchase IS NULL OR next_purchase > event_time + INTERVAL 3 DAY""")
def ts_05(t):
    return timeseries.cart_abandonment(t.events, "3 days")


# --- search --------------------------------------------------------------------------------

@query("sea_01_cosine_topk", """
WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
x AS (SELECT label, UNNEST(e) AS value, UNNEST(range(1, len(e) + 1)) AS pos FROM v),
q AS (SELECT label, list(m ORDER BY pos) AS e FROM (SELECT label, pos, AVG(value) AS m FROM x GROUP BY 1, 2) GROUP BY 1),
s AS (SELECT q.label AS query_id, v.vec_id, list_cosine_similarity(q.e, v.e) AS score FROM q, v)
SELECT query_id, vec_id, ROUND(score, 6) AS score FROM s QUALIFY ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20""")
def sea_01(t):
    # One search per label: the vectors closest to the label's centre.
    parts = t.embeddings.select("label", F.posexplode("embedding").alias("pos", "value"))
    means = parts.groupBy("label", "pos").agg(F.avg("value").alias("m"))
    centres = means.groupBy(F.col("label").alias("vec_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("embedding")
    )
    out = search.cosine_topk(t.embeddings, centres, 20)
    return out.select("query_id", "vec_id", F.round("score", 6).alias("score"))


@query("sea_02_scored_filter", with_views(EVENTS) + """
, p AS (SELECT *, 40.0::DOUBLE + product_id % 10 AS lat, -74.0::DOUBLE + product_id % 7 AS lon FROM ev),
d AS (SELECT *, 2 * 6371 * asin(sqrt(pow(sin(radians(lat - 40.7128::DOUBLE) / 2), 2) + cos(radians(40.7128::DOUBLE)) * cos(radians(lat)) * pow(sin(radians(lon + 74.006::DOUBLE) / 2), 2))) AS km FROM p),
s AS (SELECT event_id, total_amount, CASE WHEN category = 'BOOKS' THEN 1.5::DOUBLE ELSE 0 END + CASE WHEN action IN ('purchase', 'remove') THEN 1.0::DOUBLE ELSE 0 END AS score FROM d WHERE total_amount >= 20 AND km < 300)
SELECT * FROM s WHERE score >= 1""")
def sea_02(t):
    from tidewell.functions.tiers import distance_km

    place = t.events.withColumns({"lat": F.col("product_id") % 10 + 40.0, "lon": F.col("product_id") % 7 - 74.0})
    near = distance_km(F.lit(40.7128), F.lit(-74.006), "lat", "lon") < 300
    out = search.scored_filter(
        place, [F.col("total_amount") >= 20, near],
        {"books": (F.col("category") == "BOOKS", 1.5), "flags": (F.col("action").isin("purchase", "remove"), 1.0)}, 1.0,
    )
    return out.select("event_id", "total_amount", "score")
