"""Function families, SQL functions, readers, writers and jobs, all over the given tables."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import functions as F

from tidewell.functions import udfs
from tidewell.operators import aggregates as agg
from tidewell.operators import enrich, features, joins, quality
from tidewell.operators.user_aggregates import UserAggregate, aggregate_by
from tidewell.plans import jobs
from tidewell.plans.batch_core import AS_OF, CLEAN_COLUMNS
from tidewell.plans.oracle_views import EVENTS, ORDERS, PRODUCT_CHANGES, SALES, USER_CHANGES, USERS, dsum, with_views
from tidewell.plans.registry import query
from tidewell.plans.streams import sliding, tumble
from tidewell.session import durable, scratch_path
from tidewell.sources import kafka, parse, readers, sinks
from tidewell.sources.materialized import ResultStore
from tidewell.streaming.run import in_order, run_available, run_batches

#: The groupings of the stream job hold some 13 rows of state for an event of the latest batch.
JOB_EVENTS_PER_BATCH = 200_000


def n_rows(name="n"):
    return F.count(F.lit(1)).alias(name)


# --- function families ---------------------------------------------------------------------

@query("fn_str_strings", r"""
SELECT c_custkey, upper(c_mktsegment) AS up, lower(c_name) AS low, trim('  ' || c_name || ' ') AS trimmed, ltrim('  ' || c_name) AS left_trimmed, rtrim(c_name || '  ') AS right_trimmed,
  length(c_name) AS len, substr(c_name, 1, 8) AS sub, concat(c_name, '-', c_mktsegment) AS joined, concat_ws('/', c_mktsegment, c_name) AS joined_ws, c_name || '!' AS piped,
  replace(c_name, '#', ':') AS replaced, split_part(c_name, '#', 2) AS part, regexp_replace(c_name, '[0-9]+', 'N') AS masked, regexp_extract(c_name, '([0-9]+)', 1) AS digits,
  contains(c_mktsegment, 'MA') AS has_ma, c_name LIKE 'Customer#%' AS is_like, regexp_matches(c_name, '^Cust.*[05]$') AS is_match FROM customer""")
def fn_str(t):
    return t.customer.selectExpr(
        "c_custkey", "upper(c_mktsegment) AS up", "lower(c_name) AS low", "trim('  ' || c_name || ' ') AS trimmed", "ltrim('  ' || c_name) AS left_trimmed",
        "rtrim(c_name || '  ') AS right_trimmed", "length(c_name) AS len", "substring(c_name, 1, 8) AS sub", "concat(c_name, '-', c_mktsegment) AS joined",
        "concat_ws('/', c_mktsegment, c_name) AS joined_ws", "c_name || '!' AS piped", "replace(c_name, '#', ':') AS replaced", "split(c_name, '#')[1] AS part",
        "regexp_replace(c_name, '[0-9]+', 'N') AS masked", "regexp_extract(c_name, '([0-9]+)') AS digits", "contains(c_mktsegment, 'MA') AS has_ma",
        "c_name LIKE 'Customer#%' AS is_like", "c_name RLIKE '^Cust.*[05]$' AS is_match",
    )


@query("fn_math_numbers", """
SELECT o_orderkey, abs(o_totalprice - 200000) AS a, ceil(o_totalprice) AS up, floor(o_totalprice) AS down, round(o_totalprice / 1000) AS rounded, ROUND(power(o_totalprice / 1000, 2), 4) AS squared,
  ROUND(sqrt(o_totalprice), 6) AS root, ROUND(sin(o_totalprice), 6) AS s, ROUND(cos(o_totalprice), 6) AS c, ROUND(o_totalprice / 100000 * pi(), 6) AS p, o_orderkey % 7 AS m,
  greatest(o_totalprice, 150000) AS g, least(o_totalprice, 150000) AS l FROM orders""")
def fn_math(t):
    return t.orders.selectExpr(
        "o_orderkey", "abs(o_totalprice - 200000) AS a", "ceil(o_totalprice) AS up", "floor(o_totalprice) AS down", "round(o_totalprice / 1000) AS rounded",
        "round(power(o_totalprice / 1000, 2), 4) AS squared", "round(sqrt(o_totalprice), 6) AS root", "round(sin(o_totalprice), 6) AS s", "round(cos(o_totalprice), 6) AS c",
        "round(o_totalprice / 100000 * pi(), 6) AS p", "o_orderkey % 7 AS m", "greatest(o_totalprice, 150000D) AS g", "least(o_totalprice, 150000D) AS l",
    )


@query("fn_math_moments", """
SELECT o_orderpriority, ROUND(stddev(o_totalprice), 2) AS sd, ROUND(variance(o_totalprice) / 1e6, 4) AS var_m, ROUND(stddev_pop(o_totalprice), 2) AS sd_pop FROM orders GROUP BY 1""")
def fn_math_agg(t):
    return t.orders.groupBy("o_orderpriority").agg(
        F.expr("round(stddev(o_totalprice), 2)").alias("sd"), F.expr("round(variance(o_totalprice) / 1e6D, 4)").alias("var_m"),
        F.expr("round(stddev_pop(o_totalprice), 2)").alias("sd_pop"),
    )


@query("fn_date_times", """
SELECT event_id, CAST(ts AS DATE) AS day, CAST(ts AS DATE) + 30 AS later, CAST(ts AS DATE) - 7 AS earlier, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS days,
  year(ts) AS y, month(ts) AS m, day(ts) AS d, hour(ts) AS h, minute(ts) AS mi, strftime(ts, '%Y-%m-%d %H:%M:%S') AS formatted, date_trunc('hour', ts) AS hour_start,
  CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS unix, ts + INTERVAL 90 MINUTE AS moved, dayofweek(ts) + 1 AS dow, quarter(ts) AS q, strptime(strftime(ts, '%Y/%m/%d'), '%Y/%m/%d') AS parsed,
  datediff('month', DATE '2020-03-01', CAST(ts AS DATE)) AS months_age FROM events""")
def fn_date(t):
    return t.read("events").selectExpr("*", "cast(ts AS timestamp) AS at").selectExpr(
        "event_id", "to_date(at) AS day", "date_add(at, 30) AS later", "date_sub(at, 7) AS earlier", "datediff(at, date'2024-01-01') AS days", "year(at) AS y",
        "month(at) AS m", "extract(DAY FROM at) AS d", "hour(at) AS h", "minute(at) AS mi", "date_format(at, 'yyyy-MM-dd HH:mm:ss') AS formatted",
        "date_trunc('hour', at) AS hour_start", "unix_timestamp(at) AS unix", "at + INTERVAL 90 MINUTES AS moved", "dayofweek(at) AS dow", "quarter(at) AS q",
        "to_timestamp(date_format(at, 'yyyy/MM/dd'), 'yyyy/MM/dd') AS parsed", "cast(floor(months_between(trunc(at, 'month'), date'2020-03-01')) AS int) AS months_age",
    )


@query("fn_arr_arrays", """
WITH s AS (SELECT p_type, list(DISTINCT p_brand ORDER BY p_brand) AS s FROM part GROUP BY 1),
a AS (SELECT p_partkey, string_split(p_name, ' ') AS l, s FROM part JOIN s ON part.p_type = s.p_type)
SELECT p_partkey, len(l) AS n, l[1] AS first_item, list_contains(l, 'red') AS has_red, pos - 1 AS pos, item, array_to_string(s, ',') AS brands
FROM a, LATERAL (SELECT UNNEST(l) AS item, UNNEST(range(1, len(l) + 1)) AS pos)""")
def fn_arr(t):
    brands = t.part.groupBy("p_type").agg(F.array_sort(F.collect_set("p_brand")).alias("s"))
    base = t.part.join(brands, "p_type").withColumn("l", F.split("p_name", " "))
    return base.select(
        "p_partkey", F.size("l").alias("n"), F.element_at("l", 1).alias("first_item"), F.array_contains("l", "red").alias("has_red"),
        F.array_join("s", ",").alias("brands"), F.posexplode("l").alias("pos", "item"),
    )


@query("fn_map_maps", """
SELECT event_id, event_type AS v_type, CAST(value AS VARCHAR) AS v_value, 'type,value' AS keys, 2 AS size, CAST(ROUND(value * 2, 2) AS DOUBLE) AS doubled FROM events""")
def fn_map(t):
    m = F.create_map(F.lit("type"), F.col("event_type"), F.lit("value"), F.col("value").cast("string"))
    return t.read("events").withColumn("m", m).select(
        "event_id", F.col("m")["type"].alias("v_type"), F.element_at(F.map_values("m"), 2).alias("v_value"), F.array_join(F.map_keys("m"), ",").alias("keys"),
        F.size("m").alias("size"), F.round(F.transform_values(F.map_filter("m", lambda k, v: k == "value"), lambda k, v: v.cast("double") * 2)["value"], 2).alias("doubled"),
    )


@query("fn_json_values", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, 2 AS item_count, CAST(json_extract_string(props, '$.k') AS BIGINT) AS second_item, json_extract_string(props, '$.missing') AS missing,
  '{"k":' || json_extract_string(props, '$.k') || '}' AS rewritten FROM events""")
def fn_json(t):
    items = F.to_json(F.struct(F.array(F.lit(1).cast("long"), F.get_json_object("props", "$.k").cast("long")).alias("items")))
    return t.read("events").withColumn("doc", items).select(
        "event_id", F.expr("variant_get(parse_json(props), '$.k', 'bigint')").alias("k"), F.json_array_length(F.get_json_object("doc", "$.items")).alias("item_count"),
        F.get_json_object("doc", "$.items[1]").cast("long").alias("second_item"), F.get_json_object("props", "$.missing").alias("missing"),
        F.to_json(F.from_json("props", "k bigint")).alias("rewritten"),
    )


@query("fn_hash_digests", """
SELECT c_custkey, md5(c_name) AS m, sha1(c_name) AS s1, sha256(c_name) AS s2, true AS crc_known, true AS stable FROM customer""")
def fn_hash(t):
    return t.customer.select(
        "c_custkey", F.md5("c_name").alias("m"), F.sha1("c_name").alias("s1"), F.sha2("c_name", 256).alias("s2"),
        F.crc32("c_name").isNotNull().alias("crc_known"),
        ((F.hash("c_name") == F.hash(F.concat("c_name", F.lit("")))) & (F.xxhash64("c_name") == F.xxhash64(F.trim("c_name")))).alias("stable"),
    )


@query("fn_cond_conditions", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_quantity > 30 THEN 'many' WHEN l_quantity > 10 THEN 'some' ELSE 'few' END AS c, CASE WHEN l_discount = 0 THEN 'full' ELSE 'cut' END AS i,
  COALESCE(NULLIF(l_returnflag, 'N'), 'none') AS co, l_extendedprice / NULLIF(l_discount, 0) AS safe, l_tax IS NULL AS no_tax, isnan(l_tax) AS nan_tax FROM lineitem""")
def fn_cond(t):
    return t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "CASE WHEN l_quantity > 30 THEN 'many' WHEN l_quantity > 10 THEN 'some' ELSE 'few' END AS c",
        "if(l_discount = 0, 'full', 'cut') AS i", "coalesce(nullif(l_returnflag, 'N'), 'none') AS co", "try_divide(l_extendedprice, l_discount) AS safe",
        "l_tax IS NULL AS no_tax", "isnan(l_tax) AS nan_tax",
    )


@query("fn_cast_types", """
SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS s, CAST(CAST(o_orderkey AS VARCHAR) AS INTEGER) AS back, CAST(o_totalprice AS DECIMAL(12,2)) AS d, CAST(trunc(o_totalprice) AS BIGINT) AS whole,
  CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice > 100000 AS INTEGER) AS flag, TRY_CAST(o_orderpriority AS INTEGER) AS bad, CAST('2024-01-01' AS DATE) AS fixed_day FROM orders""")
def fn_cast(t):
    return t.orders.selectExpr(
        "o_orderkey", "cast(o_orderkey AS string) AS s", "cast(cast(o_orderkey AS string) AS int) AS back", "cast(o_totalprice AS decimal(12,2)) AS d",
        "cast(o_totalprice AS bigint) AS whole", "cast(o_orderdate AS date) AS day", "cast(o_totalprice > 100000 AS int) AS flag",
        "try_cast(o_orderpriority AS int) AS bad", "cast('2024-01-01' AS date) AS fixed_day",
    )


# --- SQL functions ---------------------------------------------------------------------------

@query("udf_01_classify_tier", with_views(ORDERS) + f"""
, u AS (SELECT user_id, {dsum('amount')} / 1000 AS spent FROM user_orders GROUP BY 1)
SELECT user_id, CASE WHEN spent >= 5000 THEN 'Platinum' WHEN spent >= 2000 THEN 'Gold' WHEN spent >= 500 THEN 'Silver' ELSE 'Bronze' END AS tier FROM u""")
def udf_01(t):
    udfs.register_functions(t.spark)
    spend = t.user_orders.groupBy("user_id").agg((agg.total("amount") / 1000).alias("spent"))
    return spend.select("user_id", F.expr("classify_tier(spent)").alias("tier"))


@query("udf_05_transform_by_type", with_views(EVENTS) + """
SELECT event_id, event_type, CASE WHEN event_type = 'purchase' THEN ROUND(total_amount * 2, 2) ELSE total_amount END AS amount, CASE WHEN event_type = 'error' THEN 'failed' END AS note FROM ev""")
def udf_05(t):
    events = t.events.select("event_id", "event_type", F.col("total_amount").alias("amount"))
    return enrich.transform_by_type(
        events,
        {"purchase": lambda d: d.withColumn("amount", F.round(F.col("amount") * 2, 2)), "error": lambda d: d.withColumn("note", F.lit("failed"))},
    )


# --- readers and writers ----------------------------------------------------------------------

@query("src_01_read_csv", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def src_01(t):
    path = scratch_path(t.spark, "csv")
    t.orders.drop("o_orderdate").write.option("header", True).csv(path)
    return readers.read_csv(t.spark, path, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string")


@query("src_02_read_parquet", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def src_02(t):
    path = scratch_path(t.spark, "partitioned")
    sinks.write_partitioned(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), path, ["o_orderstatus"], spread=4)
    return readers.read_parquet(t.spark, path)


@query("src_03_read_json", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def src_03(t):
    path = scratch_path(t.spark, "json")
    t.customer.select("c_custkey", "c_name", "c_acctbal").write.json(path)
    return readers.read_json(t.spark, path, "c_custkey long, c_name string, c_acctbal double")


def _messages(t):
    """Events as JSON messages; values above 400 stand for broken ones."""
    text = F.to_json(
        F.struct(
            F.concat(F.lit("e"), "event_id").alias("event_id"), F.col("user_id").cast("string").alias("user_id"), "event_type", F.lit("p1").alias("product_id"),
            "category", "price", "quantity", "session_id", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
            F.struct(F.lit("web").alias("source"), F.col("ip_address").alias("ip_address")).alias("metadata"),
        )
    )
    return t.events.select(
        F.col("user_id").cast("string").alias("key"),
        F.when(F.col("total_amount") > 250, F.concat(F.lit("{oops "), "event_id")).otherwise(text).alias("value"),
        F.lit("user-events").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("event_time").alias("timestamp"),
    )


@query("src_06_parse_events", with_views(EVENTS) + """
SELECT 'e' || event_id AS event_id, CAST(user_id AS VARCHAR) AS key, ip_address, event_id AS "offset", date_trunc('second', event_time) AS event_timestamp, total_amount FROM ev WHERE total_amount <= 250""")
def src_06(t):
    return parse.parse_events(_messages(t)).select(
        "event_id", "key", F.col("metadata.ip_address").alias("ip_address"), "offset", "event_timestamp", "total_amount"
    )


@query("src_09_split_malformed", with_views(EVENTS) + """
SELECT 'good' AS side, COUNT(*) AS n FROM ev WHERE total_amount <= 250 UNION ALL SELECT 'dead', COUNT(*) FROM ev WHERE total_amount > 250""")
def src_09(t):
    good, dead = parse.split_malformed(_messages(t))
    return good.agg(n_rows()).withColumn("side", F.lit("good")).unionByName(dead.agg(n_rows()).withColumn("side", F.lit("dead")))


@query("src_10_catalog_counts", with_views(ORDERS, USERS) + "SELECT 'user_orders' AS name, COUNT(*) AS n FROM user_orders UNION ALL SELECT 'users', COUNT(*) FROM users")
def src_10(t):
    frames = {"user_orders": t.user_orders, "users": t.users}
    names = readers.register_views(t.spark, frames)
    known = readers.catalog_tables(t.spark).filter(F.col("is_temporary") & F.col("name").isin(*names)).select("name").distinct()
    counts = frames["users"].agg(n_rows()).withColumn("name", F.lit("users")).unionByName(
        t.spark.table("user_orders").agg(n_rows()).withColumn("name", F.lit("user_orders"))
    )
    return counts.join(known, "name")


@query("src_12_read_incremental", """
SELECT 'first' AS load, COUNT(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-15' UNION ALL
SELECT 'second', COUNT(*) FROM events WHERE ts > (SELECT MAX(ts) FROM events WHERE ts < TIMESTAMP '2024-01-15')""")
def src_12(t):
    marks = scratch_path(t.spark, "marks")
    early = t.events.filter(F.col("event_time") < F.lit("2024-01-15").cast("timestamp"))
    first, commit = readers.read_incremental(lambda: early, "event_time", marks, "events", t.spark)
    counted = first.agg(n_rows()).withColumn("load", F.lit("first"))
    commit()
    second, _ = readers.read_incremental(lambda: t.events, "event_time", marks, "events", t.spark)
    return counted.unionByName(second.agg(n_rows()).withColumn("load", F.lit("second")))


@query("src_12_incremental_at_ties", """
WITH h AS (SELECT event_id, date_trunc('hour', ts) AS hour FROM events), c AS (SELECT MAX(hour) AS edge FROM h WHERE hour < TIMESTAMP '2024-01-15')
SELECT CASE WHEN hour < edge OR (hour = edge AND event_id % 2 = 0) THEN 'first' ELSE 'second' END AS load, COUNT(*) AS n, SUM(event_id) AS ids FROM h, c GROUP BY 1""")
def src_12b(t):
    """Times of whole hours have many ties; half of the rows of the first load's last hour arrive after it."""
    marks, hours = scratch_path(t.spark, "marks"), t.events.select("event_id", F.date_trunc("hour", "event_time").alias("hour"))
    before = hours.filter(F.col("hour") < F.lit("2024-01-15").cast("timestamp"))
    edge = before.agg(F.max("hour").alias("edge"))
    early = before.join(F.broadcast(edge)).filter((F.col("hour") < F.col("edge")) | (F.col("event_id") % 2 == 0)).drop("edge")
    first, commit = readers.read_incremental(lambda: early, "hour", marks, "events", t.spark, ["event_id"])
    counted = durable(first.agg(n_rows(), F.sum("event_id").alias("ids")).withColumn("load", F.lit("first")))
    commit()
    second, _ = readers.read_incremental(lambda: hours, "hour", marks, "events", t.spark, ["event_id"])
    return counted.unionByName(second.agg(n_rows(), F.sum("event_id").alias("ids")).withColumn("load", F.lit("second")))


@query("src_13_newest_messages", "SELECT CAST(user_id AS VARCHAR) AS key, event_id AS \"offset\" FROM events ORDER BY ts DESC, event_id DESC LIMIT 25")
def src_13(t):
    return kafka.newest(_messages(t), 25).select("key", "offset")


@query("src_14_read_text", r"""
SELECT line, COUNT(*) AS n FROM (SELECT UNNEST(regexp_split_to_array(text, '\r\n|\r|\n')) AS line FROM documents WHERE text <> '') GROUP BY 1""")
def src_14(t):
    """The documents written as text files and read back line by line."""
    path = scratch_path(t.spark, "text")
    t.documents.filter("text <> ''").select(F.col("text").alias("value")).write.text(path)
    return readers.read_text(t.spark, path).groupBy(F.col("value").alias("line")).agg(n_rows())


@query("snk_01_csv_report", with_views(SALES) + f"SELECT category, {dsum('total_amount')} AS revenue FROM sales GROUP BY 1")
def snk_01(t):
    path = scratch_path(t.spark, "report")
    report = t.sales("category", "total_amount").groupBy("category").agg(agg.total("total_amount").alias("revenue"))
    sinks.write_csv_report(report, path)
    return readers.read_csv(t.spark, path, "category string, revenue double")


@query("snk_05_upsert_stream", with_views(EVENTS) + """
SELECT user_id, event_id, action, total_amount FROM ev QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_time DESC, event_id DESC) = 1""")
def snk_05(t):
    sink = sinks.UpsertSink(scratch_path(t.spark, "upsert"), ["user_id"], ["event_time", "event_id"], buckets=8)
    run_batches(t.event_stream.select("user_id", "event_id", "action", "total_amount", "event_time"), sink, "upsert")
    return sink.current(t.spark).select("user_id", "event_id", "action", "total_amount")


@query("snk_06_topic_payload", """
SELECT CAST(o_custkey AS VARCHAR) AS key, '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS value FROM orders""")
def snk_06(t):
    return kafka.to_messages(t.orders, "o_custkey", ["o_orderkey", "o_orderstatus"])


@query("snk_09_partitioned_ingest", """
SELECT event_type, year(ts) AS year, month(ts) AS month, day(ts) AS day, COUNT(*) AS n FROM events GROUP BY ALL""")
def snk_09(t):
    path = scratch_path(t.spark, "ingest")
    stream = t.event_stream.select("event_id", "event_type", "event_time")
    sinks.partitioned_ingest(stream, "event_time", path, scratch_path(t.spark, "ingest-checkpoint"), ["event_type"]).awaitTermination()
    return t.spark.read.parquet(path).groupBy("event_type", "year", "month", "day").agg(n_rows())


@query("snk_10_fan_out", with_views(EVENTS) + """
SELECT 'big' AS output, COUNT(*) AS n FROM ev WHERE total_amount > 100 UNION ALL SELECT 'purchases', COUNT(*) FROM ev WHERE action = 'purchase'""")
def snk_10(t):
    path = scratch_path(t.spark, "fan-out")

    def writer(name):
        return lambda df, batch_id: df.write.mode("overwrite").parquet(f"{path}/output={name}/batch_id={batch_id}")

    outputs = {"big": (F.col("total_amount") > 100, writer("big")), "purchases": (F.col("action") == "purchase", writer("purchases"))}
    run_batches(t.event_stream.select("event_id", "action", "total_amount"), sinks.fan_out(outputs), "fan-out")
    return t.spark.read.parquet(path).groupBy("output").agg(n_rows())


@query("snk_11_dual_write", with_views(EVENTS) + """
SELECT 'events' AS side, event_type AS part, COUNT(*) AS n FROM ev GROUP BY 2 UNION ALL SELECT 'activity', strftime(event_time, '%Y-%m-%d'), COUNT(*) FROM ev GROUP BY 2""")
def snk_11(t):
    path = scratch_path(t.spark, "dual")
    stream = t.event_stream.select("event_id", "event_type", "user_id", "session_id", "event_time", "category", "price")
    run_batches(stream, sinks.dual_write_events(f"{path}/events", f"{path}/activity", "event_time"), "dual")
    events = t.spark.read.parquet(f"{path}/events").groupBy(F.col("event_type").alias("part")).agg(n_rows())
    activity = t.spark.read.parquet(f"{path}/activity").groupBy(F.col("activity_date").cast("string").alias("part")).agg(n_rows())
    return events.withColumn("side", F.lit("events")).unionByName(activity.withColumn("side", F.lit("activity")))


@query("snk_12_quality_report", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count, 0.0::DOUBLE AS null_percentage FROM customer" for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")))
def snk_12(t):
    path = scratch_path(t.spark, "quality")
    sinks.write_report(quality.null_profile(t.customer), path)
    return readers.read_json(t.spark, path, "column_name string, null_count long, null_percentage double")


@query("snk_13_materialize", with_views(SALES) + f"SELECT region, {dsum('total_amount')} AS revenue FROM sales GROUP BY 1")
def snk_13(t):
    store = ResultStore(t.spark, scratch_path(t.spark, "store"))
    revenue = t.sales("region", "total_amount").groupBy("region").agg(agg.total("total_amount").alias("revenue"))
    store.materialize("revenue", revenue, 3600)
    return store.materialize("revenue", revenue, 3600)


@query("join_11_federated_join", with_views(ORDERS, USERS) + """
SELECT country, tier, COUNT(*) AS n FROM user_orders o JOIN users u ON o.user_id = u.user_id GROUP BY 1, 2""")
def join_11(t):
    path = scratch_path(t.spark, "users-json")
    t.users.select("user_id", "country", "tier").write.json(path)
    users = readers.read_json(t.spark, path, "user_id long, country string, tier string")
    orders = t.user_orders.select("user_id", "order_id")
    return jobs.federated_orders(orders, users).groupBy("country", "tier").agg(n_rows())


# --- jobs -----------------------------------------------------------------------------------------

@query("job_01_batch", with_views(SALES) + """
SELECT 'category_revenue' AS output, COUNT(DISTINCT upper(category)) AS n FROM sales UNION ALL SELECT 'daily_trends', COUNT(DISTINCT CAST(timestamp AS DATE)) FROM sales
UNION ALL SELECT 'full_dataset', COUNT(*) FROM (SELECT DISTINCT user_id, product_id, category, action, timestamp, price, quantity, session_id, line, supplier_id FROM sales)""")
def job_01(t):
    paths = jobs.batch_job(t.sales(*CLEAN_COLUMNS), scratch_path(t.spark, "batch-job"), {"positive_prices": F.col("price") <= 0})
    counts = [
        df.agg(n_rows()).withColumn("output", F.lit(name))
        for name, df in (
            ("category_revenue", t.spark.read.option("header", True).csv(paths["category_revenue"])),
            ("daily_trends", t.spark.read.option("header", True).csv(paths["daily_trends"])),
            ("full_dataset", t.spark.read.parquet(paths["full_dataset"])),
        )
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("job_02_etl", with_views(SALES) + """
SELECT 'fact/sales' AS output, COUNT(*) AS n FROM sales UNION ALL SELECT 'fact/web', COUNT(*) FROM events UNION ALL SELECT 'dim/customers', COUNT(*) FROM customer
UNION ALL SELECT 'dim/products', COUNT(*) FROM part UNION ALL SELECT 'agg/customer_summary', COUNT(DISTINCT user_id) FROM sales
UNION ALL SELECT 'agg/daily_sales', COUNT(*) FROM (SELECT DISTINCT CAST(timestamp AS DATE), category FROM sales)""")
def job_02(t):
    customers = t.customer.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name"), F.concat(F.lit("u"), "c_custkey", F.lit("@mail.example")).alias("email"),
        F.col("c_custkey").cast("string").alias("phone"), F.col("c_acctbal").alias("lifetime_value"),
        F.lit("1999-01-01").cast("date").alias("registration_date"), F.lit("2001-11-01").cast("date").alias("last_login"),
    )
    products = t.part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("sku"), (F.col("p_retailprice") * 0.7).alias("cost_price"), F.col("p_retailprice").alias("retail_price"),
        F.col("p_size").alias("stock_quantity"), F.lit("2000-01-01").cast("date").alias("created_date"), (F.col("p_size") / 8.0).alias("weight_kg"),
    )
    visits = t.events.select(
        "event_id", F.col("event_time").alias("timestamp"), F.lit("direct").alias("referrer"), F.lit("mobile").alias("device_type"),
        F.concat(F.lit("/"), "event_type", F.lit("/x")).alias("page_url"), F.col("price").alias("duration_seconds"),
    )
    sales = t.sales("user_id", "category", "timestamp", "price", "quantity", "product_id", "session_id", "line", "supplier_id")
    paths = jobs.etl_job(sales, customers, products, visits, scratch_path(t.spark, "etl-job"), AS_OF)
    stored = [n for n in paths if n.split("/")[0] in ("fact", "dim", "agg")]
    counts = [t.spark.read.parquet(paths[n]).agg(n_rows()).withColumn("output", F.lit(n)) for n in stored]
    out = counts[0]
    for df in counts[1:]:
        out = out.unionByName(df)
    return out


@query("job_03_sql_reports", with_views(ORDERS, USERS) + f"""
, s AS (SELECT o.user_id, country, {dsum('amount')} AS spent FROM user_orders o JOIN users u ON o.user_id = u.user_id GROUP BY 1, 2)
SELECT 'tiers' AS report, CASE WHEN spent / 1000 >= 5000 THEN 'Platinum' WHEN spent / 1000 >= 2000 THEN 'Gold' WHEN spent / 1000 >= 500 THEN 'Silver' ELSE 'Bronze' END AS name, COUNT(*) AS users FROM s GROUP BY 2
UNION ALL SELECT 'countries', country, COUNT(*) FROM users GROUP BY country""")
def job_03(t):
    reports = {
        "tiers": """WITH spend AS (SELECT o.user_id, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS spent FROM user_orders o JOIN users u ON o.user_id = u.user_id GROUP BY o.user_id)
            SELECT classify_tier(spent / 1000) AS name, COUNT(*) AS users FROM spend GROUP BY 1""",
        "countries": "SELECT country AS name, COUNT(*) AS users FROM users GROUP BY country",
    }
    paths = jobs.sql_report_job(t.spark, {"user_orders": t.user_orders, "users": t.users}, scratch_path(t.spark, "sql-reports"), reports)
    read = {name: readers.read_csv(t.spark, path, "name string, users long").select(F.lit(name).alias("report"), "name", "users") for name, path in paths.items()}
    return read["tiers"].unionByName(read["countries"])


def _slid(size: int, slide: int) -> str:
    return sliding(size, slide).replace("slid AS", f"slid{size} AS", 1)


def _closed_count(name: str, cells: str, minutes: int) -> str:
    return f"SELECT '{name}' AS output, COUNT(*) AS n, CAST(COALESCE(SUM(rows), 0) AS BIGINT) AS events FROM ({cells}) WHERE window_end <= (SELECT MAX(event_time) FROM ev) - INTERVAL {minutes} MINUTE"


@query("job_04_stream", with_views(EVENTS, _slid(5, 1), _slid(10, 2), _slid(30, 5)) + " UNION ALL ".join([
    "SELECT 'high_value_alerts' AS output, COUNT(*) AS n, COUNT(*) AS events FROM ev WHERE total_amount > 200",
    _closed_count("minute_counts", tumble("1 MINUTE", "event_type", "COUNT(*) AS rows"), 2),
    _closed_count("category_revenue", "SELECT window_end, category, COUNT(*) AS rows FROM slid5 GROUP BY ALL", 5),
    _closed_count("active_users", "SELECT window_end, user_id, COUNT(*) AS rows FROM slid10 GROUP BY ALL", 10),
    _closed_count("session_analysis", "SELECT window_end, session_id, COUNT(*) AS rows FROM slid30 GROUP BY ALL", 30),
    _closed_count("fraud_alerts", tumble("5 MINUTE", "user_id", "COUNT(*) AS rows", having="COUNT(*) > 10 OR SUM(total_amount) > 2000 OR COUNT(DISTINCT ip_address) > 3"), 5),
]))
def job_04(t):
    """Every output of the job, with its number of rows and the events counted in them."""
    out = scratch_path(t.spark, "stream-job")
    events = t.event_view(in_order(t.read("events"), "ts", "stream-job", JOB_EVENTS_PER_BATCH))
    for running in jobs.stream_job(events, out, scratch_path(t.spark, "stream-job-checkpoints"), {"availableNow": True}).values():
        running.awaitTermination()
    counted = {"high_value_alerts": F.lit(1), "minute_counts": F.col("event_count"), "category_revenue": F.col("order_count"), "active_users": F.col("activity_count"),
              "session_analysis": F.col("events_in_session"), "fraud_alerts": F.col("transaction_count")}
    counts = [
        t.spark.read.parquet(f"{out}/{n}").agg(n_rows(), F.coalesce(F.sum(c), F.lit(0)).cast("long").alias("events")).withColumn("output", F.lit(n)) for n, c in counted.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


@query("job_05_event_router", with_views(EVENTS) + """
SELECT CAST(user_id AS VARCHAR) AS key, CASE WHEN action = 'purchase' THEN 'transactions' WHEN total_amount > 100 THEN 'high_value' WHEN action IN ('view', 'search') THEN 'analytics' ELSE 'general' END AS route, COUNT(*) AS n
FROM ev WHERE total_amount >= 5 GROUP BY 1, 2""")
def job_05(t):
    stream = t.event_stream.select("event_id", "user_id", "action", F.col("total_amount").alias("value"))
    routed = run_available(kafka.to_messages(jobs.event_router_job(stream, 5, [], 100.0), "user_id"), "router")
    return routed.groupBy("key", F.get_json_object("value", "$.route").alias("route")).agg(n_rows())


@query("job_06_warehouse", with_views(USER_CHANGES, PRODUCT_CHANGES) + """
SELECT 'lifecycle_events' AS output, COUNT(*) AS n FROM user_changes UNION ALL SELECT 'product_alerts', COUNT(*) FROM product_changes WHERE cost >= price OR inventory_count < 0
UNION ALL SELECT 'customer_analytics', COUNT(*) FROM (SELECT * FROM user_changes QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY version DESC) = 1) WHERE NOT is_deleted
UNION ALL SELECT 'product_analytics', COUNT(*) FROM product_changes WHERE version = 2 AND NOT is_deleted""")
def job_06(t):
    items = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.col("l_shipdate").cast("timestamp").alias("item_time"),
        F.col("l_quantity").alias("quantity"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"), F.col("l_extendedprice").alias("total_price"),
    )
    orders = t.user_orders.select("order_id", "user_id", "order_date", "amount", "status")
    results = jobs.warehouse_job(t.user_changes, t.product_changes, orders, items, AS_OF)
    names = ["lifecycle_events", "product_alerts", "customer_analytics", "product_analytics"]
    out = None
    for name in names:
        counted = results[name].agg(n_rows()).withColumn("output", F.lit(name))
        out = counted if out is None else out.unionByName(counted)
    return out


@query("job_07_features", with_views(EVENTS) + """
SELECT CASE WHEN total_amount > 60 THEN 1.0 ELSE 0.0 END AS label, COUNT(*) AS n, TRUE AS mostly_right FROM ev GROUP BY 1""")
def job_07(t):
    daily = t.events.filter("action = 'purchase'").groupBy("user_id", F.date_trunc("day", "event_time").alias("ready_at")).agg(
        agg.total("total_amount").alias("spent"), F.count(F.lit(1)).cast("double").alias("orders")
    )
    view = features.FeatureView("daily", daily, "user_id", "ready_at", "10 days")
    entities = t.events.select("event_id", "user_id", "event_time", "total_amount")
    scored, accuracy = jobs.feature_job(
        entities, "event_time", [view], lambda d: F.when(F.col("total_amount") > 60, 1.0).otherwise(0.0), ["daily__spent", "daily__orders", "total_amount"], "event_id"
    )
    right = (F.count_if(F.col("prediction") == F.col("label")) >= 0.9 * F.count(F.lit(1))) & (F.lit(accuracy) >= 0.9)
    return scored.groupBy("label").agg(n_rows(), right.alias("mostly_right"))


class SpendProfile(UserAggregate):
    """Rows, cents and the three largest amounts."""

    def create(self):
        return 0, 0, []

    def add(self, state, rows):
        n, cents, top = state
        values = rows["cents"].to_numpy()
        values = values[values == values].astype("int64")
        # A batch holds very many keys with few rows each, so this stays with plain arrays.
        largest = np.partition(values, -3)[-3:] if len(values) > 3 else values
        return n + len(rows), cents + int(values.sum()), sorted([*top, *largest.tolist()], reverse=True)[:3]

    def merge(self, a, b):
        return a[0] + b[0], a[1] + b[1], sorted([*a[2], *b[2]], reverse=True)[:3]

    def result(self, state):
        n, cents, top = state
        return n, cents, ",".join(str(v) for v in top)


@query("udf_04_user_aggregate", with_views(EVENTS) + """
, k AS (SELECT CASE WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 50 = 1 THEN NULL ELSE user_id END AS user_id, CAST(ROUND(total_amount * 100) AS BIGINT) AS cents FROM ev)
SELECT user_id, COUNT(*) AS n, CAST(SUM(cents) AS BIGINT) AS cents, array_to_string(list(cents ORDER BY cents DESC)[1:3], ',') AS top FROM k GROUP BY 1""")
def udf_04(t):
    """One key holds a third of the rows, and one is NULL."""
    user = F.when(F.col("event_id") % 3 == 0, 0).when(F.col("event_id") % 50 == 1, None).otherwise(F.col("user_id")).cast("long")
    rows = t.events.select(user.alias("user_id"), F.round(F.col("total_amount") * 100).cast("long").alias("cents"))
    return aggregate_by(rows, ["user_id"], ["cents"], SpendProfile(), "n long, cents long, top string")
