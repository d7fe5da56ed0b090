"""Keyed state, as-of joins, exact distinct counts and interval joins on streams whose files come out of order."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_streams import START, add_file, events, rows, stream

from tidewell.operators import joins, keyed_state
from tidewell.session import scratch_path
from tidewell.streaming import sessions, stateful, windows
from tidewell.streaming.asof import asof_stream
from tidewell.streaming.run import run_available

DAY = 86400
CLOSING = 10**6


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def dealt(spark, data, files, disorder, label, seed=1):
    """Files in order of time plus a random delay, and two last ones whose events close all time before them."""
    rng, source = random.Random(seed), scratch_path(spark, label)
    arriving = sorted(data, key=lambda r: r[2] + rng.uniform(0, disorder))
    for k in range(files):
        part = arriving[len(arriving) * k // files : len(arriving) * (k + 1) // files]
        rng.shuffle(part)
        add_file(events(spark, part), source)
    for k in range(2):
        add_file(events(spark, [(CLOSING + k, -1, 400 * DAY + k, "other", 501.0)]), source)
    return source


def open_rows(df, *columns):
    """Rows of the real users."""
    return rows(df.filter("event_id < 1000000") if "event_id" in df.columns else df.filter("user_id >= 0"), *columns)


@pytest.fixture(scope="module")
def history():
    """Several users with bursts, pauses, equal times and one user with a third of the rows."""
    rng, data, at = random.Random(5), [], 0
    for i in range(240):
        at += rng.choice([0, 3, 40, 40, 700, 4000])
        user = 0 if i % 3 == 0 else rng.randrange(1, 6)
        data.append((i, user, at, rng.choice(["view", "purchase", "add_to_cart", "login"]), float(rng.choice([20, 300, 600, 1100]))))
    return data


@pytest.mark.parametrize("files", [1, 6])
def test_state_equals_its_table_form(spark, history, files):
    table, disorder = events(spark, history), 3000
    source, delay = dealt(spark, history, files, disorder, "order"), f"{disorder + 1} seconds"
    alerts = run_available(stateful.fraud_alerts(stream(spark, source), delay), "fraud")
    columns = ("event_id", "event_time", "amount", "recent_spending", "fraud_score", "alert_type")
    assert rows(alerts, *columns) == rows(keyed_state.fraud_state(table), *columns) != []
    states = run_available(stateful.behavior_states(stream(spark, source), delay=delay), "behavior")
    columns = ("event_id", "total_events", "total_spent", "user_tier")
    assert open_rows(states, *columns) == rows(keyed_state.user_behavior_state(table), *columns)
    tracked = run_available(stateful.track_sessions(stream(spark, source), 1800, delay, running=False), "tracker")
    want = sessions.session_tracker(table, 1800)
    columns = ("user_id", "event_count", "unique_categories", "total_spent", "engagement_score")
    assert open_rows(tracked, *columns) == rows(want, *columns)
    popular = run_available(stateful.popularity(stream(spark, source), 24, delay), "popularity").filter(F.col("hour") < F.lit(START + dt.timedelta(days=399)))
    columns = ("product_id", "hour", "total_views", "total_revenue", "unique_users", "hours_with_activity", "popularity_score")
    assert rows(popular, *columns) == rows(keyed_state.product_popularity(table), *columns)


def test_features_of_users_products_and_sessions(spark, history):
    source, online = dealt(spark, history, 5, 3000, "features"), keyed_state.online_features(events(spark, history))
    for kind, got, want in (
        ("user", ("events", "spent", "members", "since_last_ms"), ("user_events", "user_spent", "user_categories", "since_last_activity_ms")),
        ("product", ("views", "purchases", "members", "spent"), ("product_views", "product_purchases", "product_viewers", "product_revenue")),
        ("session", ("events", "members", "since_first_ms"), ("session_events", "session_categories", "session_duration_ms")),
    ):
        out = run_available(stateful.feature_stream(stream(spark, source), kind, "3001 seconds"), kind)
        assert open_rows(out, "event_id", *got) == rows(online, "event_id", *want)


def test_features_are_forgotten(spark):
    data = [(1, 1, 0, "view", 1.0), (2, 1, 3600, "view", 1.0), (3, 1, 3600 * 2 + 3601, "view", 1.0), (4, 1, 3600 * 4, "view", 1.0)]
    out = run_available(stateful.feature_stream(stream(spark, dealt(spark, data, 4, 1, "forget")), "user", "1 second", ttl_hours=1), "forget")
    assert open_rows(out, "event_id", "events", "members") == [(1, 1, 1), (2, 2, 2), (3, 1, 1), (4, 2, 2)]


def test_count_batches_in_event_order(spark, history):
    """A user with more rows in a batch than a chunk of state holds, and rests that are flushed by the watermark or by the next row."""
    hot = [(1000 + i, 7, 10 + i % 9000, "view", 1.0) for i in range(25_000)]
    source = dealt(spark, [*history, *hot], 3, 3000, "count")
    got = run_available(stateful.count_batches(stream(spark, source), 10, 3600, "3001 seconds"), "count").filter("user_id >= 0")
    want = []
    for user in {r[1] for r in [*history, *hot]}:
        own, batch, number = sorted((r[2], r[0], r[4]) for r in [*history, *hot] if r[1] == user), [], 0
        for k, row in enumerate(own):
            batch.append(row)
            if len(batch) == 10 or k + 1 == len(own) or own[k + 1][0] - row[0] >= 3600:
                number += 1
                want.append((user, number, len(batch), sum(b[2] for b in batch), len(batch) < 10))
                batch = []
    assert rows(got, "user_id", "batch_no", "event_count", "total_amount", "is_partial") == sorted(want, key=str)


def test_profile_upgrades_and_forgetting(spark):
    hour = 3600
    data = [
        (1, 1, 0, "login", 0.0), (2, 1, 1 * hour, "purchase", 600.0), (3, 1, 2 * hour, "view", 1.0), (4, 1, 5 * hour, "purchase", 1500.0),  # two upgrades in a day
        (5, 1, 30 * hour, "view", 1.0), (6, 1, 31 * hour, "purchase", 1.0),
        (7, 2, 0, "purchase", 900.0), (8, 2, 80 * hour, "purchase", 20.0),  # forgotten after a day, and starts anew
        (9, 3, 10, "purchase", 500.0),
    ]
    source = dealt(spark, data, 4, 6 * hour, "profile")
    out = run_available(stateful.user_profiles(stream(spark, source), f"{6 * hour + 1} seconds", ttl_hours=30), "profile").filter("user_id > 0")
    profiles = {r["event_id"]: r for r in out.filter("kind = 'PROFILE'").collect()}
    assert [(k, profiles[k]["session_count"], profiles[k]["total_spent"], profiles[k]["tier"]) for k in sorted(profiles)] == [
        (1, 1, 0.0, "BRONZE"), (2, 1, 600.0, "SILVER"), (3, 1, 600.0, "SILVER"), (4, 1, 2100.0, "GOLD"), (5, 1, 2100.0, "GOLD"), (6, 1, 2101.0, "GOLD"),
        (7, 0, 900.0, "SILVER"), (8, 0, 20.0, "BRONZE"), (9, 0, 500.0, "SILVER"),
    ]
    assert profiles[6]["recent_purchases"] == [2, 1, 0] and profiles[5]["preferences"] == {"c1": 2} and profiles[8]["recent_purchases"] == [2]
    base = int(START.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    active = rows(out.filter("kind = 'TIER_ACTIVATED'").withColumn("after_s", (F.col("at_ms") - base) / 1000), "user_id", "after_s", "tier", "total_spent")
    want = [(1, 25.0 * hour, "SILVER", 600.0), (1, 29.0 * hour, "GOLD", 2100.0), (2, 24.0 * hour, "SILVER", 900.0), (3, 24.0 * hour + 10, "SILVER", 500.0)]
    assert active == sorted(want, key=str)
    short = run_available(stateful.user_profiles(stream(spark, source), f"{6 * hour + 1} seconds", ttl_hours=10), "short")
    # After the upgrades at 1 h and 5 h the user is forgotten at 15 h, before a day has passed.
    assert rows(short.filter("kind = 'TIER_ACTIVATED' AND user_id > 0"), "user_id") == []
    assert short.filter("event_id = 6").first()["total_spent"] == 1.0


def test_state_goes_on_after_a_restart(spark, history):
    source, checkpoint, out = (scratch_path(spark, n) for n in ("again-in", "again-checkpoint", "again-out"))
    half = len(history) // 2
    add_file(events(spark, history[:half]), source)
    run_available(stateful.behavior_states(stream(spark, source), delay="10 seconds"), "again", checkpoint, out)
    add_file(events(spark, history[half:]), source)
    for k in range(2):
        add_file(events(spark, [(CLOSING + k, -1, 400 * DAY + k, "other", 501.0)]), source)
    got = run_available(stateful.behavior_states(stream(spark, source), delay="10 seconds"), "again", checkpoint, out)
    columns = ("event_id", "total_events", "total_spent", "user_tier")
    assert open_rows(got, *columns) == rows(keyed_state.user_behavior_state(events(spark, history)), *columns)


def test_asof_join_of_two_streams(spark):
    rng = random.Random(8)
    schema = "user_id long, since timestamp, version int, price decimal(10,2), note struct<a:int,b:string>, flag boolean"
    versions = [
        (rng.choice([1, 2, 3, None]), START + dt.timedelta(seconds=rng.randrange(0, 20_000), microseconds=rng.randrange(10**6)), v, Decimal(v) / 4, (v, f"n{v}") if v % 5 else None, v % 2 == 0)
        for v in range(120)
    ]
    versions += [(1, START + dt.timedelta(seconds=500), 900, Decimal("1.25"), (1, "x"), True), (1, START + dt.timedelta(seconds=500), 901, None, None, None), (9, START + dt.timedelta(days=399), 999, None, None, None)]
    data = [(i, rng.randrange(0, 4), rng.randrange(0, 20_000), "view", float(i)) for i in range(150)] + [(500, 1, 500, "view", 1.0)]
    table = spark.createDataFrame(versions, schema)
    log = scratch_path(spark, "versions")
    for k in range(3):
        add_file(table.filter(F.col("version") % 3 == k), log)
    for k in range(2):
        add_file(spark.createDataFrame([(9, START + dt.timedelta(days=400 + k), 2000 + k, None, None, None)], schema), log)
    source = dealt(spark, data, 4, 25_000, "probes")
    for tolerance in (None, 3000):
        changes = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(log)
        joined = asof_stream(stream(spark, source), changes, "user_id", "event_time", "since", ["version"], "30000 seconds", "400 days", tolerance, "v_")
        got = run_available(joined, "asof")
        want = joins.asof_join(events(spark, data), table, "user_id", "event_time", "since", ["version"], None if tolerance is None else f"{tolerance} seconds", "v_")
        assert got.columns == want.columns
        assert open_rows(got, *want.columns) == rows(want, *want.columns)
        assert open_rows(got.filter("event_id = 500"), "v_version") == [(901,)]


def test_exact_distinct_counts(spark):
    """Far more users in a window than an approximate count would get right, missing ones among them."""
    rng = random.Random(2)
    data = [(i, rng.randrange(2500) if i % 50 else None, i // 2, rng.choice(["view", "purchase"]), float(i % 7 + 1)) for i in range(12_000)]
    source = dealt(spark, data, 4, 900, "distinct")
    spark_rows = events(spark, data).withColumns({"price": F.lit(1.0), "quantity": F.lit(1)})
    streamed = stream(spark, source).withColumns({"price": F.lit(1.0), "quantity": F.lit(1)})
    for build in (
        lambda d: windows.hourly_rollup(d, ("category",), "901 seconds"),
        lambda d: windows.product_popularity(d, "20 minutes", "10 minutes", "901 seconds"),
        lambda d: windows.churn_signals(d, "901 seconds"),
    ):
        got, want = run_available(build(streamed), "distinct"), build(spark_rows)
        columns = want.columns
        assert rows(got.filter(F.col("window_start") < F.lit(START + dt.timedelta(days=300))), *columns) == rows(want, *columns)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join_of_two_streams(spark, how):
    rng = random.Random(4)
    data = [(i, rng.randrange(4), rng.randrange(0, 40_000), rng.choice(["view", "purchase"]), 1.0) for i in range(160)]

    def sides(first, second):
        views = first.filter("action = 'view'").select("event_id", F.col("user_id").alias("viewer"), "user_id", "event_time")
        return views, second.filter("action = 'purchase'").select(F.col("event_id").alias("bought_id"), "user_id", F.col("event_time").alias("bought_at"))

    source = dealt(spark, data, 4, 5000, "pairs")
    for k in range(2):  # both sides close
        add_file(events(spark, [(CLOSING + 10 * k + n, -1 - k, 400 * DAY + 9 * k, a, 0.0) for n, a in enumerate(("view", "purchase"))]), source)
    got = run_available(joins.interval_join(*sides(stream(spark, source), stream(spark, source)), "user_id", "event_time", "bought_at", -600, 7200, how, "5001 seconds").select("event_id", "viewer", "bought_id"), "pairs")
    want = joins.interval_join(*sides(events(spark, data), events(spark, data)), "user_id", "event_time", "bought_at", -600, 7200, how).select("event_id", "viewer", "bought_id")
    assert open_rows(got, *want.columns) == rows(want, *want.columns)
    by_hand = {(v[0], p[0]) for v in data for p in data if v[3] == "view" and p[3] == "purchase" and v[1] == p[1] and -600 <= p[2] - v[2] <= 7200}
    alone = {(v[0], None) for v in data if v[3] == "view" and v[0] not in {a for a, _ in by_hand}}
    assert {(r["event_id"], r["bought_id"]) for r in want.collect()} == by_hand | (alone if how == "left" else set())
