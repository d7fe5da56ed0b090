"""Edge cases of batch operators on small hand-made frames."""

import datetime as dt

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.functions import tiers, udfs
from tidewell.operators import aggregates, cdc, clean, enrich, features, graph, joins, keyed_state, lake, ml, ordering, quality, search, timeseries, windows
from tidewell.session import scratch_path
from tidewell.streaming import sessions


def at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_tiers_at_exact_thresholds(spark):
    df = spark.createDataFrame([(500.0,), (499.99,), (2000.0,), (5000.0,), (None,)], "v double")
    got = [r[0] for r in df.select(tiers.classify_tier("v")).collect()]
    assert got == ["Silver", "Bronze", "Gold", "Platinum", "Unknown"]
    assert [r[0] for r in df.select(tiers.categorize_price("v")).collect()] == ["Premium", "Standard", "Premium", "Premium", "Unknown"]


def test_sql_functions_equal_expressions(spark):
    udfs.register_functions(spark)
    df = spark.createDataFrame([(2, 450.0, "ELECTRONICS"), (3, 99.0, "OTHER"), (None, 1.0, "BOOKS")], "q int, p double, c string")
    out = df.select(F.expr("complexity_score(q, p, c)").alias("a"), tiers.complexity_score("q", "p", "c").alias("b")).collect()
    assert [r["a"] for r in out] == [13, 2, 0]
    assert all(r["a"] == r["b"] for r in out)


def test_user_aggregate_and_table_function(spark):
    from pyspark.sql import types as T

    udfs.register_udaf(spark, "spread_of", lambda v: float(v.max() - v.min()), T.DoubleType())

    class Repeat:
        def eval(self, n: int):
            for i in range(n):
                yield (i,)

    udfs.register_udtf(spark, "repeat_rows", Repeat, "i int")
    spark.createDataFrame([("a", 1.0), ("a", 4.0), ("b", 2.0)], "k string, v double").createOrReplaceTempView("udaf_rows")
    assert rows(spark.sql("SELECT k, spread_of(v) AS s FROM udaf_rows GROUP BY k"), "k", "s") == [("a", 3.0), ("b", 0.0)]
    assert spark.sql("SELECT * FROM repeat_rows(3)").count() == 3


def test_clean_sales_drops_bad_rows_and_copies(spark):
    data = [(1.0, 2, " toys ", "View"), (1.0, 2, " toys ", "View"), (0.0, 2, "toys", "view"), (5.0, -1, "toys", "view"), (None, 1, "toys", "view")]
    df = spark.createDataFrame(data, "price double, quantity int, category string, action string").withColumn("timestamp", F.lit(at(0)))
    out = clean.clean_sales(df).collect()
    assert [(r["category"], r["action"], r["total_amount"]) for r in out] == [("TOYS", "view", 2.0)]


def test_mask_columns(spark):
    df = spark.createDataFrame([("ann@mail.example", "1234567", "x")], "email string, phone string, secret string")
    r = clean.mask_columns(df, {"email": "email", "phone": "partial", "secret": "drop"}).first()
    assert (r["email"], r["phone"]) == ("***@mail.example", "***4567")
    assert "secret" not in r


def test_filter_and_route_with_missing_fields(spark):
    df = spark.createDataFrame([("purchase", None), (None, 150.0), ("view", 5.0), ("login", None)], "action string, value double")
    assert enrich.filter_events(df, 10.0, ["purchase"]).count() == 2
    assert [r["route"] for r in enrich.route_events(df).collect()] == ["transactions", "high_value", "analytics", "general"]


def test_full_outer_and_presence(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string")
    b = spark.createDataFrame([(2, "z"), (3, "w")], "k int, b string")
    assert rows(joins.full_outer_reconcile(a, b, ["k"]), "k", "presence") == [(1, "left_only"), (2, "both"), (3, "right_only")]


def test_broadcast_join_with_and_without_force(spark):
    fact = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "k int, name string")
    assert [joins.broadcast_join(fact, dim, ["k"], force=f).count() for f in (True, False)] == [3, 3]


def brute_asof(events, versions, tolerance=None):
    out = {}
    for e, key, t in events:
        best = None
        for k, vt, n, v in versions:
            if k == key and vt is not None and t is not None and vt <= t and (best is None or (vt, n) > best[0]):
                best = ((vt, n), v)
        if best and tolerance is not None and t - best[0][0] > dt.timedelta(minutes=tolerance):
            best = None
        out[e] = best[1] if best else None
    return out


@settings(max_examples=2, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 20)), max_size=15),
    st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 20)), max_size=15),
)
def test_asof_join_against_brute_force(spark, events, versions):
    events = [(i, k, at(t)) for i, (k, t) in enumerate(events)]
    versions = [(k, at(t), i, f"v{i}") for i, (k, t) in enumerate(versions)]
    left = spark.createDataFrame(events, "id int, k string, t timestamp")
    right = spark.createDataFrame(versions, "k string, vt timestamp, n int, v string")
    for hot in (0, None):
        out = joins.asof_join(left, right, "k", "t", "vt", ["n"], tolerance="5 minutes", hot_rows=hot)
        assert {r["id"]: r["v"] for r in out.collect()} == brute_asof(events, versions, 5)


def test_asof_join_includes_equal_time_and_null_time(spark):
    left = spark.createDataFrame([(1, "a", at(5)), (2, "a", None), (3, None, at(5))], "id int, k string, t timestamp")
    right = spark.createDataFrame([("a", at(5), "now"), ("a", at(9), "later")], "k string, vt timestamp, v string")
    assert {r["id"]: r["v"] for r in joins.asof_join(left, right, "k", "t", "vt").collect()} == {1: "now", 2: None, 3: None}


def test_interval_join_edges(spark):
    a = spark.createDataFrame([(1, "k", at(0))], "a_id int, k string, a_ts timestamp")
    b = spark.createDataFrame([(1, "k", at(0)), (2, "k", at(10)), (3, "k", at(11)), (4, "k", at(-1))], "b_id int, k string, b_ts timestamp")
    out = joins.interval_join(a, b.withColumnRenamed("k", "k"), "k", "a_ts", "b_ts", 0, 600).select("a_id", "b_id")
    assert rows(out, "a_id", "b_id") == [(1, 1), (1, 2)]


def test_string_agg_keeps_repeated_values(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "b"), ("g", None)], "g string, v string")
    assert aggregates.string_agg(df, "g", "v", ",").first()["joined"] == "a,b,b"


def test_band_edges_belong_below(spark):
    df = spark.createDataFrame([(50.0,), (50.01,), (100.0,), (500.0,), (500.01,)], "total_amount double").withColumn("k", F.lit(1))
    r = aggregates.price_band_histogram(df, ["k"]).first()
    assert (r["band_0_50"], r["band_50_100"], r["band_200_500"], r["band_500_up"]) == (1, 2, 1, 1)


def test_ntile_smaller_groups_than_buckets(spark):
    df = spark.createDataFrame([(i,) for i in range(7)], "id int")
    for hot in (0, None):
        assert [r[1] for r in rows(windows.ntile(df, [], ["id"], 3, "t", hot), "id", "t")] == [1, 1, 1, 2, 2, 3, 3]
        assert [r[1] for r in rows(windows.ntile(df.filter("id < 2"), [], ["id"], 3, "t", hot), "id", "t")] == [1, 2]


def test_quality_on_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert {r["null_percentage"] for r in quality.null_profile(df).collect()} == {0.0}
    assert quality.duplicate_profile(df).first()["duplicate_count"] == 0
    assert quality.quality_score({"t": (df, {"bad": F.col("a") < 0})}).first()["quality_score"] == 100.0


def test_value_rules_ignore_nulls(spark):
    df = spark.createDataFrame([(None, 1), (-1.0, 1)], "price double, quantity int")
    assert quality.rule_counts(df, {"neg": F.col("price") < 0}).first()["violations"] == 1


@settings(max_examples=2, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 8), st.integers(0, 3)), st.dictionaries(st.integers(0, 8), st.integers(0, 3)))
def test_merge_upsert_is_a_dictionary_update(spark, target, updates):
    a = spark.createDataFrame(list(target.items()), "k int, v int")
    b = spark.createDataFrame(list(updates.items()), "k int, v int")
    assert dict(rows(cdc.merge_upsert(a, b, ["k"]), "k", "v")) == {**target, **updates}


def test_latest_image_drops_deleted_keys(spark):
    df = spark.createDataFrame([(1, 1, False), (1, 2, True), (2, 1, True), (2, 2, False), (3, 1, None)], "k int, v int, is_deleted boolean")
    assert rows(cdc.latest_image(df, ["k"], ["v"]), "k", "v") == [(2, 2), (3, 1)]


def test_scd2_and_apply(spark):
    changes = spark.createDataFrame([(1, "a", at(0)), (1, "a", at(1)), (1, "b", at(2)), (2, None, at(0))], "k int, s string, ts timestamp")
    history = cdc.scd2(changes, ["k"], "ts", ["s"])
    assert rows(history, "k", "s", "is_current") == [(1, "a", False), (1, "b", True), (2, None, True)]
    new = spark.createDataFrame([(1, "b", at(9)), (2, "c", at(9)), (3, "d", at(9))], "k int, s string, ts timestamp")
    out = cdc.scd2_apply(history, new, ["k"], ["s"], "ts")
    assert rows(out.filter("is_current"), "k", "s") == [(1, "b"), (2, "c"), (3, "d")]
    assert out.count() == 5


def test_delete_where_keeps_unknown(spark):
    kept, gone = cdc.delete_where(spark.createDataFrame([(1,), (None,), (5,)], "v int"), F.col("v") > 3)
    assert (kept.count(), gone.count()) == (2, 1)


def test_zorder_keeps_rows_and_compact_merges_files(spark):
    df = spark.range(1000).select("id", (F.col("id") % 37).alias("b"))
    assert lake.zorder(df, ["id", "b"], bits=3).agg(F.sum("id")).first()[0] == sum(range(1000))
    path = scratch_path(spark, "many")
    df.repartition(20).write.parquet(path)
    packed = lake.compact(spark, path, scratch_path(spark, "few"))
    assert packed.count() == 1000 and len(packed.inputFiles()) == 1


def test_snapshot_diff_and_dedupe(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, None), (4, "d")], "k int, v string")
    assert rows(ordering.snapshot_diff(old, new, ["k"]), "k", "change") == [(1, "removed"), (2, "changed"), (4, "added")]
    df = spark.createDataFrame([(1, 5), (1, 9), (1, 9)], "k int, t int")
    assert ordering.dedupe(df).count() == 2
    assert ordering.dedupe(df, ["k"], ["-t"]).first()["t"] == 9


def test_top_k_per_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    plan = ordering.top_k_per(df, ["g"], ["-id"], 2)
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()
    assert plan.count() == 6


def test_feature_expires_after_its_ttl(spark):
    values = spark.createDataFrame([(1, at(0), 7.0)], "user int, ready timestamp, x double")
    entities = spark.createDataFrame([(1, at(10)), (1, at(11)), (2, at(5))], "user int, t timestamp")
    view = features.FeatureView("f", values, "user", "ready", "10 minutes")
    assert rows(features.historical_features(entities, "t", [view]), "user", "t", "f__x") == [(1, at(10), 7.0), (1, at(11), None), (2, at(5), None)]


def test_components_on_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, 101)]
    out = graph.components(spark.createDataFrame(chain, "src int, dst int"))
    assert dict(rows(out.groupBy("component").count(), "component", "count")) == {1: 60, 100: 2}


def test_shortest_hops_stops_at_limit(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (1, 3)], "src int, dst int")
    out = graph.shortest_hops(edges, spark.createDataFrame([(1,)], "node int"), 1)
    assert rows(out, "node", "hops") == [(1, 0), (2, 1), (3, 1)]


def test_pagerank_sums_to_one(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (1, 4)], "src int, dst int")
    assert abs(graph.pagerank(edges, iterations=9).agg(F.sum("rank")).first()[0] - 1) < 1e-9


def test_cosine_topk_against_numpy(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(40, 5))
    vectors = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "vec_id long, embedding array<float>")
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    want = {q: list(np.argsort(-(unit @ unit[q]), kind="stable")[:3]) for q in range(4)}
    got = {}
    for r in search.cosine_topk(vectors.repartition(4), vectors.filter("vec_id < 4"), 3).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == want


def test_ema_equals_the_recursion(spark):
    prices = [float((i * 37) % 50) for i in range(80)]
    ticks = spark.createDataFrame([("s", i, p) for i, p in enumerate(prices)], "k string, i int, p double")
    got = {r["i"]: r["ema"] for r in timeseries.indicators(ticks, "k", ["i"], "p", k=5).collect()}
    value = prices[0]
    for i, p in enumerate(prices):
        value = value if i == 0 else value + (p - value) * 2 / 6
        assert abs(got[i] - value) < 1e-9


def test_cart_abandonment(spark):
    data = [(1, 1, "add_to_cart", at(0)), (2, 1, "purchase", at(10)), (3, 1, "add_to_cart", at(20)), (4, 2, "add_to_cart", at(0)), (5, 2, "purchase", at(90))]
    df = spark.createDataFrame(data, "event_id int, user_id int, action string, event_time timestamp").withColumn("product_id", F.lit(1))
    for hot in (0, None):
        assert rows(timeseries.cart_abandonment(df, "30 minutes", hot), "event_id") == [(3,), (4,)]


@pytest.mark.parametrize("hot", [0, None])
def test_session_gap_is_exclusive(spark, hot):
    data = [(1, at(0)), (2, at(30)), (3, at(60) + dt.timedelta(microseconds=1))]
    df = spark.createDataFrame(data, "event_id int, event_time timestamp").withColumn("user_id", F.lit(1))
    assert rows(sessions.mark_sessions(df, ["user_id"], 1800, hot_rows=hot), "event_id", "session_no", "position") == [(1, 1, 1), (2, 1, 2), (3, 2, 1)]


def test_long_sessions_have_their_steps_as_rows(spark):
    data = [(i, at(i), "view") for i in range(5)]
    df = spark.createDataFrame(data, "event_id int, event_time timestamp, action string")
    df = df.withColumns({"user_id": F.lit(1), "product_id": F.lit(1), "category": F.lit("c"), "total_amount": F.lit(1.0)})
    assert "action_sequence" not in sessions.session_profile(df).columns
    assert sessions.session_steps(df).count() == 5


def test_models(spark):
    df = spark.range(400).select("id", (F.col("id") % 20).cast("double").alias("x"), ((F.col("id") * 7) % 11).cast("double").alias("y"))
    df = df.withColumn("label", F.col("x") * 3 + F.col("y"))
    _, rmse = ml.train_tabular(df, ["x", "y"], "label")
    assert rmse < 0.1
    clustered, model = ml.cluster_users(df, ["x", "y"], k=3)
    assert sum(ml.cluster_sizes(model)) == 400 == clustered.count()
    train, test = ml.split_by_key(df, "id")
    assert train.count() + test.count() == 400


def test_null_keys_stay(spark):
    schema = "user_id int, action string, category string, total_amount double, session_id int, timestamp timestamp, event_time timestamp, event_id int, product_id int"
    data = [(None, "view", None, 1.0, 1, at(0), at(0), 1, 1), (None, "view", "a", 2.0, 1, at(1), at(1), 2, 1), (1, "view", None, 3.0, 2, at(2), at(2), 3, 1)]
    df = spark.createDataFrame(data, schema)
    assert aggregates.user_behavior(df).count() == 2
    assert aggregates.cohort_analysis(df).count() == 1 and aggregates.cohort_analysis(df).first()["active_users"] == 2
    real = df.unionByName(df.filter("user_id = 1").withColumns({"category": F.lit("unknown"), "event_time": F.lit(None).cast("timestamp"), "event_id": F.lit(9)}))
    maps = {r["user_id"]: r for r in aggregates.breakdown_maps(real, ["user_id"]).collect()}
    assert [tuple(e) for e in maps[None]["by_category"]] == [("a", 2.0), (None, 1.0)] and [tuple(e) for e in maps[1]["by_category"]] == [("unknown", 3.0), (None, 3.0)]
    assert [tuple(e) for e in maps[1]["by_hour"]] == [(0, 3.0), (None, 3.0)]
    assert keyed_state.user_profile(df).filter("user_id is null").first()["preferences"] == {"a": 1}
    with pytest.raises(Exception, match="one row"):
        joins.cross_one_row(df.agg(F.count("*").alias("n")), df.select("event_id")).collect()
    assert joins.cross_one_row(df.agg(F.count("*").alias("n")), df.agg(F.max("event_id").alias("m"))).first() == (3, 3)
    assert windows.position_stats(df, ["category"], "total_amount", ["event_id"]).count() == 3
    assert windows.share_of_partition(df, "category", "total_amount", 5, ["event_id"]).count() == 3


def test_models_keep_rows_with_null_features(spark):
    df = spark.createDataFrame([(i, float(i % 4), None if i == 3 else float(i)) for i in range(40)], "id int, x double, y double")
    clustered, _ = ml.cluster_users(df, ["x", "y"], k=2)
    assert clustered.count() == 40 and clustered.filter("id = 3").first()["cluster"] is None


def test_exponential_mean_is_the_full_recursion(spark):
    prices = [float((i * 37) % 101) for i in range(9000)]
    df = spark.createDataFrame([(1, i + 1, p) for i, p in enumerate(prices)], "k int, rn int, p double")
    got = {r["rn"]: (r["fast"], r["slow"]) for r in timeseries.exponential_means(df, "k", "rn", "p", {"fast": 12, "slow": 500}).collect()}
    fast = slow = prices[0]
    for i, p in enumerate(prices):
        if i:
            fast, slow = fast + (p - fast) * 2 / 13, slow + (p - slow) * 2 / 501
        assert abs(got[i + 1][0] - fast) < 1e-8 and abs(got[i + 1][1] - slow) < 1e-8
