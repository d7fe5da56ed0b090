"""Readers, writers, generators, result store and the parts of connectors that need no server."""

import pytest
from pyspark.sql import functions as F

from tidewell.session import scratch_path
from tidewell.sources import kafka, parse, readers, sinks, synthetic
from tidewell.sources.materialized import ResultStore


def test_jdbc_options_split_only_with_bounds():
    plain = readers.jdbc_options("jdbc:x", "t")
    assert "partitionColumn" not in plain
    split = readers.jdbc_options("jdbc:x", "t", "id", ("1", "9"), 4)
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("1", "9", "4")
    assert sinks.jdbc_write_options("jdbc:x", "t", 50)["batchsize"] == "50"


def test_kafka_options():
    options = kafka.source_options("b:1", "topic", max_per_trigger=5)
    assert options["failOnDataLoss"] == "false" and options["maxOffsetsPerTrigger"] == "5"
    assert kafka.range_options("b:1", "topic", 7)["startingTimestamp"] == "7"


def test_parse_and_split(spark):
    good = '{"event_id":"e1","price":2.5,"quantity":2,"timestamp":"2024-01-01 10:00:00","metadata":{"ip_address":"1.2.3.4"}}'
    late = '{"event_id":"e2","price":1.0,"quantity":1,"timestamp":"yesterday"}'
    df = spark.createDataFrame([("k", good), ("k", late), ("k", "{broken"), ("k", None)], "key string, value string")
    parsed = parse.parse_events(df).collect()
    assert [(r["event_id"], r["total_amount"], r["metadata"]["ip_address"]) for r in parsed] == [("e1", 5.0, "1.2.3.4")]
    ok, dead = parse.split_malformed(df)
    assert (ok.count(), dead.count()) == (2, 2)
    assert {r["value"] for r in dead.collect()} == {"{broken", None}


def test_synthetic_data_does_not_depend_on_partitions(spark):
    a = synthetic.synthetic_sales(spark, 500).agg(F.sum(F.xxhash64("user_id", "price", "category") % 1000)).first()[0]
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "3")
    try:
        b = synthetic.synthetic_sales(spark, 500).agg(F.sum(F.xxhash64("user_id", "price", "category") % 1000)).first()[0]
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert a == b
    assert synthetic.synthetic_events(spark, 10).count() == synthetic.synthetic_transactions(spark, 10).count() == 10
    assert synthetic.rate_events(spark).isStreaming
    low, high = synthetic.synthetic_sales(spark, 500).agg(F.min("price"), F.max("price")).first()
    assert 10 <= low and high <= 1000


def test_store_reuses_expires_and_forgets(spark):
    now = [1000.0]
    store = ResultStore(spark, scratch_path(spark, "store"), clock=lambda: now[0])
    first = store.materialize("sum", spark.range(5), 60).inputFiles()
    assert store.materialize("sum", spark.range(5), 60).inputFiles() == first
    now[0] += 61
    renewed = store.materialize("sum", spark.range(5), 60).inputFiles()
    assert renewed != first
    now[0] += 1
    assert store.materialize("sum", spark.range(6), 60).count() == 6
    now[0] += 1
    store.warm({"other": spark.range(1)}, 60)
    assert store.invalidate("s*") == ["sum"]
    assert [r["name"] for r in store.live().collect()] == ["other"]


def test_incremental_load_repeats_until_committed(spark):
    marks = scratch_path(spark, "marks")
    rows = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-02 00:00:00",)], "s string").select(F.to_timestamp("s").alias("t"))
    fresh, _ = readers.read_incremental(lambda: rows, "t", marks, "x", spark)
    assert fresh.count() == 2
    fresh, commit = readers.read_incremental(lambda: rows, "t", marks, "x", spark)
    assert fresh.count() == 2
    commit()
    fresh, _ = readers.read_incremental(lambda: rows, "t", marks, "x", spark)
    assert fresh.count() == 0


def test_partitioned_write_and_sample(spark):
    path = scratch_path(spark, "parts")
    df = spark.range(100).select("id", (F.col("id") % 2).alias("p"))
    sinks.write_partitioned(df, path, ["p"], spread=3)
    back = readers.read_parquet(spark, path)
    assert back.filter("p = 1").count() == 50
    plan = back.filter("p = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan
    sample = scratch_path(spark, "sample")
    sinks.write_sample(df, sample, 0.5)
    assert 0 < spark.read.parquet(sample).count() < 100


def test_catalog_and_describe(spark):
    readers.register_views(spark, {"catalog_probe": spark.range(1)})
    assert readers.catalog_tables(spark).filter("name = 'catalog_probe'").count() >= 1
    assert [tuple(r) for r in readers.describe(spark.range(1)).collect()] == [(1, "id", "bigint", False)]


def test_dual_write_shapes(spark):
    df = spark.createDataFrame([("e1", "view", 1, "s", 2.5), ("e2", None, None, None, None)], "event_id string, event_type string, user_id int, session_id string, price double")
    df = df.withColumn("event_time", F.lit("2024-01-01").cast("timestamp"))
    raw = {r["data"]["event_id"]: r for r in sinks.raw_event_rows(df).collect()}
    assert raw["e2"]["event_type"] == "unknown" and "price" not in raw["e2"]["data"] and raw["e1"]["data"]["price"] == "2.5"
    assert sinks.user_activity_rows(df, "event_time").count() == 1


def test_csv_and_text(spark):
    path = scratch_path(spark, "csv")
    sinks.write_csv_report(spark.range(3), path)
    assert readers.read_csv(spark, path).dtypes == [("id", "int")]
    assert readers.read_text(spark, path).count() == 4


def test_shared_dir_needs_a_name_on_a_cluster(spark):
    from types import SimpleNamespace

    from tidewell.session import shared_dir

    conf = SimpleNamespace(get=lambda key, default=None: None)
    fake = SimpleNamespace(
        sparkContext=SimpleNamespace(getConf=lambda: conf, master="spark://host:7077", applicationId="a"), conf=conf
    )
    with pytest.raises(RuntimeError):
        shared_dir(fake)
