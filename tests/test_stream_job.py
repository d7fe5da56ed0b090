"""The stream job keeps its state in few stores, whatever the number of partitions of a shuffle."""

from pyspark.sql import functions as F

from tidewell.plans import functions_io, jobs
from tidewell.session import scratch_path
from tidewell.streaming import run


def test_stores_are_few_and_batches_bounded(spark, monkeypatch):
    monkeypatch.setattr(jobs.stream_windows, "active_users", lambda events: events.select("event_id"))
    monkeypatch.setattr(jobs.stream_windows, "session_sliding", lambda events: events.select("event_id"))
    monkeypatch.setattr(jobs.stream_windows, "sliding_revenue", lambda events: events.select("event_id"))
    monkeypatch.setattr(jobs.stream_windows, "fraud_window", lambda events: events.select("event_id"))
    monkeypatch.setattr(jobs.enrich, "high_value_alerts", lambda events, least: events.select("event_id"))
    times = F.timestamp_seconds(F.col("id") * 977 % 5000 + 1_700_000_000)
    table = spark.range(300).select(F.col("id").alias("event_id"), times.alias("event_time"), F.lit("view").alias("event_type"), F.lit(3.0).alias("total_amount"))
    events = run.in_order(table, "event_time", "t", rows_per_batch=100)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "300")
    try:
        started = jobs.stream_job(events, scratch_path(spark, "o"), scratch_path(spark, "c"), {"availableNow": True})
        assert spark.conf.get("spark.sql.shuffle.partitions") == "300"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for query in started.values():
        query.awaitTermination()
    steps = [s for p in started["minute_counts"].recentProgress for s in p["stateOperators"]]
    assert steps and {s["numShufflePartitions"] for s in steps} == {run.STORES_PER_CORE * spark.sparkContext.defaultParallelism}
    assert sum(p["numInputRows"] for p in started["minute_counts"].recentProgress) == 300
    assert functions_io.JOB_EVENTS_PER_BATCH < run.ROWS_PER_BATCH
