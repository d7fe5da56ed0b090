"""Streams: equal to the table form, across restarts, files, late and repeated rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewell.session import scratch_path
from tidewell.sources import sinks
from tidewell.streaming import lateness, monitor, sessions, windows
from tidewell.streaming.run import run_available, run_batches



@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")


SCHEMA = "event_id long, user_id long, session_id string, product_id long, category string, action string, event_type string, total_amount double, event_time timestamp"
START = dt.datetime(2024, 1, 1)


def events(spark, rows):
    """rows: (id, user, seconds, action, amount)."""
    data = [(i, u, f"s{u}", i % 3, f"c{i % 2}", a, a, m, START + dt.timedelta(seconds=s)) for i, u, s, a, m in rows]
    return spark.createDataFrame(data, SCHEMA)


def add_file(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, files_per_batch=1):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_windows_continue_after_restart(spark):
    source, checkpoint, out = (scratch_path(spark, n) for n in ("restart-in", "restart-checkpoint", "restart-out"))
    first = events(spark, [(i, 1, i * 20, "view", 1.0) for i in range(10)])
    second = events(spark, [(i, 1, i * 20, "view", 1.0) for i in range(10, 40)])
    add_file(first, source)
    run_available(windows.tumbling_counts(stream(spark, source)), "restart", checkpoint, out)
    add_file(second, source)
    got = run_available(windows.tumbling_counts(stream(spark, source)), "restart", checkpoint, out)
    want = windows.tumbling_counts(first.unionByName(second))
    latest = START + dt.timedelta(seconds=39 * 20 - 120)
    assert rows(got, "window_start", "event_count") == rows(want.filter(F.col("window_end") <= latest), "window_start", "event_count")


def test_session_gap_on_a_stream(spark):
    source = scratch_path(spark, "gap-in")
    add_file(events(spark, [(1, 1, 0, "view", 1.0), (2, 1, 1800, "view", 1.0), (3, 1, 3601, "view", 1.0), (4, 1, 3700, "view", 1.0), (5, 2, 90000, "view", 1.0)]), source)
    got = run_available(sessions.session_windows(stream(spark, source)), "gap")
    assert rows(got, "user_id", "event_count") == [(1, 2), (1, 2)]


def test_late_rows_leave_by_the_side(spark):
    source, marks, out = (scratch_path(spark, n) for n in ("late-in", "late-marks", "late-out"))
    add_file(events(spark, [(1, 1, 0, "view", 1.0), (2, 1, 500, "view", 1.0)]), source)
    add_file(events(spark, [(3, 1, 439, "view", 1.0), (4, 1, 440, "view", 1.0), (5, 1, 600, "view", 1.0)]), source)

    def to(side):
        return lambda df, n: df.write.mode("overwrite").parquet(f"{out}/side={side}/n={n}")

    run_batches(stream(spark, source), lateness.LateSplitter(marks, "event_time", 60, to("ok"), to("late")), "late")
    assert rows(spark.read.parquet(out).filter("side = 'late'"), "event_id") == [(3,)]
    assert spark.read.parquet(out).count() == 5


def test_duplicates_inside_the_watermark(spark):
    source = scratch_path(spark, "dup-in")
    df = events(spark, [(1, 1, 0, "view", 1.0), (2, 1, 5, "view", 1.0)])
    add_file(df, source)
    add_file(df, source)
    assert run_available(lateness.dedupe_within_watermark(stream(spark, source), ["event_id"], "event_time", "1 hour"), "dup").count() == 2
    assert lateness.dedupe_within_watermark(df.unionByName(df), ["event_id"], "event_time", "1 hour").count() == 2


def test_upsert_replay_changes_nothing(spark):
    sink = sinks.UpsertSink(scratch_path(spark, "upsert"), ["user_id"], ["event_time"], buckets=4)
    first = events(spark, [(1, 1, 0, "view", 1.0), (2, 2, 0, "view", 1.0)])
    second = events(spark, [(3, 1, 9, "purchase", 1.0), (4, 3, 9, "view", 1.0)])
    sink(first, 0)
    sink(second, 1)
    once = rows(sink.current(spark), "user_id", "event_id")
    sink(second, 1)
    assert rows(sink.current(spark), "user_id", "event_id") == once == [(1, 3), (2, 2), (3, 4)]


def test_memory_sink_and_progress(spark):
    source = scratch_path(spark, "progress-in")
    add_file(events(spark, [(1, 1, 0, "view", 1.0)]), source)
    listener = monitor.ProgressListener()
    spark.streams.addListener(listener)
    try:
        query = sinks.memory_sink(stream(spark, source), "progress_rows")
        query.awaitTermination()
        assert spark.table("progress_rows").count() == 1
        import time

        for _ in range(50):
            if listener.reports:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    metrics = monitor.progress_metrics(spark, listener).filter("query_name = 'progress_rows'")
    assert metrics.agg(F.sum("input_rows")).first()[0] == 1
    health = monitor.health_check(spark.table("progress_rows"), "event_time", "2024-01-01 00:30:00", 60).first()
    assert health["is_fresh"] and health["age_minutes"] == 30
