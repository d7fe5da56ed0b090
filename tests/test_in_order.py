"""A replay in order of time: bounded batches, no row late, none lost."""

from pyspark.sql import functions as F

from tidewell.session import scratch_path
from tidewell.streaming import run, windows


def test_batches_are_bounded_and_rows_come_in_order(spark):
    times = F.when(F.col("id") % 50 > 0, F.timestamp_seconds(F.col("id") * 977 % 5000 + 1_700_000_000))
    table = spark.range(1000).select("id", times.alias("ts"))
    batches = []

    def note(rows, batch_id):
        batches.append(rows.agg(F.count("*"), F.count("ts"), F.min("ts"), F.max("ts")).first())

    run.run_batches(run.in_order(table, "ts", "t", rows_per_batch=300), note, "t")
    full = [b for b in batches if b[0]]
    assert len(full) == 4 and sum(b[0] for b in full) == 1000 and sum(b[1] for b in full) == 980
    assert all(a[3] < b[2] for a, b in zip(full, full[1:], strict=False))
    assert max(b[1] for b in full) < 300


def test_state_goes_as_the_batches_pass(spark, tables):
    raw = tables.read("events")
    stream = tables.event_view(run.in_order(raw, "ts", "events", rows_per_batch=raw.count() // 4))
    query = windows.session_sliding(stream).writeStream.format("noop").trigger(availableNow=True).option("checkpointLocation", scratch_path(spark, "c")).start()
    query.awaitTermination()
    held = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    assert sum(s["numRowsDroppedByWatermark"] for s in held) == 0
    assert max(s["numRowsTotal"] for s in held) < windows.session_sliding(tables.events).count() / 2


def test_sessions_hold_only_what_is_read(spark, monkeypatch):
    from conftest import SF
    from tidewell.plans import catalog, streams

    seen = []
    monkeypatch.setattr(streams, "run_available", lambda stream, label: seen.append(stream.columns) or stream)
    catalog.QUERIES["str_10_session_windows_stream"](spark, SF)
    assert seen == [["user_id", "session_start", "session_end", "event_count", "total_spent"]]


def test_larger_tables_are_replayed_in_more_batches(tables):
    from tidewell.plans.event_streams import PARTS, out_of_order
    from tidewell.streaming.run import run_batches

    n, seen = tables.read("events").count(), []
    run_batches(out_of_order(tables, rows_per_batch=n // 8), lambda rows, batch_id: seen.append(rows.count()), "t")
    assert len(seen) >= 8 and sum(seen) == n
    seen.clear()
    run_batches(out_of_order(tables, PARTS, rows_per_batch=n // 8), lambda rows, batch_id: seen.append(rows.count()), "t")
    assert len(seen) == PARTS and sum(seen) == n
