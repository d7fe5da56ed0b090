"""Streams have no more stateful steps than their result needs: each costs a state store per partition and batch."""

from pyspark.sql import functions as F

from tidewell.session import scratch_path
from tidewell.streaming import windows


def steps(stream):
    query = stream.writeStream.format("noop").outputMode("append").trigger(availableNow=True).option("checkpointLocation", scratch_path(stream.sparkSession, "steps")).start()
    query.awaitTermination()
    return len(query.lastProgress["stateOperators"])


def test_levels_of_windows_are_one_step(spark, tables):
    stream = tables.event_stream
    assert steps(windows.all_levels(stream, {"minute": "1 minute", "five": "5 minutes", "hourly": "1 hour"})) == 1


def test_levels_are_those_of_single_groupings(spark, tables):
    sizes = {"minute": "1 minute", "day": "1 day"}
    both = windows.all_levels(tables.events, sizes)
    for name, size in sizes.items():
        alone = tables.events.groupBy(F.window("event_time", size), "category").agg(F.count(F.lit(1)).alias("order_count"))
        alone = alone.select("window.start", "window.end", "category", "order_count")
        level = both.filter(F.col("level") == name).select("window_start", "window_end", "category", "order_count")
        assert sorted(map(str, alone.collect())) == sorted(str(r).replace("window_start", "start").replace("window_end", "end") for r in level.collect())
