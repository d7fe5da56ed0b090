"""Replayed tables: every batch is taken whole, whatever the layout of the table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewell.session import scratch_path
from tidewell.streaming.run import replay, run_batches


@pytest.mark.parametrize("files", [1, 3, 24])
def test_batches_are_whole(spark, files):
    path, seen = scratch_path(spark, "layout"), {}
    start = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp")
    table = spark.range(60_000).select("id", (start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id").cast("decimal(18,6)"))).alias("at"))
    table.repartition(files).write.parquet(path)
    spark.conf.set("spark.sql.files.openCostInBytes", "65536")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        stream = replay(spark.read.parquet(path), "at", 4, F.pmod(F.col("id"), F.lit(100)) * 1_000_000, "whole")
        run_batches(stream, lambda df, batch: seen.update({batch: {r["id"] for r in df.collect()}}), "whole")
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    arrival = {i: i + i % 100 for i in range(60_000)}
    low, span = 0, max(arrival.values()) * 1_000_000 + 1
    want = {k: {i for i, a in arrival.items() if span * k // 4 <= a * 1_000_000 < span * (k + 1) // 4} for k in range(4)}
    assert seen == want
