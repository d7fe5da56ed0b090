"""Watermarks, late rows and duplicates."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_lateness(df: DataFrame, ts: str, out_of_order_seconds: int, lateness_seconds: int = 0) -> DataFrame:
    """Spark has one delay: it covers disorder plus the extra time late rows are still accepted."""
    return df.withWatermark(ts, f"{out_of_order_seconds + lateness_seconds} seconds")


def dedupe_within_watermark(df: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """One row per key; a stream forgets a key once the watermark has passed it."""
    if not df.isStreaming:
        return df.dropDuplicates(list(keys))
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


class LateSplitter:
    """``foreachBatch`` function that hands on-time and late rows to two writers.

    The high-water mark before each batch is kept in a small table, one folder per batch id,
    so a replayed batch is split exactly as before.
    """

    def __init__(self, marks: str, ts: str, delay_seconds: int,
                 on_time: Callable[[DataFrame, int], None], late: Callable[[DataFrame, int], None]):
        self.marks, self.ts, self.delay_seconds = marks, ts, delay_seconds
        self.on_time, self.late = on_time, late

    def high_mark(self, spark, batch_id: int):
        if batch_id == 0:
            return None
        marks = spark.read.schema("mark timestamp, batch_id long").parquet(self.marks)
        return marks.filter(F.col("batch_id") < batch_id).agg(F.max("mark")).first()[0]

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        df = df.persist()
        try:
            mark = self.high_mark(spark, batch_id)
            cutoff = F.lit(mark).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(self.delay_seconds))
            late = F.coalesce(F.col(self.ts) < cutoff, F.lit(False))
            self.on_time(df.filter(~late), batch_id)
            self.late(df.filter(late), batch_id)
            df.agg(F.max(self.ts).alias("mark")).write.mode("overwrite").parquet(f"{self.marks}/batch_id={batch_id}")
        finally:
            df.unpersist()
