"""Progress of running streams and health of what they write."""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = (
    "query_name string, query_id string, batch_id long, at string, input_rows long, input_rate double, processed_rate double, "
    "watermark string, state_rows long"
)


class ProgressListener(StreamingQueryListener):
    """Keeps the last ``keep`` progress reports of all queries of a session."""

    def __init__(self, keep: int = 1000):
        self.reports: deque = deque(maxlen=keep)
        self.ended: dict[str, str | None] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.reports.append(
            (
                p.name, str(p.id), p.batchId, p.timestamp, p.numInputRows, p.inputRowsPerSecond, p.processedRowsPerSecond,
                dict(p.eventTime or {}).get("watermark"), sum(o.numRowsTotal for o in p.stateOperators),
            )
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.id)] = event.exception


def progress_metrics(spark: SparkSession, listener: ProgressListener) -> DataFrame:
    return spark.createDataFrame(list(listener.reports), SCHEMA)


def health_check(df: DataFrame, ts: str, as_of: str, max_age_minutes: float) -> DataFrame:
    """Rows, newest time, age in minutes and whether the table is fresh at ``as_of``."""
    age = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.max(ts))) / 60_000_000
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.max(ts).alias("latest"), age.alias("age_minutes")).withColumn(
        "is_fresh", F.coalesce(F.col("age_minutes") <= max_age_minutes, F.lit(False))
    )
