"""Sessions by inactivity gap.

Tables use gap flags in event order, which ``scan`` can split inside one huge user; streams
use ``session_window``. A session closes when the next event comes more than the gap later.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.measures import ratio, total
from tidewell.operators.scan import lag, row_number, running_max, running_sum, scan

TS = "event_time"


def mark_sessions(df: DataFrame, keys: Sequence[str], gap_seconds: int, tiebreak: Sequence[str] = ("event_id",),
                  hot_rows: int | None = None) -> DataFrame:
    """Add ``session_no`` per key and ``position`` inside the session to every event of a table."""
    starts = F.col("__before").isNull() | (F.unix_micros(TS) - F.col("__before") > gap_seconds * 1_000_000)
    return (
        scan(
            df, keys, [TS, *tiebreak],
            {"__before": lag(F.unix_micros(TS))},
            {"session_no": running_sum(F.when(starts, 1).otherwise(0).cast("long")), "__rn": row_number()},
            {"__from": running_max(F.when(starts, F.col("__rn")))},
            hot_rows=hot_rows,
        )
        .withColumn("position", F.col("__rn") - F.col("__from") + 1)
        .drop("__before", "__rn", "__from")
    )


def _sessions(df, keys, gap_seconds, delay, hot_rows, tiebreak=("event_id",), **aggregates: Column) -> DataFrame:
    named = [a.alias(n) for n, a in aggregates.items()]
    if df.isStreaming:
        window = F.session_window(TS, f"{gap_seconds} seconds")
        out = df.withWatermark(TS, delay).groupBy(window, *keys).agg(*named)
        return out.select(
            *keys, F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), *aggregates
        )
    marked = mark_sessions(df, keys, gap_seconds, tiebreak, hot_rows)
    out = marked.groupBy(*keys, "session_no").agg(F.min(TS).alias("session_start"), F.max(TS).alias("__last"), *named)
    end = F.col("__last") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(gap_seconds))
    return out.select(*keys, "session_start", end.alias("session_end"), *aggregates)


def session_windows(df: DataFrame, gap_seconds: int = 1800, keys: Sequence[str] = ("user_id",), actions: Sequence[str] = ("view", "add_to_cart", "purchase"),
                    delay: str = "30 seconds", hot_rows: int | None = None) -> DataFrame:
    """Sessions of more than one event; the end is the last event plus the gap."""
    products = F.approx_count_distinct("product_id", 0.02) if df.isStreaming else F.count_distinct("product_id")
    out = _sessions(
        df.filter(F.col("action").isin(*actions)), list(keys), gap_seconds, delay, hot_rows,
        event_count=F.count(F.lit(1)), total_spent=total("total_amount"), unique_products=products,
    ).filter(F.col("event_count") > 1)
    micros = F.unix_micros("session_end") - F.unix_micros("session_start")
    return out.withColumn("session_duration_minutes", micros / 60_000_000)


def session_profile(df: DataFrame, gap_seconds: int = 1800, hot_rows: int | None = None) -> DataFrame:
    """Metrics and type of every session of a table. Its action sequence, at any length, is the rows of :func:`session_steps`."""
    bought = F.col("action") == "purchase"
    marked = mark_sessions(df, ["user_id"], gap_seconds, hot_rows=hot_rows)
    out = marked.groupBy("user_id", "session_no").agg(
        F.min(TS).alias("session_start"), F.max(TS).alias("last_event"),
        F.count(F.lit(1)).alias("event_count"), total("total_amount").alias("total_amount"),
        F.count_distinct("product_id").alias("unique_products"), F.count_distinct("category").alias("unique_categories"),
        F.count_if(bought).alias("purchase_count"), F.count_if(F.col("action") == "view").alias("view_count"),
    )
    span = F.unix_micros("last_event") - F.unix_micros("session_start")
    count, categories = F.col("event_count"), F.col("unique_categories")
    per_event = F.col("purchase_count") / count
    return out.withColumns(
        {
            "session_duration_ms": F.floor(span / 1000),
            "avg_order_value": ratio("total_amount", "purchase_count"),
            "conv_per_event": per_event,
            "conv_per_view": F.when(F.col("view_count") > 0, F.col("purchase_count") / F.col("view_count")).otherwise(0.0),
            "avg_time_between_events_ms": F.floor(span / 1000) / F.greatest(count - 1, F.lit(1)),
            "session_type": F.when(F.col("total_amount") > 500, "HIGH_VALUE")
            .when(count > 10, "HIGH_ENGAGEMENT")
            .when(categories > 2, "CROSS_CATEGORY")
            .when(per_event > 0.5, "HIGH_CONVERSION")
            .otherwise("REGULAR"),
        }
    )


def session_steps(df: DataFrame, gap_seconds: int = 1800, hot_rows: int | None = None) -> DataFrame:
    """Every step of every session as a row."""
    return mark_sessions(df, ["user_id"], gap_seconds, hot_rows=hot_rows).select(
        "user_id", "session_no", "position", "event_id", "action"
    )


def session_tracker(df: DataFrame, gap_seconds: int = 1800, hot_rows: int | None = None) -> DataFrame:
    """Final session metrics with the engagement score (table twin of the keyed tracker)."""
    action = F.col("action")
    marked = mark_sessions(df, ["user_id"], gap_seconds, hot_rows=hot_rows)
    out = marked.groupBy("user_id", "session_no").agg(
        F.min(TS).alias("session_start"), F.max(TS).alias("last_event"), F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("category").alias("unique_categories"),
        F.coalesce(total(F.when(action == "purchase", F.col("total_amount"))), F.lit(0.0)).alias("total_spent"),
        F.count_if(action == "view").alias("view_count"), F.count_if(action == "add_to_cart").alias("cart_count"),
        F.count_if(action == "purchase").alias("purchase_count"),
    )
    return out.withColumn(
        "engagement_score",
        F.col("view_count") + F.col("cart_count") * 3 + F.col("purchase_count") * 5 + F.col("unique_categories") * 2,
    )
