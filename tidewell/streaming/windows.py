"""Event-time window jobs. Every function takes a table or a stream.

On a stream the watermark bounds the state; on a table it has no effect. Distinct counts are exact on both: a stream first
reduces rows to one per window, keys and counted value, and then counts those, as two stateful steps. Both drop a window once the
watermark passes its end; the first holds one row per counted value of the open windows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.measures import Measure, averaged, counted, extreme, mean, ratio, summed, total
from tidewell.operators.ordering import top_k_per
from tidewell.operators.scan import row_number, scan

TS = "event_time"


def _rows() -> Column:
    return F.count(F.lit(1))


def windowed(df: DataFrame, by: Sequence[str], size: str, slide: str | None, delay: str, **aggregates: Column) -> DataFrame:
    """Group by time window and keys; the window's bounds come first."""
    window = F.window(TS, size, slide) if slide else F.window(TS, size)
    out = df.withWatermark(TS, delay).groupBy(window, *by).agg(*[a.alias(n) for n, a in aggregates.items()])
    return out.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, *aggregates
    )


def windowed_distinct(
    df: DataFrame, by: Sequence[str], size: str, slide: str | None, delay: str, name: str, column: str, **measures: Measure
) -> DataFrame:
    """Like ``windowed`` with mergeable measures, and ``name`` as the exact number of distinct values of ``column``; NULL is no value."""
    parts = {f"__{m}_{p}": part for m, measure in measures.items() for p, part in measure.parts.items()}
    merges = {f"__{m}_{p}": merge for m, measure in measures.items() for p, merge in measure.merges.items()}
    window = (F.window(TS, size, slide) if slide else F.window(TS, size)).alias("window")
    rows = df.withWatermark(TS, delay)
    if df.isStreaming:
        reduced = rows.groupBy(window, *by, F.col(column).alias("__value")).agg(*[part.alias(n) for n, part in parts.items()])
        out = reduced.groupBy("window", *by).agg(F.count("__value").alias(name), *[merge(F.col(n)).alias(n) for n, merge in merges.items()])
    else:
        out = rows.groupBy(window, *by).agg(F.count_distinct(column).alias(name), *[part.alias(n) for n, part in parts.items()])
    values = [measure.finish(lambda p, m=m: F.col(f"__{m}_{p}")).alias(m) for m, measure in measures.items()]
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, name, *values)


def tumbling_counts(df: DataFrame, size: str = "1 minute", delay: str = "2 minutes") -> DataFrame:
    return windowed(df, ["event_type"], size, None, delay, event_count=_rows(), total_revenue=total("total_amount"))


def sliding_revenue(df: DataFrame, size: str = "5 minutes", slide: str = "1 minute", delay: str = "5 minutes") -> DataFrame:
    return windowed(
        df, ["category"], size, slide, delay,
        revenue=total("total_amount"), order_count=_rows(), avg_order_value=mean("total_amount"),
    )


def active_users(df: DataFrame, size: str = "10 minutes", slide: str = "2 minutes", delay: str = "10 minutes") -> DataFrame:
    """Activity per user; the set of event types is as small as their domain."""
    out = windowed(
        df, ["user_id"], size, slide, delay,
        activity_count=_rows(), total_spent=total("total_amount"), events=F.array_sort(F.collect_set("event_type")),
    )
    return out.withColumn("unique_events", F.size("events"))


def session_sliding(df: DataFrame, size: str = "30 minutes", slide: str = "5 minutes", delay: str = "30 minutes") -> DataFrame:
    out = windowed(
        df, ["session_id"], size, slide, delay,
        events_in_session=_rows(), session_value=total("total_amount"), session_events=F.array_sort(F.collect_set("event_type")),
        session_start=F.min(TS), session_end=F.max(TS),
    )
    seconds = F.unix_seconds("session_end") - F.unix_seconds("session_start")
    return out.withColumn("session_duration_minutes", seconds / 60)


def fraud_window(
    df: DataFrame, size: str = "5 minutes", delay: str = "5 minutes", max_count: int = 10, max_amount: float = 2000, max_ips: int = 3
) -> DataFrame:
    """Users with too many events, too much spend or too many addresses in a window."""
    out = windowed_distinct(
        df, ["user_id"], size, None, delay, "unique_ips", "ip_address", transaction_count=counted(), window_amount=summed("total_amount"),
    )
    many, much, ips = F.col("transaction_count") > max_count, F.col("window_amount") > max_amount, F.col("unique_ips") > max_ips
    return out.filter(many | much | ips).withColumn(
        "fraud_type", F.when(many, "HIGH_FREQUENCY").when(much, "HIGH_VALUE").otherwise("MULTIPLE_IPS")
    )


def tumble_revenue(df: DataFrame, size: str = "1 minute", delay: str = "30 seconds", purchases_only: bool = False) -> DataFrame:
    """Revenue per category and window over positive rows; ``purchases_only`` counts purchases alone."""
    kept = df.filter((F.col("price") > 0) & (F.col("quantity") > 0))
    if purchases_only:
        kept = kept.filter(F.col("action") == "purchase")
    return windowed_distinct(
        kept, ["category"], size, None, delay, "unique_users", "user_id", total_revenue=summed("total_amount"), order_count=counted(),
        avg_order_value=averaged("total_amount"), max_order_value=extreme("total_amount", F.max),
    )


def hourly_rollup(df: DataFrame, by: Sequence[str] = ("category",), delay: str = "30 seconds") -> DataFrame:
    kept = df.filter((F.col("price") > 0) & (F.col("quantity") > 0))
    return windowed_distinct(
        kept, list(by), "1 hour", None, delay, "unique_users", "user_id",
        total_revenue=summed("total_amount"), order_count=counted(), avg_order_value=averaged("total_amount"),
    )


def product_revenue(df: DataFrame, size: str = "5 minutes", delay: str = "30 seconds") -> DataFrame:
    """Purchase revenue per product and window, the input of the ranking."""
    out = windowed(
        df.filter(F.col("action") == "purchase"), ["product_id", "category"], size, None, delay,
        total_revenue=total("total_amount"), order_count=_rows(),
    )
    return out.filter(F.col("total_revenue") > 0)


def rank_products(cells: DataFrame, k: int = 10) -> DataFrame:
    """Best ``k`` products per window and category. Streams rank finished windows in ``foreachBatch``."""
    return top_k_per(cells, ["window_start", "category"], ["-total_revenue", "product_id"], k, "popularity_rank")


def product_popularity(df: DataFrame, size: str = "5 minutes", slide: str = "1 minute", delay: str = "20 seconds") -> DataFrame:
    bought = F.col("action") == "purchase"
    out = windowed_distinct(
        df, ["product_id"], size, slide, delay, "unique_users", "user_id",
        views=counted(F.col("action") == "view"), purchases=counted(bought), revenue=summed(F.when(bought, F.col("total_amount"))),
    )
    return out.withColumns(
        {"revenue": F.coalesce("revenue", F.lit(0.0)), "conversion_rate": ratio("purchases", "views")}
    )


def all_levels(df: DataFrame, sizes: Mapping[str, str], by: Sequence[str] = ("category",), delay: str = "20 seconds") -> DataFrame:
    """The same additive metrics at several window sizes, in one grouping: a row counts once per level, and a stream has one stateful step."""
    rows = df.select(TS, *by, F.col("total_amount").cast("decimal(18,2)").alias("__amount")).withWatermark(TS, delay)
    for k, size in enumerate(sizes.values()):
        rows = rows.withColumn(f"__w{k}", F.window(TS, size))
    levels = [F.struct(F.lit(name).alias("level"), F.col(f"__w{k}").alias("window")) for k, name in enumerate(sizes)]
    grouped = rows.select(*by, "__amount", F.inline(F.array(*levels))).groupBy("level", "window", *by)
    out = grouped.agg(_rows().alias("order_count"), F.sum("__amount").cast("double").alias("total_revenue"))
    return out.select("level", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, "order_count", "total_revenue")


def multi_level_windows(df: DataFrame, sizes: Mapping[str, str], by: Sequence[str] = ("category",), delay: str = "20 seconds") -> dict[str, DataFrame]:
    """``all_levels`` level by level; each one is a grouping of its own and depends on no other."""
    return {name: all_levels(df, {name: size}, by, delay) for name, size in sizes.items()}


def count_trigger(df: DataFrame, key: str, n: int, order: Sequence[str] = (TS, "event_id"), hot_rows: int | None = None) -> DataFrame:
    """An aggregate for every ``n`` events of a key in event order, the last one partial (tables; streams: ``stateful``)."""
    numbered = scan(df, [key], order, {"__rn": row_number()}, hot_rows=hot_rows)
    batch_no = F.ceil(F.col("__rn") / n).cast("long").alias("batch_no")
    return numbered.groupBy(key, batch_no).agg(
        _rows().alias("event_count"), total("total_amount").alias("total_amount"),
        F.min(TS).alias("first_event"), F.max(TS).alias("last_event"),
    )


def behavior_patterns(
    df: DataFrame, size: str = "10 minutes", slide: str = "2 minutes", delay: str = "20 seconds",
    rapid: int = 3, very_rapid: int = 5, high_value: float = 1000, switching: int = 4, browsing: int = 10,
) -> DataFrame:
    """Patterns of a user inside a window, as an array of (type, description, severity)."""
    action = F.col("action")
    bought = action == "purchase"
    out = windowed(
        df, ["user_id"], size, slide, delay,
        event_count=_rows(), purchases=F.count_if(bought), views=F.count_if(action == "view"),
        adds=F.count_if(action == "add_to_cart"), removes=F.count_if(action == "remove"),
        total_spent=F.coalesce(total(F.when(bought, F.col("total_amount"))), F.lit(0.0)),
        unique_categories=F.size(F.collect_set("category")),
    ).filter(F.col("event_count") >= 2)

    def pattern(condition, name, text, severity):
        return F.when(condition, F.struct(F.lit(name).alias("type"), text.alias("description"), severity.alias("severity")))

    purchases, left = F.col("purchases"), F.col("adds") - F.col("purchases") - F.col("removes")
    found = F.array_compact(
        F.array(
            pattern(purchases >= rapid, "RAPID_PURCHASING", F.concat(purchases, F.lit(" purchases in window")),
                    F.when(purchases > very_rapid, "HIGH").otherwise("MEDIUM")),
            pattern(F.col("total_spent") > high_value, "HIGH_VALUE_PURCHASING",
                    F.format_string("$%.2f spent in window", "total_spent"), F.lit("HIGH")),
            pattern(F.col("unique_categories") >= switching, "CATEGORY_SWITCHING",
                    F.concat(F.col("unique_categories"), F.lit(" different categories")), F.lit("MEDIUM")),
            pattern(left > 0, "ABANDONED_CART", F.concat(left, F.lit(" items left in cart")), F.lit("LOW")),
            pattern((F.col("views") > browsing) & (purchases == 0), "PRICE_SENSITIVE_BROWSING",
                    F.concat(F.col("views"), F.lit(" views but no purchases")), F.lit("MEDIUM")),
        )
    )
    return (
        out.withColumn("patterns", found)
        .filter(F.size("patterns") > 0)
        .drop("purchases", "views", "adds", "removes")
    )


def premium_analytics(enriched: DataFrame, size: str = "5 minutes", delay: str = "30 seconds") -> DataFrame:
    """Purchases per tier; rows without a known tier count as UNKNOWN."""
    bought = enriched.filter(F.col("action") == "purchase").withColumn("user_tier", F.coalesce("user_tier", F.lit("UNKNOWN")))
    return windowed_distinct(
        bought, ["user_tier"], size, None, delay, "user_count", "user_id", total_revenue=summed("total_amount"), avg_order_value=averaged("total_amount"),
    )


def inventory_signal(df: DataFrame, size: str = "10 minutes", delay: str = "30 seconds", stock: int = 100, at_least: int = 5,
                     levels: Sequence[tuple[int, str]] = ((80, "CRITICAL"), (60, "LOW"), (40, "MEDIUM"))) -> DataFrame:
    """Products bought more than ``at_least`` times in a window, with the stock estimated to remain."""
    out = windowed(
        df.filter(F.col("action") == "purchase"), ["product_id", "category"], size, None, delay,
        purchase_count=_rows(), last_purchase_time=F.max(TS),
    ).filter(F.col("purchase_count") > at_least)
    level = F.when(F.col("purchase_count") > levels[0][0], levels[0][1])
    for threshold, name in levels[1:]:
        level = level.when(F.col("purchase_count") > threshold, name)
    return out.withColumns(
        {"estimated_remaining_stock": F.greatest(F.lit(0), stock - F.col("purchase_count")), "alert_level": level.otherwise("OK")}
    )


def cross_category(df: DataFrame, size: str = "1 hour", delay: str = "30 seconds") -> DataFrame:
    """Users who bought from several categories in a window."""
    out = windowed(
        df.filter(F.col("action") == "purchase"), ["user_id"], size, None, delay,
        categories_purchased=F.array_sort(F.collect_set("category")), total_spent=total("total_amount"),
    ).withColumn("category_count", F.size("categories_purchased"))
    return out.filter(F.col("category_count") > 1).withColumn(
        "cross_category_score", F.col("category_count") * F.col("total_spent") / 1000.0
    )


def churn_signals(df: DataFrame, delay: str = "30 seconds", high: int = 3, medium: int = 7) -> DataFrame:
    """Activity span, gap per session and engagement of every user and day, with a risk level by count."""
    out = windowed_distinct(
        df, ["user_id"], "1 day", None, delay, "sessions", "session_id",
        signal_timestamp=extreme(TS, F.max), first_event=extreme(TS, F.min), events=counted(),
    )
    seconds = F.unix_seconds("signal_timestamp") - F.unix_seconds("first_event")
    return out.select(
        "window_start", "user_id", "signal_timestamp",
        F.floor(seconds / 86400).alias("days_since_last_purchase"),
        (seconds / 3600.0 / F.greatest("sessions", F.lit(1))).alias("avg_session_gap_hours"),
        ratio("events", "sessions").alias("recent_engagement_score"),
        F.when(F.col("events") < high, "HIGH_RISK").when(F.col("events") < medium, "MEDIUM_RISK").otherwise("LOW_RISK").alias("churn_risk_level"),
    )


def window_metadata(windows: DataFrame, key: str, kind: str = "tumbling") -> DataFrame:
    """Key, duration and type of the window beside its aggregate."""
    micros = F.unix_micros("window_end") - F.unix_micros("window_start")
    return windows.withColumns(
        {"window_key": F.col(key).cast("string"), "window_duration_ms": F.floor(micros / 1000), "window_type": F.lit(kind)}
    )


def page_view_windows(df: DataFrame, size: str = "5 minutes", delay: str = "20 seconds") -> DataFrame:
    """Page views per user and window, read from the nested ``event`` struct."""
    views = df.filter(F.col("event.type") == "view").withColumn("page", F.col("event.page"))
    return windowed_distinct(views, ["user_id"], size, None, delay, "unique_pages", "page", page_views=counted())


def user_amounts(df: DataFrame, size: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    return windowed(df, ["user_id"], size, None, delay, event_count=_rows(), amount=total("total_amount"))
