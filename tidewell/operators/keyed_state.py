"""Table twins of the keyed state jobs: the same results from running values in event order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.measures import ratio, total
from tidewell.functions.tiers import LOYALTY_TIERS, TIER_BENEFITS, loyalty_tier
from tidewell.operators.joins import join_same
from tidewell.operators.ordering import last_n_per
from tidewell.operators.scan import earliest, lag, range_totals, row_number, running_count, running_max, running_sum, scan

TS = "event_time"
ORDER = [TS, "event_id"]


def _money(column: Column) -> Column:
    return column.cast("decimal(18,2)")


def _spent() -> Column:
    return F.when(F.col("action") == "purchase", _money(F.col("total_amount"))).otherwise(F.lit(0).cast("decimal(18,2)"))


def user_profile(events: DataFrame, keep: int = 10) -> DataFrame:
    """Per user: logins, spend, views per category and the last ``keep`` purchases. Views without a category are in no preference."""
    base = events.groupBy("user_id").agg(
        F.count_if(F.col("action") == "login").alias("session_count"),
        F.sum(_spent()).cast("double").alias("total_spent"),
        F.max(TS).alias("last_activity"),
    )
    views = events.filter("action = 'view' AND category IS NOT NULL").groupBy("user_id", "category").agg(F.count(F.lit(1)).alias("n"))
    views = views.groupBy("user_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "n")))).alias("preferences")
    )
    recent = last_n_per(events.filter("action = 'purchase'"), "user_id", ORDER, keep)
    recent = recent.groupBy("user_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("recency", "product_id", "category", "total_amount", TS))),
            lambda r: F.struct(r["product_id"].alias("product_id"), r["total_amount"].alias("amount")),
        ).alias("recent_purchases")
    )
    return join_same(join_same(base, views, ["user_id"], "left"), recent, ["user_id"], "left").withColumn("tier", loyalty_tier("total_spent"))


def tier_activations(events: DataFrame, steps: Sequence[tuple[float, str]] = tuple(LOYALTY_TIERS), hot_rows: int | None = None) -> DataFrame:
    """One row per tier upgrade, active 24 hours later; a tier once reached is kept."""
    buys = events.filter("action = 'purchase'")
    ranks = sorted(steps)
    spent = scan(buys, ["user_id"], ORDER, {"running": running_sum(_money(F.col("total_amount")))}, hot_rows=hot_rows)
    level = F.lit(0)
    for i, (threshold, _) in enumerate(ranks, start=1):
        level = F.when(F.col("running") >= threshold, i).otherwise(level)
    spent = spent.withColumn("level", level)
    out = scan(spent, ["user_id"], ORDER, {"best": running_max("level")}, {"before": lag("best", 1, 0)}, hot_rows=hot_rows)
    names = F.create_map(*[x for i, (_, n) in enumerate(ranks, start=1) for x in (F.lit(i), F.lit(n))])
    benefits = F.create_map(*[x for n, b in TIER_BENEFITS.items() for x in (F.lit(n), F.array(*[F.lit(v) for v in b]))])
    upgraded = out.filter(F.col("best") > F.col("before")).withColumn("new_tier", names[F.col("best")])
    return upgraded.select(
        "user_id", "new_tier", F.col("running").cast("double").alias("total_spent"),
        (F.col(TS) + F.expr("INTERVAL 24 HOURS")).alias("activation_time"),
        F.try_element_at(benefits, F.col("new_tier")).alias("benefits"),
    )


def product_popularity(events: DataFrame, hours: int = 24, hot_rows: int | None = None) -> DataFrame:
    """Per product and hour: views, purchases, revenue, users and active hours of the last ``hours``, and the score.

    Hourly cells are built first. Users of the trailing period are counted once each: a
    user's hour counts unless the same user was active earlier in the period.
    """
    stamp = F.floor(F.unix_seconds(TS) / 3600).alias("hour_no")
    views, buys = F.col("action") == "view", F.col("action") == "purchase"
    cells = events.groupBy("product_id", stamp).agg(
        F.count_if(views).alias("v"), F.count_if(buys).alias("p"), F.sum(_spent()).alias("r")
    )
    active = F.when((F.col("v") > 0) | (F.col("p") > 0), 1).otherwise(0).cast("long")
    rolled = range_totals(
        cells, ["product_id"], "hour_no", [],
        {"total_views": (F.col("v"), hours), "total_purchases": (F.col("p"), hours), "total_revenue": (F.col("r"), hours),
         "hours_with_activity": (active, hours)},
        hot_rows,
    )
    seen = events.select("product_id", "user_id", stamp).distinct()
    # A user's hour covers cells from its hour until the period ends or the user's next hour begins.
    spans = scan(seen, ["product_id", "user_id"], ["-hour_no"], {"next_hour": lag("hour_no")}, hot_rows=hot_rows)
    until = F.least(F.coalesce("next_hour", F.col("hour_no") + hours + 1), F.col("hour_no") + hours + 1)
    steps = spans.select(
        "product_id",
        F.explode(F.array(F.struct(F.col("hour_no").alias("h"), F.lit(1).alias("d")), F.struct(until.alias("h"), F.lit(-1).alias("d")))).alias("s"),
    ).select("product_id", F.col("s.h").alias("hour_no"), F.col("s.d").cast("long").alias("delta"))
    change = steps.groupBy("product_id", "hour_no").agg(F.sum("delta").alias("delta"))
    users = scan(change, ["product_id"], ["hour_no"], {"unique_users": running_sum("delta")}, hot_rows=hot_rows).drop("delta")
    out = rolled.join(users, ["product_id", "hour_no"])
    n = F.col("unique_users")
    return out.select(
        "product_id", F.timestamp_seconds(F.col("hour_no") * 3600).alias("hour"), "total_views", "total_purchases",
        F.col("total_revenue").cast("double").alias("total_revenue"), n, "hours_with_activity",
        ratio("total_purchases", "total_views").alias("conversion_rate"),
        (F.col("total_views") + F.col("total_purchases") * 5 + n * 3 + F.col("hours_with_activity") * 2).alias("popularity_score"),
    )


def online_features(events: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Running user, product and session features at every event.

    First sightings (of a category by a user, a user by a product, and so on) are flagged per
    pair, so the distinct counts become running sums.
    """
    def first(keys, name, df):
        return scan(df, keys, ORDER, {f"__{name}": row_number()}, hot_rows=hot_rows).withColumn(
            name, F.when(F.col(f"__{name}") == 1, 1).otherwise(0).cast("long")
        ).drop(f"__{name}")

    df = first(["user_id", "category"], "new_category", events)
    df = first(["product_id", "user_id"], "new_viewer", df)
    df = first(["session_id", "category"], "new_in_session", df)
    view = F.when(F.col("action") == "view", 1).otherwise(0).cast("long")
    buy = F.when(F.col("action") == "purchase", 1).otherwise(0).cast("long")
    df = scan(
        df, ["user_id"], ORDER,
        {"user_events": running_count(), "user_spent": running_sum(_spent()), "user_categories": running_sum("new_category"),
         "__last": lag(F.unix_micros(TS))}, hot_rows=hot_rows,
    )
    df = scan(
        df, ["product_id"], ORDER,
        {"product_views": running_sum(view), "product_purchases": running_sum(buy), "product_viewers": running_sum("new_viewer"),
         "product_revenue": running_sum(_spent())}, hot_rows=hot_rows,
    )
    df = scan(
        df, ["session_id"], ORDER,
        {"session_events": running_count(), "session_spent": running_sum(_spent()), "session_categories": running_sum("new_in_session"),
         "__start": earliest(F.unix_micros(TS)), "session_purchases": running_sum(buy)}, hot_rows=hot_rows,
    )
    spent = [c for c in ("user_spent", "product_revenue", "session_spent")]
    return df.withColumns(
        {c: F.col(c).cast("double") for c in spent}
        | {
            "since_last_activity_ms": F.coalesce(F.floor((F.unix_micros(TS) - F.col("__last")) / 1000), F.lit(0)),
            "is_frequent_user": F.col("user_events") > 10,
            "is_high_value_user": F.col("user_spent") > 1000,
            "product_conversion": ratio("product_purchases", "product_views"),
            "is_popular": F.col("product_views") > 50,
            "session_duration_ms": F.floor((F.unix_micros(TS) - F.col("__start")) / 1000),
            "has_purchase": F.col("session_purchases") > 0,
            "hour_of_day": F.hour(TS),
        }
    ).drop("__last", "__start", "new_category", "new_viewer", "new_in_session", "session_purchases")


def user_behavior_state(events: DataFrame, silver: float = 500, gold: float = 2000, hot_rows: int | None = None) -> DataFrame:
    """Events so far, spend so far and tier of the user at every event."""
    out = scan(events, ["user_id"], ORDER, {"total_events": running_count(), "spent": running_sum(_spent())}, hot_rows=hot_rows)
    tier = F.when(F.col("spent") >= gold, "GOLD").when(F.col("spent") >= silver, "SILVER").otherwise("BRONZE")
    return out.select("event_id", "user_id", TS, "total_events", F.col("spent").cast("double").alias("total_spent"), tier.alias("user_tier"))


def fraud_state(
    events: DataFrame, floor: float = 500, high: float = 1000, volume: float = 2000, reset_seconds: int = 3600, rapid_seconds: int = 60,
    emit_at: int = 40, hot_rows: int | None = None,
) -> DataFrame:
    """Alerts on amounts above ``floor``: large amount 50, spend since the last long pause 30, rapid repeat 40."""
    kept = events.filter(F.col("total_amount") > floor).withColumn("__at", F.unix_micros(TS))
    pause = F.col("__at") - F.col("__before")
    starts = F.coalesce(pause > reset_seconds * 1_000_000, F.lit(True))
    amount = _money(F.col("total_amount"))
    # Spend since the last reset is the running sum minus its value before the reset row;
    # it only grows, so a running maximum carries that value.
    out = scan(
        kept, ["user_id"], ORDER,
        {"__before": lag("__at")},
        {"__sum": running_sum(amount)},
        {"__base": running_max(F.when(starts, F.col("__sum") - amount))},
        hot_rows=hot_rows,
    )
    spending = F.col("__sum") - F.col("__base")
    big, busy = F.col("total_amount") > high, spending > volume
    rapid = F.coalesce(pause < rapid_seconds * 1_000_000, F.lit(False))
    score = F.when(big, 50).otherwise(0) + F.when(busy, 30).otherwise(0) + F.when(rapid, 40).otherwise(0)
    return out.select(
        "event_id", "user_id", TS, F.col("total_amount").alias("amount"), spending.cast("double").alias("recent_spending"),
        score.alias("fraud_score"),
        F.when(rapid, "RAPID_TRANSACTIONS").when(busy, "HIGH_VOLUME").when(big, "HIGH_VALUE").otherwise("SUSPICIOUS").alias("alert_type"),
    ).filter(F.col("fraud_score") >= emit_at)


def type_counters(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type", F.to_date(TS).alias("day"), F.hour(TS).alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), total("total_amount").alias("amount")
    )


def recent_activity(events: DataFrame, n: int = 100) -> DataFrame:
    return last_n_per(events.select("user_id", "event_id", "action", TS), "user_id", ORDER, n)
