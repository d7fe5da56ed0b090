"""Window analytics. Everything ordered inside a group goes through ``scan``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions import tiers
from tidewell.functions.measures import mean, total
from tidewell.operators.gaps import every_step
from tidewell.operators.scan import (
    lag, lead, moving, rank, ranks, row_number, running_count, running_sum, scan, with_totals,
)


def purchase_sequence(sales: DataFrame, tiebreak: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """Order number per user, previous and next amount, first-purchase flag, growth in percent."""
    out = scan(
        sales, ["user_id"], ["timestamp", *tiebreak],
        {
            "user_order_number": row_number(),
            "previous_purchase": lag("total_amount"),
            "next_purchase": lead("total_amount"),
        },
        hot_rows=hot_rows,
    )
    before = F.col("previous_purchase")
    return out.withColumns(
        {
            "is_first_purchase": F.col("user_order_number") == 1,
            "purchase_growth": F.when(
                before.isNotNull(), F.round(F.try_divide(F.col("total_amount") - before, before) * 100, 2)
            ).otherwise(0.0),
        }
    )


def ranked_orders(sales: DataFrame, tiebreak: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """Rank by amount inside the category and dense rank inside the day."""
    ranked = ranks(sales, ["-total_amount", *tiebreak], {"daily_rank": (["date"], True), "category_rank": (["category"], False)}, hot_rows)
    return ranked.select(*sales.columns, "category_rank", "daily_rank")


def running_total(sales: DataFrame, min_orders: int, tiebreak: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """Running spend, order sequence and neighbours for users with at least ``min_orders`` rows."""
    frequent = sales.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_orders)
    kept = sales.join(frequent, "user_id", "left_semi")
    out = scan(
        kept, ["user_id"], ["timestamp", *tiebreak],
        {
            "running_total": running_sum(F.col("total_amount").cast("decimal(18,2)")),
            "order_sequence": row_number(),
            "previous_order_value": lag("total_amount"),
            "next_order_value": lead("total_amount"),
        },
        hot_rows=hot_rows,
    )
    return out.withColumn("running_total", F.col("running_total").cast("double"))


def moving_avg(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, k: int, name: str = "moving_avg",
               bounded: bool = False, hot_rows: int | None = None) -> DataFrame:
    """Mean of the last ``k`` rows including the current one."""
    parts = scan(
        df, by, order,
        {
            "__sum": moving(F.sum, F.col(value).cast("decimal(18,2)"), k),
            "__n": moving(F.count, F.col(value), k),
        },
        bounded=bounded, hot_rows=hot_rows,
    )
    return parts.withColumn(name, F.try_divide(F.col("__sum").cast("double"), F.col("__n"))).drop("__sum", "__n")


def cumulative_clv(events: DataFrame, bucket: str = "1 hour", recent: int = 5) -> DataFrame:
    """Per user and time bucket: cumulative value, buckets so far and the mean of the recent ones."""
    hourly = (
        events.filter("action = 'purchase'")
        .groupBy("user_id", F.window("event_time", bucket).start.alias("window_start"))
        .agg(F.sum(F.col("total_amount").cast("decimal(18,2)")).alias("bucket_amount"))
    )
    out = scan(
        hourly, ["user_id"], ["window_start"],
        {
            "cumulative_clv": running_sum("bucket_amount"),
            "total_transactions": running_count(),
            "__s": moving(F.sum, F.col("bucket_amount"), recent),
            "__n": moving(F.count, F.col("bucket_amount"), recent),
        },
    )
    return out.select(
        "user_id", "window_start", F.col("bucket_amount").cast("double"),
        F.col("cumulative_clv").cast("double"), "total_transactions",
        (F.col("__s").cast("double") / F.col("__n")).alias("recent_avg_order_value"),
    )


def share_of_partition(df: DataFrame, by: str, value: str, k: int, tiebreak: Sequence[str]) -> DataFrame:
    """Top ``k`` rows per group with the group total and the share in percent.

    The top rows are cut before the join, so only groups times ``k`` rows meet the totals.
    """
    order = Window.partitionBy(by).orderBy(F.col(value).desc(), *tiebreak)
    top = df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    totals = df.groupBy(F.col(by).alias("__by")).agg(total(value).alias("partition_total"))
    return top.join(totals, F.col(by).eqNullSafe(F.col("__by"))).drop("__by").withColumn(
        "share_pct", F.try_divide(F.col(value), F.col("partition_total")) * 100
    )


def daily_trend(orders: DataFrame, status: str = "completed") -> DataFrame:
    """Day by day: orders, revenue, users, direction against the day before and 3-day mean."""
    daily = (
        orders.filter(F.col("status") == status)
        .groupBy(F.to_date("order_date").alias("order_date"))
        .agg(
            F.count(F.lit(1)).alias("daily_orders"),
            total("amount").alias("daily_revenue"),
            mean("amount").alias("avg_order_value"),
            F.count_distinct("user_id").alias("unique_customers"),
        )
    )
    # One row per calendar day, so a single ordered group is small.
    out = scan(daily, [], ["order_date"], {"prev_day_revenue": lag("daily_revenue")}, bounded=True)
    out = moving_avg(out, [], ["order_date"], "daily_revenue", 3, "three_day_avg", bounded=True)
    before, now = F.col("prev_day_revenue"), F.col("daily_revenue")
    return out.withColumn(
        "revenue_trend",
        F.when(before.isNull(), "N/A").when(now > before, "Up").when(now < before, "Down").otherwise("Same"),
    )


def ntile(df: DataFrame, keys: Sequence[str], order: Sequence[str], buckets: int, name: str,
          hot_rows: int | None = None) -> DataFrame:
    """NTILE from a row number and the group size, which also works when one group is everything."""
    numbered = with_totals(scan(df, keys, order, {"__rn": row_number()}, hot_rows=hot_rows), keys, __n=F.count(F.lit(1)))
    size = F.floor(F.col("__n") / buckets)
    larger = F.col("__n") % buckets
    edge = larger * (size + 1)
    in_large = F.floor((F.col("__rn") - 1) / (size + 1)) + 1
    in_small = larger + F.floor((F.col("__rn") - 1 - edge) / F.greatest(size, F.lit(1))) + 1
    return numbered.withColumn(name, F.when(F.col("__rn") <= edge, in_large).otherwise(in_small).cast("int")).drop(
        "__rn", "__n"
    )


def terciles(customers: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Spend and frequency terciles and lifecycle stage; the id breaks ties."""
    out = ntile(customers, [], ["-total_spent", "user_id"], 3, "spending_tercile", hot_rows)
    out = ntile(out, [], ["-total_orders", "user_id"], 3, "frequency_tercile", hot_rows)
    days = F.col("customer_lifetime_days")

    def label(column: str, noun: str) -> Column:
        names = {1: f"High {noun}", 2: f"Medium {noun}"}
        return F.when(F.col(column) == 1, names[1]).when(F.col(column) == 2, names[2]).otherwise(f"Low {noun}")

    return out.withColumns(
        {
            "spending_segment": label("spending_tercile", "Spender"),
            "frequency_segment": label("frequency_tercile", "Frequency"),
            "lifecycle_stage": F.when(days == 0, "Single Purchase")
            .when(days <= 7, "New Customer")
            .when(days <= 30, "Regular Customer")
            .otherwise("Loyal Customer"),
        }
    )


def spending_rank(sales: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Users ranked by spend with their value tier."""
    users = sales.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        total("total_amount").alias("total_spent"),
        mean("total_amount").alias("avg_order_value"),
    )
    return scan(users, [], ["-total_spent", "user_id"], {"spending_rank": row_number()}, hot_rows=hot_rows).withColumn(
        "customer_tier", tiers.at_least("total_spent", tiers.VALUE_TIERS, "Low Value")
    )


def peak_hours(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Hours of the day ranked by revenue."""
    hours = df.groupBy(F.hour(ts).alias("hour")).agg(
        F.count(F.lit(1)).alias("total_transactions"), total("total_amount").alias("total_revenue")
    )
    # At most 24 rows.
    return scan(hours, [], ["-total_revenue", "hour"], {"revenue_rank": rank("-total_revenue")}, bounded=True)


def change_events(
    changes: DataFrame,
    key: str,
    version: Sequence[str],
    tracked: Mapping[str, str],
    amount: str | None = None,
    jump: float = 1000,
    hot_rows: int | None = None,
) -> DataFrame:
    """What changed between consecutive versions of a row.

    ``tracked`` maps a column to the event type of its change, in order of priority; then a
    rise of ``amount`` by more than ``jump`` counts as a high-value purchase.
    """
    columns = [*tracked, *([amount] if amount else [])]
    out = scan(changes, [key], version, {"previous_state": lag(F.struct(*columns))}, hot_rows=hot_rows)
    previous = F.col("previous_state")
    kind, reason = None, None
    for column, event_type in tracked.items():
        changed = F.col(column) != previous[column]
        noun = event_type.split("_")[0].capitalize()
        text = F.concat(F.lit(f"{noun} changed from "), previous[column], F.lit(" to "), F.col(column))
        kind = (F if kind is None else kind).when(changed, event_type)
        reason = (F if reason is None else reason).when(changed, text)
    if amount:
        rise = F.col(amount) - F.coalesce(previous[amount], F.lit(0.0)) > jump
        kind = kind.when(rise, "HIGH_VALUE_PURCHASE")
        reason = reason.when(rise, "High value purchase detected")
    return out.withColumns(
        {"event_type": kind.otherwise("UPDATE"), "change_reason": reason.otherwise("Regular update")}
    )


def position_stats(df: DataFrame, by: Sequence[str], order: str, tiebreak: Sequence[str], nth: int = 2,
                   hot_rows: int | None = None) -> DataFrame:
    """percent_rank, cume_dist, first, last and n-th value of ``order`` inside each group."""
    out = scan(df, by, [order, *tiebreak], {"__rn": row_number(), "__rank": rank(order)}, hot_rows=hot_rows)
    sort = F.col(order)
    out = with_totals(
        out, by, __n=F.count(F.lit(1)), first_value=F.min(sort), last_value=F.max(sort),
        nth_value=F.max(F.when(F.col("__rn") == nth, sort)),
    )
    peers = df.groupBy(*[F.col(c).alias(f"__p{k}") for k, c in enumerate([*by, order])]).agg(F.count(F.lit(1)).alias("__peers"))
    same = F.lit(True)
    for k, c in enumerate([*by, order]):
        same = same & F.col(c).eqNullSafe(F.col(f"__p{k}"))
    out = out.join(peers, same).drop(*[f"__p{k}" for k in range(len(by) + 1)])
    return out.withColumns(
        {
            "percent_rank": F.when(F.col("__n") > 1, (F.col("__rank") - 1) / (F.col("__n") - 1)).otherwise(0.0),
            "cume_dist": (F.col("__rank") - 1 + F.col("__peers")) / F.col("__n"),
        }
    ).drop("__rn", "__rank", "__n", "__peers")


def daily_growth(sales: DataFrame, by: Sequence[str], unit: str = "day") -> DataFrame:
    """Resample to one row per period and group, empty periods included, with growth on the one before."""
    cells = sales.groupBy(*by, F.date_trunc(unit, "timestamp").alias("period")).agg(
        total("total_amount").alias("revenue_sum"),
        F.count(F.lit(1)).alias("revenue_count"),
        F.sum("quantity").alias("quantity_sum"),
    )
    filled = every_step(cells, by, "period", f"1 {unit}")
    empty = {"revenue_sum": F.lit(0.0), "revenue_count": F.lit(0).cast("long"), "quantity_sum": F.lit(0).cast("long")}
    filled = filled.withColumns({n: F.when(F.col("is_step"), zero).otherwise(F.coalesce(n, zero)) for n, zero in empty.items()}).drop("is_step")
    # One row per period and group.
    out = scan(filled, by, ["period"], {"__before": lag("revenue_sum")}, bounded=True)
    return out.withColumn(
        "revenue_growth", F.round(F.try_divide(F.col("revenue_sum") - F.col("__before"), F.col("__before")), 4)
    ).drop("__before")
