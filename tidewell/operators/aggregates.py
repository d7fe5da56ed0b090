"""Grouped, multi-dimensional and two-level aggregates.

All of these use Spark's partial aggregation, so a hot group is reduced before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions import tiers
from tidewell.functions.measures import mean, ratio, spread, total
from tidewell.operators.joins import join_same
from tidewell.operators.scan import running_sum, scan, with_totals

QUANTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}
PRICE_BANDS = [("0-50", 50), ("50-100", 100), ("100-200", 200), ("200-500", 500)]


def rows() -> Column:
    return F.count(F.lit(1))


def basic_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        rows().alias("total_records"),
        total("total_amount").alias("total_revenue"),
        mean("total_amount").alias("avg_order_value"),
        F.max("total_amount").alias("max_order_value"),
        F.min("total_amount").alias("min_order_value"),
        F.count_distinct("user_id").alias("total_users"),
    )


def revenue_by_category(df: DataFrame) -> DataFrame:
    return (
        df.filter((F.col("price") > 0) & (F.col("quantity") > 0))
        .groupBy("category")
        .agg(
            rows().alias("order_count"),
            total("total_amount").alias("total_revenue"),
            mean("total_amount").alias("avg_order_value"),
            F.min("total_amount").alias("min_order_value"),
            F.max("total_amount").alias("max_order_value"),
        )
        .orderBy(F.col("total_revenue").desc())
    )


def daily_trends(df: DataFrame, last: int | None = None) -> DataFrame:
    """Per day; ``last`` keeps the most recent days."""
    daily = (
        df.groupBy(F.to_date("timestamp").alias("sale_date"))
        .agg(
            rows().alias("daily_orders"),
            total("total_amount").alias("daily_revenue"),
            F.count_distinct("user_id").alias("unique_customers"),
            mean("total_amount").alias("avg_order_value"),
        )
        .orderBy(F.col("sale_date").desc())
    )
    return daily.limit(last) if last else daily


def hourly_patterns(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return (
        df.groupBy(F.hour(ts).alias("hour"))
        .agg(rows().alias("orders"), total("total_amount").alias("revenue"))
        .orderBy("hour")
    )


def user_behavior(df: DataFrame) -> DataFrame:
    """Per user: orders, spend, sessions and the actions with their counts.

    The list of actions is kept as (action, count), which holds the same as the full list
    in a size that does not grow with a busy user.
    """
    by_action = df.groupBy("user_id", "action").agg(
        rows().alias("n"), F.sum(F.col("total_amount").cast("decimal(18,2)")).alias("spent")
    )
    totals = by_action.groupBy("user_id").agg(
        F.sum("n").alias("total_orders"),
        F.sum("spent").alias("spent"),
        F.array_sort(F.collect_list(F.struct("action", "n"))).alias("actions"),
    )
    sessions = df.groupBy("user_id").agg(F.count_distinct("session_id").alias("total_sessions"))
    return (
        join_same(totals, sessions, ["user_id"])
        .withColumns(
            {
                "total_spent": F.col("spent").cast("double"),
                "avg_order_value": F.round(F.col("spent") / F.col("total_orders"), 2),
            }
        )
        .drop("spent")
    )


def user_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("user_id").agg(
        rows().alias("total_orders"),
        total("total_amount").alias("total_spent"),
        mean("total_amount").alias("avg_order_value"),
    )


def customer_segments(df: DataFrame, steps: Sequence[tuple[float, str]] = ((1000, "Premium"), (500, "Gold"), (100, "Silver"))) -> DataFrame:
    """Users by spend (strictly above each step) and per-segment averages."""
    return (
        user_totals(df)
        .groupBy(tiers.above("total_spent", steps, "Bronze").alias("segment"))
        .agg(
            rows().alias("customer_count"),
            mean("total_spent").alias("avg_spent"),
            F.avg("total_orders").alias("avg_orders"),
        )
        .orderBy(F.col("avg_spent").desc())
    )


def customer_behavior(
    df: DataFrame,
    values: Sequence[tuple[float, str]] = tuple(tiers.VALUE_TIERS),
    counts: Sequence[tuple[float, str]] = ((10, "Frequent"), (5, "Regular")),
) -> DataFrame:
    """Tier by frequency matrix."""
    users = df.groupBy("user_id").agg(
        rows().alias("total_orders"),
        total("total_amount").alias("total_spent"),
        F.count_distinct("category").alias("categories"),
    )
    return users.groupBy(
        tiers.at_least("total_spent", values, "Low Value").alias("customer_tier"),
        tiers.at_least("total_orders", counts, "Occasional").alias("purchase_frequency"),
    ).agg(
        rows().alias("customer_count"),
        mean("total_spent").alias("avg_spending"),
        F.avg("total_orders").alias("avg_orders"),
        F.avg("categories").alias("avg_categories"),
    )


def daily_sales_agg(fact: DataFrame) -> DataFrame:
    return fact.groupBy("sale_date", "category").agg(
        rows().alias("transaction_count"),
        total("final_amount", 4).alias("total_revenue"),
        total("estimated_profit", 6).alias("total_profit"),
        mean("final_amount", 4).alias("avg_transaction_value"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )


def customer_summary(fact: DataFrame) -> DataFrame:
    """Per customer: orders, spend, profit, categories, tenure and orders per 30 days."""
    tenure = F.col("customer_tenure_days")
    return (
        fact.groupBy("customer_id")
        .agg(
            rows().alias("total_orders"),
            total("final_amount", 4).alias("total_spent"),
            total("estimated_profit", 6).alias("total_profit_generated"),
            mean("final_amount", 4).alias("avg_order_value"),
            F.max("timestamp").alias("last_order_date"),
            F.min("timestamp").alias("first_order_date"),
            F.array_sort(F.collect_set("category")).alias("purchased_categories"),
        )
        .withColumn("customer_tenure_days", F.datediff("last_order_date", "first_order_date"))
        .withColumn(
            "order_frequency",
            F.when(tenure > 0, F.try_divide(F.col("total_orders"), tenure / 30)).otherwise(
                F.col("total_orders").cast("double")
            ),
        )
    )


def business_summary(daily: DataFrame) -> DataFrame:
    """Totals of the daily table; the mean of daily means beside the true mean per transaction."""
    return daily.groupBy("category").agg(
        total("total_revenue", 4).alias("category_revenue"),
        F.sum("transaction_count").alias("category_transactions"),
        F.round(F.avg("avg_transaction_value"), 4).alias("mean_of_daily_means"),
        F.try_divide(total("total_revenue", 4), F.sum("transaction_count")).alias("avg_transaction_value"),
    )


def cohort_analysis(df: DataFrame) -> DataFrame:
    """First purchase month against month of activity."""
    monthly = df.groupBy("user_id", F.date_trunc("month", "timestamp").alias("activity_month")).agg(
        F.sum(F.col("total_amount").cast("decimal(18,2)")).alias("monthly_revenue")
    )
    # First month per user from the monthly rows, already one per user and month.
    first = monthly.groupBy("user_id").agg(F.min("activity_month").alias("cohort_month"))
    return (
        join_same(monthly, first, ["user_id"])
        .groupBy("cohort_month", "activity_month")
        .agg(
            rows().alias("active_users"),
            F.sum("monthly_revenue").cast("double").alias("cohort_revenue"),
            (F.sum("monthly_revenue").cast("double") / rows()).alias("avg_revenue_per_user"),
        )
        .orderBy("cohort_month", "activity_month")
    )


def cube_revenue(df: DataFrame, dims: Sequence[str] = ("category", "action", "is_premium")) -> DataFrame:
    """All subtotals; ``grouping_id`` tells a subtotal from a NULL value.

    The finest cells are reduced first, so the 2^n expansion multiplies cells and not input rows.
    """
    return _subtotals(df, dims, lambda cells: cells.cube(*dims))


def rollup_revenue(df: DataFrame, dims: Sequence[str] = ("category", "action", "is_premium")) -> DataFrame:
    return _subtotals(df, dims, lambda cells: cells.rollup(*dims))


def grouping_sets_revenue(df: DataFrame, dims: Sequence[str], sets: Sequence[Sequence[str]]) -> DataFrame:
    return _subtotals(
        df, dims, lambda cells: cells.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(d) for d in dims])
    )


def _subtotals(df, dims, group):
    cells = df.groupBy(*dims).agg(
        rows().alias("__n"), F.sum(F.col("total_amount").cast("decimal(18,2)")).alias("__s")
    )
    return (
        group(cells)
        .agg(
            F.grouping_id().cast("int").alias("grouping_id"),
            F.sum("__n").alias("transaction_count"),
            F.sum("__s").cast("double").alias("total_revenue"),
        )
        .withColumn("avg_transaction_value", F.try_divide("total_revenue", "transaction_count"))
        .orderBy(*[F.col(d).asc_nulls_last() for d in dims], "grouping_id")
    )


def distribution_stats(df: DataFrame, by: str, value: str, accuracy: int = 10_000) -> DataFrame:
    """Count, mean, deviation and approximate quantiles from a mergeable sketch."""
    sketch = F.percentile_approx(value, F.array(*[F.lit(q) for q in QUANTILES.values()]), accuracy)
    return (
        df.groupBy(by)
        .agg(
            rows().alias("sample_size"),
            mean(value).alias("mean_value"),
            spread(value).alias("std_deviation"),
            sketch.alias("__q"),
        )
        .select("*", *[F.col("__q")[i].alias(n) for i, n in enumerate(QUANTILES)])
        .drop("__q")
    )


def exact_quantiles(df: DataFrame, by: str, value: str, quantiles: dict[str, float] = QUANTILES) -> DataFrame:
    """Exact discrete quantiles: distinct values are counted, then a running count finds each rank.

    ``percentile_disc`` would hold a whole group in one task; here a group is one row per
    distinct value and ``scan`` splits it when that is still large.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(by, value).agg(rows().alias("__n"))
    ranked = scan(counts, [by], [value], {"__upto": running_sum("__n")})
    ranked = with_totals(ranked, [by], __all=F.sum("__n"))
    reached = [
        F.min(F.when(F.col("__upto") >= F.ceil(F.col("__all") * q), F.col(value))).alias(n) for n, q in quantiles.items()
    ]
    return ranked.groupBy(by).agg(*reached)


def text_counts(df: DataFrame) -> DataFrame:
    """Conditional counts and text lengths per category, with the set of id prefixes."""
    user = F.col("user_id").cast("string")
    return df.groupBy("category").agg(
        rows().alias("total_records"),
        F.count_if(user.rlike("^[0-9]+$")).alias("valid_user_ids"),
        F.count_if(F.length(F.col("session_id").cast("string")) > 3).alias("long_sessions"),
        F.array_sort(F.collect_set(F.substring(user, 1, 1))).alias("user_id_prefixes"),
        (F.sum(F.length(F.col("quantity").cast("string"))) / rows()).alias("avg_quantity_digits"),
    )


def category_action_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("category", "action").agg(
        rows().alias("event_count"),
        F.count_distinct("user_id").alias("unique_users"),
        F.min("total_amount").alias("min_value"),
        F.max("total_amount").alias("max_value"),
        mean("total_amount").alias("avg_value"),
        spread("total_amount").alias("std_value"),
    )


def recent_category_days(df: DataFrame, as_of: str, days: int) -> DataFrame:
    """Category by day since ``days`` before ``as_of``: a bare comparison on the time column reaches the scan."""
    since = F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp")
    return (
        df.filter(F.col("timestamp") >= since)
        .groupBy("category", F.to_date("timestamp").alias("date"))
        .agg(rows().alias("daily_orders"), total("total_amount").alias("daily_revenue"))
    )


def string_agg(df: DataFrame, by: str, column: str, sep: str = ", ", distinct: bool = False) -> DataFrame:
    """Values of a group joined in sorted order, with counts. Meant for columns of few values."""
    text = F.col(column).cast("string")
    if distinct:
        joined = F.array_join(F.array_sort(F.collect_set(text)), sep)
        return df.groupBy(by).agg(rows().alias("n"), F.count_distinct(column).alias("distinct_n"), joined.alias("joined"))
    # Equal values are counted first and repeated afterwards: the shuffle carries one row per value.
    counted = df.filter(F.col(column).isNotNull()).groupBy(by, text.alias("__v")).agg(rows().cast("int").alias("__n"))
    pieces = F.array_sort(F.collect_list(F.struct("__v", "__n")))
    repeated = F.flatten(F.transform(pieces, lambda p: F.array_repeat(p["__v"], p["__n"])))
    return counted.groupBy(by).agg(F.sum("__n").alias("n"), F.array_join(repeated, sep).alias("joined"))


def country_revenue(orders: DataFrame, users: DataFrame, status: str = "completed") -> DataFrame:
    """Revenue per country and per customer; orders are reduced per customer before the join."""
    per_user = (
        orders.filter(F.col("status") == status)
        .groupBy("user_id")
        .agg(rows().alias("n"), F.sum(F.col("amount").cast("decimal(18,2)")).alias("spent"))
    )
    return (
        per_user.join(users, "user_id")
        .groupBy("country")
        .agg(
            F.sum("n").alias("orders_count"),
            F.sum("spent").cast("double").alias("total_revenue"),
            rows().alias("unique_customers"),
        )
        .withColumns(
            {
                "avg_order_amount": F.col("total_revenue") / F.col("orders_count"),
                "revenue_per_customer": F.col("total_revenue") / F.col("unique_customers"),
            }
        )
    )


def band_counts(value: str = "total_amount", bands: Sequence[tuple[str, float]] = tuple(PRICE_BANDS)) -> dict[str, Column]:
    """Count of values per band; a band includes its upper edge."""
    low = None
    out = {}
    for name, high in bands:
        inside = F.col(value) <= high if low is None else (F.col(value) > low) & (F.col(value) <= high)
        out["band_" + name.replace("-", "_")] = F.count_if(inside)
        low = high
    out[f"band_{low:g}_up"] = F.count_if(F.col(value) > low)
    return out


def price_band_histogram(df: DataFrame, by: Sequence[str], bands: Sequence[tuple[str, float]] = tuple(PRICE_BANDS)) -> DataFrame:
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in band_counts(bands=bands).items()])


def breakdown_maps(df: DataFrame, by: Sequence[str], ts: str = "event_time") -> DataFrame:
    """Revenue by category, count by action and revenue by hour as arrays of (name, value) in order of the name, merged from one set of cells.

    Arrays, not maps, as a map holds no NULL: rows without a category, action or time have an entry of their own, at the end.
    """
    cells = df.groupBy(*by, "category", "action", F.hour(ts).alias("hour")).agg(
        rows().alias("n"), F.sum(F.col("total_amount").cast("decimal(18,2)")).alias("revenue")
    )

    def entries(name: str, value: Column) -> DataFrame:
        per = cells.groupBy(*by, name).agg(value.alias("value"))
        entry = F.struct(F.col(name).isNull().alias("none"), F.col(name).alias("name"), "value")
        ordered = F.array_sort(F.collect_list(entry))
        return per.groupBy(*by).agg(F.transform(ordered, lambda e: F.struct(e["name"].alias("name"), e["value"].alias("value"))).alias(f"by_{name}"))

    money = F.sum("revenue").cast("double")
    parts = [entries("category", money), entries("action", F.sum("n")), entries("hour", money)]
    return reduce(lambda a, b: join_same(a, b, list(by)), parts)


def extreme_orders(df: DataFrame, by: Sequence[str], order_id: str = "event_id") -> DataFrame:
    """Largest and smallest order of each group; the smaller id wins a tie."""
    who = F.struct(F.col("total_amount").alias("amount"), "user_id", "product_id", F.col(order_id).alias("id"))
    top = F.max_by(who, F.struct(F.col("total_amount"), -F.col(order_id)))
    low = F.min_by(who, F.struct(F.col("total_amount"), F.col(order_id)))
    return df.groupBy(*by).agg(top.alias("max_order"), low.alias("min_order"))


def activity_rates(df: DataFrame, by: Sequence[str], ts: str = "event_time") -> DataFrame:
    """Revenue and orders per user, covered span and events per second."""
    return (
        df.groupBy(*by)
        .agg(
            rows().alias("order_count"),
            total("total_amount").alias("total_revenue"),
            F.count_distinct("user_id").alias("unique_users"),
            F.floor((F.unix_micros(F.max(ts)) - F.unix_micros(F.min(ts))) / 1000).alias("span_ms"),
        )
        .withColumns(
            {
                "avg_order_value": ratio("total_revenue", "order_count"),
                "revenue_per_user": ratio("total_revenue", "unique_users"),
                "orders_per_user": ratio("order_count", "unique_users"),
                "events_per_second": ratio("order_count", "span_ms") * 1000,
            }
        )
    )


def event_table_stats(df: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    return df.groupBy(*by).agg(
        rows().alias("event_count"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("event_type").alias("event_types"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
    )


def table_health(df: DataFrame, keys: Sequence[str], ts: str, small_file_bytes: int = 128 * 1024 * 1024) -> DataFrame:
    """Totals, distinct keys, covered time and file sizes of a file-backed table, in one row."""
    files = (
        df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))
        .groupBy("path")
        .agg(F.first("bytes").alias("bytes"))
        .agg(
            rows().alias("file_count"),
            F.sum("bytes").alias("total_bytes"),
            F.avg("bytes").alias("avg_file_bytes"),
            F.count_if(F.col("bytes") < small_file_bytes).alias("small_files"),
        )
        .withColumn("small_file_warning", F.col("small_files") > F.col("file_count") / 2)
    )
    content = df.agg(
        rows().alias("total_rows"),
        *[F.count_distinct(k).alias(f"distinct_{k}") for k in keys],
        F.min(ts).alias("earliest"),
        F.max(ts).alias("latest"),
    )
    return content.crossJoin(files)


def approx_unique(df: DataFrame, by: str, column: str, rsd: float = 0.02) -> DataFrame:
    return df.groupBy(by).agg(F.approx_count_distinct(column, rsd).alias("approx_unique"))


def region_product_summary(sales: DataFrame) -> DataFrame:
    return sales.groupBy("region", "product_id").agg(
        rows().alias("transaction_count"),
        total("total_amount").alias("total_revenue"),
        mean("total_amount").alias("avg_revenue"),
        spread("total_amount").alias("revenue_std"),
        F.sum("quantity").alias("total_quantity"),
        F.min("timestamp").alias("first_sale"),
        F.max("timestamp").alias("last_sale"),
    )


def bucket_agg(df: DataFrame, ts: str, unit: str, by: str, value: str, k: int) -> DataFrame:
    """Time histogram with the ``k`` most frequent terms of each bucket, their share and mean value."""
    cells = df.groupBy(F.date_trunc(unit, ts).alias("bucket"), by).agg(
        rows().alias("n"), F.sum(F.col(value).cast("decimal(18,2)")).alias("s")
    )
    buckets = cells.groupBy("bucket").agg(
        F.sum("n").alias("bucket_count"), (F.sum("s").cast("double") / F.sum("n")).alias("bucket_avg")
    )
    order = Window.partitionBy("bucket").orderBy(F.col("n").desc(), by)
    top = cells.withColumn("term_rank", F.row_number().over(order)).filter(F.col("term_rank") <= k)
    return join_same(top, buckets, ["bucket"]).select(
        "bucket", "bucket_count", "bucket_avg", by, F.col("n").alias("term_count"),
        (F.col("s").cast("double") / F.col("n")).alias("term_avg"), "term_rank",
    )


def significant_terms(df: DataFrame, term: str, foreground: Column) -> DataFrame:
    """Share of a term inside the foreground against its share in all rows (ratio above 1 is significant)."""
    counts = df.groupBy(term).agg(F.count_if(foreground).alias("fg_count"), rows().alias("bg_count"))
    totals = df.agg(F.count_if(foreground).alias("fg_total"), rows().alias("bg_total"))
    fg = F.try_divide("fg_count", "fg_total")
    bg = F.try_divide("bg_count", "bg_total")
    return (
        counts.crossJoin(totals)
        .filter(F.col("fg_count") > 0)
        .select(term, "fg_count", "bg_count", F.round(F.try_divide(fg, bg), 4).alias("score"))
    )


def tier_summary(sales: DataFrame, scale: float = 1.0) -> DataFrame:
    """Spend per user, then per tier. ``scale`` divides the spend before it is classified."""
    spend = sales.groupBy("user_id").agg(total("total_amount").alias("spent"))
    return spend.groupBy(tiers.classify_tier(F.col("spent") / scale).alias("customer_tier")).agg(
        rows().alias("customer_count"),
        mean("spent").alias("avg_spending"),
        F.min("spent").alias("min_spending"),
        F.max("spent").alias("max_spending"),
    )


def price_category_performance(sales: DataFrame) -> DataFrame:
    return sales.groupBy("category", tiers.categorize_price("price").alias("price_tier")).agg(
        rows().alias("transaction_count"),
        total("total_amount").alias("total_revenue"),
        F.avg("quantity").alias("avg_quantity"),
    )


def complexity_analysis(sales: DataFrame) -> DataFrame:
    score = tiers.complexity_score("quantity", "price", "category")
    return (
        sales.groupBy("category", score.alias("complexity"))
        .agg(
            rows().alias("order_count"),
            mean("total_amount").alias("avg_order_value"),
            total("total_amount").alias("total_revenue"),
        )
        .filter(F.col("complexity") > 0)
    )


def word_count(df: DataFrame, column: str) -> DataFrame:
    words = F.explode(F.split(F.col(column), r"\s+")).alias("word")
    return df.select(words).filter(F.col("word") != "").groupBy("word").agg(rows().alias("n"))
