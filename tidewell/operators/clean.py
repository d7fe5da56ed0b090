"""Projection, filtering and cleaning of sales, customers, products and web visits."""

# The thresholds, labels and column names of the star schema are those of its result tables, here and in functions/tiers.py.
from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import tiers


def clean_sales(df: DataFrame) -> DataFrame:
    """Positive price and quantity, normalised names, derived date parts, exact duplicates removed."""
    return (
        df.filter((F.col("price") > 0) & (F.col("quantity") > 0))
        .withColumns(
            {
                "category": F.upper(F.trim("category")),
                "action": F.lower(F.trim("action")),
                "total_amount": F.round(F.col("price") * F.col("quantity"), 2),
                "date": F.date_format("timestamp", "yyyy-MM-dd"),
                "hour": F.hour("timestamp"),
            }
        )
        .dropDuplicates()
    )


def sales_fact(df: DataFrame) -> DataFrame:
    """Star-schema fact: tiered discount, margin by category, profit, customer and order ids.

    Amounts are decimals, so discounts and profits are exact.
    """
    gross = F.col("total_amount").cast("decimal(18,2)")
    return (
        df.filter((F.col("price") > 0) & (F.col("quantity") > 0))
        .withColumn("total_amount", F.round(F.col("price") * F.col("quantity"), 2))
        .withColumns(
            {
                "sale_date": F.date_format("timestamp", "yyyy-MM-dd"),
                "sale_hour": F.hour("timestamp"),
                "discount_amount": F.when(gross > 1000, gross * F.lit(Decimal("0.10")))
                .when(gross > 500, gross * F.lit(Decimal("0.05")))
                .otherwise(F.lit(Decimal("0")))
                .cast("decimal(18,4)"),
                "profit_margin": tiers.category_margin("category").cast("decimal(4,2)"),
                "customer_id": F.regexp_replace(F.col("user_id").cast("string"), "^user_", "cust_"),
                "order_id": F.concat(
                    F.lit("ORD-"),
                    F.date_format("timestamp", "yyyyMMdd"),
                    F.lit("-"),
                    F.abs(F.hash("user_id", "timestamp").cast("long")).cast("string"),
                ),
            }
        )
        .withColumn("final_amount", (gross - F.col("discount_amount")).cast("decimal(18,4)"))
        .withColumn("estimated_profit", (F.col("final_amount") * F.col("profit_margin")).cast("decimal(18,6)"))
    )


def customer_dim(df: DataFrame, as_of: str) -> DataFrame:
    """Customer dimension at the date ``as_of``."""
    today = F.lit(as_of).cast("date")
    return df.withColumns(
        {
            "full_name_clean": F.concat(
                F.upper(F.substring("full_name", 1, 1)), F.lower(F.expr("substring(full_name, 2)"))
            ),
            "email_domain": F.regexp_extract("email", "@(.+)", 1),
            "phone_clean": F.regexp_replace("phone", "[^0-9]", ""),
            "days_since_registration": F.datediff(today, "registration_date"),
            "days_since_last_login": F.datediff(today, "last_login"),
            "lifetime_value_tier": tiers.at_least(
                "lifetime_value", [(1000, "High Value"), (500, "Medium Value")], "Low Value"
            ),
        }
    ).withColumns(
        {
            "customer_age_category": tiers.below(
                "days_since_registration", [(30, "New"), (365, "Regular")], "Veteran"
            ),
            "activity_status": F.when(F.col("days_since_last_login") <= 7, "Highly Active")
            .when(F.col("days_since_last_login") <= 30, "Active")
            .when(F.col("days_since_last_login") <= 90, "Inactive")
            .otherwise("Dormant"),
        }
    )


def product_dim(df: DataFrame, as_of: str) -> DataFrame:
    """Product dimension at the date ``as_of``."""
    return df.withColumns(
        {
            "markup_percentage": F.round(
                F.try_divide(F.col("retail_price") - F.col("cost_price"), F.col("cost_price")) * 100, 2
            ),
            "price_tier": tiers.at_least("retail_price", tiers.PRICE_TIERS, "Budget"),
            "availability_status": F.when(F.col("stock_quantity") == 0, "Out of Stock").otherwise(
                tiers.below("stock_quantity", [(10, "Low Stock"), (50, "Medium Stock")], "High Stock")
            ),
            "product_age_days": F.datediff(F.lit(as_of).cast("date"), "created_date"),
            "sku_category": F.substring("sku", 1, 3),
            "weight_category": tiers.below("weight_kg", [(1, "Light"), (5, "Medium")], "Heavy"),
        }
    ).withColumn(
        "product_lifecycle",
        tiers.below("product_age_days", [(30, "New Launch"), (365, "Current"), (1095, "Mature")], "Legacy"),
    )


def web_fact(df: DataFrame) -> DataFrame:
    """Web visits: duration class, traffic source, device, first path segment, weekend flag."""
    return df.withColumns(
        {
            "session_date": F.date_format("timestamp", "yyyy-MM-dd"),
            "session_hour": F.hour("timestamp"),
            "duration_category": tiers.below(
                "duration_seconds", [(30, "Quick View"), (120, "Browse"), (300, "Engaged")], "Deep Dive"
            ),
            "traffic_source": F.when(F.col("referrer").contains("google"), "Search")
            .when(F.col("referrer").contains("facebook"), "Social")
            .when(F.col("referrer") == "direct", "Direct")
            .when(F.col("referrer") == "email", "Email")
            .otherwise("Other"),
            "device_category": F.when(F.col("device_type") == "mobile", "Mobile")
            .when(F.col("device_type") == "tablet", "Tablet")
            .otherwise("Desktop"),
            "page_category": F.regexp_extract("page_url", "/([^/]+)/", 1),
            "is_weekend": F.dayofweek("timestamp").isin(1, 7),
        }
    )


def conditional_samples(df: DataFrame, value: str) -> DataFrame:
    """The conditional forms side by side: CASE, IF, COALESCE/NULLIF, division that yields NULL on zero."""
    v = F.col(value)
    return df.withColumns(
        {
            "even_or_odd": F.when(v % 2 == 0, "Even").otherwise("Odd"),
            "size_category": F.when(v > 5, "Large").otherwise("Small"),
            "coalesced": F.coalesce(F.nullif(v, F.lit(5)), F.lit(999)),
            "safe_division": F.try_divide(F.lit(10), v - 5),
        }
    )


def predicates(df: DataFrame, as_of: str, days: int) -> DataFrame:
    """Comparison, IN, BETWEEN, LIKE, regular expression, NULL test and relative time in one filter."""
    recent = F.col("order_date") >= F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp")
    shape = F.col("status").isin("completed", "shipped") & F.col("amount").between(1000, 400000)
    text = F.col("payment_method").like("%-%") & ~F.col("payment_method").like("%LOW%")
    urgent = F.col("payment_method").rlike("^[12]-") | F.col("amount").isNull()
    return df.filter(recent & shape & text & (urgent | (F.col("amount") > 250000)))


def repeat_buyers(sales: DataFrame, k: int) -> DataFrame:
    """Rows of users with at least ``k`` rows (IN-subquery with HAVING as a left semi join)."""
    frequent = sales.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
    return sales.join(frequent, "user_id", "left_semi")


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """Inline values, for lookup lists. They came through the driver, so joins broadcast them and do not gather a table by few values."""
    return F.broadcast(spark.createDataFrame([tuple(r) for r in rows], schema))


def mask_columns(df: DataFrame, policy: Mapping[str, str]) -> DataFrame:
    """Mask personal fields: ``hash`` (SHA-256), ``partial`` (keep the last four), ``email`` (keep the domain), ``drop``."""

    def masked(name: str, how: str) -> Column:
        text = F.col(name).cast("string")
        if how == "hash":
            return F.sha2(text, 256)
        if how == "partial":
            return F.regexp_replace(text, r".(?=.{4})", "*")
        if how == "email":
            return F.regexp_replace(text, "^[^@]+", "***")
        raise ValueError(f"unknown masking rule {how!r}")

    kept = [c for c in df.columns if policy.get(c) != "drop"]
    return df.select(*[masked(c, policy[c]).alias(c) if c in policy else F.col(c) for c in kept])
