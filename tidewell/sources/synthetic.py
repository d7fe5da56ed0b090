"""Seeded sample data made in the executors, for demos and tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Domains of the sample data.
CATEGORIES = ["electronics", "clothing", "books", "home", "sports"]
ACTIONS = ["view", "add_to_cart", "purchase", "remove"]
REGIONS = ["us-east", "us-west", "eu-central", "asia-pacific"]


def _pick(values: list[str], salt: int, seed: int) -> Column:
    place = F.pmod(F.xxhash64("id", F.lit(salt), F.lit(seed)), F.lit(len(values)))
    return F.element_at(F.array(*[F.lit(v) for v in values]), (place + 1).cast("int"))


def _number(low: float, high: float, salt: int, seed: int) -> Column:
    """Uniform value from a hash of the row id: the same for any partitioning."""
    unit = F.pmod(F.xxhash64("id", F.lit(salt), F.lit(seed)), F.lit(1_000_003)) / 1_000_003
    return unit * (high - low) + low


def _id(prefix: str, n: int, salt: int, seed: int) -> Column:
    return F.concat(F.lit(prefix), F.pmod(F.xxhash64("id", F.lit(salt), F.lit(seed)), F.lit(n)).cast("string"))


def _time(end: str, days: int, salt: int, seed: int) -> Column:
    return F.timestamp_seconds(F.unix_timestamp(F.lit(end).cast("timestamp")) - F.floor(_number(0, days * 86400, salt, seed)))


def synthetic_sales(spark: SparkSession, n: int, seed: int = 42, end: str = "2024-02-01") -> DataFrame:
    return spark.range(n).select(
        _id("user_", 50_000, 1, seed).alias("user_id"), _id("product_", 10_000, 2, seed).alias("product_id"),
        _pick(CATEGORIES, 3, seed).alias("category"), _pick(ACTIONS, 4, seed).alias("action"), _time(end, 7, 5, seed).alias("timestamp"),
        F.round(_number(10, 1000, 6, seed), 2).alias("price"), F.floor(_number(1, 6, 7, seed)).cast("int").alias("quantity"),
        _id("session_", 100_000, 8, seed).alias("session_id"), (_number(0, 1, 9, seed) < 0.3).alias("is_premium"),
        _pick(REGIONS, 10, seed).alias("region"),
    )


def synthetic_events(spark: SparkSession, n: int, seed: int = 42, end: str = "2024-02-01") -> DataFrame:
    return event_columns(spark.range(n), seed).withColumn("event_time", _time(end, 1, 15, seed)).drop("id")


def event_columns(df: DataFrame, seed: int = 42) -> DataFrame:
    return df.withColumns(
        {
            "event_id": F.concat(F.lit("evt_"), F.col("id").cast("string")), "user_id": _id("user_", 1000, 11, seed),
            "action": _pick(ACTIONS, 12, seed), "product_id": _id("product_", 500, 13, seed), "category": _pick(CATEGORIES, 14, seed),
            "price": F.round(_number(10, 500, 16, seed), 2), "quantity": F.floor(_number(1, 4, 17, seed)).cast("int"),
            "session_id": _id("session_", 100, 18, seed),
        }
    )


def synthetic_transactions(spark: SparkSession, n: int, seed: int = 42, end: str = "2024-02-01") -> DataFrame:
    return spark.range(n).select(
        _id("user_", 1000, 21, seed).alias("user_id"), _id("product_", 100, 22, seed).alias("product_id"),
        F.round(_number(10, 500, 23, seed), 2).alias("amount"), F.floor(_number(1, 6, 24, seed)).cast("int").alias("quantity"),
        _pick(CATEGORIES, 25, seed).alias("category"), _time(end, 30, 26, seed).alias("transaction_date"),
        _pick(["completed", "pending", "cancelled"], 27, seed).alias("status"),
    )


def rate_events(spark: SparkSession, rows_per_second: int = 10, seed: int = 42) -> DataFrame:
    """Continuous sample events."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return event_columns(rate.select(F.col("value").alias("id"), F.col("timestamp").alias("event_time")), seed).drop("id")
