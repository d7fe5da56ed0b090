"""Stateless enrichment, filtering and routing of events; the same for tables and streams."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import tiers

# Scoring lists of the additive fraud rule.
SUSPICIOUS_AMOUNTS = [999.99, 1000.00, 1111.11, 1234.56]
HIGH_RISK_CATEGORIES = ["ELECTRONICS", "JEWELRY"]


def enrich_event(df: DataFrame, value: str = "value") -> DataFrame:
    """Action category and value tier; the caller's clock stamps ``processed_at``."""
    action = F.col("action")
    return df.withColumns(
        {
            "enriched": F.lit(True),
            "action_category": F.when(action.isin("view", "search"), "browse")
            .when(action.isin("add_to_cart", "remove_from_cart"), "cart")
            .when(action == "purchase", "transaction")
            .when(action.isNotNull(), "other"),
            "value_tier": F.when(
                F.col(value).isNotNull(), tiers.below(value, [(50, "low"), (200, "medium")], "high")
            ),
        }
    )


def stamp_processed(df: DataFrame) -> DataFrame:
    return df.withColumn("processed_at", F.current_timestamp())


def filter_events(
    df: DataFrame, min_value: float = 0.0, allowed_actions: Sequence[str] = (), value: str = "value"
) -> DataFrame:
    """Keep events that reach the value and have an allowed action; a missing field passes."""
    keep = F.col(value).isNull() | (F.col(value) >= min_value)
    if allowed_actions:
        keep = keep & (F.col("action").isNull() | F.col("action").isin(*allowed_actions))
    return df.filter(keep)


def route_events(df: DataFrame, threshold: float = 100.0, value: str = "value") -> DataFrame:
    """First match of purchase, high value, view/search, anything else."""
    purchase = F.coalesce(F.col("action") == "purchase", F.lit(False))
    high = F.coalesce(F.col(value), F.lit(0.0)) > threshold
    return df.withColumns(
        {
            "priority": F.when(purchase | high, "high").otherwise("normal"),
            "route": F.when(purchase, "transactions")
            .when(high, "high_value")
            .when(F.col("action").isin("view", "search"), "analytics")
            .otherwise("general"),
        }
    )


def change_topic(df: DataFrame, topics: Mapping[str, str], table: str = "table_name", default: str = "other") -> DataFrame:
    """Topic suffix of a change record, by the table it comes from."""
    pairs = list(topics.items())
    start = F.when(F.col(table) == pairs[0][0], pairs[0][1])
    topic = reduce(lambda acc, kv: acc.when(F.col(table) == kv[0], kv[1]), pairs[1:], start)
    return df.withColumn("topic", topic.otherwise(default))


def high_value_alerts(df: DataFrame, threshold: float = 500.0) -> DataFrame:
    return df.filter(F.col("total_amount") > threshold).select(
        "event_id",
        "user_id",
        "total_amount",
        "category",
        "event_time",
        F.lit("HIGH_VALUE_TRANSACTION").alias("alert_type"),
        F.lit(threshold).alias("threshold"),
    )


def event_fraud_rules(
    df: DataFrame, high: float = 1000, medium: float = 500, electronics: float = 200, night: tuple[int, int] = (0, 6)
) -> DataFrame:
    """Score 80/60/50/30 by the first matching row rule."""
    value = F.col("price") * F.col("quantity")
    risky = (F.col("category") == "ELECTRONICS") & (value > electronics)
    at_night = (F.col("action") == "purchase") & F.hour("event_time").between(*night)
    return df.filter((value > medium) | risky | at_night).select(
        F.concat(F.lit("fraud_"), F.col("event_id")).alias("alert_id"),
        "user_id",
        "event_id",
        F.when(value > high, 80).when(value > medium, 60).when(risky, 50).otherwise(30).alias("fraud_score"),
        F.when(value > high, "HIGH_VALUE_TRANSACTION")
        .when(value > medium, "MEDIUM_VALUE_TRANSACTION")
        .otherwise("SUSPICIOUS_PATTERN")
        .alias("alert_type"),
        value.alias("event_amount"),
    )


def fraud_score_additive(
    df: DataFrame, suspicious: Sequence[float] = SUSPICIOUS_AMOUNTS, high: float = 500, emit_at: int = 30
) -> DataFrame:
    """Additive score with the list of reasons; events below ``emit_at`` are not alerts."""
    hour = F.hour("event_time")
    rules: list[tuple[str, Column, int]] = [
        ("suspicious_amount", F.col("total_amount").isin(*suspicious), 30),
        ("high_value", F.col("total_amount") > high, 20),
        ("high_risk_category", F.col("category").isin(*HIGH_RISK_CATEGORIES), 15),
        ("unusual_time", (hour < 6) | (hour >= 23), 10),
    ]
    score = reduce(lambda a, b: a + b, [F.when(c, points).otherwise(0) for _, c, points in rules])
    reasons = F.array_compact(F.array(*[F.when(c, name) for name, c, _ in rules]))
    return (
        df.withColumns({"fraud_score": score, "fraud_reasons": reasons})
        .filter(F.col("fraud_score") >= emit_at)
        .select("event_id", "user_id", "total_amount", "event_time", "fraud_score", "fraud_reasons",
                F.lit("POTENTIAL_FRAUD").alias("alert_type"))
    )


def transform_by_type(
    df: DataFrame, transformers: Mapping[str, Callable[[DataFrame], DataFrame]], type_column: str = "event_type"
) -> DataFrame:
    """Apply a transformer to the rows of its type; other rows pass unchanged.

    One scan per registered type: the filter is pushed into each, so a column-partitioned
    source reads every row once.
    """
    known = list(transformers)
    parts = [fn(df.filter(F.col(type_column) == name)) for name, fn in transformers.items()]
    rest = df.filter(F.col(type_column).isNull() | ~F.col(type_column).isin(*known))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts, rest)
