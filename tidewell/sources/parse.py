"""Parsing of JSON events. Transport and parsing are separate, so files, topics and tables share it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField(
            "metadata",
            T.StructType([T.StructField(n, T.StringType()) for n in ("source", "version", "user_agent", "ip_address")]),
        ),
    ]
)
CORRUPT = "_corrupt_record"


def parse_events(
    df: DataFrame, schema: T.StructType = EVENT_SCHEMA, value: str = "value", ts_format: str = "yyyy-MM-dd HH:mm:ss"
) -> DataFrame:
    """JSON values to columns with event time, processing time and amount; rows without a time are dropped.

    Columns of the transport (key, topic, partition, offset) are kept, its timestamp as ``kafka_timestamp``.
    """
    transport = [c for c in df.columns if c not in (value, "timestamp")]
    kept = [F.col(c).cast("string").alias(c) if c == "key" else F.col(c) for c in transport]
    if "timestamp" in df.columns:
        kept.append(F.col("timestamp").alias("kafka_timestamp"))
    parsed = df.select(F.from_json(F.col(value).cast("string"), schema).alias("data"), *kept)
    return (
        parsed.select("data.*", *[c for c in parsed.columns if c != "data"])
        .withColumns(
            {
                "processed_timestamp": F.current_timestamp(),
                "event_timestamp": F.try_to_timestamp(F.col("timestamp"), F.lit(ts_format)),
                "total_amount": F.col("price") * F.col("quantity"),
            }
        )
        .filter(F.col("event_timestamp").isNotNull())
    )


def split_malformed(df: DataFrame, schema: T.StructType = EVENT_SCHEMA, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good, dead_letter): rows that do not parse keep their text and leave by the second frame."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    text = F.col(value).cast("string")
    parsed = df.withColumn("__parsed", F.from_json(text, with_corrupt, options))
    broken = F.col("__parsed").isNull() | F.col(f"__parsed.{CORRUPT}").isNotNull()
    others = [c for c in df.columns if c != value]
    good = parsed.filter(~broken).select("__parsed.*", *others).drop(CORRUPT)
    dead = parsed.filter(broken).select(text.alias(value), *others)
    return good, dead
