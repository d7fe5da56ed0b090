"""Point-in-time features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.measures import total
from tidewell.operators.joins import asof_join
from tidewell.operators.ordering import top_k_per
from tidewell.operators.scan import earliest, range_totals, scan
from tidewell.operators.windows import ntile


@dataclass(frozen=True)
class FeatureView:
    """A history of feature values: entity key, event time and how long a value stays valid."""

    name: str
    frame: DataFrame
    key: str
    ts: str
    ttl: str | None = None
    version: tuple[str, ...] = ()


def historical_features(entities: DataFrame, ts: str, views: Sequence[FeatureView], hot_rows: int | None = None) -> DataFrame:
    """For every entity row the values each view held at its time, NULL when expired or absent."""
    out = entities
    for view in views:
        out = asof_join(
            out, view.frame, view.key, ts, view.ts, view.version, view.ttl, prefix=f"{view.name}__", hot_rows=hot_rows
        )
        out = out.drop(f"{view.name}__{view.ts}", *[f"{view.name}__{v}" for v in view.version])
    return out


def materialize_latest(view: FeatureView, start: str, end: str) -> DataFrame:
    """Last value per entity in ``[start, end)``, for the online store."""
    rows = view.frame.filter(
        (F.col(view.ts) >= F.lit(start).cast("timestamp")) & (F.col(view.ts) < F.lit(end).cast("timestamp"))
    )
    order = [f"-{view.ts}", *[f"-{v}" for v in view.version]]
    return top_k_per(rows, [view.key], order, 1, "__first").drop("__first")


def rolling_features(
    tx: DataFrame, key: str, ts: str, row_id: str, value: str, spans: Mapping[str, int], hot_rows: int | None = None
) -> DataFrame:
    """Count and sum over each trailing span (name to seconds), the means, and days since the first row of the key."""
    micros = tx.withColumn("__at", F.unix_micros(ts))
    wanted = {}
    for name, seconds in spans.items():
        wanted[f"count_{name}"] = (F.lit(1).cast("long"), seconds * 1_000_000)
        wanted[f"sum_{name}"] = (F.col(value).cast("decimal(18,2)"), seconds * 1_000_000)
    out = range_totals(micros, [key], "__at", [row_id], wanted, hot_rows)
    out = scan(out, [key], [ts, row_id], {"__first": earliest(F.col(ts))}, hot_rows=hot_rows)
    return out.withColumns(
        {f"sum_{n}": F.col(f"sum_{n}").cast("double") for n in spans}
        | {f"avg_{n}": F.try_divide(F.col(f"sum_{n}").cast("double"), F.col(f"count_{n}")) for n in spans}
        | {"account_age_days": F.datediff(ts, "__first")}
    ).drop("__at", "__first")


def rfm(orders: DataFrame, as_of: str, key: str = "user_id", ts: str = "order_date", value: str = "amount",
        kind: str | None = None, hot_rows: int | None = None) -> DataFrame:
    """Recency, frequency, monetary value, mean order, diversity and quintile scores (5 is best)."""
    extra = [F.count_distinct(kind).alias("diversity")] if kind else []
    base = orders.groupBy(key).agg(
        F.datediff(F.lit(as_of).cast("date"), F.max(ts)).alias("recency_days"),
        F.count(F.lit(1)).alias("frequency"),
        total(value).alias("monetary"),
        *extra,
    ).withColumn("avg_order_value", F.col("monetary") / F.col("frequency"))
    base = ntile(base, [], ["-recency_days", key], 5, "r_score", hot_rows)
    base = ntile(base, [], ["frequency", key], 5, "f_score", hot_rows)
    return ntile(base, [], ["monetary", key], 5, "m_score", hot_rows)
