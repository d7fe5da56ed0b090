"""Change logs, upserts and history tables as set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.measures import total
from tidewell.operators.joins import asof_join, join_on_live
from tidewell.operators.ordering import top_k_per
from tidewell.operators.scan import lag, lead, scan


def latest_image(changes: DataFrame, keys: Sequence[str], version: Sequence[str], deleted: str | None = "is_deleted") -> DataFrame:
    """Current row per key from a change log; keys whose last change is a delete are left out."""
    last = top_k_per(changes, keys, [f"-{v}" for v in version], 1, "__first").drop("__first")
    return last.filter(~F.coalesce(F.col(deleted), F.lit(False))) if deleted else last


def state_as_of(changes: DataFrame, keys: Sequence[str], version: Sequence[str], ts: str, moment: str, deleted: str | None = "is_deleted") -> DataFrame:
    """The table as it was at ``moment``."""
    return latest_image(changes.filter(F.col(ts) <= F.lit(moment).cast("timestamp")), keys, version, deleted)


def enhanced_orders(orders: DataFrame, user_changes: DataFrame, registered: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Orders with the user version valid at the order's time; orders of deleted users drop out."""
    versions = user_changes.select("user_id", "updated_at", "version", "user_status", "user_tier", "email", "is_deleted")
    joined = asof_join(orders, versions, "user_id", "order_date", "updated_at", ["version"], hot_rows=hot_rows)
    days = F.datediff("order_date", "registration_date")
    return (
        joined.filter(~F.col("is_deleted"))
        .join(registered.select("user_id", "registration_date"), "user_id", "left")
        .withColumn("days_since_registration", days)
        .withColumn(
            "customer_segment",
            F.when(days <= 30, "NEW_CUSTOMER").when(days <= 365, "EXISTING_CUSTOMER").otherwise("LOYAL_CUSTOMER"),
        )
    )


def order_details(items: DataFrame, product_changes: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Order items with the product version valid at the item's time: profit, margin and discount class."""
    versions = product_changes.select("product_id", "updated_at", "version", "product_name", "category", "price", "cost", "is_deleted")
    joined = asof_join(items, versions, "product_id", "item_time", "updated_at", ["version"], hot_rows=hot_rows)
    profit = F.col("total_price") - F.col("cost") * F.col("quantity")
    unit, price = F.col("unit_price"), F.col("price")
    return joined.filter(~F.col("is_deleted")).withColumns(
        {
            "profit_amount": profit,
            "profit_margin_percent": F.try_divide(profit, F.col("total_price")) * 100,
            "discount_category": F.when(unit < price * 0.8, "HIGH_DISCOUNT")
            .when(unit < price * 0.9, "MEDIUM_DISCOUNT")
            .when(unit < price, "LOW_DISCOUNT")
            .otherwise("NO_DISCOUNT"),
        }
    )


def customer_analytics(users: DataFrame, orders: DataFrame, as_of: str, statuses: Sequence[str] = ("completed", "shipped", "delivered"), active_days: int = 30) -> DataFrame:
    """Orders, spend, mean value, recency and activity of every live user."""
    now = F.lit(as_of).cast("timestamp")
    last = F.col("last_order_date")
    return join_on_live(users, orders, statuses).withColumnRenamed("order_count", "total_orders").withColumns(
        {
            "avg_order_value": F.coalesce(F.try_divide("total_spent", "total_orders"), F.lit(0.0)),
            "days_since_last_order": F.coalesce(F.datediff(now, last), F.lit(999)),
            "customer_lifetime_days": F.datediff(now, "registration_date"),
            "is_active": F.coalesce(last >= now - F.make_dt_interval(F.lit(active_days)), F.lit(False)),
        }
    )


def product_analytics(products: DataFrame, details: DataFrame) -> DataFrame:
    """Sold quantity, revenue, turnover, margin and reorder flag of every live product."""
    sold = details.groupBy("product_id").agg(
        F.sum("quantity").alias("total_sold"),
        total("total_price").alias("total_revenue"),
        F.round(F.avg("unit_price"), 4).alias("avg_sale_price"),
        F.max("item_time").alias("last_sale_date"),
    )
    stock, price = F.col("inventory_count"), F.col("price")
    return products.join(sold, "product_id", "left").select(
        "product_id", "product_name", "category",
        price.alias("current_price"),
        stock.alias("current_inventory"),
        F.coalesce("total_sold", F.lit(0)).alias("total_sold"),
        F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"),
        F.coalesce("avg_sale_price", price).alias("avg_sale_price"),
        F.when(stock > 0, F.coalesce("total_sold", F.lit(0)) / stock).otherwise(0.0).alias("inventory_turnover_rate"),
        F.when(price > 0, (price - F.col("cost")) / price * 100).otherwise(0.0).alias("profit_margin"),
        "last_sale_date",
        (stock <= F.col("reorder_level")).alias("reorder_needed"),
    )


def inventory_alerts(products: DataFrame) -> DataFrame:
    """Active, live products at or near their reorder level with the quantity to order. Also for streams."""
    stock, level = F.col("inventory_count"), F.col("reorder_level")
    return products.filter((stock <= level * 1.5) & (F.col("product_status") == "ACTIVE") & ~F.col("is_deleted")).select(
        "product_id", "product_name", "category",
        F.when(stock <= 0, "OUT_OF_STOCK").when(stock <= level, "LOW_STOCK").otherwise("APPROACHING_REORDER").alias("alert_type"),
        stock.alias("current_inventory"),
        level.alias("reorder_level"),
        F.when(stock <= 0, level * 3).when(stock <= level, level * 2).otherwise(level).alias("recommended_order_quantity"),
        F.col("updated_at").alias("alert_timestamp"),
    )


def merge_upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Updates replace the target rows of their key; other updates are inserted. Keys are unique in ``updates``."""
    columns = target.columns
    kept = target.join(updates.select(*keys), list(keys), "left_anti").select(*columns)
    return kept.unionByName(updates.select(*columns))


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns where ``condition`` is true; old values feed every expression."""
    return df.select(
        *[F.when(condition, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in df.columns]
    )


def update_from(df: DataFrame, other: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Take ``columns`` from the matching row of ``other`` (unique in ``on``), NULLs included."""
    source = other.select(*on, F.struct(*columns).alias("__new"))
    joined = df.join(source, list(on), "left")
    matched = F.col("__new").isNotNull()
    return joined.select(
        *[F.when(matched, F.col("__new")[c]).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def delete_where(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, deleted); a NULL condition keeps the row."""
    hit = F.coalesce(condition, F.lit(False))
    return df.filter(~hit), df.filter(hit)


def scd2(changes: DataFrame, keys: Sequence[str], ts: str, tracked: Sequence[str], tiebreak: Sequence[str] = (), hot_rows: int | None = None) -> DataFrame:
    """Type-2 history from a change log: one row per run of equal tracked values, ``valid_to`` NULL while current."""
    state = F.struct(*tracked)
    order = [ts, *tiebreak]
    marked = scan(changes, keys, order, {"__before": lag(state), "__first": lag(F.lit(1))}, hot_rows=hot_rows)
    starts = marked.filter(F.col("__first").isNull() | ~F.col("__before").eqNullSafe(state)).drop("__before", "__first")
    return scan(starts, keys, order, {"valid_to": lead(ts)}, hot_rows=hot_rows).select(
        *keys, *tracked, F.col(ts).alias("valid_from"), "valid_to", F.col("valid_to").isNull().alias("is_current")
    )


def scd2_apply(history: DataFrame, updates: DataFrame, keys: Sequence[str], tracked: Sequence[str], ts: str) -> DataFrame:
    """Fold one new version per key into an SCD2 table: close the open row when a tracked value changed."""
    new = updates.select(*keys, F.struct(*tracked).alias("__new"), F.col(ts).alias("__at"))
    open_rows = history.filter("is_current")
    closed = history.filter(~F.col("is_current"))
    joined = open_rows.join(new, list(keys), "full_outer")
    present = F.col("valid_from").isNotNull()
    changed = F.col("__new").isNotNull() & (~present | ~F.col("__new").eqNullSafe(F.struct(*tracked)))
    old = joined.filter(present).select(
        *keys, *tracked, "valid_from",
        F.when(changed, F.col("__at")).otherwise(F.col("valid_to")).alias("valid_to"),
        (~changed).alias("is_current"),
    )
    added = joined.filter(changed).select(
        *keys, "__new.*", F.col("__at").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"), F.lit(True).alias("is_current"),
    )
    return closed.select(*old.columns).unionByName(old).unionByName(added)


def evolve(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bring rows of an older schema to ``schema``: missing columns become NULL, types widen, extra columns stay last."""
    have = set(df.columns)
    wanted = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ]
    extra = [F.col(c) for c in df.columns if c not in {f.name for f in schema.fields}]
    return df.select(*wanted, *extra)

