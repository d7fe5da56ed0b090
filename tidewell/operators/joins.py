"""Joins. Strategy is Catalyst's choice unless the operator itself is about strategy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.measures import mean, total
from tidewell.operators.scan import latest, scan


def top_customers(sales: DataFrame, users: DataFrame, k: int = 20) -> DataFrame:
    """Largest spenders with their attributes: aggregate and cut first, join ``k`` rows after."""
    spend = (
        sales.groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            total("total_amount").alias("total_spent"),
            mean("total_amount").alias("avg_order_value"),
        )
        .join(users.select("user_id"), "user_id", "left_semi")
        .orderBy(F.col("total_spent").desc(), "user_id")
        .limit(k)
    )
    return spend.join(users, "user_id").orderBy(F.col("total_spent").desc(), "user_id")


def product_performance(products: DataFrame, sales: DataFrame, k: int = 50) -> DataFrame:
    """Sales per product and markup over the list price; products without sales are left out."""
    sold = sales.groupBy("product_id").agg(
        F.count("product_id").alias("times_sold"),
        F.sum("quantity").alias("total_quantity_sold"),
        total("total_amount").alias("total_revenue"),
        F.round(F.avg("price"), 4).alias("avg_selling_price"),
    )
    base = F.col("base_price")
    return (
        products.join(sold, "product_id", "left")
        .filter(F.col("times_sold") > 0)
        .withColumn("price_markup_pct", F.round(F.try_divide(F.col("avg_selling_price") - base, base) * 100, 4))
        .orderBy(F.col("total_revenue").desc(), "product_id")
        .limit(k)
    )


def join_on_live(users: DataFrame, orders: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """All users with the orders in ``statuses``; the status test is part of the join, so users without stay."""
    live = orders.filter(F.col("status").isin(*statuses)).groupBy("user_id").agg(
        F.count("order_id").alias("order_count"),
        total("amount").alias("total_spent"),
        F.max("order_date").alias("last_order_date"),
    )
    return users.join(live, "user_id", "left").withColumns(
        {"order_count": F.coalesce("order_count", F.lit(0)), "total_spent": F.coalesce("total_spent", F.lit(0.0))}
    )


def completed_only(users: DataFrame, orders: DataFrame, status: str) -> DataFrame:
    """The WHERE form of the same question: users without such an order drop out."""
    return join_on_live(users, orders, [status]).filter(F.col("order_count") > 0)


def full_outer_reconcile(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys of both sides with a presence label."""
    a = left.withColumn("__l", F.lit(True))
    b = right.withColumn("__r", F.lit(True))
    return (
        a.join(b, list(on), "full_outer")
        .withColumn(
            "presence",
            F.when(F.col("__l").isNull(), "right_only").when(F.col("__r").isNull(), "left_only").otherwise("both"),
        )
        .drop("__l", "__r")
    )


def cross_one_row(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two one-row aggregates side by side; a side with more rows is an error, not a product."""
    def guarded(df: DataFrame) -> DataFrame:
        many = F.assert_true(F.count(F.lit(1)).over(Window.partitionBy()) <= 1, "cross_one_row takes sides of one row")
        return df.withColumn("__checked", many).filter(F.col("__checked").isNull()).drop("__checked")

    return guarded(left).crossJoin(F.broadcast(guarded(right)))


def broadcast_join(fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "inner", force: bool = False) -> DataFrame:
    """Join with a small side. The optimiser broadcasts ``dim`` by its bytes, at run time too; ``force`` is for a caller who knows its bound."""
    return fact.join(F.broadcast(dim) if force else dim, list(on), how)


def join_same(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL equals NULL; the left side's keys are kept."""
    renamed = right.withColumnsRenamed({c: f"__same_{c}" for c in on})
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"__same_{c}"))
    return left.join(renamed, same, how).drop(*[f"__same_{c}" for c in on])


def semi(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys, list(on), "left_semi")


def anti(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys, list(on), "left_anti")


def asof_join(
    events: DataFrame,
    versions: DataFrame,
    key: str,
    ts: str,
    version_ts: str,
    version_order: Sequence[str] = (),
    tolerance: str | None = None,
    prefix: str = "",
    hot_rows: int | None = None,
) -> DataFrame:
    """Each event with the latest version of its key at or before the event's time.

    Events and versions are merged into one ordered stream per key and the last version is
    carried forward, so one shuffle serves both sides and a huge key is split by ``scan``.
    ``tolerance`` (an interval such as ``"30 days"``) drops versions that are too old.
    """
    values = [c for c in versions.columns if c != key]
    left = events.select(
        F.col(key),
        F.col(ts).alias("__ts"),
        F.lit(1).alias("__side"),
        *[F.lit(None).cast(versions.schema[c].dataType).alias(f"__o_{c}") for c in version_order],
        F.lit(None).cast(versions.select(F.struct(*values).alias("v")).schema["v"].dataType).alias("__version"),
        F.struct(*events.columns).alias("__event"),
    )
    right = versions.filter(F.col(key).isNotNull() & F.col(version_ts).isNotNull()).select(
        F.col(key),
        F.col(version_ts).alias("__ts"),
        F.lit(0).alias("__side"),
        *[F.col(c).alias(f"__o_{c}") for c in version_order],
        F.struct(*values).alias("__version"),
        F.lit(None).cast(left.schema["__event"].dataType).alias("__event"),
    )
    order = ["__ts", "__side", *[f"__o_{c}" for c in version_order]]
    found = scan(left.unionByName(right), [key], order, {"__found": latest("__version")}, hot_rows=hot_rows)
    found = found.filter(F.col("__side") == 1)
    match = F.col("__found")
    valid = F.col("__ts").isNotNull()
    if tolerance:
        valid = valid & (F.col("__ts") - F.expr(f"INTERVAL {tolerance}") <= match[version_ts])
    return found.select(
        "__event.*", *[F.when(valid, match[c]).alias(f"{prefix}{c}") for c in values]
    )


def join_aggregate(dim: DataFrame, fact: DataFrame, key: str, **aggregates: Column) -> DataFrame:
    """Dimension rows with aggregates of their facts; NULL where there are none."""
    return dim.join(fact.groupBy(key).agg(*[a.alias(n) for n, a in aggregates.items()]), key, "left")


def link_lookup(nodes: DataFrame, links: DataFrame, key: str, source: str, target: str, name: str) -> DataFrame:
    """Names of both ends of every link."""
    first = nodes.select(F.col(key).alias(source), F.col(name).alias(f"{source}_name"))
    second = nodes.select(F.col(key).alias(target), F.col(name).alias(f"{target}_name"))
    return links.join(first, source).join(second, target)


def federated_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join frames from different readers; each source receives its own pushed-down filters."""
    return left.join(right, list(on), how)


def interval_join(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, lower: int, upper: int, how: str = "inner", delay: str = "20 seconds",
) -> DataFrame:
    """Pairs with ``right_ts`` in ``[left_ts + lower, left_ts + upper]`` seconds; ``how`` is ``inner`` or ``left``.

    The columns of both sides come one after another; the sides share no name but the key, which comes once per side.

    On streams both sides get a watermark of ``delay``, and the interval lets Spark drop a row once no partner can come any more; with ``left``
    a row without a partner comes out at that time.

    On tables the time axis is also cut into cells of the interval's width, so that a hot
    key is joined cell by cell and not every row with every row.
    """
    a, b = left.alias("a"), right.alias("b")
    bound = F.expr(
        f"b.{right_ts} BETWEEN a.{left_ts} + INTERVAL '{lower}' SECOND AND a.{left_ts} + INTERVAL '{upper}' SECOND"
    )
    equal = F.col(f"a.{key}") == F.col(f"b.{key}")
    columns = [*[F.col(f"a.{c}") for c in left.columns], *[F.col(f"b.{c}") for c in right.columns]]
    if left.isStreaming or right.isStreaming:
        marked = left.withWatermark(left_ts, delay).alias("a").join(right.withWatermark(right_ts, delay).alias("b"), equal & bound, how)
        return marked.select(*columns)
    width = max(upper - lower, 1)
    seconds = F.unix_seconds(left_ts)
    cells = F.sequence(F.floor((seconds + lower) / width), F.floor((seconds + upper + 1) / width))
    a = left.withColumn("__cell", F.explode(cells)).alias("a")
    b = right.withColumn("__cell", F.floor(F.unix_seconds(right_ts) / width)).alias("b")
    same_cell = F.col("a.__cell") == F.col("b.__cell")
    pairs = a.join(b, equal & same_cell & bound).select(*columns)
    if how == "inner":
        return pairs
    # A row lies in several cells, so rows without any partner are found apart from the pairs.
    row, other = left.columns, [f.dataType for f in right.schema]
    met = left.withColumns({"__cell": F.explode_outer(cells), "__row": F.struct(*row)}).alias("a").join(b, equal & same_cell & bound, "left_semi").select("__row").distinct()
    alone = left.withColumn("__row", F.struct(*row)).join(met, "__row", "left_anti").select(*row, *[F.lit(None).cast(t).alias(c) for c, t in zip(right.columns, other, strict=True)])
    return pairs.union(alone)


def enrich_static(stream: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Stream rows with attributes of a static table; unmatched rows stay."""
    return stream.join(dim, list(on), "left")


def salted_agg(df: DataFrame, keys: Sequence[str], partial: dict[str, Column], final: dict[str, Column], salts: int = 32, row_id: Sequence[str] = ()) -> DataFrame:
    """Two-phase aggregation over (keys, salt) and then keys, for aggregates without map-side combine.

    The salt is a hash of ``row_id``, columns that tell rows apart, and so the same after every retry. Without them it is a hash of the whole
    row, and copies of one row share a salt.
    """
    columns = list(row_id) or df.columns
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(salts)))
    first = salted.groupBy(*keys, "__salt").agg(*[c.alias(n) for n, c in partial.items()])
    return first.groupBy(*keys).agg(*[c.alias(n) for n, c in final.items()])
