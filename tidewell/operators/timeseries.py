"""Market and sensor series, transaction rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.tiers import distance_km
from tidewell.operators.aggregates import exact_quantiles
from tidewell.operators.gaps import every_step
from tidewell.operators.scan import lag, latest, moving, range_totals, row_number, running_sum, scan

CHUNK = 64


def _decayed(ends: DataFrame, key: str, fades: dict[str, float]) -> DataFrame:
    """(key, __chunk, __sum): ``sum_k = end_k + f * sum_(k-1)`` over consecutive chunks of (key, __chunk, __end), for every fade ``f``.

    Chunks are taken ``CHUNK`` at a time; the ends of those groups are summed the same way, one level up with ``f ** CHUNK``. Levels stop
    when that fade is zero as a double, which depends on the span alone: all history counts, however long.
    """
    group, place = F.floor(F.col("__chunk") / CHUNK), F.col("__chunk") % CHUNK
    items = ends.groupBy(F.col(key), group.alias("__group")).agg(F.array_sort(F.collect_list(F.struct(place.alias("place"), F.col("__end").alias("end")))).alias("__items"))

    def upto(i: Column) -> Column:
        taken = F.slice("__items", 1, i)
        return F.struct(*[F.aggregate(taken, F.lit(0.0), _fold(n, f)).alias(n) for n, f in fades.items()])

    def _fold(name: str, f: float):
        return lambda total, item: total * f + item["end"][name]

    sums = items.select(F.col(key), "__group", F.transform(F.sequence(F.lit(1), F.size("__items")), upto).alias("__sums"))
    inside = sums.select(F.col(key), "__group", F.posexplode("__sums").alias("__i", "__local"))
    upper = {n: f**CHUNK for n, f in fades.items()}
    chunk = (F.col("__group") * CHUNK + F.col("__i")).alias("__chunk")
    if not any(upper.values()):
        return inside.select(F.col(key), chunk, F.col("__local").alias("__sum"))
    above = _decayed(sums.select(F.col(key), F.col("__group").alias("__chunk"), F.element_at("__sums", -1).alias("__end")), key, upper)
    before = above.select(F.col(key).alias("__key"), (F.col("__chunk") + 1).alias("__of"), F.col("__sum").alias("__above"))
    joined = inside.join(before, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__group") == F.col("__of")), "left")
    whole = F.struct(*[(F.col(f"__local.{n}") + F.pow(F.lit(f), F.col("__i") + 1) * F.coalesce(f"__above.{n}", F.lit(0.0))).alias(n) for n, f in fades.items()])
    return joined.select(F.col(key), chunk, whole.alias("__sum"))


def exponential_means(df: DataFrame, key: str, row: str, price: str, spans: dict[str, int]) -> DataFrame:
    """Exponential means (seeded with the first value) of a series whose rows are numbered in ``row``.

    A mean is the part from its own chunk of ``CHUNK`` rows plus the faded sum of all chunks before.
    """
    if min(spans.values()) < 2:
        raise ValueError("a span of one row is the price itself")
    number = F.col(row) - 1
    df = df.withColumns({"__chunk": F.floor(number / CHUNK), "__i": (number % CHUNK + 1).cast("double")})
    inside = Window.partitionBy(key, "__chunk").orderBy("__i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fade = {name: 1 - 2 / (span + 1) for name, span in spans.items()}
    local = {
        f"__local_{n}": F.sum(F.when(number == 0, 1.0).otherwise(1 - f) * F.col(price) * F.pow(F.lit(f), -F.col("__i"))).over(inside)
        * F.pow(F.lit(f), F.col("__i"))
        for n, f in fade.items()
    }
    df = df.withColumns(local)
    ends = df.groupBy(key, "__chunk").agg(F.max_by(F.struct(*[F.col(f"__local_{n}").alias(n) for n in fade]), "__i").alias("__end"))
    sums = _decayed(ends, key, {n: f**CHUNK for n, f in fade.items()})
    carried = sums.select(F.col(key).alias("__key"), (F.col("__chunk") + 1).alias("__of"), "__sum")
    out = df.join(carried, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__chunk") == F.col("__of")), "left").drop("__key", "__of")
    means = {n: F.col(f"__local_{n}") + F.pow(F.lit(f), F.col("__i")) * F.coalesce(f"__sum.{n}", F.lit(0.0)) for n, f in fade.items()}
    return out.withColumns(means).drop("__chunk", "__i", "__sum", *local)


def _tail(values: Column, n: int) -> Column:
    return F.slice(values, -F.least(F.size(values), F.lit(n)), n)


def indicators(
    ticks: DataFrame, key: str, order: Sequence[str], price: str, k: int = 14, fast: int = 12, slow: int = 26,
    hot_rows: int | None = None,
) -> DataFrame:
    """SMA, WMA, EMA, RSI, MACD and Bollinger bands per symbol."""
    value = F.col(price)
    out = scan(
        ticks, [key], order,
        {"sma": moving(F.avg, value, k), "__dev": moving(F.stddev_pop, value, k), "__recent": moving(F.collect_list, value, k + 1)},
        {"__rn": row_number()},
        hot_rows=hot_rows,
    )
    recent = F.col("__recent")
    last = _tail(recent, k)
    weighted = F.aggregate(
        F.transform(last, lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x
    ) / (F.size(last) * (F.size(last) + 1) / 2)
    tail = _tail(recent, k + 1)
    steps = F.zip_with(F.slice(tail, 2, k), F.slice(tail, 1, F.greatest(F.size(tail) - 1, F.lit(0))), lambda b, a: b - a)
    gain = F.aggregate(F.transform(steps, lambda d: F.greatest(d, F.lit(0.0))), F.lit(0.0), lambda a, x: a + x)
    loss = F.aggregate(F.transform(steps, lambda d: F.greatest(-d, F.lit(0.0))), F.lit(0.0), lambda a, x: a + x)
    rsi = F.when(F.size(recent) <= 1, None).when(loss == 0, 100.0).otherwise(100 - 100 / (1 + F.try_divide(gain, loss)))
    out = out.withColumns({"wma": weighted, "rsi": rsi}).drop("__recent")
    out = exponential_means(out, key, "__rn", price, {"ema": k, "__fast": fast, "__slow": slow})
    return out.withColumns(
        {
            "macd": F.col("__fast") - F.col("__slow"),
            "bollinger_upper": F.col("sma") + 2 * F.col("__dev"),
            "bollinger_lower": F.col("sma") - 2 * F.col("__dev"),
        }
    ).drop("__dev", "__rn", "__fast", "__slow")


def returns(ticks: DataFrame, key: str, order: Sequence[str], price: str, hot_rows: int | None = None) -> DataFrame:
    """Relative change against the row before; the first row of a key has none."""
    out = scan(ticks, [key], order, {"__before": lag(price)}, hot_rows=hot_rows)
    before = F.col("__before")
    return out.withColumn("ret", F.try_divide(F.col(price) - before, before)).drop("__before")


def historical_var(series: DataFrame, key: str, value: str = "ret", q: float = 0.05) -> DataFrame:
    """Historical value at risk: the loss at the ``q`` quantile of returns."""
    return exact_quantiles(series, key, value, {"quantile": q}).select(key, (-F.col("quantile")).alias("value_at_risk"))


def running_pnl(trades: DataFrame, key: str, order: Sequence[str], signed_amount: Column, hot_rows: int | None = None) -> DataFrame:
    amount = signed_amount.cast("decimal(18,2)")
    out = scan(trades, [key], order, {"pnl": running_sum(amount)}, hot_rows=hot_rows)
    return out.withColumn("pnl", F.col("pnl").cast("double"))


def sensor_zscore(readings: DataFrame, key: str, order: Sequence[str], value: str, k: int, limit: float = 3.0,
                  hot_rows: int | None = None) -> DataFrame:
    """Deviation from the last ``k`` readings, the current one included, and an anomaly flag."""
    out = scan(
        readings, [key], order,
        {"__mean": moving(F.avg, F.col(value), k), "__dev": moving(F.stddev_pop, F.col(value), k)},
        hot_rows=hot_rows,
    )
    score = F.try_divide(F.col(value) - F.col("__mean"), F.col("__dev"))
    return out.withColumn("zscore", score).withColumn("is_anomaly", F.coalesce(F.abs("zscore") > limit, F.lit(False))).drop("__mean", "__dev")


def downsample(readings: DataFrame, key: str, ts: str, value: str, width: str) -> DataFrame:
    """Mean, extremes and count per key and time bucket."""
    return readings.groupBy(key, F.window(ts, width).start.alias("bucket")).agg(
        F.count(value).alias("n"), F.round(F.avg(value), 6).alias("mean_value"), F.min(value).alias("min_value"), F.max(value).alias("max_value")
    )


def gap_fill(buckets: DataFrame, key: str, ts: str, value: str, step: str, hot_rows: int | None = None) -> DataFrame:
    """Every step from the first to the last bucket of its key; a missing bucket or value repeats the last value."""
    out = every_step(buckets.select(key, ts, value), [key], ts, step, {"__filled": latest(value)}, hot_rows=hot_rows)
    return out.select(key, ts, (F.col("is_step") | F.col(value).isNull()).alias("is_filled"), F.col("__filled").alias(value))


def rule_checks(
    tx: DataFrame, key: str, ts: str, row_id: str, lat: str, lon: str, per_minute: int = 5, max_kmh: float = 900.0,
    quiet: tuple[int, int] = (0, 5), hot_rows: int | None = None,
) -> DataFrame:
    """Velocity per minute, impossible travel and off-hours flags for every transaction."""
    at = tx.withColumn("__at", F.unix_micros(ts))
    out = range_totals(at, [key], "__at", [row_id], {"last_minute": (F.lit(1).cast("long"), 60_000_000)}, hot_rows)
    out = scan(out, [key], [ts, row_id], {"__before": lag(F.struct(lat, lon, "__at"))}, hot_rows=hot_rows)
    before = F.col("__before")
    km = distance_km(before[lat], before[lon], lat, lon)
    hours = (F.col("__at") - before["__at"]) / 3_600_000_000
    speed = F.try_divide(km, hours)
    return out.withColumns(
        {
            "speed_kmh": speed,
            "velocity_flag": F.col("last_minute") > per_minute,
            "travel_flag": F.coalesce((speed > max_kmh) | ((hours == 0) & (km > 0)), F.lit(False)),
            "off_hours_flag": F.hour(ts).between(*quiet),
        }
    ).drop("__before", "__at")


def cart_abandonment(events: DataFrame, within: str, hot_rows: int | None = None) -> DataFrame:
    """Cart additions without a purchase of the same product by the same user within the given time."""
    kept = events.filter(F.col("action").isin("add_to_cart", "purchase"))
    out = scan(
        kept, ["user_id", "product_id"], ["-event_time", "-event_id"],
        {"next_purchase": latest(F.when(F.col("action") == "purchase", F.col("event_time")))}, hot_rows=hot_rows,
    )
    late = F.col("next_purchase").isNull() | (F.col("next_purchase") > F.col("event_time") + F.expr(f"INTERVAL {within}"))
    return out.filter((F.col("action") == "add_to_cart") & late).select("event_id", "user_id", "product_id", "event_time", "next_purchase")
