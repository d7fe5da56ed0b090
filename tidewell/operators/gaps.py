"""Missing steps of a time axis, made from each row and the next one of its key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.scan import lead, scan

CHUNK = 4096


def every_step(df: DataFrame, keys: Sequence[str], ts: str, step: str, *others: dict, hot_rows: int | None = None) -> DataFrame:
    """The rows of ``df``, and after each row one copy of it per ``step`` until the next row of its key, with ``is_step`` true for the copies.

    A gap is cut into chunks of ``CHUNK`` steps, each of which is one array, so neither a long gap nor a key with a long life is ever one
    value. ``others`` are further steps of ``scan`` over the rows as they come, whose columns the copies carry.
    """
    out = scan(df, keys, [ts], {"__next": lead(ts)}, *others, hot_rows=hot_rows)
    # The shortest a step can be: a month is counted as February.
    length = F.expr(f"unix_micros(TIMESTAMP '2001-02-01 00:00:00' + INTERVAL {step}) - unix_micros(TIMESTAMP '2001-02-01 00:00:00')")
    until = F.col("__next") - F.expr("INTERVAL '0.000001' SECOND")
    chunks = F.floor((F.unix_micros(until) - F.unix_micros(ts)) / (length * CHUNK))
    out = out.withColumn("__chunk", F.explode(F.sequence(F.lit(0), F.greatest(F.coalesce(chunks, F.lit(0)), F.lit(0)).cast("int"))))
    starts = F.expr(f"`{ts}` + INTERVAL {step} * (__chunk * {CHUNK})")
    ends = F.expr(f"`{ts}` + INTERVAL {step} * (__chunk * {CHUNK} + {CHUNK - 1})")
    out = out.withColumns({"__start": starts, "__end": F.least(ends, until)})
    inside: Column = F.expr(f"sequence(__start, __end, INTERVAL {step})")
    times = F.when(F.col("__end") >= F.col("__start"), inside).when(F.col("__chunk") == 0, F.array("__start"))
    times = F.when(F.col("__next").isNull(), F.array("__start")).otherwise(times)
    out = out.withColumn("__at", F.explode(times)).withColumn("is_step", F.col("__at") != F.col(ts))
    return out.withColumn(ts, F.col("__at")).drop("__next", "__chunk", "__start", "__end", "__at")
