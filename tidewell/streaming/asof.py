"""As-of join of two streams: each event with the latest version of its key at or before the event's time.

Both streams become one, and a key's rows are applied in event-time order once the watermark of both has passed them: events wait until no
older version can come. State holds the waiting rows and one version per key; all older ones are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.streaming.ordered import InEventOrder, keyed, passes, timed

PLAIN = (T.LongType, T.IntegerType, T.DoubleType, T.StringType, T.BooleanType)


def packed(name: str, kind: T.DataType) -> tuple[Column, str]:
    """A column in a form that state arrays hold, and that form's type."""
    if isinstance(kind, PLAIN):
        return F.col(name), kind.simpleString().replace("bigint", "long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name), "long"
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(name, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}), "string"
    return F.col(name).cast("string"), "string"


def unpacked(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, PLAIN):
        return column
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(column)
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.from_json(column, kind.json(), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    return column.cast(kind)


class AsOf(InEventOrder):
    """Versions (side 0) and events (side 1) of a key; at equal times versions come first, in the order of ``version_order``."""

    def __init__(self, event_fields: list[tuple[str, str]], version_fields: list[tuple[str, str]], version_order: Sequence[str], tolerance_us: int | None):
        self.split, self.none, self.tolerance_us = 2 + len(event_fields), (None,) * len(version_fields), tolerance_us
        self.FIELDS = ", ".join(f"{n} {t}" for n, t in [("side", "int"), *event_fields, *version_fields])
        self.ORDER = ("side", *[f"v_{c}" for c in version_order])
        self.STATE = ", ".join(f"{n} {t}" for n, t in [("since_us", "long"), *version_fields])
        self.SCHEMA = ", ".join(f"`{n}` {t}" for n, t in [*event_fields, *version_fields])

    def advance(self, key, rows, state, mark_us, out):
        for row in rows:
            if row[1] == 0:
                state = (row[0], *row[self.split :])
            else:
                valid = state is not None and (self.tolerance_us is None or state[0] >= row[0] - self.tolerance_us)
                out.append((*row[2 : self.split], *(state[1:] if valid else self.none)))
        return None if state is None or (self.tolerance_us is not None and mark_us > state[0] + self.tolerance_us) else state

    def deadline(self, state):
        return passes(state[0] + self.tolerance_us) if self.tolerance_us is not None else None


def asof_stream(events: DataFrame, versions: DataFrame, key: str, ts: str, version_ts: str, version_order: Sequence[str] = (), delay: str = "20 seconds",
                version_delay: str | None = None, tolerance_seconds: int | None = None, prefix: str = "") -> DataFrame:
    """The stream form of ``joins.asof_join``, for events whose time the watermarks of both streams have passed.

    Rows without a time, and versions without a key, take no part.
    """
    values = [c for c in versions.columns if c != key]
    event_kinds, version_kinds = {c: events.schema[c].dataType for c in events.columns}, {c: versions.schema[c].dataType for c in values}
    event_packed, version_packed = {c: packed(f"`{c}`", k) for c, k in event_kinds.items()}, {c: packed(f"`{c}`", k) for c, k in version_kinds.items()}
    event_fields, version_fields = [(f"e_{c}", t) for c, (_, t) in event_packed.items()], [(f"v_{c}", t) for c, (_, t) in version_packed.items()]

    def rows(side: DataFrame, number: int, at: str, own: dict, lag: str) -> DataFrame:
        columns = {n: F.lit(None).cast(t) for n, t in [*event_fields, *version_fields]} | {("v_" if number == 0 else "e_") + c: v for c, (v, _) in own.items()}
        chosen = side.select(F.col(f"`{key}`").alias("key"), F.col(f"`{at}`").alias("event_time"), F.lit(number).alias("side"), *[v.alias(n) for n, v in columns.items()])
        return timed(chosen, lag)

    both = rows(events, 1, ts, event_packed, delay).unionByName(rows(versions.filter(F.col(f"`{key}`").isNotNull()), 0, version_ts, version_packed, version_delay or delay))
    tolerance = None if tolerance_seconds is None else tolerance_seconds * 1_000_000
    processor = AsOf(event_fields, version_fields, version_order, tolerance)
    out = keyed(both, "key", processor, processor.SCHEMA)
    return out.select(
        *[unpacked(F.col(f"`e_{c}`"), k).alias(c) for c, k in event_kinds.items()], *[unpacked(F.col(f"`v_{c}`"), k).alias(f"{prefix}{c}") for c, k in version_kinds.items()]
    )
