"""Keyed state that sees the rows of a key in event-time order, whatever the order of files and micro-batches.

Keys are dealt by hash to a fixed number of slots, and Spark's state is that of a slot: a call, a timer and the reads and writes of state serve
all keys of a slot at once, so that a stream of very many keys with few rows each does not pay for them per key.

Rows wait in map state, in chunks with their first and last time, until the watermark passes them. One event-time timer per slot stands at the
earliest time something is due: a waiting row or a deadline of one of its keys. When it fires, the rows up to the watermark are sorted
and applied key by key, and chunks that begin later are not read. A row that comes after the watermark has passed its time is dropped by Spark before it
gets here, so rows once applied are never overtaken and results depend on event times alone.

A slot holds in memory the rows that one watermark step frees, which the stream's rate limit times the watermark delay bounds, and the
state of its keys, which is read and written once per step in which something of the slot is due.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidewell.session import needs_rocksdb

CHUNK_ROWS = 10_000
#: Slots that the keys of a stream are dealt to. A checkpoint holds for the number it was written with.
SLOTS = 512


def listed(values: pd.Series, kind: str) -> list:
    """Plain Python values; a missing one is None, and whole numbers stay whole."""
    if values.dtype.kind in "iub":
        return values.tolist()
    whole = kind in ("long", "int")
    return [None if v is None or v != v else int(v) if whole else v for v in values.tolist()]


def reaches(micros: int) -> int:
    """The first watermark, in milliseconds, at or after a time."""
    return -(-int(micros) // 1000)


def passes(micros: int) -> int:
    """The first watermark, in milliseconds, after a time."""
    return int(micros) // 1000 + 1


def fields_of(schema: str) -> list[tuple[str, str]]:
    return [tuple(f.split(" ", 1)) for f in schema.split(", ")]


class Shelf:
    """Rows of a slot in map state, in chunks of arrays."""

    def __init__(self, handle, name: str, schema: str):
        columns = ", ".join(f"{n} array<{t}>" for n, t in fields_of(schema))
        self.chunks = handle.getMapState(name, "part int", columns)

    def _parts(self) -> list[int]:
        return [k[0] for k in self.chunks.keys()]

    def rows(self) -> list[tuple]:
        return [row for part in self._parts() for row in zip(*self.chunks.getValue((part,)), strict=True)]

    def append(self, rows: list[tuple], part: int | None = None) -> int:
        """Add rows as new chunks and return the number after the last."""
        part = max(self._parts(), default=-1) + 1 if part is None else part
        for low in range(0, len(rows), CHUNK_ROWS):
            self.chunks.updateValue((part,), tuple(list(c) for c in zip(*rows[low : low + CHUNK_ROWS], strict=True)))
            part += 1
        return part

    def put(self, rows: list[tuple]) -> None:
        kept = self.append(rows, 0)
        for part in self._parts():
            if part >= kept:
                self.chunks.removeKey((part,))


class InEventOrder(StatefulProcessor):
    """Base of processors. ``FIELDS`` are the buffered columns beside ``at_us``; ``ORDER`` breaks ties of time; ``STATE`` is what is kept of a key.

    ``advance(key, rows, state, mark_us, out)`` gets the rows ``(at_us, *FIELDS)`` of a key up to the watermark in order, possibly none, and its state
    or None; it adds rows of ``SCHEMA`` to ``out``, times in microseconds, and returns the new state, or None to forget the key.
    ``deadline(state)`` is the watermark in milliseconds at which something is due without further rows, or None.
    """

    FIELDS = "event_id long"
    ORDER = ("event_id",)
    STATE = "last_us long"
    SCHEMA = ""
    KEY = "long"

    def init(self, handle) -> None:
        self.handle = handle
        self.fields = fields_of(self.FIELDS)
        arrays = ", ".join(f"{n} array<{t}>" for n, t in [("key", self.KEY), ("at_us", "long"), *self.fields])
        self.waiting = handle.getMapState("waiting", "first_us long, last_us long, part long", arrays)
        self.clock = handle.getValueState("clock", "due_ms long, part long")
        self.held = Shelf(handle, "held", f"key {self.KEY}, {self.STATE}")
        names = [n for n, _ in self.fields]
        self.ties = [2 + names.index(n) for n in self.ORDER]

    def advance(self, key, rows: list[tuple], state: tuple | None, mark_us: int, out: list[tuple]) -> tuple | None:
        raise NotImplementedError

    def deadline(self, state: tuple) -> int | None:
        return None

    def load(self) -> None:
        """Read what a processor keeps beside the states."""

    def save(self) -> None:
        """Write what a processor keeps beside the states."""

    def frame(self, rows) -> pd.DataFrame:
        """Rows of output in the order of ``SCHEMA``."""
        columns = fields_of(self.SCHEMA)
        frame = {n.strip("`"): pd.Series(values, dtype=object) for (n, _), values in zip(columns, zip(*rows, strict=True), strict=True)}
        return pd.DataFrame({n: pd.to_datetime(frame[n].astype("int64"), unit="us") if t == "timestamp" else frame[n] for n, t in ((n.strip("`"), t) for n, t in columns)})

    def _order(self, row: tuple) -> tuple:
        """Time, then the ties; missing values last."""
        return (row[1], *[(row[i] is None, row[i]) for i in self.ties])

    def _wait(self, rows: list[tuple], part: int) -> int:
        """Store rows ``(key, at_us, *FIELDS)`` that are in order of time."""
        for low in range(0, len(rows), CHUNK_ROWS):
            chunk = rows[low : low + CHUNK_ROWS]
            self.waiting.updateValue((chunk[0][1], chunk[-1][1], part), tuple(list(c) for c in zip(*chunk, strict=True)))
            part += 1
        return part

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        due, part = self.clock.get() or (None, 0)
        known = due
        for events in rows:
            events = events.sort_values("at_us", kind="stable")
            keys = [None if missing else k for k, missing in zip(events["key"].tolist(), events["keyless"].tolist(), strict=True)]
            part = self._wait(list(zip(keys, events["at_us"].tolist(), *[listed(events[n], t) for n, t in self.fields], strict=True)), part)
            first = reaches(events["at_us"].iloc[0])
            due = first if due is None else min(due, first)
        if due != known:
            if known is not None:
                self.handle.deleteTimer(known)
            self.handle.registerTimer(due)
        self.clock.update((due, part))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark_ms = timerValues.getCurrentWatermarkInMs()
        mark = mark_ms * 1000
        _, part = self.clock.get()
        events, later = [], []
        for chunk in [tuple(k) for k in self.waiting.keys()]:
            if chunk[0] <= mark:
                events += zip(*self.waiting.getValue(chunk), strict=True)
                self.waiting.removeKey(chunk)
            else:
                later.append(chunk[0])
        events.sort(key=self._order)
        rest = [row for row in events if row[1] > mark]
        if rest:
            part = self._wait(rest, part)
            later.append(rest[0][1])
        states = {row[0]: row[1:] for row in self.held.rows()}
        ripe = {k: [] for k, state in states.items() if (due := self.deadline(state)) is not None and due <= mark_ms}
        for row in events[: len(events) - len(rest)]:
            ripe.setdefault(row[0], []).append(row[1:])
        self.load()
        out = []
        for one, rows in ripe.items():
            state = self.advance(one, rows, states.get(one), mark, out)
            if state is None:
                states.pop(one, None)
            else:
                states[one] = state
        if ripe:
            self.held.put([(k, *state) for k, state in states.items()])
            self.save()
        due = [reaches(min(later))] if later else []
        due += [d for d in map(self.deadline, states.values()) if d is not None]
        if due:
            self.handle.registerTimer(min(due))
            self.clock.update((min(due), part))
        else:
            self.clock.clear()
        if out:
            yield self.frame(out)

    def close(self) -> None:
        pass


def keyed(events: DataFrame, key: str, processor: InEventOrder, schema: str, slots: int = SLOTS) -> DataFrame:
    """Run a processor over a stream that has ``at_us`` and a watermark."""
    needs_rocksdb(events.sparkSession)
    column, processor.KEY = F.col(key), events.schema[key].dataType.simpleString()
    # A missing key is marked apart, as a column with missing numbers would reach Python as floating point.
    dealt = events.withColumns({
        "slot": F.pmod(F.xxhash64(column), F.lit(slots)).cast("int"), "keyless": column.isNull(),
        "key": F.coalesce(column, F.lit("0").cast(processor.KEY)),
    })
    return dealt.groupBy("slot").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="append", timeMode="eventtime"
    )


def timed(events: DataFrame, delay: str, ts: str = "event_time") -> DataFrame:
    """The event time in microseconds beside the rows, and the watermark; rows without a time are left out, as they have no place in the order."""
    return events.filter(F.col(ts).isNotNull()).withColumn("at_us", F.unix_micros(ts)).withWatermark(ts, delay)
