"""Keyed state jobs in event-time order, on ``ordered.InEventOrder``.

A row is applied when the watermark passes it, so every job gives the rows of its table twin for the closed part of the stream. Amounts are
kept as whole cents, so running sums are exact. State is read and written once per slot of keys and watermark step, and forgotten when nothing
that comes can depend on it any more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.measures import ratio
from tidewell.functions.tiers import LOYALTY_TIERS, TIER_BENEFITS
from tidewell.streaming.ordered import InEventOrder, Shelf, keyed, passes, reaches, timed

DAY_US = 86_400_000_000


def prepare(events: DataFrame, delay: str, *columns: str) -> DataFrame:
    """The columns a processor reads, with the watermark set. A missing amount counts as nothing."""
    cents = F.coalesce(F.round(F.col("total_amount") * 100).cast("long"), F.lit(0))
    return timed(events, delay).withColumn("cents", cents).select("at_us", "event_time", *dict.fromkeys(columns))


class FraudState(InEventOrder):
    """Spend since the last long pause and the time of the last large transaction."""

    FIELDS = "event_id long, cents long"
    STATE = "last_us long, cents long"
    SCHEMA = "event_id long, user_id long, event_time timestamp, amount double, recent_spending double, fraud_score int, alert_type string"

    def __init__(self, high=1000.0, volume=2000.0, reset_seconds=3600, rapid_seconds=60, emit_at=40):
        self.high, self.volume = round(high * 100), round(volume * 100)
        self.reset_us, self.rapid_us, self.emit_at = reset_seconds * 1_000_000, rapid_seconds * 1_000_000, emit_at

    def advance(self, key, rows, state, mark_us, out):
        last, spending = state or (None, 0)
        for at, event, cents in rows:
            pause = None if last is None else at - last
            spending = cents if pause is None or pause > self.reset_us else spending + cents
            big, busy, rapid = cents > self.high, spending > self.volume, pause is not None and pause < self.rapid_us
            score = 50 * big + 30 * busy + 40 * rapid
            if score >= self.emit_at:
                kind = "RAPID_TRANSACTIONS" if rapid else "HIGH_VOLUME" if busy else "HIGH_VALUE" if big else "SUSPICIOUS"
                out.append((event, key, at, cents / 100, spending / 100, score, kind))
            last = at
        # After the deadline the next row starts anew, whenever it comes.
        return None if mark_us >= self._end(last) * 1000 else (last, spending)

    def _end(self, last: int) -> int:
        return passes(last + max(self.reset_us, self.rapid_us))

    def deadline(self, state):
        return self._end(state[0])


class SessionTracker(InEventOrder):
    """Final metrics once the gap has passed; with ``running`` also those so far, whenever the watermark has freed rows."""

    FIELDS = "event_id long, action string, category string, cents long"
    SCHEMA = (
        "user_id long, session_start_ms long, last_event_ms long, event_count long, unique_categories int, total_spent double, "
        "view_count long, cart_count long, purchase_count long, engagement_score long, is_final boolean"
    )
    STATE = "start_us long, last_us long, n long, views long, carts long, purchases long, cents long, categories array<string>"

    def __init__(self, gap_seconds: int = 1800, running: bool = True):
        self.gap_us, self.running = gap_seconds * 1_000_000, running

    @staticmethod
    def _row(key, s, final):
        start, last, n, views, carts, purchases, cents, categories = s
        score = views + 3 * carts + 5 * purchases + 2 * len(categories)
        return (key, start // 1000, last // 1000, n, len(categories), cents / 100, views, carts, purchases, score, final)

    def advance(self, key, rows, state, mark_us, out):
        for at, _, action, category, cents in rows:
            if state and at - state[1] > self.gap_us:
                out.append(self._row(key, state, True))
                state = None
            start, _, n, views, carts, purchases, spent, seen = state or (at, at, 0, 0, 0, 0, 0, [])
            if category is not None and category not in seen:
                seen = sorted([*seen, category])
            bought = action == "purchase"
            state = (start, at, n + 1, views + (action == "view"), carts + (action == "add_to_cart"), purchases + bought, spent + (cents if bought else 0), seen)
        if mark_us > state[1] + self.gap_us:
            out.append(self._row(key, state, True))
            return None
        if rows and self.running:
            out.append(self._row(key, state, False))
        return state

    def deadline(self, state):
        return passes(state[1] + self.gap_us)


class UserProfile(InEventOrder):
    """Logins, spend, last purchases and viewed categories at every event; upgrades become active a day later; idle users are forgotten.

    A user is forgotten ``ttl_hours`` after their last event. Upgrades that would become active later than that are forgotten with them.
    """

    FIELDS = "event_id long, action string, category string, product_id long, cents long"
    SCHEMA = (
        "user_id long, kind string, event_id long, at_ms long, session_count long, total_spent double, tier string, "
        "recent_purchases array<long>, preferences map<string,long>, benefits array<string>"
    )
    STATE = (
        "logins long, cents long, level int, last_us long, recent array<long>, viewed array<string>, views array<long>, "
        "due_us array<long>, due_level array<int>, due_logins array<long>, due_cents array<long>"
    )

    def __init__(self, ttl_hours: int = 24 * 365, keep: int = 10, steps=tuple(LOYALTY_TIERS)):
        self.ttl_us, self.keep, self.steps = ttl_hours * 3_600_000_000, keep, tuple(sorted(steps))

    def _tier(self, level: int) -> str:
        return self.steps[level - 1][1] if level else "BRONZE"

    def _activated(self, key, coming: list[tuple], until_us: int, out: list[tuple]) -> list[tuple]:
        """Add the rows of the upgrades that are due by then, and return the others."""
        for at, level, logins, cents in coming:
            if at <= until_us:
                out.append((key, "TIER_ACTIVATED", None, at // 1000, logins, cents / 100, self._tier(level), None, None, TIER_BENEFITS[self._tier(level)]))
        return [u for u in coming if u[0] > until_us]

    def advance(self, key, rows, state, mark_us, out):
        logins, cents, level, last, recent, coming = *(state[:5] if state else (0, 0, 0, None, [])), list(zip(*state[7:], strict=True)) if state else []
        seen = dict(zip(state[5], state[6], strict=True)) if state else {}
        for at, event, action, category, product, amount in rows:
            if last is not None and at - last > self.ttl_us:
                self._activated(key, coming, last + self.ttl_us, out)
                logins, cents, level, recent, seen, coming = 0, 0, 0, [], {}, []
            if action == "login":
                logins += 1
            elif action == "view" and category is not None:
                seen = {**seen, category: seen.get(category, 0) + 1}
            elif action == "purchase":
                cents, recent = cents + amount, [*recent, product][-self.keep :]
            # Steps already taken stay.
            reached = max(level, sum(cents >= step * 100 for step, _ in self.steps))
            if reached > level:
                level = reached
                coming.append((at + DAY_US, level, logins, cents))
            out.append((key, "PROFILE", event, at // 1000, logins, cents / 100, self._tier(level), recent, seen, None))
            last = at
        if mark_us > last + self.ttl_us:
            self._activated(key, coming, last + self.ttl_us, out)
            return None
        coming = self._activated(key, coming, mark_us, out)
        return (logins, cents, level, last, recent, list(seen), list(seen.values()), *[[u[k] for u in coming] for k in range(4)])

    def deadline(self, state):
        return min([*map(reaches, state[7]), passes(state[3] + self.ttl_us)])


class RunningFeatures(InEventOrder):
    """Running totals of a key at every event, with the number of distinct ``member`` values so far.

    Members are rows of a shelf, and only new ones are written, so a key with very many of them is no large value. A key is forgotten
    ``ttl_hours`` after its last event, members included.
    """

    STATE = "n long, cents long, views long, purchases long, members long, first_us long, last_us long"

    def __init__(self, key: str, member: str, key_type: str, ttl_hours: int = 24 * 365):
        self.ttl_us = ttl_hours * 3_600_000_000
        self.FIELDS = f"event_id long, action string, cents long, {member} string"
        self.SCHEMA = self.schema(key, key_type)

    @staticmethod
    def schema(key: str, key_type: str) -> str:
        return f"{key} {key_type}, event_id long, event_time timestamp, events long, spent double, views long, purchases long, members long, since_last_ms long, since_first_ms long"

    def init(self, handle) -> None:
        super().init(handle)
        self.known = Shelf(handle, "members", f"key {self.KEY}, member string")

    def load(self):
        self.members, self.fresh, self.gone = {}, [], False
        for key, member in self.known.rows():
            self.members.setdefault(key, set()).add(member)

    def save(self):
        if self.gone:
            self.known.put([(key, member) for key, members in self.members.items() for member in members])
        elif self.fresh:
            self.known.append(self.fresh)

    def _forget(self, key) -> None:
        self.gone = bool(self.members.pop(key, None)) or self.gone

    def advance(self, key, rows, state, mark_us, out):
        for at, event, action, cents, member in rows:
            if state and at - state[6] > self.ttl_us:
                self._forget(key)
                state = None
            n, spent, views, purchases, members, first, last = state or (0, 0, 0, 0, 0, at, at)
            seen = self.members.setdefault(key, set())
            if member is not None and member not in seen:
                seen.add(member)
                self.fresh.append((key, member))
                members += 1
            sold = action == "purchase"
            state = (n + 1, spent + (cents if sold else 0), views + (action == "view"), purchases + sold, members, first, at)
            out.append((key, event, at, state[0], state[1] / 100, state[2], state[3], members, (at - last) // 1000, (at - first) // 1000))
        if mark_us > state[6] + self.ttl_us:
            self._forget(key)
            return None
        return state

    def deadline(self, state):
        return passes(state[6] + self.ttl_us)


class CountTrigger(InEventOrder):
    """An aggregate for every ``n`` events in event order; a rest is flushed after ``idle_seconds`` without events."""

    FIELDS = "event_id long, cents long"
    STATE = "batch_no long, n long, cents long, first_us long, last_us long"
    SCHEMA = "user_id long, batch_no long, event_count long, total_amount double, first_ms long, last_ms long, is_partial boolean"

    def __init__(self, n: int = 100, idle_seconds: int = 3600):
        self.n, self.idle_us = n, idle_seconds * 1_000_000

    def advance(self, key, rows, state, mark_us, out):
        batch_no, n, cents, first, last = state or (1, 0, 0, None, None)

        def flush(partial: bool) -> None:
            nonlocal batch_no, n, cents
            out.append((key, batch_no, n, cents / 100, first // 1000, last // 1000, partial))
            batch_no, n, cents = batch_no + 1, 0, 0

        for at, _, amount in rows:
            if n and at - last >= self.idle_us:
                flush(True)
            first = at if n == 0 else first
            n, cents, last = n + 1, cents + amount, at
            if n == self.n:
                flush(False)
        if n and mark_us >= last + self.idle_us:
            flush(True)
        return batch_no, n, cents, first, last

    def deadline(self, state):
        return reaches(state[4] + self.idle_us) if state[1] else None


class ProductPopularity(InEventOrder):
    """Metrics of the last ``hours`` at the end of every hour in which a product had events.

    Every user of the period is one row of a shelf, their latest hour, and beside them stands the number of users by latest hour: the users
    of a period are a sum over its hours. Users who have been away for the whole period are removed once per period.
    """

    FIELDS = "event_id long, action string, cents long, user string"
    STATE = "open_hour long, cleaned_hour long, any_cells boolean"
    SCHEMA = "product_id long, hour_no long, total_views long, total_purchases long, revenue_cents long, unique_users long, hours_with_activity long"
    HOUR_US = 3_600_000_000

    def __init__(self, hours: int = 24):
        self.hours = hours

    def init(self, handle) -> None:
        super().init(handle)
        self.cell_shelf = Shelf(handle, "cells", f"key {self.KEY}, hour_no long, views long, purchases long, cents long, latest_users long")
        self.user_shelf = Shelf(handle, "latest", f"key {self.KEY}, user string, hour_no long")

    def load(self):
        self.cells, self.latest = {}, {}
        for key, hour, *cell in self.cell_shelf.rows():
            self.cells.setdefault(key, {})[hour] = cell
        for key, user, hour in self.user_shelf.rows():
            self.latest.setdefault(key, {})[user] = hour

    def save(self):
        self.cell_shelf.put([(key, hour, *cell) for key, cells in self.cells.items() for hour, cell in cells.items()])
        self.user_shelf.put([(key, user, hour) for key, users in self.latest.items() for user, hour in users.items()])

    def _closed(self, key, hour: int, cells: dict[int, list[int]]) -> tuple:
        for old in [h for h in cells if h < hour - self.hours]:
            del cells[old]
        sums = [sum(c[k] for c in cells.values()) for k in range(4)]
        return (key, hour, *sums, sum(1 for c in cells.values() if c[0] or c[1]))

    def advance(self, key, rows, state, mark_us, out):
        cells, latest = self.cells.setdefault(key, {}), self.latest.setdefault(key, {})
        opened, cleaned, _ = state or (None, None, False)
        for at, _, action, cents, user in rows:
            hour = at // self.HOUR_US
            if opened is not None and opened < hour:
                out.append(self._closed(key, opened, cells))
            opened, cleaned = hour, hour if cleaned is None else cleaned
            cell = cells.setdefault(hour, [0, 0, 0, 0])
            cell[0] += action == "view"
            if action == "purchase":
                cell[1] += 1
                cell[2] += cents
            before = latest.get(user)
            if before != hour:
                if before in cells:
                    cells[before][3] -= 1
                cell[3] += 1
                latest[user] = hour
        if opened is not None and mark_us >= (opened + 1) * self.HOUR_US:
            out.append(self._closed(key, opened, cells))
            opened = None
        now = mark_us // self.HOUR_US
        if cleaned is not None and now > cleaned + self.hours:
            latest = self.latest[key] = {u: h for u, h in latest.items() if h >= now - self.hours}
            cells = self.cells[key] = {h: c for h, c in cells.items() if h >= now - self.hours}
            cleaned = now
        # Nothing is due once the product's cells are gone.
        return (opened, cleaned, bool(cells)) if cells or opened is not None else None

    def deadline(self, state):
        opened, cleaned, any_cells = state
        due = [(opened + 1) * self.HOUR_US] if opened is not None else []
        due += [(cleaned + self.hours + 1) * self.HOUR_US] if any_cells else []
        return reaches(min(due)) if due else None


def popularity(events: DataFrame, hours: int = 24, delay: str = "20 seconds") -> DataFrame:
    """Metrics and score per product at the end of every hour with events, over the last ``hours``."""
    user = F.coalesce(F.col("user_id").cast("string"), F.lit(""))
    rows = prepare(events, delay, "product_id", "event_id", "action", "cents", "user_id").withColumn("user", user).drop("user_id")
    out = keyed(rows, "product_id", ProductPopularity(hours), ProductPopularity.SCHEMA)
    return out.select(
        "product_id", F.timestamp_seconds(F.col("hour_no") * 3600).alias("hour"), "total_views", "total_purchases", (F.col("revenue_cents") / 100).alias("total_revenue"),
        "unique_users", "hours_with_activity", ratio("total_purchases", "total_views").alias("conversion_rate"),
        (F.col("total_views") + F.col("total_purchases") * 5 + F.col("unique_users") * 3 + F.col("hours_with_activity") * 2).alias("popularity_score"),
    )


def fraud_alerts(events: DataFrame, delay: str = "20 seconds", floor: float = 500.0, **rules) -> DataFrame:
    """Alerts of ``FraudState``; only amounts above ``floor`` reach the state."""
    rows = prepare(events.filter(F.col("total_amount") > floor), delay, "user_id", "event_id", "cents")
    return keyed(rows, "user_id", FraudState(**rules), FraudState.SCHEMA)


def track_sessions(events: DataFrame, gap_seconds: int = 1800, delay: str = "20 seconds", running: bool = True) -> DataFrame:
    rows = prepare(events, delay, "user_id", "event_id", "action", "category", "cents")
    return keyed(rows, "user_id", SessionTracker(gap_seconds, running), SessionTracker.SCHEMA)


def user_profiles(events: DataFrame, delay: str = "20 seconds", **settings) -> DataFrame:
    rows = prepare(events, delay, "user_id", "event_id", "action", "category", "product_id", "cents")
    return keyed(rows, "user_id", UserProfile(**settings), UserProfile.SCHEMA)


def count_batches(events: DataFrame, n: int, idle_seconds: int = 3600, delay: str = "20 seconds") -> DataFrame:
    return keyed(prepare(events, delay, "user_id", "event_id", "cents"), "user_id", CountTrigger(n, idle_seconds), CountTrigger.SCHEMA)


#: Key, its type and the members counted per feature stream.
FEATURES = {"user": ("user_id", "long", "category"), "product": ("product_id", "long", "user_id"), "session": ("session_id", "string", "category")}


def feature_stream(events: DataFrame, kind: str, delay: str = "20 seconds", ttl_hours: int = 24 * 365) -> DataFrame:
    """Running features of users, products or sessions at every event."""
    key, key_type, member = FEATURES[kind]
    rows = prepare(events, delay, key, "event_id", "action", "cents", member).withColumn(member, F.col(member).cast("string"))
    return keyed(rows, key, RunningFeatures(key, member, key_type, ttl_hours), RunningFeatures.schema(key, key_type))


def feature_streams(events: DataFrame, delay: str = "20 seconds") -> dict[str, DataFrame]:
    """User, product and session features as three streams keyed by event id."""
    return {kind: feature_stream(events, kind, delay) for kind in FEATURES}


def tier_by_spend(spent: Column, silver: float, gold: float) -> Column:
    return F.when(spent >= gold, "GOLD").when(spent >= silver, "SILVER").otherwise("BRONZE")


def behavior_states(events: DataFrame, silver: float = 500, gold: float = 2000, delay: str = "20 seconds") -> DataFrame:
    """Events and spend so far with the tier, at every event."""
    return feature_stream(events, "user", delay).select(
        "event_id", "user_id", "event_time", F.col("events").alias("total_events"), F.col("spent").alias("total_spent"),
        tier_by_spend(F.col("spent"), silver, gold).alias("user_tier"),
    )
