"""Event patterns per user, worked out in event time.

The rows of a user wait in state, folded to one entry a millisecond, and an event-time timer takes each
entry out once the watermark has passed it. Timers fire in order, so the result does not depend on the
order of the micro-batches or of the rows in them, and no user's rows are ever gathered or sorted: a task
holds ``HELD`` entries of the user at hand. A user's state is gone one span after the last of the rows.

The watermark follows all events, not only those a pattern looks at. Rows behind it are dropped by Spark
and counted in ``numRowsDroppedByWatermark``; the delay says how late a row may be. Rows without an
instant have no place in time and belong to no pattern.
"""

from __future__ import annotations

import sys
from typing import Any, Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weirgate.functions.envelope import is_critical
from weirgate.functions.timeaxis import micros

#: Entries of one user that a task folds before it hands them to the state store.
HELD = 4096

# The processors travel with the query, so workers need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class InTimeOrder(StatefulProcessor):
    """What waits (``WAITING``), what is remembered of the past (``LAST``, its newest instant first) and for how long."""

    WAITING: str
    LAST: str

    def __init__(self, span_micros: int):
        self.span = span_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "ms bigint", self.WAITING)
        self.last = handle.getValueState("last", self.LAST)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        held: dict[int, dict] = {}
        for row in rows:
            ms = row["_at"] // 1000
            if ms not in held and len(held) >= HELD:
                self._keep(held)
                held = {}
            self.fold(held.setdefault(ms, {}), row)
        self._keep(held)
        return iter(())

    def _keep(self, held: dict[int, dict]) -> None:
        for ms, entry in held.items():
            before = self.waiting.getValue((ms,))
            if before is None:
                # The watermark is a millisecond as well; the next one has passed all of this one.
                self.handle.registerTimer(ms + 1)
            self.waiting.updateValue((ms,), self.packed(entry, before))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        entry = self.waiting.getValue((due - 1,))
        if entry is not None:
            self.waiting.removeKey((due - 1,))
            newest, found = self.taken(key, entry)
            yield from found
            if newest is not None:
                self.handle.registerTimer(self._over(newest))
        elif self.last.exists() and self._over(self.last.get()[0]) <= due:
            self.last.clear()

    def _over(self, newest: int) -> int:
        """The first millisecond in which an instant reaches nothing any more; entries are taken a millisecond later."""
        return (newest + self.span) // 1000 + 2

    def close(self) -> None:
        pass


class Bursts(InTimeOrder):
    """Remembers the last ``n - 1`` instants of a user; that is all the next decision needs."""

    WAITING = "at array<bigint>, rows array<bigint>"
    LAST = "newest bigint, at array<bigint>"

    def __init__(self, n: int, span_micros: int):
        super().__init__(span_micros)
        self.n = n

    def fold(self, entry: dict, row: Row) -> None:
        # More than n rows at one instant decide nothing that n do not.
        entry[row["_at"]] = min(entry.get(row["_at"], 0) + 1, self.n)

    def packed(self, entry: dict, before: tuple | None) -> tuple:
        if before is not None:
            for at, rows in zip(*before):
                entry[at] = min(entry.get(at, 0) + rows, self.n)
        return list(entry), list(entry.values())

    def taken(self, key: Any, entry: tuple) -> tuple[int | None, list[Row]]:
        kept = list(self.last.get()[1]) if self.last.exists() else []
        found = []
        for at, rows in sorted(zip(*entry)):
            kept = (kept + [at] * rows)[-self.n:]
            if len(kept) == self.n and at - kept[0] <= self.span:
                found.append(Row(user_id=key[0], at=at))
        kept = kept[1 - self.n:] if self.n > 1 else []
        if not kept:
            return None, found
        self.last.update((kept[-1], kept))
        return kept[-1], found


class LatestOpened(InTimeOrder):
    """Remembers the latest opened transaction of a user; at one instant the smallest id stands for all."""

    WAITING = "at array<bigint>, opened array<string>, closed array<array<string>>"
    LAST = "at bigint, id string"

    def __init__(self, opened: str, span_micros: int):
        super().__init__(span_micros)
        self.opened = opened

    @staticmethod
    def _open(place: list, event_id: str) -> None:
        place[0] = event_id if place[0] is None else min(place[0], event_id)

    def fold(self, entry: dict, row: Row) -> None:
        place = entry.setdefault(row["_at"], [None, []])
        if row["event_type"] == self.opened:
            self._open(place, row["event_id"])
        else:
            place[1].append(row["event_id"])

    def packed(self, entry: dict, before: tuple | None) -> tuple:
        for at, opened, closed in zip(*before) if before is not None else ():
            place = entry.setdefault(at, [None, []])
            if opened is not None:
                self._open(place, opened)
            place[1].extend(closed)
        return list(entry), [p[0] for p in entry.values()], [p[1] for p in entry.values()]

    def taken(self, key: Any, entry: tuple) -> tuple[int | None, list[Row]]:
        current = tuple(self.last.get()) if self.last.exists() else None
        found, newest = [], None
        for at, opened, closed in sorted(zip(*entry), key=lambda x: x[0]):
            if opened is not None:
                current, newest = (at, opened), at
            if current is not None and at - current[0] <= self.span:
                found += [
                    Row(user_id=key[0], closed_id=c, opened_id=current[1], closed_us=at, opened_us=current[0]) for c in closed
                ]
        if newest is not None:
            self.last.update(current)
        return newest, found


def _in_time_order(
    events: DataFrame, wanted: Column, columns: tuple[str, ...], processor: InTimeOrder, result: str, delay: str, at: str
) -> DataFrame:
    # The condition names the instant, or Spark would filter before the watermark, and a quiet pattern
    # would hold up its own results.
    timed = events.withWatermark(at, delay).filter(F.when(F.col(at).isNotNull(), wanted))
    return timed.select(*columns, micros(F.col(at)).alias("_at"), at).groupBy("user_id").transformWithState(
        statefulProcessor=processor, outputStructType=result, outputMode="Append", timeMode="EventTime"
    )


def stream_bursts(
    events: DataFrame, n: int = 3, within: int = 600, delay: str = "1 hour", at: str = "received_at"
) -> DataFrame:
    """(user_id, alert_at) at each instant that completes ``n`` critical events in the span."""
    found = _in_time_order(
        events, is_critical(F.col("event_type")), ("user_id",), Bursts(n, within * 1_000_000), "user_id string, at bigint", delay, at
    )
    return found.select("user_id", F.timestamp_micros("at").alias("alert_at"))


def stream_matches(
    events: DataFrame, bound: int = 3600, opened: str = "transaction.created",
    closed: str = "transaction.completed", delay: str = "1 hour", at: str = "received_at",
) -> DataFrame:
    """Every ``closed`` event with the user's latest ``opened`` at or before it, within the bound.

    A stream-stream join would emit every pair within the bound before the latest is chosen; this gives
    one row per closed event.
    """
    found = _in_time_order(
        events, F.col("event_type").isin(opened, closed), ("user_id", "event_id", "event_type"),
        LatestOpened(opened, bound * 1_000_000),
        "user_id string, closed_id string, opened_id string, closed_us bigint, opened_us bigint", delay, at,
    )
    return found.select(
        "user_id", "closed_id", "opened_id",
        F.timestamp_micros("closed_us").alias("closed_at"), F.timestamp_micros("opened_us").alias("opened_at"),
    )
