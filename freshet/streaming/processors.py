"""Per-key state machines for ``transformWithState``.

What comes here is already in event order from batch to batch: ``stateful`` first aggregates rows to one per key and
pane, and Spark hands a pane on once the watermark has passed its end.  So a machine only puts the few panes that close
together in order, and a key costs as many rows as it has panes, however many rows it has.  Days are whole numbers (days
since the epoch in the session's time zone), made by Spark before the rows come here.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class _Keyed(StatefulProcessor):
    """Goes through a key's panes in order with one value of state; adds a column to each row."""

    state_schema = ""
    added = ""

    def __init__(self, order: list[str], names: list[str]) -> None:
        self.order = order
        self.names = names
        self.out = Row(*names, self.added)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.state_schema)

    def in_order(self, rows: Iterator[Row]) -> list[Row]:
        return sorted(rows, key=lambda row: tuple((row[name] is not None, row[name]) for name in self.order))

    def extended(self, row: Row, value) -> Row:
        return self.out(*[row[name] for name in self.names], value)

    def known(self):
        return self.state.get()[0] if self.state.exists() else None

    def close(self) -> None:
        pass


class DaySeen(_Keyed):
    """The day a key was last seen; adds it to rows as ``prev_day``."""

    state_schema = "day int"
    added = "prev_day"

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = before = self.known()
        for row in self.in_order(rows):
            yield self.extended(row, last)
            last = row["day"]
        if last != before:
            self.state.update((last,))


class FirstVisit(_Keyed):
    """The day a device counts as first seen, from its first row with a visitor flag; added as ``first_day``."""

    state_schema = "day int"
    added = "first_day"

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = before = self.known()
        for row in self.in_order(rows):
            if first is None and row["flag"] is not None:
                first = row["day"] if row["flag"] == "1" else row["day"] - 1
            yield self.extended(row, first)
        if first != before:
            self.state.update((first,))


class SessionStart(_Keyed):
    """Marks the first row of a session; the mark holds for ``ttl`` and is then removed by a timer.

    Once per pane the session's earliest row decides.  A key is a group of sessions, as sessions are many and short: its
    marks are one list, read and written once a batch, so what a step costs in calls to the state does not depend on how
    many sessions it has.  A mark is the session and the time of the row that was marked, in microseconds.  A pane may
    close up to its own length after the time of its first row, so the timer, set to the earliest mark, waits for that.
    """

    added = "starts"

    def __init__(
        self, order: list[str], names: list[str], session: str, session_type: str, ttl_seconds: int, pane_seconds: int
    ) -> None:
        super().__init__(order, names)
        self.session = session
        self.mark_schema = f"session {session_type}, created bigint"
        self.ttl = ttl_seconds * 1_000_000
        self.pane = pane_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getListState("state", self.mark_schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        marks = self._marks()
        decided, changed = {}, False
        for row in self.in_order(rows):
            session, created = row[self.session], marks.get(row[self.session])
            starts = row["pane_end"] != decided.get(session) and (
                created is None or row["micros"] - created >= self.ttl
            )
            decided[session] = row["pane_end"]
            if starts:
                marks[session], changed = row["micros"], True
            yield self.extended(row, 1 if starts else 0)
        if changed:
            self._keep(marks)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        marks = self._marks()
        later = {session: created for session, created in marks.items() if self._due(created) > now}
        if later and len(later) < len(marks):
            self._keep(later)
        elif marks and not later:
            self.state.clear()
        return iter(())

    def _marks(self) -> dict:
        return dict(tuple(mark) for mark in self.state.get()) if self.state.exists() else {}

    def _keep(self, marks: dict) -> None:
        self.state.put(list(marks.items()))
        self.handle.registerTimer(self._due(min(marks.values())))

    def _due(self, created: int) -> int:
        return -(-(created + self.ttl + self.pane) // 1000)


class FollowedBy(StatefulProcessor):
    """A ``first`` event directly followed by a ``second`` one of the same key.

    Rows wait until the watermark has passed their bucket of event time, so that what counts as directly following does
    not depend on arrival order.  Each step of a key costs a few calls to its state however many rows or buckets it has:
    a batch's rows are appended in one, and a key's timer, set to its earliest bucket, reads what waits in one, goes
    through all buckets that are over and leaves the later rows.  The last event is forgotten when nothing can follow it
    in time any more.
    """

    def __init__(self, first: str, second: str, within_seconds: int, message: str) -> None:
        self.first, self.second = first, second
        self.within = within_seconds * 1_000_000
        self.bucket = min(self.within, 60_000_000)
        self.message = message

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "micros bigint, tie bigint, kind string")
        self.last = handle.getValueState("last", "micros bigint, kind string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        added = [(row["micros"], row["tie"], row["kind"]) for row in rows]
        self.waiting.appendList(added)
        self.handle.registerTimer(self._end(min(micros for micros, _, _ in added)))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        before = tuple(self.last.get()) if self.last.exists() else None
        waiting = [tuple(event) for event in self.waiting.get()] if self.waiting.exists() else []
        over = [event for event in waiting if self._end(event[0]) <= now]
        if not over:
            if before is not None and before[0] + self.within <= now * 1000:
                self.last.clear()
            return
        for micros, _, kind in sorted(over, key=lambda e: (e[0], e[1] is not None, e[1])):
            if (
                before is not None
                and before[1] == self.first
                and kind == self.second
                and micros - before[0] < self.within
            ):
                yield Row(user_id=key[0], first_micros=before[0], second_micros=micros, message=self.message)
            before = (micros, kind)
        if len(over) < len(waiting):
            later = [event for event in waiting if self._end(event[0]) > now]
            self.waiting.put(later)
            self.handle.registerTimer(self._end(min(micros for micros, _, _ in later)))
        else:
            self.waiting.clear()
        self.last.update(before)
        # a later row's timer reads it before this one forgets it
        self.handle.registerTimer(self._end(before[0] + self.within + self.bucket))

    def _end(self, micros: int) -> int:
        """When the bucket of a time is over, in milliseconds."""
        return (micros // self.bucket + 1) * self.bucket // 1000

    def close(self) -> None:
        pass
