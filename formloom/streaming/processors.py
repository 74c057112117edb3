"""Keyed state of the streams: folds, sequencing buffers and panels of votes.

All work in event time, to the millisecond, as watermarks do.  A key's open rows
(those the watermark has not passed) are held in the state store row by row;
when the watermark passes them they are folded into one small value.  Keys that
stay silent are forgotten by a timer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from formloom.operators.logs import GENESIS, line_text


def millis(times: pd.Series) -> list[int]:
    return (times.astype("datetime64[ms]").astype("int64")).tolist()


def step(status: str, attempts: int, action: str, max_attempts: int) -> tuple[str, int]:
    """An item's state after one more action."""
    if action == "begin":
        return "IN_PROGRESS", attempts + 1
    if action == "ok":
        return "DONE", attempts
    if action == "error":
        return ("DEAD" if attempts >= max_attempts else "FAILED"), attempts
    if action == "retry" and status == "FAILED":
        return "PENDING", attempts
    if action == "reset":
        return "PENDING", 0
    return status, attempts


class Timed(StatefulProcessor):
    """A key with a list of open rows, whose first two columns are time and id."""

    open_schema = "ms bigint, id bigint"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", self.open_schema)
        self.due = handle.getValueState("due", "ms bigint")

    def hold(self, rows: Iterable[pd.DataFrame], columns: list[str]) -> int | None:
        """Add arriving rows to the open ones; the latest time among them."""
        latest = None
        for part in rows:
            if len(part):
                at = millis(part["ts"])
                self.open.appendList(list(zip(at, *(part[c].tolist() for c in columns))))
                latest = max(at) if latest is None else max(latest, *at)
        return latest

    def opened(self) -> list[tuple]:
        """Open rows in their order; repeated deliveries count once."""
        return sorted(set(map(tuple, self.open.get()))) if self.open.exists() else []

    def wake(self, ms: int) -> None:
        """Set the key's one timer.  Timers before the watermark fire, so it
        is set a millisecond early."""
        if self.due.exists():
            old = self.due.get()[0]
            if old == ms:
                return
            self.handle.deleteTimer(old - 1)
        self.due.update((ms,))
        self.handle.registerTimer(ms - 1)

    def leave(self, rows: list[tuple]) -> None:
        if rows:
            self.open.put(rows)
        else:
            self.open.clear()

    def close(self) -> None:
        pass


class RunFold(Timed):
    """Item states.  What the watermark has passed is folded; open actions are
    folded on top for each answer, in their order, so late ones find their
    place.  ``keep_ms`` after its last action an item is forgotten."""

    open_schema = "ms bigint, id bigint, action string"

    def __init__(self, max_attempts: int, keep_ms: int):
        self.max_attempts, self.keep_ms = max_attempts, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.folded = handle.getValueState("folded", "status string, attempts bigint, last bigint")

    def _state(self) -> tuple[str, int, int]:
        return tuple(self.folded.get()) if self.folded.exists() else ("PENDING", 0, 0)

    def _settle(self, watermark: int) -> list[tuple]:
        """Fold what the watermark has passed; the rows that are still open."""
        rows = self.opened()
        passed = [r for r in rows if r[0] <= watermark]
        if passed:
            status, attempts, last = self._state()
            for ms, _, action in passed:
                status, attempts = step(status, attempts, action, self.max_attempts)
                last = max(last, ms)
            self.folded.update((status, attempts, last))
            self.leave(rows[len(passed) :])
        return rows[len(passed) :]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self.hold(rows, ["event_id", "action"])
        still = self._settle(timerValues.getCurrentWatermarkInMs())
        status, attempts, last = self._state()
        for _, _, action in still:
            status, attempts = step(status, attempts, action, self.max_attempts)
        self.wake(max([last, *(r[0] for r in still)]) + self.keep_ms)
        yield pd.DataFrame({"item": [key[0]], "status": [status], "attempts": [attempts]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # The key's last action is long past, so nothing of it is open.
        for state in (self.folded, self.open, self.due):
            state.clear()
        return iter(())


class ChainLinks(Timed):
    """Chain lines.  Entries wait until the watermark has passed them and are
    then linked in the order of time and id, whatever batch brought them."""

    open_schema = "ms bigint, id bigint, payload string"

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.end = handle.getValueState("end", "seq bigint, hash string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self.hold(rows, ["order_id", "payload"])
        waiting = self.opened()
        if waiting:
            self.wake(waiting[0][0])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        waiting = self.opened()
        passed = [r for r in waiting if r[0] <= watermark]
        seq, last = tuple(self.end.get()) if self.end.exists() else (0, GENESIS)
        out = {"log_key": [], "seq": [], "payload": [], "prev_hash": [], "line_hash": []}
        for _, _, payload in passed:
            line = hashlib.sha256(line_text(seq, last, payload).encode()).hexdigest()
            for column, value in zip(out.values(), (key[0], seq, payload, last, line)):
                column.append(value)
            seq, last = seq + 1, line
        self.end.update((seq, last))
        self.leave(waiting[len(passed) :])
        self.due.clear()
        if len(waiting) > len(passed):
            self.wake(waiting[len(passed)][0])
        if passed:
            yield pd.DataFrame(out)


class Panel(StatefulProcessor):
    """The latest vote of each voter on a key, and the consensus over them.
    ``keep_ms`` after its last vote a key is forgotten."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.votes = handle.getMapState("votes", "voter string", "ms bigint, event_id bigint, verdict string")
        self.due = handle.getValueState("due", "ms bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        latest = {v[0]: tuple(s) for v, s in self.votes.iterator()} if self.votes.exists() else {}
        for part in rows:
            for voter, *vote in zip(part["voter"], millis(part["ts"]), part["event_id"].tolist(), part["verdict"]):
                if voter not in latest or tuple(vote[:2]) > latest[voter][:2]:
                    latest[voter] = tuple(vote)
                    self.votes.updateValue((voter,), tuple(vote))
        said = [verdict for _, _, verdict in latest.values()]
        due = max(ms for ms, _, _ in latest.values()) + self.keep_ms
        if self.due.exists():
            self.handle.deleteTimer(self.due.get()[0])
        self.due.update((due,))
        self.handle.registerTimer(due)
        yield pd.DataFrame({"key": [key[0]], "n_major": [said.count("major")], "n_minor": [said.count("minor")]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.votes.clear()
        self.due.clear()
        return iter(())

    def close(self) -> None:
        pass
