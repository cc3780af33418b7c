"""Projects that wait in line: each crawler works on one, and the next begins when nothing has happened for a while.

Rows are (crawler, ts, kind, project): kind ``queue`` puts a project in the crawler's line, any other kind says that something happened to the
project.  Times are event times.  A timer stands at the last event of the running project plus the gap; when the watermark
passes it, the project is idle and the first project in line begins at that time.  The line is kept as numbered entries of
map state, so that it may be long: an event or a timer reads a few entries of it."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "crawler string, project string, event string, at timestamp"


class IdleQueue(StatefulProcessor):
    """Gives (crawler, project, event, at) with event start or idle."""

    def __init__(self, gap_ms: int) -> None:
        self.gap = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.line = handle.getMapState("line", "n long", "project string")
        #: first and next number in line, the running project (null: none), when it was last heard of
        self.head = handle.getValueState("head", "first long, next long, project string, last long")

    def _start(self, key: str, at: int, first: int, end: int) -> tuple[list[tuple], int, str | None]:
        """The first project in line begins; gives rows, the line's new first number and the project."""
        if first == end:
            return [], first, None
        project = self.line.getValue((first,))[0]
        self.line.removeKey((first,))
        self.handle.registerTimer(at + self.gap)
        return [(key, project, "start", at)], first + 1, project

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first, end, project, last = self.head.get() if self.head.exists() else (0, 0, None, 0)
        events = pd.concat(list(rows)).sort_values(["ts", "kind", "project"], kind="stable")
        out: list[tuple] = []
        for ts, kind, name in zip(events["ts"], events["kind"], events["project"], strict=True):
            at = int(ts.timestamp() * 1000)
            if kind == "queue":
                self.line.updateValue((end,), (name,))
                end += 1
                if project is None:
                    began, first, project = self._start(key[0], at, first, end)
                    out, last = out + began, at
            elif name == project and at > last:
                self.handle.deleteTimer(last + self.gap)
                self.handle.registerTimer(at + self.gap)
                last = at
        self.head.update((first, end, project, last))
        yield _frame(out)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        first, end, project, last = self.head.get()
        at = expiredTimerInfo.getExpiryTimeInMs()
        out = []
        if project is not None and at == last + self.gap:
            began, first, following = self._start(key[0], at, first, end)
            out = [(key[0], project, "idle", at), *began]
            self.head.update((first, end, following, at))
        yield _frame(out)

    def close(self) -> None:
        pass


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["crawler", "project", "event", "at"])
    out["at"] = pd.to_datetime(out["at"], unit="ms")
    return out


def next_when_idle(events: DataFrame, *, gap: str = "10 minutes", late: str = "1 minute") -> DataFrame:
    """(crawler, project, event, at): when projects begin, and when they are found idle.

    events: a stream of (crawler string, ts timestamp, kind string, project string).  Rows later than the watermark are left out.  The state store must
    have timers: set spark.sql.streaming.stateStore.providerClass to the RocksDB provider."""
    gap_ms = int(pd.Timedelta(gap).total_seconds() * 1000)
    rows = events.select("crawler", "ts", "kind", "project").withWatermark("ts", late)
    return rows.groupBy("crawler").transformWithStateInPandas(statefulProcessor=IdleQueue(gap_ms), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime")
