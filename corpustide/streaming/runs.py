"""Streaming forms: deduplicated notices by day, and the state of each item over the runs that saw it."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener


def deduplicated(notices: DataFrame, key: str, stamp: str, late: str = "3 days") -> DataFrame:
    """Each notice once, though overlapping windows read it again; keys are forgotten after ``late``."""
    return notices.withWatermark(stamp, late).dropDuplicatesWithinWatermark([key])


def per_day(notices: DataFrame, stamp: str, kind: str) -> DataFrame:
    """Notices by publication day (UTC) and kind. The stream must carry a watermark."""
    start = F.col("day.start")
    if dict(notices.dtypes)[stamp] != "timestamp_ntz":  # an instant shows its day by the session's zone
        start = F.to_utc_timestamp(start, F.current_timezone())
    counts = notices.groupBy(F.window(stamp, "1 day").alias("day"), kind).agg(F.count("*").alias("n"))
    return counts.select(start.cast("date").alias("day"), kind, "n")


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_ITEMS = "pid array<string>, first_seen array<string>, last_seen array<string>, last_change array<string>, seq array<long>, until array<long>"
_SEEN = f"{_ITEMS}, groups int, timer long"
_OUT = "pid string, first_seen string, last_seen string, last_change string"

#: Groups that the items of a stream lie in.
GROUPS = 1024


class _Seen(StatefulProcessor):
    """State of a group of items, each: when it was first and last seen, when it last changed, the last run's number, and when it is forgotten.

    A call into the state and a frame of rows cost far more than one item's work, so they are paid by the group.
    """

    def __init__(self, forget: int | None, groups: int):
        self.forget, self.groups = forget, groups  # milliseconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("seen", _SEEN)

    def _items(self) -> tuple[dict, int | None]:
        """The group's items by pid, and the timer that is set for it: the first millisecond at which one of them is forgotten."""
        if not self.state.exists():
            return {}, None
        pids, *columns, groups, timer = self.state.get()
        if groups != self.groups:
            raise ValueError(f"the stream began with {groups} groups of items, not {self.groups}")
        return dict(zip(pids, zip(*columns))), timer

    def _keep(self, items: dict, timer: int | None) -> None:
        """The group's state, if any is left, and its timer; ``timer`` is the one that is set."""
        first = min(item[-1] for item in items.values()) + 1 if items and self.forget else None
        if items:
            self.state.update(([*items], *map(list, zip(*items.values())), self.groups, first))
        else:
            self.state.clear()
        if first != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if first is not None:
                self.handle.registerTimer(first)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        items, timer = self._items()
        batch = pd.concat(list(rows)).sort_values("seq", kind="stable")
        told = {}
        for pid, date, seq, status, now in zip(*(batch[c].tolist() for c in ("pid", "date", "seq", "status", "now"))):
            first, last, change, at, until = told[pid] = items.get(pid, (None, None, None, -1, None))
            if seq <= at:
                continue  # a run that was replayed
            if until is not None and now > until:
                first = change = None  # forgotten before this run, whether or not its timer has gone off
            change = date if status != "unchanged" else change
            items[pid] = told[pid] = (first or date, date, change, int(seq), int(now) + self.forget if self.forget else None)
        self._keep(items, timer)
        yield self._rows(told, False)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        items, _ = self._items()
        mark = timerValues.getCurrentWatermarkInMs()
        gone = {pid: item for pid, item in items.items() if item[-1] < mark}
        self._keep({pid: item for pid, item in items.items() if pid not in gone}, None)  # the one that went off is no longer set
        yield self._rows(gone, True)

    def _rows(self, items: dict, gone: bool) -> pd.DataFrame:
        columns = zip(*(item[:3] for item in items.values()))
        row = {"pid": [*items], **dict(zip(("first_seen", "last_seen", "last_change"), columns))}
        return pd.DataFrame(row | {"forgotten": [gone] * len(items)} if self.forget else row)

    def close(self) -> None:
        """Nothing is held beside the state."""


def seen(runs: DataFrame, groups: int = GROUPS) -> DataFrame:
    """first_seen, last_seen and last_change of each item over a stream of runs (pid, date, seq, status), as they come; kept for ever.

    State lies in RocksDB, beside the JVM's heap: the session's provider is set to it. Items lie in ``groups`` groups by a hash.
    A task holds one group's state at a time, with what a batch brings of it, so more items want more groups. A stream keeps the
    number that it began with; another one is an error.
    """
    return _kept(runs.withColumn("now", F.lit(0).cast("long")), None, "None", groups)


def seen_lately(runs: DataFrame, forget: timedelta, late: str = "0 seconds", groups: int = GROUPS) -> DataFrame:
    """As :func:`seen` with runs' times (stamp), of items seen within ``forget``: one that is not seen for longer leaves the state
    (a last row, ``forgotten``) when the watermark, ``late`` behind the newest run, has passed it; seen again it is a new one.

    What an item's rows say does not depend on how runs are cut into batches: a run that comes after the time is up counts as
    the first, though no timer has gone off. Runs that are later than the watermark are dropped.
    """
    timed = runs.withColumn("now", F.unix_millis("stamp")).withWatermark("stamp", late)  # a worker sees times in the session's zone
    return _kept(timed, int(forget.total_seconds() * 1000), "EventTime", groups)


def _kept(runs: DataFrame, forget: int | None, mode: str, groups: int) -> DataFrame:
    runs.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    schema = _OUT + (", forgotten boolean" if forget else "")
    dealt = runs.withColumn("group", F.pmod(F.xxhash64("pid"), F.lit(groups)))
    return dealt.groupBy("group").transformWithStateInPandas(_Seen(forget, groups), schema, "Update", mode)


class Dropped(StreamingQueryListener):
    """Counts what a stream's stateful operators dropped as too late, by batch, from the progress that Spark reports."""

    def __init__(self) -> None:
        self.by_batch: dict[int, int] = {}
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        """Nothing has been dropped yet."""

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.by_batch[p.batchId] = sum(o.numRowsDroppedByWatermark for o in p.stateOperators)

    def onQueryIdle(self, event) -> None:
        """An idle stream drops nothing."""

    def onQueryTerminated(self, event) -> None:
        self.ended.set()
