"""Numbered messages per key: what is missing, what came late, what came again.

Senders number the messages of a key from 1. The state of a key is the highest number
so far, the open gaps below it as ranges, and counts; it does not grow with
the stream but with the gaps. A number above the highest opens a gap if it leaves any
out; a number within a gap is late and closes it, or part of it; any other is a copy.
The numbers of a key in one batch are taken in order, so late means: after a
batch with a higher number.

When a key has been idle for longer than ``idle`` in event time, a timer gives out its
last state as closed, and forgets it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE = "highest long, gaps array<struct<first:long,last:long>>, late long, copies long, newest long"
REPORT = "key string, highest long, missing long, gaps array<struct<first:long,last:long>>, late long, copies long, closed boolean"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def take(number: int, highest: int, gaps: list[tuple[int, int]]) -> tuple[int, list[tuple[int, int]], str]:
    """The state after one more number, and what the number was: ``next``, ``late`` or ``copy``."""
    if number > highest:
        return number, [*gaps, (highest + 1, number - 1)] if number > highest + 1 else gaps, "next"
    for i, (first, last) in enumerate(gaps):
        if first <= number <= last:
            left = [(first, number - 1)] if first < number else []
            right = [(number + 1, last)] if number < last else []
            return highest, [*gaps[:i], *left, *right, *gaps[i + 1 :]], "late"
    return highest, gaps, "copy"


class GapFinder(StatefulProcessor):
    def __init__(self, idle: timedelta):
        self.idle_ms = int(idle.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("numbers", STATE)

    def _load(self) -> tuple:
        if not self.state.exists():
            return 0, [], 0, 0, 0
        highest, gaps, late, copies, newest = self.state.get()
        return highest, [tuple(g) for g in gaps], late, copies, newest

    @staticmethod
    def _row(key, highest, gaps, late, copies, closed) -> pd.DataFrame:
        missing = sum(b - a + 1 for a, b in gaps)
        listed = [{"first": a, "last": b} for a, b in gaps]
        return pd.DataFrame({"key": [key[0]], "highest": [highest], "missing": [missing], "gaps": [listed], "late": [late], "copies": [copies], "closed": [closed]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        highest, gaps, late, copies, newest = self._load()
        known = newest
        came = pd.concat([r[["number", "at"]] for r in rows], ignore_index=True)
        for number in came["number"].sort_values().tolist():
            highest, gaps, what = take(int(number), highest, gaps)
            late += what == "late"
            copies += what == "copy"
        newest = max(newest, int(came["at"].max().timestamp() * 1000))
        if newest > known:
            if known:
                self.handle.deleteTimer(known + self.idle_ms)
            self.handle.registerTimer(newest + self.idle_ms)
        self.state.update((highest, gaps, late, copies, newest))
        yield self._row(key, highest, gaps, late, copies, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        highest, gaps, late, copies, _ = self._load()
        self.state.clear()
        yield self._row(key, highest, gaps, late, copies, True)

    def close(self) -> None:
        pass


def gaps(messages: DataFrame, idle: timedelta = timedelta(days=1), watermark: str = "1 hour") -> DataFrame:
    """The state of every key that a batch of ``key, number, at`` touches; start it within ``keyed_state``."""
    return (
        messages.withWatermark("at", watermark)
        .groupBy("key")
        .transformWithStateInPandas(GapFinder(idle), REPORT, "Update", "EventTime")
    )


@contextmanager
def keyed_state(spark: SparkSession):
    """The state store that processors with timers need, for queries started inside."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)
