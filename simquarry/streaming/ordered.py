"""Streams whose events of a key are taken in event time, in whatever order they come.

Events wait in keyed state until the watermark has passed them; then they go, by
time and number, through a step function that changes the state of their key.
So the result does not depend on how the input was cut into micro-batches, as
long as no event is later than the declared lateness.
"""

from __future__ import annotations

import pickle
from collections import namedtuple
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta
from itertools import batched, chain
from operator import itemgetter
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, StructField, StructType

# (state or None, event) -> (new state, rows to give out)
Step = Callable[[Any, Row], tuple[Any, list[Row]]]
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EPOCH = datetime(1970, 1, 1)
PACK = 1000  # events of a key in one element of its state, and in one row given out


def to_time(micros: int | None) -> datetime | None:
    """Microseconds since 1970 as a time of UTC without a zone."""
    return None if micros is None else EPOCH + timedelta(microseconds=micros)


def to_micros(ts: datetime | None) -> int | None:
    return None if ts is None else (ts - EPOCH) // timedelta(microseconds=1)


def _millis(micros: int) -> int:
    """The first whole millisecond that is not before."""
    return -(-micros // 1000)


class _InOrder(StatefulProcessor):
    """Events of a key wait packed, up to ``PACK`` in one element, and rows go out as arrays of so many.

    An element and a row cost far more than an event in them: each is turned from
    Python to Java or back by itself.
    """

    def __init__(self, step: Step, events: StructType, state: StructType, output: StructType) -> None:
        self.step, self.events, self.state, self.output = step, events, state, output

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "packed binary")
        self.now = handle.getValueState("now", self.state)
        self.timer = handle.getValueState("timer", "at long")
        names = self.events.fieldNames()
        self.event = namedtuple("Event", names)._make
        self.micros, self.place = itemgetter(names.index("micros")), itemgetter(names.index("micros"), names.index("seq"))

    def _call_at(self, at: int) -> None:
        """One timer a key, at the earliest event that waits."""
        due = self.timer.get()
        if due is None or at < due[0]:
            if due is not None:
                self.handle.deleteTimer(due[0])
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def _packed(self, rows: Iterator[tuple]) -> tuple[list[tuple[bytes]], int]:
        """Elements of the state for these events, and the time of the first."""
        packed, first = [], None
        for part in batched(rows, PACK):
            packed.append((pickle.dumps(part, pickle.HIGHEST_PROTOCOL),))
            least = min(map(self.micros, part))
            first = least if first is None else min(first, least)
        return packed, _millis(first)

    def _given(self, rows: list[Row]) -> Iterator[Row]:
        names = self.output.fieldNames()
        for part in batched(rows, PACK):
            order = [part[0].__fields__.index(n) for n in names]
            columns = list(zip(*part, strict=True))
            yield Row(**{n: list(columns[k]) for n, k in zip(names, order, strict=True)})

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        first = next(rows)
        pick = itemgetter(*(first.__fields__.index(n) for n in self.events.fieldNames()))
        packed, at = self._packed(pick(tuple(r)) for r in chain((first,), rows))
        self.waiting.appendList(packed)
        self._call_at(at)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        self.timer.clear()
        over = timerValues.getCurrentWatermarkInMs() * 1000
        ready, left = [], []
        for (packed,) in self.waiting.get():
            for event in pickle.loads(packed):
                (ready if self.micros(event) <= over else left).append(event)
        ready.sort(key=self.place)
        state, out = self.now.get(), []
        for event in map(self.event, ready):
            state, given = self.step(state, event)
            out += given
        if ready:
            self.now.update(state)
        if left:
            packed, at = self._packed(left)
            self.waiting.put(packed)
            self._call_at(at)
        else:
            self.waiting.clear()
        return self._given(out)

    def close(self) -> None:
        pass


def in_order(events: DataFrame, key: str, step: Step, state: str, output: str, lateness: str) -> DataFrame:
    """What ``step`` gives out for the stream ``events`` (key, ts, seq, ...), key by key in the order of (ts, seq).

    Events reach ``step`` with ``micros``, microseconds since 1970, in place of ``ts``.
    An event that comes more than ``lateness`` after a younger one of the stream
    may find the watermark past it; Spark then drops it and counts it in the
    progress of the query (numRowsDroppedByWatermark).  Memory follows the events
    within that time, which wait in the state store on disk.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("micros", F.unix_micros("ts")).withWatermark("ts", lateness)
    kept = StructType([f for f in timed.schema.fields if f.name != "ts"])
    given = StructType.fromDDL(output)
    arrays = StructType([StructField(f.name, ArrayType(f.dataType)) for f in given.fields])
    out = timed.groupBy(key).transformWithState(_InOrder(step, kept, StructType.fromDDL(state), given), arrays, "Append", "EventTime")
    return out.select(F.inline(F.arrays_zip(*given.fieldNames())))
