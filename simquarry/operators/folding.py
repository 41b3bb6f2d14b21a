"""Ordered folds: a state that each row of a group reads and changes.

Rows are dealt by group and sorted within their partition, then pass one state
machine in Arrow batches.  A group is never held: what stays in memory is the
state, which grows with the distinct things in a group and not with its rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Hashable, Iterator, Sequence
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from simquarry.session import spread

OUT_ROWS = 10_000
ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}


class State(Protocol):
    def step(self, row: dict[str, Any]) -> Sequence[dict[str, Any]]:
        """Take one row in; the rows that it gives rise to."""

    def finish(self) -> Sequence[dict[str, Any]]:
        """What is left to say after the last row of the group."""


def fold(rows: DataFrame, group: str, order: Sequence[str], start: Callable[[Any], State], schema: StructType) -> DataFrame:
    """The rows that ``start(group)`` and its successors give out, group by group in ``order`` (null first)."""
    arrow = pa.schema([(f.name, ARROW[f.dataType.simpleString()]) for f in schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = object()
        at: Any = none
        state: State | None = None
        out: list[dict[str, Any]] = []
        for batch in batches:
            for row in batch.to_pylist():
                if row[group] != at or state is None:
                    if state is not None:
                        out += state.finish()
                    at, state = row[group], start(row[group])
                out += state.step(row)
                if len(out) >= OUT_ROWS:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
                    out = []
        if state is not None:
            out += state.finish()
        yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return spread(rows, group).sortWithinPartitions(group, *order).mapInArrow(run, schema)


class Bearers:
    """Who bears a value now, the least of them first.

    ``bears(item, value)`` tells the truth of the moment.  Entries that are no
    longer true stay in the heap until they come to its top.
    """

    def __init__(self, bears: Callable[[Any, Hashable], bool]) -> None:
        self.bears = bears
        self.heaps: dict[Hashable, list[Any]] = {}
        self.inside: set[tuple[Any, Hashable]] = set()

    def add(self, item: Any, value: Hashable) -> None:
        if (item, value) not in self.inside:
            self.inside.add((item, value))
            heapq.heappush(self.heaps.setdefault(value, []), item)

    def first(self, value: Hashable) -> Any | None:
        heap = self.heaps.get(value, [])
        while heap and not self.bears(heap[0], value):
            self.inside.discard((heapq.heappop(heap), value))
        return heap[0] if heap else None
