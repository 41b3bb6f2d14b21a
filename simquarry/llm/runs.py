"""Periodic runs of words: stretches that repeat themselves.

A run holds each of its words at least twice, so a word that stands in a segment
once splits it: no run crosses that word.  Splitting makes segments shorter and
words in them rarer, and goes on until nothing changes or a segment is too short
for any run.  What survives is scanned lag by lag: a run of period q and length
2q or more covers two neighbouring multiples of q, so for each lag only the
places at its multiples are extended to both sides, by tables of equal factors
of 1, 2, 4, ... words.  Nothing is hashed, and a text of n words costs n log² n
whatever it says.

Documents stay where they are; the splitting looks at all texts of a batch at
once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simquarry.llm.bpe import slices

SHORTEST = 12  # words of a run, and at least two periods
ANCHORS = 1 << 20  # places that are extended together


def split_segments(words: np.ndarray, starts: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int]]:
    """Segments (begin, end) of ``words`` in which every word stands twice or more.

    ``starts`` are the places where texts begin; no segment crosses one.
    """
    at = np.arange(len(words))
    cut = np.zeros(len(words), bool)
    cut[starts[starts < len(words)]] = True
    segment = np.cumsum(cut) - 1
    while len(at):
        # Words of a segment side by side: a rare one differs from both neighbours.
        order = np.lexsort((words[at], segment))
        w, s = words[at][order], segment[order]
        same = (w[1:] == w[:-1]) & (s[1:] == s[:-1])
        often = np.zeros(len(at), bool)
        often[order] = np.concatenate((same, [False])) | np.concatenate(([False], same))
        kept, label = at[often], segment[often]
        new = np.ones(len(kept), bool)
        new[1:] = (kept[1:] != kept[:-1] + 1) | (label[1:] != label[:-1])
        label = np.cumsum(new) - 1
        long = np.bincount(label, minlength=1)[label] >= shortest if len(kept) else np.zeros(0, bool)
        if often.all() and long.all():
            break
        at, segment = kept[long], label[long]
    if not len(at):
        return []
    first = np.concatenate(([True], segment[1:] != segment[:-1]))
    begins = at[first]
    return list(zip(begins.tolist(), (begins + np.diff(np.append(np.flatnonzero(first), len(at)))).tolist(), strict=True))


class Factors:
    """Names of the factors of 1, 2, 4, ... words at each place: equal names, equal factors."""

    def __init__(self, words: np.ndarray) -> None:
        self.n = n = len(words)
        self.levels = [np.unique(words, return_inverse=True)[1].astype(np.int32)]
        size = 1
        while 2 * size <= n // 2:
            last = self.levels[-1].astype(np.int64)
            pair = last[: n - 2 * size + 1] * n + last[size : n - size + 1]
            self.levels.append(np.unique(pair, return_inverse=True)[1].astype(np.int32))
            size *= 2

    def ahead(self, a: np.ndarray, lag: np.ndarray) -> np.ndarray:
        """How many words from ``a`` on equal those ``lag`` later."""
        return self._extend(a, lag, forward=True)

    def back(self, a: np.ndarray, lag: np.ndarray) -> np.ndarray:
        """How many words before ``a`` equal those ``lag`` later."""
        return self._extend(a, lag, forward=False)

    def _extend(self, a: np.ndarray, lag: np.ndarray, forward: bool) -> np.ndarray:
        length = np.zeros(len(a), np.int64)
        # The longest factors may fit several times, the others once.
        for level in range(len(self.levels) - 1, -1, -1):
            names, size = self.levels[level], 1 << level
            going = np.arange(len(a))
            while len(going):
                begin = a[going] + length[going] if forward else a[going] - length[going] - size
                fits = (begin >= 0) & (begin + lag[going] + size <= self.n)
                going, begin = going[fits], begin[fits]
                going = going[names[begin] == names[begin + lag[going]]]
                length[going] += size
                if level < len(self.levels) - 1:
                    break
        return length


def lag_scan(words: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """All runs (start, length, smallest period) of ``words``, by start and period."""
    n = len(words)
    factors = Factors(words)
    found: dict[tuple[int, int], int] = {}
    lags = np.arange(1, n // 2 + 1)
    ends = np.cumsum((n - 1) // lags)  # a lag has so many places, each with its partner
    at = 0
    while at < len(lags):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + ANCHORS, "right")))
        count = (n - 1) // lags[at:to]
        lag = np.repeat(lags[at:to], count)
        place = lag * (np.arange(len(lag)) - np.repeat(np.cumsum(count) - count, count))
        behind, ahead = factors.back(place, lag), factors.ahead(place, lag)
        start, length = place - behind, behind + ahead + lag
        runs = (ahead + behind > 0) & (length >= np.maximum(shortest, 2 * lag))
        # A multiple of the period finds the same run again: the least lag stands.
        for s, size, q in set(zip(start[runs].tolist(), length[runs].tolist(), lag[runs].tolist(), strict=True)):
            found[s, size] = min(q, found.get((s, size), q))
        at = to
    return sorted((s, size, q) for (s, size), q in found.items())


def repeated_tail(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """First word and period of the planted tail of a document of ``n`` words; None if it has none or no id."""
    if doc_id is None:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def find_runs(texts: list[list[bytes]], shortest: int = SHORTEST) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words."""
    flat = pa.array(chain.from_iterable(texts), pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum([0, *map(len, texts)])
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for begin, end in split_segments(flat, starts[:-1], shortest):
        text = int(np.searchsorted(starts, begin, "right")) - 1
        shift = begin - int(starts[text])
        found[text] += [(s + shift, size, q) for s, size, q in lag_scan(flat[begin:end], shortest)]
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """``words`` without those that a run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


RUN = "struct<start: bigint, length: bigint, period: bigint>"


def periodic_runs(docs: DataFrame, keep: list[str] | None = None, plant: bool = False, shortest: int = SHORTEST) -> DataFrame:
    """The columns ``keep`` (doc_id), ``runs`` by start and period, and the ``collapsed`` text.

    A run is a longest stretch of words with smallest period q and at least
    ``shortest`` words and two periods; runs may overlap.  In the collapsed text
    words are joined by one space, and a word goes if any run holds it after the
    run's first period.  Null, empty and blank texts have no runs and collapse
    to the empty text.  ``plant`` first replaces the end of a tenth of all texts,
    chosen by doc_id, by repetitions.  Rows are independent of one another, so
    repeated rows and ids change nothing; other columns are not looked at.
    """
    keep = keep or ["doc_id"]
    by_id = [F.col("doc_id").cast("long").alias("__id")] if plant else []
    asked = docs.select(*keep, F.col("text").alias("__text"), *by_id)
    schema = docs.select(*keep, F.lit(None).cast(f"array<{RUN}>").alias("runs"), F.lit("").alias("collapsed")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in slices(batches, "__text"):
            # bytes.split() knows exactly the six blanks.
            texts = [t.encode().split() if t else [] for t in batch.column("__text").to_pylist()]
            if plant:
                for k, doc_id in enumerate(batch.column("__id").to_pylist()):
                    tail = repeated_tail(doc_id, len(texts[k]))
                    if tail:
                        a, p = tail
                        words = texts[k]
                        texts[k] = [*words[:a], *(words[a + i % p] for i in range(len(words) - a))]
            found = find_runs(texts, shortest)
            left = [b" ".join(collapsed(words, runs)).decode() for words, runs in zip(texts, found, strict=True)]
            named = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(named, kind), pa.array(left, pa.string())], names=[*keep, "runs", "collapsed"]
            )

    return asked.mapInArrow(run, schema)
