"""Failure and recovery alerts of repeated jobs as a stream.

State of a label: failures in a row, since when, when an alert was delivered,
and, if a recovery message did not get through, the count it will report.  The
state moves on delivered messages only, so an undelivered one is tried again.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from simquarry.streaming.ordered import in_order, to_micros, to_time

_OUTPUT = "label string, micros long, seq long, kind string, failures long, since long, delivered boolean"
_STATE = "failures long, first_failure long, alerted_at long, parked long"
_EMPTY = (0, None, None, None)


def advance(state: tuple, ts: datetime, exit_code: int, delivered: bool, threshold: int, repeat_hours: float):
    """State after one run, and the message it gave rise to, if any.

    A message is (kind, failures, since).  ``parked`` is set after a recovery
    message that was not delivered; a failure then starts a new episode.
    """
    failures, first, alerted, parked = state
    at = ts.replace(microsecond=0)
    if exit_code == 0:
        if alerted is None:
            return (0, None, None, None), None
        count = parked or failures
        message = ("recovered", count, first)
        if delivered:
            return (0, None, None, None), message
        return (0, first, alerted, count), message
    if parked is not None:
        failures, first, alerted = 0, None, None
    failures, first = failures + 1, first if first is not None else at
    message = None
    if failures >= threshold and (
        alerted is None or (repeat_hours > 0 and at - alerted >= timedelta(hours=repeat_hours))
    ):
        message = ("failed", failures, first)
        if delivered:
            alerted = at
    return (failures, first, alerted, None), message


def alert_stream(runs: DataFrame, threshold: int = 3, repeat_hours: float = 24, lateness: str = "1 day") -> DataFrame:
    """Messages of a stream of runs (label, ts, seq, exit_code, delivered).

    ``delivered`` is the sender's receipt for a message about this run, so the
    stream can be replayed.  Runs of a label are taken in the order of (ts, seq)
    once the watermark has passed them, so their messages are those of
    ``operators.alerts.alerts`` however the input is cut, as long as no run is
    more than ``lateness`` behind.
    """

    def step(state: tuple | None, run: Row) -> tuple[tuple, list[Row]]:
        failures, first, alerted, parked = state or _EMPTY
        now, message = advance((failures, to_time(first), to_time(alerted), parked), to_time(run.micros), run.exit_code, bool(run.delivered), threshold, repeat_hours)
        after = (now[0], to_micros(now[1]), to_micros(now[2]), now[3])
        if message is None:
            return after, []
        kind, count, since = message
        return after, [Row(label=run.label, micros=run.micros, seq=run.seq, kind=kind, failures=count, since=to_micros(since), delivered=run.delivered)]

    typed = runs.selectExpr("label", "ts", "cast(seq as long) as seq", "cast(exit_code as int) as exit_code", "delivered")
    told = in_order(typed, "label", step, _STATE, _OUTPUT, lateness)
    return told.select("label", F.timestamp_micros("micros").alias("ts"), "seq", "kind", "failures", F.timestamp_micros("since").alias("since"), "delivered")
