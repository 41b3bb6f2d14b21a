"""Streams cut at different places against one replay of all events."""

import datetime as dt
import random
import types

import pytest
from pyspark.sql import Row
from pyspark.sql.types import StructType

from simquarry.operators.alerts import alerts, failure_episodes
from simquarry.operators.bundles import latest_outcomes
from simquarry.operators.intake import parse_tickets, settle_jobs
from simquarry.streaming.alerts import _EMPTY, advance, alert_stream
from simquarry.streaming.intake import complete_tickets, completion_stream, current_jobs, job_step, job_stream, outcome_stream, take_markers
from simquarry.streaming import ordered, views
from simquarry.streaming.run import closing, drain

T0 = dt.datetime(2024, 1, 1)


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def stream_of(spark, tmp_path, schema, slices):
    """One file, hence one micro-batch, per slice."""
    folder = tmp_path / f"in{random.getrandbits(40)}"
    for k, part in enumerate(slices):
        pdf = spark.createDataFrame(part, schema).coalesce(1)
        pdf.write.mode("append").parquet(str(folder / f"s{k:03}"))
    files = sorted(folder.glob("*/*.parquet"))
    for k, f in enumerate(files):
        import os

        os.utime(f, (10**9 + k, 10**9 + k))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder / "*"))


def cut(items, n):
    step = max(1, len(items) // n)
    return [items[k : k + step] for k in range(0, len(items), step)]


RUNS = "label string, ts timestamp_ntz, seq long, exit_code int, delivered boolean"


def make_runs(seed, labels=4, n=260):
    rnd = random.Random(seed)
    out, at = [], T0
    for seq in range(n):
        at += dt.timedelta(seconds=rnd.choice([30, 3600, 3600 * 5, 3600 * 11]), microseconds=rnd.randrange(10**6))
        label = f"j{min(rnd.randrange(labels * 2), labels - 1)}"
        # Long runs of failures, so that alerts repeat.
        fail = rnd.random() < (0.97 if label == "j3" else 0.6)
        out.append((label, at, seq, 1 if fail else 0, rnd.random() < 0.7))
    return out


def replay(runs, threshold, hours):
    state, out = {}, []
    for label, ts, seq, code, delivered in sorted(runs, key=lambda r: (r[1], r[2])):
        state[label], message = advance(state.get(label, _EMPTY), ts, code, delivered, threshold, hours)
        if message:
            kind, failures, since = message
            out.append((label, ts, seq, kind, failures, since, delivered))
    return sorted(out, key=str)


COLS = ["label", "ts", "seq", "kind", "failures", "since", "delivered"]


@pytest.mark.parametrize("threshold, hours", [(3, 24), (1, 0), (2, 6), (1, 0.5)])
def test_alerts_in_batch_form(make, threshold, hours):
    runs = make_runs(threshold)
    got = alerts(make(RUNS, *runs).repartition(6), threshold, hours)
    want = replay(runs, threshold, hours)
    assert rows(got, *COLS) == want
    assert {w[3] for w in want} == {"failed", "recovered"}


def plain(records):
    return sorted(((r[0], r[1].replace(tzinfo=None), *r[2:5], r[5].replace(tzinfo=None) if r[5] else None, r[6]) for r in records), key=str)


@pytest.mark.parametrize(("parts", "mixed"), [(1, False), (7, False), (8, True)])
def test_alerts_as_a_stream(spark, make, tmp_path, parts, mixed):
    """One file a trigger, also in no order of time, gives the messages of the batch form."""
    runs = make_runs(9, n=140)
    cuts = cut(runs, parts)
    if mixed:
        random.Random(2).shuffle(cuts)
        cuts = [random.Random(k).sample(c, len(c)) for k, c in enumerate(cuts)]
    stream, close = closing(stream_of(spark, tmp_path, RUNS, cuts))
    out = drain(alert_stream(stream, 2, 12, lateness="100 days"), close=close)
    got = plain(tuple(r) for r in out.select(COLS).collect())
    assert got == replay(runs, 2, 12) == plain(tuple(r) for r in alerts(make(RUNS, *runs), 2, 12).select(COLS).collect())


def test_messages_follow_the_watermark(spark, tmp_path):
    """Without an end, runs wait as long as an earlier one may come; later than that, a run is dropped."""
    hour = lambda h: T0 + dt.timedelta(hours=h)
    slices = [[("a", hour(5), 5, 1, True), ("a", hour(6), 6, 1, True)], [("a", hour(4), 4, 1, True)], [("a", hour(10), 10, 1, True)], [("a", hour(1), 1, 0, True), ("a", hour(11), 11, 1, True)]]
    told = rows(drain(alert_stream(stream_of(spark, tmp_path, RUNS, slices), 3, 1, lateness="3 hours")), "seq", "kind", "failures")
    assert told == [(6, "failed", 3)]
    stream, close = closing(stream_of(spark, tmp_path, RUNS, slices))
    told = rows(drain(alert_stream(stream, 3, 1, lateness="3 hours"), close=close), "seq", "kind", "failures")
    assert told == [(10, "failed", 4), (11, "failed", 5), (6, "failed", 3)]


def test_alert_rules():
    """The cases of the rules, one by one."""
    t = lambda h: T0 + dt.timedelta(hours=h)
    state, said = _EMPTY, []
    for h, code, ok in [(0, 1, True), (1, 1, True), (2, 0, True), (3, 1, True), (4, 1, True), (5, 1, False), (6, 1, True), (7, 1, True), (31, 1, True), (32, 0, False), (33, 0, True), (34, 0, True)]:
        state, message = advance(state, t(h), code, ok, 3, 24)
        if message:
            said.append((h, message[0], message[1]))
    assert said == [(5, "failed", 3), (6, "failed", 4), (31, "failed", 6), (32, "recovered", 6), (33, "recovered", 6)]
    # A failure after an undelivered recovery opens a new episode.
    state, _ = advance((0, t(0), t(0), 4), t(2), 1, True, 3, 24)
    assert state == (1, t(2), None, None)


def test_episodes(make):
    h = lambda k: T0 + dt.timedelta(hours=k * 9)
    df = make(RUNS, *[("a", h(k), k, c, True) for k, c in enumerate([1, 1, 0, 0, 1, 0, 1])])
    assert rows(failure_episodes(df), "island", "first_failure", "failures", "recovered") == [
        (0, h(0), 2, True), (2, h(4), 1, True), (3, h(6), 1, False),
    ]


def test_completion(spark, make, tmp_path):
    mark = "mdrepo-submission.completed.json"
    tickets = make("id long, irods_tickets string", (1, "MDRSubmit_a:/a;MDRSubmit_b:/b"), (2, "MDRSubmit_b:/b;MDRSubmit_c:/c"), (3, "MDRSubmit_d:/d;bad"), (4, None), (5, "MDRSubmit_e:/e"), (6, "MDRSubmit_a:/a;MDRSubmit_a:/a"))
    slices = [[("/a", mark, 5)], [("/a", mark, 5), ("/b", mark, 0)], [("/b", mark, 7), ("/d", mark, 1)], [("/b", mark, 7), ("/a", mark, 5), ("/e", "x", 3)]]
    markers = stream_of(spark, tmp_path, "collection string, name string, size int", slices)
    path = str(tmp_path / "told")
    completion_stream(parse_tickets(tickets), markers, path).awaitTermination()
    assert rows(complete_tickets(spark, path)) == [(1, 2), (3, 1), (6, 2)]


def test_state_of_completed_tickets_ends(spark, make, tmp_path):
    """What is left in the end is the landings of the open ticket."""
    mark = "mdrepo-submission.completed.json"
    tickets = make("id long, irods_tickets string", *[(t, ";".join(f"MDRSubmit_{t}{c}:/{t}{c}" for c in "abc")) for t in range(20)], (99, "MDRSubmit_x:/x;MDRSubmit_y:/y;MDRSubmit_z:/z"))
    slices = [[*((f"/{t}{c}", mark, 5) for t in range(20) for c in "ab"), ("/x", mark, 5)], [(f"/{t}c", mark, 5) for t in range(20)], [("/y", mark, 5)], [("/none", mark, 5)]]
    markers = stream_of(spark, tmp_path, "collection string, name string, size int", slices)
    path = str(tmp_path / "told")
    completion_stream(parse_tickets(tickets), markers, path).awaitTermination()
    held = [spark.read.parquet(f"{path}/open/batch={k}").count() for k in range(4)]
    assert held == [41, 1, 2, 2]
    want = [(t, 3) for t in range(20)]
    assert rows(complete_tickets(spark, path)) == sorted(want, key=str)
    # A batch that runs again, and markers listed again, change nothing.
    again = spark.createDataFrame(slices[1], "collection string, name string, size int")
    for batch in (1, 4):
        take_markers(again, batch, path)
    assert rows(complete_tickets(spark, path)) == sorted(want, key=str)
    assert spark.read.parquet(f"{path}/open/batch=4").count() == 2


def test_outcomes(spark, tmp_path):
    lines = [(k, f"b{k % 7}", "done" if k % 3 else "failed") for k in range(60)]
    log = stream_of(spark, tmp_path, "seq long, bundle string, result string", cut(lines, 5))
    view = latest_outcomes(drain(outcome_stream(log), "update"))
    assert rows(view, "bundle", "seq") == sorted((f"b{j}", max(k for k in range(60) if k % 7 == j)) for j in range(7))


def test_a_maintained_view(spark, tmp_path):
    """Only touched buckets get a new version, and a batch that runs again changes nothing."""
    lines = [(k * 7 % 60, f"b{k % 23}", "done" if k % 3 else "failed") for k in range(60)]
    slices = [*cut(lines[:50], 4), [(100, "b3", "late")], lines[50:]]
    log = stream_of(spark, tmp_path, "seq long, bundle string, result string", slices)
    path = str(tmp_path / "view")
    views.maintain(log, path, "bundle", ["seq"], buckets=8).awaitTermination()
    want = sorted({b: max((s, r) for s, c, r in [*lines, (100, "b3", "late")] if c == b) for _, b, _ in lines}.items())
    seen = lambda: sorted((r["bundle"], (r["seq"], r["result"])) for r in views.read_view(spark, path, log.schema).collect())
    assert seen() == want
    written = {p.name: sorted(x.name for x in p.glob("bucket=*")) for p in (tmp_path / "view" / "rows").iterdir()}
    one = len(slices) - 2
    assert len(written[f"batch={one}"]) == 1 and len(written["batch=0"]) > 3
    again = spark.createDataFrame([(100, "b3", "late")], log.schema)
    views.merge(again, one, path, "bundle", ["seq"], buckets=8)
    assert seen() == want
    # Rows written without their version, as by a batch that failed half way, are not seen.
    spark.createDataFrame([(999, "b3", "x")], log.schema).write.parquet(f"{path}/rows/batch=99/{written[f'batch={one}'][0]}")
    assert seen() == want


EVENTS = "job_id long, ts timestamp_ntz, seq long, kind string, exit_code int, retryable boolean"


@pytest.mark.parametrize(("parts", "mixed"), [(1, False), (6, False), (8, True)])
def test_jobs(spark, tmp_path, parts, mixed):
    rnd = random.Random(4)
    events, at = [], T0
    for seq in range(150):
        at += dt.timedelta(minutes=rnd.choice([1, 4, 30, 200]))
        kind = rnd.choice(["enqueue", "claim", "claim", "end"])
        events.append((rnd.randrange(5), at, seq, kind, rnd.choice([0, 1, 1, None]) if kind == "end" else None, rnd.random() < 0.8))
    state = {}
    for job, ts, _seq, kind, code, retry in events:
        state[job] = job_step(state.get(job), ts, kind, code, retry)
    cuts = cut(events, parts)
    if mixed:
        random.Random(3).shuffle(cuts)
    stream, close = closing(stream_of(spark, tmp_path, EVENTS, cuts))
    out = current_jobs(drain(job_stream(stream, lateness="100 days"), close=close))
    got = {r[0]: tuple(v.replace(tzinfo=None) if isinstance(v, dt.datetime) else v for v in r[1:]) for r in rows(out)}
    assert got == {j: s if s is not None else (None,) * 5 for j, s in state.items()}


@pytest.mark.parametrize("seed", [4, 5])
def test_jobs_in_batch_form(make, seed):
    """The rows that a replay of every event leaves, without a step per event."""
    rnd = random.Random(seed)
    events, at = [], T0
    for seq in range(900):
        at += dt.timedelta(minutes=rnd.choice([0, 1, 4, 30, 200]))
        job, kind = rnd.randrange(60), rnd.choice(["enqueue", "claim", "claim", "end"])
        events.append((job if job < 40 else 0, at, seq, kind, rnd.choice([0, 1, 1, 1, 1, 1, None]) if kind == "end" else None, rnd.choice([True] * 12 + [False, None])))
    events += [(100, T0, 1, "claim", None, None), (101, T0, 2, "enqueue", None, None)]
    state = {}
    for job, ts, _seq, kind, code, retry in events:
        state[job] = job_step(state.get(job), ts, kind, code, bool(retry))
    shuffled = rnd.sample(events, len(events))
    out = settle_jobs(make(EVENTS, *shuffled, (None, T0, 1, "enqueue", None, None), (102, None, 1, "enqueue", None, None)).repartition(5))
    assert {r[0]: tuple(r)[1:] for r in out.collect()} == {j: s if s is not None else (None,) * 5 for j, s in state.items()}
    assert max(s[1] for s in state.values() if s) >= 2
    assert settle_jobs(make(EVENTS, *events).where("false")).collect() == []


class Held:
    """State of one key, as a processor's handle gives it."""

    def __init__(self):
        self.value, self.items, self.timers = None, [], set()

    def getListState(self, *_):
        return self

    def getValueState(self, *_):
        return Value()

    def appendList(self, items):
        self.items += items

    def put(self, items):
        self.items = list(items)

    def get(self):
        return iter(self.items)

    def clear(self):
        self.items = []

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


class Value:
    value = None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


def test_events_wait_and_go_in_packs():
    """2,500 events of a key are three elements of its state and three rows given out, in order."""
    events, out = StructType.fromDDL("k long, seq long, micros long"), StructType.fromDDL("micros long, seq long, n int")
    # Rows may name their fields in another order than the output.
    counted = lambda state, e: (((state or (0,))[0] + 1,), [Row(seq=e.seq, n=(state or (0,))[0] + 1, micros=e.micros)])
    held, over = Held(), types.SimpleNamespace(getCurrentWatermarkInMs=lambda: 2)
    fold = ordered._InOrder(counted, events, StructType.fromDDL("n int"), out)
    fold.init(held)
    row = Row("micros", "k", "seq")
    ready = [(m, s) for m in (0, 1, 1999, 2000) for s in range(625)]
    mixed = random.Random(1).sample(ready, len(ready))
    assert list(fold.handleInputRows((7,), iter([row(m, 7, s) for m, s in mixed]), None)) == []
    assert list(fold.handleInputRows((7,), iter([row(2001, 7, 1)]), None)) == []
    assert len(held.items) == 4 and held.timers == {0}
    given = list(fold.handleExpiredTimer((7,), over, None))
    assert len(given) == 3
    assert [x for g in given for x in zip(g.micros, g.seq, g.n)] == [(m, s, k + 1) for k, (m, s) in enumerate(ready)]
    assert len(held.items) == 1 and 3 in held.timers


def test_job_rules():
    pending = ("pending", 1, 1, None, T0)
    minutes = lambda m: T0 + dt.timedelta(minutes=m)
    assert job_step(pending, minutes(4), "claim", None, False) == pending
    assert job_step(pending, minutes(5), "claim", None, False)[0] == "running"
    running = ("running", 5, None, T0, None)
    assert job_step(running, T0, "end", 1, True) == ("failed", 5, 1, T0, T0)
    assert job_step(("running", 4, None, T0, None), T0, "end", 1, True) == ("pending", 5, 1, None, T0)
    assert job_step(running, T0, "end", None, True)[0:3] == ("failed", 5, None)
    assert job_step(None, T0, "claim", None, False) is None
