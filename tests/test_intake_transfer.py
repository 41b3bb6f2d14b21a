"""Intake, queue and transfer rules on small tables."""

import datetime as dt
import math

from pyspark.sql import functions as F

from simquarry.operators import intake, transfer

MARK = "mdrepo-submission.completed.json"
NOW = dt.datetime(2024, 1, 1, 12, 0)


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def test_completeness_cases(make):
    tickets = make(
        "id long, irods_tickets string",
        (1, "MDRSubmit_a:/z/a"),
        (2, "MDRSubmit_b:/z/b;MDRSubmit_c:/z/c"),
        (3, "MDRSubmit_d:/z/d"),
        (4, "garbage"),
        (5, None),
        (6, ""),
        (7, "garbage;MDRSubmit_a:/z/a"),
    )
    objects = make(
        "collection string, name string, size int",
        ("/z/a", MARK, 5039), ("/z/b", MARK, 10), ("/z/c", MARK, 0), ("/z/d", "other", 7),
    )
    out = intake.ticket_completeness(intake.parse_tickets(tickets), objects, tickets.select(F.col("id").alias("ticket_id")))
    assert rows(out) == [
        (1, 1, True), (2, 2, False), (3, 1, False), (4, 0, False), (5, 0, False), (6, 0, False), (7, 1, True),
    ]


def test_ticket_map_keeps_last(make):
    t = make("id long, irods_tickets string", (1, "MDRSubmit_a:/old;MDRSubmit_a:/new;bad"))
    assert rows(intake.ticket_map(t)) == [(1, "a", "/new")]


def test_mark_and_enqueue_twice(make):
    ticket = make("id long, upload_notification_sent boolean", (1, False), (2, False), (3, True))
    complete = make("ticket_id long", (1,), (3,))
    jobs = make("id long, ticket_id long, server string, status string", (9, 3, "prod", "succeeded"))
    marked, queued = intake.mark_and_enqueue(ticket, complete, jobs, "prod", NOW)
    assert rows(marked, "id", "upload_notification_sent", "used_for_upload") == [(1, True, True), (2, False, False), (3, True, False)]
    assert rows(queued, "ticket_id", "status") == [(1, "pending"), (3, "succeeded")]
    again, queue2 = intake.mark_and_enqueue(marked, complete, queued, "prod", NOW)
    assert rows(again) == rows(marked) and rows(queue2) == rows(queued)


def test_claim_back_off(make):
    cases = [(1, 1, False), (1, 6, True), (2, 10, False), (2, 25, True), (3, 30, False), (3, 90, True), (4, 100, False), (4, 200, True), (9, 200, True), (0, None, True)]
    jobs = make(
        "id long, ticket_id long, server string, status string, num_attempts int, created_at timestamp_ntz, finished_at timestamp_ntz, started_at timestamp_ntz",
        *[
            (k, k, f"s{k}", "pending", n, NOW, NOW - dt.timedelta(minutes=m) if m is not None else None, None)
            for k, (n, m, _) in enumerate(cases)
        ],
    )
    got = {r[0] for r in intake.next_jobs(jobs, NOW).select("id").collect()}
    assert got == {k for k, c in enumerate(cases) if c[2]}


def test_backed_off_job_does_not_block_a_newer_one(make):
    jobs = make(
        "id long, ticket_id long, server string, status string, num_attempts int, created_at timestamp_ntz, finished_at timestamp_ntz, started_at timestamp_ntz",
        (1, 1, "s", "pending", 3, NOW - dt.timedelta(days=2), NOW - dt.timedelta(minutes=5), None),
        (2, 2, "s", "pending", 0, NOW - dt.timedelta(days=1), None, None),
        (3, 3, "s", "pending", 0, NOW, None, None),
    )
    out = intake.claim(jobs, NOW, 1)
    assert rows(out, "id", "status", F.col("started_at").isNotNull()) == [(1, "pending", False), (2, "running", True), (3, "pending", False)]


def test_outcomes(make):
    jobs = make(
        "id long, ticket_id long, server string, status string, exit_code int, last_error string, num_attempts int, started_at timestamp_ntz, finished_at timestamp_ntz",
        *[(k, k, "s", "running", None, None, 5 if k == 4 else 1, NOW, None) for k in range(1, 8)],
    )
    outcomes = make(
        "id long, exit_code int, detail string, killed boolean",
        (1, 0, None, False), (2, 1, "NetworkException", False), (3, 1, "bad", None), (4, 1, "NetworkException", False),
        (5, None, "NetworkException", True), (6, None, "no binary", False),
    )
    out = intake.apply_outcomes(jobs, outcomes, NOW)
    assert rows(out, "id", "status", "exit_code", "num_attempts", F.col("started_at").isNull(), F.col("finished_at").isNull()) == [
        (1, "succeeded", 0, 1, False, False), (2, "pending", 1, 2, True, False), (3, "failed", 1, 1, False, False),
        (4, "failed", 1, 5, False, False), (5, "failed", None, 1, False, False), (6, "failed", None, 1, False, False),
        (7, "running", None, 1, False, True),
    ]


def test_profiles_by_id(make):
    ticket = make("id long, irods_tickets string, created_by_id long, ticket_type string, processing_complete boolean",
                  (1, "MDRSubmit_L%:/z", 5, "u", False), (2, None, 5, "u", False), (3, "x", 6, "d", True))
    user = make("id long, username string", (5, "a"), (6, "b"))
    account = make("user_id long, provider string, uid string", (5, "orcid", "2"), (5, "orcid", "1"), (6, "github", "9"))
    pick = lambda **k: rows(intake.ticket_profiles(ticket, user, account, **k), "ticket_id", "username", "orcid")
    assert pick() == [(1, "a", "1")]
    assert pick(ids=[2, 3, 99]) == [(2, "a", "1"), (3, "b", "")]
    assert pick(landing="L%") == [(1, "a", "1")]
    assert pick(landing="L_") == []


# --- transfer --------------------------------------------------------------
def packed(n, start=0):
    return ";".join(f"MDRSubmit_L{k}:/z/L{k}" for k in range(start, start + n))


def test_batches(make):
    for n, threads, size in [(200, 8, 25), (300, 2, 25), (3, 8, 1), (10, 4, 3), (1, 0, 1)]:
        t = make("id long, irods_tickets string", (1, packed(n)), (2, packed(4)))
        out = transfer.make_batches(t, threads=threads)
        sizes = {r[0]: r[1] for r in out.where("ticket_id = 1").groupBy("batch").count().collect()}
        assert sorted(sizes) == list(range(math.ceil(n / size)))
        assert all(v == size for k, v in sizes.items() if k < len(sizes) - 1)
        # A partition of the parts: each once, in order, never across tickets.
        assert rows(out.where("ticket_id = 1"), "part_num") == sorted(((k,) for k in range(1, n + 1)), key=str)


def test_part_numbers_survive_a_selection(make):
    t = make("id long, irods_tickets string", (1, packed(6)), (2, None), (3, ""))
    wanted = ["L4", "L1"]
    assert rows(transfer.number_parts(t, wanted), "part_num", "landing") == [(2, "L1"), (5, "L4")]
    assert rows(transfer.make_batches(t, wanted, threads=1), "part_num", "batch") == [(2, 0), (5, 0)]
    ask = make("landing string", ("L1",), ("zz",))
    assert rows(transfer.missing_landings(transfer.number_parts(t), ask)) == [("zz",)]


def test_chunks_of_a_hot_part(make, spark):
    df = spark.range(1037).select(F.when(F.col("id") < 900, "hot").otherwise("cold").alias("part"), F.format_string("%05d", "id").alias("name"))
    got = transfer.chunk(df, ["part"], ["name"], 100).orderBy("part", "name").collect()
    want = [("cold", f"{900 + k:05d}", k // 100) for k in range(137)] + [("hot", f"{k:05d}", k // 100) for k in range(900)]
    assert [tuple(r) for r in got] == want


def test_reconcile(make):
    objects = make(
        "collection string, name string, size int, md5 string",
        ("/a", MARK, 5, "m"), ("/a", "ok", 1, "1"), ("/a", "bad", 1, "2"), ("/a", "unlisted", 1, "3"), ("/a", "empty", 1, "4"), ("/a", "nosum", 1, None), ("/b", "ok", 1, "1"),
    )
    manifest = make("collection string, name string, md5 string", ("/a", "ok", "1"), ("/a", "bad", "x"), ("/a", "empty", ""), ("/a", "nosum", "5"))
    good, bad = transfer.reconcile(objects, manifest, landings=make("collection string", ("/a",)))
    assert rows(good, "name") == [("empty",), ("ok",), ("unlisted",)]
    assert rows(bad, "name") == [("bad",), ("nosum",)]
    assert rows(transfer.reconcile(objects, manifest, "^un")[0], "name") == [("unlisted",)]


def test_copy_status_and_retry(make):
    want = make("collection string, name string, size int, md5 string", *[("/a", n, 5, "5d") for n in "abcd"], ("/a", "e", 5, None))
    have = make("collection string, name string, size int, md5 string", ("/a", "b", 4, "5d"), ("/a", "c", 5, "xx"), ("/a", "d", 5, "5d"), ("/a", "e", 5, None))
    status = transfer.copy_status(want, have)
    assert rows(status, "name", "state") == [("a", "missing"), ("b", "size"), ("c", "md5"), ("d", "ok"), ("e", "md5")]
    again, failed = transfer.retry_plan(status, 1)
    assert rows(again, "name", "attempt") == [("a", 2), ("b", 2), ("c", 2), ("e", 2)] and failed.count() == 0
    again, failed = transfer.retry_plan(status, 2)
    assert again.count() == 0 and rows(failed, "name") == [("a",), ("b",), ("c",), ("e",)]


def test_batch_mode(make):
    parts = make("batch_id long, ticket_id long, name string", (1, 1, "a"), (1, 1, "b"), (2, 1, "a"), (2, 1, "a"), (3, 1, "a"), (3, 2, "b"))
    assert rows(transfer.batch_mode(parts), "batch_id", "mode") == [(1, "together"), (2, "single"), (3, "single")]
    assert {r[1] for r in rows(transfer.batch_mode(parts, "x"), "batch_id", "mode")} == {"single"}


def test_push_plan_and_verify(make):
    local = make("dest string, size int, md5 string", ("a", 5, " AB "), ("a", 5, " AB "), ("b", 5, "ab"), ("c", 5, ""), ("d", 5, None), ("e", 5, "ab"), ("f", 0, None))
    remote = make("path string, size int, checksum string", ("a", 9, "md5:ab"), ("b", 5, "cd"), ("c", 5, "cd"), ("d", 6, "cd"))
    assert rows(transfer.push_plan(local, remote), "dest", "skip") == [("a", True), ("b", False), ("c", True), ("d", False), ("e", False), ("f", True)]
    twice = make("dest string, size int, md5 string, pos int", ("b", 5, "ab", 2), ("b", 5, "cd", 1))
    assert rows(transfer.push_plan(twice, remote, ["pos"]), "dest", "skip", "pos") == [("b", True, 1)]
    targets = make("simulation_id long, dest string, size int, expected_md5 string", *[(1, n, 5, "AB") for n in "pqrst"], (2, "u", 5, None))
    remote = make("path string, size int, checksum string", ("p", 5, "md5: AB "), ("q", 4, "ab"), ("r", 5, None), ("s", 5, "cd"), ("u", 5, None))
    out = transfer.push_verify(targets, remote)
    assert rows(out, "dest", "present", "verified", "reason") == [
        ("p", True, True, None), ("q", False, False, "missing"), ("r", True, False, "no checksum available"),
        ("s", True, False, "md5 mismatch"), ("t", False, False, "missing"), ("u", True, False, "no checksum available"),
    ]
    sims = make("simulation_id long", (1,), (2,), (3,))
    assert rows(transfer.push_complete(out, sims)) == [(1, 1, 5, False), (2, 0, 1, False), (3, 0, 0, False)]
    assert rows(transfer.push_complete(out.where("verified"))) == [(1, 1, 1, True)]


def test_push_targets(make):
    files = make(
        "simulation_id long, kind string, pos int, name string, size int, md5 string",
        (7, "original", 0, "d/t.nc", 1, "A"), (7, "original", 1, "d/t.nc", 2, "B"), (7, "processed", 0, "minimal.pdb", 3, "C"), (7, "processed", 1, "x/minimal.pdb", 4, "D"),
    )
    got = rows(transfer.push_targets(files, data_dir="/w/"), "location", "src", "dest", "size", "expected_md5")
    assert got == sorted([
        ("irods", "/w/d/t.nc", "MDR00000007/original/t.nc", 2, "b"), ("irods", "/w/processed/minimal.pdb", "MDR00000007/processed/minimal.pdb", 3, "c"),
        ("irods", "/w/processed/x/minimal.pdb", "MDR00000007/processed/minimal.pdb", 4, "d"), ("media", "/w/processed/minimal.pdb", "MDR00000007/minimal.pdb", 3, "c"),
    ], key=str)
    assert {r[0] for r in rows(transfer.push_targets(files, ["media"]), "location")} == {"media"}
    assert transfer.push_targets(files, ["original"]).count() == 1


def test_dedupe(make):
    df = make("a int, b int", (1, 2), (1, 1), (2, 5))
    assert rows(transfer.dedupe(df, ["a"], ["b"])) == [(1, 1), (2, 5)]
