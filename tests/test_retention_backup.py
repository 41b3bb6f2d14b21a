"""Retention, backups and bundles on small tables."""

import datetime as dt
import itertools

from pyspark.sql import functions as F

from simquarry.operators import bundles, retention, snapshots

D = dt.datetime


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def test_classes_follow_the_rules(make):
    """All combinations of the signals, against the rules in plain Python."""
    cases = list(itertools.product([True, False, None], [True, False], [True, False, None], [True, False, None]))
    upload, sims, want = [], [], {}
    for k, (ok, has_sim, placeholder, gone) in enumerate(cases):
        upload.append((1, f"L{k}", k if has_sim else None, ok, gone))
        sims.append((k, placeholder))
        eligible = bool(ok) and has_sim and placeholder is False
        want[f"L{k}"] = "eligible" if eligible else "abandoned" if gone else "held"
    upload += [(2, "busy", 0, True, False), (3, None, 0, True, False), (4, "nosuch", 0, True, True)]
    out = retention.classify_landings(
        make("ticket_id long, landing_id string, simulation_id long, successful boolean, is_abandoned boolean", *upload),
        make("id long, irods_tickets string", (1, "MDRSubmit_L0:/z/L0"), (2, None), (3, None)),
        make("id long, is_placeholder boolean", *sims),
        make("ticket_id long, status string", (2, "running"), (1, "failed")),
    )
    assert {r["landing_id"]: r["class"] for r in out.collect()} == want
    assert {r[0] for r in rows(out, "has_job")} == {True}
    assert rows(out.where("collection is not null"), "landing_id", "collection") == [("L0", "/z/L0")]
    roll = retention.candidate_rollup(out).first()
    n = {c: sum(v == c for v in want.values()) for c in ("eligible", "abandoned", "held")}
    assert (roll["landings"], roll["abandoned"], roll["held"]) == (n["eligible"] + n["abandoned"], n["abandoned"], n["held"])


def test_already_purged(make):
    cands = make("ticket_id long, landing_id string, collection string", (1, "a", "/a"), (1, "b", "/b"), (1, "c", "/c"), (2, "a", None), (3, "x", "/x"), (4, "y", "/y"))
    there = make("collection string", ("/b",), ("/x",))
    local = make("ticket_id long, landing_id string", (4, "y"), (9, "a"))
    assert rows(retention.already_purged(cands, there)) == [(1, True), (2, True), (3, False), (4, True)]
    assert rows(retention.already_purged(cands, there, full_scan=True)) == [(1, False), (2, True), (3, False), (4, True)]
    assert rows(retention.already_purged(cands, there, local)) == [(1, True), (2, True), (3, False), (4, False)]


def test_verdicts(make):
    files = make("simulation_id long, local_file_path string, file_size_bytes long", (1, "a", 5), (1, "b", 5), (1, "c", None), (1, "d", 5), (1, "e", 5))
    inv = make("path string, size long", ("a", 5), ("b", 6), ("c", 9), ("e", 5))
    out = retention.verify_files(files, inv, make("path string", ("e",)))
    assert rows(out, "local_file_path", "verdict") == [("a", "ok"), ("b", "SIZE"), ("c", "ok"), ("d", "MISSING"), ("e", "UNREACHABLE")]


def test_unverified_simulation_holds_only_its_tickets(make):
    cands = make(
        "ticket_id long, landing_id string, simulation_id long, class string",
        (1, "a", 10, "eligible"), (1, "b", 11, "eligible"), (1, "c", None, "abandoned"), (2, "d", 12, "eligible"), (3, "e", None, "abandoned"),
        (4, "f", 10, "abandoned"), (1, "g", 10, "abandoned"), (1, "h", 13, "held"),
    )
    files = make("simulation_id long", (10,), (11,))
    without, refused = retention.unverifiable(cands, files)
    assert rows(without) == [(2, 12)] and rows(refused) == [(2,)]
    left = retention.hold_back(cands, make("simulation_id long", (10,), (12,)), refused)
    assert rows(left, "landing_id") == [("b",), ("c",), ("e",), ("f",)]


def test_sampling_is_repeatable_and_bounded(make, spark):
    files = spark.range(500).select((F.col("id") % 7).alias("simulation_id"), F.concat(F.lit("f"), F.col("id").cast("string")).alias("local_file_path"))
    one = retention.sample_per_group(files, "simulation_id", 3, "s")
    assert rows(one) == rows(retention.sample_per_group(files.repartition(9), "simulation_id", 3, "s"))
    assert {r[1] for r in one.groupBy("simulation_id").count().collect()} == {3}
    assert retention.sample_per_group(files, "simulation_id", 0).count() == 500


def test_totals_are_the_sum_of_the_parts(make):
    names = ["present", "freed", "removed", "stalled", "local_present", "local_freed", "local_removed", "local_failed"]
    parts = [(1, 10, 1, 0, 1, 20, 1, 0), (1, 5, 0, 1, 0, 0, 0, 1)]
    df = make(", ".join(f"{n} long" for n in names), *parts)
    assert tuple(retention.purge_totals(df).first()) == tuple(map(sum, zip(*parts)))
    assert tuple(retention.purge_totals(df.limit(0)).first()) == (0,) * 8
    verdict = lambda **k: retention.purge_verdict(
        make("removed int, local_removed int, stalled int, held_unchecked int, unverified int",
             tuple(k.get(c, 0) for c in ("removed", "local_removed", "stalled", "held_unchecked", "unverified")))
    ).first()["verdict"]
    assert [verdict(), verdict(removed=1), verdict(held_unchecked=1), verdict(removed=1, unverified=1)] == ["silent", "report", "report", "failed"]


def test_logs(make):
    now = D(2024, 6, 1)
    inv = make("path string, modified_at timestamp_ntz", ("/l/ticket-1.log", D(2024, 1, 1)), ("/l/ticket-2.log", D(2024, 5, 1)), ("/l/x.log", D(2020, 1, 1)), ("/l/ticket-3.txt", D(2020, 1, 1)))
    assert rows(retention.expired_logs(inv, now), "path") == [("/l/ticket-1.log",)]
    jobs = make("id long, log_file string", (1, "/l/x.log"), (2, "/l/gone"), (3, None))
    assert rows(retention.orphan_logs(jobs, inv)) == [(2, "/l/gone")]


def test_empty_shells(make):
    e = make("ticket_id long, name string, is_dir boolean", (1, "ticket.json", False), (2, "L", True), (2, "ticket.json", False))
    assert rows(retention.empty_shells(e)) == [(1,)]


# --- backups ---------------------------------------------------------------
def test_replica_complaints(make):
    objects = make("path string, size long, expected_size long, expected_md5 string", ("good", 5, 5, "ab"), ("bad", 1234, 5000, "ab"), ("none", 5, 5, "ab"))
    replicas = make(
        "path string, replica_no int, resource string, size long, status int, checksum string",
        ("good", 0, "r", 5, 1, "md5:AB"), ("good", 1, "s", 5, 1, "ab"), ("bad", 0, "r", 1234, 0, ""), ("bad", 1, "s", 5000, 1, "cd"),
    )
    assert rows(snapshots.replica_problems(objects, replicas)) == sorted([
        ("bad", "object size 1,234 != local 5,000"), ("bad", "replica 0 on r is not good (status 0)"), ("bad", "replica 0 on r size 1,234 != local 5,000"),
        ("bad", "replica 0 on r has no registered checksum"), ("bad", "replica 1 on s md5 cd != local ab"), ("none", "only 0 replica(s), expected 2"),
    ], key=str)
    assert rows(snapshots.stored_report(objects, replicas), "path", "problems") == [("bad", 2), ("good", 0), ("none", 0)]


def test_surviving_snapshots_by_replay(make):
    """Write the slots one by one as the job would, then compare."""
    runs = [(D(2024, 1, 1) + dt.timedelta(hours=11 * k), f"r{k}", k % 5 != 3) for k in range(200)]
    disk = {}
    for ts, run, ok in runs:
        if not ok:
            continue
        disk[ts.strftime("backup.%d.sql.gz")] = run
        disk["backup.latest.sql.gz"] = run
        if not any(n.startswith(ts.strftime("backup.%Y-%m")) for n in disk):
            disk[ts.strftime("backup.%Y-%m-%d.sql.gz")] = run
    df = make("ts timestamp_ntz, run_id string, ok boolean", *runs)
    assert rows(snapshots.surviving_snapshots(df), "name", "run_id") == sorted(disk.items())


def test_needs_archive(make):
    names = make("name string", ("backup.2024-01-05.sql.gz",), ("backup.05.sql.gz",))
    assert rows(snapshots.needs_archive(names, make("month string", ("2024-01",), ("2024-02",)))) == [("2024-01", False), ("2024-02", True)]


# --- bundles ---------------------------------------------------------------
def test_next_bundle(make):
    now = D(2024, 1, 9)
    day = lambda k: now - dt.timedelta(days=k)
    objects = make("name string, size long, create_time timestamp_ntz", ("a.md5", 10, now), ("b.md5", 0, day(1)), ("c.md5", 5, day(2)), ("c.data", 5, day(2)), ("d.md5", 5, day(3)))
    log = make("bundle string", ("d",))
    assert rows(bundles.next_bundles(objects, log), "bundle") == [("c",)]
    assert rows(bundles.next_bundles(objects, log, None), "bundle") == [("a",), ("c",)]
    assert bundles.next_bundles(objects.where("size = 0"), log).count() == 0
    assert bundles.next_bundles(objects, make("bundle string", ("a",), ("c",), ("d",))).count() == 0


def test_latest_outcome_wins(make):
    log = make("seq long, bundle string, result string", (1, "a", "failed"), (3, "a", "done"), (2, "b", "failed"))
    assert rows(bundles.latest_outcomes(log), "bundle", "result") == [("a", "done"), ("b", "failed")]


def test_fill_smiles(make):
    ligands = make("simulation_id long, name string, smiles string", (1, "LIG", ""), (2, "LIG", None), (2, "ABC", ""), (3, "XYZ", ""), (4, "LIG", ""), (5, "LIG", "C"), (6, "LIG", ""))
    sims = make("simulation_id long, pdb_id string", (1, "1ABC"), (2, "1ABC"), (3, "1abc"), (4, "9zzz"), (5, "1abc"), (6, "2abc"))
    table = make("pdb_id string, ligand string, smiles string", ("1abc", "lig", "CCO"), ("1abc", "other", "N"), ("2abc", "LIG", " "))
    assert rows(bundles.fill_smiles(ligands, sims, table), "simulation_id", "name", "reason", "smiles") == [
        (1, "LIG", "filled", "CCO"), (2, "ABC", "several missing", ""), (2, "LIG", "several missing", None), (3, "XYZ", "name mismatch", ""),
        (4, "LIG", "no entry", ""), (5, "LIG", "given", "C"), (6, "LIG", "empty entry", ""),
    ]
