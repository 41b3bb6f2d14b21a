"""Queries on retention, backups and the bundle backlog."""

from __future__ import annotations

from pyspark.sql import functions as F

from simquarry.operators import bundles, retention as op, snapshots
from simquarry.plans.intake import PARTS
from simquarry.plans.registry import Inputs, named
from simquarry.plans.views import query

# The jobs of the given tables belong to low ticket numbers only; spread them.
JOBS = """
select id, id * 2 as ticket_id, status, server from v_job"""
# Misses are made by other names, so that every table stays whole.
INVENTORY = "select case when size % 7 = 0 then concat(path, '.gone') else path end as path, size from v_release"
LOST = "select case when size % 11 = 0 then path else concat(path, '.seen') end as path from v_release"
LEFT = "select distinct case when size % 5 = 0 then collection else concat(collection, '-old') end as collection from v_objects"
LOCAL = "select ticket_id, case when (ticket_id * part) % 6 = 1 then landing_id else concat(landing_id, '-old') end as landing_id from v_landing"
ON_DISK = "select case when size % 4 <> 0 then path else concat(path, '.gz') end as path from v_log_files"

CLASSES = {
    "v_exploded": PARTS["v_exploded"],
    "v_parts": PARTS["v_parts"],
    "v_jobs": JOBS,
    "v_class": """
select u.ticket_id, u.landing_id, u.simulation_id, m.collection,
       case when coalesce(u.successful and u.simulation_id is not null and s.is_placeholder = false, false) then 'eligible'
            when u.is_abandoned then 'abandoned' else 'held' end as class,
       exists (select 1 from v_jobs j where j.ticket_id = u.ticket_id) as has_job
from v_upload u join v_ticket t on t.id = u.ticket_id
left join (select ticket_id, landing_id, arg_max(collection, pos) as collection from v_parts where ok group by ticket_id, landing_id) m
     on m.ticket_id = u.ticket_id and m.landing_id = u.landing_id
left join v_simulation s on s.id = u.simulation_id
where not exists (select 1 from v_jobs j where j.ticket_id = u.ticket_id and j.status in ('pending', 'running'))""",
    "v_cand": "select * from v_class where class <> 'held'",
    "v_inv": INVENTORY,
    "v_lost": LOST,
    "v_used_files": """
select * from v_files f where exists (select 1 from v_cand c where c.class = 'eligible' and c.simulation_id = f.simulation_id)""",
    "v_sampled": """
select * from v_used_files qualify row_number() over (partition by simulation_id order by md5(concat('0', local_file_path))) <= 1""",
    "v_verdict": """
select f.simulation_id, f.local_file_path, case when l.path is not null then 'UNREACHABLE' when r.path is null then 'MISSING'
       when r.size <> f.file_size_bytes then 'SIZE' else 'ok' end as verdict
from v_sampled f left join v_inv r on r.path = f.local_file_path left join v_lost l on l.path = f.local_file_path""",
    "v_elig": "select distinct ticket_id, simulation_id from v_cand where class = 'eligible'",
    "v_norows": "select * from v_elig e where not exists (select 1 from v_files f where f.simulation_id = e.simulation_id)",
    "v_refused": """
select ticket_id from v_elig e group by ticket_id
having count(*) filter (exists (select 1 from v_files f where f.simulation_id = e.simulation_id)) = 0""",
}


def _jobs(i: Inputs):
    return query(i.spark, i.sf_dir, JOBS)


def _classes(i: Inputs):
    return op.classify_landings(i.v_upload, i.v_ticket, i.v_simulation, _jobs(i))


def _files(i: Inputs):
    files = i.v_files
    return files.where("kind = 'processed'"), files.where("kind = 'original'")


def _inventory(i: Inputs):
    return query(i.spark, i.sf_dir, INVENTORY)


def _lost(i: Inputs):
    return query(i.spark, i.sf_dir, LOST)


@named("j6_not_in_flight", """select ticket_id, landing_id from v_upload u where not exists
    (select 1 from v_jobs j where j.ticket_id = u.ticket_id and j.status in ('pending', 'running'))""", CLASSES)
def _(i: Inputs):
    return op.not_in_flight(i.v_upload, _jobs(i)).select("ticket_id", "landing_id")


@named("j7_with_has_job", """select ticket_id, landing_id, exists (select 1 from v_jobs j where j.ticket_id = u.ticket_id) as has_job
    from v_upload u""", CLASSES)
def _(i: Inputs):
    return op.with_has_job(i.v_upload, _jobs(i)).select("ticket_id", "landing_id", "has_job")


@named("j8_classify_landings", "select ticket_id, landing_id, simulation_id, collection, class, has_job from v_class", CLASSES)
def _(i: Inputs):
    return _classes(i)


@named(
    "a4_candidate_rollup",
    """select ticket_id, count(*) filter (class <> 'held') as landings,
              count(*) filter (class <> 'held' and simulation_id is not null) as num_sims,
              count(*) filter (class = 'abandoned') as abandoned, count(*) filter (class = 'held') as held, bool_or(has_job) as has_job
       from v_class group by ticket_id having count(*) filter (class <> 'held') > 0""",
    CLASSES,
)
def _(i: Inputs):
    return op.candidate_rollup(_classes(i))


PURGED = {
    **CLASSES,
    "v_left": LEFT,
    "v_local": LOCAL,
    "v_seen": """
select c.ticket_id, c.landing_id, c.collection, l.collection is not null as there, d.landing_id is not null as on_disk
from v_cand c left join v_left l on l.collection = c.collection
left join v_local d on d.ticket_id = c.ticket_id and d.landing_id = c.landing_id""",
}


def _purged(i: Inputs, full: bool):
    left, local = query(i.spark, i.sf_dir, LEFT), query(i.spark, i.sf_dir, LOCAL)
    return op.already_purged(_classes(i).where("class <> 'held'"), left, local, full_scan=full)


@named(
    "a7_already_purged",
    """select ticket_id, not coalesce(arg_min(there, landing_id) filter (collection is not null)
              or arg_max(there, landing_id) filter (collection is not null), false) and not bool_or(on_disk) as purged
       from v_seen group by ticket_id""",
    PURGED,
)
def _(i: Inputs):
    return _purged(i, False)


@named(
    "a7_already_purged_full_scan",
    "select ticket_id, not bool_or(there) and not bool_or(on_disk) as purged from v_seen group by ticket_id",
    PURGED,
)
def _(i: Inputs):
    return _purged(i, True)


@named("u1_permanent_files", "select simulation_id, local_file_path, file_size_bytes from v_used_files", CLASSES)
def _(i: Inputs):
    return op.permanent_files(*_files(i), _classes(i).where("class = 'eligible'"))


@named(
    "w4_sample_per_group",
    "select simulation_id, local_file_path from v_files qualify row_number() over (partition by simulation_id order by md5(concat('7', local_file_path))) <= 2",
)
def _(i: Inputs):
    return op.sample_per_group(i.v_files, "simulation_id", 2, "7").select("simulation_id", "local_file_path")


@named("j9_verify_files", "select simulation_id, local_file_path, verdict from v_verdict", CLASSES)
def _(i: Inputs):
    files = op.permanent_files(*_files(i), _classes(i).where("class = 'eligible'"))
    out = op.verify_files(op.sample_per_group(files, "simulation_id", 1), _inventory(i), _lost(i))
    return out.select("simulation_id", "local_file_path", "verdict")


@named("j10_unverifiable", "select ticket_id, simulation_id from v_norows", CLASSES)
def _(i: Inputs):
    return op.unverifiable(_classes(i), i.v_files)[0]


@named("j10_refused_tickets", "select ticket_id from v_refused", CLASSES)
def _(i: Inputs):
    return op.unverifiable(_classes(i), i.v_files)[1]


@named(
    "j11_hold_back",
    """select ticket_id, landing_id, class, collection from v_cand c where ticket_id not in (select ticket_id from v_refused)
       and not exists (select 1 from v_elig e where e.ticket_id = c.ticket_id and e.simulation_id = c.simulation_id and (
           exists (select 1 from v_verdict v where v.simulation_id = e.simulation_id and v.verdict <> 'ok')
           or exists (select 1 from v_norows n where n.simulation_id = e.simulation_id)))""",
    CLASSES,
)
def _(i: Inputs):
    return op.purge_list(
        i.v_upload, i.v_ticket, i.v_simulation, _jobs(i), *_files(i), _inventory(i), unreachable=_lost(i)
    ).select("ticket_id", "landing_id", "class", "collection")


RESULTS = """
select ticket_id, landing_id, 1 as present, partkey * 10 as freed, case when part % 3 = 0 then 0 else 1 end as removed,
       case when part % 3 = 0 then 1 else 0 end as stalled, part % 2 as local_present, part % 2 * partkey as local_freed,
       part % 2 as local_removed, 0 as local_failed
from v_landing"""


def _totals(i: Inputs):
    return op.purge_totals(query(i.spark, i.sf_dir, RESULTS))


TOTALS = """
select cast(sum(present) as bigint) as present, cast(sum(freed) as bigint) as freed, cast(sum(removed) as bigint) as removed,
       cast(sum(stalled) as bigint) as stalled, cast(sum(local_present) as bigint) as local_present,
       cast(sum(local_freed) as bigint) as local_freed, cast(sum(local_removed) as bigint) as local_removed,
       cast(sum(local_failed) as bigint) as local_failed from v_results"""


@named("a5_purge_totals", TOTALS, {"v_results": RESULTS})
def _(i: Inputs):
    return _totals(i)


@named(
    "a26_purge_verdict",
    f"""select *, case when unverified > 0 then 'failed' when removed > 0 or local_removed > 0 or stalled > 0 or held_unchecked > 0 then 'report'
                 else 'silent' end as verdict
        from (select t.*, (select count(*) from v_refused) as unverified,
                     (select count(*) from v_verdict where verdict = 'UNREACHABLE') as held_unchecked from ({TOTALS}) t)""",
    {**CLASSES, "v_results": RESULTS},
)
def _(i: Inputs):
    classes = _classes(i)
    files = op.permanent_files(*_files(i), classes.where("class = 'eligible'"))
    verdicts = op.verify_files(op.sample_per_group(files, "simulation_id", 1), _inventory(i), _lost(i))
    refused = op.unverifiable(classes, i.v_files)[1]
    # Three one-row aggregates side by side: a union and one more aggregate,
    # so that no join without a key is needed.
    zero = {c: F.lit(0).cast("long") for c in ("unverified", "held_unchecked")}
    base = _totals(i).withColumns(zero)
    empty = {c: F.lit(0).cast("long").alias(c) for c in base.columns}
    one = refused.agg(F.count(F.lit(1)).alias("unverified")).select(
        *[F.col(c) if c == "unverified" else empty[c] for c in base.columns]
    )
    two = verdicts.agg(F.count_if(F.col("verdict") == "UNREACHABLE").alias("held_unchecked")).select(
        *[F.col(c) if c == "held_unchecked" else empty[c] for c in base.columns]
    )
    rows = base.unionByName(one).unionByName(two)
    return op.purge_verdict(rows.agg(*[F.sum(c).alias(c) for c in base.columns]))


@named(
    "a6_dir_sizes",
    """select collection as dir, count(*) as files, cast(sum(size) as bigint) as bytes,
              case when sum(size) < 1024 then printf('%.1f B', sum(size)::double) else printf('%.1f KB', sum(size) / 1024.0::double) end as label
       from v_objects group by collection""",
)
def _(i: Inputs):
    return op.dir_sizes(i.v_objects.withColumnRenamed("collection", "dir"))


@named(
    "a8_empty_shells",
    "select ticket_id from v_landing group by ticket_id having not bool_or((ticket_id + part) % 3 = 0)",
)
def _(i: Inputs):
    entries = i.v_landing.select(
        "ticket_id", F.col("landing_id").alias("name"), ((F.col("ticket_id") + F.col("part")) % 3 == 0).alias("is_dir")
    )
    return op.empty_shells(entries)


@named(
    "o4_limit_tickets",
    """select ticket_id, count(*) filter (class <> 'held') as landings from v_class group by ticket_id
       having count(*) filter (class <> 'held') > 0 order by ticket_id limit 20""",
    CLASSES,
)
def _(i: Inputs):
    return op.limit_tickets(op.candidate_rollup(_classes(i)).select("ticket_id", "landings"), 20)


LOG_NOW = "2024-04-20 00:00:00"


@named(
    "p26_expired_logs",
    f"""select path, size from v_log_files where regexp_replace(path, '^.*/', '') like 'ticket-%' and path like '%.log'
        and modified_at < timestamp '{LOG_NOW}' - interval '90' day""",
)
def _(i: Inputs):
    return op.expired_logs(i.v_log_files, LOG_NOW).select("path", "size")


def _log_jobs(i: Inputs):
    return i.v_log_files.select(
        F.col("event_id").alias("id"), F.when(F.col("event_id") % 9 != 0, F.col("path")).alias("log_file")
    )


@named("j12_orphan_logs", "select event_id as id, path as log_file from v_log_files where event_id % 9 <> 0 and size % 4 = 0")
def _(i: Inputs):
    return op.orphan_logs(_log_jobs(i), query(i.spark, i.sf_dir, ON_DISK))


@named(
    "m19_null_orphan_logs",
    "select event_id as id, case when event_id % 9 <> 0 and size % 4 <> 0 then path end as log_file from v_log_files",
)
def _(i: Inputs):
    from simquarry.operators.intake import apply_fix

    jobs = _log_jobs(i)
    return apply_fix(jobs, op.orphan_logs(jobs, query(i.spark, i.sf_dir, ON_DISK)), "log_file", None)


# --- backups ---------------------------------------------------------------
@named(
    "p27_snapshot_names",
    """select event_id, concat('backup.', strftime(ts, '%d'), '.sql.gz') as slot, concat('backup.', strftime(ts, '%Y-%m-%d'), '.sql.gz') as archive,
              'backup.latest.sql.gz' as latest from events""",
)
def _(i: Inputs):
    return i.events.select("event_id", *[c.alias(n) for n, c in snapshots.snapshot_names(F.col("ts")).items()])


@named(
    "a10_replica_problems",
    """select path, concat('object size ', format('{:,}', size), ' != local ', format('{:,}', expected_size)) as problem from v_backup where size <> expected_size
       union all select b.path, concat('only ', count(r.path), ' replica(s), expected 2') from v_backup b left join v_replicas r on r.path = b.path
                 group by b.path having count(r.path) < 2
       union all select path, concat(w, ' is not good (status ', status, ')') from v_both where status <> 1
       union all select path, concat(w, ' size ', format('{:,}', size), ' != local ', format('{:,}', expected_size)) from v_both where size <> expected_size
       union all select path, concat(w, ' has no registered checksum') from v_both where checksum is null
       union all select path, concat(w, ' md5 ', checksum, ' != local ', expected_md5) from v_both where checksum <> expected_md5""",
    {
        "v_both": """select r.*, b.expected_size, b.expected_md5, concat('replica ', replica_no, ' on ', resource) as w
                     from v_replicas r join v_backup b on b.path = r.path"""
    },
)
def _(i: Inputs):
    return snapshots.replica_problems(i.v_backup, i.v_replicas)


@named(
    "a11_stored_report",
    """select b.path, any_value(b.size) as size, coalesce(count(distinct r.size) > 1, false) as disagree,
              coalesce(bool_or(r.status <> 1), false) as not_good,
              cast(coalesce(count(distinct r.size) > 1, false) as int) + cast(coalesce(bool_or(r.status <> 1), false) as int) as problems
       from v_backup b left join v_replicas r on r.path = b.path group by b.path""",
)
def _(i: Inputs):
    return snapshots.stored_report(i.v_backup, i.v_replicas)


@named(
    "a12_needs_archive",
    """select m.month, not exists (select 1 from v_archives a where a.name like concat('backup.', m.month, '%')) as needed
       from (select distinct strftime(o_orderdate, '%Y-%m') as month from orders) m""",
    {"v_archives": "select concat(case when month(o_orderdate) % 3 = 0 then 'other.' else 'backup.' end, strftime(o_orderdate, '%Y-%m-%d'), '.sql.gz') as name from orders"},
)
def _(i: Inputs):
    orders = i.orders
    names = {p: snapshots.snapshot_names(F.col("o_orderdate"), p)["archive"] for p in ("other.", "backup.")}
    archives = orders.select(
        F.when(F.month("o_orderdate") % 3 == 0, names["other."]).otherwise(names["backup."]).alias("name")
    )
    months = orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("month")).distinct()
    return snapshots.needs_archive(archives, months)


@named(
    "w9_surviving_snapshots",
    """select concat('backup.', strftime(ts, '%d'), '.sql.gz') as name, ts, run_id from v_snapshots where ok
         qualify row_number() over (partition by strftime(ts, '%d') order by ts desc, run_id desc) = 1
       union all select concat('backup.', strftime(ts, '%Y-%m-%d'), '.sql.gz'), ts, run_id from v_snapshots where ok
         qualify row_number() over (partition by strftime(ts, '%Y-%m') order by ts, run_id) = 1
       union all (select 'backup.latest.sql.gz', ts, run_id from v_snapshots where ok order by ts desc, run_id desc limit 1)""",
)
def _(i: Inputs):
    return snapshots.surviving_snapshots(i.v_snapshots)


# --- bundles ---------------------------------------------------------------
READY = """
select left(name, len(name) - 4) as bundle, create_time from v_bundle_objects o where name like '%.md5' and size > 0
and not exists (select 1 from v_outcomes u where u.bundle = left(o.name, len(o.name) - 4))"""


@named("j13_unrecorded_bundles", READY)
def _(i: Inputs):
    return bundles.next_bundles(i.v_bundle_objects, i.v_outcomes, None)


@named("o3_next_bundles", READY + " order by create_time, bundle limit 10")
def _(i: Inputs):
    return bundles.next_bundles(i.v_bundle_objects, i.v_outcomes, 10)


@named("w7_latest_outcomes", "select bundle, max(seq) as seq, arg_max(ts, seq) as ts, arg_max(result, seq) as result from v_outcomes group by bundle")
def _(i: Inputs):
    return bundles.latest_outcomes(i.v_outcomes)


LIGANDS = {
    "v_ligands": """
select p_partkey as ligand_id, cast(floor(p_partkey / 3) as bigint) as simulation_id, concat('L', p_size % 4) as name,
       case when p_partkey % 3 = 0 then '' when p_partkey % 11 = 0 then null else concat('C', p_size) end as smiles from part""",
    "v_structures": "select p_partkey as simulation_id, concat('P', p_size) as pdb_id from part",
    "v_smiles": """
select distinct concat('p', p_size) as pdb_id, concat('l', p_size % 4) as ligand, case when p_size % 6 = 0 then ' ' else concat('N', p_size) end as smiles
from part
union select distinct concat('p', p_size), 'zz', 'ZZ' from part where p_size % 5 = 0""",
}


@named(
    "j18_fill_smiles",
    """select ligand_id, simulation_id, reason, case when reason = 'filled' then k_smiles else smiles end as smiles from (
         select l.*, trim(k.smiles) as k_smiles, case when coalesce(l.smiles, '') <> '' then 'given' when n.n > 1 then 'several missing'
                when not exists (select 1 from v_smiles x where x.pdb_id = lower(s.pdb_id)) then 'no entry'
                when k.pdb_id is null then 'name mismatch' when trim(k.smiles) = '' then 'empty entry' else 'filled' end as reason
         from v_ligands l join (select simulation_id, count(*) filter (coalesce(smiles, '') = '') as n from v_ligands group by 1) n
              on n.simulation_id = l.simulation_id
         left join v_structures s on s.simulation_id = l.simulation_id
         left join v_smiles k on k.pdb_id = lower(s.pdb_id) and upper(k.ligand) = upper(l.name))""",
    LIGANDS,
)
def _(i: Inputs):
    get = lambda n: query(i.spark, i.sf_dir, LIGANDS[n])
    return bundles.fill_smiles(get("v_ligands"), get("v_structures"), get("v_smiles")).select(
        "ligand_id", "simulation_id", "reason", "smiles"
    )
