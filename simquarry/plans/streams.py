"""Queries on sources, sinks, episodes and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from simquarry.functions import fixed_values as fv
from simquarry.operators import alerts, bundles, intake, transfer
from simquarry.operators.structure import chain_sequences
from simquarry.plans.intake import PARTS
from simquarry.plans.registry import Inputs, named
from simquarry.plans.structure import CHAINS, SEQ
from simquarry.plans.transfer import PUSH
from simquarry.plans.views import VIEWS, query, view
from simquarry.session import shared_folder
from simquarry.sources import documents, files, sinks, tables
from simquarry.streaming.alerts import alert_stream
from simquarry.streaming.intake import complete_tickets, completion_stream, current_jobs, job_stream
from simquarry.streaming.run import closing, drain, state_partitions
from simquarry.streaming.views import maintain, read_view

# A stored table has no order of arrival: its files may come in any order of the
# time they span, so that span is the lateness declared for it.
SPAN = "31 days"


def table_stream(i: Inputs, table: str):
    """A given table as a stream of files.

    Written as a pattern, the path may be a folder of files or a single file.
    The bytes of a micro-batch are bounded, and with them the rows of a key.
    """
    schema = view(i.spark, i.sf_dir, table).schema
    return i.spark.readStream.schema(schema).option("maxBytesPerTrigger", 256 * 1024 * 1024).parquet(f"{i.sf_dir}/{table}.parque[t]")


def _partitions(i: Inputs, table: str) -> int:
    return state_partitions(i.spark, view(i.spark, i.sf_dir, table).count())


# --- sources ---------------------------------------------------------------
@named("s2_catalog_objects", "select path as collection, resource as name, size, checksum as md5 from v_replicas where replica_no = 0")
def _(i: Inputs):
    catalog = i.v_replicas.select(
        F.col("path").alias("collection"), F.col("resource").alias("name"), "size", F.col("checksum").alias("md5"),
        F.lit(None).cast("timestamp").alias("create_time"), F.col("replica_no").alias("replica_number"),
    )
    return tables.objects(catalog).drop("create_time")


def _manifest_docs(i: Inputs):
    """Manifest texts: entries by object, some repeated, some documents cut."""
    entry = F.struct(F.col("name").alias("irods_path"), F.col("md5").alias("md5_hash"))
    listed = i.v_manifest.groupBy("collection").agg(F.sort_array(F.collect_list(entry)).alias("files"))
    again = F.transform("files", lambda f: F.struct(f["irods_path"].alias("irods_path"), F.lit("stale").alias("md5_hash")))
    text = F.to_json(F.struct(F.concat(again, F.col("files")).alias("files")))
    number = F.regexp_extract("collection", r"L(\d+)-", 1).cast("long")
    return listed.select("collection", F.when(number % 10 == 0, F.left(text, F.length(text) - 5)).otherwise(text).alias("text"))


@named("s3_manifests", r"select collection, name, md5 from v_manifest where cast(regexp_extract(collection, 'L(\d+)-', 1) as bigint) % 10 <> 0")
def _(i: Inputs):
    return documents.parse_manifests(_manifest_docs(i))[0]


@named("s3_unreadable_manifests", r"select distinct collection from v_manifest where cast(regexp_extract(collection, 'L(\d+)-', 1) as bigint) % 10 = 0")
def _(i: Inputs):
    return documents.parse_manifests(_manifest_docs(i))[1]


@named(
    "s4_imports",
    """select l_orderkey as doc, printf('h%d', l_orderkey) as hash, cast(l_linenumber - 1 as bigint) as pos, concat('L', l_partkey) as name, concat('C', l_suppkey) as smiles
       from (select l_orderkey, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) as l_linenumber, l_partkey, l_suppkey from lineitem)""",
)
def _(i: Inputs):
    element = F.struct("l_linenumber", "l_partkey", "l_suppkey")
    grouped = i.lineitem.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(element)).alias("e"))
    ligands = F.transform(
        "e",
        lambda e: F.struct(
            F.concat(F.lit("L"), e["l_partkey"].cast("string")).alias("name"),
            F.concat(F.lit("C"), e["l_suppkey"].cast("string")).alias("smiles"),
        ),
    )
    key = F.concat(F.lit("h"), F.col("l_orderkey").cast("string"))
    body = F.struct(key.alias("unique_file_hash_string"), ligands.alias("ligands"))
    docs = grouped.select(F.col("l_orderkey").alias("doc"), F.to_json(F.struct(body.alias("simulation"))).alias("text"))
    good, _bad = documents.parse_imports(docs)
    return documents.elements(good.withColumn("sim_id", F.col("hash")), "ligands").select(
        "doc", F.col("simulation_id").alias("hash"), "pos", "name", "smiles"
    )


PDB_LINES = """
select label as path, 0 as block, vec_id + 1 as line_no, case when vec_id % 50 = 7 then 'MODEL        2'
       when vec_id % 50 = 9 then 'REMARK' else concat('ATOM  ', lpad(cast(vec_id % 100000 as string), 5, ' '), '  CA  ALA A', lpad(cast(vec_id % 1000 as string), 4, ' '), '    ',
       lpad(cast(vec_id * 3 % 10000000 as string), 8, ' '), lpad('bad', 8, ' '), lpad('1.50', 8, ' '), rpad('', 22, ' '), ' C') end as line
from embeddings"""


@named(
    "s5_pdb_atoms",
    """select path, line_no, 'ATOM' as record, vec_id % 100000 as serial, 'CA' as name, 'ALA' as resname, 'A' as chain, cast(vec_id % 1000 as int) as resnum,
              cast(vec_id * 3 % 10000000 as double) as x, cast(null as double) as y, 1.5::double as z, 'C' as element,
              cast(greatest(1, count(*) filter (vec_id % 50 = 7) over (partition by path order by line_no)) as int) as model
       from (select label as path, vec_id + 1 as line_no, vec_id from embeddings) qualify vec_id % 50 not in (7, 9)""",
)
def _(i: Inputs):
    return files.parse_pdb_atoms(query(i.spark, i.sf_dir, PDB_LINES)).drop("icode")


@named(
    "s6_outcome_lines",
    """select concat_ws(chr(9), 't', result, bundle, left(regexp_replace(trim(text, chr(32) || chr(10)), '\\s+', ' ', 'g'), 500)) as line
       from v_outcomes join documents on doc_id = seq % (select count(*) from documents)""".replace("\\\\", "\\"),
)
def _(i: Inputs):
    docs = i.documents.select(F.col("doc_id").alias("k"), F.col("text").alias("detail"))
    rows = i.v_outcomes.withColumn("k", F.col("seq") % F.lit(max(docs.count(), 1))).join(docs, "k").withColumn("timestamp", F.lit("t"))
    return sinks.outcome_lines(rows)


@named("s6_outcome_log", "select bundle, result, detail from (select bundle, result, concat('d', seq) as detail from v_outcomes) where bundle <> 'b7'")
def _(i: Inputs):
    """Lines written and read back; short lines and the header drop out."""
    rows = i.v_outcomes.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), "result", "bundle",
        F.concat(F.lit("d"), F.col("seq").cast("string")).alias("detail"), "seq",
    )
    text = sinks.outcome_lines(rows).select("line")
    short = F.when(F.col("line").contains("\tb7\t"), F.substring_index("line", "\t", 2)).otherwise(F.col("line"))
    lines = text.select(short.alias("line"), F.lit("log").alias("path"), F.lit(1).alias("line_no"))
    return files.parse_outcome_lines(lines).select("bundle", "result", "detail")


@named(
    "s7_inventory",
    "select concat('part=', user_id % 50) as folder, cast(sum(strlen(props) + 1) as bigint) as bytes from events group by user_id % 50",
)
def _(i: Inputs):
    """Text files written from a table, then listed: bytes per folder."""
    root = f"{shared_folder(i.spark)}/tree-{uuid.uuid4().hex}"
    i.events.select((F.col("user_id") % 50).alias("part"), "props").write.partitionBy("part").text(root)
    data = files.read_inventory(i.spark, root).where(~F.col("name").rlike("^[._]"))
    return data.groupBy(F.substring_index("dir", "/", -1).alias("folder")).agg(F.sum("size").alias("bytes"))


ID_LINES = """
select case event_id % 6 when 0 then '' when 1 then concat(' ', event_id, ' ') when 2 then concat('x', event_id) when 3 then concat('-', event_id) when 4 then concat(event_id, '.5')
       else cast(event_id as string) end as line from events"""


@named("s8_id_list", r"select cast(trim(line) as bigint) as id from v_lines where regexp_matches(trim(line), '^[+-]?\d+$')", {"v_lines": ID_LINES})
def _(i: Inputs):
    good, _bad = files.split_id_lines(_id_lines(i))
    return good


@named("s8_id_list_rejects", r"select trim(line) as text from v_lines where trim(line) <> '' and not regexp_matches(trim(line), '^[+-]?\d+$')", {"v_lines": ID_LINES})
def _(i: Inputs):
    return files.split_id_lines(_id_lines(i))[1].select("text")


def _id_lines(i: Inputs):
    return query(i.spark, i.sf_dir, ID_LINES).select(F.lit("ids").alias("path"), F.lit(0).alias("line_no"), "line")


@named("s9_fasta_records", r"""select sim_id, cast(number as int) as number, concat('>', number, chr(10), sequence) as record from v_num where not regexp_matches(sequence, '^X+$')""", SEQ)
def _(i: Inputs):
    return sinks.fasta_records(chain_sequences(query(i.spark, i.sf_dir, CHAINS)))


@named(
    "s10_push_results",
    """select simulation_id, bool_and(coalesce(present and remote_md5 = expected, false)) as complete, count(*) as n_files,
              string_agg(dest, ',' order by dest) as dests from v_pushed group by simulation_id""",
    PUSH,
)
def _(i: Inputs):
    targets = i.v_files.select(
        "simulation_id", F.lit("irods").alias("location"), F.lit("").alias("src"), F.col("local_file_path").alias("dest"),
        F.col("file_size_bytes").alias("size"), F.col("md5_hash").alias("expected_md5"),
    )
    out = sinks.push_results(transfer.push_verify(targets, i.v_release))
    return out.select(
        "simulation_id", "complete", F.size("files").cast("long").alias("n_files"),
        F.array_join(F.transform("files", lambda f: f["dest"]), ",").alias("dests"),
    )


@named(
    "s10_ticket_info",
    """select t.id as ticket_id, concat('{"first_name":"', u.first_name, '","last_name":"', u.last_name, '","email":"', u.email, '","orcid":"', coalesce(a.uid, ''),
              '","username":"', u.username, '","institution":"', u.institution, '"}') as info
       from v_ticket t join v_user u on u.id = t.created_by_id
       left join (select user_id, min(uid) as uid from v_account where provider = 'orcid' group by 1) a on a.user_id = u.id
       where t.ticket_type = 'u' and t.irods_tickets is not null and t.processing_complete = false""",
)
def _(i: Inputs):
    return sinks.ticket_info(intake.ticket_profiles(i.v_ticket, i.v_user, i.v_account))


LOG_LINES = {"v_log": VIEWS["v_logs"]}


@named("s11_run_logs", "select run_id, line_no, line from v_logs")
def _(i: Inputs):
    """Lines of each report, numbered from their place."""
    from simquarry.operators.ranking import running_total

    raw = i.v_logs.select(F.col("run_id").alias("path"), F.lit(0).alias("block"), F.col("line_no").alias("row"), "line")
    numbered = running_total(raw, ["path"], "block", ["row"], F.lit(1), "line_no")
    return numbered.select(F.col("path").alias("run_id"), F.col("line_no").cast("int").alias("line_no"), "line")


# --- episodes and alerts ---------------------------------------------------
ISLANDS = {
    "v_isl": "select *, cast(sum(case when exit_code = 0 then 1 else 0 end) over (partition by label order by ts, seq) as bigint) as island from v_runs",
}


@named(
    "w11_failure_episodes",
    """select label, island, min(ts) as first_failure, max(ts) as last_failure, count(*) as failures,
              island < (select max(island) from v_isl k where k.label = v_isl.label) as recovered
       from v_isl where exit_code <> 0 group by label, island""",
    ISLANDS,
)
def _(i: Inputs):
    return alerts.failure_episodes(i.v_runs)


# The rules of an alert, replayed run by run.
ALERTS = {
    "v_run_no": "select *, row_number() over (partition by label order by ts, seq) as rn from v_runs",
    "v_replay": """
select label, cast(0 as bigint) as rn, cast(null as timestamp) as ts, cast(null as bigint) as seq, cast(null as varchar) as kind, cast(null as bigint) as told,
       cast(null as timestamp) as since, cast(null as boolean) as delivered, cast(0 as bigint) as failures, cast(null as timestamp) as first_failure,
       cast(null as timestamp) as alerted_at, cast(null as bigint) as parked
from v_run_no where rn = 1
union all
select label, rn, ts, seq, case when ok then case when alerted is not null then 'recovered' end when due then 'failed' end as kind,
       case when ok then coalesce(nullif(parked, 0), failures) else n end as told, case when ok then first_failure else first end as since, delivered,
       case when ok then 0 else n end, case when ok then case when alerted is not null and not delivered then first_failure end else first end,
       case when ok then case when not delivered then alerted end when due and delivered then date_trunc('second', ts) else live end,
       case when ok and alerted is not null and not delivered then coalesce(nullif(parked, 0), failures) end
from (select *, n >= 3 and (live is null or date_trunc('second', ts) - live >= interval '24' hour) as due
      from (select r.label, r.rn, r.ts, r.seq, r.exit_code = 0 as ok, r.delivered, p.failures, p.first_failure, p.alerted_at as alerted, p.parked,
                   case when p.parked is null then p.failures else 0 end + 1 as n,
                   coalesce(case when p.parked is null then p.first_failure end, date_trunc('second', r.ts)) as first,
                   case when p.parked is null then p.alerted_at end as live
            from v_replay p join v_run_no r on r.label = p.label and r.rn = p.rn + 1))""",
}
ALERT_SQL = "select label, ts, seq, kind, told as failures, since, delivered from v_replay where kind is not null"


@named("x1_alert_batch", ALERT_SQL, ALERTS)
def _(i: Inputs):
    return alerts.alerts(i.v_runs)


@named("x1_alert_stream", ALERT_SQL, ALERTS)
def _(i: Inputs):
    runs = table_stream(i, "events").selectExpr(
        "concat('job-', user_id) as label", "ts", "event_id as seq",
        "case when event_type in ('error', 'click', 'view') then 1 else 0 end as exit_code", "event_id % 7 <> 0 as delivered",
    )
    runs, close = closing(runs)
    return drain(alert_stream(runs, lateness=SPAN), close=close, partitions=_partitions(i, "events"))


@named(
    "x2_completion_stream",
    """select p.ticket_id, count(*) as n_landings from v_parts p where p.ok group by p.ticket_id
       having bool_and(exists (select 1 from v_marker m where m.collection = p.collection))""",
    PARTS,
)
def _(i: Inputs):
    """Marker objects arrive as often as their line items."""
    key = F.concat(F.lit("/z/landing/L"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    total = F.col("l_orderkey") + F.col("l_linenumber")
    markers = (
        table_stream(i, "lineitem")
        .where((F.col("l_orderkey") * 3 + F.col("l_linenumber")) % 13 != 0)
        .select(
            key.alias("collection"), F.lit(fv.COMPLETION_MARKER).alias("name"), F.when(total % 11 == 0, 0).otherwise(5039).alias("size")
        )
    )
    path = f"{shared_folder(i.spark)}/completion-{uuid.uuid4().hex}"
    completion_stream(intake.parse_tickets(i.v_ticket), markers, path).awaitTermination()
    return complete_tickets(i.spark, path)


@named("x3_outcome_stream", "select bundle, max(seq) as seq, arg_max(result, seq) as result from v_outcomes group by bundle")
def _(i: Inputs):
    log = table_stream(i, "events").where("event_id % 5 in (1, 2)").selectExpr(
        "event_id as seq", "concat('b', cast(floor(event_id / 20) as bigint)) as bundle", "case when event_type = 'error' then 'failed' else 'done' end as result"
    )
    path = f"{shared_folder(i.spark)}/view-{uuid.uuid4().hex}"
    maintain(log, path, "bundle", ["seq"]).awaitTermination()
    return read_view(i.spark, path, log.schema).select("bundle", "seq", "result")


JOBS = {
    "v_ev": """
select user_id as job_id, ts, event_id as seq, case event_type when 'view' then 'enqueue' when 'signup' then 'enqueue' when 'click' then 'claim' else 'end' end as kind,
       case when event_type = 'purchase' then case when event_id % 40 = 0 then 0 else 2 end when event_type = 'error' then 1 end as exit_code,
       event_type = 'error' or event_id % 3 <> 0 as retryable, row_number() over (partition by user_id order by ts, event_id) as rn from events""",
    "v_state": """
select job_id, cast(0 as bigint) as rn, cast(null as varchar) as status, 0 as num_attempts, cast(null as int) as exit_code, cast(null as timestamp) as started_at,
       cast(null as timestamp) as finished_at from v_ev where rn = 1
union all
select job_id, rn, case when made then 'pending' when start then 'running' when good then 'succeeded' when back then 'pending' when bad then 'failed' else status end,
       cast(case when back then num_attempts + 1 else num_attempts end as int), case when good or back or bad then code else exit_code end,
       case when start then ts when back then null else started_at end, case when good or back or bad then ts else finished_at end
from (select e.job_id, e.rn, e.ts, e.exit_code as code, p.status, p.num_attempts, p.exit_code, p.started_at, p.finished_at,
             p.status is null and e.kind = 'enqueue' as made,
             coalesce(p.status = 'pending' and e.kind = 'claim' and (p.finished_at is null or
               p.finished_at + cast(least(5 * power(4, greatest(p.num_attempts - 1, 0)), 180) as int) * interval '1' minute <= e.ts), false) as start,
             coalesce(p.status = 'running' and e.kind = 'end' and e.exit_code = 0, false) as good,
             coalesce(p.status = 'running' and e.kind = 'end' and e.exit_code <> 0 and e.retryable and p.num_attempts < 5, false) as back,
             coalesce(p.status = 'running' and e.kind = 'end' and e.exit_code <> 0 and not (e.retryable and p.num_attempts < 5), false) as bad
      from v_state p join v_ev e on e.job_id = p.job_id and e.rn = p.rn + 1)""",
}


JOB_EVENTS = [
    "user_id as job_id", "ts", "event_id as seq",
    "case event_type when 'view' then 'enqueue' when 'signup' then 'enqueue' when 'click' then 'claim' else 'end' end as kind",
    "case when event_type = 'purchase' then case when event_id % 40 = 0 then 0 else 2 end when event_type = 'error' then 1 end as exit_code",
    "event_type = 'error' or event_id % 3 <> 0 as retryable",
]
JOB_SQL = """select job_id, status, cast(case when status is null then null else num_attempts end as int) as num_attempts, exit_code, started_at, finished_at from v_state
       qualify row_number() over (partition by job_id order by rn desc) = 1"""


@named("x4_job_batch", JOB_SQL, JOBS)
def _(i: Inputs):
    return intake.settle_jobs(i.events.selectExpr(*JOB_EVENTS))


@named("x4_job_stream", JOB_SQL, JOBS)
def _(i: Inputs):
    events = table_stream(i, "events").selectExpr(*JOB_EVENTS)
    events, close = closing(events)
    return current_jobs(drain(job_stream(events, lateness=SPAN), close=close, partitions=_partitions(i, "events")))
