"""Queries on intake, queue and scalar rules over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from simquarry.functions import rules, text
from simquarry.operators import intake as op
from simquarry.plans.registry import Inputs, named

NOW = "2024-01-20 00:00:00"

# Views shared by the DuckDB texts below.
PARTS = {
    "v_exploded": """
select id as ticket_id, cast(unnest(range(len(string_split(irods_tickets, ';')))) as int) as pos,
       unnest(string_split(irods_tickets, ';')) as entry
from v_ticket where coalesce(irods_tickets, '') <> ''""",
    "v_parts": """
select ticket_id, pos, entry, regexp_matches(entry, '^MDRSubmit_([^:]+):(.+)$') as ok,
       nullif(regexp_extract(entry, '^MDRSubmit_([^:]+):(.+)$', 1), '') as landing_id,
       nullif(regexp_extract(entry, '^MDRSubmit_([^:]+):(.+)$', 2), '') as collection
from v_exploded""",
    "v_marker": """
select collection from v_objects where name = 'mdrepo-submission.completed.json' and size > 0""",
    "v_complete": """
select p.ticket_id, count(*) as n_landings, bool_and(m.collection is not null) as is_complete
from v_parts p left join v_marker m on m.collection = p.collection where p.ok group by p.ticket_id""",
    "v_done": """
select t.id as ticket_id, t.created_at, u.username, u.first_name, u.last_name, c.n_landings
from v_ticket t join v_user u on u.id = t.created_by_id join v_complete c on c.ticket_id = t.id
where t.ticket_type = 'u' and t.upload_notification_sent = false and c.is_complete""",
    "v_ready": """
select *, finished_at + least(5 * power(4, greatest(num_attempts - 1, 0)), 180)::int * interval '1' minute as eligible_at
from v_job""",
}


@named("s1_read_table", "select id, username, institution, email from v_user")
def _(i: Inputs):
    from simquarry.sources.tables import conform

    return conform(i.v_user, "user").select("id", "username", "institution", "email")


@named("p1_parse_tickets", "select ticket_id, pos, entry, landing_id, collection, ok from v_parts", PARTS)
def _(i: Inputs):
    return op.parse_tickets(i.v_ticket)


@named(
    "p1_parse_tickets_split",
    """select ticket_id, pos, entry, case when ok then regexp_replace(regexp_replace(c, '/+$', ''), '^.*/', '') end as landing_id,
       case when ok then c end as collection, ok
       from (select *, contains(entry, ':') as ok, string_split(entry, ':')[2] as c from v_exploded)""",
    {"v_exploded": PARTS["v_exploded"]},
)
def _(i: Inputs):
    return op.parse_tickets(i.v_ticket, mode="split")


@named(
    "p1_ticket_map",
    "select ticket_id, landing_id, arg_max(collection, pos) as collection from v_parts where ok group by ticket_id, landing_id",
    PARTS,
)
def _(i: Inputs):
    return op.ticket_map(i.v_ticket)


@named("p2_landing_name", "select ticket_id, part, landing_id as name from v_landing")
def _(i: Inputs):
    return i.v_landing.select("ticket_id", "part", text.landing_name(F.concat("collection", F.lit("//"))).alias("name"))


@named("p3_tickets_like", "select id, irods_tickets from v_ticket where contains(irods_tickets, 'L12')")
def _(i: Inputs):
    return op.tickets_like(i.v_ticket, "L12").select("id", "irods_tickets")


@named("p4_eligible_at", "select id, num_attempts, eligible_at from v_ready", PARTS)
def _(i: Inputs):
    return i.v_job.select(
        "id", "num_attempts", rules.eligible_at(F.col("finished_at"), F.col("num_attempts")).alias("eligible_at")
    )


@named(
    "p5_is_retryable",
    """select id, coalesce(contains(lower(last_error), 'failed to establish a connection to irods server')
       or contains(lower(last_error), 'networkexception') or contains(lower(last_error), 'exec_cmd_error'), false) as retryable
       from v_job""",
)
def _(i: Inputs):
    return i.v_job.select("id", rules.is_retryable(F.col("last_error")).alias("retryable"))


@named(
    "p6_repo_id",
    "select l_partkey, printf('MDR%08d', l_partkey * 100003) as repo_id from lineitem",
)
def _(i: Inputs):
    return i.lineitem.select("l_partkey", text.repo_id(F.col("l_partkey") * 100003).alias("repo_id"))


DONE_MESSAGE = """
select ticket_id, created_at, username, n_landings,
       concat('New simulation upload ', ticket_id, ' by ',
              case when trim(concat(first_name, ' ', last_name)) = '' then username
                   else concat(trim(concat(first_name, ' ', last_name)), ' (', username, ')') end,
              ' containing ', n_landings, ' simulation', case when n_landings = 1 then '' else 's' end) as message
from v_done"""


@named("p7_upload_message", DONE_MESSAGE, PARTS)
def _(i: Inputs):
    return op.complete_uploads(i.v_ticket, i.v_user, i.v_objects)


@named(
    "p8_human_bytes",
    """select l_orderkey, l_linenumber, bytes,
       case when abs(bytes) < 1024 then printf('%.1f B', bytes::double)
            when abs(bytes) < 1048576 then printf('%.1f KB', bytes / 1024.0::double)
            when abs(bytes) < 1073741824 then printf('%.1f MB', bytes / 1048576.0::double)
            when abs(bytes) < 1099511627776 then printf('%.1f GB', bytes / 1073741824.0::double)
            else printf('%.1f TB', bytes / 1099511627776.0::double) end as label
       from (select l_orderkey, l_linenumber,
             cast(l_partkey * (l_suppkey % 7) * case l_linenumber when 1 then 1 when 2 then 64 when 3 then 4096
                  when 4 then 262144 else 1048576 end as bigint) as bytes from lineitem)""",
)
def _(i: Inputs):
    unit = (
        F.when(F.col("l_linenumber") == 1, 1).when(F.col("l_linenumber") == 2, 64)
        .when(F.col("l_linenumber") == 3, 4096).when(F.col("l_linenumber") == 4, 262144).otherwise(1048576)
    )
    size = (F.col("l_partkey") * (F.col("l_suppkey") % 7) * unit).cast("long")
    return i.lineitem.select("l_orderkey", "l_linenumber", size.alias("bytes"), text.human_bytes(size).alias("label"))


@named(
    "p9_format_hm",
    """select event_id, case when s is null then null when s < 60 then '<1m'
            when s // 3600 > 0 then concat(s // 3600, 'h ', s // 60 % 60, 'm') else concat(s // 60, 'm') end as took
       from (select event_id, cast(trunc(case when event_type = 'view' then null else value * 137 end) as bigint) as s from events)""",
)
def _(i: Inputs):
    seconds = F.when(F.col("event_type") != "view", F.col("value") * 137)
    return i.events.select("event_id", text.format_hm(seconds).alias("took"))


@named(
    "p10_tail_lines",
    r"""select doc_id, regexp_replace(array_to_string(case when len(l) > 5 then l[-5:] else l end, chr(10)), '^\s+|\s+$', '', 'g') as tail
        from (select doc_id, string_split(regexp_replace(text, '\n\z', ''), chr(10)) as l from documents)""",
)
def _(i: Inputs):
    return i.documents.select("doc_id", text.tail_lines(F.col("text"), 5).alias("tail"))


@named(
    "p11_slug",
    """select p_partkey, coalesce(nullif(regexp_replace(regexp_replace(lower(label), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'job') as slug
       from (select p_partkey, case when p_partkey % 10 = 0 then '##' else concat(p_brand, ' (', p_name, ')!') end as label from part)""",
)
def _(i: Inputs):
    label = F.when(F.col("p_partkey") % 10 == 0, "##").otherwise(
        F.concat("p_brand", F.lit(" ("), "p_name", F.lit(")!"))
    )
    return i.part.select("p_partkey", text.slug(label).alias("slug"))


@named(
    "p12_norm_md5",
    "select path, replica_no, lower(checksum) as digest from v_replicas",
)
def _(i: Inputs):
    dressed = F.concat(F.lit("md5:  "), F.upper("checksum"), F.lit("\t "))
    return i.v_replicas.select("path", "replica_no", text.norm_md5(dressed).alias("digest"))


@named("p13_permanent_path", "select simulation_id, local_file_path as path from v_files")
def _(i: Inputs):
    name = F.concat(
        F.when(F.col("kind") == "processed", "some/dir/").otherwise(""), text.basename(F.col("local_file_path"))
    )
    return i.v_files.select(
        "simulation_id", text.permanent_path(F.col("simulation_id"), F.col("kind"), name).alias("path")
    )


@named("p25_filter_files", "select collection, name, size from v_objects where regexp_matches(name, '^part-1.*xtc$')")
def _(i: Inputs):
    from simquarry.operators.transfer import filter_files

    return filter_files(i.v_objects, "^part-1.*xtc$").select("collection", "name", "size")


@named(
    "p29_job_notice",
    """select id, case when status = 'succeeded' then
             concat('Ticket ', ticket_id, ' processing SUCCEEDED', case when took is null then '' else concat(' in ', took) end)
           else concat('Ticket ', ticket_id, ' processing ', case when killed then 'KILLED (exceeded time limit)' else 'FAILED' end,
                case when killed then '' else ' (exit 1)' end, case when took is null then '' else concat(' after ', took) end, chr(10),
                case when killed then concat('timed out', chr(10)) else '' end,
                'Details: /job/', id, chr(10), 'Debug log: /logs/', ticket_id) end as notice
       from (select *, id % 9 = 0 as killed, case when started_at is null then null else '7m' end as took from v_job
             where status in ('succeeded', 'failed'))""",
)
def _(i: Inputs):
    killed = F.col("id") % 9 == 0
    outcome = F.when(F.col("status") == "succeeded", "succeeded").when(killed, "killed").otherwise("failed")
    seconds = F.timestamp_diff("SECOND", F.col("started_at"), F.col("finished_at"))
    return i.v_job.where(F.col("status").isin("succeeded", "failed")).select(
        "id",
        rules.job_notice(
            F.col("ticket_id"), outcome, seconds, F.lit(1), F.when(killed, "timed out"),
            F.concat(F.lit("/job/"), F.col("id").cast("string")),
            F.concat(F.lit("/logs/"), F.col("ticket_id").cast("string")),
        ).alias("notice"),
    )


@named(
    "j1_unprocessed_tickets",
    """select t.id, t.created_at, t.irods_tickets, u.username, u.first_name, u.last_name
       from v_ticket t join v_user u on u.id = t.created_by_id
       where t.ticket_type = 'u' and t.upload_notification_sent = false""",
)
def _(i: Inputs):
    return op.unprocessed_tickets(i.v_ticket, i.v_user)


@named(
    "j2_ticket_profiles",
    """select t.id as ticket_id, t.created_at, t.irods_tickets, u.first_name, u.last_name, u.username, u.institution, u.email,
              coalesce(a.orcid, '') as orcid
       from v_ticket t join v_user u on u.id = t.created_by_id
       left join (select user_id, min(uid) as orcid from v_account where provider = 'orcid' group by user_id) a on a.user_id = u.id
       where t.ticket_type = 'u' and t.irods_tickets is not null and t.processing_complete = false""",
)
def _(i: Inputs):
    return op.ticket_profiles(i.v_ticket, i.v_user, i.v_account).select(
        "ticket_id", "created_at", "irods_tickets", "first_name", "last_name", "username", "institution", "email", "orcid"
    )


@named(
    "a1_ticket_completeness",
    """select t.id as ticket_id, coalesce(c.n_landings, 0) as n_landings, coalesce(c.is_complete, false) as is_complete
       from v_ticket t left join v_complete c on c.ticket_id = t.id""",
    PARTS,
)
def _(i: Inputs):
    tickets = i.v_ticket
    return op.ticket_completeness(
        op.parse_tickets(tickets), i.v_objects, tickets.select(F.col("id").alias("ticket_id"))
    )


@named("a2_queue_counts", "select server, status, count(*) as n from v_job group by server, status")
def _(i: Inputs):
    return op.queue_counts(i.v_job)


@named(
    "a3_queue_busy",
    """select server, bool_or(status in ('pending', 'running')) as busy, count(*) filter (status = 'pending') as pending
       from v_job group by server""",
)
def _(i: Inputs):
    return op.queue_busy(i.v_job)


@named(
    "o1_next_jobs",
    f"""select id, ticket_id, server, num_attempts from v_ready
        where status = 'pending' and (finished_at is null or eligible_at <= timestamp '{NOW}')
        qualify row_number() over (partition by server order by created_at, id) <= 5""",
    PARTS,
)
def _(i: Inputs):
    return op.next_jobs(i.v_job, NOW, 5).select("id", "ticket_id", "server", "num_attempts")


@named("o2_failed_jobs", "select id, ticket_id, finished_at, left(last_error, 200) as err from v_job where status = 'failed'")
def _(i: Inputs):
    return op.failed_jobs(i.v_job)


@named(
    "o2_retrying_jobs",
    "select id, ticket_id, num_attempts, left(last_error, 200) as err from v_job where status = 'pending' and num_attempts > 0",
)
def _(i: Inputs):
    return op.retrying_jobs(i.v_job)


@named(
    "o2_stuck_jobs",
    f"select id, ticket_id, started_at from v_job where status = 'running' and started_at < timestamp '{NOW}' - interval '12' hour",
)
def _(i: Inputs):
    return op.stuck_jobs(i.v_job, NOW)


@named(
    "j14_stale_flag_tickets",
    """select id, created_by_id from v_ticket t where ticket_type = 'u' and upload_notification_sent = false
       and (exists (select 1 from events e where e.user_id = t.id) or exists (select 1 from v_upload u where u.ticket_id = t.id))""",
)
def _(i: Inputs):
    sims = i.events.select(F.col("user_id").alias("md_repo_ticket_id"))
    return op.stale_flag_tickets(i.v_ticket, sims, i.v_upload).select("id", "created_by_id")


@named(
    "j21_abandoned_tickets",
    """select id, created_at from v_ticket t left join v_complete c on c.ticket_id = t.id
       where created_at < timestamp '1999-01-01' - interval '7' day and not coalesce(c.is_complete, false)
       and not exists (select 1 from v_job j where j.ticket_id = t.id)
       and not exists (select 1 from v_upload u where u.ticket_id = t.id and u.simulation_id is not null)""",
    PARTS,
)
def _(i: Inputs):
    complete = op.ticket_completeness(op.parse_tickets(i.v_ticket), i.v_objects)
    linked = i.v_upload.where("simulation_id is not null")
    return op.abandoned_tickets(i.v_ticket, complete, [i.v_job, linked], "1999-01-01").select("id", "created_at")


@named(
    "m16_mark_and_enqueue_tickets",
    """select t.id, t.upload_notification_sent or d.ticket_id is not null as upload_notification_sent,
              d.ticket_id is not null as used_for_upload
       from v_ticket t left join v_done d on d.ticket_id = t.id""",
    PARTS,
)
def _(i: Inputs):
    done = op.complete_uploads(i.v_ticket, i.v_user, i.v_objects)
    marked, _jobs = op.mark_and_enqueue(i.v_ticket, done, i.v_job, "staging", NOW)
    return marked.select("id", "upload_notification_sent", "used_for_upload")


@named(
    "m16_mark_and_enqueue_jobs",
    f"""select id, ticket_id, server, status, created_at from v_job
        union all select null, ticket_id, 'staging', 'pending', timestamp '{NOW}' from v_done""",
    PARTS,
)
def _(i: Inputs):
    done = op.complete_uploads(i.v_ticket, i.v_user, i.v_objects)
    _marked, jobs = op.mark_and_enqueue(i.v_ticket, done, i.v_job, "staging", NOW)
    return jobs.select("id", "ticket_id", "server", "status", "created_at")


# Outcomes: the running jobs end in five ways.
OUTCOMES = """
select id, case when id % 5 = 0 then 0 when id % 5 = 4 then null else cast(id % 5 as int) end as exit_code,
       case when id % 5 in (1, 4) then 'NETWORKEXCEPTION seen' when id % 5 = 2 then 'bad topology' else 'x' end as detail,
       id % 5 = 4 as killed
from v_job where status = 'running'"""


@named(
    "m17_apply_outcomes",
    f"""select j.id, case when o.id is null then status when exit_code = 0 then 'succeeded' when id5 = 1 and num_attempts < 5 then 'pending'
                else 'failed' end as status,
              case when o.id is null then null when killed then null else exit_code end as exit_code,
              case when o.id is not null and coalesce(exit_code, 1) <> 0 then detail else last_error end as last_error,
              cast(case when id5 = 1 and o.id is not null then num_attempts + 1 else num_attempts end as int) as num_attempts,
              case when id5 = 1 and o.id is not null then null else started_at end as started_at,
              case when o.id is not null then timestamp '{NOW}' else finished_at end as finished_at
       from (select *, id % 5 as id5 from v_job) j left join v_ended o on o.id = j.id""",
    {"v_ended": OUTCOMES},
)
def _(i: Inputs):
    from simquarry.plans.views import query

    jobs = i.v_job.withColumn("exit_code", F.lit(None).cast("int"))
    return op.apply_outcomes(jobs, query(i.spark, i.sf_dir, OUTCOMES), NOW).select(
        "id", "status", "exit_code", "last_error", "num_attempts", "started_at", "finished_at"
    )


@named(
    "m18_claim",
    f"""select j.id, case when c.id is not null then 'running' else j.status end as status,
               case when c.id is not null then timestamp '{NOW}' else j.started_at end as started_at
        from v_job j left join (
          select id from v_ready where status = 'pending' and (finished_at is null or eligible_at <= timestamp '{NOW}')
          qualify row_number() over (partition by server order by created_at, id) <= 3) c on c.id = j.id""",
    PARTS,
)
def _(i: Inputs):
    return op.claim(i.v_job, NOW, 3).select("id", "status", "started_at")


@named(
    "m19_apply_fix",
    """select id, upload_notification_sent or (ticket_type = 'u' and exists (select 1 from v_upload u where u.ticket_id = t.id))
              as upload_notification_sent from v_ticket t""",
)
def _(i: Inputs):
    stale = op.stale_flag_tickets(
        i.v_ticket, i.v_upload.select(F.col("ticket_id").alias("md_repo_ticket_id")), i.v_upload
    )
    return op.apply_fix(i.v_ticket, stale, "upload_notification_sent", True).select("id", "upload_notification_sent")
