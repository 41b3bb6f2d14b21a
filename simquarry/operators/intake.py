"""Upload intake: which uploads are complete, which jobs run next, what a run
of a job leads to."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simquarry.functions import fixed_values as fv
from simquarry.functions import rules, text
from simquarry.session import broadcast_if_small, freeze, spread


def as_time(now: dt.datetime | str | Column) -> Column:
    return now if isinstance(now, Column) else F.lit(str(now)).cast("timestamp_ntz")


# --- tickets ---------------------------------------------------------------
def parse_tickets(df: DataFrame, col: str = "irods_tickets", mode: str = "regex", key: str = "id") -> DataFrame:
    """One row per entry of the packed string, with its position.

    Bad entries stay in the result with ``ok`` false.  No shuffle.
    """
    entry = F.col("entry")
    landing, collection, ok = text.ticket_entry(entry, mode)
    return (
        df.where(~text.blank(F.col(col)))
        .select(F.col(key).alias("ticket_id"), F.posexplode(F.split(col, ";")).alias("pos", "entry"))
        .select(
            "ticket_id", "pos", "entry", landing.alias("landing_id"), collection.alias("collection"), ok.alias("ok")
        )
    )


def ticket_map(df: DataFrame, col: str = "irods_tickets", key: str = "id") -> DataFrame:
    """Landing id to collection per ticket; the last entry of a landing wins.

    Entries are dealt first: an aggregate that keeps texts sorts its input, and a
    scan of tickets has many entries.
    """
    return (
        spread(parse_tickets(df, col, key=key).where("ok"), "ticket_id", "landing_id")
        .groupBy("ticket_id", "landing_id")
        .agg(F.max_by("collection", "pos").alias("collection"))
    )


def tickets_like(ticket: DataFrame, fragment: str) -> DataFrame:
    """Tickets whose packed string contains a text, taken literally."""
    return ticket.where(F.col("irods_tickets").contains(fragment))


def unprocessed_tickets(ticket: DataFrame, user: DataFrame) -> DataFrame:
    """Upload tickets nobody was told about yet, with their owner."""
    t = ticket.where((F.col("ticket_type") == "u") & (F.col("upload_notification_sent") == F.lit(False)))
    return t.join(
        user.select(F.col("id").alias("created_by_id"), "username", "first_name", "last_name"), "created_by_id"
    ).select("id", "created_at", "irods_tickets", "username", "first_name", "last_name")


def ticket_profiles(
    ticket: DataFrame, user: DataFrame, account: DataFrame, ids: Sequence[int] | None = None,
    landing: str | None = None,
) -> DataFrame:
    """Selected tickets with owner and ORCID ('' if none, the least of several)."""
    if ids is None and landing is None:
        picked = ticket.where(
            (F.col("ticket_type") == "u")
            & F.col("irods_tickets").isNotNull()
            & (F.col("processing_complete") == F.lit(False))
        )
    else:
        picked = ticket.where(
            F.col("id").isin(*(ids or [])) | (F.col("irods_tickets").contains(landing) if landing else F.lit(False))
        )
    orcid = (
        account.where(F.col("provider") == "orcid")
        .groupBy(F.col("user_id").alias("created_by_id"))
        .agg(F.min("uid").alias("orcid"))
    )
    owner = user.withColumnRenamed("id", "created_by_id").join(orcid, "created_by_id", "left")
    return (
        picked.join(owner, "created_by_id")
        .withColumn("orcid", F.coalesce("orcid", F.lit("")))
        .withColumnRenamed("id", "ticket_id")
    )


def ticket_completeness(parts: DataFrame, objects: DataFrame, tickets: DataFrame | None = None) -> DataFrame:
    """Whether every valid landing of a ticket has a non-empty marker.

    ``parts`` are parsed entries, ``objects`` the catalog.  The marker filter
    reaches the catalog scan; one join on the collection and one aggregate on
    the ticket follow.  A ticket without a valid landing is not complete; to
    see those without any entry, pass ``tickets``.
    """
    marker = (
        objects.where((F.col("name") == fv.COMPLETION_MARKER) & (F.col("size") > 0))
        .select("collection", F.lit(True).alias("marked"))
    )
    per_ticket = (
        parts.where("ok")
        .join(marker, "collection", "left")
        .groupBy("ticket_id")
        .agg(
            F.count(F.lit(1)).alias("n_landings"),
            F.bool_and(F.coalesce("marked", F.lit(False))).alias("all_marked"),
        )
    )
    base = tickets if tickets is not None else parts.select("ticket_id").distinct()
    return base.join(per_ticket, "ticket_id", "left").select(
        *base.columns,
        F.coalesce("n_landings", F.lit(0)).alias("n_landings"),
        F.coalesce("all_marked", F.lit(False)).alias("is_complete"),
    )


def upload_message(df: DataFrame) -> DataFrame:
    """Text for a complete ticket, from its owner and number of landings."""
    label = text.display_name(F.col("first_name"), F.col("last_name"), F.col("username"))
    return df.withColumn(
        "message",
        F.concat(
            F.lit("New simulation upload "), F.col("ticket_id").cast("string"), F.lit(" by "), label,
            F.lit(" containing "), F.col("n_landings").cast("string"),
            F.when(F.col("n_landings") == 1, " simulation").otherwise(" simulations"),
        ),
    )


def complete_uploads(ticket: DataFrame, user: DataFrame, objects: DataFrame) -> DataFrame:
    """Unprocessed tickets that are complete, with the message to send."""
    fresh = unprocessed_tickets(ticket, user)
    done = ticket_completeness(parse_tickets(fresh), objects).where("is_complete").drop("is_complete")
    owner = fresh.select(F.col("id").alias("ticket_id"), "created_at", "username", "first_name", "last_name")
    return upload_message(owner.join(done, "ticket_id")).select(
        "ticket_id", "created_at", "username", "n_landings", "message"
    )


def mark_and_enqueue(
    ticket: DataFrame, complete: DataFrame, jobs: DataFrame, server: str, now
) -> tuple[DataFrame, DataFrame]:
    """Flag complete tickets and give each one pending job.

    Both tables come from one frozen set of ids.  A ticket that is flagged
    already is not in the set, so a second run adds nothing.
    """
    ids = freeze(
        ticket.where(F.col("upload_notification_sent") == F.lit(False))
        .join(complete.select(F.col("ticket_id").alias("id")).distinct(), "id", "left_semi")
        .select("id")
    )
    hit = ids.select("id", F.lit(True).alias("__hit"))
    used = F.col("used_for_upload") if "used_for_upload" in ticket.columns else F.lit(False)
    marked = (
        ticket.join(hit, "id", "left")
        .withColumn("used_for_upload", F.coalesce("__hit", used))
        .withColumn("upload_notification_sent", F.coalesce("__hit", "upload_notification_sent"))
        .drop("__hit")
    )
    columns = {
        "ticket_id": F.col("id"),
        "server": F.lit(server),
        "status": F.lit("pending"),
        "num_attempts": F.lit(0),
        "created_at": as_time(now),
    }
    new = ids.select(*[c.alias(n) for n, c in columns.items()])
    return marked, jobs.unionByName(new, allowMissingColumns=True)


def abandoned_tickets(
    ticket: DataFrame, complete: DataFrame, refs: Sequence[DataFrame], now, days: int = 7
) -> DataFrame:
    """Incomplete tickets older than ``days`` that no other table refers to.

    Each of ``refs`` has a column ``ticket_id``.  The result is a list only.
    """
    old = ticket.where(F.col("created_at") < F.timestamp_add("DAY", F.lit(-days), as_time(now)))
    done = complete.where("is_complete").select(F.col("ticket_id").alias("id"))
    out = old.join(done, "id", "left_anti")
    for ref in refs:
        out = out.join(ref.select(F.col("ticket_id").alias("id")), "id", "left_anti")
    return out


def stale_flag_tickets(ticket: DataFrame, sim: DataFrame, upload: DataFrame) -> DataFrame:
    """Unflagged upload tickets that have a simulation or an upload already."""
    open_ = ticket.where((F.col("ticket_type") == "u") & (F.col("upload_notification_sent") == F.lit(False)))
    owners = (
        sim.select(F.col("md_repo_ticket_id").alias("id"))
        .unionByName(upload.select(F.col("ticket_id").alias("id")))
    )
    return open_.join(owners, "id", "left_semi")


# --- queue -----------------------------------------------------------------
def queue_counts(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("server", "status").agg(F.count(F.lit(1)).alias("n"))


def queue_busy(jobs: DataFrame) -> DataFrame:
    """Per server: anything pending or running, and how many are pending."""
    return jobs.groupBy("server").agg(
        F.bool_or(F.col("status").isin(*fv.IN_FLIGHT)).alias("busy"),
        F.count_if(F.col("status") == "pending").alias("pending"),
    )


def next_jobs(jobs: DataFrame, now, k: int = 1) -> DataFrame:
    """The ``k`` oldest claimable jobs per server.

    The rank filter becomes a limit per group before the shuffle, so a server
    with most of the jobs does not fill one task.
    """
    ready = jobs.where(
        rules.claimable(F.col("status"), F.col("finished_at"), F.col("num_attempts"), as_time(now))
    )
    rank = F.row_number().over(Window.partitionBy("server").orderBy("created_at", "id"))
    return ready.withColumn("rank", rank).where(F.col("rank") <= k)


def claim(jobs: DataFrame, now, k: int = 1) -> DataFrame:
    """The job table after the next jobs were started."""
    chosen = freeze(next_jobs(jobs, now, k).select("id", F.lit(True).alias("__hit")))
    return (
        jobs.join(chosen, "id", "left")
        .withColumn("status", F.when(F.col("__hit"), "running").otherwise(F.col("status")))
        .withColumn("started_at", F.when(F.col("__hit"), as_time(now)).otherwise(F.col("started_at")))
        .drop("__hit")
    )


def failed_jobs(jobs: DataFrame) -> DataFrame:
    return (
        jobs.where(F.col("status") == "failed")
        .select("id", "ticket_id", "finished_at", F.left("last_error", F.lit(200)).alias("err"))
        .orderBy(F.desc("finished_at"), "id")
    )


def retrying_jobs(jobs: DataFrame) -> DataFrame:
    return (
        jobs.where((F.col("status") == "pending") & (F.col("num_attempts") > 0))
        .select("id", "ticket_id", "num_attempts", F.left("last_error", F.lit(200)).alias("err"))
        .orderBy(F.desc("num_attempts"), "id")
    )


def stuck_jobs(jobs: DataFrame, now, hours: int = fv.STUCK_HOURS) -> DataFrame:
    limit = F.timestamp_add("HOUR", F.lit(-hours), as_time(now))
    return jobs.where((F.col("status") == "running") & (F.col("started_at") < limit)).select(
        "id", "ticket_id", "started_at"
    )


def apply_outcomes(jobs: DataFrame, outcomes: DataFrame, now, max_attempts: int = fv.MAX_ATTEMPTS) -> DataFrame:
    """The job table after runs ended.

    ``outcomes`` has (id, exit_code, detail, killed); exit_code is NULL when
    the run was killed or could not start.  A transient fault of a job with
    attempts left sends it back to pending; ``finished_at`` then paces it.
    """
    o = outcomes.select(
        "id", F.col("exit_code").alias("__code"), F.col("detail").alias("__detail"),
        F.coalesce("killed", F.lit(False)).alias("__killed"), F.lit(True).alias("__hit"),
    )
    hit, code = F.coalesce("__hit", F.lit(False)), F.col("__code")
    good = hit & (code == 0) & ~F.col("__killed")
    back = (
        hit & ~F.col("__killed") & code.isNotNull() & (code != 0)
        & rules.is_retryable(F.col("__detail")) & (F.col("num_attempts") < max_attempts)
    )
    bad = hit & ~F.coalesce(good, F.lit(False)) & ~F.coalesce(back, F.lit(False))
    return (
        jobs.join(o, "id", "left")
        .withColumns(
            {
                "status": F.when(good, "succeeded").when(back, "pending").when(bad, "failed").otherwise(F.col("status")),
                "exit_code": F.when(good, 0)
                .when(hit & F.col("__killed"), F.lit(None).cast("int"))
                .when(hit, code)
                .otherwise(F.col("exit_code")),
                "last_error": F.when(back | bad, F.col("__detail")).otherwise(F.col("last_error")),
                "num_attempts": F.when(back, F.col("num_attempts") + 1).otherwise(F.col("num_attempts")),
                "started_at": F.when(back, F.lit(None)).otherwise(F.col("started_at")),
                "finished_at": F.when(hit, as_time(now)).otherwise(F.col("finished_at")),
            }
        )
        .drop("__code", "__detail", "__killed", "__hit")
    )


def _first_after(live: DataFrame, events: DataFrame, fits: Column) -> DataFrame:
    """Each job of ``live`` with the first event ``e`` that ``fits``, or null if there is none."""
    key = live.select(F.col("job_id").alias("__job"), "after", "num_attempts", "finished_at")
    found = (
        events.join(broadcast_if_small(key), F.col("job_id") == F.col("__job"))
        .where((F.col("at") > F.col("after")) & fits)
        .groupBy("job_id")
        .agg(F.min(F.struct("at", "exit_code", "retryable")).alias("e"))
    )
    return live.join(found, "job_id", "left")


def settle_jobs(events: DataFrame, max_attempts: int = fv.MAX_ATTEMPTS) -> DataFrame:
    """The job table after all events (job_id, ts, seq, kind, exit_code, retryable).

    Events of a job count in the order of (ts, seq), and those that do not fit its
    status change nothing.  So a job goes from its first enqueue to the first claim
    after it, to the first end after that, and back to pending ``max_attempts``
    times at most: each round finds the successors of all jobs that are still
    live by a join and a minimum, whatever the number of events of a job.  Jobs
    without an enqueue have no status; events without a job, time or number are left out.
    """
    at = F.struct("ts", "seq").alias("at")
    known = events.where("job_id is not null and ts is not null and seq is not null")
    e = freeze(known.select("job_id", at, "kind", "exit_code", F.coalesce("retryable", F.lit(False)).alias("retryable")))
    no_code, no_time = F.lit(None).cast("int"), F.lit(None).cast(e.schema["at"].dataType["ts"].dataType)
    first = F.min(F.when(F.col("kind") == "enqueue", F.col("at")))
    live = (
        e.groupBy("job_id").agg(first.alias("after"))
        .select(
            "job_id", "after", F.when(F.col("after").isNotNull(), "pending").alias("status"),
            F.when(F.col("after").isNotNull(), 0).alias("num_attempts"), no_code.alias("exit_code"),
            no_time.alias("started_at"), no_time.alias("finished_at"),
        )
    )
    row = ["job_id", "after", "status", "num_attempts", "exit_code", "started_at", "finished_at"]
    rounds, time, code = [], F.col("e.at.ts"), F.col("e.exit_code")
    for _ in range(max_attempts + 1):
        step = freeze(live)
        rounds.append(step.where("status is null or status <> 'pending'"))
        pending = step.where("status = 'pending'")
        # Before its first run a job has not finished and may be claimed at once.
        due = F.col("finished_at").isNull() | (rules.eligible_at(F.col("finished_at"), F.col("num_attempts")) <= F.col("at.ts"))
        claimed = freeze(_first_after(pending, e.where("kind = 'claim'"), due))
        rounds.append(claimed.where("e is null").select(row))
        running = claimed.where("e is not null").withColumns({"after": F.col("e.at"), "status": F.lit("running"), "started_at": time}).drop("e")
        ended = _first_after(running, e.where("kind = 'end'"), F.lit(True))
        good = F.coalesce(code == 0, F.lit(False))
        back = code.isNotNull() & (code != 0) & F.col("e.retryable") & (F.col("num_attempts") < max_attempts)
        hit = F.col("e").isNotNull()
        live = ended.select(
            "job_id", F.when(hit, F.col("e.at")).otherwise(F.col("after")).alias("after"),
            F.when(hit & good, "succeeded").when(hit & back, "pending").when(hit, "failed").otherwise(F.col("status")).alias("status"),
            F.when(hit & back, F.col("num_attempts") + 1).otherwise(F.col("num_attempts")).alias("num_attempts"),
            F.when(hit, code).otherwise(F.col("exit_code")).alias("exit_code"),
            F.when(hit & back, no_time).otherwise(F.col("started_at")).alias("started_at"),
            F.when(hit, time).otherwise(F.col("finished_at")).alias("finished_at"),
        )
    rounds.append(freeze(live))
    return reduce(DataFrame.unionByName, rounds).select([c for c in row if c != "after"])


def apply_fix(table: DataFrame, ids: DataFrame, col: str, value, id_col: str = "id") -> DataFrame:
    """Set one column to a value in the listed rows."""
    hit = ids.select(F.col(id_col)).distinct().withColumn("__hit", F.lit(True))
    return (
        table.join(hit, id_col, "left")
        .withColumn(col, F.when(F.col("__hit"), F.lit(value)).otherwise(F.col(col)))
        .drop("__hit")
    )
