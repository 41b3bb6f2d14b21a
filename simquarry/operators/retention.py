"""Retention: which landing copies may go, and proof of the permanent copy.

Nothing here deletes; the results are lists and verdicts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simquarry.functions import fixed_values as fv
from simquarry.functions import text
from simquarry.operators.intake import as_time, ticket_map
from simquarry.session import by_merge, freeze, spread


def not_in_flight(df: DataFrame, jobs: DataFrame) -> DataFrame:
    """Rows whose ticket has no pending or running job."""
    busy = jobs.where(F.col("status").isin(*fv.IN_FLIGHT)).select("ticket_id")
    return df.join(busy, "ticket_id", "left_anti")


def with_has_job(df: DataFrame, jobs: DataFrame) -> DataFrame:
    """Flag the rows whose ticket ever had a job."""
    ids = jobs.select("ticket_id").distinct().withColumn("__job", F.lit(True))
    return df.join(ids, "ticket_id", "left").withColumn("has_job", F.coalesce("__job", F.lit(False))).drop("__job")


def classify_landings(upload: DataFrame, ticket: DataFrame, sim: DataFrame, jobs: DataFrame) -> DataFrame:
    """Class of each landing: eligible, abandoned or held.

    Eligible needs both signals: the run was successful, and the simulation it
    produced is known not to be a placeholder (NULL is not false).  Tickets
    with a job in flight are left out.  One aggregate of the jobs answers both
    questions about them, in flight and ever.
    """
    state = jobs.groupBy("ticket_id").agg(F.bool_or(F.col("status").isin(*fv.IN_FLIGHT)).alias("__busy"))
    sims = sim.select(F.col("id").alias("__sim"), "is_placeholder")
    # Landings without a simulation match nothing; a stand-in below zero spreads
    # them over the partitions of the join.
    own = F.coalesce("simulation_id", -1 - F.pmod(F.xxhash64("ticket_id", "landing_id"), F.lit(1 << 20)))
    eligible = F.coalesce(
        F.col("successful") & F.col("simulation_id").isNotNull() & (F.col("is_placeholder") == F.lit(False)),
        F.lit(False),
    )
    kind = F.when(eligible, "eligible").when(F.col("is_abandoned"), "abandoned").otherwise("held")
    return (
        upload.where("landing_id is not null")
        .join(by_merge(ticket.select(F.col("id").alias("ticket_id"))), "ticket_id", "left_semi")
        .join(by_merge(state), "ticket_id", "left")
        .where(~F.coalesce("__busy", F.lit(False)))
        .join(ticket_map(ticket), ["ticket_id", "landing_id"], "left")
        .withColumn("__sim", own)
        .join(by_merge(spread(sims, "__sim")), "__sim", "left")
        .select(
            "ticket_id", "landing_id", "simulation_id", "collection", kind.alias("class"),
            F.col("__busy").isNotNull().alias("has_job"),
        )
    )


def candidate_rollup(classified: DataFrame) -> DataFrame:
    """Per ticket with something to delete: landings, simulations, held."""
    gone = F.col("class") != "held"
    return (
        classified.groupBy("ticket_id")
        .agg(
            F.count_if(gone).alias("landings"),
            F.count_if(gone & F.col("simulation_id").isNotNull()).alias("num_sims"),
            F.count_if(F.col("class") == "abandoned").alias("abandoned"),
            F.count_if(~gone).alias("held"),
            F.bool_or("has_job").alias("has_job"),
        )
        .where(F.col("landings") > 0)
    )


def already_purged(
    cands: DataFrame, collections: DataFrame, local: DataFrame | None = None, full_scan: bool = False
) -> DataFrame:
    """Whether a ticket is gone in both places.

    By default its first and last collection are looked at, with ``full_scan``
    all.  ``local`` lists (ticket_id, landing_id) directories on disk.
    """
    present = spread(collections.select(F.col("collection").alias("__place")), "__place").distinct().withColumn("__there", F.lit(True))
    # A landing without a collection gets a place of its own, which spreads
    # such rows over the partitions of the join.
    place = F.coalesce("collection", F.concat(F.lit("\0"), F.col("landing_id")))
    rows = (
        cands.withColumn("__place", place)
        .join(present, "__place", "left")
        .withColumn("__there", F.coalesce("__there", F.lit(False)))
    )
    if local is not None:
        on_disk = spread(local.select("ticket_id", "landing_id"), "ticket_id", "landing_id").distinct().withColumn("__local", F.lit(True))
        rows = rows.join(on_disk, ["ticket_id", "landing_id"], "left")
    else:
        rows = rows.withColumn("__local", F.lit(False))
    placed = F.when(F.col("collection").isNotNull(), F.col("landing_id"))
    there = (
        F.bool_or(F.col("__there"))
        if full_scan
        else F.min_by("__there", placed) | F.max_by("__there", placed)
    )
    return rows.groupBy("ticket_id").agg(
        (~F.coalesce(there, F.lit(False)) & ~F.coalesce(F.bool_or("__local"), F.lit(False))).alias("purged")
    )


def permanent_files(processed: DataFrame, uploaded: DataFrame, sims: DataFrame) -> DataFrame:
    """All permanent files of the chosen simulations, duplicates kept."""
    chosen = sims.select("simulation_id").distinct()
    cols = ["simulation_id", "local_file_path", "file_size_bytes"]
    return processed.select(*cols).unionByName(uploaded.select(*cols)).join(by_merge(chosen), "simulation_id", "left_semi")


def sample_per_group(df: DataFrame, key: str, k: int, seed: str = "0", path: str = "local_file_path") -> DataFrame:
    """At most ``k`` rows per key, chosen by the digest of seed and path; 0
    keeps all.

    The rank filter becomes a limit per input partition before the shuffle.
    """
    if k == 0:
        return df
    order = [F.md5(F.concat(F.lit(seed), F.col(path)))] + [F.col(c) for c in df.columns]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= k).drop("__rank")


def verify_files(files: DataFrame, inventory: DataFrame, unreachable: DataFrame | None = None) -> DataFrame:
    """Verdict per file against the permanent inventory.

    UNREACHABLE is no answer at all and is kept apart from MISSING and SIZE.
    """
    inv = inventory.select(
        F.col("path").alias("local_file_path"), F.col("size").alias("__size"), F.lit(True).alias("__found")
    )
    out = files.join(by_merge(inv), "local_file_path", "left")
    if unreachable is not None:
        lost = unreachable.select(F.col("path").alias("local_file_path")).distinct().withColumn("__lost", F.lit(True))
        out = out.join(by_merge(lost), "local_file_path", "left")
    else:
        out = out.withColumn("__lost", F.lit(None).cast("boolean"))
    verdict = (
        F.when(F.col("__lost"), "UNREACHABLE")
        .when(F.col("__found").isNull(), "MISSING")
        .when(F.coalesce(F.col("file_size_bytes") != F.col("__size"), F.lit(False)), "SIZE")
        .otherwise("ok")
    )
    return out.withColumn("verdict", verdict).drop("__size", "__found", "__lost")


def unverifiable(cands: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Eligible simulations without file rows, and tickets refused as a whole.

    A ticket is refused if none of its eligible simulations has a file row.
    """
    known = files.select("simulation_id").distinct().withColumn("__known", F.lit(True))
    rows = (
        cands.where((F.col("class") == "eligible") & F.col("simulation_id").isNotNull())
        .select("ticket_id", "simulation_id")
        .distinct()
        .join(by_merge(known), "simulation_id", "left")
    )
    without = rows.where("__known is null").select("ticket_id", "simulation_id")
    refused = (
        rows.groupBy("ticket_id").agg(F.count("__known").alias("n")).where("n = 0").select("ticket_id")
    )
    return without, refused


def hold_back(cands: DataFrame, bad_sims: DataFrame, refused: DataFrame) -> DataFrame:
    """Landings left to delete: no refused ticket, no unverified simulation.

    A simulation counts as unverified only in tickets that had it verified,
    that is, where it has an eligible landing.
    """
    bad = (
        cands.where((F.col("class") == "eligible") & F.col("simulation_id").isNotNull())
        .select("ticket_id", "simulation_id")
        .join(bad_sims.select("simulation_id"), "simulation_id", "left_semi")
    )
    return (
        cands.where(F.col("class") != "held")
        .join(refused.select("ticket_id"), "ticket_id", "left_anti")
        .join(by_merge(bad), ["ticket_id", "simulation_id"], "left_anti")
    )


def purge_totals(results: DataFrame) -> DataFrame:
    """Totals of a run; the two stores are never added together."""
    names = ["present", "freed", "removed", "stalled", "local_present", "local_freed", "local_removed", "local_failed"]
    return results.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])


def purge_verdict(totals: DataFrame) -> DataFrame:
    """Outcome of a run: refused tickets fail it, a run that did nothing is
    silent."""
    did = (
        (F.col("removed") > 0) | (F.col("local_removed") > 0) | (F.col("stalled") > 0) | (F.col("held_unchecked") > 0)
    )
    return totals.withColumn(
        "verdict", F.when(F.col("unverified") > 0, "failed").when(did, "report").otherwise("silent")
    )


def purge_list(
    upload: DataFrame, ticket: DataFrame, sim: DataFrame, jobs: DataFrame, processed: DataFrame,
    uploaded: DataFrame, inventory: DataFrame, verify: int = 1, seed: str = "0",
    unreachable: DataFrame | None = None,
) -> DataFrame:
    """Landings that may be deleted now, after verification."""
    # Both are read several times below, and take many scans to make.
    cands = freeze(classify_landings(upload, ticket, sim, jobs).where(F.col("class") != "held"))
    sims = cands.where(F.col("class") == "eligible").select("simulation_id")
    files = freeze(permanent_files(processed, uploaded, sims))
    verdicts = verify_files(sample_per_group(files, "simulation_id", verify, seed), inventory, unreachable)
    without, refused = unverifiable(cands, files)
    bad = verdicts.where(F.col("verdict") != "ok").select("simulation_id").unionByName(without.select("simulation_id"))
    return hold_back(cands, bad, refused)


# --- disk ------------------------------------------------------------------
def dir_sizes(inventory: DataFrame, depth_dir: str = "dir") -> DataFrame:
    """Files and apparent bytes per directory of an inventory."""
    return inventory.groupBy(depth_dir).agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"), text.human_bytes(F.sum("size")).alias("label")
    )


def empty_shells(entries: DataFrame) -> DataFrame:
    """Ticket directories with no landing sub-directory left, from rows
    (ticket_id, name, is_dir)."""
    return entries.groupBy("ticket_id").agg(F.bool_or("is_dir").alias("d")).where(~F.col("d")).select("ticket_id")


def limit_tickets(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` candidate tickets by id."""
    return df.orderBy("ticket_id").limit(n)


# --- logs ------------------------------------------------------------------
def expired_logs(inventory: DataFrame, now, days: int = 90) -> DataFrame:
    """Ticket logs last written more than ``days`` ago."""
    name = text.basename(F.col("path"))
    cutoff = F.timestamp_add("DAY", F.lit(-days), as_time(now))
    return inventory.where(
        name.startswith(fv.LOG_PREFIX) & name.endswith(fv.LOG_SUFFIX) & (F.col("modified_at") < cutoff)
    )


def orphan_logs(jobs: DataFrame, inventory: DataFrame) -> DataFrame:
    """Jobs whose log is named but not on disk."""
    there = inventory.select(F.col("path").alias("log_file"))
    return jobs.where("log_file is not null").join(there, "log_file", "left_anti").select("id", "log_file")
