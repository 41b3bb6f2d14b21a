"""Planning and verifying transfers: parts, batches, reconciliation, pushes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simquarry.functions import fixed_values as fv
from simquarry.functions import rules, text
from simquarry.operators.ranking import rank_in_group


def filter_files(df: DataFrame, regex: str | None, col: str = "name") -> DataFrame:
    """Rows whose file name matches; all rows without a pattern."""
    return df if regex is None else df.where(F.col(col).rlike(regex))


# --- parts and batches -----------------------------------------------------
def _landing(entry: Column) -> Column:
    return text.landing_name(text.second_field(entry))


def number_parts(ticket: DataFrame, wanted: Sequence[str] | DataFrame | None = None, col: str = "irods_tickets") -> DataFrame:
    """Parts with their number in the full list, then filtered by name: a few
    given names, or a table of them (column ``landing``)."""
    parts = (
        ticket.where(~text.blank(F.col(col)))
        .select(F.col("id").alias("ticket_id"), F.posexplode(F.split(col, ";")).alias("pos", "entry"))
        .select("ticket_id", (F.col("pos") + 1).alias("part_num"), "entry", _landing(F.col("entry")).alias("landing"))
    )
    if isinstance(wanted, DataFrame):
        return parts.join(wanted.select("landing"), "landing", "left_semi").select(parts.columns)
    return parts if not wanted else parts.where(F.col("landing").isin(*wanted))


def make_batches(
    ticket: DataFrame,
    wanted: Sequence[str] | None = None,
    threads: int = 8,
    cap: int = fv.MAX_COLLECTIONS_PER_CALL,
    col: str = "irods_tickets",
) -> DataFrame:
    """Parts with the number of their batch, counted from 0 within a ticket.

    All parts of a ticket come from one packed string, so selection, count and
    position are array functions on that row and nothing is shuffled.
    """
    entries = F.split(col, ";")
    if wanted:
        numbered = F.transform(entries, lambda e, i: F.struct((i + 1).alias("part_num"), e.alias("entry")))
        entries = F.filter(numbered, lambda e: _landing(e["entry"]).isin(*wanted))
        number, entry = F.col("part.part_num"), F.col("part.entry")
    else:
        number, entry = F.col("pos") + 1, F.col("part")
    per_batch = F.least(F.greatest(F.lit(1), F.ceil(F.size("parts") / max(1, threads))), F.lit(cap))
    # The size is taken below the explode, once per ticket.
    return (
        ticket.where(~text.blank(F.col(col)))
        .select(F.col("id").alias("ticket_id"), entries.alias("parts"))
        .withColumn("per_batch", per_batch)
        .select("ticket_id", "per_batch", F.posexplode("parts").alias("pos", "part"))
        .select(
            "ticket_id", number.alias("part_num"), entry.alias("entry"), _landing(entry).alias("landing"),
            F.floor(F.col("pos") / F.col("per_batch")).alias("batch"),
        )
    )


def chunk(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int = fv.MAX_OBJECTS_PER_CALL
) -> DataFrame:
    """Chunks of at most ``k`` rows per key, numbered from 0.

    A key may hold most of the rows; see ``ranking``.
    """
    ranked = rank_in_group(df, keys, order, "__rank")
    return ranked.withColumn("chunk", F.floor((F.col("__rank") - 1) / k)).drop("__rank")


def batch_mode(batches: DataFrame, regex: str | None = None) -> DataFrame:
    """``together`` or ``single`` per batch.

    ``batches`` has (batch_id, ticket_id, name), one row per collection.  Two
    collections of one name would be merged locally, so they go one by one.
    """
    # Counting per (batch, name) first keeps a batch with most of the rows
    # spread over its names.
    per_name = batches.groupBy("batch_id", "name").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("ticket_id").alias("t0"),
        F.max("ticket_id").alias("t1"),
    )
    single = F.lit(regex is not None) | (F.max("n") > 1) | (F.min("t0") != F.max("t1"))
    return per_name.groupBy("batch_id").agg(
        F.sum("n").alias("n_parts"), F.when(single, "single").otherwise("together").alias("mode")
    )


def missing_landings(parts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Requested landings (column ``landing``) that no selected ticket has."""
    return wanted.select("landing").distinct().join(parts.select("landing"), "landing", "left_anti")


# --- reconciliation and verification ---------------------------------------
def reconcile(
    objects: DataFrame, manifest: DataFrame, regex: str | None = None, landings: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Objects to fetch, and those whose checksum the manifest contradicts.

    Objects the manifest does not list are kept.  ``landings`` (collection), if
    given, are those with a readable manifest; the others are left out.
    """
    o = filter_files(objects.where(F.col("name") != fv.COMPLETION_MARKER), regex)
    if landings is not None:
        o = o.join(landings.select("collection"), "collection", "left_semi")
    m = manifest.select("collection", "name", F.col("md5").alias("manifest_md5"))
    both = o.join(m, ["collection", "name"], "left")
    conflict = ~text.blank(F.col("manifest_md5")) & ~F.col("manifest_md5").eqNullSafe(F.col("md5"))
    return both.where(~conflict).drop("manifest_md5"), both.where(conflict)


def copy_status(expected: DataFrame, actual: DataFrame, keys: Sequence[str] = ("collection", "name")) -> DataFrame:
    """State of each expected file's copy: missing, size, md5 or ok."""
    a = actual.select(
        *keys, F.col("size").alias("__size"), F.col("md5").alias("__md5"), F.lit(True).alias("__found")
    )
    state = rules.copy_state(F.col("__found"), F.col("__size"), F.col("__md5"), F.col("size"), F.col("md5"))
    return expected.join(a, list(keys), "left").withColumn("state", state).drop("__size", "__md5", "__found")


def retry_plan(status: DataFrame, attempt: int, max_attempts: int = 2) -> tuple[DataFrame, DataFrame]:
    """Files to fetch again, and files that failed for good.

    After the last pass the second table names every file that is not ok, one
    row each, so a part with many failures stays a distributed result.
    """
    bad = status.where(F.col("state") != "ok")
    nothing = bad.where(F.lit(False))
    again = bad if attempt < max_attempts else nothing
    return again.withColumn("attempt", F.lit(attempt + 1)), (nothing if attempt < max_attempts else bad)


def fetch_summary(parts: DataFrame) -> DataFrame:
    """Objects, bytes and rate per ticket from (ticket_id, size, seconds)."""
    return parts.groupBy("ticket_id").agg(
        F.count(F.lit(1)).alias("objects"),
        F.sum("size").alias("bytes"),
        F.try_divide(F.sum("size"), F.sum("seconds")).alias("bytes_per_second"),
    )


# --- pushes ----------------------------------------------------------------
def push_targets(files: DataFrame, types: Sequence[str] = ("all",), data_dir: str = "") -> DataFrame:
    """What a push must deliver: media, originals and processed files.

    ``files`` has (simulation_id, kind, pos, name, size, md5) with kind
    ``original`` or ``processed``.  A file listed twice is delivered once, with
    size and checksum of its last mention.
    """
    flat = (
        files.groupBy("simulation_id", "kind", "name")
        .agg(F.max(F.struct("pos", "size", "md5")).alias("m"))
        .select(
            "simulation_id", "kind", "name",
            F.concat(
                F.lit(data_dir), F.when(F.col("kind") == "processed", "processed/").otherwise(""), F.col("name")
            ).alias("src"),
            F.col("m.size").alias("size"),
            F.lower(F.coalesce("m.md5", F.lit(""))).alias("expected_md5"),
        )
    )
    want = lambda t: "all" in types or t in types
    root = text.repo_id(F.col("simulation_id"))
    base = text.basename(F.col("name"))
    # One pass: each file is emitted for its own list and, if it is one of the
    # media files, for the media list as well.
    lists = F.array_compact(
        F.array(
            F.when(
                F.lit(want("media")) & (F.col("kind") == "processed") & F.col("name").isin(*fv.MEDIA_FILES),
                F.struct(F.lit("media").alias("location"), F.concat_ws("/", root, base).alias("dest")),
            ),
            F.when(
                ((F.col("kind") == "original") & F.lit(want("original")))
                | ((F.col("kind") == "processed") & F.lit(want("processed"))),
                F.struct(
                    F.lit("irods").alias("location"), F.concat_ws("/", root, F.col("kind"), base).alias("dest")
                ),
            ),
        )
    )
    return flat.select("simulation_id", F.inline(lists), "src", "size", "expected_md5")


def push_plan(local: DataFrame, remote: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Skip or upload per local file, with the reason.

    Checksums decide where both are known, sizes otherwise.  Of rows with one
    destination the first by ``order`` counts, or by the other columns.
    """
    r = remote.select(
        F.col("path").alias("dest"), F.col("size").alias("__size"), text.norm_md5(F.col("checksum")).alias("__md5")
    )
    first = dedupe(local, ["dest"], order or [c for c in local.columns if c != "dest"])
    both = first.join(r, "dest", "left")
    known = ~text.blank(F.col("md5")) & ~text.blank(F.col("__md5"))
    mine = F.lower(text.strip(F.col("md5")))
    skip = F.when(known, mine == F.col("__md5")).otherwise(F.col("size") == F.coalesce("__size", F.lit(0)))
    reason = (
        F.when(skip, "already uploaded").when(known, "md5 differs").otherwise("size differs, no md5 to compare")
    )
    return both.withColumns({"skip": skip, "reason": reason}).drop("__size", "__md5")


def push_verify(targets: DataFrame, remote: DataFrame) -> DataFrame:
    """Presence, checksum, verdict and reason per pushed file."""
    r = remote.select(
        F.col("path").alias("dest"), F.col("size").alias("__size"), F.col("checksum").alias("__sum"),
        F.lit(True).alias("__found"),
    )
    present, digest, verified, reason = rules.push_state(
        F.col("__found"), F.col("__size"), F.col("__sum"), F.col("size"), F.col("expected_md5")
    )
    return (
        targets.join(r, "dest", "left")
        .withColumns({"present": present, "remote_md5": digest, "verified": verified, "reason": reason})
        .drop("__size", "__sum", "__found")
    )


def push_complete(verified: DataFrame, sims: DataFrame | None = None) -> DataFrame:
    """Per simulation: complete only with at least one file and all verified."""
    out = verified.groupBy("simulation_id").agg(
        F.count_if("verified").alias("n_verified"), F.count(F.lit(1)).alias("n_files"),
        F.bool_and("verified").alias("complete"),
    )
    if sims is None:
        return out
    return sims.select("simulation_id").distinct().join(out, "simulation_id", "left").select(
        "simulation_id",
        F.coalesce("n_verified", F.lit(0)).alias("n_verified"),
        F.coalesce("n_files", F.lit(0)).alias("n_files"),
        F.coalesce("complete", F.lit(False)).alias("complete"),
    )


def dedupe(df: DataFrame, cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each combination, by an explicit order.

    ``rank = 1`` is applied per input partition before the shuffle, so a value
    with most of the rows sends one row per partition.
    """
    rank = F.row_number().over(Window.partitionBy(*cols).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")
