"""Backups: names, replica audits, surviving snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simquarry.functions import fixed_values as fv
from simquarry.functions import text


def snapshot_names(ts: Column, prefix: str = fv.SNAPSHOT_PREFIX, suffix: str = fv.SNAPSHOT_SUFFIX) -> dict[str, Column]:
    """Rotation slot, month archive and latest name for a backup time."""
    return {
        "slot": F.concat(F.lit(prefix), F.date_format(ts, "dd"), F.lit(suffix)),
        "archive": F.concat(F.lit(prefix), F.date_format(ts, "yyyy-MM-dd"), F.lit(suffix)),
        "latest": F.lit(f"{prefix}latest{suffix}"),
    }


def needs_archive(names: DataFrame, months: DataFrame, prefix: str = fv.SNAPSHOT_PREFIX) -> DataFrame:
    """Per month (column ``month``, yyyy-MM) whether no archive exists yet.

    The month is cut from the name, so this is an equi-join.
    """
    length = len(prefix) + 7
    have = (
        names.where(F.length("name") >= length)
        .select(F.left("name", F.lit(length)).alias("__stem"))
        .distinct()
        .withColumn("__have", F.lit(True))
    )
    return (
        months.withColumn("__stem", F.concat(F.lit(prefix), F.col("month")))
        .join(have, "__stem", "left")
        .select(*months.columns, F.col("__have").isNull().alias("needed"))
    )


def replica_problems(objects: DataFrame, replicas: DataFrame, expected: int = fv.EXPECTED_REPLICAS) -> DataFrame:
    """Complaints about stored objects, one row each.

    ``objects`` has (path, size, expected_size, expected_md5).  Rows, not a
    list per object, so an object with very many replicas needs no large row.
    """
    comma = lambda c: F.format_number(c, 0)
    where = F.concat(F.lit("replica "), F.col("replica_no").cast("string"), F.lit(" on "), F.col("resource"))
    digest = text.norm_md5(F.coalesce("checksum", F.lit("")))
    mine = F.array_compact(
        F.array(
            F.when(
                F.col("status") != 1,
                F.concat(where, F.lit(" is not good (status "), F.col("status").cast("string"), F.lit(")")),
            ),
            F.when(
                F.col("size") != F.col("expected_size"),
                F.concat(where, F.lit(" size "), comma("size"), F.lit(" != local "), comma("expected_size")),
            ),
            F.when(digest == "", F.concat(where, F.lit(" has no registered checksum"))).when(
                digest != F.col("expected_md5"),
                F.concat(where, F.lit(" md5 "), digest, F.lit(" != local "), F.col("expected_md5")),
            ),
        )
    )
    wanted = objects.select("path", "expected_size", "expected_md5")
    per_replica = replicas.join(wanted, "path").select("path", F.explode(mine).alias("problem"))
    counts = replicas.groupBy("path").agg(F.count(F.lit(1)).alias("__n"))
    n = F.coalesce("__n", F.lit(0))
    whole = F.array_compact(
        F.array(
            F.when(
                F.col("size") != F.col("expected_size"),
                F.concat(F.lit("object size "), comma("size"), F.lit(" != local "), comma("expected_size")),
            ),
            F.when(
                n < expected,
                F.concat(F.lit("only "), n.cast("string"), F.lit(f" replica(s), expected {expected}")),
            ),
        )
    )
    per_object = objects.join(counts, "path", "left").select("path", F.explode(whole).alias("problem"))
    return per_object.unionByName(per_replica)


def stored_report(objects: DataFrame, replicas: DataFrame) -> DataFrame:
    """Per object, by name: whether replica sizes differ, whether one is bad,
    and the number of problems."""
    # min <> max stands for "more than one distinct size" and combines map-side.
    r = replicas.groupBy("path").agg(
        (F.min("size") != F.max("size")).alias("disagree"), F.bool_or(F.col("status") != 1).alias("not_good")
    )
    flag = lambda c: F.coalesce(c, F.lit(False))
    return (
        objects.join(r, "path", "left")
        .select(
            "path", "size", flag("disagree").alias("disagree"), flag("not_good").alias("not_good"),
            (flag("disagree").cast("int") + flag("not_good").cast("int")).alias("problems"),
        )
        .orderBy("path")
    )


def surviving_snapshots(runs: DataFrame) -> DataFrame:
    """Snapshots that still exist after all runs (ts, run_id, ok).

    The newest success per day-of-month slot, the first success of each month,
    and the newest of all.  All three are min/max aggregates with map-side
    combine; slots are at most 31 rows, months a few per year.
    """
    good = runs.where("ok")
    row = F.struct("ts", "run_id")
    slots = good.groupBy(snapshot_names(F.col("ts"))["slot"].alias("name")).agg(F.max(row).alias("r"))
    months = (
        good.groupBy(F.date_format("ts", "yyyy-MM").alias("m"))
        .agg(F.min(row).alias("r"))
        .select(snapshot_names(F.col("r.ts"))["archive"].alias("name"), "r")
    )
    latest = good.agg(F.max(row).alias("r")).where("r is not null").select(
        snapshot_names(F.col("r.ts"))["latest"].alias("name"), "r"
    )
    return slots.unionByName(months).unionByName(latest).select("name", "r.ts", "r.run_id")
