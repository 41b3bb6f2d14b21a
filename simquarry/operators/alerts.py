"""Failure episodes and alerts of job series in batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simquarry.operators.ranking import running, running_total
from simquarry.session import freeze


def with_islands(runs: DataFrame) -> DataFrame:
    """Runs with the number of successes up to and including them.

    Failures that share it follow the same success.  Windows see one day of
    one label; earlier days come in as sums.
    """
    good = (F.col("exit_code") == 0).cast("int")
    daily = runs.withColumn("__day", F.date_trunc("day", "ts"))
    return running_total(daily, ["label"], "__day", ["ts", "seq"], good, "island").drop("__day")


def failure_episodes(runs: DataFrame) -> DataFrame:
    """Failures in a row per label: first, last, count, and whether a success
    followed."""
    marked = with_islands(runs)
    last = marked.groupBy("label").agg(F.max("island").alias("__last"))
    episodes = (
        marked.where("exit_code <> 0")
        .groupBy("label", "island")
        .agg(F.min("ts").alias("first_failure"), F.max("ts").alias("last_failure"), F.count(F.lit(1)).alias("failures"))
    )
    return episodes.join(last, "label").withColumn("recovered", F.col("island") < F.col("__last")).drop("__last")


# --- alerts ----------------------------------------------------------------
_EPISODE = ["label", "island"]


def _next_due(nodes: DataFrame) -> DataFrame:
    """For each delivered failure the next one at least a period later.

    ``nodes`` has (label, island, t, id, bucket), buckets being one period
    wide.  The next one lies in the following bucket, at the same offset or
    later, or it is the first of a later bucket.  So a window sees at most one
    period of one episode and the node rows that point into it.
    """
    slots = nodes.select(*_EPISODE, "bucket", "t", F.col("id").alias("node"), F.lit(None).cast(nodes.schema["id"].dataType).alias("asks"))
    asks = nodes.select(
        *_EPISODE, (F.col("bucket") + 1).alias("bucket"), F.col("due").alias("t"),
        F.lit(None).cast(nodes.schema["id"].dataType).alias("node"), F.col("id").alias("asks"),
    )
    # At equal times the nodes come after the questions, so they answer them.
    ahead = (
        Window.partitionBy(*_EPISODE, "bucket")
        .orderBy(F.col("t"), F.col("asks").isNull(), "node")
        .rowsBetween(0, Window.unboundedFollowing)
    )
    answered = (
        slots.unionByName(asks)
        .withColumn("found", F.min("node").over(ahead))
        .where("asks is not null")
        .select(*_EPISODE, F.col("asks").alias("id"), "bucket", "found")
    )
    firsts = nodes.groupBy(*_EPISODE, "bucket").agg(F.min("id").alias("first"))
    # One row per episode and period: the first node of any later bucket.
    later = Window.partitionBy(*_EPISODE).orderBy("bucket").rowsBetween(1, Window.unboundedFollowing)
    reach = (
        firsts.unionByName(answered.select(*_EPISODE, "bucket").distinct().withColumn("first", F.lit(None).cast(nodes.schema["id"].dataType)))
        .groupBy(*_EPISODE, "bucket")
        .agg(F.min("first").alias("first"))
        .select(*_EPISODE, "bucket", F.min("first").over(later).alias("after"))
    )
    return answered.join(reach, [*_EPISODE, "bucket"]).select(
        *_EPISODE, "id", F.coalesce("found", "after").alias("next")
    )


def _chains(roots: DataFrame, steps: DataFrame) -> DataFrame:
    """All nodes reached from the roots; each round doubles the step length,
    so a chain of n alerts takes log2(n) rounds."""
    reached, steps = freeze(roots), freeze(steps.where("next is not null"))
    while True:
        found = freeze(reached.join(steps, [*_EPISODE, "id"]).select(*_EPISODE, F.col("next").alias("id")))
        if found.isEmpty():
            return reached
        reached = reached.unionByName(found)
        onward = steps.select(*_EPISODE, F.col("id").alias("next"), F.col("next").alias("far"))
        steps = freeze(steps.join(onward, [*_EPISODE, "next"]).select(*_EPISODE, "id", F.col("far").alias("next")))


def alerts(runs: DataFrame, threshold: int = 3, repeat_hours: float = 24) -> DataFrame:
    """Messages of a finished series; the batch form of ``alert_stream``.

    Failures in a row are independent of what was before the last success, so
    the first alert of an episode is an aggregate, repeats are a chain of
    pointers, and recovery messages belong to the successes that follow an
    alerted episode.  No task ever holds a label.
    """
    bad = F.col("exit_code") != 0
    placed = running(
        runs.withColumns({"__day": F.date_trunc("day", "ts"), "t": F.unix_timestamp(F.date_trunc("second", "ts").cast("timestamp"))}),
        ["label"], "__day", ["ts", "seq"],
        {"island": ("sum", (~bad).cast("long")), "fails": ("sum", bad.cast("long"))},
    ).withColumn("id", F.struct("ts", "seq"))
    episodes = placed.groupBy(*_EPISODE).agg(
        F.min(F.col("fails") - bad.cast("long")).alias("base"),
        F.min(F.when(bad, F.col("ts"))).alias("since"),
        F.max("fails").alias("end"),
    )
    counted = placed.join(episodes, _EPISODE).withColumn("n", F.col("fails") - F.col("base"))
    tries = freeze(
        counted.where(bad & (F.col("n") >= threshold)).select(*_EPISODE, "id", "t", "n", "since", "end", "delivered")
    )
    firsts = tries.where("delivered").groupBy(*_EPISODE).agg(F.min(F.struct("id", "t")).alias("f"))
    firsts = firsts.select(*_EPISODE, F.col("f.id").alias("first"), F.col("f.t").alias("first_t"))
    state = tries.join(firsts, _EPISODE, "left")
    told = state.where(F.col("first").isNull() | (F.col("id") <= F.col("first"))).select(*_EPISODE, "id", "n", "since", "delivered")

    if repeat_hours > 0:
        period = int(round(repeat_hours * 3600))
        after = freeze(state.where(F.col("id") > F.col("first")))
        # Only episodes that outlast a period can repeat.
        long = after.groupBy(*_EPISODE).agg(F.max(F.col("t") - F.col("first_t")).alias("span")).where(F.col("span") >= period)
        roots = firsts.join(long.select(*_EPISODE), _EPISODE, "left_semi")
        nodes = (
            after.where("delivered").select(*_EPISODE, "id", "t").join(long.select(*_EPISODE), _EPISODE, "left_semi")
            .unionByName(roots.select(*_EPISODE, F.col("first").alias("id"), F.col("first_t").alias("t")))
            .withColumns({"due": F.col("t") + period, "bucket": F.floor(F.col("t") / period)})
        )
        chain = _chains(roots.select(*_EPISODE, F.col("first").alias("id")), _next_due(freeze(nodes)))
        marked = (
            after.join(long.select(*_EPISODE), _EPISODE, "left_semi")
            .unionByName(state.where(F.col("id") == F.col("first")))
            .join(chain.withColumn("alert", F.lit(True)), [*_EPISODE, "id"], "left")
            .withColumn("bucket", F.floor(F.col("t") / period))
        )
        last = running(
            marked, _EPISODE, "bucket", ["id"], {"last": ("max", F.when(F.col("alert"), F.col("t")))}, before=["last"]
        )
        told = told.unionByName(
            last.where((F.col("id") > F.col("first")) & (F.col("t") - F.col("last") >= period))
            .select(*_EPISODE, "id", "n", "since", "delivered")
        )
    failed = told.select("label", "id", F.lit("failed").alias("kind"), F.col("n").alias("failures"), "since", "delivered")

    # Successes after an alerted episode share its running count of failures.
    alerted = episodes.join(firsts.select(*_EPISODE), _EPISODE, "left_semi").select(
        "label", F.col("end").alias("fails"), (F.col("end") - F.col("base")).alias("failures"), "since"
    )
    good = placed.where(~bad).select("label", "fails", "id", "delivered").join(alerted, ["label", "fails"])
    heard = good.where("delivered").groupBy("label", "fails").agg(F.min("id").alias("heard"))
    recovered = (
        good.join(heard, ["label", "fails"], "left")
        .where(F.col("heard").isNull() | (F.col("id") <= F.col("heard")))
        .select("label", "id", F.lit("recovered").alias("kind"), "failures", "since", "delivered")
    )
    return failed.unionByName(recovered).select(
        "label", "id.ts", "id.seq", "kind", "failures", F.date_trunc("second", "since").alias("since"), "delivered"
    )
