"""Members that hang together through shared keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simquarry.session import freeze


def _roots(near: DataFrame) -> DataFrame:
    """Labels of (member, label) followed to their end; members that are their own label are left out.

    The label of a member is never greater than the member, so the way ends.  Each
    round follows the label of a label, so that its reach doubles.
    """
    at = near.where("label <> member")
    while True:
        onward = at.select(F.col("member").alias("label"), F.col("label").alias("far"))
        moved = freeze(at.join(onward, "label", "left").select("member", F.coalesce("far", "label").alias("label"), F.col("far").isNotNull().alias("moved")))
        at = moved.select("member", "label")
        if moved.where("moved").isEmpty():
            return at


def connected(pairs: DataFrame) -> DataFrame:
    """(member, component) of every member of ``pairs`` (member, key): the least member it is tied to.

    Members of a key are tied, and so on.  Each round ties a member to the least one
    of its keys and follows these ties to their roots; then a root stands for its
    members, and only keys that still have two go on, so that rounds shrink fast.  A
    round is a written table, and a key with many members is only ever aggregated and
    joined, never collected.  Members without a key are their own.
    """
    rows = pairs.where("key is not null").select("member", "key")
    rounds: list[DataFrame] = []
    while True:
        shared = rows.groupBy("key").agg(F.min("member").alias("least"), F.max("member").alias("most")).where("least <> most")
        tied = freeze(rows.join(shared.select("key", "least"), "key"))
        if tied.isEmpty():
            break
        roots = _roots(tied.groupBy("member").agg(F.min("least").alias("label")))
        rounds.append(roots)
        rows = tied.join(roots, "member", "left").select(F.coalesce("label", "member").alias("member"), "key")
    everyone = pairs.select("member").distinct()
    if not rounds:
        return everyone.select("member", F.col("member").alias("component"))
    labels = rounds.pop()
    for roots in reversed(rounds):
        later = labels.select(F.col("member").alias("label"), F.col("label").alias("far"))
        labels = labels.unionByName(roots.join(later, "label", "left").select("member", F.coalesce("far", "label").alias("label")))
    return everyone.join(labels, "member", "left").select("member", F.coalesce("label", "member").alias("component"))
