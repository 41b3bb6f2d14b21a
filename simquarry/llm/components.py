"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simquarry.session import freeze


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and a sum over their hashes; equal for equal tables."""
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return r["n"], r["x"]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the component is its least node.

    Large and small stars in turn: a node's larger neighbours are tied to the
    least of its neighbourhood, then its smaller ones.  The number of rounds
    grows with the logarithm of the longest path, no neighbourhood is collected,
    and each round is a written table.  Null ends are left out.
    """
    now = freeze(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(now)
    while mark[0]:
        both = _both(now)
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = freeze(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(small, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        new = freeze(tied.unionByName(small.select("a", F.col("m").alias("b"))).distinct())
        new_mark = _mark(new)
        now = new
        if new_mark == mark:
            break
        mark = new_mark
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
