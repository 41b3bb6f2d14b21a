"""Positions within huge groups, without one task holding the group.

``row_number() over (partition by key)`` puts a whole key into one task, and
without a key the whole table.  Here the rows are range-sorted by (key, order),
so that a hot key is spread over many partitions; each partition numbers its
own rows and a table with one row per partition supplies the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simquarry.session import broadcast_if_small, freeze

# monotonically_increasing_id() keeps the partition above bit 33.
_PARTITION_BITS = 33
# Rows of a key that one task may sort.
HEAVY = 1_000_000


def number_rows(df: DataFrame, order: Sequence[Column | str], name: str = "row_no") -> DataFrame:
    """Number all rows 1..n in the given order.

    The sorted rows are frozen, because two evaluations of a range sort may cut
    the partitions differently.  The offset table has one row per partition,
    which bounds both its window and its broadcast.
    """
    placed = freeze(df.orderBy(*order).withColumn("__id", F.monotonically_increasing_id()))
    part = F.shiftright("__id", _PARTITION_BITS)
    offsets = (
        placed.groupBy(part.alias("__part"))
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(
            "__part",
            F.coalesce(
                F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ).alias("__before"),
        )
    )
    within = F.col("__id").bitwiseAND(F.lit((1 << _PARTITION_BITS) - 1))
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__before") + within + 1)
        .drop("__part", "__before", "__id")
    )


def _same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(and_, (F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys))


def _rank_by_sort(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str, count: str | None) -> DataFrame:
    """The global number less the first number of the key; first number and size
    come from one aggregate with map-side combine."""
    numbered = number_rows(df, [*keys, *order], "__no")
    firsts = numbered.groupBy(*keys).agg(
        F.min("__no").alias("__first"), F.count(F.lit(1)).alias("__size")
    )
    return numbered.alias("n").join(firsts.alias("f"), _same_keys("n", "f", keys)).select(
        *[F.col(f"n.{c}") for c in df.columns],
        (F.col("__no") - F.col("__first") + 1).alias(name),
        *([F.col("__size").alias(count)] if count else []),
    )


def _rank_by_window(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str, count: str | None) -> DataFrame:
    group = Window.partitionBy(*keys)
    rank = F.row_number().over(group.orderBy(*order)).cast("long").alias(name)
    return df.select("*", rank, *([F.count(F.lit(1)).over(group).alias(count)] if count else []))


def rank_in_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    name: str = "rank",
    count: str | None = None,
    heavy: int = HEAVY,
) -> DataFrame:
    """Rank 1..n within each key and, if asked for, the size of the group.

    Keys of at most ``heavy`` rows go through a plain window, one shuffle on the
    key.  Keys of more are found by partial counts and numbered by a range sort,
    which spreads them over many tasks.  Both ways give the same numbers, as long
    as ``order`` tells the rows of a key apart.
    """
    big = freeze(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__size")).where(F.col("__size") > heavy).drop("__size"))
    if big.isEmpty():
        return _rank_by_window(df, keys, order, name, count)
    rows, heavies = df.alias("n"), broadcast_if_small(big).alias("b")
    same = _same_keys("n", "b", keys)
    return _rank_by_window(rows.join(heavies, same, "left_anti"), keys, order, name, count).unionByName(
        _rank_by_sort(rows.join(heavies, same, "left_semi"), keys, order, name, count)
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    bucket: str,
    order: Sequence[Column | str],
    values: dict[str, tuple[str, Column]],
    before: Sequence[str] = (),
) -> DataFrame:
    """Running sums or maxima within a key, computed per bucket.

    ``values`` maps a new column to ("sum" or "max", expression); the row itself
    counts, except for the names in ``before``.  ``bucket`` must grow with the
    order (a day, a file block).  A window sees one bucket of one key; earlier
    buckets come in from a table with one row per (key, bucket).
    """
    fold = {"sum": F.sum, "max": F.max}
    kind = {name: fold[how] for name, (how, _) in values.items()}
    held = df.withColumns({f"__v_{name}": value for name, (_, value) in values.items()})
    past = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    earlier = (
        held.groupBy(*keys, bucket)
        .agg(*[kind[name](f"__v_{name}").alias(f"__s_{name}") for name in values])
        .select(*keys, bucket, *[kind[name](f"__s_{name}").over(past).alias(f"__b_{name}") for name in values])
    )
    inside = Window.partitionBy(*keys, bucket).orderBy(*order)

    def total(name: str) -> Column:
        here = F.col(f"__i_{name}")
        if values[name][0] == "max":
            return F.greatest(f"__b_{name}", here)
        return F.coalesce(f"__b_{name}", F.lit(0)) + F.coalesce(here, F.lit(0))

    frames = {
        name: kind[name](f"__v_{name}").over(
            inside.rowsBetween(Window.unboundedPreceding, -1 if name in before else 0)
        )
        for name in values
    }
    out = held.withColumns({f"__i_{name}": column for name, column in frames.items()}).join(earlier, [*keys, bucket])
    return out.select(*df.columns, *[total(name).alias(name) for name in values])


def running_total(
    df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[Column | str], value: Column, name: str
) -> DataFrame:
    """Inclusive running sum of one expression; see ``running``."""
    return running(df, keys, bucket, order, {name: ("sum", value)})
