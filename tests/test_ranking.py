"""Distributed positions equal the plain window on data with a hot key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from simquarry.operators.ranking import number_rows, rank_in_group, running_total


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.6 else f"k{rnd.randrange(20)}", rnd.randrange(10**6), k) for k in range(3000)]
    rows += [(None, 5, 3000), (None, 4, 3001)]
    return spark.createDataFrame(rows, "key string, at long, id long").repartition(7)


def test_number_rows(skewed):
    got = {r["id"]: r["row_no"] for r in number_rows(skewed, ["at", "id"]).collect()}
    want = {r["id"]: k for k, r in enumerate(sorted(skewed.collect(), key=lambda r: (r["at"], r["id"])), 1)}
    assert got == want


@pytest.mark.parametrize("heavy", [0, 150, 10**6])
def test_rank_in_group(skewed, heavy):
    """By range sort, by range sort for the hot key only, and by a window."""
    w = Window.partitionBy("key")
    plain = skewed.withColumn("rank", F.row_number().over(w.orderBy("at", "id"))).withColumn("n", F.count("*").over(w))
    ours = rank_in_group(skewed, ["key"], ["at", "id"], "rank", "n", heavy)
    pick = lambda df: sorted(tuple(r) for r in df.select("id", "rank", "n").collect())
    assert pick(ours) == pick(plain)


def test_small_keys_need_no_sort_of_all_rows(skewed):
    plan = lambda heavy: rank_in_group(skewed, ["key"], ["at", "id"], heavy=heavy)._jdf.queryExecution().toString()
    assert "hashpartitioning(key" in plan(10**6) and "Window" in plan(10**6)
    assert "Union" in plan(150)


def test_running_total(skewed):
    keyed = skewed.where("key is not null").withColumn("bucket", F.floor(F.col("at") / 50000))
    ours = running_total(keyed, ["key"], "bucket", ["at", "id"], F.col("id") % 3, "total")
    plain = keyed.withColumn("total", F.sum(F.col("id") % 3).over(Window.partitionBy("key").orderBy("at", "id")))
    pick = lambda df: sorted(tuple(r) for r in df.select("id", "total").collect())
    assert pick(ours) == pick(plain)
    assert set(ours.columns) == {*keyed.columns, "total"}


def test_one_row_and_no_row(skewed):
    assert [r["row_no"] for r in number_rows(skewed.where("id = 7"), ["at"]).collect()] == [1]
    assert number_rows(skewed.where("id < 0"), ["at"]).collect() == []
