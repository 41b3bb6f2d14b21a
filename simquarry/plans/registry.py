"""Register of named queries and of their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from simquarry.plans.views import oracle, view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


class Inputs:
    """The views of one scale factor by name: ``inputs.v_ticket``."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)


def named(name: str, sql: str | None = None, extra: dict[str, str] | None = None):
    """Register a function of ``Inputs`` as a query, with its SQL if there is one."""

    def keep(fn: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = oracle(sql, extra)
        return fn

    return keep
