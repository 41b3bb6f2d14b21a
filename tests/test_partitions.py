"""Whole jobs, dealt into partitions that do not grow with the tables."""

import os

import pytest

from simquarry.operators import folding, retention
from simquarry.plans import views
from simquarry.plans.catalog import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_chunks_run_over_many_orders(spark):
    """Keys of 13 characters hold thousands of objects, so there are many chunks of 100."""
    assert QUERIES["w3_chunk"](spark, SF_DIR).where("chunk > 1").count() > 0


@pytest.mark.parametrize("name", ["v_landing", "v_ticket", "v_objects"])
def test_line_items_are_dealt_before_they_are_aggregated(spark, monkeypatch, name):
    monkeypatch.setattr(views, "ROWS_A_PARTITION", 1000)
    df = views.view(spark, SF_DIR, name)
    rows = views.view(spark, SF_DIR, "lineitem").count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert f"{-(-rows // 1000)}), REPARTITION_BY_NUM" in plan
    few = df.exceptAll(views.query(spark, SF_DIR, f"select * from {name}"))
    assert few.isEmpty()


def test_joins_of_landings_keep_their_partitions(make):
    upload = make("ticket_id long, landing_id string, simulation_id long, successful boolean, is_abandoned boolean", (1, "L1", 1, True, False))
    ticket, jobs = make("id long, irods_tickets string", (1, "MDRSubmit_L1:/z/L1")), make("ticket_id long, status string", (9, "failed"))
    classes = retention.classify_landings(upload, ticket, make("id long, is_placeholder boolean", (1, False)), jobs)
    count = lambda df: df._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM")
    assert count(classes) == 2
    purged = retention.already_purged(classes, make("collection string", ("/z/L1",)), make("ticket_id long, landing_id string", (1, "L1")))
    assert count(purged) >= 4
    assert [tuple(r) for r in purged.collect()] == [(1, False)]


def test_folds_keep_their_partitions(make):
    rows = make("k long, at long", (1, 2), (1, 1), (2, 5))

    class Last:
        def __init__(self, _k):
            self.row = None

        def step(self, row):
            self.row = row
            return []

        def finish(self):
            return [self.row]

    out = folding.fold(rows, "k", ["at"], Last, rows.schema)
    assert "REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2), (2, 5)]


#: Sides that may be broadcast: refused tickets and bad simulations of j11, told by a product of sizes.
@pytest.mark.parametrize(("name", "most"), [("j11_hold_back", 2), ("j9_verify_files", 0), ("a26_purge_verdict", 0)])
def test_sides_that_grow_are_not_broadcast(spark, name, most):
    """Spark takes files and inventories, made from the keys of a small table, for a hundredth of their size."""
    assert QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") <= most
