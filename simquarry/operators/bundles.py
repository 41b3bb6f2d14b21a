"""Backlog of directly uploaded bundles, their outcome log, missing SMILES."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simquarry.functions.text import blank, strip

SIDECAR = ".md5"


def latest_outcomes(log: DataFrame, key: str = "bundle") -> DataFrame:
    """The last line per key, by sequence number."""
    rest = [c for c in log.columns if c not in (key, "seq")]
    return (
        log.groupBy(key)
        .agg(F.max(F.struct("seq", *rest)).alias("r"))
        .select(key, "r.seq", *[f"r.{c}" for c in rest])
    )


def next_bundles(objects: DataFrame, log: DataFrame, k: int | None = 1) -> DataFrame:
    """The ``k`` oldest ready bundles without a line in the log; all if None.

    The sidecar is written last, so a non-empty one means the bundle is ready.
    """
    ready = (
        objects.where(F.col("name").endswith(SIDECAR) & (F.col("size") > 0))
        .select(
            F.substring("name", F.lit(1), F.length("name") - len(SIDECAR)).alias("bundle"), "create_time"
        )
    )
    left = ready.join(log.select("bundle"), "bundle", "left_anti")
    return left if k is None else left.orderBy("create_time", "bundle").limit(k)


def fill_smiles(ligands: DataFrame, sim: DataFrame, table: DataFrame) -> DataFrame:
    """Fill a missing ligand SMILES from (pdb_id, ligand, smiles).

    Refused, with the reason: several ligands missing in one simulation, no
    entry for the structure, an empty entry, another ligand name.
    """
    missing = blank(F.col("smiles"))
    # Per simulation an aggregate, not a window: it combines map-side.
    counts = ligands.groupBy("simulation_id").agg(F.count_if(missing).alias("__missing"))
    pdb = sim.select("simulation_id", F.lower("pdb_id").alias("pdb_id"))
    entries = table.select(
        F.lower("pdb_id").alias("pdb_id"), F.upper(strip(F.col("ligand"))).alias("__name"),
        strip(F.col("smiles")).alias("__smiles"),
    )
    named = entries.groupBy("pdb_id", "__name").agg(F.max("__smiles").alias("__smiles"), F.lit(True).alias("__named"))
    listed = entries.select("pdb_id").distinct().withColumn("__listed", F.lit(True))
    reason = (
        F.when(~missing, "given")
        .when(F.col("__missing") > 1, "several missing")
        .when(F.col("__listed").isNull(), "no entry")
        .when(F.col("__named").isNull(), "name mismatch")
        .when(blank(F.col("__smiles")), "empty entry")
        .otherwise("filled")
    )
    return (
        ligands.join(counts, "simulation_id")
        .join(pdb, "simulation_id", "left")
        .withColumn("__name", F.upper("name"))
        .join(listed, "pdb_id", "left")
        .join(named, ["pdb_id", "__name"], "left")
        .withColumn("reason", reason)
        .withColumn("smiles", F.when(F.col("reason") == "filled", F.col("__smiles")).otherwise(F.col("smiles")))
        .drop("__missing", "__name", "__named", "__listed", "__smiles", "pdb_id")
    )
