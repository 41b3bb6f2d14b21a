"""Sinks: FASTA, JSON results, the append-only outcome log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simquarry.functions.text import one_line


def fasta_records(sequences: DataFrame) -> DataFrame:
    """One record per chain: ``>number`` and the sequence."""
    return sequences.where("sequence is not null").select(
        "sim_id", "number", F.concat(F.lit(">"), F.col("number").cast("string"), F.lit("\n"), "sequence").alias("record")
    )


def write_fasta(sequences: DataFrame, path: str) -> None:
    """FASTA text, one folder per structure, chains in order."""
    (
        fasta_records(sequences)
        .repartition("sim_id")
        .sortWithinPartitions("sim_id", "number")
        .select("sim_id", "record")
        .write.partitionBy("sim_id")
        .text(path)
    )


def push_results(verified: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """One result document per simulation: verdict, files, errors.

    The files of a simulation were listed in one import document, which bounds
    the array.
    """
    file = F.struct("location", "src", "dest", "size", "expected_md5", "remote_md5", "present", "verified")
    out = verified.groupBy("simulation_id").agg(
        F.bool_and("verified").alias("complete"), F.sort_array(F.collect_list(file)).alias("files")
    )
    if errors is None:
        return out.withColumn("errors", F.array().cast("array<string>"))
    e = errors.groupBy("simulation_id").agg(F.sort_array(F.collect_list("error")).alias("errors"))
    return out.join(e, "simulation_id", "left").withColumn(
        "errors", F.coalesce("errors", F.array().cast("array<string>"))
    )


def ticket_info(profiles: DataFrame) -> DataFrame:
    """Ticket id and the JSON text kept beside its landings."""
    fields = ["first_name", "last_name", "email", "orcid", "username", "institution"]
    return profiles.select("ticket_id", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("info"))


def series_document(rmsd: DataFrame, rmsf: DataFrame) -> DataFrame:
    """Per simulation the two sampled series, in order, as arrays.

    Series are cut to about a thousand points before they come here.
    """

    def packed(df: DataFrame, order: str, value: str) -> DataFrame:
        rows = F.sort_array(F.collect_list(F.struct(order, value)))
        return df.groupBy("sim_id").agg(F.transform(rows, lambda r: r[value]).alias(value))

    return packed(rmsd, "frame", "rmsd").join(packed(rmsf, "atom_id", "rmsf"), "sim_id")


def import_receipts(actions: DataFrame, server: str, data_dir: str = "") -> DataFrame:
    """Receipt of each imported document."""
    return actions.select(
        F.lit(server).alias("server"), F.col("doc").alias("filename"), F.col("sim_id").alias("simulation_id"),
        F.lit(data_dir).alias("data_dir"),
    )


def write_results(df: DataFrame, path: str) -> None:
    """JSON lines, one document a row, NULL fields kept."""
    df.write.option("ignoreNullFields", "false").json(path)


def outcome_lines(outcomes: DataFrame) -> DataFrame:
    """Log lines of (timestamp, result, bundle, detail); detail on one line."""
    return outcomes.select(
        F.concat_ws("\t", "timestamp", "result", "bundle", one_line(F.col("detail"))).alias("line")
    )


def append_outcomes(outcomes: DataFrame, path: str) -> None:
    outcome_lines(outcomes).write.mode("append").text(path)
