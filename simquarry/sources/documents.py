"""Nested JSON documents: completion manifests and imports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simquarry.functions.text import dirname
from simquarry.sources.files import plain_path, read_inventory

_MANIFEST = "files array<struct<irods_path: string, md5_hash: string>>, _bad string"

_FILE = "name: string, file_type: string, size: bigint, md5_sum: string, description: string, is_primary: boolean"
_SIMULATION = (
    "lead_contributor_orcid: string, software_name: string, software_version: string, simulation_id: bigint, "
    "alias: string, unique_file_hash_string: string, run_commands: string, description: string, "
    "short_description: string, duration: double, sampling_frequency: double, integration_timestep_fs: double, "
    "water_type: string, water_density: double, rmsd_values: array<double>, rmsf_values: array<double>, "
    "forcefield: string, forcefield_comments: string, fasta_sequence: string, num_replicates: int, "
    "temperature_kelvin: double, protonation_method: string, is_embargoed: boolean, is_coarse_grained: boolean, "
    f"original_files: array<struct<{_FILE}>>, processed_files: array<struct<{_FILE}>>, replicates: array<string>, "
    "contributors: array<struct<name: string, email: string, institution: string, orcid: string, rank: int>>, "
    "ligands: array<struct<name: string, smiles: string>>, "
    "solutes: array<struct<name: string, concentration_mol_liter: double>>, "
    "external_links: array<struct<url: string, label: string>>, "
    "papers: array<struct<title: string, authors: string, journal: string, volume: string, year: int, doi: string>>, "
    "uniprots: array<struct<uniprot_id: string, name: string, sequence: string>>, "
    "pdb: struct<pdb_id: string, title: string, classification: string>"
)
_IMPORT = f"simulation struct<{_SIMULATION}>, _bad string"

_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}


def _read_whole(spark: SparkSession, path: str) -> DataFrame:
    """One row per document; a document is one value of JSON and not split.

    Files of zero bytes, which the file sources leave out, come from the
    inventory, because an empty document must be seen to be reported.
    """
    full = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(
        plain_path(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("text")
    )
    empty = read_inventory(spark, path).where("size = 0").select("path", F.lit("").alias("text"))
    return full.unionByName(empty)


def parse_manifests(docs: DataFrame, key: str = "collection") -> tuple[DataFrame, DataFrame]:
    """Listed files (key, name, md5), and the keys whose manifest is unreadable.

    The last entry of a repeated name wins.
    """
    parsed = docs.select(key, F.from_json("text", _MANIFEST, _PERMISSIVE).alias("m"))
    good = F.col("m._bad").isNull() & F.col("m.files").isNotNull()
    rows = (
        parsed.where(good)
        .select(key, F.posexplode("m.files").alias("pos", "f"))
        .groupBy(key, F.col("f.irods_path").alias("name"))
        .agg(F.max_by("f.md5_hash", "pos").alias("md5"))
    )
    return rows, parsed.where(~F.coalesce(good, F.lit(False))).select(key)


def read_manifests(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Manifests by the folder they lie in."""
    docs = _read_whole(spark, path).withColumn("collection", dirname(F.col("path")))
    return parse_manifests(docs)


def parse_imports(docs: DataFrame, key: str = "doc") -> tuple[DataFrame, DataFrame]:
    """Import documents (key and the fields of ``simulation``), and bad keys."""
    parsed = docs.select(key, F.from_json("text", _IMPORT, _PERMISSIVE).alias("d"))
    good = F.col("d._bad").isNull() & F.col("d.simulation").isNotNull()
    fields = T._parse_datatype_string(_IMPORT)["simulation"].dataType.names
    rows = parsed.where(good).select(
        key, *[F.col(f"d.simulation.{f}").alias("hash" if f == "unique_file_hash_string" else f) for f in fields]
    )
    return rows, parsed.where(~F.coalesce(good, F.lit(False))).select(key)


def read_imports(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return parse_imports(_read_whole(spark, path).withColumnRenamed("path", "doc"))


def elements(docs: DataFrame, field: str, sim_id: str = "sim_id", single: bool = False) -> DataFrame:
    """Elements of one array of the documents: doc, pos, simulation_id and the
    fields of the element; ``single`` for a field that is one struct."""
    array = F.when(F.col(field).isNotNull(), F.array(field)) if single else F.col(field)
    out = docs.select("doc", F.col(sim_id).alias("simulation_id"), F.posexplode(array).alias("pos", "e"))
    if isinstance(out.schema["e"].dataType, T.StructType):
        return out.select("doc", F.col("pos").cast("long").alias("pos"), "simulation_id", "e.*")
    return out.withColumn("pos", F.col("pos").cast("long"))
