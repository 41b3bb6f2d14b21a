"""Repository tables with fixed schemas, from parquet folders or over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEXT, _LONG, _INT = T.StringType(), T.LongType(), T.IntegerType()
_BOOL, _TIME, _DOUBLE = T.BooleanType(), T.TimestampNTZType(), T.DoubleType()
_SERIES = T.ArrayType(T.DoubleType())

_COLUMNS: dict[str, dict[str, T.DataType]] = {
    "ticket": {
        "id": _LONG, "token": _TEXT, "full_token": _TEXT, "irods_tickets": _TEXT, "created_at": _TIME,
        "created_by_id": _LONG, "ticket_type": _TEXT, "upload_notification_sent": _BOOL, "used_for_upload": _BOOL,
        "processing_complete": _BOOL,
    },
    "user": {
        "id": _LONG, "username": _TEXT, "first_name": _TEXT, "last_name": _TEXT, "institution": _TEXT, "email": _TEXT,
    },
    "account": {"user_id": _LONG, "provider": _TEXT, "uid": _TEXT},
    "process_job": {
        "id": _LONG, "ticket_id": _LONG, "server": _TEXT, "status": _TEXT, "exit_code": _INT, "last_error": _TEXT,
        "log_file": _TEXT, "num_attempts": _INT, "created_at": _TIME, "started_at": _TIME, "finished_at": _TIME,
    },
    "upload_instance": {
        "ticket_id": _LONG, "landing_id": _TEXT, "simulation_id": _LONG, "successful": _BOOL, "is_abandoned": _BOOL,
    },
    "simulation": {
        "id": _LONG, "unique_file_hash_string": _TEXT, "alias": _TEXT, "software_id": _LONG, "created_by_id": _LONG,
        "run_commands": _TEXT, "description": _TEXT, "short_description": _TEXT, "duration": _DOUBLE,
        "sampling_frequency": _DOUBLE, "integration_timestep_fs": _DOUBLE, "water_type": _TEXT,
        "water_density": _DOUBLE, "rmsd_values": _SERIES, "rmsf_values": _SERIES, "forcefield": _TEXT,
        "forcefield_comments": _TEXT, "fasta_sequence": _TEXT, "num_replicates": _INT, "temperature": _DOUBLE,
        "protonation_method": _TEXT, "is_placeholder": _BOOL, "is_deprecated": _BOOL, "is_public": _BOOL,
        "is_embargoed": _BOOL, "is_coarse_grained": _BOOL, "creation_date": _TIME, "pdb_id": _LONG,
        "md_repo_ticket_id": _LONG, "irods_ticket": _TEXT,
    },
    "processed_file": {
        "id": _LONG, "simulation_id": _LONG, "filename": _TEXT, "file_type": _TEXT, "description": _TEXT,
        "local_file_path": _TEXT, "file_size_bytes": _LONG, "md5_hash": _TEXT,
    },
    "software": {"id": _LONG, "name": _TEXT, "version": _TEXT},
    "contribution": {
        "id": _LONG, "simulation_id": _LONG, "name": _TEXT, "email": _TEXT, "institution": _TEXT, "orcid": _TEXT,
        "rank": _INT,
    },
    "uniprot": {"id": _LONG, "uniprot_id": _TEXT, "name": _TEXT, "amino_length": _INT, "sequence": _TEXT},
    "simulation_uniprot": {"id": _LONG, "uniprot_id": _LONG, "simulation_id": _LONG},
    "pdb": {"id": _LONG, "pdb_id": _TEXT, "title": _TEXT, "classification": _TEXT},
    "ligand": {"id": _LONG, "name": _TEXT, "smiles_string": _TEXT, "simulation_id": _LONG},
    "solute": {"id": _LONG, "name": _TEXT, "concentration": _DOUBLE, "simulation_id": _LONG},
    "external_link": {"id": _LONG, "url": _TEXT, "label": _TEXT, "simulation_id": _LONG},
    "pub": {
        "id": _LONG, "title": _TEXT, "authors": _TEXT, "journal": _TEXT, "volume": _TEXT, "year": _INT, "doi": _TEXT,
    },
    "simulation_pub": {"id": _LONG, "pub_id": _LONG, "simulation_id": _LONG},
    "replicate": {"id": _LONG, "simulation_id": _LONG, "trajectory_file_name": _TEXT},
    "download_processed_file": {"id": _LONG, "simulationprocessedfile_id": _LONG},
    "download_uploaded_file": {"id": _LONG, "simulationuploadedfile_id": _LONG},
    "object": {
        "collection": _TEXT, "name": _TEXT, "size": _LONG, "md5": _TEXT, "create_time": _TIME, "replica_number": _INT,
    },
    "replica": {
        "path": _TEXT, "replica_no": _INT, "resource": _TEXT, "size": _LONG, "status": _INT, "checksum": _TEXT,
    },
    "atom": {
        "sim_id": _LONG, "atom_id": _LONG, "name": _TEXT, "resname": _TEXT, "resix": _LONG, "chain": _TEXT,
        "element": _TEXT,
    },
    "coordinate": {
        "sim_id": _LONG, "frame": _LONG, "atom_id": _LONG, "x": _DOUBLE, "y": _DOUBLE, "z": _DOUBLE,
    },
}
_COLUMNS["uploaded_file"] = {**_COLUMNS["processed_file"], "is_primary": _BOOL}

SCHEMAS: dict[str, T.StructType] = {
    table: T.StructType([T.StructField(c, t) for c, t in columns.items()]) for table, columns in _COLUMNS.items()
}

# Names in the database that do not follow the common prefix (fixed values).
_DATABASE_NAMES = {
    "account": "socialaccount_socialaccount",
    "download_processed_file": "md_frontend_download_instance_processed_files",
    "download_uploaded_file": "md_frontend_download_instance_uploaded_files",
}


def database_name(table: str) -> str:
    return _DATABASE_NAMES.get(table, f"md_{table}")


def conform(df: DataFrame, table: str) -> DataFrame:
    """The declared columns with the declared types; absent ones are NULL."""
    return df.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in SCHEMAS[table]
        ]
    )


def read(
    spark: SparkSession,
    table: str,
    root: str | None = None,
    server: str | None = None,
    jdbc: dict[str, dict[str, str]] | None = None,
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """Read one table of one server.

    ``root`` is a folder of parquet tables, one sub-folder per server if a
    server is named.  ``jdbc`` maps a server to the options of its database.
    ``split`` (column, low, high, partitions) reads a database table with many
    tasks; without it, JDBC uses one connection, which suits small tables only.
    Column and filter pruning reach either source.
    """
    if jdbc is not None:
        reader = spark.read.format("jdbc").options(**jdbc[server or "staging"], dbtable=database_name(table))
        if split:
            column, low, high, parts = split
            reader = reader.options(
                partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts)
            )
        return conform(reader.load(), table)
    if root is None:
        raise ValueError("name a root folder or a database")
    folder = f"{root}/{server}" if server else root
    return spark.read.schema(SCHEMAS[table]).parquet(f"{folder}/{table}")


def objects(catalog: DataFrame, collections: DataFrame | None = None) -> DataFrame:
    """Data objects, replica 0 only, of all or of the given collections."""
    out = catalog.where(F.col("replica_number") == 0).select("collection", "name", "size", "md5", "create_time")
    return out if collections is None else out.join(collections.select("collection"), "collection", "left_semi")
