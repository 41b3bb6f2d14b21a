"""Text, PDB, log and inventory sources."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from simquarry.functions.text import strip
from simquarry.operators.ranking import running_total
from simquarry.session import freeze


def read_lines(spark: SparkSession, path: str | list[str], line_no: bool = True) -> DataFrame:
    """Lines of text files with file and line number, counted from 1.

    Files are split like any other input.  Place of a line is its block and
    its row in the block; numbers are row counts per block, added up, so no
    file has to fit into one task.
    """
    raw = spark.read.option("recursiveFileLookup", "true").text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("line"),
    )
    if not line_no:
        return raw
    return running_total(raw, ["path"], "block", ["row"], F.lit(1), "line_no")


def parse_pdb_atoms(lines: DataFrame, key: str = "path") -> DataFrame:
    """Atom rows from numbered PDB lines (key, block, row, line_no, line).

    Fields are cut by column; a number that cannot be read is NULL.  The model
    of an atom is the number of MODEL records above it, at least 1.
    """
    is_model = F.col("line").startswith("MODEL").cast("int")
    placed = running_total(lines, [key], "block", ["line_no"], is_model, "__models")
    cut = lambda start, n: strip(F.substring("line", start, n))
    return placed.where(F.col("line").startswith("ATOM") | F.col("line").startswith("HETATM")).select(
        key, "line_no", cut(1, 6).alias("record"),
        cut(7, 5).try_cast("long").alias("serial"), cut(13, 4).alias("name"), cut(18, 3).alias("resname"),
        F.substring("line", 22, 1).alias("chain"), cut(23, 4).try_cast("int").alias("resnum"),
        cut(27, 1).alias("icode"),
        *[cut(31 + 8 * k, 8).try_cast("double").alias(c) for k, c in enumerate("xyz")],
        cut(77, 2).alias("element"), F.greatest("__models", F.lit(1)).cast("int").alias("model"),
    )


def read_pdb_atoms(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_pdb_atoms(read_lines(spark, path))


def residue_key(atoms: DataFrame) -> DataFrame:
    """Atoms of PDB files in the form ``chain_sequences`` takes."""
    return atoms.withColumnRenamed("path", "sim_id").withColumn(
        "residue", F.concat_ws("|", F.col("resnum").cast("string"), "icode")
    )


TREE = "dir string, path string, name string, is_dir boolean, size long, modified_at timestamp_ntz"
_LISTED = 20_000


def _lister(local: bool):
    def entries(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            for folder in batch["path"]:
                system, inner = (fs.LocalFileSystem(), folder) if local else fs.FileSystem.from_uri(folder)
                infos = system.get_file_info(fs.FileSelector(inner))
                for k in range(0, len(infos), _LISTED):
                    part = infos[k : k + _LISTED]
                    is_dir = [i.type == fs.FileType.Directory for i in part]
                    yield pd.DataFrame(
                        {
                            "dir": folder,
                            "path": [f"{folder.rstrip('/')}/{i.base_name}" for i in part],
                            "name": [i.base_name for i in part],
                            "is_dir": is_dir,
                            "size": pd.array([None if d else i.size for d, i in zip(is_dir, part)], dtype="Int64"),
                            "modified_at": pd.to_datetime([i.mtime for i in part], utc=True).tz_localize(None),
                        }
                    )

    return entries


def read_tree(spark: SparkSession, root: str) -> DataFrame:
    """All files and folders below a root, empty ones included.

    Spark's own file sources leave out folders and files of zero bytes, and
    both matter here.  One level of the tree is listed at a time, its folders
    spread over the tasks; the number of rounds is the depth of the tree.
    """
    root = plain_path_text(root)
    list_level = _lister("://" not in root)
    level, found = spark.createDataFrame([(root,)], "path string"), None
    while True:
        entries = freeze(level.mapInPandas(list_level, TREE))
        found = entries if found is None else found.unionByName(entries)
        folders = entries.where("is_dir").select("path")
        if folders.isEmpty():
            return found
        level = folders.repartition("path")


def plain_path_text(path: str) -> str:
    """Local paths without a scheme, others as they are; no slash at the end."""
    return re.sub(r"^file:/+", "/", path).rstrip("/") or "/"


def plain_path(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "/")


def read_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Path, folder, size and modification time of all files below a root."""
    return read_tree(spark, root).where("not is_dir").drop("is_dir")


def split_id_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Integers of numbered lines, blanks skipped, and the lines that are none."""
    kept = lines.select("path", "line_no", strip(F.col("line")).alias("text")).where("text <> ''")
    value = F.when(F.col("text").rlike(r"^[+-]?\d+$"), F.col("text").try_cast("long"))
    parsed = kept.withColumn("id", value)
    return parsed.where("id is not null").select("id"), parsed.where("id is null").drop("id")


def read_id_list(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Integers of a list file, one per line, and the rejected lines."""
    return split_id_lines(read_lines(spark, path))


def read_run_logs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of tool reports; the file is the run."""
    return read_lines(spark, path).select(F.col("path").alias("run_id"), "line_no", "line")


def parse_outcome_lines(lines: DataFrame) -> DataFrame:
    """Outcomes from numbered lines of the append-only log.

    Lines with fewer than three fields and headers are skipped.  The sequence
    orders lines by time stamp, then file and line.
    """
    parts = F.split("line", "\t")
    return (
        lines.withColumn("p", parts)
        .where((F.size("p") >= 3) & (F.get("p", 0) != "timestamp"))
        .select(
            F.struct(F.get("p", 0).alias("at"), "path", "line_no").alias("seq"),
            F.get("p", 0).alias("timestamp"), F.get("p", 1).alias("result"), F.get("p", 2).alias("bundle"),
            F.coalesce(F.get("p", 3), F.lit("")).alias("detail"),
        )
    )


def read_outcome_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_outcome_lines(read_lines(spark, path))
