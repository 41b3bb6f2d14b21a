"""Session settings, frozen intermediate tables and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings that hold on a laptop and on a large cluster alike.  The number of
# shuffle partitions is left to the caller: AQE merges small ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # State of streams on local disk instead of the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# A side of a join is broadcast by hint only up to this many (narrow) rows.
BROADCAST_ROWS = 500_000


def builder(app: str = "simquarry") -> SparkSession.Builder:
    b = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    A temporary folder stands in only in local mode, where driver and executor
    are one process; on a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="simquarry-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def freeze(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Used where several results must come from one and the same set of rows, or
    where lineage would grow round by round.  The table is parquet in replicated
    storage: it survives the loss of executors, later steps read only the
    columns they need, and its size is known to the optimizer.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/frozen-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if ``df`` has at most ``max_rows`` rows, else leave the
    choice to the optimizer, which shuffles both sides.

    The size is a plain count, an aggregate of partial counts: a limit would
    bring rows of every partition into one task.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def by_merge(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the tables: sides are shuffled and sorted.

    Without statistics Spark tells a side's size from the bytes of its compressed files,
    and so takes rows that are exploded, and texts made from keys, for a hundredth of
    what they fill as a broadcast, which the driver builds whole.
    """
    return df.hint("merge")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows by ``keys`` into as many partitions as the session's shuffles have.

    A number that is given stays.  Adaptive execution would merge partitions up to
    64 MB of packed rows, which in the sorts and hash tables of a task take many times
    that.  The other side of a join on ``keys`` follows this side's partitions.  Goes
    below an aggregate on ``keys``: above one, Spark takes it for redundant.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
