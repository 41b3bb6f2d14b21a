"""Run a stream over what is there now and read what it wrote."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simquarry.session import shared_folder

END = "9000-01-01 00:00:00"
ROWS_A_PARTITION = 50_000


def closing(stream: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """``stream`` with an end that can be called, for input that is known to be complete.

    The call adds one row of nulls at a time after all others, which moves the
    watermark past every event that still waits.  The row itself waits for ever.
    """
    spark = stream.sparkSession
    folder = f"{shared_folder(spark)}/closing-{uuid.uuid4().hex}"
    schema = stream.schema
    spark.createDataFrame([], schema).write.parquet(folder)

    def close() -> None:
        last = [F.lit(END).cast(f.dataType).alias(f.name) if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        spark.range(1).select(*last).write.mode("append").parquet(folder)

    return stream.unionByName(spark.readStream.schema(schema).parquet(folder)), close


def state_partitions(spark: SparkSession, rows: int) -> int:
    """Partitions of a stream's state for an input of so many rows.

    They stay as they are for the life of a checkpoint and are not merged at run
    time, and each starts a Python worker in every micro-batch; so a small input
    gets few, and a large one as many as the session's shuffles have.
    """
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(8, rows // ROWS_A_PARTITION))


def drain(stream: DataFrame, mode: str = "append", close: Callable[[], None] | None = None, partitions: int | None = None) -> DataFrame:
    """Process the available input and return the written rows.

    Rows go to a parquet folder in the shared folder; each micro-batch writes a
    folder of its own, so a batch that is run again replaces its rows.  With
    ``close`` the stream goes on from its checkpoint after the end was called.
    ``partitions`` is the number of partitions of its state.
    """
    spark = stream.sparkSession
    base = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    schema = stream.schema

    # An input without rows still gives a table.
    spark.createDataFrame([], schema).write.parquet(f"{base}/rows/batch=-1")

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{base}/rows/batch={batch_id}")

    for end in (None, close) if close else (None,):
        if end:
            end()
        writer = (
            stream.writeStream.outputMode(mode)
            .option("checkpointLocation", f"{base}/state")
            .trigger(availableNow=True)
            .foreachBatch(write)
        )
        # A query takes its settings from the session as it starts.
        usual = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions or usual))
        try:
            query = writer.start()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", usual)
        query.awaitTermination()
    return spark.read.schema(schema).parquet(f"{base}/rows").select(*schema.names)
