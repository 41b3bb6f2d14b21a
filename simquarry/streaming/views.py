"""A table with the latest row of each key, kept up to date by a stream.

The table is a set of buckets by a hash of the key.  A micro-batch reads and
writes only the buckets that its keys fall into, as a version named after the
batch; a small table says which buckets a batch wrote, and is written last.  So a
reader sees the versions of finished batches only, and a batch that runs again
writes the same.  Reading takes one version of each bucket and aggregates nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from simquarry.session import freeze

BUCKETS = 64
VERSIONS = "bucket int, batch long"


def _latest(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The row of each key that is last in ``order``."""
    rest = [c for c in rows.columns if c != key and c not in order]
    return rows.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("r")).select(F.col(key), "r.*").select(*rows.columns)


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _versions(spark: SparkSession, path: str, before: int | None = None) -> dict[int, int]:
    """The batch that last wrote each bucket, among those before one; as many rows as there are buckets."""
    found = spark.read.schema(VERSIONS).parquet(f"{path}/versions")
    if before is not None:
        found = found.where(F.col("batch") < before)
    return {r["bucket"]: r["batch"] for r in found.groupBy("bucket").agg(F.max("batch").alias("batch")).collect()}


def _read(spark: SparkSession, path: str, schema: StructType, versions: dict[int, int]) -> DataFrame:
    folders = [f"{path}/rows/batch={batch}/bucket={bucket}" for bucket, batch in sorted(versions.items())]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def create_view(spark: SparkSession, path: str) -> None:
    """An empty table at ``path``."""
    spark.createDataFrame([], VERSIONS).write.parquet(f"{path}/versions/of=-1")


def merge(changed: DataFrame, batch: int, path: str, key: str, order: Sequence[str], buckets: int = BUCKETS) -> None:
    """Take the rows ``changed`` of micro-batch ``batch`` into the table at ``path``.

    Of equal ``order`` the greater row stays, so the result does not depend on
    how rows were cut into batches.  Rows without a key go together under null.
    """
    spark = changed.sparkSession
    new = freeze(_latest(changed, key, order).withColumn("bucket", _bucket(key, buckets)))
    touched = {r["bucket"] for r in new.select("bucket").distinct().collect()}  # ``buckets`` at most
    held = {b: n for b, n in _versions(spark, path, batch).items() if b in touched}
    both = _read(spark, path, changed.schema, held).unionByName(new.drop("bucket"))
    merged = _latest(both, key, order).withColumn("bucket", _bucket(key, buckets))
    merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/rows/batch={batch}")
    spark.createDataFrame([(b, batch) for b in sorted(touched)], VERSIONS).coalesce(1).write.mode("overwrite").parquet(f"{path}/versions/of={batch}")


def read_view(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The latest row of each key, from one version of each bucket."""
    return _read(spark, path, schema, _versions(spark, path))


def maintain(rows: DataFrame, path: str, key: str, order: Sequence[str], buckets: int = BUCKETS) -> StreamingQuery:
    """Keep the table at ``path`` up to date with what the stream ``rows`` brings, until its input ends."""
    create_view(rows.sparkSession, path)
    return (
        rows.writeStream.option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(lambda df, batch: merge(df, batch, path, key, order, buckets))
        .start()
    )
