"""From documents to token ids: five stages, each written and read again.

A stage takes (spark, docs, sf_dir) and returns a DataFrame.  All but the last
return the columns of ``documents``, with the rows that stay.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simquarry.llm import bpe, decontam, jaccard, line_dedup, quality
from simquarry.session import shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the full policy rejects; null and empty texts go."""
    measured = quality.measure(docs.select(*(F.col(f"`{c}`").alias(f"d_{c}") for c in docs.columns)), "d_text")
    return measured.where(~quality.fails(quality.FULL, F.col("quality.failed"))).select(*(F.col(f"`d_{c}`").alias(c) for c in docs.columns))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without chunks of lines that stand in an earlier one; those of which nothing is left go.

    ``n_chars`` follows the text.
    """
    out = line_dedup.dedup_lines(docs)
    n_chars = F.when(F.col("removed.n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars")
    left = (F.col("removed.n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return out.where(left).select(*(n_chars if c == "n_chars" else c for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each group of similar ones.

    Rows are told apart by doc_id and text, so rows that share an id only are no
    group.  Those without doc_id come last, and of one id that with the least hash
    of its text comes first; of equal rows one stays.
    """
    key = F.xxhash64("doc_id", "text")
    groups = jaccard.similar_groups(docs.select(key.alias("doc_id"), "text")).select(F.col("doc_id").alias("key"), "component_id")
    place = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash"))
    named = docs.select(key.alias("key"), "doc_id", F.xxhash64("text").alias("text_hash"))
    stays = groups.join(named, "key").groupBy("component_id").agg(F.min_by("key", place).alias("__key")).select("__key")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    row = F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("row")
    left = docs.withColumn("__key", key).join(stays, "__key", "left_semi").groupBy("__key").agg(row)
    return left.select(*(F.col("row")[c].alias(c) for c in docs.columns))


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    found = decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("n_hit > 0").select("doc_id", "text_hash").distinct()
    d, f = docs.alias("d"), found.alias("f")
    return d.join(f, F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.xxhash64("d.text") == F.col("f.text_hash")), "left_anti").select("d.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids of each text."""
    out = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"), ["doc_id", "lang", "source"])
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", remove_benchmarks),
    ("bpe", tokenize),
]

# SQL can express neither the cuts of line chunks nor byte-pair encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage is a table in the shared folder."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
