"""Bindings from the driver's parquet tables to the engine's data model.

* labelled documents: ``documents`` with ``label = int(substr(source, 4))``
  (20 classes, ``src0`` .. ``src19``); category name = ``source``.
* chunk vectors: ``embeddings`` with ``doc = vec_id div 4``,
  ``chunk_no = vec_id % 4``, truth label ``label``.
* metric tables: ``events`` with ``run = user_id``, ``metric = value``,
  ordered by ``(ts, event_id)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwise.functions import text as T


# Tables whose per-row work is CPU-heavy (regexes, folds over text).
TEXT_TABLES = {"documents"}


def spread(df: DataFrame, spark: SparkSession) -> DataFrame:
    """Rows of a scan of fewer tasks than there are cores, dealt round-robin.

    A parquet file is split by row groups, so one small file is read and
    processed by one task however many cores exist.  A scan of as many tasks
    as cores or more is left as it is, so no large table is shuffled; the
    rows are the same both ways.
    """
    target = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target * 2)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df, spark) if name in TEXT_TABLES else df


def label_of_source(source: str = "source"):
    return F.col(source).substr(4, 1_000_000).cast("int")


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text, label) before cleaning."""
    return table(spark, sf_dir, "documents").select("doc_id", "text", label_of_source().alias("label"))


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text, label) with ``clean_text`` applied (one projection)."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", T.clean_text("text").alias("text"), label_of_source().alias("label"))


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(label, name) dimension derived from the documents; ~20 rows."""
    return (table(spark, sf_dir, "documents")
            .select(label_of_source().alias("label"), F.col("source").alias("name"))
            .distinct())


def chunk_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, doc, chunk_no, embedding array<double>, mask, label).

    The mask marks real chunks: chunk 0 is always real; chunk j > 0 is real
    unless ``(doc * 7 + j) % 5 == 0`` (a fixed rule so some documents have
    padding chunks).
    """
    e = table(spark, sf_dir, "embeddings")
    doc = (F.col("vec_id") / 4).cast("bigint")
    j = (F.col("vec_id") % 4).cast("int")
    mask = F.when((j == 0) | ((doc * 7 + j) % 5 != 0), 1).otherwise(0)
    return e.select("vec_id", doc.alias("doc"), j.alias("chunk_no"),
                    F.col("embedding").cast("array<double>").alias("embedding"),
                    mask.alias("mask"), "label")


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run, ts, event_id, metric) from ``events``."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"), "ts", "event_id", F.col("value").alias("metric"))
