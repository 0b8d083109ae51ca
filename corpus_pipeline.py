"""Corpus pipeline: five stages over ``documents``; each is written as Parquet and read again."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwise.llm import decontaminate, line_dedup, order_minhash, piece_codec, quality_fm
from chunkwise.llm.store import stored
from chunkwise.session import checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None  # trained weights, sketches and tokenizer ids are not SQL


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = quality_fm.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_fm.score(docs, model).where(F.col("score") >= quality_fm.CUT).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines removed; every document stays, with n_chars of what is left."""
    d = line_dedup.dedup_lines(docs, grow=line_dedup.GROW, every=True)
    n = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    return d.withColumn("n_chars", n).select(*docs.columns)


def keyed(docs: DataFrame) -> DataFrame:
    """docs with ``row_``, a number of its own for every row, written once."""
    return stored(docs.withColumn("row_", F.monotonically_increasing_id()), "keyed")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least row of each class by (doc_id, text hash), rows without an id last; decided by row."""
    k = keyed(docs)
    c = order_minhash.classes(k.select(F.col("row_").alias("doc_id"), "text")).withColumnRenamed("doc_id", "row_")
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("th"), "row_")
    keep = k.select("row_", at.alias("at")).join(c, "row_").groupBy("class_id").agg(F.min("at").alias("at"))
    return k.join(keep.select(F.col("at.row_").alias("row_")), "row_", "left_semi").select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window; decided by row."""
    k = keyed(docs)
    bad = (decontaminate.decontaminate(k.select(F.col("row_").alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
           .where("contaminated").select(F.col("doc_id").alias("row_")))
    return k.join(bad, "row_", "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text per document."""
    return piece_codec.encode_digest(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality classifier", quality), ("line dedup", lines), ("MinHash near-dedup", near_duplicates),
          ("benchmark decontamination", benchmark), ("SentencePiece encoding", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{out}/{k}")
        docs = spark.read.parquet(f"{out}/{k}")
    return docs
