"""Registered queries of this package: ``QUERIES`` and their DuckDB statements ``ORACLE``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from chunkwise.llm import (
    decontaminate,
    license_scan,
    line_dedup,
    merkle,
    oracle,
    order_minhash,
    piece_codec,
    quality_fm,
    quality_rules,
    secret_scan,
    sharding,
    spelling,
    token_count,
    vantage,
)

QUERIES: dict = {}
ORACLE: dict[str, str] = dict(oracle.ORACLE)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_token_count(spark, sf):
    return token_count.count_tokens(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op2_quality_fm(spark, sf):
    docs = table(spark, sf, "documents")
    d = quality_fm.score(docs.select("doc_id", "text"), quality_fm.train(docs, table(spark, sf, "labels")))
    return d.select("doc_id", quality_fm.held_out().alias("held_out"), "score", (F.col("score") >= quality_fm.CUT).cast("int").alias("predicted"))


@query
def op3_decontaminate(spark, sf):
    d = decontaminate.decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return d.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query
def op4_sharding(spark, sf):
    return sharding.shard(table(spark, sf, "documents"))


@query
def op5_piece_codec(spark, sf):
    return piece_codec.encode_digest(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op6_secret_scan(spark, sf):
    docs = table(spark, sf, "documents")
    return secret_scan.scan(docs, secret_scan.train(docs))


@query
def op7_quality_rules(spark, sf):
    return quality_rules.evaluate(table(spark, sf, "documents"))


@query
def op8_license_scan(spark, sf):
    return license_scan.scan(table(spark, sf, "documents"))


@query
def op9_line_dedup(spark, sf):
    d = line_dedup.dedup_lines(table(spark, sf, "documents").select("doc_id", "text"), grow=line_dedup.GROW, every=True)
    return d.select("doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query
def op10_order_minhash(spark, sf):
    return order_minhash.classes(table(spark, sf, "documents"))


@query
def op11_merkle_manifest(spark, sf):
    return merkle.audit(merkle.manifest(table(spark, sf, "documents")))


@query
def op12_vantage_simhash(spark, sf):
    return vantage.digest(vantage.near(table(spark, sf, "documents")))


@query
def op13_spelling_variants(spark, sf):
    return spelling.variants(table(spark, sf, "documents"))
