"""Dataset statistics and manifest: label distributions, sizes, chunk and
length statistics, coverage and class balance.

All are aggregates with map-side partial aggregation; none collects rows.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chunkwise.functions import text as T


def label_distribution(df: DataFrame, label: str = "label", by: str = "split") -> DataFrame:
    """Rows per (split, label) plus ``total`` rows per label: ``split, label, n``.
    The total is re-aggregated from the small per-(split, label) table, so
    the input is scanned once."""
    per = df.groupBy(by, label).agg(F.count(F.lit(1)).alias("n"))
    tot = per.groupBy(label).agg(F.sum("n").alias("n")).withColumn(by, F.lit("total"))
    return per.unionByName(tot.select(by, label, "n"))


def label_set(df: DataFrame, label: str = "label") -> DataFrame:
    """Sorted distinct labels and their number (one row)."""
    labels = df.select(label).distinct().agg(F.array_sort(F.collect_list(label)).alias("labels"))
    return labels.select(F.size("labels").alias("num_labels"), "labels")


def split_sizes(df: DataFrame, by: str = "split") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.count_if(F.col(by) == "train").alias("train_samples"),
        F.count_if(F.col(by) == "test").alias("test_samples"),
    )


def chunk_stats(df: DataFrame, chunk_count: str = "chunk_count", by: str | None = "split") -> DataFrame:
    """Mean and max chunk count (0.0 on empty input), per ``by`` if given."""
    aggs = [F.coalesce(F.avg(chunk_count), F.lit(0.0)).alias("avg_chunks"),
            F.coalesce(F.max(chunk_count).cast("double"), F.lit(0.0)).alias("max_chunks")]
    return df.groupBy(by).agg(*aggs) if by else df.agg(*aggs)


def length_stats(df: DataFrame, text: str = "text", exact: bool = True) -> DataFrame:
    """Character length mean / median / min / max.  The exact median keeps a
    map of distinct lengths per partition (bounded by the longest text),
    not the rows; ``exact=False`` uses ``percentile_approx``."""
    n = F.length(text)
    med = F.median(n) if exact else F.percentile_approx(n, 0.5, 10000).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n_docs"), F.avg(n).alias("mean_chars"), med.alias("median_chars"),
                  F.min(n).alias("min_chars"), F.max(n).alias("max_chars"))


def token_coverage(df: DataFrame, limit: int = 2040, text: str = "text",
                   counter: T.Counter = T.count_tokens) -> DataFrame:
    within = (counter(F.col(text)) <= limit).cast("int")
    return df.agg(F.count(F.lit(1)).alias("n_docs"), F.sum(within).cast("bigint").alias("n_within"),
                  F.avg(within).alias("share_within"))


def class_balance(df: DataFrame, categories: DataFrame | None = None, label: str = "label") -> DataFrame:
    """Rows per class with share of total, largest first."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    c = c.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))
    if categories is not None:
        c = c.join(categories, label, "left")  # small; AQE broadcasts after measuring
    return c.orderBy(F.col("n").desc(), F.col(label))


def label_maps(df: DataFrame, label: str = "label") -> DataFrame:
    """``label2id`` and ``id2label`` (both identity on the ids) as one row of
    two maps with string keys."""
    ids = df.select(label).distinct()
    entries = F.array_sort(F.collect_list(F.struct(F.col(label).cast("string").alias("k"), F.col(label).alias("v"))))
    return ids.agg(entries.alias("e")).select(
        F.map_from_entries("e").alias("label2id"),
        F.map_from_entries(F.transform("e", lambda x: F.struct(x["k"], x["k"]))).alias("id2label"))


def count_labels(lines: DataFrame, value: str = "value") -> DataFrame:
    """Distinct all-digit fields of a category file (tab, else comma, else
    whitespace separated): ``num_labels``."""
    v = T.strip_ws(F.col(value))
    fields = F.when(F.instr(v, "\t") > 0, F.split(v, "\t")) \
        .when(F.instr(v, ",") > 0, F.split(v, ",")) \
        .otherwise(F.split(v, f"{T.WS}+"))
    f = lines.where(v != "").select(F.explode(fields).alias("f")).select(T.strip_ws("f").alias("f"))
    return f.where(F.col("f").rlike("^[0-9]+$")).agg(
        F.count_distinct(F.col("f").cast("decimal(38,0)")).alias("num_labels"))


def dataset_manifest(split_df: DataFrame, chunk_count: str = "chunk_count", label: str = "label",
                     test_size: float = 0.1, max_tokens: int = T.DEFAULT_MAX_TOKENS,
                     max_chunks: int = T.DEFAULT_MAX_CHUNKS, paths: dict[str, str] | None = None,
                     dropped: str | None = None) -> DataFrame:
    """One-row manifest: ``paths`` (input, output_dir) if given, sizes, ratio,
    label list, three label distributions (string -> count maps) and chunk
    statistics; ``to_json(struct(*))`` gives the file body.  ``dropped``
    names a column with the chunks cut off a text, whose sums are added.  One per-label aggregate (one row per class), then
    one global aggregate over it."""
    def on(s):
        return F.col("split") == s

    per = split_df.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(on("train")).alias("n_train"), F.count_if(on("test")).alias("n_test"),
        F.sum(F.when(on("train"), F.col(chunk_count))).alias("cs_train"),
        F.sum(F.when(on("test"), F.col(chunk_count))).alias("cs_test"),
        F.max(F.when(on("train"), F.col(chunk_count))).alias("cm_train"),
        F.max(F.when(on("test"), F.col(chunk_count))).alias("cm_test"),
        *[F.sum(F.when(on(s), F.col(dropped))).alias(f"cd_{s}") for s in ("train", "test") if dropped])

    def dist(col):
        k = F.col(label).cast("string")
        return F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col(col) > 0, F.struct(k.alias("k"),
                                                                                           F.col(col).alias("v"))))))

    def avg_of(s):
        return F.coalesce(F.sum(f"cs_{s}") / F.sum(f"n_{s}"), F.lit(0.0))

    def max_of(s):
        return F.coalesce(F.max(f"cm_{s}").cast("double"), F.lit(0.0))

    cut = [F.coalesce(F.sum(f"cd_{s}"), F.lit(0)).alias(f"{s}_dropped_chunks") for s in ("train", "test") if dropped]
    m = per.agg(
        F.sum("n").alias("total_samples"), F.sum("n_train").alias("train_samples"),
        F.sum("n_test").alias("test_samples"), F.array_sort(F.collect_list(label)).alias("labels"),
        dist("n").alias("label_distribution_total"), dist("n_train").alias("label_distribution_train"),
        dist("n_test").alias("label_distribution_test"),
        avg_of("train").alias("train_avg_chunks"), max_of("train").alias("train_max_chunks"),
        avg_of("test").alias("test_avg_chunks"), max_of("test").alias("test_max_chunks"), *cut)
    return m.select(
        *[F.lit(v).alias(k) for k, v in (paths or {}).items()],
        "total_samples", "train_samples", "test_samples", F.lit(test_size).alias("test_size"),
        F.size("labels").alias("num_labels"), "labels", "label_distribution_total", "label_distribution_train",
        "label_distribution_test",
        F.struct(F.lit(max_tokens).alias("max_tokens_per_chunk"), F.lit(max_chunks).alias("max_chunks"),
                 "train_avg_chunks", "train_max_chunks", "test_avg_chunks", "test_max_chunks",
                 *(["train_dropped_chunks", "test_dropped_chunks"] if dropped else [])).alias("hbert"),
        F.from_json(F.lit(json.dumps(OUTPUT_NAMES)), "map<string,string>").alias("outputs"),
    )


# Output file names recorded in the manifest (the manifest's
# chunk-statistics key is "hbert", also a fixed format value).
OUTPUT_NAMES = {
    "train_split": "train_split.txt",
    "test_split": "test_split.txt",
    "xgboost_train": "xgboost_train.csv",
    "xgboost_test": "xgboost_test.csv",
    "fasttext_train": "fasttext_train.txt",
    "fasttext_test": "fasttext_test.txt",
    "hbert_train": "hbert_train.jsonl",
    "hbert_test": "hbert_test.jsonl",
    "label2id": "label2id.json",
    "id2label": "id2label.json",
}
