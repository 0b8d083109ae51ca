"""Registered queries: each operator of the inventory run over the driver's
whole tables.  Every callable takes ``(spark, sf_dir)`` and returns a
DataFrame whose column names equal those of the matching oracle SQL.

Computed doubles are rounded to 6 places (the oracle does the same).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwise.functions import text as T
from chunkwise.operators import filters as FL
from chunkwise.operators import splits as SP
from chunkwise.operators import stats as ST
from chunkwise.operators.store import written
from chunkwise.sources import readers as R
from chunkwise.sources import sinks as K
from chunkwise.plans import tables as TB

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------- shared plans

def kept_documents(spark, sf) -> DataFrame:
    """Cleaned documents that pass all three filters."""
    kept, _ = FL.filter_with_reason(TB.labelled_documents(spark, sf))
    return kept


def long_documents(spark, sf) -> DataFrame:
    """(doc_id, label) of cleaned documents with at least 200 characters,
    written once: the splits read these two columns, not the texts."""
    return written(FL.filter_min_chars(TB.labelled_documents(spark, sf)).select("doc_id", "label"), "long-documents")


def split_documents(spark, sf) -> DataFrame:
    """``long_documents`` split train/test."""
    return SP.stratified_split(long_documents(spark, sf))


def long_form(df: DataFrame, arr: str, keys: list[str], pos: str, val: str, base: int = 1) -> DataFrame:
    out = df.select(*keys, F.posexplode(arr).alias("_p", val))
    return out.select(*keys, (F.col("_p") + base).alias(pos), val)


# ---------------------------------------------------------------- flagship

@query("chunks_per_class")
def chunks_per_class(spark, sf):
    """After cleaning and filtering: documents, mean and largest number of
    510-token chunks (first 4 kept) per class."""
    d = T.with_chunks(kept_documents(spark, sf), "text", "ch")
    return d.groupBy("label").agg(
        F.count(F.lit(1)).alias("n_docs"), r6(F.avg(F.size("ch"))).alias("avg_chunks"),
        F.max(F.size("ch")).alias("max_chunks"))


# ---------------------------------------------------------------- text (2.3)

@query("clean_text")
def q_clean_text(spark, sf):
    return TB.labelled_documents(spark, sf).select("doc_id", "text")


@query("mark_sections")
def q_mark_sections(spark, sf):
    return TB.labelled_documents(spark, sf).select("doc_id", T.mark_sections("text").alias("marked"))


@query("split_units")
def q_split_units(spark, sf):
    d = FL.materialize(TB.labelled_documents(spark, sf).select("doc_id", "text"), {"u": T.split_units("text")})
    return long_form(d, "u", ["doc_id"], "unit_no", "unit")


@query("count_tokens")
def q_count_tokens(spark, sf):
    d = TB.table(spark, sf, "documents")
    return d.select("doc_id", T.count_tokens("text").alias("n_tokens_raw"),
                    T.count_tokens(T.clean_text("text")).alias("n_tokens"))


@query("split_by_words")
def q_split_by_words(spark, sf):
    d = FL.materialize(TB.labelled_documents(spark, sf).select("doc_id", "text"), {"p": T.split_by_words("text", 64)})
    return long_form(d, "p", ["doc_id"], "piece_no", "piece")


@query("split_long_unit")
def q_split_long_unit(spark, sf):
    d = FL.materialize(TB.labelled_documents(spark, sf).select("doc_id", "text"), {"u": T.split_units("text")})
    u = FL.materialize(long_form(d, "u", ["doc_id"], "unit_no", "unit"), {"p": T.split_long_unit("unit", 40)})
    return long_form(u, "p", ["doc_id", "unit_no"], "piece_no", "piece")


@query("build_chunks")
def q_build_chunks(spark, sf):
    d = T.with_chunks(TB.labelled_documents(spark, sf), "text", "ch", max_tokens=128, max_chunks=8)
    d = d.select("doc_id", T.chunk_texts("ch").alias("c"))
    return long_form(d, "c", ["doc_id"], "chunk_no", "chunk")


@query("explode_chunks")
def q_explode_chunks(spark, sf):
    d = T.with_chunks(kept_documents(spark, sf), "text", "ch")
    return d.select("doc_id", F.posexplode("ch").alias("chunk_no", "c")).select(
        "doc_id", "chunk_no", F.col("c")["chunk"].alias("chunk"), F.col("c")["n_tokens"].alias("n_tokens"))


@query("pad_chunks")
def q_pad_chunks(spark, sf):
    d = T.with_chunks(TB.labelled_documents(spark, sf), "text", "ch")
    d = FL.materialize(d.select("doc_id", "ch"), {"p": T.pad_chunks(T.chunk_texts("ch"), 4)})
    d = d.select("doc_id", F.arrays_zip(F.col("p")["chunks"].alias("chunk"), F.col("p")["chunk_mask"].alias("mask"))
                 .alias("z"))
    return d.select("doc_id", F.posexplode("z").alias("slot", "s")).select(
        "doc_id", "slot", F.col("s")["chunk"].alias("chunk"), F.col("s")["mask"].alias("mask"))


@query("single_line")
def q_single_line(spark, sf):
    return TB.table(spark, sf, "documents").select("doc_id", T.single_line("text").alias("line"))


@query("label_lines")
def q_label_lines(spark, sf):
    d = FL.filter_min_chars(TB.labelled_documents(spark, sf))
    return d.select("doc_id", T.label_line("text", "label").alias("line"))


@query("cast_label")
def q_cast_label(spark, sf):
    d = TB.table(spark, sf, "documents")
    return d.select("doc_id", "source", F.col("source").substr(4, 1_000_000).try_cast("int").alias("label"))


# ---------------------------------------------------------------- filters (2.4)

@query("filter_min_chars")
def q_filter_min_chars(spark, sf):
    d = FL.filter_min_chars(TB.labelled_documents(spark, sf))
    return d.select("doc_id", F.length("text").alias("n_chars"))


@query("filter_min_tokens")
def q_filter_min_tokens(spark, sf):
    d = FL.filter_min_tokens(TB.labelled_documents(spark, sf))
    return d.select("doc_id", T.count_tokens("text").alias("n_tokens"))


@query("filter_max_tokens")
def q_filter_max_tokens(spark, sf):
    d = FL.filter_max_tokens(TB.labelled_documents(spark, sf))
    return d.select("doc_id", T.count_tokens("text").alias("n_tokens"))


@query("filter_with_reason")
def q_filter_with_reason(spark, sf):
    _, counts = FL.filter_with_reason(TB.labelled_documents(spark, sf))
    return counts


@query("reject_empty")
def q_reject_empty(spark, sf):
    d = TB.table(spark, sf, "documents")
    return d.select("doc_id", F.coalesce(FL.empty_reason("text"), F.lit("ok")).alias("status"))


@query("drop_rarest")
def q_drop_rarest(spark, sf):
    d = FL.drop_rarest(written(kept_documents(spark, sf).select("doc_id", "label"), "kept-labels"), k=4)
    return d.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- lookups (2.5)

@query("with_category")
def q_with_category(spark, sf):
    d = TB.labelled_documents(spark, sf).select("doc_id", "label")
    cats = TB.categories(spark, sf)
    # the category table is derived from the data: AQE broadcasts it once its size is measured
    return d.join(cats, "label", "left").select("doc_id", "label", F.col("name").alias("category"))


@query("default_categories")
def q_default_categories(spark, sf):
    ids = TB.raw_documents(spark, sf).select("label").distinct()
    return R.default_categories(spark).join(ids, "label", "left_semi")


@query("count_labels")
def q_count_labels(spark, sf):
    cats = TB.categories(spark, sf)
    lines = cats.select(F.concat_ws("\t", F.col("label").cast("string"), "name").alias("value"))
    return ST.count_labels(lines)


@query("label_maps")
def q_label_maps(spark, sf):
    m = ST.label_maps(kept_documents(spark, sf))
    return m.select(F.explode("label2id").alias("key", "label2id"), "id2label").select(
        "key", "label2id", F.col("id2label")[F.col("key")].alias("id2label"))


# ---------------------------------------------------------------- aggregates (2.6)

@query("label_distribution")
def q_label_distribution(spark, sf):
    return ST.label_distribution(split_documents(spark, sf))


@query("label_set")
def q_label_set(spark, sf):
    s = ST.label_set(kept_documents(spark, sf))
    return s.select("num_labels", F.array_join("labels", ",").alias("labels"))


@query("split_sizes")
def q_split_sizes(spark, sf):
    return ST.split_sizes(split_documents(spark, sf))


def _split_chunks(spark, sf) -> DataFrame:
    """(doc_id, label, chunk_count, split): texts are cleaned and chunked in
    one scan and only the counts are written and split."""
    d = T.with_chunks(FL.filter_min_chars(TB.labelled_documents(spark, sf)), "text", "ch")
    return SP.stratified_split(written(d.select("doc_id", "label", F.size("ch").alias("chunk_count")), "chunk-counts"))


@query("chunk_stats")
def q_chunk_stats(spark, sf):
    s = ST.chunk_stats(_split_chunks(spark, sf))
    return s.select("split", r6(F.col("avg_chunks")).alias("avg_chunks"), "max_chunks")


@query("length_stats")
def q_length_stats(spark, sf):
    s = ST.length_stats(TB.labelled_documents(spark, sf))
    return s.select("n_docs", r6(F.col("mean_chars")).alias("mean_chars"),
                    r6(F.col("median_chars")).alias("median_chars"), "min_chars", "max_chars")


@query("token_coverage")
def q_token_coverage(spark, sf):
    s = ST.token_coverage(FL.filter_min_chars(TB.labelled_documents(spark, sf)))
    return s.select("n_docs", "n_within", r6(F.col("share_within")).alias("share_within"))


@query("class_balance")
def q_class_balance(spark, sf):
    b = ST.class_balance(kept_documents(spark, sf), TB.categories(spark, sf))
    return b.select("label", "name", "n", r6(F.col("share")).alias("share"))


@query("dataset_manifest")
def q_dataset_manifest(spark, sf):
    m = ST.dataset_manifest(_split_chunks(spark, sf))
    h = F.col("hbert")
    return m.select("total_samples", "train_samples", "test_samples", "test_size", "num_labels",
                    r6(h["train_avg_chunks"]).alias("train_avg_chunks"), h["train_max_chunks"].alias("train_max_chunks"),
                    r6(h["test_avg_chunks"]).alias("test_avg_chunks"), h["test_max_chunks"].alias("test_max_chunks"),
                    F.array_join("labels", ",").alias("labels"), *[_map_text(f"label_distribution_{s}") for s in ("total", "train", "test")])


def _map_text(name):
    """A map as ``key:value`` parts in key order."""
    parts = F.transform(F.array_sort(F.map_entries(name)), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))
    return F.array_join(parts, ",").alias(name)


@query("chunk_records")
def q_chunk_records(spark, sf):
    d = written(FL.filter_min_chars(TB.labelled_documents(spark, sf)), "clean-documents")
    return K.chunk_records(SP.with_row_id(SP.stratified_split(d)), keep=["split"]) \
        .withColumn("chunks", F.array_join("chunks", "\n"))


# ---------------------------------------------------------------- splits (2.7)

@query("stratified_split")
def q_stratified_split(spark, sf):
    return split_documents(spark, sf).select("doc_id", "label", "split")


@query("dev_split")
def q_dev_split(spark, sf):
    return SP.three_way_split(long_documents(spark, sf)).where("split <> 'test'").select("doc_id", "label", "split")


@query("three_way_split")
def q_three_way_split(spark, sf):
    return SP.three_way_split(long_documents(spark, sf)).select("doc_id", "label", "split")


@query("seeded_order")
def q_seeded_order(spark, sf):
    return SP.seeded_order(TB.labelled_documents(spark, sf).select("doc_id")).select("doc_id", "order_no")


@query("row_id")
def q_row_id(spark, sf):
    return SP.with_row_id(split_documents(spark, sf)).select("doc_id", "split", "id")

