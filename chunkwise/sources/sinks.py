"""Writers: CSV/TSV splits, label lines, chunk records, label maps,
manifest, evaluation report and confusion matrix, model persistence.

Every writer is a distributed ``DataFrame.write``; nothing is gathered on
the driver.  Small single-row results (maps, manifest, report) are written
as one JSON line with ``coalesce(1)`` on a one-row frame.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwise.functions import text as T


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """K1: ``text,label`` with a header, quoting only where needed and
    quotes doubled; whitespace kept as is."""
    (df.select("text", "label").write.mode("overwrite")
     .option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def write_tsv(df: DataFrame, path: str) -> None:
    """K2: as K1 with a tab separator.  Read it back with the same CSV
    options (not the quote-less line reader) so a ``"`` survives (Q4)."""
    write_csv(df, path, sep="\t")


def read_csv_split(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Round-trip reader for K1/K2 output."""
    return (spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
            .option("multiLine", True).schema("text string, label int").csv(path))


def write_label_lines(df: DataFrame, path: str) -> None:
    """K3: ``__label__<label> <text>`` per line."""
    df.select(T.label_line("text", "label").alias("value")).write.mode("overwrite").text(path)


def chunk_records(df: DataFrame, max_tokens: int = T.DEFAULT_MAX_TOKENS, max_chunks: int = T.DEFAULT_MAX_CHUNKS,
                  id_col: str = "id", keep: list[str] | None = None, counter: T.Counter = T.count_tokens) -> DataFrame:
    """K4 rows: ``id, text, label, chunks, chunk_count``, after the columns of ``keep``."""
    c = T.with_chunks(df, "text", "_ch", max_tokens, max_chunks, counter)
    return c.select(*(keep or []), F.col(id_col).cast("bigint").alias("id"), "text", "label",
                    T.chunk_texts("_ch").alias("chunks"), F.size("_ch").alias("chunk_count"))


def write_chunk_records(df: DataFrame, path: str) -> None:
    """K4: JSON Lines, UTF-8, non-ASCII kept unescaped."""
    df.select("id", "text", "label", "chunks", "chunk_count").write.mode("overwrite").json(path)


def write_json_row(df: DataFrame, path: str) -> None:
    """A one-row frame as one JSON document (K5, K6, K7 report)."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_json_map(df: DataFrame, path: str) -> None:
    """The one map column of a one-row frame as a JSON object of its own."""
    df.select(F.to_json(F.col(df.columns[0])).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_label_maps(maps: DataFrame, path: str) -> None:
    """K5: ``label2id`` and ``id2label`` (from ``stats.label_maps``)."""
    write_json_row(maps.select("label2id"), f"{path}/label2id")
    write_json_row(maps.select("id2label"), f"{path}/id2label")


def report_document(report: DataFrame) -> DataFrame:
    """K7 report body from ``metrics.classification_report`` rows (with
    ``name``): ``{name: {precision, recall, f1-score, support}, ...,
    accuracy, macro avg (all listed classes), weighted avg}``, one global
    aggregate over the per-class rows."""
    sup = F.sum("support")

    def avg_struct(p, r, f):
        return F.struct(p.alias("precision"), r.alias("recall"), f.alias("f1-score"), sup.cast("double").alias("support"))

    def wavg(c):
        return F.sum(F.col(c) * F.col("support")) / sup

    doc = report.agg(
        F.map_from_entries(F.collect_list(F.struct(
            F.col("name"), F.struct("precision", "recall", F.col("f1").alias("f1-score"),
                                    F.col("support").cast("double").alias("support"))))).alias("classes"),
        (F.sum("tp") / sup).alias("accuracy"),
        avg_struct(F.avg("precision"), F.avg("recall"), F.avg("f1")).alias("macro avg"),
        avg_struct(wavg("precision"), wavg("recall"), wavg("f1")).alias("weighted avg"))
    rest = F.to_json(F.struct("accuracy", "macro avg", "weighted avg"))
    # splice the class map and the summary fields into one JSON object
    body = F.concat(F.regexp_replace(F.to_json("classes"), "\\}$", ","), F.regexp_replace(rest, "^\\{", ""))
    return doc.select(body.alias("value"))


def write_evaluation(report: DataFrame, cm: DataFrame, categories: DataFrame, path: str, prefix: str) -> None:
    """K7: ``<prefix>_classification_report.json`` and
    ``<prefix>_confusion_matrix.csv`` (header ``true\\pred`` then the class
    names; one row per true class, in id order)."""
    report_document(report).coalesce(1).write.mode("overwrite").text(
        f"{path}/{prefix}_classification_report.json")
    ids = [r["label"] for r in categories.orderBy("label").collect()]  # the class list (bounded)
    names = {r["label"]: r["name"] for r in categories.collect()}
    wide = cm.groupBy("true").pivot("pred", ids).agg(F.first("n")).join(
        F.broadcast(categories.withColumnRenamed("label", "true")), "true").orderBy("true")
    out = wide.select(F.col("name").alias("true\\pred"), *[F.col(str(i)).alias(names[i]) for i in ids])
    out.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path}/{prefix}_confusion_matrix.csv")


def save_model(model, metadata: dict | None, path: str, spark: SparkSession) -> None:
    """K8: persist a fitted model (any ML stage that can be written) and its
    metadata (class list, chunk limits, pooling, dev metrics) beside it; a
    model that knows its metadata needs none given, and given fields win."""
    own = model.metadata() if hasattr(model, "metadata") else {}
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(own | (metadata or {})),)], "value string").coalesce(1).write.mode("overwrite") \
        .text(f"{path}/metadata")


def load_model(spark: SparkSession, path: str, defaults: dict | None = None):
    """K8: ``(model, metadata)``; the model has the class it was saved with,
    and stored metadata overrides defaults."""
    from pyspark.ml.util import DefaultParamsReader

    meta = dict(defaults or {})
    rows = spark.read.text(f"{path}/metadata").collect()  # one small row
    if rows:
        meta.update(json.loads(rows[0][0]))
    return DefaultParamsReader.loadParamsInstance(f"{path}/model", spark), meta
