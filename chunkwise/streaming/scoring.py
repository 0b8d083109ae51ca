"""Score a stream of texts with the same Columns as batch prediction.

The pipeline is stateless (every output row depends on one input row and a
static category dimension), so no watermark or state store is involved; a
file source with ``availableNow`` processes what is there and stops, and a
long-running trigger works the same way.  The checkpoint lives in the
cluster's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwise.operators import filters as FL
from chunkwise.operators import models as MD
from chunkwise.session import checkpoint_dir


def score_stream(stream_df: DataFrame, model, categories: DataFrame | None = None,
                 text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Streaming DataFrame of ``keep..., label, category``; ``model`` as for ``models.predict``."""
    p = MD.predict(stream_df, model, categories, text)
    return p.select(*(keep or []), "label", *[c for c in ("category",) if c in p.columns])


def run_to_table(spark: SparkSession, scored: DataFrame, name: str = "scores") -> str:
    """Run a scored stream to completion into a parquet folder under the
    shared checkpoint directory; returns the folder."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    q = (scored.writeStream.format("parquet").option("path", f"{base}/data")
         .option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return f"{base}/data"


STATUS_OK = "ok"


def score_batch(batch: DataFrame, batch_id: int, model, categories: DataFrame | None, path: str, text: str = "text") -> None:
    """Write one micro-batch: every row with ``label``, ``category`` and
    ``status`` (``ok``, or why it was rejected, without a label).

    Both outputs come from one pass over the batch and lie under the folder
    of the batch id, so a batch that is replayed replaces its own rows.
    """
    if not isinstance(model, MD.ChunkModel):
        categories = categories if categories is not None else model.categories(batch.sparkSession)
        model = model.chunk_model
    d = batch.withColumn("status", F.coalesce(FL.empty_reason(text), F.lit(STATUS_OK)))
    d = MD.predict_labels(d.withColumn("_text", F.coalesce(F.col(text), F.lit(""))), model, "_text").drop("_text")
    d = d.withColumn("label", F.when(F.col("status") == STATUS_OK, F.col("label")))
    if categories is not None:
        d = d.join(F.broadcast(MD.category_names(categories, len(model.head_b))), "label", "left")
    d.write.mode("overwrite").partitionBy("status").parquet(f"{path}/batch={batch_id}")


def score_to_table(spark: SparkSession, stream_df: DataFrame, model, categories: DataFrame | None = None, text: str = "text",
                   path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Score what a stream holds into a table; (scored rows, rejected rows with ``status``).

    ``path`` (default: a new folder under the shared checkpoint directory)
    keeps the stream's progress too: called again with it, only new input is
    scored.
    """
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/scores-{uuid.uuid4().hex}"
    q = (stream_df.writeStream.foreachBatch(lambda batch, k: score_batch(batch, k, model, categories, f"{path}/data", text))
         .option("checkpointLocation", f"{path}/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    named = categories is not None or not isinstance(model, MD.ChunkModel)
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in stream_df.schema if f.name != "label"]
                       + ["label int"] + (["category string"] if named else []) + ["status string", "batch long"])
    seen = file_status(spark, f"{path}/data")  # none where the stream held no batch
    rows = spark.read.schema(fields).parquet(f"{path}/data") if seen else spark.createDataFrame([], fields)
    ok = F.col("status") == STATUS_OK
    return rows.where(ok).drop("status", "batch"), rows.where(~ok).drop("label", "batch", *(["category"] if named else []))


def document_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The driver's ``documents`` table as a file stream: all files of a
    folder, or the one file; ``max_files_per_trigger`` files a micro-batch
    (Spark's own bound where it is not given)."""
    table = f"{sf_dir}/documents.parquet"
    stream = spark.readStream.schema(spark.read.parquet(table).schema)
    if max_files_per_trigger is not None:
        stream = stream.option("maxFilesPerTrigger", max_files_per_trigger)
    if file_status(spark, table).isDirectory():
        return stream.parquet(table)
    return stream.option("pathGlobFilter", "documents.parquet").parquet(sf_dir)


def file_status(spark: SparkSession, path: str):
    """The file system's status of a path; None where there is none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.getFileStatus(p) if fs.exists(p) else None
