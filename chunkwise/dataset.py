"""The end-to-end dataset build: labelled lines in, every training file and the manifest out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwise.functions import text as T
from chunkwise.operators import filters as FL
from chunkwise.operators import splits as SP
from chunkwise.operators import stats as ST
from chunkwise.sources import readers as R
from chunkwise.sources import sinks as K

MANIFEST = "dataset_info.json"


@dataclass
class Dataset:
    """What a build wrote: the split rows with their chunks, the rows left
    out with a reason, rows per reason, and the manifest (one row)."""
    rows: DataFrame
    rejected: DataFrame
    counts: dict[str, int]
    manifest: DataFrame


def build_dataset(spark: SparkSession, input_path: str, output_dir: str, text_col: str = "text", label_col: str = "label",
                  test_size: float = SP.TEST_RATIO, seed: int = SP.SEED, min_chars: int = FL.MIN_CHARS,
                  max_tokens: int = T.DEFAULT_MAX_TOKENS, max_chunks: int = T.DEFAULT_MAX_CHUNKS,
                  counter: T.Counter = T.count_tokens) -> Dataset:
    """Read, clean, tag, split, chunk and write a ``text<TAB>label`` input.

    1. One pass over the input cleans each line and writes it under its
       reason (kept, too short, malformed); the counts come from that write.
    2. The split compares kept rows with their class's cut (``splits``), ids
       number each split in seeded order, chunks are packed, and the rows are
       written by split.
    3. Each output reads the columns and the split it needs: CSV, TSV, label
       lines and chunk records for train and test, both label maps and
       ``dataset_info.json``.  Every output is a folder of part files under
       the name that the manifest lists.

    An input without a kept row gives empty outputs and a manifest of zeros.
    Repeated lines are rows of their own.
    """
    out = output_dir.rstrip("/")
    lines = R.tagged_labeled(spark, input_path, text_col, label_col, row_id="doc_id")
    kept, rejected, counts = FL.write_with_reason(lines, f"{out}/_rows", FL.Limits(min_chars, None, None), given="reason",
                                                  given_reasons=[R.REASON_NO_TAB, R.REASON_BAD_LABEL])
    split = SP.stratified_split(kept.select("doc_id", "text", "label"), ratio=test_size, seed=seed)
    table = T.with_chunks(SP.with_row_id(split, seed=seed), "text", "_ch", max_tokens, max_chunks, counter, full=True)
    table = table.select("split", "id", "doc_id", "text", "label", T.chunk_texts(F.col("_ch")["chunks"]).alias("chunks"),
                         F.size(F.col("_ch")["chunks"]).alias("chunk_count"), F.col("_ch")["dropped_chunks"].alias("dropped_chunks"))
    table.write.mode("overwrite").partitionBy("split").parquet(f"{out}/_split")
    rows = spark.read.schema(table.schema).parquet(f"{out}/_split")

    names = ST.OUTPUT_NAMES
    for part in ("train", "test"):
        one = rows.where(F.col("split") == part)
        K.write_tsv(one, f"{out}/{names[f'{part}_split']}")
        K.write_csv(one, f"{out}/{names[f'xgboost_{part}']}")
        K.write_label_lines(one, f"{out}/{names[f'fasttext_{part}']}")
        K.write_chunk_records(one, f"{out}/{names[f'hbert_{part}']}")
    maps = ST.label_maps(rows)
    for name in ("label2id", "id2label"):
        K.write_json_map(maps.select(name), f"{out}/{names[name]}")
    manifest = ST.dataset_manifest(rows, test_size=test_size, max_tokens=max_tokens, max_chunks=max_chunks,
                                   paths={"input": input_path, "output_dir": output_dir}, dropped="dropped_chunks")
    K.write_json_row(manifest, f"{out}/{MANIFEST}")
    return Dataset(rows, rejected, counts, manifest)
