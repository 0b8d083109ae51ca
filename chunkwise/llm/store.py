"""Intermediate tables in the shared folder, which outlive executors and carry no lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from chunkwise.session import checkpoint_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the folder of ``spark.checkpoint.dir`` and read again."""
    spark = df.sparkSession
    out = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(out)
    return spark.read.schema(df.schema).parquet(out)
