"""Tables written once into the shared folder, so that later passes neither repeat nor shuffle what led to them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from chunkwise.session import checkpoint_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet under ``spark.checkpoint.dir``, read again.  It has
    no lineage and outlives executors; rows keep their order within a file."""
    out = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(out)
    return df.sparkSession.read.schema(df.schema).parquet(out)
