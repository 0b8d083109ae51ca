"""Session helpers: one place for the configuration the jobs rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "chunkwise") -> SparkSession:
    """Return the active session or build a local one (tests, bench).

    On a cluster the session already exists and is returned untouched; the
    settings below only apply when this process creates it.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    master = master or os.environ.get("CHUNKWISE_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("CHUNKWISE_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CHUNKWISE_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only when the setting is absent (local tests) a scratch folder is created
    and registered; on a cluster the configured shared folder is always used.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="chunkwise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(conf)
    return conf
