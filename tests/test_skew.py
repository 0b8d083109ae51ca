"""Hot keys: one class / one run holding most rows must be spread over many
tasks and still give exact results."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from chunkwise.operators import splits as SP
from chunkwise.operators import training as TR


def test_hot_class_rank_is_exact_and_spread(spark):
    # label 0 holds 90% of 20,000 rows
    df = spark.range(20000).select(F.col("id").alias("doc_id"),
                                   F.when(F.col("id") % 10 == 0, F.col("id") % 7 + 1).otherwise(0).alias("label"))
    ok = SP.order_key("doc_id", 42, "test")
    r = SP.exact_rank(df, ["label"], ok, "doc_id", name="r", digits=2)
    ref = df.withColumn("r2", F.row_number().over(Window.partitionBy("label").orderBy(ok, "doc_id")))
    assert r.join(ref, ["doc_id", "label"]).where(F.col("r") != F.col("r2")).count() == 0
    # the final row_number runs per (label, bucket): the hot label is cut into many groups
    buckets = df.where("label = 0").select(F.substring(ok, 1, 2).alias("b")).distinct().count()
    assert buckets == 256
    s = SP.stratified_split(df)
    k = s.where("label = 0 and split = 'test'").count()
    assert k == 1800  # round_half_even(18000 * 0.1)


def test_hot_run_scan_spans_blocks(spark):
    # run 1 holds 95% of the rows; steps must still be 1..n in order
    n = 5000
    df = spark.range(n).select(F.when(F.col("id") % 20 == 0, F.lit(2)).otherwise(F.lit(1)).alias("run"),
                               F.col("id").alias("event_id"), (F.col("id") * 7 % 11).cast("double").alias("metric"))
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        d = TR.with_steps(df, "run", ["event_id"], "metric")
        blocks = d.where("run = 1").select("_blk").distinct().count()
        rows = d.where("run = 1").select("event_id", "step", "cum_sum").orderBy("event_id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert blocks > 4
    total = 0.0
    for i, r in enumerate(rows, start=1):
        total += (r["event_id"] * 7 % 11)
        assert r["step"] == i and abs(r["cum_sum"] - total) < 1e-9
