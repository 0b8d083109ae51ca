"""Metric-log operators: best step with early stopping (G6) and the running
mean reported every n-th step (G7), over a table of many runs.

Both need prefix aggregates in step order inside a run.  A window
``partitionBy(run)`` would sort a whole run in one task, so a run with a
third of all rows would stall the job.  Instead the rows are
range-partitioned on ``(run, order...)`` (Spark samples the bounds, so a hot
run is cut across many partitions), each (run, partition) block gets its
aggregate, a small window over the block table gives every block the
prefix of the blocks before it, and the final windows run per block.
Results equal a single ordered scan per run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkwise.operators.splits import null_safe_join
from chunkwise.session import checkpoint_dir

# ---------------------------------------------------------------------------
# Reference defaults.
# ---------------------------------------------------------------------------
PATIENCE = 2
LOG_EVERY = 10
INITIAL_BEST = -1.0
# ---------------------------------------------------------------------------

_U = Window.unboundedPreceding


def assign_blocks(df: DataFrame, run: str, order: list[str], n_blocks: int | None = None) -> DataFrame:
    """Range-partition on (run, order...) and tag each row with its block.

    Range bounds are sampled per exchange, so the tagged rows are written to
    the shared checkpoint folder once and every branch reads those.
    """
    checkpoint_dir(df.sparkSession)
    n = n_blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, run, *order).withColumn("_blk", F.spark_partition_id()).checkpoint()


def block_prefix(df: DataFrame, run: str, order: list[str], specs: dict[str, tuple[str, Column, bool]]) -> DataFrame:
    """Add prefix aggregates per run in ``order``.

    ``specs[name] = (kind, value, inclusive)`` with kind ``sum``, ``max`` or
    ``count``; ``inclusive`` includes the current row.  Requires ``_blk``.
    """
    agg = {"sum": F.sum, "max": F.max, "count": F.count}
    blocks = df.groupBy(run, "_blk").agg(*[agg[k](v).alias(f"_b_{n}") for n, (k, v, _) in specs.items()])
    wb = Window.partitionBy(run).orderBy("_blk").rowsBetween(_U, -1)
    roll = {"sum": F.sum, "max": F.max, "count": F.sum}
    offs = blocks.select(run, "_blk", *[roll[k](f"_b_{n}").over(wb).alias(f"_o_{n}") for n, (k, _, _) in specs.items()])
    # one row per (run, block): at most #runs + #blocks rows; AQE broadcasts it
    d = null_safe_join(df, offs, [run, "_blk"], "left")
    wl = Window.partitionBy(run, "_blk").orderBy(*order)
    for n, (k, v, inclusive) in specs.items():
        local = agg[k](v).over(wl.rowsBetween(_U, 0 if inclusive else -1))
        off = F.col(f"_o_{n}")
        if k == "max":
            val = F.greatest(off, local)  # greatest skips nulls
        else:
            val = F.coalesce(off, F.lit(0)) + F.coalesce(local, F.lit(0))
        d = d.withColumn(n, val)
    return d.drop(*[f"_o_{n}" for n in specs])


def with_steps(df: DataFrame, run: str, order: list[str], metric: str) -> DataFrame:
    """Add ``step`` (1-based position in the run) and ``prev_max`` (largest
    metric at earlier steps), plus running ``cum_sum``."""
    d = assign_blocks(df, run, order)
    return block_prefix(d, run, order, {
        "step": ("count", F.lit(1), True),
        "prev_max": ("max", F.col(metric), False),
        "cum_sum": ("sum", F.col(metric), True),
    })


def early_stop(df: DataFrame, run: str = "run", order: list[str] | None = None, metric: str = "metric",
               patience: int = PATIENCE) -> DataFrame:
    """G6 per run: the best value starts at -1; a step improves when its
    metric is strictly larger than the best so far; the patience counter
    resets on improvement and counts other steps; training stops at the first
    step where the counter reaches ``patience``.

    Output: ``run, n_steps, best_step, best_metric, stop_step`` (stop_step
    null when the run never stops; best_step null when nothing improved).
    """
    order = order or ["step"]
    d = with_steps(df, run, order, metric)
    best_before = F.greatest(F.coalesce(F.col("prev_max"), F.lit(INITIAL_BEST)), F.lit(INITIAL_BEST))
    d = d.withColumn("_best_before", best_before).withColumn("_imp", F.col(metric) > F.col("_best_before"))
    d = block_prefix(d, run, ["step"], {"_last_imp": ("max", F.when(F.col("_imp"), F.col("step")).otherwise(0), True)})
    cand = (F.col("step") - F.col("_last_imp")) >= patience
    g = d.groupBy(run).agg(
        F.max("step").alias("n_steps"),
        F.min(F.when(cand, F.col("step"))).alias("stop_step"),
        F.min_by(F.col("_best_before"), F.when(cand, F.col("step"))).alias("_best_at_stop"),
        F.max(F.when(F.col("_imp"), F.col("step"))).alias("_last"),
        F.max(metric).alias("_max"),
    )
    best_step = F.when(F.col("stop_step").isNotNull(), F.col("stop_step") - patience).otherwise(F.col("_last"))
    g = g.withColumn("best_step", F.when(best_step > 0, best_step))
    best_metric = F.when(F.col("best_step").isNull(), F.lit(None).cast("double")) \
        .when(F.col("stop_step").isNotNull(), F.col("_best_at_stop")).otherwise(F.col("_max"))
    return g.select(run, "n_steps", "best_step", best_metric.alias("best_metric"), "stop_step")


def running_mean(df: DataFrame, run: str = "run", order: list[str] | None = None, value: str = "metric",
                 every: int = LOG_EVERY) -> DataFrame:
    """Mean of the values up to each step, reported at every ``every``-th
    step: ``run, step, running_mean``."""
    d = with_steps(df, run, order or ["step"], value)
    d = d.where(F.col("step") % every == 0)
    return d.select(run, "step", (F.col("cum_sum") / F.col("step")).alias("running_mean"))
