"""Classification metrics from (true, pred) pairs.

Everything derives from the C x C confusion counts, which are one
``groupBy(true, pred)`` with map-side partial aggregation: the input is
shuffled once as at most C^2 partial rows per task, whatever its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _div(a: Column, b: Column) -> Column:
    """a / b with 0 where b is 0 (zero_division = 0)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


def _f1(p: Column, r: Column) -> Column:
    return F.when((p + r) == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r))


def confusion_counts(pairs: DataFrame, true: str = "true", pred: str = "pred") -> DataFrame:
    """Non-zero cells ``(true, pred, n)``."""
    return pairs.groupBy(F.col(true).alias("true"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def label_spine(labels: DataFrame, label: str = "label") -> DataFrame:
    """All (true, pred) pairs over a small label table, without a join:
    the label list is collected into one array (bounded by the number of
    classes) and exploded twice."""
    arr = labels.agg(F.array_sort(F.collect_set(label)).alias("_l"))
    return arr.select(F.explode("_l").alias("true"), "_l").select("true", F.explode("_l").alias("pred"))


def confusion_matrix(pairs: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """F8 in long form over the fixed label list: ``(true, pred, n)``, zeros
    included.  Wide form: ``.groupBy('true').pivot('pred', ids).sum('n')``."""
    return matrix_of(confusion_counts(pairs), labels, label)


def matrix_of(counts: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """F8 from the non-zero cells."""
    spine = label_spine(labels, label)
    return spine.join(counts, ["true", "pred"], "left").select(
        "true", "pred", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def all_cells(counts: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """Cells of the label list (zeros included) and every other non-zero
    cell, so that support, predictions and totals lose no row."""
    return label_spine(labels, label).withColumn("n", F.lit(0).cast("bigint")).union(counts)


def per_class(cm: DataFrame) -> DataFrame:
    """``label, precision, recall, f1, support`` (+ ``predicted``, ``tp``)."""
    g = cm.groupBy("true").agg(F.sum(F.when(F.col("true") == F.col("pred"), F.col("n")).otherwise(0)).alias("tp"),
                               F.sum("n").alias("support"))
    pc = cm.groupBy(F.col("pred").alias("true")).agg(F.sum("n").alias("predicted"))
    r = g.join(pc, "true", "full").select(
        F.col("true").alias("label"), F.coalesce("tp", F.lit(0)).alias("tp"),
        F.coalesce("support", F.lit(0)).cast("bigint").alias("support"),
        F.coalesce("predicted", F.lit(0)).cast("bigint").alias("predicted"))
    p = _div(F.col("tp"), F.col("predicted"))
    rc = _div(F.col("tp"), F.col("support"))
    return r.select("label", p.alias("precision"), rc.alias("recall"), _f1(p, rc).alias("f1"), "support",
                    "predicted", "tp")


def classification_report(pairs: DataFrame, labels: DataFrame, names: DataFrame | None = None,
                          label: str = "label") -> DataFrame:
    """Per-class rows over all listed labels, with category names if given."""
    return report_of(confusion_counts(pairs), labels, names, label)


def report_of(counts: DataFrame, labels: DataFrame, names: DataFrame | None = None, label: str = "label") -> DataFrame:
    """F9 from the non-zero cells."""
    listed = labels.select(F.col(label).alias("label")).distinct()
    rep = per_class(all_cells(counts, labels, label)).join(listed, "label", "left_semi")
    if names is not None:
        rep = rep.join(names, "label", "left")  # small; AQE broadcasts after measuring
    return rep


def metrics_summary(pairs: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """F10-F13 in one row: accuracy; micro P/R/F1; macro over classes present
    in truth or prediction (``macro_*``) and over all listed classes
    (``macro_all_*``, the report's ``macro avg``); support-weighted P/R/F1."""
    return summary_of(confusion_counts(pairs), labels, label)


def summary_of(counts: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """F10-F13 from the non-zero cells."""
    listed = labels.select(F.col(label).alias("label")).distinct().withColumn("_in", F.lit(True))
    rep = per_class(all_cells(counts, labels, label)).join(listed, "label", "left")
    present = (F.col("support") > 0) | (F.col("predicted") > 0)

    def pavg(c: str) -> Column:
        return F.sum(F.when(present, F.col(c))) / F.sum(F.when(present, 1))

    tp, sup, prd = F.sum("tp"), F.sum("support"), F.sum("predicted")
    mp, mr = _div(tp, prd), _div(tp, sup)
    return rep.agg(
        sup.alias("n"),
        _div(tp, sup).alias("accuracy"),
        mp.alias("micro_precision"), mr.alias("micro_recall"), _f1(mp, mr).alias("micro_f1"),
        pavg("precision").alias("macro_precision"), pavg("recall").alias("macro_recall"), pavg("f1").alias("macro_f1"),
        F.avg(F.when(F.col("_in"), F.col("precision"))).alias("macro_all_precision"), F.avg(F.when(F.col("_in"), F.col("recall"))).alias("macro_all_recall"),
        F.avg(F.when(F.col("_in"), F.col("f1"))).alias("macro_all_f1"),
        _div(F.sum(F.col("precision") * F.col("support")), sup).alias("weighted_precision"),
        _div(F.sum(F.col("recall") * F.col("support")), sup).alias("weighted_recall"),
        _div(F.sum(F.col("f1") * F.col("support")), sup).alias("weighted_f1"),
    )


def cross_entropy(df: DataFrame, logits: str = "logits", label: str = "label") -> DataFrame:
    """mean of ``logsumexp(logits) - logits[label]`` (one row: n, loss)."""
    from chunkwise.functions.text import let

    def row_loss(lg: Column) -> Column:
        return let(F.array_max(lg), lambda mx: mx + F.log(F.aggregate(lg, F.lit(0.0), lambda s, v: s + F.exp(v - mx)))
                   - F.element_at(lg, F.col(label) + 1))

    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(let(F.col(logits), row_loss)).alias("loss"))


def top_confusions(cm: DataFrame, k: int = 5) -> DataFrame:
    """the k largest off-diagonal cells (ties: lower true, then pred)."""
    return cm.where((F.col("true") != F.col("pred")) & (F.col("n") > 0)) \
        .orderBy(F.col("n").desc(), "true", "pred").limit(k)


def wide_confusion(cm: DataFrame, labels: list[int]) -> DataFrame:
    """Confusion matrix as rows per true label, one column per predicted
    label id (pivot over the fixed list, so no extra pass to find values)."""
    return cm.groupBy("true").pivot("pred", labels).agg(F.sum("n")).orderBy("true")
