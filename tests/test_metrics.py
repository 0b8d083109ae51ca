"""Metric operators against the published 20-class test confusion matrix
(FIXTURES section 3): the counts are expanded to 223 (true, pred) pairs and
every summary number must match to 1e-12."""

import os

import pytest
from pyspark.sql import functions as F

from chunkwise.operators import metrics as M

HERE = os.path.dirname(__file__)

EXPECTED = {
    "accuracy": 0.9192825112107623,
    "macro_all_precision": 0.9281501831501832,
    "macro_all_recall": 0.9216414141414141,
    "macro_all_f1": 0.9200258705937129,
    "weighted_precision": 0.9286395965768164,
    "weighted_recall": 0.9192825112107623,
    "weighted_f1": 0.9190865619439618,
}


@pytest.fixture(scope="module")
def golden(spark):
    rows = []
    with open(os.path.join(HERE, "data", "golden_confusion_counts.csv")) as f:
        for t, line in enumerate(f):
            for p, n in enumerate(line.strip().split(",")):
                rows += [(t, p)] * int(n)
    pairs = spark.createDataFrame(rows, "true int, pred int")
    labels = spark.createDataFrame([(i,) for i in range(20)], "label int")
    return pairs, labels


def test_summary_matches_published_report(golden):
    pairs, labels = golden
    s = M.metrics_summary(pairs, labels).collect()[0].asDict()
    assert s["n"] == 223
    for k, v in EXPECTED.items():
        assert abs(s[k] - v) < 1e-12, (k, s[k], v)
    # all 20 classes are present, so both macro variants agree
    assert abs(s["macro_f1"] - s["macro_all_f1"]) < 1e-15
    assert abs(s["micro_f1"] - s["accuracy"]) < 1e-15


def test_per_class_extremes(golden):
    pairs, labels = golden
    rep = {r["label"]: r for r in M.classification_report(pairs, labels).collect()}
    assert abs(rep[17]["f1"] - 0.8) < 1e-12          # weakest class
    assert rep[0]["f1"] == 1.0 and rep[9]["f1"] == 1.0  # best classes
    assert sum(r["support"] for r in rep.values()) == 223


def test_errors_are_distinct_cells(golden):
    pairs, labels = golden
    cm = M.confusion_matrix(pairs, labels)
    off = cm.where((F.col("true") != F.col("pred")) & (F.col("n") > 0)).collect()
    assert len(off) == 18 and all(r["n"] == 1 for r in off)
    top = M.top_confusions(cm, 3).collect()
    assert [(r["true"], r["pred"]) for r in top] == [(1, 5), (1, 14), (1, 15)]


def test_macro_present_vs_all(spark):
    pairs = spark.createDataFrame([(0, 0), (0, 1), (1, 1)], "true int, pred int")
    labels = spark.createDataFrame([(i,) for i in range(4)], "label int")
    s = M.metrics_summary(pairs, labels).collect()[0]
    # present classes 0 and 1: P=(1+0.5)/2, over all four: /4
    assert abs(s["macro_precision"] - 0.75) < 1e-15
    assert abs(s["macro_all_precision"] - 0.375) < 1e-15
