"""Supervised word vectors: learning, agreement with one plain task, persistence."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkwise.operators import metrics as M
from chunkwise.operators import models as MD
from chunkwise.operators import wordvec as W


def labelled(spark, n=600, seed=0):
    """The class is told by one word of thirty; the others are noise."""
    r = random.Random(seed)
    noise = [f"word{k}" for k in range(400)]
    rows = []
    for i in range(n):
        y = i % 4
        w = r.choices(noise, k=30)
        w[r.randrange(30)] = f"sign{y}{r.randrange(3)}"
        rows.append((i, " ".join(w), y))
    rows += [(9000, None, 1), (9001, "", 2), (9002, "word1 sign00", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, label int")


def macro_f1(model, dev):
    p = model.transform(dev).select(F.col("label").alias("true"), F.col("prediction").cast("int").alias("pred"))
    return M.metrics_summary(p, dev.select("label").distinct()).first()["macro_f1"]


@pytest.fixture(scope="module")
def parts(spark):
    d = labelled(spark)
    return d.where("doc_id % 5 <> 0"), d.where("doc_id % 5 = 0 and doc_id < 9000")


@pytest.fixture(scope="module")
def fitted(spark, parts):
    return W.SupervisedWordVectors(buckets=4096, dim=16, epochs=40, rate=2.0, tasks=4).fit(parts[0])


def test_beats_the_unsupervised_vectors(parts, fitted):
    train, dev = parts
    plain = MD.fit_wordvec_baseline(train.where("label is not null and text is not null"), dim=16)
    assert macro_f1(fitted, dev) > 0.9
    assert macro_f1(fitted, dev) > macro_f1(plain, dev) + 0.1


def test_save_and_load(parts, fitted, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel

    fitted.write().overwrite().save(str(tmp_path / "m"))
    again = W.SupervisedWordVectorsModel.load(str(tmp_path / "m"))
    rows = lambda m: sorted(map(str, map(tuple, m.transform(parts[1]).collect())))
    assert rows(again) == rows(fitted) and again.uid == fitted.uid
    p = Pipeline(stages=[W.SupervisedWordVectors(buckets=64, dim=4, epochs=1)]).fit(parts[0])
    p.write().save(str(tmp_path / "p"))
    assert rows(PipelineModel.load(str(tmp_path / "p"))) == rows(p)


def test_gradient_equals_differences():
    """A step follows the numeric gradient of the batch's cross entropy."""
    r = np.random.default_rng(1)
    ids = [np.array([0, 1, 1]), np.array([2]), np.array([], int), np.array([3, 0])]
    y = np.array([0, 2, 1, 1])
    v, h = r.normal(size=(5, 3)), r.normal(size=(3, 3))

    def loss(v, h):
        x = np.array([v[i].mean(0) if len(i) else np.zeros(3) for i in ids])
        return -np.log(W.softmax(x @ h.T)[np.arange(4), y]).sum()

    a, b, rate = v.astype(np.float64).copy(), h.copy(), 1e-6
    W.learn(ids, y, a, b, rate)
    for old, new, which in ((v, a, 0), (h, b, 1)):
        for i in np.ndindex(*old.shape):
            args = [[v.copy(), h.copy()] for _ in range(2)]
            args[0][which][i] += 1e-5
            args[1][which][i] -= 1e-5
            slope = (loss(*args[0]) - loss(*args[1])) / 2e-5
            assert abs((old[i] - new[i]) / rate - slope) < 2e-3


def test_every_row_is_predicted(spark, fitted):
    d = spark.createDataFrame([(1, None), (1, ""), (None, "sign00 " * 50)], "doc_id int, text string")
    assert fitted.transform(d).count() == 3 and fitted.transform(d.limit(0)).count() == 0
    assert fitted.transform(d).where("prediction >= 0").count() == 3  # a filter above the prediction


def test_prediction_holds_few_vectors():
    """Means of many rows take memory in proportion to a piece, not to the ids of the batch."""
    import tracemalloc

    r = np.random.default_rng(2)
    v = r.normal(size=(512, 64)).astype(np.float32)
    ids = [r.integers(0, 512, 400).astype(np.int32) for _ in range(1500)] + [np.zeros(0, np.int32), r.integers(0, 512, 90_000).astype(np.int32)]
    tracemalloc.start()
    got = W.means(ids, v)
    got = got[0] if isinstance(got, tuple) else got
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6  # all vectors at once: 177 MB
    want = np.array([np.add.reduceat(v[i], [0], axis=0)[0] / len(i) if len(i) else np.zeros(64) for i in ids], np.float32)
    assert (got[:-1] == want[:-1]).all() and np.allclose(got[-1], want[-1], atol=1e-6)


def test_sums_of_runs():
    """Runs of any length: the same bits as one run at a time."""
    r = np.random.default_rng(3)
    n = np.r_[r.integers(1, 12, 300), 500, 1]
    start = np.cumsum(n) - n
    x = r.normal(size=(n.sum(), 16)).astype(np.float32)
    assert (W.run_sums(x, start, n) == np.add.reduceat(x, start, axis=0)).all()
    assert W.run_sums(x[:0], start[:0], n[:0]).shape == (0, 16)
