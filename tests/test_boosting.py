"""Boosted trees: sums and splits against plain loops, learning, persistence."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkwise.operators import boosting as B
from chunkwise.operators import models as MD


def labelled(spark, n=400):
    """The class is told by one word of twenty; the others are noise."""
    r = random.Random(1)
    noise = [f"word{k}" for k in range(150)]
    rows = []
    for i in range(n):
        w = r.choices(noise, k=20)
        w[r.randrange(20)] = f"sign{i % 4}{r.randrange(2)}"
        rows.append((i, " ".join(w), i % 4))
    rows += [(9000, None, 1), (9001, "", 2), (9002, "word1 sign00", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(4)


@pytest.fixture(scope="module")
def halves(spark):
    d = labelled(spark).cache()
    return d.where("doc_id % 5 <> 0"), d.where("doc_id % 5 = 0 and doc_id < 9000")


@pytest.fixture(scope="module")
def fitted(halves):
    return B.BoostedTrees(features=400, rounds=5, depth=3, rate=0.5, bins=3).fit(halves[0])


def accuracy(model, dev):
    p = model.transform(dev)
    return p.where(F.col("prediction").cast("int") == F.col("label")).count() / p.count()


def test_beats_the_forest(halves, fitted):
    train, dev = halves
    forest = MD.fit_tree_baseline(train.where("label is not null and text is not null"), ["the"], num_trees=20, max_depth=6, vocab_size=400)
    assert accuracy(fitted, dev) > 0.85 and accuracy(fitted, dev) > accuracy(forest, dev)


def test_sums_and_splits_equal_loops():
    r = np.random.default_rng(0)
    n, width, q, k = 40, 6, 3, 3
    b = B.Booster([f"t{i}" for i in range(width)], np.ones(width), np.tile([0.3, 0.6], (width, 1)), np.log([0.5, 0.3, 0.2]), 2)
    ids = [np.flatnonzero(r.random(width) < 0.5) for _ in range(n)]
    w = [r.random(len(i)) for i in ids]
    bins = [b.bins(i, x) for i, x in zip(ids, w, strict=True)]
    y = r.integers(0, k, n)
    term, cut = np.array([[0, 0, 0], [1, 0, 0], [2, 0, 0]]), np.array([[0, 9, 9], [1, 9, 9], [B.NONE, 9, 9]])
    out, total = np.zeros((k, 2, 2 * width * q)), np.zeros((k, 2, 2))
    B.histograms(b, 1, term, cut, ids, bins, y, out, total)
    p = np.array([0.5, 0.3, 0.2])
    for c in range(k):
        want, all_ = np.zeros((2, 2, width, q)), np.zeros((2, 2))
        for j in range(n):
            x = dict(zip(ids[j].tolist(), bins[j].tolist(), strict=True))
            node = int(x.get(term[c, 0], 0) > cut[c, 0])
            gh = np.array([p[c] - (y[j] == c), p[c] * (1 - p[c])])
            all_[:, node] += gh
            for f, v in x.items():
                want[:, node, f, v - 1] += gh
        assert np.allclose(out[c].reshape(2, 2, width, q), want) and np.allclose(total[c], all_)
        t, x, child = B.best_splits(out[c], total[c], width, q, 1.0)
        for node in range(2):
            best = max((sum(s[0] ** 2 / (s[1] + 1.0) for s in (right, all_[:, node] - right)) - all_[0, node] ** 2 / (all_[1, node] + 1.0), right.tolist())
                       for f in range(width) for v in range(q) for right in [want[:, node, f, v:].sum(axis=1)]
                       if min(right[1], all_[1, node] - right[1]) >= B.LEAST_HESSIAN) if all_[1, node] > 1 else None
            if best and best[0] > 1e-9:
                right = want[:, node, t[node], x[node]:].sum(axis=1)
                assert np.allclose(child[:, node, 1], right) and np.allclose(child[:, node].sum(axis=1), all_[:, node])
                got = sum(s[0] ** 2 / (s[1] + 1.0) for s in (right, all_[:, node] - right)) - all_[0, node] ** 2 / (all_[1, node] + 1.0)
                assert abs(got - best[0]) < 1e-9


def test_save_load_and_every_row(spark, halves, fitted, tmp_path):
    fitted.write().overwrite().save(str(tmp_path / "m"))
    again = B.BoostedTreesModel.load(str(tmp_path / "m"))
    rows = lambda m: sorted(map(str, map(tuple, m.transform(halves[1]).collect())))
    assert rows(again) == rows(fitted) and again.uid == fitted.uid
    d = spark.createDataFrame([(1, None), (1, ""), (None, "sign00 " * 50)], "doc_id int, text string")
    assert fitted.transform(d).count() == 3 and fitted.transform(d.limit(0)).count() == 0


def test_known_terms_without_objects():
    """Terms are looked up in Arrow memory: what Python allocates does not grow with the unknown terms."""
    import tracemalloc

    import pyarrow as pa

    r = random.Random(3)
    rows = [[{"term": f"t{r.randrange(2000)}", "tf": r.randrange(1, 9)} for _ in range(300)] for _ in range(500)] + [None, []]
    b = B.Booster([f"t{k}" for k in range(50)], np.linspace(1, 2, 50), np.full((50, 1), 0.4), np.zeros(2), 1)
    counts = pa.array(rows, pa.list_(pa.struct([("term", pa.string()), ("tf", pa.int64())]))).slice(3)
    tracemalloc.start()
    row, ids, bins = b.encode(counts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5e6
    want = []
    for k, pairs in enumerate(rows[3:]):
        known = [(int(p["term"][1:]), p["tf"]) for p in pairs or () if int(p["term"][1:]) < 50]
        x = np.array([t for _, t in known], float) * b.idf[[i for i, _ in known]] if known else np.zeros(0)
        want += [(k, i, 1 + int(v > 0.4)) for (i, _), v in zip(known, x / np.sqrt((x * x).sum()) if known else (), strict=True)]
    assert list(zip(row.tolist(), ids.tolist(), bins.tolist(), strict=True)) == want
