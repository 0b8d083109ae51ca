"""Randomised SVD against numpy."""

import numpy as np
import pytest

from chunkwise.operators import svd


def matrix(n, width, seed=0):
    """Sparse rows with a decaying spectrum, an empty row and repeated rows."""
    r = np.random.default_rng(seed)
    a = r.normal(size=(n, 12)) @ (np.diag(2.0 ** -np.arange(12)) @ r.normal(size=(12, width)))
    a = np.where(r.random((n, width)) < 0.5, a, 0.0)
    a[3] = 0
    a[5] = a[4]
    return a


def frames(spark, a, parts):
    long = [(i if i else None, f"t{j}", float(x)) for i, row in enumerate(a) for j, x in enumerate(row) if x]
    vocab = [(f"t{j}", j) for j in range(a.shape[1])]
    return (spark.createDataFrame(long, "doc_id long, term string, weight double").repartition(parts),
            spark.createDataFrame(vocab, "term string, term_id int"))


@pytest.mark.parametrize(("n", "width", "parts", "fan"), [(60, 20, 3, 16), (300, 40, 8, 2), (9, 30, 2, 16)])
def test_singular_values_equal_numpy(spark, monkeypatch, n, width, parts, fan):
    monkeypatch.setattr(svd, "FAN", fan)
    a, k = matrix(n, width), 6
    u, s = svd.reduce_rows(*frames(spark, a, parts), k, "doc_id")
    full_u, full_s, vt = np.linalg.svd(a, full_matrices=False)
    assert np.allclose(s, full_s[:k], rtol=1e-6)
    got = np.zeros((n, k))
    for r in u.collect():
        got[r["doc_id"] or 0, r["dim"]] = r["value"]
    sign = np.sign(vt[np.arange(k), np.abs(vt[:k]).argmax(1)])
    assert np.allclose(got, full_u[:, :k] * full_s[:k] * sign, atol=1e-5 * full_s[0])


def test_fewer_terms_than_dimensions(spark):
    a = np.array([[1.0, 2.0], [3.0, 4.0], [0.5, 0.0]])
    w, v = frames(spark, a, 1)
    u, s = svd.reduce_rows(w, v, 16, "doc_id")
    assert np.allclose(s, np.linalg.svd(a, compute_uv=False)) and u.count() == 3 * 2


def test_no_rows(spark):
    w, v = frames(spark, np.zeros((4, 3)), 1)
    u, _ = svd.reduce_rows(w, v, 2, "doc_id")
    assert u.collect() == []


def test_product_holds_few_numbers():
    """A batch takes the memory of one row's slice of the matrix, not of all rows'."""
    import tracemalloc

    import pandas as pd

    r = np.random.default_rng(4)
    ids = [r.permutation(3000)[:n].astype(np.int32) for n in [400] * 300 + [0, 3000]]
    f = pd.DataFrame({"ids": ids, "w": [r.normal(size=len(i)) for i in ids]})
    right = r.normal(size=(3000, 100))
    tracemalloc.start()
    got = svd.product(f, right)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = np.array([w @ right[i] if len(i) else np.zeros(100) for i, w in zip(f["ids"], f["w"], strict=True)])
    assert np.allclose(got, want, rtol=1e-12, atol=1e-12) and peak < 6e6
