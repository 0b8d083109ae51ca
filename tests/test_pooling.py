"""Pooling over rows against numpy: long documents, repeated and null keys, padding, extreme scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkwise.operators import vectors as V

SCHEMA = "doc long, embedding array<double>, mask int, n int"


def attention(xs, masks, w, b, v):
    s = np.array([np.dot(v, np.tanh(np.asarray(w) @ x + b)) if m else -1e4 for x, m in zip(xs, masks, strict=True)])
    e = np.exp(s - s.max())
    return (e[:, None] * xs).sum(0) / e.sum()


def mean(xs, masks):
    return (np.asarray(masks)[:, None] * xs).sum(0) / max(1, sum(masks))


@pytest.fixture(scope="module")
def docs():
    r = np.random.default_rng(0)
    out = {d: [(r.normal(size=4).tolist(), int(r.random() < 0.7)) for _ in range(n)] for d, n in [(1, 1), (2, 3), (3, 40), (None, 5)]}
    return out | {4: [([1.0, 2.0, 3.0, 4.0], 0), ([3.0, 2.0, 1.0, 0.0], 0)]}  # padding alone


def frame(spark, docs):
    rows = [(d, x, m, 7) for d, c in docs.items() for x, m in c]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def check(got, want):
    got = {r["doc"]: r["doc_vec"] for r in got.collect()}
    assert set(got) == set(want)
    for d, x in want.items():
        assert np.allclose(got[d], x, rtol=1e-12, atol=1e-12), d


@pytest.mark.parametrize("scale", [1.0, 40.0, 300.0])
def test_pooling_equals_numpy(spark, docs, scale):
    w, b, v = V.attention_weights(4)
    v = [x * scale for x in v]  # scores far apart: exponents differ within a document
    d = frame(spark, docs)
    check(V.pool_attention(d, w, b, v), {k: attention(*map(np.array, zip(*c, strict=True)), w, b, v) for k, c in docs.items()})
    check(V.pool_mean(d), {k: mean(*map(np.array, zip(*c, strict=True))) for k, c in docs.items()})
    check(V.pool_mean(d, mask=None), {k: mean(np.array([x for x, _ in c]), [1] * len(c)) for k, c in docs.items()})


def test_a_long_document(spark):
    n = 100_000
    d = spark.range(n).select(F.lit(1).cast("long").alias("doc"), F.array(*[F.sin(F.col("id") * (i + 1)) for i in range(4)]).alias("embedding"),
                              (F.col("id") % 3 > 0).cast("int").alias("mask"))
    x = np.sin(np.arange(n)[:, None] * np.arange(1, 5))
    m = (np.arange(n) % 3 > 0).astype(int)
    w, b, v = V.attention_weights(4)
    s = np.where(m > 0, np.tanh(x @ np.asarray(w).T + b) @ v, -1e4)
    e = np.exp(s - s.max())
    got = V.pool_attention(d, w, b, v).first()["doc_vec"]
    assert np.allclose(got, (e[:, None] * x).sum(0) / e.sum(), rtol=1e-9)
    assert np.allclose(V.pool_mean(d).first()["doc_vec"], (m[:, None] * x).sum(0) / m.sum(), rtol=1e-9)


def test_plan_adds_up_before_the_shuffle(spark, docs):
    import contextlib
    import io

    with contextlib.redirect_stdout(io.StringIO()) as out:
        V.pool_attention(frame(spark, docs), *V.attention_weights(4)).explain()
    assert "collect_list" not in out.getvalue() and "partial_sum" in out.getvalue()


def test_nulls_and_empty(spark):
    rows = [(1, [1.0, 2.0], 1, 0), (1, None, 1, 0), (1, [5.0, 6.0], None, 0), (2, None, 1, 0)]
    d = spark.createDataFrame(rows, SCHEMA)
    w, b, v = V.attention_weights(2)
    got = {r["doc"]: r["doc_vec"] for r in V.pool_attention(d, w, b, v).collect()}
    assert np.allclose(got[1], [1.0, 2.0]) and got[2] is None
    assert {r["doc"]: r["doc_vec"] for r in V.pool_mean(d).collect()} == {1: [1.0, 2.0], 2: [0.0, 0.0]}
    assert V.pool_mean(d.limit(0)).collect() == [] and V.pool_attention(d.limit(0), w, b, v).collect() == []


def test_numpy_pooling_equals_native(spark):
    from pyspark.sql import functions as F

    from chunkwise.operators import encoders as EN
    from chunkwise.operators import vectors as V

    w, b, v = V.attention_weights(16)
    rows = [(0, ["a b, c", "", "x"], [1, 0, 1]), (1, ["", "", ""], [1, 0, 0]), (2, ["İ Σ straße é a a", "b " * 700, "z"], [1, 1, 0]), (3, None, None)]
    d = spark.createDataFrame(rows, "i int, c array<string>, m array<int>").repartition(2)
    d = d.withColumn("t", EN.chunk_tokens(F.col("c"))).withColumn("native", F.transform("c", lambda x: EN.hashed_vector(x, 16)))
    d = d.withColumn("vecs", EN.hashed_udf(16)(F.col("t")))
    d = d.withColumn("h", V.hidden_udf(w, b)(F.col("vecs"))).localCheckpoint()
    d = d.withColumn("p", V.pool_attention_rows(F.col("vecs"), F.col("m"), w, b, v, F.col("h"))).withColumn("q", V.pool_attention_rows(F.col("native"), F.col("m"), w, b, v))
    for r in d.collect():
        assert r.vecs == r.native and r.p == r.q and (r.p is None) == (r.i == 3)
