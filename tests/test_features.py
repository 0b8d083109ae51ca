"""Feature operators: rebalance exactness, token ids, TF-IDF invariants."""

import math

from pyspark.sql import functions as F

from chunkwise.operators import features as FE
from chunkwise.plans import tables as TB
from tests.conftest import SF_SMALL


def test_rebalance_exact(spark):
    rows = [(i, 0) for i in range(7)] + [(100 + i, 1) for i in range(3)] + [(200, 2)]
    df = spark.createDataFrame(rows, "doc_id bigint, label int")
    r = FE.rebalance(df)
    per = {x["label"]: x["n"] for x in r.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per == {0: 7, 1: 7, 2: 7}
    copies = r.groupBy("doc_id", "label").agg(F.count(F.lit(1)).alias("c")).collect()
    by = {}
    for x in copies:
        by.setdefault(x["label"], []).append(x["c"])
    assert all(max(v) - min(v) <= 1 for v in by.values())


def test_encode_ids_shape(spark):
    df = spark.createDataFrame([(1, 0, "Hello hello world"), (1, 1, ""), (2, 0, "x " * 600)],
                               "doc_id int, chunk_no int, chunk string")
    vocab = spark.createDataFrame([("hello", 4), ("x", 5)], "term string, term_id int")
    got = {(r["doc_id"], r["chunk_no"]): r for r in FE.encode_ids(df, vocab).collect()}
    a = got[(1, 0)]
    assert a["input_ids"][:5] == [2, 4, 4, 1, 3] and len(a["input_ids"]) == 512 and sum(a["attention_mask"]) == 5
    assert got[(1, 1)]["input_ids"][:3] == [2, 3, 0]
    long = got[(2, 0)]
    assert sum(long["attention_mask"]) == 512 and long["input_ids"][-1] == 3 and long["input_ids"][1] == 5


def test_tfidf_rows_are_unit_length(spark):
    docs = TB.labelled_documents(spark, SF_SMALL)
    w, vocab = FE.tfidf(docs, max_features=500, min_df=2, max_df=0.9, stop_words=["the", "of"])
    norms = w.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("s")).collect()
    assert norms and all(abs(r["s"] - 1.0) < 1e-9 for r in norms)
    v = vocab.collect()
    assert len(v) <= 500 and sorted(r["term_id"] for r in v) == list(range(len(v)))
    n = docs.count()
    assert all(abs(r["idf"] - (math.log((1 + n) / (1 + r["df"])) + 1)) < 1e-12 for r in v)


def test_reduce_dims_matches_numpy_svd(spark):
    import numpy as np

    from chunkwise.operators import models as MD

    docs = TB.labelled_documents(spark, SF_SMALL)
    w, vocab = FE.tfidf(docs, max_features=300, min_df=2, max_df=0.9, stop_words=["the", "of"])
    k = 5
    got = MD.reduce_dims(w, vocab, k=k).collect()
    ids = {r["term"]: r["term_id"] for r in vocab.collect()}
    doc_ids = sorted({r["doc_id"] for r in w.collect()})
    row = {d: i for i, d in enumerate(doc_ids)}
    a = np.zeros((len(doc_ids), len(ids)))
    for r in w.collect():
        a[row[r["doc_id"]], ids[r["term"]]] = r["weight"]
    u, s, _ = np.linalg.svd(a, full_matrices=False)
    us = np.zeros((len(doc_ids), k))
    for r in got:
        us[row[r["doc_id"]], r["dim"]] = r["value"]
    # singular values: column norms of U*S; vectors equal up to sign
    assert np.allclose(np.linalg.norm(us, axis=0), s[:k], rtol=1e-6)
    for j in range(k):
        ref = u[:, j] * s[j]
        assert min(np.abs(us[:, j] - ref).max(), np.abs(us[:, j] + ref).max()) < 1e-6


def test_tfidf_equals_plain_counts(spark):
    """Null, empty and repeated texts and keys: each row is a document."""
    from collections import Counter

    rows = [(1, "red fish blue fish"), (1, "red fish"), (None, "one fish two fish red"), (2, ""), (3, None), (4, "a b c"), (4, "red red red blue")]
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    w, vocab = FE.tfidf(df, ngram_max=2, max_features=6, min_df=2, max_df=0.9)
    docs = [[t for t in (x or "").split() if len(t) > 1] for _, x in rows]
    docs = [Counter(t + [" ".join(p) for p in zip(t, t[1:])]) for t in docs]
    df_of, total = Counter(t for d in docs for t in d), sum(docs, Counter())
    terms = sorted((t for t in df_of if 2 <= df_of[t] <= 0.9 * len(rows)), key=lambda t: (-total[t], t))[:6]
    assert [r["term"] for r in vocab.orderBy("term_id").collect()] == terms
    want = []
    for (key, _), d in zip(rows, docs, strict=True):
        x = {t: d[t] * (math.log((1 + len(rows)) / (1 + df_of[t])) + 1) for t in terms if d[t]}
        norm = math.sqrt(sum(v * v for v in x.values()))
        want += [(key, t, round(v / norm, 9)) for t, v in x.items()]
    got = [(r["doc_id"], r["term"], round(r["weight"], 9)) for r in w.collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_terms_and_ids_are_looked_up_in_the_row(spark):
    """Neither the weights nor the ids of a chunk shuffle or join a row for each term; longer n-grams are counted too."""
    rows = [(1, 0, "Red fish blue fish red fish"), (1, 0, "red"), (2, None, "one red fish x"), (None, 1, None), (3, 0, "y")]
    df = spark.createDataFrame(rows, "doc_id int, chunk_no int, chunk string").repartition(3)
    w, vocab = FE.tfidf(df, text="chunk", ngram_max=3, min_df=1, max_df=1.0)
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert {r["term"]: r["df"] for r in vocab.collect()} == {
        t: 2 if t in ("fish", "red fish") else 3 if t == "red" else 1
        for t in ("red", "fish", "blue", "one", "red fish", "fish blue", "blue fish", "fish red", "one red", "red fish blue",
                  "fish blue fish", "blue fish red", "fish red fish", "one red fish")}
    ids = FE.encode_ids(df, spark.createDataFrame([("red", 4), ("fish", 5)], "term string, term_id int"), pad_size=10)
    assert "Join" not in ids._jdf.queryExecution().executedPlan().toString()
    got = {(r["doc_id"], r["chunk_no"]): (r["input_ids"], sum(r["attention_mask"]), len(r["attention_mask"])) for r in ids.collect()}
    assert got == {(1, 0): ([2, 4, 4, 5, 1, 5, 4, 5, 3, 0], 9, 10), (2, None): ([2, 1, 4, 5, 1, 3, 0, 0, 0, 0], 6, 10),
                   (None, 1): ([2, 3, 0, 0, 0, 0, 0, 0, 0, 0], 2, 10), (3, 0): ([2, 1, 3, 0, 0, 0, 0, 0, 0, 0], 3, 10)}
