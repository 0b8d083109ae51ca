"""Row replication and the two outputs of stream scoring."""

import hashlib
from collections import Counter

from pyspark.sql import functions as F

from chunkwise.operators import features as FE
from chunkwise.operators import models as MD
from chunkwise.streaming import scoring as SC


def plain(rows):
    by = {}
    for place, (k, g) in enumerate(rows):
        h = hashlib.md5("|".join(["42", "rebalance"] + ([] if k is None else [str(k)])).encode()).hexdigest()
        by.setdefault(g, []).append((h, k is not None, k or 0, place))
    most = max(map(len, by.values()), default=0)
    out = Counter()
    for group in by.values():
        for r, (*_, place) in enumerate(sorted(group), 1):
            out[place] = most // len(group) + (r <= most % len(group))
    return out


def test_rebalance_equals_plain_counts(spark):
    rows = [(i, i % 5 if i % 11 else None) for i in range(200)] + [(7, 9), (7, 9), (None, 8), (None, 8), (None, 8)]
    df = spark.createDataFrame([(k, g, i, "x") for i, (k, g) in enumerate(rows)], "doc_id long, label int, place int, copy string").coalesce(1)
    for copies in (4096, 6):
        got = FE.rebalance(df, copies=copies)
        assert got.columns == [*df.columns, "copy_no"]
        seen = got.groupBy("place").agg(F.count("*").alias("n"), F.count_distinct("copy_no").alias("d"), F.min("copy_no").alias("a"), F.max("copy_no").alias("b"))
        assert {r["place"]: r["n"] for r in seen.collect()} == plain(rows)
        assert all(r["n"] == r["d"] == r["b"] and r["a"] == 1 for r in seen.collect())
    assert FE.rebalance(df.limit(0)).count() == 0


def test_one_row_of_many_copies_spreads(spark):
    df = spark.range(400_000).select("id", F.lit(0).alias("label")).unionByName(spark.range(1).select((F.col("id") - 1).alias("id"), F.lit(1).alias("label")))
    r = FE.rebalance(df, key="id")
    one = r.where("label = 1").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(x["count"] for x in one) == 400_000 and len(one) >= 6 and max(x["count"] for x in one) < 200_000
    assert r.where("label = 1").select("copy_no").distinct().count() == 400_000
    assert dict(r.dtypes)["copy_no"] == "bigint"


def test_stream_writes_scores_and_rejects_once(spark, tmp_path):
    rows = [(i, f"Some text number {i}. Another sentence." if i % 4 else (None if i % 8 else "  ")) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    cats = spark.createDataFrame([(i, f"c{i}") for i in range(5)], "label int, name string")
    model = MD.default_model(5)
    batch = MD.predict(docs, model, cats).select("doc_id", "text", "label", "category")
    out = f"{tmp_path}/out"
    stream = lambda: SC.document_stream(spark, str(tmp_path), 1)
    for _ in range(2):  # the second call finds no new input
        ok, bad = SC.score_to_table(spark, stream(), model, cats, path=out)
        assert sorted(map(tuple, ok.select(batch.columns).collect())) == sorted(map(tuple, batch.collect()))
        assert sorted((r["doc_id"], r["status"]) for r in bad.collect()) == [(i, "empty") for i in range(0, 40, 4)]
    SC.score_batch(docs.limit(10), 0, model, cats, f"{out}/replay")
    SC.score_batch(docs.limit(10), 0, model, cats, f"{out}/replay")  # a replayed batch adds no row
    assert spark.read.parquet(f"{out}/replay").count() == 10


def test_stream_without_input(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema("doc_id long, text string").parquet(str(tmp_path / "in"))
    ok, bad = SC.score_to_table(spark, stream, MD.default_model(3))
    assert ok.count() == bad.count() == 0 and ok.columns == ["doc_id", "text", "label"]
