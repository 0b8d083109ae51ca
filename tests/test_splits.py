"""Split invariants: exact per-class counts, disjoint and covering splits,
two-level rank equal to a plain row_number."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chunkwise.operators import splits as SP
from tests.conftest import SF_ORACLE

# FIXTURES section 5: rows held out per class of n at ratio 0.1
HELD_OUT = {1: 0, 2: 1, 4: 1, 5: 1, 10: 1, 14: 1, 15: 2, 25: 2, 26: 3, 50: 5, 500: 50}


def test_held_out_counts(spark):
    df = spark.createDataFrame([(n,) for n in HELD_OUT], "n bigint")
    got = dict(df.select("n", SP.held_out_count(F.col("n"), 0.1).alias("k")).collect())
    assert got == HELD_OUT


@pytest.fixture(scope="module")
def uneven(spark):
    # one row per (label, i) with class sizes from the table above
    rows = []
    for label, n in enumerate(HELD_OUT):
        rows += [(label * 1000 + i, label) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, label int")


def test_split_counts_and_partition(uneven):
    s = SP.stratified_split(uneven)
    got = {r["label"]: r["k"] for r in s.groupBy("label").agg(F.count_if(F.col("split") == "test").alias("k")).collect()}
    assert got == {label: HELD_OUT[n] for label, n in enumerate(HELD_OUT)}
    assert s.count() == uneven.count()
    assert s.select("doc_id").distinct().count() == uneven.count()


def test_three_way_disjoint_cover(uneven):
    s = SP.three_way_split(uneven)
    assert s.select("doc_id").exceptAll(uneven.select("doc_id")).count() == 0
    assert uneven.select("doc_id").exceptAll(s.select("doc_id")).count() == 0
    tr = s.where("split = 'train'").select("doc_id")
    assert tr.intersect(s.where("split = 'dev'").select("doc_id")).count() == 0
    assert tr.intersect(s.where("split = 'test'").select("doc_id")).count() == 0


def test_two_level_rank_equals_row_number(spark):
    d = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", F.col("lang").alias("g"))
    ok = SP.order_key("doc_id", 42, "x")
    a = SP.exact_rank(d, ["g"], ok, "doc_id", name="r", digits=2)
    b = d.withColumn("r2", F.row_number().over(Window.partitionBy("g").orderBy(ok, "doc_id")))
    j = a.join(b, ["doc_id", "g"])
    assert j.where(F.col("r") != F.col("r2")).count() == 0
    assert j.count() == d.count()


def test_global_order_is_a_permutation(spark):
    d = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id")
    o = SP.seeded_order(d)
    r = o.agg(F.min("order_no"), F.max("order_no"), F.count_distinct("order_no")).collect()[0]
    assert tuple(r) == (1, d.count(), d.count())


def plain_split(rows, ratio=0.1, salt="test"):
    """Held-out ids by sorting every class: (label, key, place) in the seeded order."""
    import hashlib

    by = {}
    for place, (k, label) in enumerate(rows):
        text = "|".join(["42", salt] + ([] if k is None else [str(k)]))
        by.setdefault(label, []).append((hashlib.md5(text.encode()).hexdigest(), k is not None, k or 0, place))
    out = set()
    for group in by.values():
        n = len(group)
        k = 0 if n <= 1 else min(max(1, round(n * ratio)), n - 1)
        out |= {p for *_, p in sorted(group)[:k]}
    return out


def test_selection_equals_sorting(spark):
    """Null labels and keys, a key that fills a third of a class, keys on both sides of the cut, every class size."""
    rows = [(i, i % 3 if i % 7 else None) for i in range(400)]
    rows += [(1000, 1)] * 150 + [(None, 2)] * 60 + [(5, 9), (5, 9), (5, 9), (6, 10)]
    df = spark.createDataFrame([(k, g, i) for i, (k, g) in enumerate(rows)], "doc_id long, label int, place int").coalesce(1)
    for ratio in (0.1, 0.45, 0.9):
        s = SP.stratified_split(df, ratio=ratio)
        assert s.columns == [*df.columns, "split"] and s.count() == len(rows)
        assert {r["place"] for r in s.where("split = 'test'").collect()} == plain_split(rows, ratio)


def test_three_way_equals_two_splits(spark):
    df = spark.createDataFrame([(i, i % 4) for i in range(500)], "doc_id long, label int")
    s = SP.three_way_split(df)
    first = SP.stratified_split(df)
    second = SP.stratified_split(first.where("split = 'train'").drop("split"), names=("train", "dev"))
    both = second.unionByName(first.where("split = 'test'"))
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, both.collect()))


def test_split_moves_no_text(spark):
    import contextlib
    import io

    df = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").withColumn("label", F.col("source"))
    with contextlib.redirect_stdout(io.StringIO()) as out:
        SP.three_way_split(df).explain("formatted")
    plan = out.getvalue()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert plan.split("(1) Scan")[0].count("Scan parquet") == 3 and "BroadcastExchange" in plan  # the texts and two tables of cuts


def test_split_beyond_the_broadcast_bound(spark, monkeypatch):
    df = spark.createDataFrame([(i, i % 50) for i in range(600)], "doc_id long, label int")
    want = sorted(map(tuple, SP.three_way_split(df).collect()))
    monkeypatch.setattr(SP, "BROADCAST_CLASSES", 10)
    assert sorted(map(tuple, SP.three_way_split(df).collect())) == want
    assert SP.stratified_split(df.limit(0)).count() == 0
