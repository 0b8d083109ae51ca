"""Prediction, encoders and stream scoring."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkwise.functions import text as T
from chunkwise.operators import models as MD
from chunkwise.operators import stages as ST
from chunkwise.plans import tables as TB
from chunkwise.sources import sinks as K
from chunkwise.streaming import scoring as SC
from tests.conftest import SF_SMALL


def test_stream_equals_batch(spark):
    model = MD.default_model(20)
    cats = TB.categories(spark, SF_SMALL)
    batch = MD.predict(TB.raw_documents(spark, SF_SMALL), model, cats).select("doc_id", "label", "category")
    stream = SC.document_stream(spark, SF_SMALL).select("doc_id", "text")
    out = spark.read.parquet(SC.run_to_table(spark, SC.score_stream(stream, model, cats, keep=["doc_id"])))
    assert out.count() == batch.count() > 0
    assert out.exceptAll(batch).count() == 0 and batch.exceptAll(out).count() == 0


def test_stream_reads_every_part(spark, tmp_path):
    docs = TB.raw_documents(spark, SF_SMALL)
    docs.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    stream = SC.document_stream(spark, str(tmp_path)).select("doc_id")
    out = spark.read.parquet(SC.run_to_table(spark, stream))
    assert out.count() == docs.count() > 0 and out.exceptAll(docs.select("doc_id")).count() == 0


def test_predict_rejects_empty(spark):
    df = spark.createDataFrame([(1, "   "), (2, "Some text. Another sentence here.")], "doc_id int, text string")
    got = MD.predict(df, MD.default_model(5)).collect()
    assert [r["doc_id"] for r in got] == [2] and 0 <= got[0]["label"] < 5


def test_hashed_vectors_unit_norm(spark):
    df = spark.createDataFrame([(["a b c", ""],)], "chunks array<string>")
    v = MD.encode_chunks(df, "chunks", "v").collect()[0]["v"]
    assert abs(sum(x * x for x in v[0]) - 1.0) < 1e-12 and sum(v[1]) == 0.0 and len(v[0]) == 64


def make_length_encoder():
    def encode(texts: np.ndarray) -> np.ndarray:
        return np.stack([[float(len(t)), float(t.count(" "))] for t in texts])
    return encode


def test_user_encoder_on_arrow_batches(spark):
    df = spark.createDataFrame([(1, ["ab cd", "", "x"]), (2, ["hello world again"])], "doc_id int, chunks array<string>")
    got = {r["doc_id"]: r["v"] for r in MD.encode_chunks(df, "chunks", "v", make_encoder=make_length_encoder,
                                                         batch_size=2).collect()}
    assert got[1] == [[5.0, 1.0], [0.0, 0.0], [1.0, 0.0]] and got[2] == [[17.0, 2.0]]


def test_user_encoder_keeps_every_row(spark):
    """Repeated and null keys, null and empty lists, null chunks: one vector list a row, in its row."""
    rows = [(1, ["a b", None]), (1, ["abc"]), (None, []), (None, None), (None, ["x"] * 7), (2, [""])]
    df = spark.createDataFrame(rows, "doc_id int, chunks array<string>").repartition(3)
    got = MD.encode_chunks(df, "chunks", "v", make_encoder=make_length_encoder, batch_size=2).collect()
    want = [(d, c, None if c is None else [[float(len(x or "")), float((x or "").count(" "))] for x in c]) for d, c in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_user_encoder_plan_has_no_exchange(spark):
    import contextlib
    import io

    df = spark.createDataFrame([(1, "Some text. Another one here.")], "doc_id int, text string")
    model = MD.default_model(3, dim=2)
    model.make_encoder = make_length_encoder
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        MD.predict(df, model).explain()
    assert "ArrowEvalPython" in plan.getvalue() and "Exchange" not in plan.getvalue() and "Join" not in plan.getvalue()


def test_wrong_encoder_shape_is_an_error(spark):
    df = spark.createDataFrame([(["a", "b"],)], "chunks array<string>")
    with pytest.raises(Exception, match="the encoder gave shape"):
        MD.encode_chunks(df, "chunks", "v", make_encoder=lambda: lambda t: np.zeros((1, 2))).collect()


def test_hashed_vector_counts_buckets(spark):
    import hashlib
    import re

    texts = ["The cat, the CAT. 17 cats", "", "é è ß x_y"]
    got = spark.createDataFrame([(texts,)], "c array<string>").select(F.transform("c", lambda c: MD.hashed_vector(c)).alias("v")).first()["v"]
    for t, v in zip(texts, got, strict=True):
        want = np.zeros(64)
        for w in re.findall(r"[A-Za-z0-9_]+|[^\sA-Za-z0-9_]", t.lower()):
            want[int(hashlib.md5(w.encode()).hexdigest()[:7], 16) % 64] += 1
        assert np.allclose(v, want / max(np.linalg.norm(want), 1e-300))


@pytest.fixture(scope="module")
def labelled(spark):
    words = [["alpha", "beta", "gamma"], ["delta", "epsilon", "zeta"], ["eta", "theta", "iota"]]
    rows = [(i, " ".join(words[i % 3][(i // 3 + j) % 3] for j in range(12)) + f". Word {i % 5} here.", i % 3) for i in range(90)]
    rows += [(900, None, 1), (901, "  ", 2), (902, "alpha beta", None)]
    return spark.createDataFrame(rows, "doc_id int, text string, label int")


@pytest.mark.parametrize("params", [{"pooling": "attention"}, {"pooling": "mean", "dim": 16},
                                    {"encoder": "tests.test_models:make_letter_encoder", "dim": 26, "batchSize": 7}])
def test_fit_save_load_predict(spark, labelled, tmp_path, params):
    """A fitted model, the one loaded from its files, one in a pipeline and a stream give equal rows."""
    from pyspark.ml import Pipeline, PipelineModel

    cats = spark.createDataFrame([(i, f"class {i}") for i in range(3)], "label int, name string")
    stage = ST.ChunkClassifier(regParams=[0.01, 0.1], maxIter=20, **params).setCategories(cats)
    model = stage.fit(labelled)
    assert model.metrics["dev_macro_f1"] > 0.9 and sum(g["selected"] for g in model.metrics["grid"]) == 1
    K.save_model(model, {"note": 1}, str(tmp_path), spark)
    loaded, meta = K.load_model(spark, str(tmp_path), {"pad_size": 512, "pooling": "none"})
    assert type(loaded) is ST.ChunkClassifierModel and loaded.uid == model.uid and loaded.chunk_model == model.chunk_model
    assert meta["pooling"] == model.get("pooling") and meta["labels"] == ["class 0", "class 1", "class 2"] and meta["pad_size"] == 512 and meta["note"] == 1
    cols = ["doc_id", "text", "label", "category"]
    want = rows_of(MD.predict(labelled.drop("label"), model).select(cols))
    assert len(want) == 91 and rows_of(MD.predict(labelled.drop("label"), loaded).select(cols)) == want
    t = loaded.transform(labelled)
    assert t.columns == [*labelled.columns, "prediction", "category"] and t.count() == 93
    assert rows_of(t.where("length(trim(text)) > 0").select("doc_id", "text", "prediction", "category")) == want
    p = Pipeline(stages=[stage]).fit(labelled)
    p.write().overwrite().save(f"{tmp_path}/pipeline")
    assert rows_of(PipelineModel.load(f"{tmp_path}/pipeline").transform(labelled)) == rows_of(p.transform(labelled))
    labelled.select("doc_id", "text").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("doc_id int, text string").parquet(f"{tmp_path}/in")
    out = spark.read.parquet(SC.run_to_table(spark, SC.score_stream(stream, loaded, keep=["doc_id", "text"])))
    assert rows_of(out.select(cols)) == want


def make_letter_encoder():
    def encode(texts: np.ndarray) -> np.ndarray:
        return np.array([[t.lower().count(chr(97 + k)) / (1 + len(t)) for k in range(26)] for t in texts])
    return encode


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_estimator_round_trip(spark, tmp_path):
    stage = ST.ChunkClassifier(splitCol="part", regParams=[0.5], maxChunks=2)
    stage.write().overwrite().save(str(tmp_path / "stage"))
    again = ST.ChunkClassifier.load(str(tmp_path / "stage"))
    assert again.get("splitCol") == "part" and again.get("regParams") == [0.5] and again.get("maxChunks") == 2


def test_unnamed_encoder_is_not_saved(spark, tmp_path):
    model = ST.ChunkClassifierModel()._with(MD.default_model(2, 4), [(0, "a"), (1, "b")], {})
    model.chunk_model.make_encoder = make_length_encoder
    with pytest.raises(ValueError, match="name the encoder"):
        model.write().save(str(tmp_path / "m"))


def test_evaluate_equals_pairs(spark, labelled):
    """Every metric of a model comes from its own predictions, blank texts counted too."""
    from chunkwise.operators import metrics as M

    model = ST.ChunkClassifier(regParams=[0.1], maxIter=5, splitCol="split").fit(
        labelled.withColumn("split", F.when(F.col("doc_id") % 4 == 0, "dev").otherwise("train")))
    known = labelled.where("label is not null")
    e = MD.evaluate(known, model)
    pairs = model.transform(known).select(F.col("label").alias("true"), F.col("prediction").alias("pred"))
    classes = spark.range(3).select(F.col("id").cast("int").alias("label"))
    assert e.summary.first() == M.metrics_summary(pairs, classes).first() and e.summary.first()["n"] == 92
    assert rows_of(e.confusion) == rows_of(M.confusion_matrix(pairs, classes))
    assert {r["name"] for r in e.report.collect()} == {"0", "1", "2"}


def test_metrics_count_predictions_outside_the_list(spark):
    from chunkwise.operators import metrics as M

    pairs = spark.createDataFrame([(0, 0), (1, 1), (0, 0), (1, 7)], "true int, pred int")
    labels = spark.createDataFrame([(0,), (1,)], "label int")
    s = M.metrics_summary(pairs, labels).first()
    assert s["n"] == 4 and s["accuracy"] == 0.75
    assert {r["label"]: r["support"] for r in M.classification_report(pairs, labels).collect()} == {0: 2, 1: 2}


def test_pad_and_encode_shapes(spark):
    df = TB.labelled_documents(spark, SF_SMALL).limit(20)
    d = df.select(T.pad_chunks(T.build_chunks("text"), 4).alias("p"))
    e = MD.encode_chunks(d.select(F.col("p")["chunks"].alias("c")), "c", "v")
    assert all(len(r["v"]) == 4 and all(len(x) == 64 for x in r["v"]) for r in e.collect())


def test_queries_take_the_operators_defaults():
    import inspect

    from chunkwise.operators import features as FE
    from chunkwise.plans import more_queries as Q

    assert inspect.signature(FE.tfidf).parameters["max_features"].default == Q.TFIDF_FEATURES
    assert inspect.signature(FE.build_vocab).parameters["size"].default == Q.VOCAB_SIZE
    assert "num_trees" not in inspect.getsource(Q.q_tree_baseline)


def test_word_vectors_train_in_partitions(spark):
    df = spark.createDataFrame([(f"alpha beta gamma {w} delta", i % 2) for i, w in enumerate(["one", "two"] * 20)], "text string, label int")
    stage = MD.fit_wordvec_baseline(df, dim=4).stages[1]
    assert stage.getNumPartitions() == spark.sparkContext.defaultParallelism > 1
