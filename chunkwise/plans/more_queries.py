"""Vector, metric and metric-log queries (registered on import).

Bindings: chunk vectors from ``embeddings`` (``doc = vec_id div 4``), a
deterministic linear head and attention scorer whose weights follow fixed
rules (``operators.vectors.head_weights`` / ``attention_weights``), truth
``embeddings.label``; metric logs from ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwise.operators import metrics as M
from chunkwise.operators import training as TR
from chunkwise.operators import vectors as V
from chunkwise.plans import tables as TB
from chunkwise.plans.queries import query, r6

N_CLASSES = 10
WIDTH = 64


def _head():
    return V.head_weights(N_CLASSES, WIDTH)


def scored_chunks(spark, sf) -> DataFrame:
    w, b = _head()
    v = TB.chunk_vectors(spark, sf)
    return v.withColumn("logits", V.linear_logits(F.col("embedding"), w, b)) \
        .withColumn("pred", V.argmax(F.col("logits")))


def pairs(spark, sf) -> DataFrame:
    return scored_chunks(spark, sf).select("vec_id", F.col("label").alias("true"), "pred")


def label_list(spark, sf) -> DataFrame:
    return TB.table(spark, sf, "embeddings").select("label").distinct()


@query("linear_logits")
def q_linear_logits(spark, sf):
    s = scored_chunks(spark, sf)
    o = s.select("vec_id", F.posexplode("logits").alias("class", "logit"))
    return o.select("vec_id", "class", r6(F.col("logit")).alias("logit"))


@query("argmax")
def q_argmax(spark, sf):
    return scored_chunks(spark, sf).select("vec_id", "pred")


@query("pool_mean")
def q_pool_mean(spark, sf):
    p = V.pool_mean(TB.chunk_vectors(spark, sf))
    return V.vector_long(p, ["doc"], "doc_vec")


@query("pool_attention")
def q_pool_attention(spark, sf):
    w, b, v = V.attention_weights(WIDTH)
    p = V.pool_attention(TB.chunk_vectors(spark, sf), w, b, v)
    return V.vector_long(p, ["doc"], "doc_vec")


@query("confusion_matrix")
def q_confusion_matrix(spark, sf):
    return M.confusion_matrix(pairs(spark, sf), label_list(spark, sf))


@query("classification_report")
def q_classification_report(spark, sf):
    r = M.classification_report(pairs(spark, sf), label_list(spark, sf))
    return r.select("label", r6(F.col("precision")).alias("precision"), r6(F.col("recall")).alias("recall"),
                    r6(F.col("f1")).alias("f1"), "support")


SUMMARY_COLS = ["accuracy", "micro_precision", "micro_recall", "micro_f1", "macro_precision", "macro_recall",
                "macro_f1", "macro_all_precision", "macro_all_recall", "macro_all_f1", "weighted_precision",
                "weighted_recall", "weighted_f1"]


@query("metrics_summary")
def q_metrics_summary(spark, sf):
    s = M.metrics_summary(pairs(spark, sf), label_list(spark, sf))
    return s.select("n", *[r6(F.col(c)).alias(c) for c in SUMMARY_COLS])


@query("cross_entropy")
def q_cross_entropy(spark, sf):
    c = M.cross_entropy(scored_chunks(spark, sf))
    return c.select("n", r6(F.col("loss")).alias("loss"))


@query("top_confusions")
def q_top_confusions(spark, sf):
    return M.top_confusions(M.confusion_matrix(pairs(spark, sf), label_list(spark, sf)), 5)


def doc_predictions(spark, sf) -> DataFrame:
    """Attention-pooled document vectors -> linear head -> argmax; truth is
    the label of the document's first chunk."""
    w, b, v = V.attention_weights(WIDTH)
    hw, hb = _head()
    cv = TB.chunk_vectors(spark, sf)
    docs = V.pool_attention(cv, w, b, v)
    truth = cv.where(F.col("chunk_no") == 0).select("doc", F.col("label").alias("true"))
    pred = docs.select("doc", V.argmax(V.linear_logits(F.col("doc_vec"), hw, hb)).alias("pred"))
    return truth.join(pred, "doc")


@query("evaluate")
def q_evaluate(spark, sf):
    s = M.metrics_summary(doc_predictions(spark, sf), label_list(spark, sf))
    return s.select("n", r6(F.col("accuracy")).alias("accuracy"), r6(F.col("macro_f1")).alias("macro_f1"),
                    r6(F.col("weighted_f1")).alias("weighted_f1"))


@query("early_stop")
def q_early_stop(spark, sf):
    e = TR.early_stop(TB.metric_log(spark, sf), "run", ["ts", "event_id"], "metric", patience=2)
    return e.select("run", "n_steps", "best_step", r6(F.col("best_metric")).alias("best_metric"), "stop_step")


@query("running_mean")
def q_running_mean(spark, sf):
    m = TR.running_mean(TB.metric_log(spark, sf), "run", ["ts", "event_id"], "metric", every=10)
    return m.select("run", "step", r6(F.col("running_mean")).alias("running_mean"))


# ---------------------------------------------------------------- features (2.10)

from chunkwise.functions import text as T  # noqa: E402
from chunkwise.operators import features as FE  # noqa: E402
from chunkwise.plans.queries import kept_documents  # noqa: E402

# Fixed parameter of the registered TF-IDF query: one explicit stop-word
# list, used identically by the oracle.
STOP_WORDS = ["and", "are", "as", "at", "be", "by", "de", "des", "du", "en", "et", "for", "from", "in", "is",
              "it", "la", "le", "les", "of", "on", "or", "the", "this", "to", "was", "with"]
TFIDF_FEATURES = 50_000  # the operators' defaults
VOCAB_SIZE = 30_000


@query("tfidf")
def q_tfidf(spark, sf):
    w, _ = FE.tfidf(TB.labelled_documents(spark, sf), ngram_max=2, max_features=TFIDF_FEATURES, min_df=2,
                    max_df=0.9, stop_words=STOP_WORDS)
    return w.select("doc_id", "term", r6(F.col("weight")).alias("weight"))


@query("build_vocab")
def q_build_vocab(spark, sf):
    return FE.build_vocab(kept_documents(spark, sf), size=VOCAB_SIZE)


@query("encode_ids")
def q_encode_ids(spark, sf):
    # Both the vocabulary and the chunks need the cleaned, filtered documents:
    # every text is cleaned and filtered once.
    docs = written(kept_documents(spark, sf).select("doc_id", "text"), "kept-texts")
    vocab = FE.build_vocab(docs, size=VOCAB_SIZE)
    ch = T.with_chunks(docs, "text", "ch").select("doc_id", F.posexplode("ch").alias("chunk_no", "c"))
    ch = ch.select("doc_id", "chunk_no", F.col("c")["chunk"].alias("chunk"))
    e = FE.encode_ids(ch, vocab, "chunk", ["doc_id", "chunk_no"])
    return e.select("doc_id", "chunk_no", F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_real"),
                    F.array_join("input_ids", " ").alias("ids"))


@query("rebalance")
def q_rebalance(spark, sf):
    lab = TB.table(spark, sf, "labels").select("doc_id", (F.col("quality") * 2 + F.col("toxic")).alias("label"))
    return FE.rebalance(lab).select("doc_id", "label", "copy_no")


# ---------------------------------------------------------------- models and stream (rows-only)

from chunkwise.operators import models as MD  # noqa: E402
from chunkwise.operators import boosting as BT  # noqa: E402
from chunkwise.operators import splits as SP  # noqa: E402
from chunkwise.operators import wordvec as WV  # noqa: E402
from chunkwise.operators.store import written  # noqa: E402
from chunkwise.streaming import scoring as SC  # noqa: E402

DOC_CLASSES = 20


@query("encode_chunks")
def q_encode_chunks(spark, sf):
    d = T.with_chunks(kept_documents(spark, sf), "text", "ch")
    d = d.select("doc_id", T.pad_chunks(T.chunk_texts("ch"), 4)["chunks"].alias("chunks"))
    e = MD.encode_chunks(d, "chunks", "vecs")
    o = e.select("doc_id", F.posexplode("vecs").alias("chunk_no", "v")).select("doc_id", "chunk_no", F.posexplode("v").alias("dim", "value"))
    return o.where("value > 0").withColumn("value", r6(F.col("value")))


@query("predict")
def q_predict(spark, sf):
    docs = TB.raw_documents(spark, sf)
    p = MD.predict(docs, MD.default_model(DOC_CLASSES), TB.categories(spark, sf))
    return p.select("doc_id", "label", "category")


@query("reduce_dims")
def q_reduce_dims(spark, sf):
    w, vocab = FE.tfidf(TB.labelled_documents(spark, sf), ngram_max=2, max_features=TFIDF_FEATURES, min_df=2,
                        max_df=0.9, stop_words=STOP_WORDS)
    return MD.reduce_dims(w, vocab, k=16)


def _split_docs(spark, sf):
    """Three-way split of the kept documents, materialised once in the
    shared checkpoint folder: model fitting scans it many times."""
    return written(SP.three_way_split(written(kept_documents(spark, sf), "kept-documents")), "split-documents")


@query("tree_baseline")
def q_tree_baseline(spark, sf):
    s = _split_docs(spark, sf)
    m = BT.BoostedTrees(predictionCol="pred", stopWords=STOP_WORDS).fit(s.where("split = 'train'"))
    return m.transform(s.where("split = 'test'")).select("doc_id", "label", "pred")


@query("wordvec_baseline")
def q_wordvec_baseline(spark, sf):
    s = _split_docs(spark, sf)
    m = WV.SupervisedWordVectors(predictionCol="pred").fit(s.where("split = 'train'"))
    return m.transform(s.where("split = 'test'")).select("doc_id", "label", "pred")


@query("fit_select")
def q_fit_select(spark, sf):
    from pyspark.ml.functions import array_to_vector

    s = MD.document_vectors(_split_docs(spark, sf), MD.default_model(DOC_CLASSES), clean=False)
    s = s.select("doc_id", "label", "split", array_to_vector("doc_vec").alias("features")).checkpoint(eager=True)
    labels = s.select("label").distinct()
    _, grid, test = MD.fit_select(s.where("split = 'train'"), s.where("split = 'dev'"), s.where("split = 'test'"),
                                  labels)
    once = test.first()  # one row; the test set is scored once
    return grid.select("*", *[F.when(F.col("selected"), F.lit(once[c])).alias(f"test_{c}") for c in ("macro_f1", "accuracy")])


@query("score_stream")
def q_score_stream(spark, sf):
    stream = SC.document_stream(spark, sf).select("doc_id", "text")
    scored, _ = SC.score_to_table(spark, stream, MD.default_model(DOC_CLASSES), TB.categories(spark, sf))
    return scored.select("doc_id", "label", "category")
