"""Batch prediction, evaluation and model fitting.

Prediction is one row-wise projection: clean -> chunk -> pad -> encode each
chunk -> pooling -> linear head -> argmax, then a broadcast lookup of the
category name (a dimension of one row per class).  It needs no shuffle, so
the same Columns run in batch and in a stateless stream.

The default chunk encoder counts hashed tokens in numpy, and a user encoder
runs inside the row too, both on Arrow batches (``operators.encoders``); the
latter is loaded once per Python worker.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwise.functions import text as T
from chunkwise.functions.counters import WordCounter
from chunkwise.operators import encoders as EN
from chunkwise.operators import filters as FL
from chunkwise.operators import metrics as M
from chunkwise.operators import vectors as V
from chunkwise.operators.encoders import ENCODER_DIM, MakeEncoder, encode_chunks, hashed_vector  # noqa: F401

# ------------------------------------------------------------------ M9 predict

@dataclass
class ChunkModel:
    """Parameters of the chunk-pooling classifier.

    ``encoder`` names a user encoder as ``package.module:factory``;
    ``make_encoder`` gives one directly (not persisted).  Without either the
    native encoder of width ``dim`` is used.  ``counter`` names a factory of
    the function that a ``counters.WordCounter`` takes; chunks are then
    packed by its counts, with its ``joins`` (space, comma).
    """
    head_w: list[list[float]]
    head_b: list[float]
    att_w: list[list[float]] | None = None
    att_b: list[float] | None = None
    att_v: list[float] | None = None
    pooling: str = "attention"
    max_tokens: int = T.DEFAULT_MAX_TOKENS
    max_chunks: int = T.DEFAULT_MAX_CHUNKS
    dim: int = ENCODER_DIM
    encoder: str | None = None
    batch_size: int = 64
    make_encoder: MakeEncoder | None = None
    counter: str | None = None
    joins: tuple[int, int] = (0, 1)
    extra: dict = field(default_factory=dict)

    def factory(self) -> MakeEncoder | None:
        return self.make_encoder or (EN.named_factory(self.encoder) if self.encoder else None)


def default_model(n_classes: int, dim: int = ENCODER_DIM) -> ChunkModel:
    hw, hb = V.head_weights(n_classes, dim)
    aw, ab, av = V.attention_weights(dim)
    return ChunkModel(hw, hb, aw, ab, av, dim=dim)


def document_vectors(df: DataFrame, model: ChunkModel, text: str = "text", clean: bool = True,
                     out: str = "doc_vec") -> DataFrame:
    """C1 -> C7 -> C9 -> M5 -> M6/M7 for every row (no shuffle)."""
    t = T.clean_text(text) if clean else F.col(text)
    padded = T.pad_chunks(T.build_chunks(t, model.max_tokens, model.max_chunks), model.max_chunks)
    if model.counter:
        words = WordCounter(EN.named_factory(model.counter), *model.joins)
        df = T.with_chunks(FL.materialize(df, {"_clean": t}), "_clean", "_chunks", model.max_tokens, model.max_chunks, words)
        padded = T.pad_chunks(T.chunk_texts("_chunks"), model.max_chunks)

    def pool(vecs: Column, mask: Column) -> Column:
        if model.pooling == "attention":
            return V.pool_attention_rows(vecs, mask, model.att_w, model.att_b, model.att_v)
        return V.pool_mean_rows(vecs, mask)

    make = model.factory()
    if make is None:
        d = FL.materialize(df, {"_padded": padded})
        d = FL.materialize(d, {"_tokens": EN.chunk_tokens(F.col("_padded")["chunks"])}).withColumn("_vecs", EN.hashed_udf(model.dim)(F.col("_tokens")))
        mask = F.col("_padded")["chunk_mask"]
        if model.pooling != "attention":
            return d.withColumn(out, T.let(F.col("_vecs"), lambda v: pool(v, mask))).drop("_padded", "_tokens", "_vecs", "_clean", "_chunks")
        both = F.struct(F.col("_vecs").alias("x"), V.hidden_udf(model.att_w, model.att_b)(F.col("_vecs")).alias("h"))
        vec = T.let(both, lambda s: V.pool_attention_rows(s["x"], mask, model.att_w, model.att_b, model.att_v, s["h"]))
        return d.withColumn(out, vec).drop("_padded", "_tokens", "_vecs", "_clean", "_chunks")
    d = FL.materialize(df, {"_padded": padded})
    d = d.withColumn("_vecs", EN.encoder_udf(make, model.batch_size)(F.col("_padded")["chunks"]))
    return d.withColumn(out, T.let(F.col("_vecs"), lambda v: pool(v, F.col("_padded")["chunk_mask"]))).drop("_padded", "_vecs", "_clean", "_chunks")


def predict_labels(df: DataFrame, model: ChunkModel, text: str = "text", out: str = "label") -> DataFrame:
    """``df`` with the predicted class index in ``out``; every row is kept."""
    d = document_vectors(df, model, text, out="_doc_vec")
    logits = V.linear_logits(F.col("_doc_vec"), model.head_w, model.head_b)
    return d.withColumn(out, T.let(logits, V.argmax)).drop("_doc_vec")


def predict(df: DataFrame, model, categories: DataFrame | None = None, text: str = "text") -> DataFrame:
    """M9: ``label`` and ``category`` per row; empty texts are rejected first
    (D6).  ``model`` is a ``ChunkModel`` or a fitted ``ChunkClassifierModel``
    (which brings its own categories).  ``categories`` is the (label, name)
    dimension, one row per class; of several names the least is taken."""
    if not isinstance(model, ChunkModel):
        categories = categories if categories is not None else model.categories(df.sparkSession)
        model = model.chunk_model
    ok, _ = FL.reject_empty(df, text)
    d = predict_labels(ok, model, text)
    if categories is not None:
        d = d.join(F.broadcast(category_names(categories, len(model.head_b))), "label", "left")
    return d


def category_names(categories: DataFrame, n_classes: int) -> DataFrame:
    """(label, category) of the labels a head of ``n_classes`` can emit: at most that many rows."""
    return (categories.where((F.col("label") >= 0) & (F.col("label") < n_classes))
            .groupBy("label").agg(F.min("name").alias("category")))


# ------------------------------------------------------------------ M10 evaluate

@dataclass
class Evaluation:
    """Metric tables of one prediction run; ``cells`` are the counts they all derive from."""
    summary: DataFrame
    report: DataFrame
    confusion: DataFrame
    cells: DataFrame


def evaluate(df: DataFrame, model, truth: str = "label", text: str = "text", labels: DataFrame | None = None,
             names: DataFrame | None = None) -> Evaluation:
    """Predict a labelled set once and derive F8-F13 from its confusion
    counts (at most one row per pair of classes, written once).

    ``labels`` (label) is the class list, by default the indices of the head;
    ``names`` (label, name) adds class names to the report.  Empty texts are
    predicted too, as the truth counts them.
    """
    from chunkwise.session import checkpoint_dir

    spark = df.sparkSession
    model_c = model if isinstance(model, ChunkModel) else model.chunk_model
    if labels is None:
        labels = spark.range(len(model_c.head_b)).select(F.col("id").cast("int").alias("label"))
    if names is None and not isinstance(model, ChunkModel):
        names = model.categories(spark)
    p = predict_labels(df.select(F.col(truth).alias("true"), F.coalesce(F.col(text), F.lit("")).alias("text")), model_c, out="pred")
    checkpoint_dir(spark)
    cells = M.confusion_counts(p).checkpoint(eager=True)
    return Evaluation(M.summary_of(cells, labels), M.report_of(cells, labels, names), M.matrix_of(cells, labels), cells)


# ------------------------------------------------------------------ M2 SVD

def reduce_dims(weights: DataFrame, vocab: DataFrame, k: int = 16, key: str = "doc_id") -> DataFrame:
    """M2: truncated SVD (no centring) of the TF-IDF matrix; returns the
    document coordinates ``U * S`` as ``key, dim, value`` (``operators.svd``)."""
    from chunkwise.operators.svd import reduce_rows

    return reduce_rows(weights, vocab, k, key)[0]


# ------------------------------------------------------------------ M3 / M4 baselines

def tfidf_pipeline_stages(stop_words: list[str], vocab_size: int = 50000, min_df: float = 2.0,
                          max_df: float = 0.9):
    """Spark ML feature stages for the baselines: terms, stop words, 1-2
    grams, counts, IDF.  (Spark's IDF is ``ln((N+1)/(df+1))`` without the
    ``+1`` of M1; ``operators.features.tfidf`` is the exact form.)"""
    from pyspark.ml.feature import CountVectorizer, IDF, NGram, RegexTokenizer, SQLTransformer, StopWordsRemover

    return [
        RegexTokenizer(inputCol="text", outputCol="_w", pattern=r"[\p{L}\p{N}_]{2,}", gaps=False, toLowercase=True),
        StopWordsRemover(inputCol="_w", outputCol="_u", stopWords=stop_words),
        NGram(n=2, inputCol="_u", outputCol="_b"),
        SQLTransformer(statement="SELECT *, concat(_u, _b) AS _g FROM __THIS__"),
        CountVectorizer(inputCol="_g", outputCol="_tf", vocabSize=vocab_size, minDF=min_df, maxDF=max_df),
        IDF(inputCol="_tf", outputCol="features"),
    ]


def fit_tree_baseline(train: DataFrame, stop_words: list[str], num_trees: int = 50, max_depth: int = 8,
                      seed: int = 42, vocab_size: int = 50000):
    """M3: TF-IDF + random forest (multiclass natively; Spark's GBT is
    binary only)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier

    rf = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=num_trees, maxDepth=max_depth,
                                seed=seed)
    return Pipeline(stages=tfidf_pipeline_stages(stop_words, vocab_size) + [rf]).fit(train)


def fit_wordvec_baseline(train: DataFrame, dim: int = 64, seed: int = 42, min_count: int = 2,
                         partitions: int | None = None):
    """M4: averaged word vectors + multinomial logistic regression (the
    supervised word-vector shape; vectors here are trained unsupervised).

    The vectors are trained in ``partitions`` tasks (default: the session's
    parallelism), each on its share of the texts; Spark averages the vectors
    of a word over the tasks after each iteration.  The vocabulary goes to
    the driver."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import RegexTokenizer, Word2Vec

    return Pipeline(stages=[
        RegexTokenizer(inputCol="text", outputCol="_w", pattern=T.TOKEN_PATTERN, gaps=False, toLowercase=True),
        Word2Vec(inputCol="_w", outputCol="features", vectorSize=dim, minCount=min_count, seed=seed,
                 numPartitions=partitions or train.sparkSession.sparkContext.defaultParallelism),
        LogisticRegression(featuresCol="features", labelCol="label", family="multinomial", maxIter=50),
    ]).fit(train)


# ------------------------------------------------------------------ M11 fit and select

@dataclass
class Selected:
    """The head of the best grid point and what led to it."""
    model: object
    grid: list[tuple[float, float, bool]]
    reg_param: float
    dev_macro_f1: float


def select_head(train: DataFrame, dev: DataFrame, labels: DataFrame, reg_params: tuple[float, ...] = (0.0, 0.01, 0.1),
                features: str = "features", label: str = "label", max_iter: int = 50) -> Selected:
    """Fit a multinomial logistic head per grid point on ``train`` and keep
    the first one with the strictly best dev macro F1 (classes present in
    truth or prediction).  Rows without a label are left out."""
    from pyspark.ml.classification import LogisticRegression

    train, dev = train.where(F.col(label).isNotNull()), dev.where(F.col(label).isNotNull())
    best, rows = None, []
    for rp in reg_params:  # a few distributed fits; one metric row each
        m = LogisticRegression(featuresCol=features, labelCol=label, family="multinomial", regParam=rp,
                               maxIter=max_iter).fit(train)
        f1 = M.metrics_summary(scored(m, dev, label), labels).first()["macro_f1"]
        rows.append((float(rp), float(f1 or 0.0)))
        if best is None or rows[-1][1] > best[1]:
            best = (m, rows[-1][1], float(rp))
    return Selected(best[0], [(rp, f1, rp == best[2]) for rp, f1 in rows], best[2], best[1])


def scored(model, df: DataFrame, label: str = "label") -> DataFrame:
    return model.transform(df).select(F.col(label).alias("true"), F.col("prediction").cast("int").alias("pred"))


def fit_select(train: DataFrame, dev: DataFrame, test: DataFrame, labels: DataFrame,
               reg_params: tuple[float, ...] = (0.0, 0.01, 0.1), features: str = "features",
               label: str = "label", max_iter: int = 50):
    """``select_head`` on train and dev, then evaluate that model on
    ``test`` once.

    Returns ``(best_model, grid_df, test_summary_df)``; the grid rows hold
    ``reg_param, dev_macro_f1, selected``.  ``operators.stages`` has the same
    as an ``Estimator`` from texts to a model that predicts and persists.
    """
    s = select_head(train, dev, labels, reg_params, features, label, max_iter)
    grid = train.sparkSession.createDataFrame(s.grid, "reg_param double, dev_macro_f1 double, selected boolean")
    return s.model, grid, M.metrics_summary(scored(s.model, test.where(F.col(label).isNotNull()), label), labels)


def head_of(model) -> tuple[list[list[float]], list[float]]:
    """Weights and biases of a multinomial logistic model as a linear head."""
    return model.coefficientMatrix.toArray().tolist(), model.interceptVector.toArray().tolist()
