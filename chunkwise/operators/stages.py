"""The chunk-pooling classifier as Spark ML stages: fit, save, load, predict.

``ChunkClassifier`` is an ``Estimator`` from (text, label) rows to a
``ChunkClassifierModel``; the model is a ``Transformer`` whose Columns are
those of batch and stream prediction, and both go into a ``Pipeline``.
``save`` writes the params and metrics as the stage's metadata and the
weights and class names as Parquet, one row a weight row and a class, so a
model loaded elsewhere gives the same rows.

A user encoder is named as ``package.module:factory``, which is what is
saved; the module must be importable where the model is used.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwise.functions import text as T
from chunkwise.operators import filters as FL
from chunkwise.operators import metrics as M
from chunkwise.operators import models as MD
from chunkwise.operators import splits as SP
from chunkwise.operators import vectors as V
from chunkwise.session import checkpoint_dir

CLASSES = "label int, name string"
WEIGHTS = "part string, row int, weights array<double>"


class _ChunkParams(Params):
    """Params that the estimator and its model share."""
    textCol = Param(Params._dummy(), "textCol", "column of texts", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "column of class indices 0 .. n-1", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "column of the predicted class index", TypeConverters.toString)
    categoryCol = Param(Params._dummy(), "categoryCol", "column of the predicted class's name", TypeConverters.toString)
    pooling = Param(Params._dummy(), "pooling", "attention or mean", TypeConverters.toString)
    maxTokens = Param(Params._dummy(), "maxTokens", "tokens of a chunk", TypeConverters.toInt)
    maxChunks = Param(Params._dummy(), "maxChunks", "chunks of a text", TypeConverters.toInt)
    dim = Param(Params._dummy(), "dim", "width of the chunk vectors", TypeConverters.toInt)
    encoder = Param(Params._dummy(), "encoder", "user encoder as package.module:factory; empty for the native one", TypeConverters.toString)
    counter = Param(Params._dummy(), "counter", "token counter of the chunks as package.module:factory; empty for the native one", TypeConverters.toString)
    joins = Param(Params._dummy(), "joins", "tokens that the counter adds for a space and for a comma between texts", TypeConverters.toListInt)
    batchSize = Param(Params._dummy(), "batchSize", "chunks given to a user encoder at a time", TypeConverters.toInt)

    def _defaults(self) -> None:
        self._setDefault(textCol="text", labelCol="label", predictionCol="prediction", categoryCol="category", pooling="attention",
                         maxTokens=T.DEFAULT_MAX_TOKENS, maxChunks=T.DEFAULT_MAX_CHUNKS, dim=MD.ENCODER_DIM, encoder="", batchSize=64,
                         counter="", joins=[0, 1])

    def get(self, name: str):
        return self.getOrDefault(self.getParam(name))


class ChunkClassifier(Estimator, _ChunkParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the linear head over pooled chunk vectors.

    ``splitCol`` names a column with ``train`` and ``dev`` rows (others are
    not used); where it is empty, dev rows are drawn per class by the seeded
    split of ``keyCol``.  The head of the grid's best dev macro F1 is kept.
    The attention scorer is the library's rule-made one, as the gradient
    trainer is not part of it.  Rows without a label or with a blank text
    are not learnt from.  The pooled vectors are written once (the fits read
    them many times).
    """
    splitCol = Param(Params._dummy(), "splitCol", "column with train and dev; empty: drawn by keyCol", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "row key of the drawn dev split", TypeConverters.toString)
    devRatio = Param(Params._dummy(), "devRatio", "share of dev rows drawn", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the drawn split", TypeConverters.toInt)
    regParams = Param(Params._dummy(), "regParams", "grid of regularisation", TypeConverters.toListFloat)
    maxIter = Param(Params._dummy(), "maxIter", "iterations of a fit", TypeConverters.toInt)

    @keyword_only
    def __init__(self, **params):
        super().__init__()
        self._defaults()
        self._setDefault(splitCol="", keyCol="doc_id", devRatio=SP.DEV_RATIO, seed=SP.SEED, regParams=[0.0, 0.01, 0.1], maxIter=50)
        self._set(**self._input_kwargs)
        self.class_names: DataFrame | None = None

    def setCategories(self, categories: DataFrame) -> ChunkClassifier:
        """(label, name), one row per class; the fitted model keeps it.  Not saved with the unfitted stage."""
        self.class_names = categories
        return self

    def _fit(self, df: DataFrame) -> ChunkClassifierModel:
        from pyspark.ml.functions import array_to_vector

        if self.get("pooling") not in ("attention", "mean"):
            raise ValueError("pooling is attention or mean")
        text, label, split = self.get("textCol"), self.get("labelCol"), self.get("splitCol")
        spark = df.sparkSession
        checkpoint_dir(spark)
        ok, _ = FL.reject_empty(df.where(F.col(label).isNotNull()), text)
        named = [F.col(text).alias("text"), F.col(label).cast("int").alias("label")]
        ok = ok.select(*named, F.col(split).alias("split")) if split else ok.select(*named, F.col(self.get("keyCol")).alias("key"))
        model = ChunkClassifierModel()
        self._copyValues(model)
        vectors = MD.document_vectors(ok, model.parameters([], [], width=self.get("dim")), out="features").drop("text")
        vectors = vectors.withColumn("features", array_to_vector("features")).checkpoint(eager=True)
        if not split:
            vectors = SP.stratified_split(vectors, "label", self.get("devRatio"), self.get("seed"), "key", ("train", "dev"))
        labels = vectors.select("label").distinct()
        best = MD.select_head(vectors.where("split = 'train'"), vectors.where("split = 'dev'"), labels,
                              tuple(self.get("regParams")), max_iter=self.get("maxIter"))
        head_w, head_b = MD.head_of(best.model)
        names = self.class_names if self.class_names is not None else spark.range(len(head_b)).select(
            F.col("id").cast("int").alias("label"), F.col("id").cast("string").alias("name"))
        classes = MD.category_names(names, len(head_b)).orderBy("label").collect()  # at most one row a class
        metrics = {"reg_param": best.reg_param, "dev_macro_f1": best.dev_macro_f1,
                   "grid": [{"reg_param": r, "dev_macro_f1": f, "selected": s} for r, f, s in best.grid]}
        return model._with(model.parameters(head_w, head_b, width=len(head_w[0])), [(r["label"], r["category"]) for r in classes], metrics)


class ChunkClassifierModel(Model, _ChunkParams, MLReadable, MLWritable):
    """Fitted classifier.  ``transform`` keeps every row and adds the
    prediction and the category's name; blank and null texts are predicted
    from an empty chunk.  ``operators.models.predict`` rejects them first
    and names its columns as the reference does."""

    def __init__(self):
        super().__init__()
        self._defaults()
        self.chunk_model: MD.ChunkModel | None = None
        self.classes: list[tuple[int, str]] = []
        self.metrics: dict = {}

    def _with(self, chunk_model: MD.ChunkModel, classes: list[tuple[int, str]], metrics: dict) -> ChunkClassifierModel:
        self.chunk_model, self.classes, self.metrics = chunk_model, classes, metrics
        return self

    def copy(self, extra=None) -> ChunkClassifierModel:
        return super().copy(extra)._with(self.chunk_model, self.classes, self.metrics)

    def parameters(self, head_w: list[list[float]], head_b: list[float], width: int, attention: tuple | None = None) -> MD.ChunkModel:
        """A ``ChunkModel`` with this stage's params; the attention scorer is the rule-made one unless given."""
        w, b, v = (None, None, None) if self.get("pooling") == "mean" else attention or V.attention_weights(width)
        return MD.ChunkModel(head_w, head_b, w, b, v, self.get("pooling"), self.get("maxTokens"), self.get("maxChunks"), width,
                             self.get("encoder") or None, self.get("batchSize"), counter=self.get("counter") or None,
                             joins=tuple(self.get("joins")))

    def categories(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.classes, CLASSES)

    def metadata(self) -> dict:
        """What the reference stores beside a model: class list, limits, pooling and dev metrics."""
        return {"labels": [name for _, name in self.classes], "max_tokens": self.get("maxTokens"), "max_chunks": self.get("maxChunks"),
                "pooling": self.get("pooling"), "encoder": self.get("encoder"), **{k: v for k, v in self.metrics.items() if k != "grid"}}

    def _transform(self, df: DataFrame) -> DataFrame:
        text, out = self.get("textCol"), self.get("predictionCol")
        d = MD.predict_labels(df.withColumn("_text", F.coalesce(F.col(text), F.lit(""))), self.chunk_model, "_text", out).drop("_text")
        names = self.categories(df.sparkSession).select(F.col("label").alias(out), F.col("name").alias(self.get("categoryCol")))
        return d.join(F.broadcast(names), out, "left").select(*df.columns, out, self.get("categoryCol"))  # one row a class

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    def __init__(self, model: ChunkClassifierModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m, c = self.model, self.model.chunk_model
        if c.make_encoder is not None and not c.encoder:
            raise ValueError("name the encoder as package.module:factory to save the model")
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, {"metrics": m.metrics})
        parts = {"head_w": c.head_w, "head_b": [c.head_b]}
        if c.pooling == "attention":
            parts |= {"att_w": c.att_w, "att_b": [c.att_b], "att_v": [c.att_v]}
        rows = [(part, k, [float(x) for x in row]) for part, matrix in parts.items() for k, row in enumerate(matrix)]
        self.sparkSession.createDataFrame(rows, WEIGHTS).coalesce(1).write.parquet(f"{path}/weights")
        self.sparkSession.createDataFrame(m.classes, CLASSES).coalesce(1).write.parquet(f"{path}/classes")


class _ModelReader(MLReader):
    def load(self, path: str) -> ChunkClassifierModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = ChunkClassifierModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        part: dict[str, list] = {}
        for r in spark.read.schema(WEIGHTS).parquet(f"{path}/weights").orderBy("part", "row").collect():  # the model's own rows
            part.setdefault(r["part"], []).append(list(r["weights"]))
        attention = (part["att_w"], part["att_b"][0], part["att_v"][0]) if "att_w" in part else None
        classes = spark.read.schema(CLASSES).parquet(f"{path}/classes").orderBy("label").collect()
        chunk = model.parameters(part["head_w"], part["head_b"][0], len(part["head_w"][0]), attention)
        return model._with(chunk, [(r["label"], r["name"]) for r in classes], metadata["metrics"])
