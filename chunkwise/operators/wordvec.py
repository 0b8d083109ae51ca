"""M4: supervised averaged word vectors, trained over partitions.

A text is the mean of its words' vectors (words and word pairs, hashed into
a fixed number of buckets, so no vocabulary is built); a linear layer over
it gives the classes, and both are learnt together by gradient steps on the
cross entropy.  In each epoch every task takes the current parameters,
learns from its own rows in batches, and gives its parameters weighted by
its rows; they are averaged in blocks of buckets.  What travels is bounded
by buckets x width, whatever the number of documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwise.functions import text as T
from chunkwise.operators.filters import materialize
from chunkwise.operators.store import written

BLOCK = 1024  # buckets that are averaged together
SHORT = 8  # rows of a run that is added together with others of its length
PIECE = 1 << 15  # ids whose vectors are held at a time


def bucket_ids(text: Column, buckets: int, pairs: bool = True) -> Column:
    """Bucket of each lower-cased token and, with ``pairs``, of each two adjacent ones."""
    tokens = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(T.TOKEN_JAVA), 0)

    def ids(t: Column) -> Column:
        one = F.transform(t, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))
        if not pairs:
            return one
        n = F.greatest(F.size(t) - 1, F.lit(0))
        two = F.zip_with(F.slice(t, F.lit(1), n), F.slice(t, F.lit(2), n), lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets)).cast("int"))
        return F.concat(one, two)

    return T.let(tokens, ids)


def groups(sizes: np.ndarray, piece: int) -> list[np.ndarray]:
    """Places of ``sizes`` in runs that add up to ``piece`` or little more; a larger one is a run of its own."""
    long = sizes > piece
    cut = (np.diff(np.cumsum(sizes) // piece) > 0) | long[1:] | long[:-1]
    return np.split(np.arange(len(sizes)), np.flatnonzero(cut) + 1) if len(sizes) else []


def means(ids: list[np.ndarray], vectors: np.ndarray, piece: int = PIECE) -> np.ndarray:
    """Mean vector of each row; a row without ids is zero.  The vectors of
    about ``piece`` ids are held at a time, whatever the number of rows."""
    sizes = np.array([len(x) for x in ids], np.int64)
    out = np.zeros((len(ids), vectors.shape[1]), np.float32)
    full = np.flatnonzero(sizes)
    for rows in (full[g] for g in groups(sizes[full], piece)):
        if len(rows) > 1 or sizes[rows[0]] <= piece:
            flat = np.concatenate([ids[r] for r in rows]).astype(np.int64)
            total = np.add.reduceat(vectors[flat], np.r_[0, np.cumsum(sizes[rows])[:-1]], axis=0)
        else:  # a long row: each piece goes on from the sum before it
            total = np.zeros((0, vectors.shape[1]), vectors.dtype)
            for k in range(0, sizes[rows[0]], piece):
                total = np.add.reduceat(np.concatenate([total, vectors[ids[rows[0]][k:k + piece]]]), [0], axis=0)
        out[rows] = total / sizes[rows, None]
    return out


def run_sums(x: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of the runs of rows that start there and hold n each, to the same bits as ``reduceat``; short runs of one length are added together."""
    out = np.empty((len(start), x.shape[1]), x.dtype)
    for k in range(1, SHORT + 1):
        at = np.flatnonzero(n == k)
        out[at] = x[start[at]]
        if k > 1:  # the rows after the first are added up first, as reduceat does
            rest = x[start[at] + 1]
            for i in range(2, k):
                rest += x[start[at] + i]
            out[at] += rest
    at = np.flatnonzero(n > SHORT)
    for i, a, b in zip(at.tolist(), start[at].tolist(), n[at].tolist(), strict=True):
        out[i] = np.add.reduceat(x[a:a + b], [0], axis=0)[0]
    return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def learn(ids: list[np.ndarray], labels: np.ndarray, vectors: np.ndarray, head: np.ndarray, rate: float) -> None:
    """One gradient step for each row of a batch, taken together; parameters are changed in place."""
    x, sizes = means(ids, vectors), np.array([len(i) for i in ids], np.int64)
    p = softmax(x @ head.T)
    p[np.arange(len(labels)), labels] -= 1
    grad = (p @ head) / np.maximum(1, sizes)[:, None]
    head -= rate * (p.T @ x)
    if sizes.sum():
        flat, row = np.concatenate(ids), np.repeat(np.arange(len(ids)), sizes)
        order = np.argsort(flat.astype(np.uint16) if len(vectors) <= 1 << 16 else flat, kind="stable")
        flat = flat[order]
        start = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
        hit, n = flat[start], np.diff(np.r_[start, len(flat)])
        for g in groups(n, PIECE):
            at = row[order[start[g[0]]:start[g[-1]] + n[g[-1]]]]
            vectors[hit[g]] -= rate * run_sums(grad[at], start[g] - start[g[0]], n[g]).astype(np.float32)


class _Params(Params):
    textCol = Param(Params._dummy(), "textCol", "column of texts", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "column of class indices 0 .. n-1", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "column of the predicted class index", TypeConverters.toString)
    buckets = Param(Params._dummy(), "buckets", "number of word buckets", TypeConverters.toInt)
    dim = Param(Params._dummy(), "dim", "width of the vectors", TypeConverters.toInt)
    wordPairs = Param(Params._dummy(), "wordPairs", "whether adjacent words count as words of their own", TypeConverters.toBoolean)

    def _defaults(self) -> None:
        self._setDefault(textCol="text", labelCol="label", predictionCol="prediction", buckets=1 << 15, dim=64, wordPairs=True)

    def get(self, name: str):
        return self.getOrDefault(self.getParam(name))


class SupervisedWordVectors(Estimator, _Params, DefaultParamsReadable, DefaultParamsWritable):
    """Fits vectors and classes together.  Rows without a label are left out;
    an empty text teaches the classes nothing, as its mean is zero."""
    epochs = Param(Params._dummy(), "epochs", "passes over the rows", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "first learning rate; it falls linearly to zero", TypeConverters.toFloat)
    batch = Param(Params._dummy(), "batch", "rows of a gradient step", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the first vectors and the row order", TypeConverters.toInt)
    tasks = Param(Params._dummy(), "tasks", "tasks of an epoch; 0: the session's parallelism", TypeConverters.toInt)

    @keyword_only
    def __init__(self, **params):
        super().__init__()
        self._defaults()
        self._setDefault(epochs=8, rate=0.5, batch=16, seed=42, tasks=0)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> SupervisedWordVectorsModel:
        spark, rate, batch, seed = df.sparkSession, self.get("rate"), self.get("batch"), self.get("seed")
        buckets, dim, epochs = self.get("buckets"), self.get("dim"), self.get("epochs")
        rows = df.where(F.col(self.get("labelCol")).isNotNull()).select(
            bucket_ids(F.col(self.get("textCol")), buckets, self.get("wordPairs")).alias("ids"), F.col(self.get("labelCol")).cast("int").alias("label"))
        tasks = self.get("tasks") or spark.sparkContext.defaultParallelism
        # hashed rows in an order of their own, so that every task sees all classes; texts are not shuffled
        rows = written(rows.repartition(tasks, F.xxhash64("ids", F.lit(seed))), "bucket-rows")
        classes = (rows.agg(F.max("label")).first()[0] or 0) + 1
        rng = np.random.default_rng(seed)
        vectors = (rng.random((buckets, dim), np.float32) - 0.5) / dim
        head = np.zeros((classes, dim), np.float32)
        for epoch in range(epochs):
            state = spark.sparkContext.broadcast((vectors, head))  # buckets x width
            now, end = rate * (1 - epoch / epochs), rate * (1 - (epoch + 1) / epochs)

            def task(frames: Iterator[pd.DataFrame], state=state, now=now, end=end) -> Iterator[pd.DataFrame]:
                v, h = (x.copy() for x in state.value)
                n = 0
                for f in frames:
                    for a in range(0, len(f), batch):
                        part = f.iloc[a:a + batch]
                        learn(part["ids"].tolist(), part["label"].to_numpy(), v, h, now + (end - now) * a / len(f))
                    n += len(f)
                if n:
                    for b in range(0, buckets, BLOCK):
                        yield pd.DataFrame({"block": [b], "n": [n], "m": [(v[b:b + BLOCK] * n).astype(np.float64).tobytes()]})
                    yield pd.DataFrame({"block": [-1], "n": [n], "m": [(h * n).astype(np.float64).tobytes()]})

            def add(g: pd.DataFrame) -> pd.DataFrame:
                return pd.DataFrame({"block": [g["block"].iat[0]], "n": [g["n"].sum()], "m": [sum(np.frombuffer(b) for b in g["m"]).tobytes()]})

            kind = "block int, n long, m binary"
            part = rows.mapInPandas(task, kind).groupBy("block", F.pmod(F.xxhash64("m"), F.lit(16)).alias("salt")).applyInPandas(add, kind)
            for r in part.groupBy("block").applyInPandas(add, kind).collect():  # the parameters, once
                mean = (np.frombuffer(r["m"]) / r["n"]).astype(np.float32).reshape(-1, dim)
                if r["block"] < 0:
                    head = mean
                else:
                    vectors[r["block"]:r["block"] + len(mean)] = mean
            state.destroy()
        model = SupervisedWordVectorsModel()
        self._copyValues(model)
        return model._with(vectors, head)


class SupervisedWordVectorsModel(Model, _Params, MLReadable, MLWritable):
    """Vectors and classes; ``transform`` adds the prediction to every row
    (a text without words gets the class of a zero vector)."""

    def __init__(self):
        super().__init__()
        self._defaults()
        self.vectors = self.head = np.zeros((0, 0), np.float32)

    def _with(self, vectors: np.ndarray, head: np.ndarray) -> SupervisedWordVectorsModel:
        self.vectors, self.head = vectors, head
        return self

    def copy(self, extra=None) -> SupervisedWordVectorsModel:
        return super().copy(extra)._with(self.vectors, self.head)

    def _transform(self, df: DataFrame) -> DataFrame:
        state = df.sparkSession.sparkContext.broadcast((self.vectors, self.head))

        @F.pandas_udf("int")
        def classify(ids: pd.Series) -> pd.Series:
            v, h = state.value
            return pd.Series((means(ids.tolist(), v) @ h.T).argmax(axis=1).astype(np.int32))

        ids = bucket_ids(F.col(self.get("textCol")), self.get("buckets"), self.get("wordPairs"))
        d = materialize(df, {"_ids": ids})  # so that a filter above leaves them where they are
        return d.withColumn(self.get("predictionCol"), classify("_ids")).drop("_ids")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: SupervisedWordVectorsModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, {"shapes": [list(m.vectors.shape), list(m.head.shape)]})
        rows = [("vectors", b, m.vectors[b:b + BLOCK].astype(np.float32).tobytes()) for b in range(0, len(m.vectors), BLOCK)]
        rows.append(("head", 0, m.head.astype(np.float32).tobytes()))
        self.sparkSession.createDataFrame(rows, "part string, block int, m binary").coalesce(1).write.parquet(f"{path}/weights")


class _Reader(MLReader):
    def load(self, path: str) -> SupervisedWordVectorsModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = SupervisedWordVectorsModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        parts = {"vectors": b"", "head": b""}
        for r in spark.read.parquet(f"{path}/weights").orderBy("part", "block").collect():  # the model's own blocks
            parts[r["part"]] += bytes(r["m"])
        v, h = (np.frombuffer(parts[k], np.float32).reshape(s) for k, s in zip(("vectors", "head"), metadata["shapes"], strict=True))
        return model._with(v, h)
