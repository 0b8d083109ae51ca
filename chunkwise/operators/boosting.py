"""M3: gradient-boosted multiclass trees over TF-IDF features.

Each round adds one tree a class, fitted to the gradients of the softmax
cross entropy.  Weights are cut into quantile bins (0 where a term is
absent).  For each level of a round, every task sums gradients and second
derivatives per (class, node, term, bin) over its rows in numpy, the sums
are added up per class, and the best splits are chosen from them.  What
travels is bounded by classes x nodes x features x bins; rows stay in their
tasks, and no pass depends on the one before but through the trees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwise.operators import features as FE
from chunkwise.operators.filters import materialize
from chunkwise.operators.store import written

SLICE = 512  # rows whose features are held densely at a time
LEAST_HESSIAN = 1e-3
NONE = 255  # cut of a node that is not split: no bin is above it
TERMS = "term string, idf double, edges array<double>"
TREES = "round int, class int, term array<int>, cut array<int>, leaf array<double>"


class Booster:
    """Terms, bin edges and trees; tree arrays are (rounds, classes, nodes)."""

    def __init__(self, terms: list[str], idf: np.ndarray, edges: np.ndarray, base: np.ndarray, depth: int):
        self.terms, self.idf, self.edges, self.base, self.depth = terms, idf, edges, base, depth
        inner, k = 2**depth - 1, len(base)
        self.term, self.cut = np.zeros((0, k, inner), np.int64), np.zeros((0, k, inner), np.int64)
        self.leaf = np.zeros((0, k, 2**depth))

    def known(self, counts: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term, weight) of the known terms of a batch of count lists, without an object a term."""
        at = self.__dict__.setdefault("_at", pa.array(self.terms, pa.string()))
        flat = counts.flatten()
        i = pc.index_in(flat.field("term"), value_set=at)
        tf = flat.field("tf").to_numpy(zero_copy_only=False)
        sizes = counts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        hit = np.flatnonzero(i.is_valid().to_numpy(zero_copy_only=False))
        ids = i.take(pa.array(hit)).to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.searchsorted(np.cumsum(sizes), hit, side="right")
        x = tf[hit] * self.idf[ids]
        ends = np.searchsorted(row, np.arange(len(counts) + 1))
        for a, z in zip(ends[:-1], ends[1:], strict=True):
            if z > a:
                x[a:z] /= max(np.sqrt((x[a:z] * x[a:z]).sum()), 1e-300)
        return row, ids, x

    def encode(self, counts: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term, bin) of the known terms of a batch of count lists."""
        row, i, x = self.known(counts)
        return row, i, self.bins(i, x)

    def bins(self, ids: np.ndarray, w: np.ndarray) -> np.ndarray:
        return 1 + (w[:, None] > self.edges[ids]).sum(axis=1)

    def nodes(self, dense: np.ndarray, term: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
        """Node of each row in each tree after so many levels (0 .. 2 ** levels - 1)."""
        n, trees = len(dense), np.arange(len(term))
        node = np.zeros((n, len(term)), np.int64)
        for _ in range(levels):
            x = dense[np.arange(n)[:, None], term[trees, node]]
            node = 2 * node + 1 + (x > cut[trees, node])
        return node - (2**levels - 1)

    def scores(self, dense: np.ndarray) -> np.ndarray:
        rounds, k, _ = self.term.shape
        if not rounds:
            return np.repeat(self.base[None], len(dense), axis=0)
        node = self.nodes(dense, self.term.reshape(rounds * k, -1), self.cut.reshape(rounds * k, -1), self.depth)
        got = self.leaf.reshape(rounds * k, -1)[np.arange(rounds * k), node]
        return self.base + got.reshape(len(dense), rounds, k).sum(axis=1)

    def dense(self, n: int, row: np.ndarray, ids: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros((n, len(self.terms)), np.uint8)
        out[row, ids] = b
        return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def histograms(b: Booster, level: int, term: np.ndarray, cut: np.ndarray, ids: list, bins: list, labels: np.ndarray, out: np.ndarray, total: np.ndarray) -> None:
    """Adds a slice's gradients: ``out`` (class, 2, node * term * bin), ``total`` (class, 2, node)."""
    n, width, each = len(ids), len(b.terms), b.edges.shape[1] + 1
    row = np.repeat(np.arange(n), [len(i) for i in ids])
    i, x = (np.concatenate(v).astype(np.int64) if len(row) else np.zeros(0, np.int64) for v in (ids, bins))
    dense = b.dense(n, row, i, x)
    p = softmax(b.scores(dense))
    g, h = p.copy(), p * (1 - p)
    g[np.arange(n), labels] -= 1
    node = b.nodes(dense, term, cut, level)
    for k in range(len(b.base)):
        at = (node[row, k] * width + i) * each + x - 1
        for j, v in enumerate((g, h)):
            out[k, j] += np.bincount(at, v[row, k], minlength=out.shape[2])
            total[k, j] += np.bincount(node[:, k], v[:, k], minlength=total.shape[2])


def best_splits(out: np.ndarray, total: np.ndarray, width: int, each: int, l2: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term, cut, G and H of both children) of each node of one class."""
    nodes = total.shape[1]
    above = out.reshape(2, nodes, width, each)[..., ::-1].cumsum(axis=-1)[..., ::-1]  # bins over cut 0, 1, ...
    low = total[:, :, None, None] - above
    value = lambda s: s[0] ** 2 / (s[1] + l2)
    gain = value(above) + value(low) - value(total)[:, None, None]
    gain[(above[1] < LEAST_HESSIAN) | (low[1] < LEAST_HESSIAN)] = -1.0
    flat = gain.reshape(nodes, -1)
    pick = flat.argmax(axis=1)
    split = flat[np.arange(nodes), pick] > 1e-9
    term, cut = np.where(split, pick // each, 0), np.where(split, pick % each, NONE)
    right = above.reshape(2, nodes, -1)[:, np.arange(nodes), pick] * split
    return term, cut, np.stack([total - right, right], axis=2)


class _Params(Params):
    textCol = Param(Params._dummy(), "textCol", "column of texts", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "column of class indices 0 .. n-1", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "column of the predicted class index", TypeConverters.toString)
    depth = Param(Params._dummy(), "depth", "levels of a tree", TypeConverters.toInt)
    stopWords = Param(Params._dummy(), "stopWords", "terms left out", TypeConverters.toListString)

    def _defaults(self) -> None:
        self._setDefault(textCol="text", labelCol="label", predictionCol="prediction", depth=3, stopWords=[])

    def get(self, name: str):
        return self.getOrDefault(self.getParam(name))

    def counts(self, text: str):
        return FE.counted(FE.with_ngrams(FE.terms(F.coalesce(F.col(text), F.lit("")), self.get("stopWords") or None), 2))


class BoostedTrees(Estimator, _Params, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the trees.  Rows without a label are left out; a text without
    known terms is a row of zeros."""
    features = Param(Params._dummy(), "features", "terms kept, the most frequent first", TypeConverters.toInt)
    bins = Param(Params._dummy(), "bins", "quantile bins of a term's weights", TypeConverters.toInt)
    rounds = Param(Params._dummy(), "rounds", "trees of each class", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "share of a tree's values that is added", TypeConverters.toFloat)
    l2 = Param(Params._dummy(), "l2", "regularisation of the values", TypeConverters.toFloat)
    minDf = Param(Params._dummy(), "minDf", "least documents of a term", TypeConverters.toInt)
    maxDf = Param(Params._dummy(), "maxDf", "largest share of documents of a term", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, **params):
        super().__init__()
        self._defaults()
        self._setDefault(features=4096, bins=4, rounds=10, rate=0.3, l2=1.0, minDf=2, maxDf=0.9)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> BoostedTreesModel:
        d = df.where(F.col(self.get("labelCol")).isNotNull()).select(F.col(self.get("labelCol")).cast("int").alias("label"), F.col(self.get("textCol")).alias("text"))
        d = written(materialize(d, {"counts": self.counts("text")}).select("label", "counts"), "counted")
        sizes = {r["label"]: r["n"] for r in d.groupBy("label").agg(F.count("*").alias("n")).collect()}  # one row a class
        n, classes = sum(sizes.values()), max(sizes, default=0) + 1
        base = np.log((np.array([sizes.get(k, 0) for k in range(classes)]) + 1) / (n + classes))
        stats = d.select(F.inline("counts")).groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))
        top = stats.where((F.col("df") >= self.get("minDf")) & (F.col("df") <= self.get("maxDf") * n)).orderBy(F.col("total").desc(), "term").limit(self.get("features")).collect()
        idf = np.log((1 + n) / (1 + np.array([r["df"] for r in top]))) + 1
        q = self.get("bins")
        b = Booster([r["term"] for r in top] or [""], idf if len(top) else np.ones(1), np.zeros((max(1, len(top)), q - 1)), base, self.get("depth"))

        def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for f in batches:
                for at in range(0, len(f), SLICE):
                    part = f.slice(at, SLICE)
                    row, i, x = b.known(part.column("counts"))
                    ends = pa.array(np.searchsorted(row, np.arange(len(part) + 1)), pa.int32())
                    lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (i.astype(np.int32), x)]
                    yield pa.RecordBatch.from_arrays([part.column("label"), *lists], ["label", "ids", "w"])

        rows = written(d.mapInArrow(weights, "label int, ids array<int>, w array<double>"), "weighted")
        if q > 1:
            cuts = F.percentile_approx("w", [k / q for k in range(1, q)], 1000)
            for r in rows.select(F.inline(F.arrays_zip("ids", "w"))).groupBy("ids").agg(cuts.alias("e")).collect():  # one row a feature
                b.edges[r["ids"]] = r["e"]
        width, k = len(b.terms), classes
        for _ in range(self.get("rounds")):
            term, cut = np.zeros((k, 2**b.depth - 1), np.int64), np.full((k, 2**b.depth - 1), NONE, np.int64)
            for level in range(b.depth):
                sums = self._pass(rows, b, level, term, cut, q)
                first = 2**level - 1
                leaf = np.zeros((k, 2 ** (level + 1)))
                for c, (out, total) in sums.items():
                    t, x, child = best_splits(out, total, width, q, self.get("l2"))
                    term[c, first:2 * first + 1], cut[c, first:2 * first + 1] = t, x
                    flat = child.reshape(2, -1)
                    leaf[c] = -self.get("rate") * flat[0] / (flat[1] + self.get("l2"))
            b.term, b.cut, b.leaf = (np.concatenate([a, x[None]]) for a, x in ((b.term, term), (b.cut, cut), (b.leaf, leaf)))
        model = BoostedTreesModel()
        self._copyValues(model)
        return model._with(b)

    def _pass(self, rows: DataFrame, b: Booster, level: int, term: np.ndarray, cut: np.ndarray, q: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Sums of one level: class -> (2, nodes * terms * bins) and (2, nodes)."""
        k, cells, nodes = len(b.base), 2**level * len(b.terms) * q, 2**level
        state = rows.sparkSession.sparkContext.broadcast((b, term, cut))

        def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            bb, t, c = state.value
            out, total, seen = np.zeros((k, 2, cells)), np.zeros((k, 2, nodes)), 0
            for f in frames:
                for a in range(0, len(f), SLICE):
                    part = f.iloc[a:a + SLICE]
                    ids = part["ids"].tolist()
                    histograms(bb, level, t, c, ids, [bb.bins(i, w) for i, w in zip(ids, part["w"], strict=True)], part["label"].to_numpy(), out, total)
                    seen += len(part)
            if seen:
                for j in range(k):
                    yield pd.DataFrame({"class": [j], "m": [np.concatenate([out[j].ravel(), total[j].ravel()]).tobytes()]})

        def add(g: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"class": [g["class"].iat[0]], "m": [sum(np.frombuffer(x) for x in g["m"]).tobytes()]})

        kind = "class int, m binary"
        part = rows.mapInPandas(task, kind).groupBy("class", F.pmod(F.xxhash64("m"), F.lit(16)).alias("salt")).applyInPandas(add, kind)
        got = {}
        for r in part.groupBy("class").applyInPandas(add, kind).toLocalIterator():  # one class at a time
            m = np.frombuffer(bytes(r["m"]))
            got[r["class"]] = (m[:2 * cells].reshape(2, cells), m[2 * cells:].reshape(2, nodes))
        state.destroy()
        return got


class BoostedTreesModel(Model, _Params, MLReadable, MLWritable):
    """Fitted trees; ``transform`` adds the prediction to every row, inside the row."""

    def __init__(self):
        super().__init__()
        self._defaults()
        self.booster: Booster | None = None

    def _with(self, booster: Booster) -> BoostedTreesModel:
        self.booster = booster
        return self

    def copy(self, extra=None) -> BoostedTreesModel:
        return super().copy(extra)._with(self.booster)

    def _transform(self, df: DataFrame) -> DataFrame:
        state = df.sparkSession.sparkContext.broadcast(self.booster)

        @F.arrow_udf("int")
        def classify(counts: pa.Array) -> pa.Array:
            b, out = state.value, []
            for a in range(0, len(counts), SLICE):
                part = counts.slice(a, SLICE)
                out.append(b.scores(b.dense(len(part), *b.encode(part))).argmax(axis=1))
            return pa.array(np.concatenate(out) if out else np.zeros(0), pa.int32())

        d = materialize(df, {"_counts": self.counts(self.get("textCol"))})  # so that a filter above leaves them where they are
        return d.withColumn(self.get("predictionCol"), classify("_counts")).drop("_counts")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: BoostedTreesModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        b = self.model.booster
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, {"base": b.base.tolist()})
        terms = [(t, float(i), [float(x) for x in e]) for t, i, e in zip(b.terms, b.idf, b.edges, strict=True)]
        trees = [(r, k, b.term[r, k].tolist(), b.cut[r, k].tolist(), b.leaf[r, k].tolist()) for r in range(len(b.term)) for k in range(len(b.base))]
        number = [(i, *t) for i, t in enumerate(terms)]
        self.sparkSession.createDataFrame(number, f"id int, {TERMS}").coalesce(1).write.parquet(f"{path}/terms")
        self.sparkSession.createDataFrame(trees, TREES).coalesce(1).write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def load(self, path: str) -> BoostedTreesModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = BoostedTreesModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        terms = spark.read.parquet(f"{path}/terms").orderBy("id").collect()  # the model's own rows
        trees = spark.read.parquet(f"{path}/trees").orderBy("round", "class").collect()
        b = Booster([r["term"] for r in terms], np.array([r["idf"] for r in terms]), np.array([r["edges"] for r in terms]).reshape(len(terms), -1),
                    np.array(metadata["base"]), model.get("depth"))
        k = len(b.base)
        b.term, b.cut, b.leaf = (np.array([r[c] for r in trees]).reshape(len(trees) // k, k, -1) for c in ("term", "cut", "leaf"))
        return model._with(b)
