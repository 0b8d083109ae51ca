"""Chunk-vector pooling, linear head and argmax as native expressions.

Vectors are ``array<double>`` columns.  Parameters (weight matrices, bias
and scorer vectors) are passed as Python lists and enter the plan as one
constant each, so scoring is a per-row projection with no shuffle.  Pooling
over rows is one sum per place of the vector, which Spark adds up before the
shuffle, so a document may have any number of chunks: no task holds them.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Masked attention score of the reference.
# ---------------------------------------------------------------------------
MASKED_SCORE = -1e4
# ---------------------------------------------------------------------------


def const_matrix(m: list[list[float]]) -> Column:
    """A constant ``array<array<double>>`` (folded to one literal)."""
    return F.from_json(F.lit(json.dumps(m)), "array<array<double>>")


def const_vector(v: list[float]) -> Column:
    return F.from_json(F.lit(json.dumps(v)), "array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0).cast("double"), lambda s, v: s + v)


def matvec(w: Column, x: Column, b: Column | None = None) -> Column:
    """``W x (+ b)`` for a row vector ``x``; W is (out x in).

    ``x`` is bound once: referenced inside the per-row lambda it would
    otherwise be re-evaluated for every row of W whenever the optimizer
    inlines the expression that produced it.
    """
    from chunkwise.functions.text import let

    if b is None:
        return let(x, lambda xv: F.transform(w, lambda row: dot(row, xv)))
    return let(x, lambda xv: F.transform(w, lambda row, i: dot(row, xv) + F.element_at(b, i + 1)))


def linear_logits(x: Column, w: list[list[float]], b: list[float], digits: int | None = 9) -> Column:
    """M8: logits of a linear head, rounded to ``digits`` places so argmax
    ties are stable across engines."""
    out = matvec(const_matrix(w), x, const_vector(b))
    return F.transform(out, lambda v: F.round(v, digits)) if digits is not None else out


def argmax(c: Column) -> Column:
    """0-based index of the largest value, lowest index on ties."""
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")


def attention_score(x: Column, w: list[list[float]], b: list[float], v: list[float]) -> Column:
    """``v . tanh(W x + b)``."""
    h = F.transform(matvec(const_matrix(w), x, const_vector(b)), lambda z: F.tanh(z))
    return dot(const_vector(v), h)


def width_of(df: DataFrame, embedding: str) -> int:
    """Width of the vectors, from one row; 0 without any."""
    row = df.where(F.col(embedding).isNotNull()).select(F.size(embedding)).first()
    return row[0] if row else 0


def weighted_sums(weight: Column, embedding: str, width: int) -> list[Column]:
    """One sum for each place of the vectors; null vectors add nothing."""
    return [F.coalesce(F.sum(weight * F.get(F.col(embedding), F.lit(i))), F.lit(0.0)).alias(f"_s{i}") for i in range(width)]


def pool_mean(df: DataFrame, doc: str = "doc", embedding: str = "embedding", mask: str | None = "mask",
              out: str = "doc_vec", width: int | None = None) -> DataFrame:
    """M6: mean over real chunks, divisor at least 1; without a mask a plain
    mean.  A null vector or mask counts as padding; a null document is one."""
    width = width_of(df, embedding) if width is None else width
    m = F.when(F.col(embedding).isNotNull(), F.coalesce(F.col(mask).cast("double"), F.lit(0.0)) if mask else F.lit(1.0)).otherwise(F.lit(0.0))
    g = df.groupBy(doc).agg(F.greatest(F.sum(m), F.lit(1.0)).alias("_n"), *weighted_sums(m, embedding, width))
    return g.select(doc, F.array(*[F.col(f"_s{i}") / F.col("_n") for i in range(width)]).cast("array<double>").alias(out))


EXPONENT = 32.0  # scores whose floor by this is equal are summed at one scale


def pool_attention(df: DataFrame, w: list[list[float]], b: list[float], v: list[float], doc: str = "doc",
                   embedding: str = "embedding", mask: str | None = "mask",
                   out: str = "doc_vec") -> DataFrame:
    """M7: score each chunk, mask padding with -1e4, softmax over the
    document's chunks, weighted sum of chunk vectors.

    The softmax merges: exp(score) is kept as exp(score - k * EXPONENT) under
    the exponent ``k = floor(score / EXPONENT)``, sums are taken per
    (document, k) before the shuffle, and a document's few exponents are then
    brought to its largest.  No sum overflows and none is lost that a plain
    softmax keeps.  A null vector counts as no chunk (a document of null
    vectors alone gets a null vector), a null mask as padding.
    """
    width = len(w[0]) if w else 0
    score = attention_score(F.col(embedding), w, b, v)
    if mask:
        score = F.when(F.coalesce(F.col(mask), F.lit(0)) == 0, F.lit(MASKED_SCORE)).otherwise(score)
    # the masked score has an exponent of its own, far below those of real chunks
    d = df.select(doc, embedding, F.when(F.col(embedding).isNotNull(), score).alias("_score"))
    d = d.withColumn("_k", F.floor(F.col("_score") / EXPONENT)).withColumn("_e", F.exp(F.col("_score") - F.col("_k") * EXPONENT))
    part = d.groupBy(doc, "_k").agg(F.coalesce(F.sum("_e"), F.lit(0.0)).alias("_z"), *weighted_sums(F.col("_e"), embedding, width))
    top = F.max("_k").over(Window.partitionBy(doc))
    part = part.withColumn("_f", F.coalesce(F.exp((F.col("_k") - top) * EXPONENT), F.lit(0.0)))
    total = part.groupBy(doc).agg(F.sum(F.col("_f") * F.col("_z")).alias("_z"),
                                  *[F.sum(F.col("_f") * F.col(f"_s{i}")).alias(f"_s{i}") for i in range(width)])
    return total.select(doc, F.when(F.col("_z") > 0, F.array(*[F.col(f"_s{i}") / F.col("_z") for i in range(width)])).alias(out))


def vector_long(df: DataFrame, keys: list[str], vec: str, pos: str = "dim", val: str = "value",
                digits: int | None = 6) -> DataFrame:
    """Vector column to rows ``(keys..., dim, value)``."""
    o = df.select(*keys, F.posexplode(vec).alias(pos, "_v"))
    v = F.round("_v", digits) if digits is not None else F.col("_v")
    return o.select(*keys, pos, v.alias(val))


# ---------------------------------------------------------------------------
# Deterministic parameters used by the registered queries (rule-generated).
# ---------------------------------------------------------------------------

def head_weights(n_classes: int, width: int) -> tuple[list[list[float]], list[float]]:
    w = [[((c * 31 + i * 17) % 13 - 6) / 13 for i in range(width)] for c in range(n_classes)]
    b = [((c * 7) % 5 - 2) / 10 for c in range(n_classes)]
    return w, b


def attention_weights(width: int) -> tuple[list[list[float]], list[float], list[float]]:
    w = [[((j * 13 + i * 7) % 11 - 5) / 50 for i in range(width)] for j in range(width)]
    b = [((j * 3) % 7 - 3) / 100 for j in range(width)]
    v = [((j * 5) % 9 - 4) / 20 for j in range(width)]
    return w, b, v


def pool_attention_rows(vecs: Column, mask: Column, w: list[list[float]], b: list[float],
                        v: list[float], hidden: Column | None = None) -> Column:
    """M7 inside one row: ``vecs array<array<double>>`` (the document's
    padded chunks) and ``mask array<int>`` -> pooled vector.  Used where all
    chunks of a document are already in its row (prediction, streaming), so
    no grouping is needed.  ``hidden`` brings ``W x + b`` of each chunk."""
    from chunkwise.functions.text import let

    def score(x: Column, i: Column) -> Column:
        if hidden is None:
            return attention_score(x, w, b, v)
        return dot(const_vector(v), F.transform(F.element_at(hidden, i + 1), lambda z: F.tanh(z)))

    def pooled(sc: Column) -> Column:
        mx = F.array_max(sc)
        e = F.transform(sc, lambda s: F.exp(s - mx))
        z = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
        width = F.size(F.element_at(vecs, 1))
        tot = F.aggregate(F.arrays_zip(vecs.alias("x"), e.alias("e")), F.array_repeat(F.lit(0.0), width),
                          lambda acc, r: F.zip_with(acc, r["x"], lambda a, x: a + x * r["e"]))
        return F.transform(tot, lambda t: t / z)

    scores = F.transform(vecs, lambda x, i: F.when(F.element_at(mask, i + 1) == 0, F.lit(MASKED_SCORE))
                         .otherwise(score(x, i)))
    return let(scores, pooled)


def in_order(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    """``w x`` for every row of ``x``, summed place by place from 0.0 as ``dot`` does."""
    out = np.zeros((len(x), len(w)))
    for i in range(x.shape[1]):
        out += w[:, i] * x[:, i:i + 1]
    return out


def hidden_udf(w: list[list[float]], b: list[float]) -> Callable[[Column], Column]:
    """Arrow function ``W x + b`` of every vector of a list, equal to ``matvec``; null where the list is."""
    wm, bm = np.array(w, float), np.array(b, float)

    @F.arrow_udf("array<array<double>>")
    def hidden(vecs: pa.Array) -> pa.Array:
        flat = vecs.flatten()
        h = in_order(wm, flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), wm.shape[1])) + bm
        rows = pa.ListArray.from_arrays(pa.array(np.arange(len(h) + 1) * len(bm), pa.int32()), pa.array(h.ravel()))
        ends = np.r_[0, np.cumsum(vecs.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows, mask=vecs.is_null())

    return hidden


def pool_mean_rows(vecs: Column, mask: Column) -> Column:
    """M6 inside one row."""
    width = F.size(F.element_at(vecs, 1))
    tot = F.aggregate(F.arrays_zip(vecs.alias("x"), mask.alias("m")), F.array_repeat(F.lit(0.0), width),
                      lambda acc, r: F.zip_with(acc, r["x"], lambda a, x: a + x * r["m"]))
    denom = F.greatest(F.aggregate(mask, F.lit(0), lambda a, m: a + m), F.lit(1)).cast("double")
    return F.transform(tot, lambda t: t / denom)
