"""M2: truncated SVD of a sparse document-term matrix by randomised block Krylov iteration.

Documents stay in their tasks as sparse rows; what travels is bounded by the
vocabulary times the rank, whatever the number of documents:

* the range finder starts from Gaussian columns, made in each task from the
  seed; each round adds the directions that the matrix makes of it, until
  the singular values stand still;
* the orthonormal basis of the tall product comes from a tree of QR blocks:
  a batch gives its R, groups of them are stacked and factored again;
* the small matrix (rank x vocabulary) is a sum over batches, added up in
  column blocks, and its SVD is taken on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwise.operators.store import written

OVERSAMPLE, ROUNDS, STILL, SEED = 10, 8, 1e-12, 42
KEPT = 8  # the basis is cut back to two starts of it when it holds more than so many
BLOCK = 4096  # columns of the small matrix that are added up together
PIECE = 1 << 21  # numbers of a matrix that are taken out of it at a time
FAN = 16  # R factors that are stacked at each level of the tree


def sparse_rows(weights: DataFrame, vocab: DataFrame, key: str) -> DataFrame:
    """(key, ids, weights) of each document, written once; a document has at
    most the vocabulary's number of entries."""
    # the vocabulary is bounded by max_features; its join is left to the size that Spark measures
    w = weights.join(vocab.select("term", "term_id"), "term").groupBy(key).agg(F.collect_list(F.struct("term_id", "weight")).alias("e"))
    return written(w.select(key, F.col("e.term_id").cast("array<int>").alias("ids"), F.col("e.weight").cast("array<double>").alias("w")), "sparse-rows")


def gaussian(width: int, rank: int, seed: int) -> np.ndarray:
    """The range finder's start, the same wherever it is made."""
    return np.random.default_rng(seed).standard_normal((width, rank))


def product(f: pd.DataFrame, right: np.ndarray) -> np.ndarray:
    """Sparse rows of a batch times a dense matrix."""
    out = np.zeros((len(f), right.shape[1]))
    step = max(1, PIECE // max(1, right.shape[1]))  # so that no slice of the matrix is larger than a few million numbers
    for i, (ids, w) in enumerate(zip(f["ids"], f["w"], strict=True)):
        for k in range(0, len(ids), step):
            out[i] += w[k:k + step] @ right[ids[k:k + step]]
    return out


def factor(blocks: list[np.ndarray], rank: int) -> np.ndarray:
    """R (rank x rank) of stacked blocks."""
    if not blocks:
        return np.zeros((rank, rank))
    r = np.linalg.qr(np.vstack(blocks), mode="r")
    return np.vstack([r, np.zeros((rank - len(r), rank))]) if len(r) < rank else r


def tree_qr(rows: DataFrame, right, rank: int) -> np.ndarray:
    """R of the product of all rows with ``right()``, through levels of ``FAN`` factors."""

    def leaf(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v, r = right(), None
        for f in frames:
            y = product(f, v)
            r = factor([y] if r is None else [r, y], rank)
        if r is not None:
            yield pd.DataFrame({"r": [r.tobytes()]})

    def merge(g: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"r": [factor([np.frombuffer(b).reshape(rank, rank) for b in g["r"]], rank).tobytes()]})

    level = written(rows.mapInPandas(leaf, "r binary"), "qr")
    while (n := level.count()) > FAN:
        groups = -(-n // FAN)
        level = written(level.withColumn("g", F.pmod(F.xxhash64("r"), F.lit(groups))).groupBy("g").applyInPandas(merge, "r binary"), "qr")
    return factor([np.frombuffer(b["r"]).reshape(rank, rank) for b in level.collect()], rank)  # at most FAN of them


def small_matrix(rows: DataFrame, right, back: np.ndarray, width: int) -> np.ndarray:
    """(Y back)^T A for Y = A right: rank x vocabulary, added up in blocks of columns."""
    rank = back.shape[1]

    def leaf(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v, total, any_row = right(), np.zeros((width, rank)), False
        for f in frames:
            q = product(f, v) @ back
            for i, (ids, w) in enumerate(zip(f["ids"], f["w"], strict=True)):  # a term occurs once in a row
                total[ids] += np.asarray(w)[:, None] * q[i]
            any_row = any_row or len(f) > 0
        if any_row:
            for b in range(0, width, BLOCK):
                yield pd.DataFrame({"block": [b], "m": [total[b:b + BLOCK].tobytes()]})

    def add(g: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": [g["block"].iat[0]], "m": [sum(np.frombuffer(b) for b in g["m"]).tobytes()]})

    salt = F.pmod(F.xxhash64("m"), F.lit(FAN)).alias("salt")
    part = rows.mapInPandas(leaf, "block int, m binary").groupBy("block", salt).applyInPandas(add, "block int, m binary")
    out = np.zeros((width, rank))
    for r in part.groupBy("block").applyInPandas(add, "block int, m binary").collect():  # vocabulary x rank numbers
        m = np.frombuffer(r["m"]).reshape(-1, rank)
        out[r["block"]:r["block"] + len(m)] = m
    return out.T


def truncated_svd(rows: DataFrame, width: int, k: int, oversample: int = OVERSAMPLE, rounds: int = ROUNDS,
                  seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, right vectors as columns) of the sparse rows: the
    largest ``k``, fewer if the matrix is smaller.  At most ``rounds`` rounds
    of two passes over the rows, fewer once no value changes by more than
    ``STILL`` of the largest."""
    start = max(1, min(k + oversample, width))
    right, rank = (lambda: gaussian(width, start, seed)), start
    before, s, vt = None, np.zeros(0), np.zeros((0, width))
    for _ in range(max(1, rounds)):
        back = np.linalg.pinv(tree_qr(rows, right, rank))
        _, s, vt = np.linalg.svd(small_matrix(rows, right, back, width), full_matrices=False)
        top = np.r_[s, np.zeros(k)][:k]
        if before is not None and np.abs(top - before).max(initial=0.0) <= STILL * max(top.max(initial=0.0), 1e-300):
            break
        before = top
        old = np.hstack([right(), vt.T]) if rank + start <= KEPT * start else vt[:2 * start].T
        u, size, _ = np.linalg.svd(old, full_matrices=False)  # vocabulary x rank: an orthonormal basis of both
        basis = np.ascontiguousarray(u[:, size > 1e-10 * size.max(initial=0.0)])
        if not basis.shape[1]:
            break
        right, rank = (lambda b=basis: b), basis.shape[1]
    return s[:k], vt[:k].T


def reduce_rows(weights: DataFrame, vocab: DataFrame, k: int, key: str, seed: int = SEED, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(key, dim, value) coordinates ``U * S`` of every document, and S.  The
    sign of a dimension is that which makes its largest right entry positive."""
    rows = sparse_rows(weights, vocab, key)
    width = int(vocab.agg(F.max("term_id")).first()[0] or 0) + 1
    s, v = truncated_svd(rows, width, k, rounds=rounds, seed=seed)
    v = v * np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])])

    def project(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({key: f[key], "u": list(product(f, v))})

    # keys travel as text: pandas would turn whole numbers beside nulls into doubles
    kind = rows.schema[key].dataType
    u = rows.withColumn(key, F.col(key).cast("string")).mapInPandas(project, f"{key} string, u array<double>")
    return u.select(F.col(key).cast(kind).alias(key), F.posexplode("u").alias("dim", "value")), s
