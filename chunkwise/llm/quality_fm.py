"""Quality classifier: a factorisation machine over hashed words, structure statistics and length.

score = sigmoid(b + w.x + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]), linear in the text.
Inputs come from the text alone.  Training reads at most ``SAMPLE_ROWS`` labelled texts of at most
``SAMPLE_CHARS`` characters (in order of a hash of the id, held-out ids excluded); the weights have
a fixed size.  Null text is empty; empty texts get a score; every input row gives one row.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS, FACTORS, SAMPLE_ROWS, SAMPLE_CHARS, CUT = 1 << 14, 8, 6000, 50_000, 0.3
STATS = 10


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Ids (statistics first) and values."""
    t = text or ""
    w = t.lower().split()
    n, m = max(1, len(w)), max(1, len(t))
    c = Counter(w)
    upper = sum(map(len, re.findall("[A-ZÀ-Þ]+", t)))
    symbols = sum(t.count(s) for s in "#*$%&<>")
    stats = [np.log1p(len(w)) / 8, np.log1p(len(t)) / 10, upper / m, min(3.0, 5 * symbols / n), min(3.0, 5 * t.count("|") / n),
             min(3.0, 5 * t.count("!") / n), 1 - len(c) / n, sum(a == b for a, b in zip(w, w[1:], strict=False)) / n,
             sum(map(len, re.findall("[0-9]+", t))) / m, min(3.0, m / n / 8)]
    ids: Counter = Counter()
    for x, k in c.items():
        ids[STATS + zlib.crc32(x.encode("utf-8", "replace")) % BUCKETS] += k
    return (np.fromiter([*range(STATS), *ids], np.int64), np.fromiter([*stats, *(v / n for v in ids.values())], float))


class FactorisationMachine:
    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        self.b, self.w = 0.0, np.zeros(STATS + BUCKETS)
        self.v = r.normal(0, 0.05, (STATS + BUCKETS, FACTORS))

    def logit(self, i, x):
        vx = self.v[i] * x[:, None]
        s = vx.sum(0)
        return self.b + self.w[i] @ x + 0.5 * float((s * s - (vx * vx).sum(0)).sum()), s

    def score(self, text) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(*features(text))[0], -30, 30))))

    def fit(self, texts, labels, epochs: int = 6, rate: float = 0.08, decay: float = 1e-5):
        rows = [features(t) for t in texts]
        gw, gv, gb, r = np.full(len(self.w), 1e-4), np.full(self.v.shape, 1e-4), 1e-4, np.random.default_rng(5)
        for _ in range(epochs):
            for k in r.permutation(len(rows)):
                i, x = rows[k]
                z, s = self.logit(i, x)
                d = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[k]
                dw = d * x + decay * self.w[i]
                dv = d * (x[:, None] * s - self.v[i] * (x * x)[:, None]) + decay * self.v[i]
                gb += d * d
                gw[i] += dw * dw
                gv[i] += dv * dv
                self.b -= rate * d / np.sqrt(gb)
                self.w[i] -= rate * dw / np.sqrt(gw[i])
                self.v[i] -= rate * dv / np.sqrt(gv[i])
        return self


def held_out():
    """Whether a row is kept from learning; a row without a doc_id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> FactorisationMachine:
    """Labels without a document, and null labels or texts, are not used."""
    pick = (labels.select("doc_id", F.col("quality").alias("y")).where(F.col("y").isNotNull() & ~held_out())
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    s = (docs.select("doc_id", "text").where(F.length("text") <= SAMPLE_CHARS).join(F.broadcast(pick), "doc_id")
         .orderBy("doc_id", "text").limit(rows).toPandas())
    return FactorisationMachine().fit(list(s["text"]), s["y"].to_numpy(float))


def score(docs: DataFrame, model: FactorisationMachine, name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score (a column of that name is replaced)."""
    docs = docs.drop(name)
    bc = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield pd.Series([bc.value.score(t) for t in s], dtype=float)

    return docs.withColumn(name, run("text"))
