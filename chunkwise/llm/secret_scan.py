"""Secret scan: base patterns, and a character convolution network over further candidates.

Base spans (code points, end exclusive) are found leftmost and non-overlapping per kind, then those
that are too short are dropped.  Every other run of 20 or more token characters that mixes letters
and digits is a candidate; the network scores it with its context, and one at or above the
threshold becomes a ``net`` span.  Null text is empty; rows keep their order and count.

Training: labelled findings are candidates of every whole text: positives are base spans, negatives
are all other runs of 20 or more token characters and the words around the findings.  Equal windows
are one example with a weight.  In each epoch tasks learn from their own examples and the parameters
are averaged.  The threshold is the lowest calibrated (Platt) score that keeps ``RECALL`` of all
held-out positives (a fifth of the examples, by hash); with under ``FEW`` findings nothing is held
out, and it is taken from all of them.  Without a finding nothing is added.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwise.llm.store import stored

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the same spans as runs of any length with the short ones dropped
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{20,}")
WORD = re.compile(r"[A-Za-z0-9+/_.=-]{6,}")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
KINDS = ("assign", "access", "hex", "net")
EXAMPLES, CONTEXT, FILTERS, TAPS, RECALL, FEW, AROUND = 4096, 16, 16, 5, 0.98, 10, 4
PIECE = 1 << 15  # positions convolved at a time


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted."""
    out = []
    low = text.encode("utf-8", "replace").lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list) -> list[tuple[int, int]]:
    out = []
    for m in CANDIDATE.finditer(text):
        s, e, t = m.start(), m.end(), m[0]
        if re.search("[0-9]", t) and re.search("[A-Za-z]", t) and not any(a < e and s < b for a, _, b in base):
            out.append((s, e))
    return out


def window(text: str, s: int, e: int) -> np.ndarray:
    """Codes of the whole candidate with CONTEXT characters on both sides: 0 pads, 1-95 ASCII, 96 other."""
    x = np.zeros(e - s + 2 * CONTEXT, np.int64)
    left = max(0, s - CONTEXT)
    c = np.frombuffer(text[left:e + CONTEXT].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    at = CONTEXT - (s - left)
    x[at:at + len(c)] = np.where((c >= 32) & (c < 127), c - 31, 96)
    return x


class CharNet:
    """Embedding by convolution (one table per tap), ReLU, max over positions, linear."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.k = r.normal(0, 0.1, (TAPS, 97, FILTERS))
        self.w, self.b, self.platt, self.cut = r.normal(0, 0.1, FILTERS), 0.0, (1.0, 0.0), 0.5

    def hidden(self, xs):
        """(value, position) of the largest response of each filter over each whole window."""
        out, at = np.empty((len(xs), FILTERS)), np.empty((len(xs), FILTERS), np.int64)
        size = np.array([len(x) for x in xs])
        long = size > 2 * PIECE
        for i in np.split(np.arange(len(xs)), np.flatnonzero((np.diff(np.cumsum(size) // PIECE) > 0) | long[1:] | long[:-1]) + 1):
            if long[i[0]]:  # in pieces that overlap by TAPS - 1
                x = xs[i[0]]
                cuts = list(range(0, len(x) - TAPS + 1, PIECE))
                h, p = self.hidden([x[c:c + PIECE + TAPS - 1] for c in cuts])
                best = h.argmax(0)
                out[i[0]], at[i[0]] = h[best, np.arange(FILTERS)], p[best, np.arange(FILTERS)] + np.array(cuts)[best]
                continue
            flat = np.concatenate([xs[v] for v in i])
            n = len(flat) - TAPS + 1
            h, start = sum(self.k[j][flat[j:j + n]] for j in range(TAPS)), 0
            for v in i:
                own = h[start:start + len(xs[v]) - TAPS + 1]
                at[v] = own.argmax(0)
                out[v] = own[at[v], np.arange(FILTERS)]
                start += len(xs[v])
        return np.maximum(out, 0), at

    def logit(self, xs):
        return self.hidden(xs)[0] @ self.w + self.b if len(xs) else np.zeros(0)

    def score(self, x):
        a, b = self.platt
        return 1 / (1 + np.exp(-np.clip(a * self.logit(x) + b, -30, 30)))

    def start(self) -> list:
        """Sums of squared gradients before the first step."""
        return [np.full_like(self.k, 1e-6), np.full(FILTERS, 1e-6), 1e-6]

    def learn(self, xs, y, weight, order, seen: list, rate: float) -> None:
        """Adagrad steps of about 64 examples each in the given order; ``seen`` goes on."""
        for i in np.array_split(order, max(1, len(order) // 64)):
            x = [xs[v] for v in i]
            h, at = self.hidden(x)
            d = (1 / (1 + np.exp(-np.clip(h @ self.w + self.b, -30, 30))) - y[i]) * weight[i] / weight[i].sum()
            dw, db, dh = h.T @ d, d.sum(), np.outer(d, self.w) * (h > 0)
            dk = np.zeros_like(self.k)
            for j in range(TAPS):
                np.add.at(dk[j], (np.stack([v[p + j] for v, p in zip(x, at, strict=True)]), np.arange(FILTERS)[None]), dh)
            for n, g in enumerate((dk, dw, db)):
                seen[n] = seen[n] + g * g
            self.k = self.k - rate * dk / np.sqrt(seen[0])
            self.w = self.w - rate * dw / np.sqrt(seen[1])
            self.b = self.b - rate * db / np.sqrt(seen[2])

    def flat(self, seen: list) -> np.ndarray:
        return np.concatenate([self.k.ravel(), self.w, [self.b], seen[0].ravel(), seen[1], [seen[2]]])

    def unflat(self, v: np.ndarray) -> list:
        n = self.k.size
        half = lambda u: (u[:n].reshape(self.k.shape).copy(), u[n:n + FILTERS].copy(), float(u[n + FILTERS]))
        self.k, self.w, self.b = half(v[:len(v) // 2])
        return list(half(v[len(v) // 2:]))

    def fit(self, xs, y, epochs: int = 12, rate: float = 0.05, seed: int = 7):
        r = np.random.default_rng(seed)
        held = np.arange(len(y)) % 5 == 0
        if y.sum() < FEW or not y[held].any():
            held, tr = np.ones(len(y), bool), np.arange(len(y))
        else:
            tr = np.flatnonzero(~held)
        seen = self.start()
        for _ in range(epochs):
            self.learn(xs, y, np.ones(len(y)), r.permutation(tr), seen, rate)
        on = [xs[v] for v in np.flatnonzero(held)]
        z, t = self.logit(on), y[held]
        a, b = 1.0, 0.0
        for _ in range(200):
            d = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30))) - t
            a, b = a - 0.1 * float((d * z).mean()), b - 0.1 * float(d.mean())
        self.platt = (a, b)
        pos = np.sort(self.score(on)[t == 1])
        self.cut = float(pos[int(len(pos) * (1 - RECALL))])
        return self


def examples(docs: DataFrame) -> DataFrame:
    """(x, y, n, held) of every text: distinct windows with their labels and counts."""
    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            x, y = [], []
            for t in f["text"]:
                base = base_spans(t or "")
                free = [(m.start(), m.end()) for m in (WORD if base else CANDIDATE).finditer(t or "")]
                free = [(s, e) for s, e in free if not any(a < e and s < b for a, _, b in base)]
                near = {v for a, _, b in base for v in [*[f for f in free if f[1] <= a][-AROUND:], *[f for f in free if f[0] >= b][:AROUND]]}
                spans = [(a, b, 1) for a, _, b in base] + [(a, b, 0) for a, b in free if b - a >= 20 or (a, b) in near]
                x += [window(t, a, b).astype(np.uint8).tobytes() for a, b, _ in spans]
                y += [v for _, _, v in spans]
            yield pd.DataFrame({"x": x, "y": np.array(y, "int32")})

    e = docs.select("text").mapInPandas(find, "x binary, y int").groupBy("x", "y").agg(F.count("*").alias("n"))
    return e.withColumn("held", F.pmod(F.xxhash64("x"), F.lit(5)) == 0)


def windows(x: pd.Series) -> list:
    return [np.frombuffer(v, np.uint8).astype(np.int64) for v in x]


def epoch(rows: DataFrame, net: CharNet, seen: list, rate: float, seed: int) -> list:
    """Every task learns from its examples; parameters are averaged by their weight."""
    state = net.flat(seen)

    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, n = CharNet(), 0
        got = own.unflat(state)
        for f in frames:
            own.learn(windows(f["x"]), f["y"].to_numpy(float), f["n"].to_numpy(float), np.random.default_rng(seed).permutation(len(f)), got, rate)
            n += int(f["n"].sum())
        if n:
            yield pd.DataFrame({"n": [n], "m": [(own.flat(got) * n).tobytes()]})

    def add(g: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"n": [g["n"].sum()], "m": [sum(np.frombuffer(v) for v in g["m"]).tobytes()]})

    part = rows.mapInPandas(task, "n long, m binary").groupBy(F.pmod(F.xxhash64("m"), F.lit(16))).applyInPandas(add, "n long, m binary")
    got = part.collect()  # at most 16 sums of the parameters
    return net.unflat(sum(np.frombuffer(bytes(r["m"])) for r in got) / sum(r["n"] for r in got)) if got else seen


def kth(scores: DataFrame, k: int) -> float:
    """The ``k``-th least ``s`` (from 0), each counted ``n`` times: counts by bins until few values are left."""
    left = scores
    for _ in range(8):
        low, high, values = left.agg(F.min("s"), F.max("s"), F.count("*")).first()
        if values <= 10_000 or low == high:
            break
        width = (high - low) / 1024
        bins = left.withColumn("bin", F.least(F.floor((F.col("s") - low) / width), F.lit(1023)))
        for r in bins.groupBy("bin").agg(F.sum("n").alias("n")).orderBy("bin").collect():  # at most 1,024
            if k < r["n"]:
                break
            k -= r["n"]
        left = bins.where(F.col("bin") == r["bin"]).drop("bin")
    for r in left.groupBy("s").agg(F.sum("n").alias("n")).orderBy("s").toLocalIterator():
        if k < r["n"]:
            return float(r["s"])
        k -= r["n"]
    raise ValueError("fewer scores than asked for")


def train(docs: DataFrame, epochs: int = 12, rate: float = 0.05) -> CharNet:
    """Fit on the examples of every text."""
    rows = stored(examples(docs), "secret-examples")
    net, one = CharNet(), (F.col("y") == 1)
    total, pos, held = rows.agg(F.count("*"), F.sum(F.when(one, F.col("n"))), F.sum(F.when(one & F.col("held"), F.col("n")))).first()
    if not pos:
        net.cut = 2.0  # no finding to learn from
        return net
    few = pos < FEW or not held
    learnt, kept = (rows, rows) if few else (rows.where("not held"), rows.where("held"))
    tasks = max(1, min(-(-total // EXAMPLES), rows.sparkSession.sparkContext.defaultParallelism))
    learnt = stored(learnt.repartition(tasks, F.xxhash64("x", F.lit(7))).sortWithinPartitions(F.xxhash64("x"), "x", "y"), "secret-learnt")
    seen = net.start()
    for k in range(epochs):
        seen = epoch(learnt, net, seen, rate, 7 + k)

    def logits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"z": net.logit(windows(f["x"])), "y": f["y"], "n": f["n"]})

    z = stored(kept.mapInPandas(logits, "z double, y int, n long"), "secret-logits")
    n1, n0 = z.agg(F.sum(F.when(one, F.col("n"))), F.coalesce(F.sum(F.when(~one, F.col("n"))), F.lit(0))).first()
    aim = F.when(one, F.lit((n1 + 1) / (n1 + 2))).otherwise(F.lit(1 / (n0 + 2)))
    a, b = 1.0, 0.0
    for _ in range(20):  # Newton steps to Platt's calibration
        p = 1 / (1 + F.exp(-F.greatest(F.least(a * F.col("z") + b, F.lit(30.0)), F.lit(-30.0))))
        d, h = F.col("n") * (p - aim), F.col("n") * p * (1 - p)
        ga, gb, haa, hab, hbb = z.agg(F.sum(d * F.col("z")), F.sum(d), F.sum(h * F.col("z") * F.col("z")), F.sum(h * F.col("z")), F.sum(h)).first()
        step = np.linalg.solve(np.array([[haa, hab], [hab, hbb]]) + 1e-6 * np.eye(2), [ga, gb])
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-300))
        a, b = float(a - step[0]), float(b - step[1])
        if np.abs(step).max() < 1e-6:
            break
    net.platt = (a, b)
    s = F.lit(a) * F.col("z") + F.lit(b)
    cut = kth(z.where(one).select(s.alias("s"), "n"), int(n1 * (1 - RECALL)))
    net.cut = float(1 / (1 + np.exp(-np.clip(cut, -30, 30)))) * (1 - 1e-12)  # logits may differ in the last place by batch
    return net


def scan(docs: DataFrame, net: CharNet) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        say = lambda v: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(v))
        for f in frames:
            rows = []
            for t in f["text"]:
                t = t or ""
                base = base_spans(t)
                more = candidates(t, base)
                p = net.score([window(t, s, e) for s, e in more]) if more else ()
                extra = [(s, 3, e) for (s, e), v in zip(more, p, strict=True) if v >= net.cut]
                n = [sum(k == j for _, k, _ in base) for j in range(3)]
                rows.append((*n, hashlib.sha256(say(base).encode()).hexdigest(), say(base + extra)))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])
            out.insert(0, "doc_id", f["doc_id"].astype("Int64"))
            yield out

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInPandas(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
