"""SimHash near-duplicates joined by vantage-point trees over Hamming distance.

A fingerprint bit is set where over half of the text's shingle hashes have it.  Distinct
fingerprints are the points.  A vantage-point tree of ``LEVELS`` halvings, fitted on at most
``SAMPLE`` points (those of least hash), deals all points to its leaves, the shards; a point also
visits each later shard that its ball of radius ``BITS`` may reach by the triangle bounds, so every
pair within the radius meets in one shard.  Inside a shard each task goes on halving by vantage
points of its own, prunes by the same bounds and compares what is left by popcount.  It keeps a
union of what it links, so a dense group gives one row a point, not one a pair.  Components of
these rows are found by the rounds of ``order_minhash.components``.

Shards of many points are cut into squares of at most ``SIDE`` members and ``SIDE`` visitors, each
of them a task.  All points are indexed and the result is exact at any size; the sample only places
the tree's cuts.  The visits per point do not grow with the table; the comparisons of a point do,
about with the power 0.75 of the number of points for fingerprints without structure.

Null and wordless texts have fingerprint zero, which links like any other.  Fewer words than
``WORDS`` are one shingle.  A row without a doc_id is linked too; component_id is the least doc_id
reached, null where no row reached has one.  Repeated rows give equal rows.  An empty table gives
no rows.  Extra columns are ignored.  Whole texts are hashed, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwise.llm.order_minhash import components
from chunkwise.llm.store import stored

WORDS, SEED, BITS = 4, 42, 4
SAMPLE, LEVELS = 1 << 14, 6
SIDE = 1 << 18  # members and visitors of a task
SMALL = 1 << 16  # pairs that are compared without halving further
CELLS = 1 << 20  # pairs compared at a time
TRIES = 4  # points tried as vantage point
HEAVY = 10_000  # a fingerprint of more rows than the HEAVY-th part of all is joined by broadcast: at most HEAVY of them


def fingerprint(text: str | None) -> int:
    """64-bit fingerprint of a whole text."""
    import xxhash

    w = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z alone, ASCII white space alone
    if not w:
        return 0
    joined, n = b" ".join(w), max(1, len(w) - WORDS + 1)
    end = np.cumsum([len(x) + 1 for x in w])
    starts, ends = [0, *end[:n - 1].tolist()], (end[min(WORDS, len(w)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)), "<u8", n)
    count = np.zeros(64, np.int64)
    for k in range(0, n, CELLS):
        count += np.unpackbits(h[k:k + CELLS].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            fp = np.array([fingerprint(t) for t in f["text"]], np.uint64)
            yield pd.DataFrame({"doc_id": f["doc_id"], "fp": fp.view(np.int64)})

    # ids travel as text: pandas would turn whole numbers beside nulls into doubles
    d = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, "doc_id string, fp long")
    return d.select(F.col("doc_id").cast("long").alias("doc_id"), "fp")


def distance(x: np.ndarray, y) -> np.ndarray:
    return np.bitwise_count(x ^ y).astype(np.int16)


def vantage(points: np.ndarray, rng: np.random.Generator) -> np.uint64:
    """Of a few points, the one whose distances spread most."""
    tried, among = rng.choice(points, TRIES), rng.choice(points, 256)
    return tried[int(np.argmax([distance(among, v).var() for v in tried]))]


def fit(sample: np.ndarray, levels: int = LEVELS) -> list[tuple[np.uint64, int]]:
    """(vantage point, radius) of the inner nodes in heap order; a node splits points by distance <= radius."""
    rng, tree, at = np.random.default_rng(7), [], {0: sample}
    for k in range(2**levels - 1):
        p = at.pop(k)
        v = vantage(p, rng) if len(p) else np.uint64(0)
        d = distance(p, v)
        r = int(np.median(d)) if len(p) else 32
        tree.append((v, r))
        at[2 * k + 1], at[2 * k + 2] = p[d <= r], p[d > r]
    return tree


def visits(points: np.ndarray, tree: list, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shard, member) of each point's own shard and of the later ones its ball may reach."""
    centre, radius = np.array([v for v, _ in tree], np.uint64), np.array([r for _, r in tree], np.int16)
    row, node = np.arange(len(points)), np.zeros(len(points), np.int64)
    own = np.ones(len(points), bool)  # the path of the point itself, in that every turn is its own
    while len(row) and node[0] < len(tree):
        d, r = distance(points[row], centre[node]), radius[node]
        inner, outer = d <= r + bits, d > r - bits
        row, own, node = (np.concatenate([a[inner], b[outer]]) for a, b in (
            (row, row), (own & (d <= r), own & (d > r)), (2 * node + 1, 2 * node + 2)))
    shard = node - len(tree)
    home = np.empty(len(points), np.int64)
    home[row[own]] = shard[own]
    keep = shard >= home[row]
    return row[keep], shard[keep], own[keep]


class Union:
    """Least index of each linked group over the indices of an array; links are taken in together."""

    def __init__(self, n: int):
        self.of, self.waiting, self.held = np.arange(n), [], 0

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        new = self.of[a] != self.of[b]
        self.waiting.append((a[new], b[new]))
        self.held += int(new.sum())
        if self.held > CELLS:
            self.settle()

    def settle(self) -> None:
        a, b = (np.concatenate([w[k] for w in self.waiting] or [self.of[:0]]) for k in (0, 1))
        self.waiting, self.held = [], 0
        while len(a):
            x, y = self.of[a], self.of[b]
            differ = x != y
            if not differ.any():
                return
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(self.of, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(up := self.of[self.of], self.of):
                self.of = up


def close(points: np.ndarray, members: np.ndarray, asking: np.ndarray, union: Union, bits: int = BITS) -> None:
    """Links every pair (member, asking), given as indices of points, within ``bits``; halving by vantage points."""
    rng, todo = np.random.default_rng(3), [(members, asking)]
    while todo:
        m, q = todo.pop()
        if not len(m) or not len(q):
            continue
        if len(m) * len(q) > SMALL and len(m) > 1:
            v = vantage(points[m], rng)
            dm, dq = distance(points[m], v), distance(points[q], v)
            r = int(np.median(dm))
            if r == dm.max():
                r -= 1  # so that both sides are smaller than the whole, unless all are at one distance
            if (dm <= r).any():
                todo.append((m[dm <= r], q[dq <= r + bits]))
                todo.append((m[dm > r], q[dq > r - bits]))
                continue
        step = max(1, CELLS // len(m))
        for k in range(0, len(q), step):
            i, j = np.nonzero(distance(points[q[k:k + step], None], points[None, m]) <= bits)
            union.link(q[k + i], m[j])
    union.settle()


def links(points: DataFrame, tree: list, bits: int = BITS, side: int = SIDE) -> DataFrame:
    """(a, b): spanning links of the points (fp long) within ``bits`` of each other."""

    def visit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            fp = f["fp"].to_numpy()
            row, shard, own = visits(fp.view(np.uint64), tree, bits)
            yield pd.DataFrame({"shard": shard.astype(np.int32), "fp": fp[row], "own": own})

    def join(g: pd.DataFrame) -> pd.DataFrame:
        fp, at = np.unique(g["fp"].to_numpy(), return_inverse=True)
        member, asks = np.unique(at[g["as_member"].to_numpy()]), np.unique(at[g["as_asking"].to_numpy()])
        union = Union(len(fp))
        close(fp.view(np.uint64), member, asks, union, bits)
        linked = np.flatnonzero(union.of != np.arange(len(fp)))
        return pd.DataFrame({"a": fp[linked], "b": fp[union.of[linked]]})

    v = stored(points.mapInPandas(visit, "shard int, fp long, own boolean"), "visits")
    size = {r["shard"]: (r["m"], r["q"]) for r in v.groupBy("shard").agg(F.count_if("own").alias("m"), F.count("*").alias("q")).collect()}  # one row a shard
    cut = {s: (-(-m // side) or 1, -(-q // side)) for s, (m, q) in size.items()}
    if not cut:
        return v.select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    count = lambda k: F.create_map(*[F.lit(x) for s, c in cut.items() for x in (s, c[k])])[F.col("shard")]
    v = v.withColumn("ms", count(0)).withColumn("qs", count(1))
    mine, asked = F.pmod(F.xxhash64("fp"), F.col("ms")).cast("int"), F.pmod(F.xxhash64("fp"), F.col("qs")).cast("int")
    v = v.withColumn("mine", mine).withColumn("asked", asked)
    # a point goes to the squares of its column as a visitor and, in its own shard, to those of its row as a member
    squares = F.transform(F.sequence(F.lit(0), F.col("ms") - 1), lambda m: F.struct(m.alias("m"), F.col("asked").alias("q")))
    row = F.transform(F.sequence(F.lit(0), F.col("qs") - 1), lambda q: F.struct(F.col("mine").alias("m"), q.alias("q")))
    s = v.select("shard", "fp", "own", "mine", "asked", F.explode(F.when(F.col("own"), F.array_union(squares, row)).otherwise(squares)).alias("at"))
    s = s.select("shard", "at.m", "at.q", "fp", (F.col("own") & (F.col("mine") == F.col("at.m"))).alias("as_member"), (F.col("asked") == F.col("at.q")).alias("as_asking"))
    return s.groupBy("shard", "m", "q").applyInPandas(join, "a long, b long")


def near(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """(doc_id, fp, component_id), one row per input row."""
    rows = stored(fingerprints(docs), "fingerprints")
    points = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")), "points")
    sample = points.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).select("fp").collect()
    tree = fit(np.array([r[0] for r in sample], np.int64).view(np.uint64))
    edges = stored(links(points.select("fp"), tree, bits), "links")
    comp = components(edges) if not edges.isEmpty() else edges.select(F.col("a").alias("id"), F.col("b").alias("comp"))
    p = points.join(comp.withColumnRenamed("id", "fp"), "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
    least = p.groupBy("comp").agg(F.min("low").alias("component_id"))
    of = stored(p.join(least, "comp").select("fp", "n", "component_id"), "components")
    total = of.agg(F.sum("n")).first()[0] or 0
    heavy = F.broadcast(of.where(F.col("n") * HEAVY > total).select("fp", F.col("component_id").alias("big"), F.lit(True).alias("is_big")))
    tagged = rows.join(heavy, "fp", "left")
    out = tagged.where("is_big").select("doc_id", "fp", F.col("big").alias("component_id"))
    return out.union(tagged.where("is_big is null").join(of.where(F.col("n") * HEAVY <= total).select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id"))


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
