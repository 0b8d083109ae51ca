"""Order MinHash near-duplicates: sketches of ordered minima, verified by banded alignment.

Words as in the decontamination operator; k-mers are runs of ``K`` words (a shorter text is one),
labelled with their occurrence number.  Each of ``SKETCHES`` sketches takes the ``ELL`` labelled
k-mers with the smallest hashes and keeps their text order.  Candidates share a sketch.  Two texts
are linked if the longest chain of equal labelled k-mers in both orders, inside the band that the
threshold allows, covers matched / (n1 + n2 - matched) >= ``SIMILARITY``.  Classes are the
connected components; equal texts are one class.  Null or wordless texts only join equal texts
(null: none).  Rows without a doc_id get a null class.  Extra columns are ignored.

In a bucket all members are first compared with its centre, the member whose buckets are largest
together (of a group of copies, the one most like the others); a bucket that then holds one
component is done.  Of the others, one whose members of different components make at most ``PAIRS`` pairs a member
compares those pairs: its members outside the largest component are then few and meet all members.  The
members of the heavier ones meet in a prefix join: k-mers are ordered by how many of these texts hold them,
rarest first (counts of the ``COMMON`` most frequent ones go to every task, the others come before them by
hash; any one order is exact), and two texts of similarity ``SIMILARITY`` share one of the first n - ceil(SIMILARITY n) + 1, at
places that leave enough k-mers behind both.  Both ways find every link between members of a bucket, however
large it is, and frequent passages are not compared text by text.
Pairs whose k-mer counts or signatures rule out the threshold are left out before any k-mers are joined: a
signature holds the parities of the k-mers' numbers in 1,024 bins, and two of them differ in no more bits than
the texts do in k-mers.
Texts are told apart by their digest, not by doc_id.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwise.llm.store import stored

K, SKETCHES, ELL, SIMILARITY, PAIRS = 5, 24, 3, 0.8, 32
WORD = re.compile(rb"[0-9a-z\x80-\xFF]+")  # of the lower-cased UTF-8 bytes
SLICE = 1024  # members of a bucket that one task compares
WORDS = 16  # of 64 bits, of a signature
BLOCK = 1 << 21  # numbers hashed at a time
COMMON = 1 << 18  # most frequent k-mers whose counts order the prefixes
SHORT, HELD = 4000, 1 << 20  # k-mers of a pair that is compared as sets first; k-mers held in such sets
_R = np.random.default_rng(11)
_MUL = _R.integers(1, 1 << 63, SKETCHES, dtype=np.uint64) | np.uint64(1)
_ADD = _R.integers(1, 1 << 63, SKETCHES, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def kmers(text: str | None) -> np.ndarray:
    """Hashes of the occurrence-labelled k-mers, in text order."""
    import xxhash

    w = WORD.findall((text or "").encode("utf-8", "replace").lower())
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, len(w))
    n = max(1, len(w) - K + 1)
    g = np.zeros(n, np.uint64)
    for j in range(min(K, len(w))):
        g = mix(g * np.uint64(31) + h[j:j + n] + np.uint64(j))
    order = np.argsort(g, kind="stable")
    s = g[order]
    start = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    if len(start) == n:
        return mix(g)
    label = np.empty(n, np.uint64)
    label[order] = (np.arange(n) - np.repeat(start, np.diff(np.r_[start, n]))).astype(np.uint64)
    return mix(g + label * np.uint64(0xD6E8FEB86659FD93))


def sketches(g: np.ndarray) -> np.ndarray:
    """One number for each sketch: of the ELL least labelled k-mers, in text order."""
    n = len(g)
    if not n:
        return np.zeros(0, np.int64)
    at = np.empty((SKETCHES, min(ELL, n)), np.int64)
    step = max(1, BLOCK // n)
    for j in range(0, SKETCHES, step):
        h = mix(g * _MUL[j:j + step, None] + _ADD[j:j + step, None])
        row = np.arange(len(h))
        for e in range(at.shape[1]):
            at[j:j + step, e] = low = h.argmin(1)
            h[row, low] = np.uint64(0xFFFFFFFFFFFFFFFF)
    at.sort(axis=1)
    out = np.arange(SKETCHES, dtype=np.uint64)
    for e in range(at.shape[1]):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + g[at[:, e]])
    return out.view(np.int64)


def signature(g: np.ndarray) -> np.ndarray:
    """Parities of the numbers of k-mers in each of 64 ``WORDS`` bins, as words."""
    odd = np.bincount((g & np.uint64(64 * WORDS - 1)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def alike(n: str, m: str, sig: str, sig2: str, least: float = SIMILARITY) -> Column:
    """Whether the signatures let two texts of n and m k-mers reach the threshold."""
    bits = sum((F.bit_count(F.col(sig)[i].bitwiseXOR(F.col(sig2)[i])) for i in range(WORDS)), F.lit(0))
    return bits <= (F.col(n) + F.col(m)) * ((1 - least) / (1 + least)) + 1e-6


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < least * max(n, m):
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    band = (n + m) * (1 - least) / (1 + least) + 1
    keep = np.abs(i - j) <= band
    i, j = i[keep], j[keep]
    if len(i) < least / (1 + least) * (n + m) - 1e-9:
        return 0.0
    tails: list[int] = []
    for x in j[np.argsort(i)].tolist():
        p = bisect_left(tails, x)
        if p == len(tails):
            tails.append(x)
        else:
            tails[p] = x
    return len(tails) / (n + m - len(tails))


def gram_counts(texts: DataFrame) -> DataFrame:
    """(gram, c) of the k-mers that two or more of the texts hold, at most ``COMMON`` of each part of them.

    A task sums the counts of its own texts, up to ``BLOCK`` k-mers at a time, and gives one row a part: k-mers are not rows
    before their counts are whole.  Parts are ranges of hashes, as many as shuffle partitions.
    """
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = np.array([(1 << 64) * i // parts - (1 << 63) for i in range(1, parts)], np.int64)

    def summed(gram: list[np.ndarray], c: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        u, at = np.unique(np.concatenate(gram), return_inverse=True)
        total = np.zeros(len(u), np.int64)
        np.add.at(total, at, np.concatenate(c))
        return u, total

    def own(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def dealt(u, c):
            low = np.r_[0, np.searchsorted(u, cuts), len(u)]
            full = [i for i in range(parts) if low[i] < low[i + 1]]
            return pd.DataFrame({"part": np.array(full, np.int32), "gram": [u[low[i]:low[i + 1]] for i in full], "c": [c[low[i]:low[i + 1]] for i in full]})

        none = np.zeros(0, np.int64)
        u, c, more, n = none, none, [], 0
        for f in frames:
            for g in f["g"]:
                more.append(np.asarray(g, np.int64))
                n += len(g)
                if n >= BLOCK:
                    u, c = summed([u, *more], [c, np.ones(n, np.int64)])
                    more, n = [], 0
                    if len(u) >= BLOCK:
                        yield dealt(u, c)
                        u, c = none, none
        if len(u) or n:
            yield dealt(*summed([u, *more], [c, np.ones(n, np.int64)]))

    def whole(f: pd.DataFrame) -> pd.DataFrame:
        u, c = summed(f["gram"].tolist(), f["c"].tolist())
        u, c = u[c > 1], c[c > 1]
        top = np.lexsort((u, -c))[:COMMON]
        return pd.DataFrame({"gram": u[top], "c": c[top]})

    return (texts.select("g").mapInPandas(own, "part int, gram array<long>, c array<long>")
            .groupBy("part").applyInPandas(whole, "gram long, c long"))


def components(edges: DataFrame) -> DataFrame:
    """(id, comp) of every end of an edge: least id reachable; each round is a written table."""
    both = stored(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "both")
    lab = both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("comp"))
    while True:
        lab = stored(lab, "label")
        near = both.join(lab.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("m"))
        new = lab.join(near, "id").select("id", "comp", F.least("comp", "m").alias("c1"))
        jump = lab.select(F.col("id").alias("c1"), F.col("comp").alias("c2"))
        new = stored(new.join(jump, "c1").select("id", F.least("c1", "c2").alias("now"), "comp"), "round")
        if new.where("now <> comp").isEmpty():
            return lab
        lab = new.select("id", F.col("now").alias("comp"))


def merged(comp: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, comp) after the edges have joined components; only components that an edge touches are relabelled."""
    end = lambda c: comp.select(F.col("id").alias(c), F.col("comp").alias(f"c{c}"))
    new = stored(edges.join(end("a"), "a").join(end("b"), "b").where("ca <> cb")
                 .select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), "new")
    if new.isEmpty():
        return comp
    to = components(new).select(F.col("id").alias("comp"), F.col("comp").alias("to"))
    return stored(comp.join(to, "comp", "left").select("id", F.coalesce("to", "comp").alias("comp")), "comp")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (least doc_id of the class), one row per input row."""
    own = F.coalesce(F.unhex(F.md5(F.col("text").cast("binary"))), F.concat(F.lit("null "), F.col("doc_id").cast("string")).cast("binary"))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("id", own)
    texts = stored(base.where("doc_id is not null").groupBy("id").agg(F.min("doc_id").alias("low"), F.first("text").alias("text")), "texts")

    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            g = [kmers(t) for t in f["text"]]
            yield pd.DataFrame({"id": f["id"], "n": [len(x) for x in g], "sig": [signature(x) for x in g], "keys": [sketches(x) for x in g]})

    def grams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"id": f["id"], "g": [kmers(t).view(np.int64) for t in f["text"]]})

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets: dict = {}  # of short texts: how many k-mers are equal bounds the chain, and is quick to count
        held = 0

        def of(key, g):
            nonlocal held
            if key not in sets:
                held += len(g)
                if held > HELD:
                    sets.clear()
                    held = len(g)
                sets[key] = frozenset(g.tolist())
            return sets[key]

        for f in frames:
            keep = []
            for a, b, x, y in zip(f["a"], f["b"], f["ga"], f["gb"], strict=True):
                n = len(x) + len(y)
                short = n <= SHORT and len(of(a, x) & of(b, y)) < SIMILARITY / (1 + SIMILARITY) * n - 1e-9
                keep.append(not short and similarity(x, y) >= SIMILARITY)
            yield f.loc[keep, ["a", "b"]]

    sk = stored(texts.select("id", "text").mapInPandas(sketch, "id binary, n int, sig array<long>, keys array<long>"), "sketches")
    member = sk.select("id", "n", F.explode("keys").alias("key"))

    def shared(m: DataFrame) -> DataFrame:
        """(key, id, n, first) of the members of each bucket of two or more; first is the bucket's centre."""
        x = stored(m.join(m.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "key"), "shared")
        x = x.join(x.groupBy("id").agg(F.sum("size").alias("score")), "id").select("key", "id", "n", "score")
        return stored(x.join(x.groupBy("key").agg(F.max(F.struct("score", "id", "n")).alias("first")), "key"), "member")

    def fits(x: str, y: str):
        return F.least(x, y) >= F.greatest(x, y) * (SIMILARITY - 1e-9)

    def star(m: DataFrame) -> DataFrame:
        return m.where(F.col("first.id") != F.col("id")).where(fits("first.n", "n")).select(F.col("first.id").alias("a"), F.col("id").alias("b")).distinct()

    def unresolved(m: DataFrame, comp: DataFrame) -> DataFrame:
        """Members of buckets of several components, with the largest one and the pairs of different components a member."""
        x = m.select("key", "id", "n").join(comp, "id")
        b = (x.groupBy("key", "comp").agg(F.count("*").alias("c"))
             .groupBy("key").agg(F.sum("c").alias("s"), F.sum(F.col("c") * F.col("c")).alias("q"), F.max(F.struct("c", "comp")).alias("most"))
             .where("s * s > q").select("key", F.ceil(F.col("s") / SLICE).cast("int").alias("slices"), F.col("most.comp").alias("most"),
                                        ((F.col("s") * F.col("s") - F.col("q")) / (2 * F.col("s"))).alias("load")))
        return stored(x.join(b, "key"), "unresolved")

    def bucket_pairs(x: DataFrame) -> DataFrame:
        """(a, b) of different components of a bucket.

        One of the two is outside the largest component; such members are at most 4 ``PAIRS`` and go to each slice of their bucket.
        """
        y = (x.where("comp <> most").select(*[F.col(c).alias(f"{c}2") for c in ("key", "id", "comp", "n")],
                                            F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice2")))
        x = x.withColumn("slice", F.pmod(F.xxhash64("id"), F.col("slices")).cast("int"))
        once = (F.col("comp") != F.col("comp2")) & ((F.col("comp") == F.col("most")) | (F.col("id") < F.col("id2")))
        return (x.join(y, (F.col("key") == F.col("key2")) & (F.col("slice") == F.col("slice2")) & once & fits("n", "n2"))
                .select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")).distinct())

    def prefix_pairs(x: DataFrame, known: DataFrame) -> DataFrame:
        """(a, b) of different components that share a k-mer of both prefixes at places that allow the threshold."""
        texts_g = known.join(x.select("id"), "id", "left_semi")
        top = stored(gram_counts(texts_g).orderBy(F.col("c").desc(), "gram").limit(COMMON), "common").toArrow()  # at most COMMON rows
        gram, often = (top[c].to_numpy() for c in ("gram", "c"))
        whole, by = len(gram) < COMMON, np.argsort(gram)
        gram, often = np.r_[gram[by], np.iinfo(np.int64).max], np.r_[often[by], 0]

        def prefix(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                for key, g in zip(f["id"], f["g"], strict=True):
                    g = np.asarray(g, np.int64)
                    at = np.searchsorted(gram, g)
                    c = np.where(gram[at] == g, often[at], 0)
                    first = np.lexsort((g, c))[:len(g) - int(np.ceil(len(g) * SIMILARITY - 1e-9)) + 1]
                    place = np.arange(1, len(first) + 1)
                    if whole:  # a k-mer of one text alone joins nothing
                        first, place = first[c[first] > 0], place[c[first] > 0]
                    yield pd.DataFrame({"key": g[first], "id": key, "place": place})

        rows = (texts_g.mapInPandas(prefix, "key long, id binary, place int").join(x.join(sk.select("id", "sig"), "id"), "id")
                .select("key", "id", "comp", "n", (F.col("n") - F.col("place") + 1).alias("rest"), "sig"))
        rows = stored(rows, "prefix")
        mixed = rows.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("key")
        # dealt by text: a small table of hot k-mers makes many pairs, and is not left to one task
        parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = stored(rows.join(mixed, "key", "left_semi").repartition(parts, "id"), "prefix-mixed")
        y = rows.select(*[F.col(c).alias(f"{c}2") for c in rows.columns])
        enough = F.least("rest", "rest2") >= (F.col("n") + F.col("n2")) * (SIMILARITY / (1 + SIMILARITY)) - 1e-9
        return (rows.join(y, (F.col("key") == F.col("key2")) & (F.col("id") < F.col("id2")) & (F.col("comp") != F.col("comp2")) & fits("n", "n2") & enough & alike("n", "n2", "sig", "sig2"))
                .select(F.col("id").alias("a"), F.col("id2").alias("b")).distinct())

    member = shared(member)
    nodes = member.select("id").distinct()
    known = stored(texts.select("id", "text").join(nodes, "id", "left_semi").mapInPandas(grams, "id binary, g array<long>"), "grams")

    def linked(pairs: DataFrame) -> DataFrame:
        side = lambda c: sk.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("sig").alias(f"s{c}"))
        pairs = pairs.join(side("a"), "a").join(side("b"), "b").where(alike("na", "nb", "sa", "sb")).select("a", "b")
        return stored(pairs.join(known.select(F.col("id").alias("b"), F.col("g").alias("gb")), "b")
                      .join(known.select(F.col("id").alias("a"), F.col("g").alias("ga")), "a")
                      .mapInPandas(verify, "a binary, b binary"), "edges")

    comp = merged(stored(nodes.select("id", F.col("id").alias("comp")), "comp"), linked(star(member)))
    left = unresolved(member, comp)
    heavy = left.where(F.col("load") > PAIRS).select("id", "n", "comp").distinct()
    comp = merged(comp, linked(bucket_pairs(left.where(F.col("load") <= PAIRS)).union(prefix_pairs(heavy, known)).distinct()))
    of = texts.select("id", "low").join(comp, "id", "left").select("id", "low", F.coalesce("comp", "id").alias("comp"))
    least = of.groupBy("comp").agg(F.min("low").alias("class_id"))
    out = of.join(least, "comp").select("id", "class_id")
    return base.select("doc_id", "id").join(out, "id", "left").select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id"))
