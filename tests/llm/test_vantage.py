"""SimHash joined by vantage-point trees against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from chunkwise.llm import vantage

SF = "/root/testdata/sf0.001"


def plain_print(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    hs = [xxhash.xxh64(" ".join(w[i:i + 4]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def plain_components(points, bits=4):
    points = sorted(set(points))
    of = {p: p for p in points}

    def top(p):
        while of[p] != p:
            p = of[p]
        return p

    for i, p in enumerate(points):
        for q in points[:i]:
            if (p ^ q).bit_count() <= bits:
                a, b = top(p), top(q)
                of[max(a, b)] = min(a, b)
    return {p: top(p) for p in points}


def want(rows):
    fps = [(d, plain_print(t)) for d, t in rows]
    comp = plain_components([f for _, f in fps])
    low = {}
    for d, f in fps:
        if d is not None:
            low[comp[f]] = min(d, low.get(comp[f], d))
    return [(d, f"{f:016x}", low.get(comp[f])) for d, f in fps]


def same(got, rows):
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want(rows)))


def test_documents_equal_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    same(vantage.digest(vantage.near(docs)), [(r.doc_id, r.text) for r in docs.collect()])


def test_edge_rows(spark):
    r = random.Random(4)
    base = [r.choice("abcdefgh") + str(r.randrange(50)) for _ in range(400)]
    rows = [(i, " ".join(base[:150 + i // 3] + [f"w{i}"] * (i % 3))) for i in range(60)]
    rows += [(None, None), (None, None), (None, " ".join(base[:150])), (70, ""), (71, " \t\n"), (72, "a b"), (73, "A  B"), (73, "A  B"), (74, "a b c d É"),
             ((1 << 60) + 1, "É é a b c d"), (75, "x " * 60_000)]
    docs = spark.createDataFrame([(d, t, 1, "k", 5) for d, t in rows], "doc_id long, text string, fp long, own string, component_id int")
    same(vantage.digest(vantage.near(docs)), rows)
    alone = spark.createDataFrame([(None, "some text"), (None, None)], "doc_id long, text string")
    same(vantage.digest(vantage.near(alone)), [(None, "some text"), (None, None)])
    assert vantage.near(docs.limit(0)).collect() == []


@pytest.mark.parametrize("side", [1 << 18, 40])
def test_links_equal_all_pairs(spark, side):
    """Chains and dense groups of points, in one task a shard and in squares of few points."""
    r, points = random.Random(1), []
    for _ in range(60):
        p = r.getrandbits(64)
        for _ in range(r.choice([1, 2, 30])):
            points.append(p)
            for _ in range(r.choice([1, 3, 4, 5])):
                p ^= 1 << r.randrange(64)
    signed = np.array(points, np.uint64).view(np.int64).tolist()
    tree = vantage.fit(np.array(points[:300], np.uint64), 4)
    edges = vantage.links(spark.createDataFrame([(p,) for p in set(signed)], "fp long"), tree, side=side).collect()
    assert len(edges) < 40 * len(points)
    word = lambda x: int(np.int64(x).view(np.uint64))
    found = {p: p for p in points}

    def top(p):
        while found[p] != p:
            p = found[p]
        return p

    for e in edges:
        a, b = top(word(e.a)), top(word(e.b))
        found[max(a, b)] = min(a, b)
    assert {p: top(p) for p in points} == plain_components(points)


def test_visits_meet_every_pair():
    r = np.random.default_rng(5)
    x = r.integers(0, 1 << 63, 3000, dtype=np.uint64)
    y = x ^ (np.uint64(1) << r.integers(0, 64, 3000).astype(np.uint64)) ^ (np.uint64(1) << r.integers(0, 64, 3000).astype(np.uint64))
    both = np.concatenate([x, y])
    row, shard, own = vantage.visits(both, vantage.fit(x, 6))
    home = dict(zip(row[own].tolist(), shard[own].tolist(), strict=True))
    at = set(zip(row.tolist(), shard.tolist(), strict=True))
    assert len(home) == len(both)
    assert all((i, home[i + 3000]) in at or (i + 3000, home[i]) in at for i in range(3000))
    assert len(row) < 20 * len(both)
