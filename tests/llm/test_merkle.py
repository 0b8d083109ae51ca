"""The Merkle manifest against a plain statement of its contract, and multiproofs of a few leaves."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from chunkwise.llm import merkle

DOC = "doc_id long, source string, lang string, n_chars long, text string, tree long, idx long, h string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def fold8(level):
    yield level
    while len(level) > 1:
        level = [h(*level[i:i + 8]) for i in range(0, len(level), 8)]
        yield level


def climb(levels, i, leaf=None):
    """(siblings, folded) of leaf i, bottom up."""
    out, cur = [], leaf or levels[0][i]
    for level in levels[:-1]:
        lo = i // 8 * 8
        run = level[lo:lo + 8]
        out += [x for k, x in enumerate(run) if lo + k != i]
        run[i - lo] = cur
        cur, i = h(*run), i // 8
    return out, cur


def plain(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append((r, h(*map(enc, r[:5]))))
    order = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        by[lang].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[lang] = list(fold8([x[1] for x in by[lang]]))
    top = list(fold8([trees[x][-1][0] for x in order]))
    for k, lang in enumerate(order):
        for i, (r, leaf) in enumerate(by[lang]):
            alt = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
                alt = h(*map(enc, (*r[:4], low)))
            sib, fold = climb(trees[lang], i, alt)
            more, fold = climb(top, k, fold)
            yield r[0], leaf, trees[lang][-1][0], top[-1][0], h(*sib, *more), fold, fold == top[-1][0]


def fixture(n):
    langs = ["en", "en", "en", None, "", "de", "fr", "en", "Éo", "z", "y", "x", "w"]
    rows = [(i * 7 % n if i % 5 else None, f"s{i % 3}", langs[i % 13] if i % 4 else "en", i, None if i % 11 == 0 else "" if i % 17 == 0 else f"Text É {i}", 1, 2, "x")
            for i in range(n)]
    return [*rows, rows[-1], rows[-1], (1 << 60, None, "en", None, "B" * 100_000, 1, 2, "x")]


@pytest.mark.parametrize(("n", "depth"), [(700, 1), (700, 4), (1, 4), (9, 2)])
def test_manifest_equals_plain_trees(spark, monkeypatch, n, depth):
    monkeypatch.setattr(merkle, "FREE", 0)
    rows = fixture(n)
    got = merkle.audit(merkle.manifest(spark.createDataFrame(rows, DOC), depth))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = sorted(map(str, plain(rows)))
    assert sorted(str(tuple(r)) for r in got.collect()) == want


def test_one_language_and_one_row(spark):
    rows = [(5, "s", "en", 3, "abc")]
    got = merkle.audit(merkle.manifest(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")))
    r = got.collect()
    assert [tuple(x) for x in r] == list(plain(rows)) and r[0].root == r[0].leaf


def test_empty_table(spark):
    assert merkle.audit(merkle.manifest(spark.createDataFrame([], DOC))).collect() == []


def test_few_leaves_need_few_nodes(spark, monkeypatch):
    """Multiproofs of some leaves: the union of missing nodes is the least, and every proof folds."""
    rows, _ = merkle.leaves(spark.createDataFrame(fixture(700), DOC))
    level = rows.select("tree", F.lit(0).alias("level"), "idx", "size", F.col("leaf").alias("h"))
    nodes = merkle.nodes(level).cache()
    some = rows.where("idx % 19 in (0, 1, 5)").select("tree", "idx", "size", F.col("leaf").alias("h"))
    got = merkle.prove(some, nodes).collect()
    assert len(got) == some.count()
    tops = {r.tree: r.h for r in nodes.where("size = 1").collect()}
    assert all(merkle.fold(bytes(r.h), r.places, [bytes(s) for s in r.siblings]) == bytes(tops[r.tree]) for r in got)
    have, lack = {0, 1, 9}, []
    for level, at in merkle.missing(merkle.np.array([9, 0, 1, 0]), 20):
        lack += [(level, i) for i in at.tolist()]
    assert have and lack == [(0, i) for i in (2, 3, 4, 5, 6, 7, 8, 10, 11, 12, 13, 14, 15)] + [(1, 2)]
