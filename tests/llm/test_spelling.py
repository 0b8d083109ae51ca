"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from chunkwise.llm import spelling

SF = "/root/testdata/sf0.001"


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows):
    count = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    v = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    near_of = {w: [x for x in v if near(w, x)] for w in v}
    form = {w: min(x, key=lambda y: (-v[y], y)) if x else None for w, x in near_of.items()}
    form = {w: x if x and v[x] >= 2 * v[w] else None for w, x in form.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return [(w, n, len(near_of[w]), form[w], v[form[w]] if form[w] else None, root(w)) for w, n in v.items()]


def same(got, rows):
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain(rows)))


def test_documents_equal_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    same(spelling.variants(docs), [(r.doc_id, r.text) for r in docs.collect()])


def test_edge_rows(spark):
    base = ["about", "abouut", "aabout", "bout", "abot", "abxut", "éabout", "aaaaa", "aaaaaa", "aaaaaaa", "bbaaa", "abcab", "abcaab", "Ünder", "ünder"]
    r = random.Random(3)
    rows = [(i, " ".join(r.choices(base, [9, 3, 3, 2, 2, 1, 1, 1, 2, 2, 1, 1, 2, 1, 2], k=40)) + "×÷ 5x") for i in range(30)]
    rows += [(None, "about abouut " * 20), (None, None), (90, ""), (90, ""), (91, "ab" * 3000 + " "), (92, "ab" * 3000 + "x"), ((1 << 60) + 1, "about " * 500)]
    rows += [(93 + i, "ab" * 3000) for i in range(6)] + [(99 + i, "ab" * 3000 + "x") for i in range(4)]
    docs = spark.createDataFrame([(d, t, "k", 1, "f") for d, t in rows], "doc_id long, text string, word string, n long, form string")
    same(spelling.variants(docs), rows)
    assert spelling.variants(docs.limit(0)).collect() == []
    same(spelling.variants(docs.where("doc_id = 91")), [])


@pytest.mark.parametrize(("shard", "side"), [(1 << 14, 1 << 17), (60, 1 << 17), (1 << 14, 50)])
def test_near_words_equal_all_pairs(spark, monkeypatch, shard, side):
    r = random.Random(8)
    v = {"".join(r.choice("abé") for _ in range(r.randint(5, 8))): r.randint(3, 9) for _ in range(500)}
    got = {x.word: (x.n_near, x.best_n, x.best) for x in spelling.near_words(spark.createDataFrame(list(v.items()), "word string, n long"), shard, side).collect()}
    want = {}
    for w in v:
        x = [y for y in v if near(w, y)]
        if x:
            b = min(x, key=lambda y: (-v[y], y))
            want[w] = (len(x), v[b], b)
    assert got == want


def test_index_grows_on_both_sides():
    """Intervals hold as many ranks as the string has occurrences, whichever way they grew."""
    r, block = random.Random(2), sorted({"".join(random.Random(k).choice("ab") for _ in range(6)) for k in range(30)})
    index, text = spelling.Index(block), "#" + "#".join(block) + "#"
    for _ in range(200):
        at = r.randrange(len(text) - 1)
        lo = hi = at
        s = np.array([[0, 0, len(index.suffix)]])
        code = lambda c: np.array([spelling.END if c == "#" else 2 + "ab".index(c)])
        s, _ = index.extend(s, code(text[at]), True)
        for _ in range(5):
            if r.random() < .5 and lo > 0:
                lo -= 1
                s, _ = index.extend(s, code(text[lo]), True)
            elif hi < len(text) - 1:
                hi += 1
                s, _ = index.extend(s, code(text[hi]), False)
        sub = text[lo:hi + 1]
        places = sorted(k for k in range(len(text)) if text.startswith(sub, k))
        assert sorted(index.suffix[s[0, 0]:s[0, 0] + s[0, 2]].tolist()) == places


def test_blocks_cover_all_words(monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 20)
    listed = ["a" * k for k in (5, 5, 30, 5, 12, 2)]
    spans = list(spelling.blocks(listed))
    assert [w for a, b in spans for w in listed[a:b]] == listed and len(spans) > 2
    r = random.Random(5)
    v = sorted({"".join(r.choice("ab") for _ in range(r.randint(5, 7))) for _ in range(60)})
    got = Counter()
    for reverse in (False, True):
        for row in spelling.lookup(v, v, np.ones(len(v), np.int64), reverse).itertuples():
            got[row.word] += row.n_near
    assert got == Counter({w: c for w in v if (c := sum(near(w, x) for x in v))})
