"""Pair operators, models and the pipeline against brute force on small fixtures."""

import random

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

import corpus_pipeline
from chunkwise.llm import license_scan, line_dedup, order_minhash, quality_fm, token_count

SF = "/root/testdata/sf0.001"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_within_matches_edit_distance():
    r = random.Random(1)
    for _ in range(3000):
        a = "".join(r.choice("ab") for _ in range(r.randint(0, 9)))
        b = "".join(r.choice("ab") for _ in range(r.randint(0, 9)))
        for k in (0, 1, 2, 3):
            assert line_dedup.within(a, b, k) == (distance(a, b) <= k), (a, b, k)


def test_diagonals_match_edit_distance():
    r = random.Random(9)
    for _ in range(3000):
        a = "".join(r.choice("ab") for _ in range(r.randint(0, 12)))
        b = "".join(r.choice("ab") for _ in range(r.randint(0, 12)))
        for k in (0, 1, 3, 6, 9):
            assert line_dedup.reaches(a, b, k) == line_dedup.alike(a, b, k) == (distance(a, b) <= k), (a, b, k)


def test_line_dedup_brute_force(spark):
    r = random.Random(2)
    bases = ["".join(r.choice("abcdef ") for _ in range(r.randint(30, 40))) for _ in range(12)]

    def vary(s):
        for _ in range(r.randint(0, 3)):
            p = r.randrange(len(s))
            s = s[:p] + r.choice(["", "x", "yz"]) + s[p + r.randint(0, 1):]
        return s

    rows = [(i, "\n".join(vary(r.choice(bases)) for _ in range(4)), "k") for i in range(40)] + [(98, None, "k"), (99, "", "k"), (None, bases[0], "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pos string")
    got = {x.doc_id: x.text for x in line_dedup.dedup_lines(docs).collect()}
    order = sorted((((-1 if d is None else d), p, x) for d, t, _ in rows if t is not None for p, x in enumerate(t.split("\n"))))
    firsts, want = [], {}
    for d, _, x in order:
        gone = len(x) >= line_dedup.MIN_CHARS and any(distance(x, y) <= line_dedup.EDITS for y in firsts)
        if len(x) >= line_dedup.MIN_CHARS and x not in firsts:
            firsts.append(x)
        want.setdefault(None if d < 0 else d, []).extend([] if gone else [x])
    want = {k: "\n".join(v) for k, v in want.items()} | {98: None}
    assert got == want


def test_line_dedup_whole(spark):
    """Edits that grow with the line, repeats of any length, and rows equal in id and text."""
    r = random.Random(6)
    spell = lambda n: "".join(r.choice("abcdefgh é") for _ in range(n))

    def vary(s, most):
        for _ in range(r.randint(0, most)):
            p = r.randrange(len(s))
            s = s[:p] + r.choice(["", "x", "yz"]) + s[p + r.randint(0, 1):]
        return s

    bases = [spell(n) for n in (20, 40, 60, 63, 64, 66, 100, 127, 130, 200, 257, 300, 520, 600)] + ["ab" * 70, "=" * 150]
    rows = [(i, "\n".join(vary(b, 2 + len(b) // 24) for b in r.sample(bases, 6)) + "\n}\n ") for i in range(40)]
    rows += [(50, rows[0][1]), (None, "once\n\ntwo"), (None, "once\n\ntwo"), (60, "twice"), (60, "twice")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), grow=line_dedup.GROW, every=True).collect()
    firsts, seen, want = [], set(), []
    rest = sorted([x for x in rows if x[0] is not None and x[0] != 60])
    for d, t in [(None, "once\n\ntwo")] * 2 + rest + [(60, "twice")] * 2:
        kept = []
        for x in t.split("\n"):
            gone = x.strip() and (x in seen or len(x) >= 32 and any(
                len(y) >= 32 and line_dedup.within(x, y, line_dedup.allowed(max(len(x), len(y)), 2, line_dedup.GROW)) for y in firsts))
            if x not in seen:
                seen.add(x)
                firsts.append(x)
            kept += [] if gone else [x]
        want.append((d, "\n".join(kept)))
    assert sorted(map(str, [(x.doc_id, x.text) for x in got])) == sorted(map(str, want))
    assert line_dedup.allowed(600, 2, line_dedup.GROW) == 19


@pytest.mark.parametrize("pairs", [32, 0])
def test_near_duplicates_brute_force(spark, monkeypatch, pairs):
    monkeypatch.setattr(order_minhash, "PAIRS", pairs)
    r = random.Random(3)
    vocab = [f"w{i}" for i in range(500)]
    rows = []
    for g in range(8):
        t = [r.choice(vocab) for _ in range(120)]
        for _ in range(6):
            rows.append((len(rows), " ".join(t)))
            t = list(t)
            t[r.randrange(120)] = "z" + str(r.random())
    rows += [(200, ""), (201, ""), (202, None), (203, None), (204, "one two"), (205, "One, two!"), (None, "one two"), (0, rows[0][1])]
    got = {x.doc_id: x.class_id for x in order_minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    k = {d: order_minhash.kmers(t) for d, t in rows if d is not None}
    par = {d: d for d in k}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    text = {d: t for d, t in rows if d is not None}
    for a in k:
        for b in k:
            if a < b and ((text[a] is not None and text[a] == text[b]) or order_minhash.similarity(k[a], k[b]) >= 0.8):
                x, y = sorted((find(a), find(b)))
                par[y] = x
    assert got == {d: find(d) for d in k} | {None: None}


@pytest.mark.parametrize("common", [3, 1 << 18])
def test_prefixes_are_ranked_without_a_join(spark, monkeypatch, common):
    """A hot passage in texts of many components: the k-mers are counted and ranked, not joined one by one."""
    joined, join = [], type(spark.range(1)).join
    monkeypatch.setattr(type(spark.range(1)), "join", lambda self, other, on=None, how=None: joined.append(on) or join(self, other, on, how))
    monkeypatch.setattr(order_minhash, "PAIRS", 0)
    monkeypatch.setattr(order_minhash, "COMMON", common, raising=False)
    r = random.Random(8)
    hot = " ".join(f"h{i}" for i in range(60))
    tails = [[f"t{r.randrange(10 ** 6)}" for _ in range(r.randint(8, 24))] for _ in range(12)]
    rows = [(i, f"{hot} {' '.join(t[:len(t) - i % 3])}") for i, t in enumerate(t for t in tails for _ in range(4))]
    got = {x.doc_id: x.class_id for x in order_minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    k = {d: order_minhash.kmers(t) for d, t in rows}
    par = {d: d for d in k}
    for a in k:
        for b in k:
            if a < b and par[a] != par[b] and order_minhash.similarity(k[a], k[b]) >= 0.8:
                low, high = sorted((par[a], par[b]))
                par = {d: low if p == high else p for d, p in par.items()}
    assert got == par and "gram" not in [o for o in joined if isinstance(o, str)]


def test_token_count_matches_library():
    path = public_tokenizers.path("piece_bpe_32k.model")
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    vocab = [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]
    tk = Tokenizer(models.Unigram(vocab, 0, True))
    tk.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    c, r = token_count.UnigramCounter(path), random.Random(4)
    for _ in range(2000):
        t = "".join(r.choice("etaoin shr  é梦🫠\n.,!A1") for _ in range(r.randint(0, 40)))
        assert c.document(t) == len(tk.encode(t).ids), t


def test_token_count_takes_text_pieces_only(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    c = token_count.UnigramCounter(path)
    assert c.document("a<s>b") == 5
    rows = [(1, None, 7), (2, "", 7), (None, "a<s>b", 7), (3, "<0x0A></s><unk>", 7), (3, "<0x0A></s><unk>", 7), (4, "word " * 50000, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(((r.doc_id or 0, r.n_tokens) for r in token_count.count_tokens(docs, path).collect()))
    assert [n for d, n in got if d in (0, 1, 2)] == [5, 0, 0]
    assert got[3] == got[4] and got[3][1] > 4 and got[5][1] >= 50000  # four: a mark and the three special pieces
    assert token_count.count_tokens(docs.limit(0), path).collect() == []


def test_license_scan(spark):
    rows = [(1, "x y\nLicensed under the Apache License, Version 2.0.\nmore"), (2, None), (3, ""), (4, "nothing at all " * 90), (5, "released under the mit license"), (5, "released under the mit license")]
    got = sorted((r.doc_id, r.n_license_units, r.license) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 1, "Apache-2.0"), (2, 0, None), (3, 0, None), (4, 0, None), (5, 1, "MIT"), (5, 1, "MIT")]


def test_license_windows(spark):
    notice = license_scan.TEMPLATES["MIT"]
    mit, gpl = license_scan.TEXTS["MIT"], license_scan.TEXTS["GPL-3.0"]
    rows = [(1, f"Copyright (c) 2020 Foo. {notice}"), (2, f"{notice} See the file LICENSE for details."), (3, "a b " * 50 + notice.replace(" ", "\n")),
            (4, "x = 1\n\n" + mit.replace("\n", "\n# ") + "\nimport os"), (5, "Preface to it.\n" + gpl), (6, f"{notice} Then {license_scan.TEMPLATES['CC-BY-NC-4.0']}")]
    got = {r.doc_id: (r.n_license_units, r.license, r.dice) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, "MIT", 1.0), 2: (1, "MIT", 1.0), 3: (1, "MIT", 1.0), 4: (1, "MIT", 1.0), 5: (1, "GPL-3.0", 1.0), 6: (2, "CC-BY-NC-4.0", 1.0)}


def test_license_texts_before_notices(spark):
    """A text that holds a shared notice is named by the text; every text of the package is named by itself."""
    bsd2 = license_scan.TEXTS["BSD-2-Clause"]
    rows = [(1, "Copyright (c) 2020 Foo\n" + bsd2), (2, license_scan.TEMPLATES["BSD-3-Clause"]), (3, license_scan.TEMPLATES["MIT"] + "\n" + bsd2), (None, bsd2), (4, bsd2 + bsd2)]
    rows += [(10 + i, t) for i, t in enumerate(license_scan.TEXTS.values())]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, dice int, license string")
    got = {r.doc_id: (r.n_license_units, r.license, r.dice) for r in license_scan.scan(docs).collect()}
    assert got[1] == (1, "BSD-2-Clause", 1.0) and got[2] == (1, "BSD-3-Clause", 1.0) and got[None] == got[1]
    assert got[3] == (2, "BSD-2-Clause", 1.0) and got[4][:2] == (1, "BSD-2-Clause")
    assert [got[10 + i][1] for i in range(len(license_scan.TEXTS))] == list(license_scan.TEXTS)


def test_license_scan_brute_force():
    r = random.Random(5)
    templates = [("A", "a b c d e a b f"), ("B", "d e f c")]
    scanner = license_scan.Scanner(templates, 0.8)
    for _ in range(300):
        w = [r.choice("abcdef") for _ in range(r.randint(0, 22))]
        best = []
        for name, t in templates:
            n = set(license_scan.bigrams(t))
            for i in range(len(w)):
                for j in range(i + 2, len(w) + 1):
                    g = set(license_scan.bigrams(" ".join(w[i:j])))
                    best.append((-2 * len(g & n) / (len(g) + len(n)), name))
        d, name = min(best, default=(0, ""))
        assert scanner(" ".join(w))[1:] == ((name, -d) if -d >= 0.8 else (None, None)), w


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    p = quality_fm.score(docs, quality_fm.train(docs, labels)).where(quality_fm.held_out()).join(labels, "doc_id").select("score", "quality").toPandas()
    assert np.mean((p.score >= quality_fm.CUT) == (p.quality == 1)) > 0.95


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 0 < out.count() < 200


def test_pipeline_decides_by_row(spark, tmp_path):
    r = random.Random(8)
    say = lambda n: " ".join(f"v{r.randrange(900)}" for _ in range(n))
    a, b, c, d = say(90), say(90), say(90), say(90)
    rows = [(1, a), (2, a + " end"), (2, b), (3, c), (3, c), (None, d), (None, d), (None, a), (4, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(9, " ".join(d.split()[20:40]))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    look = lambda x: sorted(map(str, ((v.doc_id, v.text) for v in x.collect())))
    near = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert near.columns == docs.columns
    assert look(near) == sorted(map(str, [(1, a), (2, b), (3, c), (None, d), (4, None), (None, None)]))
    clean = corpus_pipeline.benchmark(spark, docs, str(tmp_path))
    assert look(clean) == sorted(map(str, [x for x in rows if x[1] != d]))


def test_line_dedup_clashing_columns(spark):
    names = ["copy_", "gone_", "d_", "t_", "th_", "r_", "lead_", "rest", "d", "th", "pos", "k", "line", "at", "n_lines"]
    text = "one line that is long enough to be compared\nshort\none line that is long enough to be compared"
    docs = spark.createDataFrame([(1, text, *range(len(names))), (1, text, *range(len(names))), (None, None, *range(len(names)))],
                                 "doc_id long, text string, " + ", ".join(f"{c} int" for c in names))
    got = line_dedup.dedup_lines(docs, grow=line_dedup.GROW, every=True)
    assert got.columns == ["doc_id", "text", *names[:-1], "n_lines", "n_removed"]
    rows = got.collect()
    assert all([r[c] for c in names[:-1]] == list(range(len(names) - 1)) for r in rows)
    assert sorted(("-" if r["text"] is None else r["text"], r["n_removed"]) for r in rows) == [("", 3), ("-", 0), (text.rsplit("\n", 1)[0], 1)]


def test_rows_without_an_id_are_not_held_out(spark):
    d = spark.createDataFrame([(None,), (5,), (6,)], "doc_id long").select(quality_fm.held_out().alias("h")).collect()
    assert all(r["h"] in (True, False) for r in d) and d[0]["h"] is False


@pytest.mark.parametrize("pairs", [1000, 32, 0])
def test_near_duplicates_short_texts_in_hot_buckets(spark, monkeypatch, pairs):
    """A passage that all texts share, with short endings: links against all pairs, none false and none missed."""
    monkeypatch.setattr(order_minhash, "PAIRS", pairs)
    r = random.Random(12)
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(i, " ".join([passage, *[f"e{r.randrange(6)}" for _ in range(r.randint(1, 9))]])) for i in range(300)]
    rows += [(300 + i, " ".join(f"p{j}" for j in range(r.randint(5, 9)))) for i in range(30)]
    got = {x.doc_id: x.class_id for x in order_minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    k = {d: order_minhash.kmers(t) for d, t in rows}
    par = {d: d for d in k}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    links = [(a, b) for a in k for b in k if a < b and order_minhash.similarity(k[a], k[b]) >= 0.8]
    for a, b in links:
        x, y = sorted((find(a), find(b)))
        par[y] = x
    assert len(links) > 1000 and len({find(d) for d in k}) > 20
    assert all(got[d] <= d and find(got[d]) == find(d) for d in k)
    assert sum(got[a] == got[b] for a, b in links) >= 0.99 * len(links)


def test_signatures_bound_the_difference(spark):
    r = np.random.default_rng(5)
    pool = r.integers(0, 1 << 63, 4000, dtype=np.uint64)
    sets = [np.unique(r.choice(pool, n)) for n in (1, 30, 200, 900, 2000) for _ in range(6)] + [np.zeros(0, np.uint64)]
    sig = [order_minhash.signature(x) for x in sets]
    for a, s in zip(sets, sig, strict=True):
        for b, t in zip(sets, sig, strict=True):
            assert sum(int(x).bit_count() for x in (s ^ t).view(np.uint64)) <= len(np.setxor1d(a, b))
    rows = spark.createDataFrame([(4, 5, sig[0].tolist(), sig[1].tolist()), (9, 9, sig[7].tolist(), sig[7].tolist())], "n int, m int, s array<long>, t array<long>")
    assert [x[0] for x in rows.select(order_minhash.alike("n", "m", "s", "t")).collect()] == [False, True]


@pytest.mark.parametrize(("block", "common"), [(40, 1 << 18), (1 << 21, 5)])
def test_kmers_are_counted_without_a_row_each(spark, monkeypatch, capsys, block, common):
    """Counts of k-mers held by two or more texts, against a plain count; null, empty, least and largest ones included."""
    from collections import Counter

    r = random.Random(4)
    monkeypatch.setattr(order_minhash, "BLOCK", block)
    monkeypatch.setattr(order_minhash, "COMMON", common)
    edge = [-(1 << 63), (1 << 63) - 1, 0, -1]
    rows = [(sorted({r.choice(edge + list(range(5, 30))) * (1 if r.random() < 0.5 else 1 << 58) % (1 << 63) for _ in range(r.randrange(12))} | set(r.sample(edge, 2))),) for _ in range(60)] + [([],)]
    texts = spark.createDataFrame(rows, "g array<long>").repartition(5)
    got = order_minhash.gram_counts(texts)
    got.explain()
    assert "Generate" not in capsys.readouterr().out
    got = {x.gram: x.c for x in got.collect()}
    want = {g: c for g, c in Counter(g for x, in rows for g in x).items() if c > 1}
    assert got == want if common > 100 else got.items() <= want.items() and {c for _, c in sorted(want.items(), key=lambda x: -x[1])[:common]} <= set(got.values())
    assert order_minhash.gram_counts(texts.limit(0)).collect() == []


def test_line_dedup_first_grams():
    """Lines within their edits share a first gram, and a line has few of them: they decide what the join shuffles."""
    r = random.Random(21)
    spell = lambda n: "".join(r.choice("abcdefgh é") for _ in range(n))
    none = np.zeros(line_dedup.SLOTS, np.uint8)
    for j, (low, _, q, _) in enumerate(line_dedup.kinds(2, line_dedup.GROW, 32)):
        lines = [spell(r.randint(max(low, 32), max(low, 32) * 2 - 1)) for _ in range(60)] + ["=" * max(low, 40)]
        for x in lines[:60]:
            for _ in range(line_dedup.allowed(len(x), 2, line_dedup.GROW)):
                p = r.randrange(len(x))
                x = x[:p] + r.choice(["", "x", "y" + x[p]]) + x[p + 1:]
            lines.append(x)
        e = line_dedup.reach(np.array([len(x) for x in lines]), 2, line_dedup.GROW)
        of, key, _, _ = line_dedup.prefixes(lines, e, q, none)
        held = [set(key[of == i].tolist()) for i in range(len(lines))]
        assert all(held[i] & held[61 + i] for i in range(60)), j
        assert len(key) <= 2 * (e + 1).sum(), j


def test_line_dedup_verifies_in_batches():
    r = random.Random(22)
    a = ["".join(r.choice("abc é") for _ in range(r.randint(30, 200))) for _ in range(200)]
    b = []
    for x in a:
        for _ in range(r.randint(0, 8)):
            p = r.randrange(len(x))
            x = x[:p] + r.choice(["", "x", "yz"]) + x[p + r.randint(0, 1):]
        b.append(x)
    most = [line_dedup.allowed(max(len(x), len(y)), 2, line_dedup.GROW) for x, y in zip(a, b, strict=True)]
    assert line_dedup.all_near(a, b, 2, line_dedup.GROW).tolist() == [distance(x, y) <= k for x, y, k in zip(a, b, most, strict=True)]
    assert line_dedup.banded(a, b, np.array(most)).tolist() == [distance(x, y) <= k for x, y, k in zip(a, b, most, strict=True)]


def test_line_dedup_large_group(spark):
    """Lines alike in one large group: those to remove are found, without a row for each pair, and a pair is met once."""
    r = random.Random(23)
    base = [f"{r.choice('abcdefgh')}{r.randrange(1000)}x" for _ in range(60)]

    def vary(edits):
        w = list(base)
        for _ in range(edits):
            w[r.randrange(60)] = f"{r.choice('abcdefgh')}{r.randrange(1000)}y"
        return " ".join(w)

    lines = [vary(r.randint(1, 8)) for _ in range(160)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {x.doc_id: x.n_removed for x in line_dedup.dedup_lines(docs, grow=line_dedup.GROW, every=True).collect()}
    most = lambda x, y: line_dedup.allowed(max(len(x), len(y)), 2, line_dedup.GROW)
    want = {i: int(any(line_dedup.within(x, y, most(x, y)) for y in lines[:i])) for i, x in enumerate(lines)}
    assert got == want and 20 < sum(want.values()) < 140
    found = line_dedup.candidates(docs.selectExpr("xxhash64(text) h", "length(text) n", "text line"), sum(map(len, lines)), 2, line_dedup.GROW, 32).collect()
    assert sum(x.grams > 0 for x in found) < 160 * line_dedup.HOT  # all pairs: 12,720
    rows = [(k, i, len(x), i, s, True, [0, 1, 2]) for i, (x, s) in enumerate(zip(lines, line_dedup.sketch(lines), strict=True)) for k in range(3)]
    f = pd.DataFrame(rows, columns=["key", "id", "n", "place", "sketch", "open", "least"])
    pairs = line_dedup.neighbours(f, 2, line_dedup.GROW, False)
    met = set(zip(pairs["late"], pairs["early"], strict=True))
    assert len(pairs) == len(met) and all((i, j) in met for i in range(160) for j in range(i) if line_dedup.within(lines[i], lines[j], most(lines[i], lines[j])))
    first = line_dedup.neighbours(f, 2, line_dedup.GROW, True)
    assert set(first["late"]) == {i for i, _ in met} and set(zip(first["late"], first["early"], strict=True)) <= met
