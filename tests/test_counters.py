"""Python token counters: filters and packing equal a plain loop that re-counts every growing string."""

import re

import pytest
from pyspark.sql import functions as F

from chunkwise.functions import text as T
from chunkwise.functions.counters import WordCounter
from chunkwise.operators import filters as FL
from chunkwise.operators import models as MD

EDGES = ["", "   ", "one", "Short sentence. Another one! 3 more; Yes", "w0 " * 40, "alpha beta, gamma,, delta epsilon zeta, eta theta iota kappa lambda mu nu, xi, ",
         "a-b-c d.e.f g/h/i j k l m n", "Jane summary Led teams. Skills: SQL; Python 5 years experience. education and training BS 1999! ok? Yes",
         "Été commence. " * 9, "x," * 50 + " end", "supercalifragilistic " * 6 + ", tail words here", ",,,", "alpha, alpha, alpha, alpha, alpha beta gamma delta epsilon"]


def make_syllables():
    """Tokens of a word: one for each three letters begun, one for each other character."""
    def count(words):
        return [sum(-(-len(m) // 3) if m[0].isalnum() else 1 for m in re.findall(r"\w+|\W", w)) for w in words]
    return count


def recount(text, space, comma):
    """Tokens of a whole text, from its characters alone."""
    words = text.split()
    return sum(make_syllables()(words)) + space * max(0, len(words) - 1)


def plain_pieces(unit, budget, n):
    if n(unit) <= budget:
        return [unit]
    parts = [p.strip() for p in unit.split(",") if p.strip()]
    words = lambda s: [" ".join(s.split()[i:i + budget]) for i in range(0, len(s.split()), budget)]
    if len(parts) <= 1:
        return words(unit)
    out, cur = [], ""
    for p in parts:
        both = p if not cur else f"{cur}, {p}"
        if n(both) <= budget:
            cur = both
            continue
        if cur:
            out.append(cur)
        cur = ""
        if n(p) > budget:
            out += words(p)
        else:
            cur = p
    return out + ([cur] if cur else [])


def plain_chunks(units, budget, most, n):
    out, cur = [], ""
    for p in (x for u in units for x in plain_pieces(u, budget, n)):
        both = p if not cur else f"{cur} {p}"
        if cur and n(both) > budget:
            out.append(cur)
            cur = p
        else:
            cur = both
    return (out + ([cur] if cur else []))[:most]


@pytest.mark.parametrize(("space", "comma"), [(0, 1), (1, 2)])
def test_chunks_equal_recounting(spark, space, comma):
    # a space counts one token in the second case, so ", " counts two
    n = lambda s: recount(s, space, comma)
    counter = WordCounter(make_syllables, space, comma)
    df = spark.createDataFrame([(i % 3 if i else None, t) for i, t in enumerate([*EDGES, EDGES[3]])], "doc_id int, text string").repartition(3)
    df = df.withColumn("units", T.split_units("text"))
    got = T.with_chunks(df, "text", "ch", 9, 4, counter)
    assert got.columns == ["doc_id", "text", "units", "ch"]
    rows = got.collect()
    assert len(rows) == len(EDGES) + 1
    for r in rows:
        want = plain_chunks(r["units"], 9, 4, n)
        assert [c["chunk"] for c in r["ch"]] == want, r["text"]
        assert [c["n_tokens"] for c in r["ch"]] == [n(c) for c in want]


def test_native_counter_through_the_python_path(spark):
    """The default rule as a Python counter gives the native chunks on real texts."""
    def make():
        rule = re.compile(r"[A-Za-z0-9_]+|[^\sA-Za-z0-9_]")
        return lambda words: [len(rule.findall(w)) for w in words]

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", T.clean_text("text").alias("text"))
    a = T.with_chunks(docs, "text", "ch", 128, 8, full=True)
    b = T.with_chunks(docs, "text", "ch", 128, 8, WordCounter(make), full=True)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    dropped = b.select(F.sum("ch.dropped_chunks").alias("d"), F.sum(F.col("ch.total_chunks") - F.size("ch.chunks")).alias("t")).first()
    assert dropped["d"] == dropped["t"] > 0


def test_filters_take_the_counter(spark):
    counter = WordCounter(make_syllables)
    df = spark.createDataFrame([(t,) for t in [*EDGES, None]], "text string")
    n = [recount(t, 0, 1) for t in EDGES]
    assert FL.filter_min_tokens(df, 5, counter=counter).count() == sum(x >= 5 for x in n)
    kept, counts = FL.filter_with_reason(df, FL.Limits(None, 5, 20), counter=counter)
    assert kept.count() == sum(5 <= x <= 20 for x in n)
    assert sum(r["n"] for r in counts.collect()) == len(EDGES) + 1


def test_the_dictionary_stays_bounded(monkeypatch):
    from chunkwise.functions import counters

    monkeypatch.setattr(counters, "KNOWN", 3)
    words = {}
    for t in EDGES:
        assert counters.count_strings([t], make_syllables(), words, 0)[0] == recount(t, 0, 1)
    with pytest.raises(ValueError, match="counts for"):
        counters.count_strings(["a b"], lambda w: [1], {}, 0)


def test_prediction_packs_by_the_model_counter(spark):
    model = MD.default_model(4)
    model.counter, model.max_tokens = "tests.test_counters:make_syllables", 9
    df = spark.createDataFrame([(t,) for t in EDGES], "text string")
    got = {r["text"]: r["v"] for r in MD.document_vectors(df, model, out="v", clean=False).collect()}
    chunks = T.with_chunks(df, "text", "ch", 9, 4, WordCounter(make_syllables)).select("text", T.pad_chunks(T.chunk_texts("ch"), 4).alias("p"))
    want = chunks.select("text", MD.V.pool_attention_rows(F.transform("p.chunks", lambda c: MD.hashed_vector(c)), F.col("p.chunk_mask"), model.att_w, model.att_b, model.att_v).alias("v"))
    assert {r["text"]: r["v"] for r in want.collect()} == got
