"""Text operators: FIXTURES section 4 edge rows and a brute-force comparison
on the driver's documents."""

import pytest
from pyspark.sql import functions as F

from chunkwise.functions import text as T
from tests.conftest import SF_SMALL

W14 = " ".join(f"w{i}" for i in range(14))

# (input, cleaned, units, tokens, chunks at budget 6 / 3 chunks, tokens per chunk)
EDGE_ROWS = [
    ('  ""Foo , bar,,baz\r\n\r\n x , y  q\t\tw "', "Foo, bar, , baz x, y q w",
     ["Foo, bar, , baz x, y q w"], 11, ["Foo, bar, baz x", "y q w"], [6, 3]),
    ("Sales锛? Marketing路Lead", "Sales, Marketing Lead", ["Sales, Marketing Lead"], 4,
     ["Sales, Marketing Lead"], [4]),
    ("Jane summary Led teams. Skills: SQL; Python 5 years experience. education and training BS 1999! ok? Yes",
     None,
     ["Jane", "Summary", "Led teams.", "Skills", ": SQL;", "Python 5 years", "Experience", ".", "Education",
      "and Training", "BS 1999! ok?", "Yes"], 23,
     ["Jane Summary Led teams. Skills", ": SQL; Python 5 years", "Experience . Education and Training"], [6, 6, 5]),
    ("Professional Experience at X", None, ["Professional", "Experience", "at X"], 4,
     ["Professional Experience at X"], [4]),
    ("v1.5 is e.g. lower. case; here", None, ["v1.5 is e.g. lower. case; here"], 13,
     ["v1.5 is e.g. lower. case; here"], [13]),
    (W14, None, [W14], 14, ["w0 w1 w2 w3 w4 w5", "w6 w7 w8 w9 w10 w11", "w12 w13"], [6, 6, 2]),
    ("alpha beta, gamma,, delta epsilon zeta, eta theta iota kappa lambda mu nu, xi, ",
     "alpha beta, gamma, , delta epsilon zeta, eta theta iota kappa lambda mu nu, xi,",
     ["alpha beta, gamma, , delta epsilon zeta, eta theta iota kappa lambda mu nu, xi,"], 20,
     ["alpha beta, gamma", "delta epsilon zeta", "eta theta iota kappa lambda mu"], [4, 3, 6]),
    ("a-b-c d.e.f g/h/i j k l m n", None, ["a-b-c d.e.f g/h/i j k l m n"], 20,
     ["a-b-c d.e.f g/h/i j k l", "m n"], [18, 2]),
    ("   ", "", [], 0, [], []),
    ("Fin. Été commence. Next one", None, ["Fin. Été commence.", "Next one"], 9,
     ["Fin. Été commence.", "Next one"], [7, 2]),
]


@pytest.fixture(scope="module")
def edge(spark):
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(EDGE_ROWS)], "id int, raw string")
    df = df.withColumn("clean", T.clean_text("raw"))
    df = df.withColumn("units", T.split_units("clean")).withColumn("n", T.count_tokens("clean"))
    df = T.with_chunks(df, "clean", "chunks", max_tokens=6, max_chunks=3)
    df = df.withColumn("pad", T.pad_chunks(T.chunk_texts("chunks"), 3))
    out = df.orderBy("id").collect()
    return out


@pytest.mark.parametrize("i", range(len(EDGE_ROWS)))
def test_edge_row(edge, i):
    raw, cleaned, units, n, chunks, per_chunk = EDGE_ROWS[i]
    row = edge[i]
    assert row["clean"] == (raw if cleaned is None else cleaned)
    assert list(row["units"]) == units
    assert row["n"] == n
    assert [c["chunk"] for c in row["chunks"]] == chunks
    assert [c["n_tokens"] for c in row["chunks"]] == per_chunk


def test_pad_empty(edge):
    pad = edge[8]["pad"]
    assert list(pad["chunks"]) == ["", "", ""]
    assert list(pad["chunk_mask"]) == [1, 0, 0]


def test_pad_short(edge):
    pad = edge[3]["pad"]
    assert list(pad["chunks"]) == ["Professional Experience at X", "", ""]
    assert list(pad["chunk_mask"]) == [1, 0, 0]


@pytest.mark.parametrize("budget", [510, 40, 7])
def test_chunk_invariants_on_documents(spark, budget):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(T.clean_text("text").alias("clean"))
    got = T.with_chunks(docs, "clean", "ch", budget, 100_000)
    got = got.withColumn("again", F.transform("ch", lambda c: T.count_tokens(c["chunk"]))).collect()
    for r in got:
        assert [c["n_tokens"] for c in r["ch"]] == list(r["again"])
        assert all(c["chunk"].strip() for c in r["ch"])


def test_split_long_unit_and_words(spark):
    df = spark.createDataFrame([("a b c d e f g",), ("",)], "u string")
    got = df.select(T.split_by_words("u", 3).alias("w")).collect()
    assert list(got[0]["w"]) == ["a b c", "d e f", "g"]


def test_clean_text_is_stable_and_linear(spark):
    df = spark.createDataFrame([("a" + " " * 200_000 + ", b" + "路" * 50_000 + "c",), ('  "x ,y" ',)], "t string")
    got = [r[0] for r in df.select(T.clean_text("t")).collect()]
    assert got == ["a, b c", "x, y"]


def test_total_chunks_reports_the_cut(spark):
    # 14 words at budget 6 give 3 chunks; keeping 2 drops one
    df = spark.createDataFrame([(W14,)], "t string")
    r = df.select(T.chunk_table("t", max_tokens=6, max_chunks=2).alias("c")).collect()[0]["c"]
    assert [c["chunk"] for c in r["chunks"]] == ["w0 w1 w2 w3 w4 w5", "w6 w7 w8 w9 w10 w11"]
    assert r["total_chunks"] == 3 and r["units"] == 1


def test_over_budget_unit_kept_whole(spark):
    # a unit without commas or spaces past the budget stays one chunk
    df = spark.createDataFrame([("a-b-c-d-e-f-g. Next",)], "t string")
    r = df.select(T.chunk_table("t", max_tokens=5, max_chunks=4).alias("c")).collect()[0]["c"]
    assert [(c["chunk"], c["n_tokens"]) for c in r["chunks"]] == [("a-b-c-d-e-f-g.", 14), ("Next", 1)]


def test_clean_text_equals_its_steps(spark):
    """Random mixtures of whitespace, quotes, commas and repairs against the reference's order of steps in Python."""
    import random
    import re
    import time

    r = random.Random(5)
    bits = [" ", "  ", "\t", "\n", "\x1c", "\x85", " ", "　", ",", " ,", '"', '""', T.MOJIBAKE_COMMA, T.MOJIBAKE_SPACE, "?", "a", "B_9", "é", "\x0b", "\x7f", "\U0001f600", "-"]
    rows = [(i, "".join(r.choices(bits, k=r.randrange(14)))) for i in range(6000)] + [(-1, None), (-2, "")]

    def steps(s):
        s = re.sub(r"\s+", " ", s).strip().strip('"').replace(T.MOJIBAKE_COMMA, ",").replace(T.MOJIBAKE_SPACE, " ")
        return re.sub(r"\s*,\s*", ", ", re.sub(r"\s+", " ", s)).strip()

    d = spark.createDataFrame(rows, "i int, t string")
    got = {x.i: x for x in d.select("i", T.clean_text("t").alias("c"), T.strip_ws("t").alias("s"), T.count_tokens("t").alias("n")).collect()}
    for i, t in rows:
        if t is None:
            assert got[i].c is None and got[i].s is None and got[i].n is None
            continue
        assert got[i].c == steps(t), repr(t)
        assert got[i].s == t.strip(), repr(t)
        assert got[i].n == len(re.findall(r"[A-Za-z0-9_]+|[^\sA-Za-z0-9_]", t)), repr(t)
    # cleaning one-line texts costs little beside the plain pattern over all whitespace
    big = spark.createDataFrame([("word of text, " * 3000,)] * 400, "t string").repartition(4).cache()
    big.count()

    def seconds(c):
        best = 1e9
        for _ in range(3):
            a = time.perf_counter()
            big.select(c).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - a)
        return best

    assert seconds(T.clean_text("t")) < 2 * seconds(F.regexp_replace("t", f"{T.WS}+", " "))


def test_counting_tokens_makes_no_string_of_each(spark, capsys):
    """Counts equal the token pattern's matches, without extracting the matches."""
    import random
    import re

    r = random.Random(7)
    bits = [" ", "  ", "\t", "\n", "\x1c", "\x85", "\xa0", " ", "　", "_", "a", "Zz", "9", "é", "ß1", ",", "-", "​", "\x00", "\x7f", "\U0001f600", "a b", " a "]
    rows = [(i, "".join(r.choices(bits, k=r.randrange(20)))) for i in range(6000)] + [(-1, None), (-2, "")]
    d = spark.createDataFrame(rows, "i int, t string").select("i", "t", T.count_tokens("t").alias("n"))
    assert dict(d.dtypes)["n"] == "int"
    for x in d.collect():
        want = None if x.t is None else len(re.findall(r"[A-Za-z0-9_]+|[^\sA-Za-z0-9_]", x.t))
        assert x.n == want, repr(x.t)
    d.explain(True)
    plan = capsys.readouterr().out
    assert "regexp_extract_all" not in plan and "regexp_replace" in plan


def test_packing_grows_with_the_pieces(spark):
    """Three times the pieces take about three times as long, and every chunk is as before."""
    import time

    def seconds(n):
        d = spark.createDataFrame([("\n".join(["Ab cd."] * n),)], "t string").select(T.chunk_table("t", 6, 3).alias("c"))
        best = 1e9
        for _ in range(3):
            a = time.perf_counter()
            c = d.collect()[0]["c"]
            best = min(best, time.perf_counter() - a)
        assert c["units"] == n and c["total_chunks"] == n // 2 and c["dropped_chunks"] == n // 2 - 3
        assert [tuple(x) for x in c["chunks"]] == [("Ab cd. Ab cd.", 6)] * 3
        return best

    few = seconds(6000)
    assert seconds(18000) < 5 * few
