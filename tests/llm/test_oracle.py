"""The DuckDB statements give the operators' rows on edge texts."""

import duckdb
import pandas as pd

from chunkwise.llm import decontaminate, oracle, quality_rules
from pyspark.sql import functions as F

ITEM = "one two three four five six seven eight nine ten eleven"
DOCS = [(1, None), (2, ""), (3, f"Start {ITEM.upper()} end"), (4, "short item here"), (5, " \n\t \n"), (5, " \n\t \n"),
        (6, "a b c d e a b c d e a b c d e"), (7, "| home | about |\nPlain words in a line\nPlain words in a line\nclick here"),
        (None, "déjà vu ſhort ITEM"), (8, "x" * 5000 + " $%&"),
        (9, "Home\nAbout us\nBest offers today\nContact"), (10, "shoes boots sandals " * 14), (11, "A whole sentence of ten words is what stands here. \r\nHome\r"),
        (12, "ภาษาไทยไม่มีวรรคตอนระหว่างคำ " * 40), (13, "他说：“好。”\n  two words\u2028\n" + "word " * 29 + "end.")]
ITEMS = [(1, ITEM), (2, "short item"), (3, None), (4, "...")]


def same(got, sql: str) -> None:
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(DOCS, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    con.register("benchmark", pd.DataFrame(ITEMS, columns=["item_id", "text"]))
    cols = ", ".join(got.columns)
    want = con.sql(f"SELECT {cols} FROM ({sql})").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_decontaminate_sql(spark):
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    d = decontaminate.decontaminate(docs, items)
    same(d.select("doc_id", "n_words", "n_hit", F.size("items").alias("n_items"),
                  F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"), oracle.DECONTAMINATE)


def test_quality_rules_sql(spark):
    same(quality_rules.evaluate(spark.createDataFrame(DOCS, "doc_id long, text string")), oracle.QUALITY_RULES)
