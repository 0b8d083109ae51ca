"""Benchmark decontamination: prefix-filtered join of item windows against documents (native).

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  A window is ``width``
consecutive item words; an item with fewer words (but not none) is one window.  An exact
occurrence needs every word, so the necessary prefix under a rarity order is one word: the
window's rarest word by corpus count.  Document words join on it, the offset gives the only
possible start, the bounds 0 <= start <= n_words - length prune, and the slice is compared.

Null text has no words; null doc_id is a key of its own; repeated (doc_id, text) rows give one
result each; extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DELIMITERS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WIDTH = 10
BROADCAST_WINDOWS = 200_000  # at most this many windows are broadcast; beyond, a shuffle join


def words(text) -> Column:
    """Lower-cased words; only the first and last piece of a split can be empty."""
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(low, DELIMITERS), "")


def item_windows(items: DataFrame, width: int) -> DataFrame:
    """(win, item_id): every distinct window (array of words) with the items that hold it."""
    w = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (width - 1), F.lit(1)))
    return (w.select("item_id", "w", F.explode(starts).alias("s"))
            .select("item_id", F.slice("w", F.col("s"), F.lit(width)).alias("win")).distinct())


def decontaminate(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items (sorted item ids as strings), contaminated."""
    wins = item_windows(items, width)
    small = wins.count() <= BROADCAST_WINDOWS
    hint = F.broadcast if small else (lambda d: d)
    base = docs.select("doc_id", F.xxhash64("text").alias("th"), words(F.col("text")).alias("w"))
    vocab = wins.select(F.explode("win").alias("word")).distinct()
    counts = (base.select(F.explode("w").alias("word")).join(hint(vocab), "word")
              .groupBy("word").agg(F.count("*").alias("df")))
    order = (wins.select("win").distinct().select("win", F.posexplode("win").alias("off", "word"))
             .join(counts, "word", "left").na.fill({"df": 0}))
    key = (order.groupBy("win").agg(F.min(F.struct("df", "word", "off")).alias("m"))
           .select("win", F.col("m.word").alias("word"), F.col("m.off").alias("off")).where("m.df > 0"))
    if small:
        pos = base.select("doc_id", "th", "w", F.posexplode("w").alias("p", "word"))
        cand = pos.join(F.broadcast(key), "word").where(
            "p >= off AND p - off + size(win) <= size(w) AND slice(w, p - off + 1, size(win)) = win")
        occ = cand.select("doc_id", "th", "win", (F.col("p") - F.col("off")).alias("s"))
    else:  # narrow rows through the join, then the words of documents with a candidate
        pos = base.select("doc_id", "th", F.size("w").alias("n"), F.posexplode("w").alias("p", "word"))
        cand = (pos.join(key, "word").where("p >= off AND p - off + size(win) <= n")
                .select("doc_id", "th", "win", (F.col("p") - F.col("off")).alias("s")).distinct())
        b = base.dropDuplicates(["doc_id", "th"])
        occ = (cand.alias("c").join(b.alias("b"), F.col("c.doc_id").eqNullSafe(F.col("b.doc_id"))
                                    & (F.col("c.th") == F.col("b.th")))
               .where("slice(w, s + 1, size(win)) = win").select("c.doc_id", "c.th", "win", "s"))
    occ = occ.distinct()
    hit = (occ.select("doc_id", "th", F.explode(F.sequence(F.col("s"), F.col("s") + F.size("win") - 1)).alias("p"))
           .distinct().groupBy("doc_id", "th").agg(F.count("*").alias("n_hit")))
    ids = (occ.select("doc_id", "th", "win").distinct().join(hint(wins), "win")
           .groupBy("doc_id", "th").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
    found = (hit.alias("h").join(ids.alias("i"), F.col("h.doc_id").eqNullSafe(F.col("i.doc_id"))
                                 & (F.col("h.th") == F.col("i.th")))
             .select(F.col("h.doc_id").alias("fd"), F.col("h.th").alias("ft"), "n_hit", "items"))
    every = base.select("doc_id", "th", F.size("w").cast("long").alias("n_words"))
    return (every.join(found, F.col("doc_id").eqNullSafe(F.col("fd")) & (F.col("th") == F.col("ft")), "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
                    F.col("n_hit").isNotNull().alias("contaminated")))
