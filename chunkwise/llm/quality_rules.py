"""Line-first quality rules (native).

Per line: a line with words fails if it holds a navigation mark (``|``) for every three of its words or
fewer, if fewer than 40 % of its characters are letters, or if it holds a boilerplate phrase and is short.
Punctuation: it also fails as a fragment, if it is short, has fewer than 5 words and ends in no mark (menus,
buttons), and as a list, if it has 30 or more words of under 12 code points on average and no punctuation
mark at all (keyword lists).  The bound on the words keeps scripts written without spaces.  Short is under
80 code points.  Failed lines are removed (``cleaned``, blank lines stay); a document that keeps under half of its word characters is rejected.  The base
counts are over whole texts.  A repeated 5-word window is found by sorting (hash, position) pairs
inside the row; the words covered are the sum of min(5, gap to the next repeated window).

Null text has no words and is rejected; each input row gives one row; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
BOILERPLATE = r"(?i)cookie|privacy policy|terms of (use|service)|all rights reserved|click here|subscribe"
END = r"[.!?:;…。！？؟۔।)\]}\x22\x27”’»」』][\x20\x09-\x0D]*\z"  # ends of a sentence, with closing marks
SHORT, FRAGMENT, LIST, LETTERS, LOST = 80, 5, 30, 12, 0.5


def let(value, body):
    """Bind ``value`` once: a one-element array whose lambda variable is used in ``body``."""
    return F.transform(F.array(value), body)[0]


def repeated_words(w):
    n = F.size(w)
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(n - 4, F.lit(1))),
                        lambda i: F.struct(F.xxhash64(F.slice(w, i, 5)).alias("h"), i.alias("p")))

    def covered(s):
        before = F.concat(F.array(F.lit(None).cast("struct<h:bigint,p:int>")), F.slice(s, 1, F.size(s) - 1))
        after = F.concat(F.slice(s, 2, F.size(s)), F.array(F.lit(None).cast("struct<h:bigint,p:int>")))
        marked = F.zip_with(F.zip_with(s, before, lambda a, b: F.struct(a.p.alias("p"), a.h.alias("h"), F.coalesce(a.h == b.h, F.lit(False)).alias("d"))),
                            after, lambda a, b: F.when(a.d | F.coalesce(a.h == b.h, F.lit(False)), a.p))
        return let(F.sort_array(F.array_compact(marked)), lambda q: F.aggregate(
            F.zip_with(q, F.slice(q, 2, F.greatest(F.size(q), F.lit(1))), lambda a, b: F.least(F.lit(5), F.coalesce(b - a, F.lit(5)))),
            F.lit(0), lambda x, y: x + y))

    return F.when(n < 6, F.lit(0)).otherwise(let(F.sort_array(pairs), covered)).cast("long")


def cleaned(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, cleaned (null: null text)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", F.col("text").alias("raw"), text.alias("t"), F.array_remove(F.split(text, SPACE), "").alias("w"),
                    F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    chars = lambda c: F.length(F.regexp_replace(c, SPACE, ""))

    def passes(x):
        letters = F.length(F.regexp_replace(x, r"[^\p{L}]+", ""))
        bars = F.length(F.regexp_replace(x, r"[^|]+", ""))
        n = F.size(F.array_remove(F.split(x, SPACE), ""))
        fragment = (F.length(x) < SHORT) & ~x.rlike(END) & (n < FRAGMENT)
        listed = ~x.rlike(r"\p{P}") & (n >= LIST) & (chars(x) < n * LETTERS)
        return ((letters * 10 >= chars(x) * 4) & (bars * 6 < F.size(F.split(x, SPACE)) * 2)
                & ~((F.length(x) < SHORT) & x.rlike(BOILERPLATE)) & ~fragment & ~listed)

    kept_chars = F.aggregate(F.filter("lines", passes), F.lit(0), lambda a, x: a + chars(x))
    blank = lambda x: ~x.rlike(r"[^\x20\x09-\x0D]")
    clean = F.array_join(F.filter(F.split("raw", "\n"), lambda x: blank(x) | passes(x)), "\n")
    m = d.select("doc_id", F.size("w").cast("long").alias("n_words"), chars(F.col("t")).cast("long").alias("word_chars"),
                 F.length(F.regexp_replace("t", SYMBOLS, "")).cast("long").alias("n_symbols"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 let(F.col("w"), repeated_words).alias("n_repeat_words"), kept_chars.alias("k"), clean.alias("cleaned"))
    m = m.withColumn("base_failed", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words"))
    return m.select(*m.columns[:6], "base_failed",
                    (~F.col("base_failed") & (F.col("k") >= LOST * F.col("word_chars"))).alias("kept"), "cleaned")


def evaluate(docs: DataFrame) -> DataFrame:
    """``cleaned`` without the text."""
    return cleaned(docs).drop("cleaned")
