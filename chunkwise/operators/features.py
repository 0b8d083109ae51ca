"""Text features as relational Spark jobs: TF-IDF (M1), a frequency-ranked
vocabulary (E4), token ids with begin/end marks and padding (C10) and class
rebalancing by replication (M12).

Scale notes: term rows come from ``explode``; every per-term aggregate is
algebraic (count / sum), so a hot term is pre-aggregated map-side before
the shuffle.  The vocabulary is cut to ``max_features`` rows with
``orderBy(...).limit(k)`` (each task keeps only its top k), so the table that
every task looks terms up in has a proven bound of k rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from chunkwise.functions import text as T
from chunkwise.operators import splits as SP
from chunkwise.operators.store import written

# Terms: maximal runs of Unicode letters, digits and underscore, length >= 2
# (the "two or more word characters" rule with an explicit character class
# so Java regex and RE2 agree).
TERM_PATTERN = r"[\p{L}\p{N}_]+"

# ---------------------------------------------------------------------------
# Reserved token ids of the encoder input.
# ---------------------------------------------------------------------------
PAD_ID, UNK_ID, CLS_ID, SEP_ID = 0, 1, 2, 3
FIRST_TERM_ID = 4
# ---------------------------------------------------------------------------


ROWS = 1024  # texts whose terms are counted at a time


def terms(text: Column, stop_words: list[str] | None = None) -> Column:
    """Lower-cased terms of 2+ characters, stop words removed."""
    t = F.filter(F.regexp_extract_all(F.lower(text), F.lit(TERM_PATTERN), 0), lambda w: F.length(w) >= 2)
    if stop_words:
        stop = F.array(*[F.lit(w) for w in stop_words])
        t = F.filter(t, lambda w: ~F.array_contains(stop, w))
    return t


def with_ngrams(toks: Column, n_max: int = 2) -> Column:
    """Unigrams plus space-joined n-grams of adjacent terms (after stop-word
    removal), n up to ``n_max``; ``toks`` is bound once."""
    def body(t: Column) -> Column:
        out = t
        for n in range(2, n_max + 1):
            m = F.greatest(F.size(t) - (n - 1), F.lit(0))
            grams = F.slice(t, 1, m)
            for k in range(1, n):
                grams = F.zip_with(grams, F.slice(t, 1 + k, m), lambda a, b: F.concat(a, F.lit(" "), b))
            out = F.concat(out, grams)
        return out
    return T.let(toks, body)


def counted(grams: Column) -> Column:
    """``array<struct<term, tf>>`` of a list of terms: sorted, and each run of equal terms measured."""
    def runs(s: Column) -> Column:
        n = F.size(s)
        at = F.when(n == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), n))
        # the places where a run starts
        starts = F.filter(at, lambda i: (i == 1) | (F.element_at(s, i) != F.get(s, i - 2)))
        return T.let(starts, lambda b: F.transform(b, lambda i, j: F.struct(
            F.element_at(s, i).alias("term"), (F.coalesce(F.get(b, j + 1), n + 1) - i).cast("bigint").alias("tf"))))

    return T.let(F.array_sort(grams), runs)


def term_counts(df: DataFrame, text: str = "text", key: str = "doc_id", ngram_max: int = 2,
                stop_words: list[str] | None = None) -> DataFrame:
    """(key, row, counts ``array<struct<term, tf>>``) of each row, written
    once.  Terms are counted inside the row, so nothing is shuffled; ``row``
    tells rows of one key apart.  The words come from Spark; they are numbered,
    paired and counted on Arrow batches, ``ROWS`` rows at a time."""
    d = df.select(key, F.monotonically_increasing_id().alias("row"),
                  F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(TERM_PATTERN), 0).alias("words"))
    stop = pa.array(stop_words or [], pa.string())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(i, ROWS) for x in batches for i in range(0, len(x), ROWS)):
            lists = b.column("words")
            words = lists.flatten()
            fit = pc.and_(pc.greater_equal(pc.utf8_length(words), 2), pc.invert(pc.is_in(words, value_set=stop)))
            of = np.repeat(np.arange(len(b)), np.asarray(pc.list_value_length(lists)))[fit.to_numpy(zero_copy_only=False)]
            seen = words.filter(fit).dictionary_encode()
            code, names = np.asarray(seen.indices).astype(np.int64), [seen.dictionary]
            rows, codes, gram, total = [of], [code], code, len(names[0])
            for n in range(2, ngram_max + 1):
                left, right = gram[:max(len(code) - n + 1, 0)], code[n - 1:]
                ok = of[:len(left)] == of[n - 1:]
                pair, at = np.unique((left * len(names[0]) + right)[ok], return_inverse=True)
                first, last = np.divmod(pair, max(len(names[0]), 1))
                names.append(pc.binary_join_element_wise(names[n - 2].take(pa.array(first)), names[0].take(pa.array(last)), " "))
                gram = np.zeros(len(left), np.int64)
                gram[ok] = at
                rows.append(of[:len(left)][ok])
                codes.append(at + total)
                total += len(pair)
            found, tf = np.unique(np.concatenate(rows) * max(total, 1) + np.concatenate(codes), return_counts=True)
            row, term = np.divmod(found, max(total, 1))
            ends = pa.array(np.r_[0, np.cumsum(np.bincount(row, minlength=len(b)))].astype(np.int32))
            items = pa.StructArray.from_arrays([pa.concat_arrays(names).take(pa.array(term)), pa.array(tf)], ["term", "tf"])
            yield pa.RecordBatch.from_arrays([b.column(key), b.column("row"), pa.ListArray.from_arrays(ends, items)], names=[key, "row", "counts"])

    item = StructType([StructField("term", StringType()), StructField("tf", LongType())])
    out = StructType([d.schema[key], d.schema["row"], StructField("counts", ArrayType(item))])
    return written(d.mapInArrow(count, out), "term-counts")


def tfidf(df: DataFrame, text: str = "text", key: str = "doc_id", ngram_max: int = 2, max_features: int = 50000,
          min_df: int = 2, max_df: float = 0.9, stop_words: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """M1: returns (weights ``key, term, weight``, vocabulary ``term, term_id, df, idf``).

    df limits first (``min_df`` documents, at most ``max_df`` share), then
    the ``max_features`` terms with the largest corpus count (ties by term);
    weight ``tf * (ln((1 + N) / (1 + df)) + 1)``, L2-normalised per document.
    Every row is a document, whatever its key; a null text has no terms.

    The texts are read once and not shuffled: the statistics shuffle distinct
    terms after map-side aggregation.  Weights and norms are taken inside the
    row, from the vocabulary (at most ``max_features`` terms) in every task.
    """
    rows = term_counts(df, text, key, ngram_max, stop_words)
    n_docs = rows.agg(F.count(F.lit(1))).scalar()  # scalar subquery, evaluated once
    tc = rows.select(F.inline("counts"))
    stats = tc.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total")) \
        .withColumn("n_docs", n_docs)
    keep = (F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * F.col("n_docs"))
    top = stats.where(keep).orderBy(F.col("total").desc(), F.col("term")).limit(max_features)
    vocab = written(
        top.withColumn("term_id", F.row_number().over(Window.orderBy(F.col("total").desc(), F.col("term"))) - 1)
        .withColumn("idf", F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1)
        .select("term", "term_id", "df", "idf"), "vocabulary")
    known = vocab.select("term", "idf").toArrow()  # at most max_features rows
    term, idf = known["term"].combine_chunks(), known["idf"].to_numpy()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(i, ROWS) for x in batches for i in range(0, len(x), ROWS)):
            c = b.column("counts")
            items = c.flatten()
            at = pc.index_in(items.field("term"), value_set=term)
            pick = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
            row = np.repeat(np.arange(len(b)), np.asarray(pc.list_value_length(c)))[pick]
            w = items.field("tf").to_numpy(zero_copy_only=False)[pick] * idf[at.take(pa.array(pick)).to_numpy(zero_copy_only=False)]
            norm = np.sqrt(np.bincount(row, weights=w * w, minlength=len(b)))
            yield pa.RecordBatch.from_arrays([b.column(key).take(pa.array(row)), items.field("term").take(pa.array(pick)), pa.array(w / norm[row])],
                                             names=[key, "term", "weight"])

    out = StructType([rows.schema[key], StructField("term", StringType()), StructField("weight", DoubleType())])
    return rows.select(key, "counts").mapInArrow(weigh, out), vocab


def build_vocab(df: DataFrame, text: str = "text", size: int = 30000) -> DataFrame:
    """``term, term_id, n`` for the ``size`` most frequent tokens of the
    lower-cased text (ties by term); ids start after the reserved ones."""
    toks = df.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit(T.TOKEN_JAVA), 0)).alias("term"))
    c = toks.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    top = c.orderBy(F.col("n").desc(), F.col("term")).limit(size)
    return top.withColumn("term_id", (F.row_number().over(Window.orderBy(F.col("n").desc(), F.col("term")))
                                      + FIRST_TERM_ID - 1).cast("int")).select("term", "term_id", "n")


def encode_ids(df: DataFrame, vocab: DataFrame, text: str = "chunk", keys: list[str] | None = None,
               pad_size: int = T.DEFAULT_PAD_SIZE) -> DataFrame:
    """``[CLS] ids... [SEP]`` truncated to ``pad_size`` and padded with
    ``[PAD]``; unknown tokens map to ``[UNK]``.  Adds ``input_ids`` and
    ``attention_mask`` (array<int>, length ``pad_size``).

    A chunk's tokens past ``pad_size - 2`` are dropped, and its ids are looked
    up inside the row, in the vocabulary that every task has (bounded by its
    own ``size``).  Chunks of equal keys are one sequence, by place and id.
    """
    keys = keys or ["doc_id", "chunk_no"]
    known = vocab.select("term", "term_id").toArrow()
    term, term_id = known["term"].combine_chunks(), known["term_id"].to_numpy()
    tokens = F.regexp_extract_all(F.lower(text), F.lit(T.TOKEN_JAVA), 0)
    # collect_list skips nulls, so a chunk without a text still gets [CLS][SEP]
    g = df.select(*keys, F.slice(tokens, 1, pad_size - 2).alias("_t")).groupBy(*keys).agg(F.collect_list("_t").alias("_t"))

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = b.column("_t")
            texts = parts.flatten()
            size = np.asarray(pc.list_value_length(texts), np.int64)
            at = pc.index_in(texts.flatten(), value_set=term)
            seen = at.is_valid().to_numpy(zero_copy_only=False)
            body = np.full(len(at), UNK_ID, np.int32)
            body[seen] = term_id[at.drop_null().to_numpy()]
            chunks = np.asarray(pc.list_value_length(parts), np.int64)
            of = np.repeat(np.repeat(np.arange(len(b)), chunks), size)
            if chunks.max(initial=0) > 1:
                pos = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
                body = body[np.lexsort((body, pos, of))]
            n = np.bincount(of, minlength=len(b))
            width = np.maximum(n + 2, pad_size)
            start = np.cumsum(width) - width
            out, mask = np.full(width.sum(), PAD_ID, np.int32), np.zeros(width.sum(), np.int32)
            out[start], out[start + n + 1] = CLS_ID, SEP_ID
            out[start[of] + 1 + np.arange(len(of)) - (np.cumsum(n) - n)[of]] = body
            mask[np.repeat(start, n + 2) + np.arange((n + 2).sum()) - np.repeat(np.cumsum(n + 2) - n - 2, n + 2)] = 1
            ends = pa.array(np.r_[start, width.sum()].astype(np.int32))
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keys], *[pa.ListArray.from_arrays(ends, pa.array(x)) for x in (out, mask)]],
                                             names=[*keys, "input_ids", "attention_mask"])

    kinds = [g.schema[k] for k in keys]
    return g.mapInArrow(ids, StructType([*kinds, *[StructField(c, ArrayType(IntegerType())) for c in ("input_ids", "attention_mask")]]))


COPIES = 4096  # copies of a row that one task makes


def rebalance(df: DataFrame, label: str = "label", key: str = "doc_id", seed: int = SP.SEED, copies: int = COPIES) -> DataFrame:
    """Replicate rows so every class reaches the largest class size
    exactly: each row of a class with n rows appears ``M div n`` times and the
    first ``M mod n`` rows of the seeded order once more.  Adds ``copy_no``
    (bigint, from 1).

    Class sizes and the rows with one more copy come from a narrow table, as
    in ``stratified_split``.  A row of more than ``copies`` copies becomes
    ranges of that many, which are dealt over the tasks before they are
    expanded; other rows are copied where they are.
    """
    rows = SP.narrow_rows(df, label, key)
    sizes = written(rows.groupBy("g").agg(F.count(F.lit(1)).alias("cut")), "class-sizes")
    least, most = sizes.agg(F.min("cut"), F.max("cut")).first()
    most = most or 0
    found = {"_cut": SP.cuts(rows, lambda n: F.lit(most) % n, seed, "rebalance"), "_n": sizes}
    d = SP.with_cuts(df.withColumn("_place", SP.place_of({"_cut": found["_cut"]})), label, found)
    more = SP.held_out(F.col("_cut"), F.col(key), F.col("_place"), seed, "rebalance")
    d = d.withColumn("_reps", F.expr(f"{most}L div _n") + more.cast("long")).drop("_cut", "_n", "_place")

    def numbers(first: Column, last: Column, step: int = 1) -> Column:
        return F.explode(F.sequence(first, last, F.lit(step).cast("long")))

    one = F.lit(1).cast("long")
    if not least or most // least < copies:
        return d.withColumn("copy_no", numbers(one, F.col("_reps"))).drop("_reps")
    few = d.where(F.col("_reps") <= copies).withColumn("copy_no", numbers(one, F.col("_reps")))
    # two levels of ranges, so that no row holds more than ``copies`` of them
    many = d.where(F.col("_reps") > copies).withColumn("_a", numbers(one, F.col("_reps"), copies * copies))
    many = many.withColumn("_b", numbers(F.col("_a"), F.least(F.col("_reps"), F.col("_a") + copies * copies - 1), copies))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = many.repartition(parts, F.col(key), F.col("_b"))
    many = many.withColumn("copy_no", numbers(F.col("_b"), F.least(F.col("_reps"), F.col("_b") + copies - 1)))
    return few.drop("_reps").unionByName(many.drop("_reps", "_a", "_b"))
