"""Python token counters, for filters and for chunk packing.

A Python function cannot run inside the packing folds, so it runs beside
them: an Arrow function counts a row's strings through a dictionary of the
distinct words seen by the Python worker, and the folds work on the counts.
Rows are neither exploded nor shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwise.functions import text as T

KNOWN = 1 << 20  # words whose counts a worker keeps; beyond it the dictionary starts anew

CountWords = Callable[[list[str]], list[int]]

_counts: dict[str, tuple[CountWords, dict[str, int]]] = {}


def known(token: str, make: Callable[[], CountWords]) -> tuple[CountWords, dict[str, int]]:
    """The counter of ``token`` and its dictionary, made once in each Python worker."""
    if token not in _counts:
        _counts[token] = (make(), {})
    return _counts[token]


def count_strings(strings: list[str], fn: CountWords, words: dict[str, int], space: int) -> np.ndarray:
    """Tokens of each string: its words' counts plus ``space`` between them."""
    split = [s.split() for s in strings]
    new = list({w for ws in split for w in ws if w not in words})
    if len(words) + len(new) > KNOWN:
        words.clear()
        new = list({w for ws in split for w in ws})
    if new:
        got = fn(new)
        if len(got) != len(new):
            raise ValueError(f"the counter gave {len(got)} counts for {len(new)} words")
        words.update(zip(new, map(int, got), strict=True))
    return np.array([sum(map(words.__getitem__, ws)) + space * max(0, len(ws) - 1) for ws in split], np.int32)


@dataclass(frozen=True)
class WordCounter:
    """A token counter in Python.

    ``make()`` is called once per Python worker and returns a function from
    a list of distinct words to their token counts (a tokenizer's batch
    call).  ``space`` and ``comma`` are the tokens that a space and a ``", "``
    between two texts add.  The contract, which WordPiece and other
    tokenizers that split at white space and commas meet, is that a text
    counts what its words count together plus ``space`` for each gap, and
    that joining with ``", "`` adds ``comma``.

    Called on a string column it counts it (null counts 0), so it can be the
    ``counter`` of every filter and of ``with_chunks``.
    """
    make: Callable[[], CountWords]
    space: int = 0
    comma: int = 1
    token: str = field(default_factory=lambda: uuid.uuid4().hex)

    def __call__(self, c: Column | str) -> Column:
        return F.element_at(self.lists(F.array(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")))), 1)

    def lists(self, c: Column | str) -> Column:
        """Counts of each string of an ``array<string>``; a null list gives null, a null string 0."""
        token, make, space = self.token, self.make, self.space

        @F.arrow_udf("array<int>")
        def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            from chunkwise.functions import counters  # the worker's own module holds the dictionary

            fn, words = counters.known(token, make)
            for lists in batches:
                n = counters.count_strings([s or "" for s in lists.flatten().to_pylist()], fn, words, space)
                ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                yield pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(n), mask=lists.is_null())

        return count(F.col(c) if isinstance(c, str) else c)


def with_pieces(df: DataFrame, units: str, out: str, max_tokens: int, counter: WordCounter) -> DataFrame:
    """C6 on every unit of the ``units`` list: ``out array<struct<t,n>>``.

    The units are counted first.  Of those over budget, the comma parts and
    word groups that the rule may ask for are counted together, and the rule
    itself is the native one, looking their counts up."""
    from chunkwise.operators.filters import materialize

    d = df.withColumn("_un", counter.lists(units))

    def asked(u: Column) -> Column:
        parts = T.comma_parts(u)
        groups = F.flatten(F.transform(F.concat(F.array(u), parts), lambda p: T.split_by_words(p, max_tokens)))
        return F.array_distinct(F.concat(parts, groups))

    over = F.transform(F.arrays_zip(F.col(units).alias("u"), F.col("_un").alias("n")),
                       lambda x: F.when(x["n"] > max_tokens, asked(x["u"])).otherwise(F.array().cast("array<string>")))
    d = materialize(d, {"_over": over})
    d = d.withColumn("_on", counter.lists(F.flatten("_over")))
    sizes = F.transform("_over", lambda x: F.size(x))
    starts = F.transform("_over", lambda x, i: F.aggregate(F.slice(sizes, F.lit(1), i), F.lit(1), lambda a, s: a + s))
    d = materialize(d, {"_start": starts})
    rows = F.arrays_zip(F.col(units).alias("u"), F.col("_un").alias("n"), F.col("_over").alias("o"), F.col("_start").alias("s"))

    def pieces(x: Column) -> Column:
        counts = F.map_from_arrays(x["o"], F.slice(F.col("_on"), x["s"], F.size(x["o"])))
        return T.let(counts, lambda m: T.unit_pieces(x["u"], x["n"], max_tokens, lambda p: F.coalesce(F.try_element_at(m, p), F.lit(0)), counter.comma))

    return materialize(d, {out: F.flatten(F.transform(rows, pieces))}).drop("_un", "_over", "_on", "_start")


def with_counted_chunks(df: DataFrame, text_col: str, out_col: str, max_tokens: int, max_chunks: int, counter: WordCounter,
                        titles: list[str] | None = None, full: bool = False) -> DataFrame:
    """``text.with_chunks`` for a Python counter."""
    from chunkwise.operators.filters import materialize

    d = materialize(df, {"_units": T.split_units(text_col, titles)})
    d = with_pieces(d, "_units", "_pieces", max_tokens, counter)
    table = T.packed(F.col("_pieces"), F.size("_units"), max_tokens, max_chunks, counter.space)
    return materialize(d, {out_col: table if full else table["chunks"]}).drop("_units", "_pieces")
