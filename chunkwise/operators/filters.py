"""Row filters with the reference's limits (all bounds keep inclusively)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from chunkwise.functions import text as T

# ---------------------------------------------------------------------------
# Default limits of the reference.
# ---------------------------------------------------------------------------
MIN_CHARS = 200
MIN_TOKENS = 50
MAX_TOKENS = 2040   # 4 chunks x 510 tokens
# ---------------------------------------------------------------------------

REASON_SHORT_CHARS = "short_chars"
REASON_SHORT_TOKENS = "short_tokens"
REASON_OVERLONG = "overlong"
REASON_KEPT = "kept"
REASON_EMPTY = "empty"


@dataclass(frozen=True)
class Limits:
    min_chars: int | None = MIN_CHARS
    min_tokens: int | None = MIN_TOKENS
    max_tokens: int | None = MAX_TOKENS


def materialize(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """Add expensive columns so that they are evaluated once per row.

    A filter on a projected column is normally pushed below the projection
    with the expression substituted in, so the expression runs once for the
    filter and again for the output.  Columns produced by a generator
    (``inline`` of a one-element array) stay above it: predicates on them
    are evaluated on the computed value.
    """
    keep = [c for c in df.columns if c not in cols]
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def where_once(df: DataFrame, predicate: Column) -> DataFrame:
    """Filter on a predicate computed above the input's projection, so the
    columns it reads (e.g. cleaned text) are not recomputed inside it."""
    return materialize(df, {"_keep": F.coalesce(predicate, F.lit(False))}).where("_keep").drop("_keep")


def filter_min_chars(df: DataFrame, min_chars: int = MIN_CHARS, text: str = "text") -> DataFrame:
    """Keep rows whose text has at least ``min_chars`` code points (null dropped)."""
    return where_once(df, F.length(text) >= min_chars)


def filter_min_tokens(df: DataFrame, min_tokens: int = MIN_TOKENS, text: str = "text",
                      counter: T.Counter = T.count_tokens) -> DataFrame:
    return where_once(df, counter(F.col(text)) >= min_tokens)


def filter_max_tokens(df: DataFrame, max_tokens: int = MAX_TOKENS, text: str = "text",
                      counter: T.Counter = T.count_tokens) -> DataFrame:
    return where_once(df, counter(F.col(text)) <= max_tokens)


def removal_reason(text: Column, limits: Limits = Limits(), counter: T.Counter = T.count_tokens) -> Column:
    """First matching reason (chars before tokens, cheap before expensive);
    ``kept`` when none applies.  The token count is only evaluated for rows
    that pass the character test (CASE WHEN short-circuits)."""
    def by_tokens(n_tok: Column) -> Column:
        r = F.when(F.lit(False), F.lit(None).cast("string"))
        if limits.min_tokens is not None:
            r = r.when(n_tok < limits.min_tokens, F.lit(REASON_SHORT_TOKENS))
        if limits.max_tokens is not None:
            r = r.when(n_tok > limits.max_tokens, F.lit(REASON_OVERLONG))
        return r.otherwise(F.lit(REASON_KEPT))

    reason = F.when(text.isNull(), F.lit(REASON_SHORT_CHARS))
    if limits.min_chars is not None:
        reason = reason.when(F.length(text) < limits.min_chars, F.lit(REASON_SHORT_CHARS))
    if limits.min_tokens is None and limits.max_tokens is None:
        return reason.otherwise(F.lit(REASON_KEPT))
    # the token count is computed once, and only for rows past the char test
    return reason.otherwise(T.let(counter(text), by_tokens))


def filter_with_reason(df: DataFrame, limits: Limits = Limits(), text: str = "text",
                       counter: T.Counter = T.count_tokens) -> tuple[DataFrame, DataFrame]:
    """Return (kept rows, counts per reason).  Both derive from one tagged
    plan; cache or checkpoint the input when both are consumed."""
    tagged = materialize(df, {"_reason": removal_reason(F.col(text), limits, counter)})
    kept = tagged.where(F.col("_reason") == REASON_KEPT).drop("_reason")
    counts = tagged.groupBy(F.col("_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    return kept, counts


def write_with_reason(df: DataFrame, path: str, limits: Limits = Limits(), text: str = "text", counter: T.Counter = T.count_tokens,
                      given: str | None = None, given_reasons: list[str] | None = None) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """D4 in one job: kept rows, rejected rows (with ``reason``) and the
    number of rows per reason.

    Every row is tagged once and written under ``path`` by reason; the counts
    are metrics of that write, and both frames read their folders back.
    ``given`` names a column whose reason, where it has one, goes first;
    ``given_reasons`` are the values to be counted.
    """
    tag = removal_reason(F.col(text), limits, counter)
    if given:
        df, tag = df.withColumnRenamed(given, "_given"), F.coalesce(F.col("_given"), tag)
    tagged = materialize(df, {"reason": tag}).drop("_given")
    seen = Observation()
    named = [REASON_KEPT, REASON_SHORT_CHARS, REASON_SHORT_TOKENS, REASON_OVERLONG, *(given_reasons or [])]
    tagged.observe(seen, *[F.count_if(F.col("reason") == r).alias(r) for r in named]) \
        .write.mode("overwrite").partitionBy("reason").parquet(path)
    counts = {r: n for r, n in seen.get.items() if n}
    back = df.sparkSession.read.schema(tagged.schema).parquet(path)
    return back.where(F.col("reason") == REASON_KEPT).drop("reason"), back.where(F.col("reason") != REASON_KEPT), counts


def empty_reason(text: str = "text") -> Column:
    """``empty`` for null and blank texts, null for others: tags a table in one pass."""
    return F.when(F.col(text).isNull() | (T.strip_ws(F.col(text)) == ""), F.lit(REASON_EMPTY))


def reject_empty(df: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Split into (accepted, rejected-with-reason) on empty/blank text."""
    reason = empty_reason(text)
    return df.where(reason.isNull()), df.where(reason.isNotNull()).withColumn("reason", F.lit(REASON_EMPTY))


def drop_rarest(df: DataFrame, k: int = 4, label: str = "label") -> DataFrame:
    """Drop the ``k`` least frequent labels (ties: lower label first).

    The label counts are a per-class aggregate; the broadcast side of the
    ``left_anti`` join is the ``limit(k)`` of it, so at most ``k`` rows.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    rare = counts.orderBy(F.col("_n").asc(), F.col(label).asc()).limit(k).select(label)
    return df.join(F.broadcast(rare), on=label, how="left_anti")
