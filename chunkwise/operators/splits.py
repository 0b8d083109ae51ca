"""Reproducible stratified splits and seeded orderings.

Membership is decided by a seeded md5 order instead of a process-local
random generator: the same rows go to the same split on every run, under
any partitioning, with exactly the reference's per-class counts.

A split needs no rank of every row, only each class's k-th row in that
order.  It is found by radix selection over a narrow table of labels and
keys: a histogram of the first hash digits (summed map-side) names the
bucket that holds the k-th row, and the distinct hashes of that bucket give
the row itself.  The rows of the input are then compared with the cut of
their class where they are, so their texts are never shuffled.

Ranks of every row (``seeded_order``, row ids) use a two-level scheme so
that no class, however large, is sorted by one task: the md5 prefix cuts
every class into up to 16^d buckets; a small table of bucket counts gives
each bucket its offset; ``row_number`` runs per (class, bucket).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkwise.operators.store import written

# ---------------------------------------------------------------------------
# Reference defaults.
# ---------------------------------------------------------------------------
TEST_RATIO = 0.1
DEV_RATIO = 0.1
SEED = 42
# ---------------------------------------------------------------------------

BUCKET_DIGITS = 4  # 65,536 order-preserving buckets per class
BROADCAST_CLASSES = 100_000  # cuts are broadcast up to this many classes (about 10 MB)


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null key finds the null key of the other side."""
    r = right.withColumnsRenamed({k: f"_r{k}" for k in keys})
    cond = [left[k].eqNullSafe(r[f"_r{k}"]) for k in keys]
    return left.join(r, cond, how).drop(*[f"_r{k}" for k in keys])


def order_key(key: str | Column, seed: int = SEED, salt: str | None = None) -> Column:
    """Seeded pseudo-random order: md5 of ``seed|salt|key`` (hex string)."""
    k = F.col(key) if isinstance(key, str) else key
    parts = [F.lit(str(seed))] + ([F.lit(salt)] if salt else []) + [k.cast("string")]
    return F.md5(F.concat_ws("|", *parts))


def exact_rank(df: DataFrame, partition_by: list[str], okey: Column, tie: str, name: str = "rank",
               digits: int = BUCKET_DIGITS, with_total: str | None = None) -> DataFrame:
    """1-based rank of each row inside ``partition_by`` ordered by (okey, tie).

    ``okey`` must be a hex hash string (its prefix preserves order).  Adds
    ``name`` and, when ``with_total`` is given, the partition's row count.

    The input is shuffled once, by (partition, bucket): the local row number
    and the bucket size come from windows over that partitioning; the small
    table of bucket sizes (at most #groups x 16^digits rows) gives every
    bucket the count of the buckets before it.  Both branches share the same
    shuffle, which Spark reuses, so the input is read once.
    """
    keys = list(partition_by) + ["_b"]
    d = df.withColumn("_ok", okey).withColumn("_b", F.substring("_ok", 1, digits))
    wb = Window.partitionBy(*keys)
    d = d.withColumn("_rn", F.row_number().over(wb.orderBy("_ok", tie))).withColumn("_c", F.count(F.lit(1)).over(wb))
    sizes = d.where(F.col("_rn") == 1).select(*keys, "_c")
    w = Window.partitionBy(*partition_by).orderBy("_b") if partition_by else Window.orderBy("_b")
    offs = sizes.withColumn("_off", F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                               F.lit(0)))
    cols = keys + ["_off"]
    if with_total:
        wt = Window.partitionBy(*partition_by) if partition_by else Window.partitionBy()
        offs = offs.withColumn(with_total, F.sum("_c").over(wt))
        cols.append(with_total)
    # small side: AQE broadcasts it once its real size is known
    d = null_safe_join(d, offs.select(*cols), keys)
    return d.withColumn(name, (F.col("_off") + F.col("_rn")).cast("bigint")).drop("_ok", "_b", "_off", "_rn", "_c")


def held_out_count(n: Column, ratio: float) -> Column:
    """Rows held out of a class of ``n``: 0 for a singleton, else
    ``min(max(1, round_half_even(n * ratio)), n - 1)``."""
    k = F.least(F.greatest(F.lit(1), F.rint(n * F.lit(ratio)).cast("bigint")), n - 1)
    return F.when(n <= 1, F.lit(0).cast("bigint")).otherwise(k)


def narrow_rows(df: DataFrame, label: str, key: str) -> DataFrame:
    """(g, k, id) of every row, written once: its label, its key and its place in the input."""
    return written(df.select(F.col(label).alias("g"), F.col(key).alias("k"), F.monotonically_increasing_id().alias("id")), "split-keys")


def running(df: DataFrame, order: list[str], n: str) -> DataFrame:
    """``df`` with ``before``, the sum of ``n`` over the earlier rows of its class."""
    w = Window.partitionBy("g").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("before", F.coalesce(F.sum(n).over(w), F.lit(0)))


def kth(df: DataFrame, order: list[str], n: str = "n") -> DataFrame:
    """Of each class the row that holds its ``need``-th unit, with the units still needed of that row."""
    d = running(df, order, n).where((F.col("before") < F.col("need")) & (F.col("need") <= F.col("before") + F.col(n)))
    return d.withColumn("need", F.col("need") - F.col("before")).drop("before")


def cuts(rows: DataFrame, want: Callable[[Column], Column], seed: int, salt: str) -> DataFrame:
    """(g, cut) of every class with held-out rows, ``want`` of its size;
    ``cut`` has the hash, key and place of the last of them in the seeded order.

    Rows equal in label and key follow each other by their place in the
    input; ``cut.tied`` says that the cut runs between such rows.
    """
    d = rows.withColumn("h", order_key("k", seed, salt)).withColumn("b", F.substring("h", 1, BUCKET_DIGITS))
    sizes = d.groupBy("g", "b").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("g"))
    bucket = kth(sizes.withColumn("need", want(total)).where("need > 0"), ["b"]).select("g", "b", "need")
    # the rows of one bucket a class, summed over equal keys before they meet
    inside = null_safe_join(d, bucket, ["g", "b"]).groupBy("g", "h", "k", "need").agg(F.count(F.lit(1)).alias("n"))
    row = written(kth(inside, ["h", "k"]), "split-cuts")
    split = row.where("need < n")
    if not split.isEmpty():  # equal keys on both sides: the place decides, by input partition, then inside one
        tied = null_safe_join(d, split.select("g", "h", "k", "need"), ["g", "h", "k"]).withColumn("p", F.shiftright("id", 33))
        part = kth(tied.groupBy("g", "h", "k", "need", "p").agg(F.count(F.lit(1)).alias("n")), ["p"])
        one = null_safe_join(tied.drop("need"), part.select("g", "h", "k", "p", "need"), ["g", "h", "k", "p"]).withColumn("n", F.lit(1))
        row = null_safe_join(row, kth(one, ["id"]).select("g", F.col("id").alias("last")), ["g"], "left")
    else:
        row = row.withColumn("last", F.lit(None).cast("long"))
    cut = F.struct("h", "k", "last", F.col("last").isNotNull().alias("tied"))
    return written(row.select("g", cut.alias("cut")), "split-cuts")


def held_out(cut: Column, key: Column, place: Column, seed: int, salt: str) -> Column:
    """Whether a row comes no later than its class's cut."""
    h = order_key(key, seed, salt)
    same = key.eqNullSafe(cut["k"])
    # nulls come first in the order
    before = F.when(cut["k"].isNull(), F.lit(False)).otherwise(key.isNull() | (key < cut["k"]))
    return F.coalesce((h < cut["h"]) | ((h == cut["h"]) & (before | (same & (~cut["tied"] | (place <= cut["last"]))))), F.lit(False))


def with_cuts(df: DataFrame, label: str, found: dict[str, DataFrame]) -> DataFrame:
    """``df`` with a column for each table of cuts, null for classes without one."""
    for name, c in found.items():
        small = c.limit(BROADCAST_CLASSES + 1).count() <= BROADCAST_CLASSES
        c = c.select(F.col("g").alias(label), F.col("cut").alias(name))
        df = null_safe_join(df, F.broadcast(c) if small else c, [label], "left")
    return df


def place_of(found: dict[str, DataFrame]) -> Column:
    """The row's place, only where some cut runs between equal keys (it keeps filters from moving below)."""
    if any(not c.where("cut.tied").isEmpty() for c in found.values()):
        return F.monotonically_increasing_id()
    return F.lit(0).cast("long")


def stratified_split(df: DataFrame, label: str = "label", ratio: float = TEST_RATIO, seed: int = SEED,
                     key: str = "doc_id", names: tuple[str, str] = ("train", "test"), salt: str | None = None,
                     split_col: str = "split") -> DataFrame:
    """Add ``split_col``: per class, the first k rows of the seeded order go to
    ``names[1]``, the rest to ``names[0]``.

    The cuts are found when this is called, over a narrow table of ``df``;
    hand in a written table if ``df`` is costly to compute.  Null labels are
    a class; null and repeated keys count as rows.  Rows equal in label and
    key are told apart by their place in the input, so where such rows fall
    on both sides, the counts are exact for inputs that give their rows in
    the same order twice, as files and written tables do.
    """
    salt = salt or names[1]
    found = {"_cut": cuts(narrow_rows(df, label, key), lambda n: held_out_count(n, ratio), seed, salt)}
    d = with_cuts(df.withColumn("_place", place_of(found)), label, found)
    out = F.when(held_out(F.col("_cut"), F.col(key), F.col("_place"), seed, salt), F.lit(names[1])).otherwise(F.lit(names[0]))
    return d.withColumn(split_col, out).drop("_cut", "_place")


def three_way_split(df: DataFrame, label: str = "label", test_ratio: float = TEST_RATIO,
                    dev_ratio: float = DEV_RATIO, seed: int = SEED, key: str = "doc_id") -> DataFrame:
    """Test first, then dev out of the remaining train rows (its own salt);
    both cuts come from one narrow table, as in ``stratified_split``."""
    rows = narrow_rows(df, label, key)
    test = cuts(rows, lambda n: held_out_count(n, test_ratio), seed, "test")
    left = with_cuts(rows, "g", {"_cut": test}).where(~held_out(F.col("_cut"), F.col("k"), F.col("id"), seed, "test")).select("g", "k", "id")
    found = {"_test": test, "_dev": cuts(left, lambda n: held_out_count(n, dev_ratio), seed, "dev")}
    d = with_cuts(df.withColumn("_place", place_of(found)), label, found)
    side = F.when(held_out(F.col("_test"), F.col(key), F.col("_place"), seed, "test"), F.lit("test")) \
        .when(held_out(F.col("_dev"), F.col(key), F.col("_place"), seed, "dev"), F.lit("dev")).otherwise(F.lit("train"))
    return d.withColumn("split", side).drop("_test", "_dev", "_place")


def seeded_order(df: DataFrame, key: str = "doc_id", seed: int = SEED, salt: str = "order",
                 name: str = "order_no", partition_by: list[str] | None = None) -> DataFrame:
    """1-based position of every row in the seeded shuffle (optionally per group).
    Computed without moving all rows into one task."""
    return exact_rank(df, partition_by or [], order_key(key, seed, salt), key, name=name,
                      digits=5 if not partition_by else BUCKET_DIGITS)


def with_row_id(df: DataFrame, split_col: str = "split", key: str = "doc_id", seed: int = SEED,
                name: str = "id") -> DataFrame:
    """0-based row id inside each split, in seeded shuffled order."""
    r = exact_rank(df, [split_col], order_key(key, seed, "order"), key, name=name)
    return r.withColumn(name, F.col(name) - 1)
