"""Readers for labelled text, category maps and the raw document CSV.

All readers take an explicit schema (no inference).  Labelled text files
are read with ``spark.read.text`` and split at tabs, because the format has
no quoting: a ``"`` or backslash in the text is kept as it is.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from chunkwise.functions import text as T
from chunkwise.operators import filters as FL
from chunkwise.operators.store import written

# ---------------------------------------------------------------------------
# Default number of categories when no map is available.
# ---------------------------------------------------------------------------
DEFAULT_N_CATEGORIES = 20
HEADER_LINE = "text\tlabel"
# ---------------------------------------------------------------------------

REASON_NO_TAB = "no_tab"
REASON_BAD_LABEL = "bad_label"


BROADCAST_BLOCKS = 50_000  # line offsets are broadcast up to this many file blocks (about 10 MB)


class BadRowsError(ValueError):
    pass


def numbered_lines(spark: SparkSession, path: str, name: str = "row_id") -> DataFrame:
    """(value, ``name``): every line with its 0-based number over all files in path order.

    A first pass counts the lines of each file block without keeping them;
    a block's offset is the count of the blocks before it, and the second
    pass numbers its lines where they are.  The number depends on the files
    alone, not on how they are cut into tasks.
    """
    # the columns that tell a line's block, and its place among the lines of its task
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"),
                                         F.monotonically_increasing_id().alias("_id"))
    blocks = written(lines.groupBy("_f", "_b").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")), "line-blocks")
    # one row a file block: bounded by the input's bytes over the block size
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = blocks.select("_f", "_b", (before - F.col("_first")).alias("_o"))
    small = blocks.limit(BROADCAST_BLOCKS + 1).count() <= BROADCAST_BLOCKS
    return lines.join(F.broadcast(offsets) if small else offsets, ["_f", "_b"]).select("value", (F.col("_id") + F.col("_o")).alias(name))


def _lines(spark: SparkSession, path: str, row_id: str | None) -> DataFrame:
    return numbered_lines(spark, path, row_id) if row_id else spark.read.text(path)


def _first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of the input's first file in path order (one row to the
    driver, like Spark's own CSV header handling).  The files are listed, not
    read: a scan of several files starts with the largest."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").agg(F.min("path")).first()[0]
    r = spark.read.text(files).limit(1).collect() if files else None
    return r[0][0] if r else None


def tagged_labeled(spark: SparkSession, path: str, text_col: str = "text", label_col: str = "label",
                   row_id: str | None = None) -> DataFrame:
    """S1 in one pass: ``[row_id,] text (cleaned), label, value, reason`` of
    every line that is not blank or a header; ``reason`` says why a line is
    malformed (it then keeps its ``value``) and is null for the others."""
    first = _first_line(spark, path)
    names = first.split("\t") if first is not None else []
    lines = _lines(spark, path, row_id).where(T.strip_ws(F.col("value")) != "")
    if text_col in names and label_col in names:
        ti, li = names.index(text_col), names.index(label_col)
        lines = lines.where(F.col("value") != first)
    else:
        ti, li = 0, 1
    f = F.split(F.col("value"), "\t")
    return _tagged(lines, row_id, F.get(f, ti), F.get(f, li), T.clean_text)


def _tagged(lines: DataFrame, row_id: str | None, text: Column, label: Column, clean) -> DataFrame:
    rows = lines.select(*([row_id] if row_id else []), text.alias("_t"), label.alias("_l"), "value")
    rows = rows.withColumn("label", T.strip_ws(F.col("_l")).try_cast("int"))
    reason = F.when(F.col("_l").isNull(), F.lit(REASON_NO_TAB)).when(F.col("label").isNull(), F.lit(REASON_BAD_LABEL))
    rows = rows.withColumn("reason", reason)
    return rows.select(*([row_id] if row_id else []), F.when(F.col("reason").isNull(), clean("_t")).alias("text"), "label",
                       F.when(F.col("reason").isNotNull(), F.col("value")).alias("value"), "reason")


def _parted(tagged: DataFrame, path: str, mode: str) -> tuple[DataFrame, DataFrame]:
    good = tagged.where(F.col("reason").isNull()).drop("value", "reason")
    bad = tagged.where(F.col("reason").isNotNull()).drop("text", "label")
    if mode == "fail" and not bad.isEmpty():
        raise BadRowsError(f"rows without an integer label in {path}")
    return good, bad


def read_labeled(spark: SparkSession, path: str, text_col: str = "text", label_col: str = "label",
                 min_chars: int | None = FL.MIN_CHARS, mode: str = "quarantine",
                 row_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Headered or headerless ``text<TAB>label`` -> (rows, quarantine).

    If the first line names both columns it is the header (and lines equal to
    it are skipped); otherwise the file is headerless with fields
    ``text, label``.  Text is cleaned, the label cast to int (rows whose
    label is not an integer go to the quarantine frame, or raise with
    ``mode="fail"``), then the ``min_chars`` filter applies.  ``row_id``
    names a column with the line's number, a stable key for splits.
    """
    good, bad = _parted(tagged_labeled(spark, path, text_col, label_col, row_id), path, mode)
    if min_chars is not None:
        good = FL.filter_min_chars(good, min_chars)
    return good, bad


def read_labeled_lines(spark: SparkSession, path: str, limits: FL.Limits = FL.Limits(),
                       mode: str = "quarantine", row_id: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Line reader -> (kept rows, removal counts, quarantine).

    A ``text<TAB>label`` header line (any case, surrounding spaces allowed)
    and blank lines are skipped; each line is stripped and split at its
    first tab; text is stripped, the label cast to int; then the length
    filters D1-D3 run with a reason per removed row.  Lines without a tab or
    with a non-integer label are quarantined (the reference raises; use
    ``mode="fail"`` for that).  ``row_id`` as in ``read_labeled``.
    """
    lines = _lines(spark, path, row_id).withColumn("value", T.strip_ws(F.col("value")))
    lines = lines.where(F.col("value") != "").where(F.lower("value") != HEADER_LINE)
    p = F.split(F.col("value"), "\t", 2)
    good, bad = _parted(_tagged(lines, row_id, F.get(p, 0), F.get(p, 1), lambda c: T.strip_ws(F.col(c))), path, mode)
    kept, counts = FL.filter_with_reason(good, limits)
    return kept, counts, bad


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    """S3: ``label, name`` from a category map; separator tab, else first
    comma, else whitespace; rows whose id is not all digits are dropped;
    sorted by id.  An empty or missing map falls back to ``default_categories``."""
    v = T.strip_ws(F.col("value"))
    try:
        raw = spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return default_categories(spark)
    lines = raw.select(v.alias("line")).where(F.col("line") != "")
    parts = (F.when(F.instr("line", "\t") > 0, F.split("line", "\t", 2))
             .when(F.instr("line", ",") > 0, F.split("line", ",", 2))
             .otherwise(F.split("line", f"{T.WS}+", 2)))
    c = lines.select(parts.alias("p")).where(F.size("p") == 2)
    c = c.select(T.strip_ws(F.get("p", 0)).alias("id"), T.strip_ws(F.get("p", 1)).alias("name"))
    c = c.where(F.col("id").rlike("^[0-9]+$")).select(F.col("id").cast("int").alias("label"), "name")
    if c.isEmpty():
        return default_categories(spark)
    return c.orderBy("label")


def default_categories(spark: SparkSession, n: int = DEFAULT_N_CATEGORIES) -> DataFrame:
    """Ids ``0..n-1`` with their decimal string as name."""
    return spark.range(n).select(F.col("id").cast("int").alias("label"), F.col("id").cast("string").alias("name"))


# ---------------------------------------------------------------------------
# Column names of the original four-column document CSV.
# ---------------------------------------------------------------------------
RAW_CSV_SCHEMA = TY.StructType([
    TY.StructField("ID", TY.StringType()),
    TY.StructField("Resume_str", TY.StringType()),
    TY.StructField("Resume_html", TY.StringType()),
    TY.StructField("Category", TY.StringType()),
])


def read_documents_csv(spark: SparkSession, path: str) -> DataFrame:
    """The original 4-column CSV (quoted multi-line fields); the HTML
    column is pruned at the scan."""
    df = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
          .schema(RAW_CSV_SCHEMA).csv(path))
    return df.select(F.col("ID").alias("id"), F.col("Resume_str").alias("text"), F.col("Category").alias("category"))
