"""Merkle dataset manifest with octopus multiproofs.

Every row is a leaf: the digest of doc_id, source, lang, n_chars and text.  The leaves of a language
ascend by doc_id (null first, then by digest) and form a tree of fan-out ``FAN``; the subroots of
the languages (null first, bytewise) form a tree of the same kind, whose top is the root.

A leaf partition is an aligned block of ``FAN ** DEPTH`` leaves of a tree.  For the leaves to be
proven it works out the least union of node coordinates that it lacks, all blocks fetch theirs in
one join, and each derives the interiors that its proofs share and expands every proof locally.

Blocks bound every group.  Ranks come from a range partitioning by (lang, doc_id, digest, a number
of the row), so a language of most rows, or most rows being equal, spreads over the partitions.  A
node high in a tree is asked for by many blocks; it is joined by (node, slice of the blocks).
Digests are 32 bytes in tables and hex text where they are hashed.

Nulls: a null field is ``-``; a null lang is a language of its own, before the others; rows with a
null doc_id come first in theirs.  Empty text is ``0:``.  Equal rows are leaves of their own with
equal digests, so their order does not matter.  An empty table gives no leaves, nodes or proofs.
Extra columns are neither hashed nor kept.  Texts of any length are hashed whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkwise.llm.store import stored

FAN, DEPTH = 8, 4
TOP = -1  # tree number of the tree over the subroots
FREE = 3  # levels over a block whose nodes are not sliced: 7 * 8 ** 3 blocks ask for one at most
NODE = "tree long, level int, idx long, size long, h binary"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(c: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(text: Column | None = None) -> Column:
    """Digest of a row of ``FIELDS``, with ``text`` in place of its own if given."""
    parts = [field(text if c == "text" and text is not None else F.col(c)) for c in FIELDS]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def tampered() -> Column:
    """Whether the check changes a row: 3 divides the crc32 of its doc_id; not without an id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))


def positions(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df``, written in ``order``, with its ``part`` and the gapless position ``at`` of each row."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    t = stored(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), name)
    t = t.withColumn("part", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND((1 << 33) - 1))
    # one row a range partition, so the window and the broadcast are bounded by their number
    before = F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = t.groupBy("part").agg(F.count("*").alias("rows")).select("part", before.alias("before"))
    return t.join(F.broadcast(start), "part").withColumn("at", F.col("at") + F.col("before")).drop("before")


def leaves(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tree, idx, size, doc_id, leaf, alt) of every row, where alt is the digest of the tampered row
    or null; and (tree, lang, size) of every language."""
    alt = F.when(tampered() & F.col("text").isNotNull(), leaf_digest(F.translate("text", UPPER, LOWER)))
    d = docs.select(*FIELDS).select("doc_id", F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("key"), leaf_digest().alias("leaf"), alt.alias("alt"))
    at = positions(stored(d.withColumn("copy", F.monotonically_increasing_id()), "rows"), ["key", "doc_id", "leaf", "copy"], "leaves")
    langs = at.groupBy("key").agg(F.min("at").alias("start"), F.count("*").alias("size"))
    langs = stored(positions(stored(langs, "langs"), ["key"], "order").withColumnRenamed("at", "tree").drop("part"), "trees")
    piece = at.select("part", "key").distinct().join(langs, "key")  # the languages of each range partition
    rows = at.join(piece, ["part", "key"]).select("tree", (F.col("at") - F.col("start")).alias("idx"), "size", "doc_id", "leaf", "alt")
    lang = F.when(F.col("key") != "", F.expr("substring(key, 2)"))
    return stored(rows, "leaves"), langs.select("tree", lang.alias("lang"), "size")


def parent(run: bytes) -> bytes:
    """Digest of a run of 32-byte digests, taken as hex text."""
    return sha256(run.hex().encode()).digest()


def grow(block: pd.DataFrame, depth: int = DEPTH) -> pd.DataFrame:
    """The nodes up to ``depth`` levels above one aligned block of a level."""
    block = block.sort_values("idx")
    tree, level, size = int(block["tree"].iat[0]), int(block["level"].iat[0]), int(block["size"].iat[0])
    row, first, out = list(block["h"]), int(block["idx"].iat[0]), []
    for _ in range(depth):
        if size == 1:
            break
        row = [parent(b"".join(row[i:i + FAN])) for i in range(0, len(row), FAN)]
        first, size, level = first // FAN, -(-size // FAN), level + 1
        out.append(pd.DataFrame({"tree": tree, "level": level, "idx": np.arange(first, first + len(row)), "size": size, "h": row}))
    return pd.concat(out)


def nodes(level: DataFrame, depth: int = DEPTH) -> DataFrame:
    """All nodes of the trees whose lowest level is given, that level included."""
    rounds, base = [level], 0
    while not (low := level.where("size > 1")).isEmpty():
        up = stored(low.groupBy("tree", F.expr(f"idx div {FAN**depth}")).applyInPandas(lambda g: grow(g, depth), NODE), "nodes")
        rounds.append(up)
        base += depth
        level = up.where(F.col("level") == base)
    out = rounds[0]
    for r in rounds[1:]:
        out = out.union(r)
    return out


def missing(known: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(level, places) of the nodes that fold the known leaves to the top and do not follow from them."""
    level, known = 0, np.unique(known)
    while size > 1:
        runs = np.unique(known // FAN)
        run = (runs[:, None] * FAN + np.arange(FAN)).ravel()
        yield level, np.setdiff1d(run[run < size], known, assume_unique=True)
        level, known, size = level + 1, runs, -(-size // FAN)


def prove(wanted: DataFrame, all_nodes: DataFrame, tails: DataFrame | None = None, depth: int = DEPTH) -> DataFrame:
    """The rows of ``wanted`` (tree, idx, size, h and more) with their proofs to the top of their tree.

    ``siblings`` has the digests of the other members of the run for each level, joined; ``places``
    the place of the path's own node among them.  ``tails`` (tree, slices, places, siblings) are
    appended to every proof of a tree.
    """
    rows = wanted.withColumn("block", F.expr(f"idx div {FAN**depth}"))

    def ask(g: pd.DataFrame) -> pd.DataFrame:
        lack = [(lv, i) for lv, at in missing(g["idx"].to_numpy(), int(g["size"].iat[0])) for i in at.tolist()]
        lv, at = ([x[0] for x in lack], [x[1] for x in lack])
        return pd.DataFrame({"tree": g["tree"].iat[0], "block": g["block"].iat[0], "level": lv, "idx": at})

    slices = lambda: F.pow(F.lit(FAN), F.greatest(F.col("level") - depth - FREE, F.lit(0))).cast("long")
    asks = stored(rows.select("tree", "block", "idx", "size").groupBy("tree", "block").applyInPandas(ask, "tree long, block long, level int, idx long")
                  .withColumn("slice", F.col("block") % slices()), "asks")
    low = asks.agg(F.min("level")).first()[0]  # levels that no block lacks are not read
    copies = all_nodes.where(F.col("level") >= F.lit(0 if low is None else low)).select("tree", "level", "idx", "h", F.explode(F.sequence(F.lit(0), slices() - 1)).alias("slice"))
    found = asks.join(copies, ["tree", "level", "idx", "slice"]).select("tree", "block", "level", "idx", "h", F.lit(None).cast("array<int>").alias("places"), F.lit(None).cast("array<binary>").alias("siblings"))
    if tails is not None:
        spread = tails.select("tree", "places", "siblings", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
        ends = rows.select("tree", "block").distinct().withColumn("slice", F.expr(f"block div {FAN**depth}")).join(spread, ["tree", "slice"])
        found = found.union(ends.select("tree", "block", F.lit(-1), F.lit(-1).cast("long"), F.lit(None).cast("binary"), "places", "siblings"))

    found = found.toDF(*found.columns)  # columns of its own beside those of the rows
    more = [c for c in rows.columns if c != "block"]

    def expand(g: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        tail = got[got["level"] < 0]
        end = ([], []) if not len(tail) else (list(tail["places"].iat[0]), list(tail["siblings"].iat[0]))
        have = {(lv, i): h for lv, i, h in zip(got["level"], got["idx"], got["h"], strict=True) if lv >= 0}
        at, size, level, seen = g["idx"].to_numpy(), int(g["size"].iat[0]) if len(g) else 1, 0, dict(zip(g["idx"], g["h"], strict=True))
        places, siblings = [[] for _ in at], [[] for _ in at]
        while size > 1:
            runs: dict = {}
            for r in {i // FAN for i in seen}:
                runs[r] = b"".join(seen[i] if i in seen else have[level, i] for i in range(r * FAN, min(r * FAN + FAN, size)))
            for k, i in enumerate((at // FAN**level).tolist()):
                p, run = i % FAN, runs[i // FAN]
                places[k].append(p)
                siblings[k].append(run[:32 * p] + run[32 * p + 32:])
            seen = {r: parent(run) for r, run in runs.items()}
            level, size = level + 1, -(-size // FAN)
        return pd.DataFrame({c: g[c].tolist() for c in more}).assign(places=[p + end[0] for p in places], siblings=[s + end[1] for s in siblings])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.schema.fields)
    return rows.groupBy("tree", "block").cogroup(found.groupBy("tree", "block")).applyInPandas(expand, f"{types}, places array<int>, siblings array<binary>")


def fold(leaf: bytes, places: list[int], siblings: list[bytes]) -> bytes:
    """The top that a leaf and its proof lead to."""
    for p, s in zip(places, siblings, strict=True):
        leaf = parent(s[:32 * p] + leaf + s[32 * p:])
    return leaf


def manifest(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """doc_id, leaf, subroot, root, places, siblings and alt of every row: its proof to the root."""
    rows, langs = leaves(docs)
    base = rows.select("tree", F.lit(0).alias("level"), "idx", "size", F.col("leaf").alias("h"))
    lang_nodes = nodes(base, depth)
    count = langs.count()
    subroots = stored(lang_nodes.where("size = 1").select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"),
                                                          F.lit(count).cast("long").alias("size"), "h"), "subroots")
    top_nodes = nodes(subroots, depth)
    top = top_nodes.where("size = 1").first()
    root = bytes(top["h"]) if top else b""
    tails = prove(subroots, top_nodes, depth=depth).select(F.col("idx").alias("tree"), F.col("h").alias("subroot"), "places", "siblings")
    ends = stored(tails.join(langs.select("tree", F.expr(f"(size - 1) div {FAN ** (2 * depth)} + 1").alias("slices")), "tree"), "tails")
    # the subroot rides as the first part of the tail's digests, so that no second join is needed
    carried = ends.select("tree", "slices", F.concat(F.array(F.lit(-1)), "places").alias("places"), F.concat(F.array("subroot"), "siblings").alias("siblings"))
    id_type = rows.schema["doc_id"].dataType
    # ids travel as text: pandas would turn whole numbers beside nulls into doubles
    p = prove(rows.withColumnRenamed("leaf", "h").withColumn("doc_id", F.col("doc_id").cast("string")), lang_nodes, carried, depth)
    cut = F.array_position("places", -1).cast("int")
    drop = lambda c: F.concat(F.slice(c, F.lit(1), cut - 1), F.slice(c, cut + 1, F.size(c) - cut))
    return p.select(F.col("doc_id").cast(id_type).alias("doc_id"), F.col("h").alias("leaf"), F.element_at("siblings", cut).alias("subroot"), F.lit(root).alias("root"),
                    drop("places").alias("places"), drop("siblings").alias("siblings"), "alt")


def audit(proofs: DataFrame) -> DataFrame:
    """Digests in hex: leaf, subroot, root, that of the proof, the top folded from the tampered leaf
    (its own where the row is not tampered) and whether that is the root."""

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            use = [b if b is not None else a for a, b in zip(f["leaf"], f["alt"], strict=True)]
            tops = [fold(x, p, s) for x, p, s in zip(use, f["places"], f["siblings"], strict=True)]
            text = {c: [h.hex() for h in f[c]] for c in ("leaf", "subroot", "root")}
            yield pd.DataFrame({"doc_id": f["doc_id"], **text, "proof_sha256": [parent(b"".join(s)).hex() for s in f["siblings"]],
                                "folded_root": [t.hex() for t in tops], "verified": [t == r for t, r in zip(tops, f["root"], strict=True)]}, dtype=object)

    id_type = proofs.schema["doc_id"].dataType
    out = proofs.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        check, "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    return out.withColumn("doc_id", F.col("doc_id").cast(id_type))
