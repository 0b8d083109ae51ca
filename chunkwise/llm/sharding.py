"""Vector bin packing into shards by bytes, tokens and rows (law ``bytes``).

Groups are equal texts, and a group lies in one shard unless none can hold it.  A group above
``LARGE`` of a shard (there are at most SHARDS / LARGE) is a unit of its own; the others fall into hash
units of graded size (coarse, fine, finest), so the driver places a number of units bounded by
``UNITS``, never documents.  Units go largest first to the shard where the dot product of the unit's
vector with the residual capacity is highest among shards with room in bytes.  A group larger than a
shard is dealt into ``PIECES`` by document id, which are placed one by one.  Slots are the offset of a
unit, or of a piece of a large group, plus the row number inside it, so no window holds a shard.

Null text has size 8, crc32 of nothing and no tokens, and is in the group of the empty text; rows equal in id and text are all kept and
ordered arbitrarily among themselves; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chunkwise.session import checkpoint_dir

SHARDS, GRADES, LARGE, PIECES = 24, (3072, 3072, 3072), 1 / 16, 256
UNITS = sum(GRADES) + int(SHARDS / LARGE) * PIECES  # rows that the driver sees at most


def place(vectors: np.ndarray, shards: int = SHARDS) -> np.ndarray:
    """Shard of each unit."""
    total = np.maximum(vectors.sum(0), 1)
    v = vectors / (total / shards)
    room, out = np.ones((shards, v.shape[1])), np.zeros(len(v), int)
    for i in np.lexsort((np.arange(len(v)), -v[:, 0])):
        fit = room[:, 0] >= v[i, 0]
        # equal bytes come first: without room anywhere the emptiest shard takes the unit
        s = int(np.argmax(np.where(fit, room @ v[i], -np.inf))) if fit.any() else int(np.argmax(room[:, 0]))
        room[s] -= v[i]
        out[i] = s
    return out


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    g = F.xxhash64(text)
    a, b, c = GRADES
    unit = (F.when(F.pmod(g, F.lit(100)) < 90, F.pmod(F.hash(g), F.lit(a)))
            .when(F.pmod(g, F.lit(100)) < 99, F.pmod(F.hash(g), F.lit(b)) + a).otherwise(F.pmod(F.hash(g), F.lit(c)) + a + b))
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.size(F.array_remove(F.split(text, r"\s+"), "")).cast("long").alias("tokens"),
                       g.alias("g"), unit.cast("int").alias("unit")).checkpoint()
    groups = rows.groupBy("g").agg(F.sum("size").alias("size"))
    total = groups.agg(F.sum("size")).first()[0] or 0
    large = groups.where(F.col("size") > total * LARGE / shards).collect()  # at most shards / LARGE
    whole = {sum(GRADES) + k: r["size"] <= total / shards for k, r in enumerate(large)}  # the others fit in no shard
    own = spark.createDataFrame([(r["g"], sum(GRADES) + k) for k, r in enumerate(large)], "g long, own int")
    rows = rows.join(F.broadcast(own), "g", "left")
    piece = F.when(F.col("own").isNotNull(), F.pmod(F.xxhash64("doc_id", "g"), F.lit(PIECES))).otherwise(0).cast("int")
    rows = rows.withColumn("piece", piece).withColumn("unit", F.coalesce("own", "unit")).drop("own")
    units = rows.groupBy("unit", "piece").agg(F.sum("size").alias("s"), F.sum("tokens").alias("t"), F.count("*").alias("n")).toPandas()
    units = units.sort_values(["unit", "piece"]).reset_index(drop=True)
    units["item"] = np.where(units["unit"].map(lambda u: whole.get(u, True)).astype(bool), 0, units["piece"])
    items = units.groupby(["unit", "item"], as_index=False)[["s", "t", "n"]].sum()
    items["shard"] = place(items[["s", "t", "n"]].to_numpy(float).reshape(-1, 3), shards)
    units = units.merge(items[["unit", "item", "shard"]], on=["unit", "item"]).sort_values(["unit", "piece"]).reset_index(drop=True)
    units["first"] = units.groupby("shard")["n"].cumsum() - units["n"]
    at = spark.createDataFrame([tuple(map(int, r)) for r in units[["unit", "piece", "shard", "first"]].itertuples(index=False)],
                               "unit int, piece int, shard int, first long")
    w = Window.partitionBy("unit", "piece").orderBy("g", "doc_id")
    return (rows.withColumn("r", F.row_number().over(w)).join(F.broadcast(at), ["unit", "piece"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("first") + F.col("r") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
