"""8. Sharding by vector bin packing."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewire.llm.common import gapless_rank, read, session, text_of, word_count
from tidewire.storage import Scratch, cell_rows

SHARDS = 40
#: Bytes that a row takes besides its text.
ROW_BYTES = 16
#: Groups of texts above this share of a shard, in any dimension, are placed on their own.
OWN_SHARE = 1 / 256
#: Groups of more than a shard, in any dimension, are split into pieces of about this share of one.
PIECE_SHARE = 1 / 32
#: Bundles of small groups for each shard.
BUNDLES = 256
#: How much bytes, tokens and rows count in the dot product.
DIMENSIONS = (4.0, 1.0, 1.0)


def place(sizes: np.ndarray, bins: int, weights: tuple[float, ...] = DIMENSIONS) -> np.ndarray:
    """The bin of each item (a row of `sizes`, any units): items in decreasing order of their
    weighted sum go where the weighted dot product with the residual capacity is highest.
    Coordinates are shares of a bin's capacity, which is the total divided by `bins`; a bin that is
    over in one dimension has a negative residual there. Ties go to the lowest bin."""
    total = np.maximum(sizes.sum(axis=0), 1)
    items = sizes * bins / total
    residual = np.ones((bins, sizes.shape[1]))
    scale = np.asarray(weights)
    out = np.zeros(len(items), dtype=np.int64)
    for i in np.lexsort((np.arange(len(items)), -(items @ scale))):
        b = int(np.argmax(residual @ (items[i] * scale)))
        residual[b] -= items[i]
        out[i] = b
    return out


def shard(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size, text_crc32, law, shard, slot, grown_shard for each row: sizes (UTF-8 bytes plus
    16) near equal over the shards (law `bytes`), tokens (words) and rows balanced with them.

    Equal texts are a group and stay together; only a group that alone is more than a shard is split,
    into pieces by a hash of the key and the row's number in the scan, so that rows that repeat are
    split as well. Groups larger than OWN_SHARE of a shard are packed one by one,
    at most 3 * shards / OWN_SHARE of them. All smaller groups are dealt by their hash to a fixed
    number of bundles, which are packed like groups. So the driver packs a bounded number of items
    at any size, and the largest group is spread like any data.

    A null text has no bytes and is in one group with empty ones. Rows that repeat are each placed.
    No rows give no rows. Columns other than the two named are not read.
    """
    spark, scratch = session(docs), Scratch(session(docs), "shard")
    t = text_of(text)
    base = scratch.table(
        docs.select(
            F.col(key).alias("key"), (F.octet_length(t) + ROW_BYTES).cast("long").alias("size"), word_count(t).alias("tokens"),
            F.crc32(t.cast("binary")).alias("text_crc32"), F.sha2(t, 256).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "rows",
    )
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    total = base.agg(*sums).first()
    n = total["rows"]
    groups = scratch.table(base.groupBy("digest").agg(*sums), "groups")
    bundle = F.pmod(F.xxhash64("digest"), F.lit(shards * BUNDLES))
    share = F.greatest(*[F.col(c) * (shards / max(total[c] or 0, 1)) for c in ("size", "tokens", "rows")])
    large = groups.where(share > OWN_SHARE).select("digest", F.when(share > 1, F.ceil(share / PIECE_SHARE)).otherwise(1).cast("long").alias("pieces"))
    large = scratch.table(large, "large")  # at most 3 * shards / OWN_SHARE rows
    item = F.when(F.col("pieces").isNull(), F.concat(F.lit("b"), bundle.cast("string"))).otherwise(
        F.concat("digest", F.lit(":"), F.pmod(F.xxhash64("key", "row", F.lit("piece")), F.coalesce("pieces", F.lit(1))).cast("string"))
    )
    items = base.join(F.broadcast(large), "digest", "left").withColumn("item", item)
    packed = items.groupBy("item").agg(*sums).orderBy("item").collect()  # bounded by the two constants
    sizes = np.array([[r["size"], r["tokens"], r["rows"]] for r in packed], dtype=np.float64).reshape(-1, 3)
    plan = spark.createDataFrame([(r["item"], int(b)) for r, b in zip(packed, place(sizes, shards))], "item string, shard int")
    cells = max(1, math.ceil(n / shards / cell_rows(n)))
    placed = items.join(F.broadcast(plan), "item").select("key", "row", "size", "text_crc32", "shard")
    placed = scratch.table(placed, "placed")
    ranked = gapless_rank(placed, ["shard"], F.pmod(F.xxhash64("key", "row"), F.lit(cells)), [F.col("key"), F.col("text_crc32")], "slot")
    return ranked.select(
        F.col("key").alias(key), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_vector_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents"))
