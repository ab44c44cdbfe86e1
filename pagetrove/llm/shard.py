"""Shards of near equal size by vector bin packing.

Documents with equal texts form a group, and a group is placed as a whole: each of its bytes, tokens
and rows counts. A group that alone would take more than a small share of a shard is cut into pieces
by a hash of the doc_id, however many rows it has; all other groups are gathered into a fixed number
of bundles by a hash of the text. So the packing sees a bounded number of items, whatever the table.
It takes them from the largest to the smallest, and puts each into the shard where the dot product of
its vector with what the shard still has room for is highest.
"""

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagetrove.llm.common import WORD
from pagetrove.session import settled

SIZES = ("bytes", "tokens", "rows")
GRAIN = 256  # items per shard, about
OVERHEAD = 16  # bytes of a document besides its text
RANGES = 32  # slots of a shard are counted in this many ranges at least
RANGE_ROWS = 1 << 20  # and in so many that none is expected to hold more rows


def pack(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every item. ``vectors`` has one row per item and one column per size."""
    shares = vectors / np.maximum(vectors.sum(axis=0), 1)
    room = np.full((shards, vectors.shape[1]), 1.0 / shards)
    placed = np.zeros(len(vectors), dtype=np.int64)
    for item in np.argsort(-shares.max(axis=1), kind="stable"):
        # The direction of the item decides, not its size; a tie goes to the lowest shard.
        best = int(np.argmax(room @ shares[item]))
        placed[item] = best
        room[best] -= shares[item]
    return placed


def assign(docs: DataFrame, shards: int, grain: int = GRAIN) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs`` (doc_id, text,
    any others).

    Size is the UTF-8 length plus 16 bytes, a null text has none and checksum 0. The law is ``bytes``:
    the shards' sizes are near equal, as far as single documents allow. ``slot`` numbers the rows of a
    shard from 0 without gaps; rows that repeat get slots of their own. ``grown_shard`` is null under
    this law. An empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = settled(docs.select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("group"),
    ), "shard-rows")
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    totals = rows.agg(*sums).first()
    if not totals["rows"]:
        return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                           F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"),
                           F.lit(None).cast("int").alias("grown_shard"))
    limits = {name: max(1.0, totals[name] / (shards * grain)) for name in SIZES}
    share = F.greatest(*[F.col(name) / F.lit(limit) for name, limit in limits.items()])
    # At most 3 * shards * grain groups can exceed a share of the totals, which bounds this broadcast.
    large = rows.groupBy("group").agg(*sums).where(share > 1).select(
        "group", F.when(F.col("rows") > 1, F.ceil(share)).otherwise(1).cast("long").alias("pieces"))
    items = rows.join(F.broadcast(large), "group", "left").withColumn(
        "item", F.when(
            F.col("pieces").isNull(), F.struct(
                F.lit(None).cast("long").alias("group"),
                F.pmod("group", F.lit(shards * grain)).alias("piece")))
        .otherwise(F.struct(
            F.col("group"), F.pmod(F.xxhash64("doc_id"), F.col("pieces")).alias("piece"))))
    found = items.groupBy("item").agg(*sums).select("item.group", "item.piece", *SIZES).orderBy(
        F.col("group").asc_nulls_first(), "piece").collect()
    vectors = np.array([[item[name] for name in SIZES] for item in found], dtype=np.float64)
    shard_of = docs.sparkSession.createDataFrame(
        [(item["group"], item["piece"], int(shard)) for item, shard in zip(found, pack(vectors, shards))],
        "of_group long, of_piece long, shard int")
    placed = items.join(
        F.broadcast(shard_of),
        F.col("item.group").eqNullSafe(F.col("of_group")) & (F.col("item.piece") == F.col("of_piece")))
    numbered = _slots(placed.select("doc_id", "size", "text_crc32", "shard"), shards, totals["rows"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                           F.lit(None).cast("int").alias("grown_shard"))


def _slots(rows, shards, total):
    """Number the rows of each shard. A shard's rows are counted in ranges of a hash, each range is
    numbered on its own, and is shifted by the rows of the ranges before."""
    ranges = max(RANGES, total // (shards * RANGE_ROWS))
    rows = rows.withColumn("range", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(ranges)))
    counts = rows.groupBy("shard", "range").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "range").orderBy("doc_id", "text_crc32", "size")
    return rows.withColumn("at", F.row_number().over(inside)).join(offsets, ["shard", "range"]).withColumn(
        "slot", F.col("before") + F.col("at") - 1)
