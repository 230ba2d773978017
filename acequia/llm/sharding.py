"""Shards of nearly equal bytes by sampled splitters.

Records are ordered by (hash of the text, doc_id, row). A size-weighted sample of
these keys gives quantile boundaries that cut the order into many small ranges;
ranges that turn out overfull are cut again by a denser sample of their own keys.
Exact sizes of the ranges then say where each shard begins, and a running sum
inside the ranges places every record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acequia.llm.ranges import before, sampled, splitters, with_range
from acequia.session import materialize

RANGES_PER_SHARD = 16
SAMPLES_PER_RANGE = 16
# A range is overfull beyond this many times the mean.
OVERFULL = 2.0
HEADER_BYTES = 8
KEY = ("h", "id", "row")


def shard_by_bytes(docs: DataFrame, shards: int, ranges_per_shard: int = RANGES_PER_SHARD,
                   samples_per_range: int = SAMPLES_PER_RANGE) -> DataFrame:
    """Shard and slot of every row: (doc_id, size, text_crc32, shard, slot).

    Size is the text's UTF-8 bytes plus 8 (null text: 8). Shards hold equal shares
    of the bytes up to one record at each end; slots count the rows of a shard from
    0 in key order. Equal texts are neighbours in the order, so that a group of
    copies stays together unless a shard ends inside it; a hot group is cut
    wherever the shares demand. Repeated rows and rows without id are placed like
    others; no rows give an empty result. Null texts have the checksum of no bytes.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    text = F.coalesce(F.col("text"), F.lit(""))
    records = materialize(
        docs.select(
            "doc_id",
            (F.octet_length(text) + HEADER_BYTES).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
            F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "records",
    )
    total = records.agg(F.sum("size")).first()[0] or 0
    ranges = shards * ranges_per_shard
    step = max(total / (ranges * samples_per_range), 1.0)
    cuts = splitters(sampled(records, KEY, "size", step, 1), KEY, ranges, "size", step)
    # subdivide ranges that the sample left overfull, by a denser sample of their own
    placed = with_range(records, KEY, cuts)
    full = placed.groupBy("range").agg(F.sum("size").alias("held")).filter(F.col("held") > OVERFULL * total / ranges)
    more = placed.join(F.broadcast(full), "range").drop("held")
    denser = step / ranges_per_shard
    cuts = sorted(set(cuts) | set(splitters(sampled(more, KEY, "size", denser, 2), KEY, ranges, "size", denser)))
    placed = with_range(records, KEY, cuts)
    # where each range begins, in bytes and rows; one row per range
    upto = before("range")
    starts = F.broadcast(
        placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        .select("range", F.coalesce(F.sum("bytes").over(upto), F.lit(0)).alias("byte0"),
                F.coalesce(F.sum("rows").over(upto), F.lit(0)).alias("row0"))
    )
    inside = Window.partitionBy("range").orderBy(*KEY)
    middle = F.col("byte0") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") / 2
    ranked = materialize(
        placed.join(starts, "range").select(
            "doc_id", "size", "text_crc32",
            F.least(F.floor(middle * shards / float(max(total, 1))), F.lit(shards - 1)).cast("int").alias("shard"),
            (F.col("row0") + F.row_number().over(inside) - 1).alias("rank"),
        ),
        "ranked",
    )
    first = F.broadcast(ranked.groupBy("shard").agg(F.min("rank").alias("first")))
    return ranked.join(first, "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("first")).alias("slot"))
