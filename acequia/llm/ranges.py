"""Order-preserving ranges from a size-weighted sample of keys."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sampled(records: DataFrame, keys: Sequence[str], size: str, step: float, seed: int) -> DataFrame:
    """Each record with probability min(1, size / step): a size-weighted sample of about total / step rows."""
    u = (F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    return records.filter(u * step < F.col(size))


def splitters(sample: DataFrame, keys: Sequence[str], ranges: int, size: str, step: float) -> list:
    """Quantile boundaries of the sample; its rows are bounded by the sample size, not by the data."""
    order = Window.orderBy("key")
    weighed = sample.select(F.struct(*keys).alias("key"), F.greatest(F.col(size) / step, F.lit(1.0)).alias("w"))
    part = F.floor(F.sum("w").over(order) * ranges / F.sum("w").over(Window.partitionBy()))
    cuts = weighed.select("key", part.alias("part")).groupBy("part").agg(F.max("key").alias("key"))
    return [r.key for r in cuts.orderBy("key").collect()]


def with_range(records: DataFrame, keys: Sequence[str], cuts: list) -> DataFrame:
    """Add `range`: how many splitters are at or below the record's key, found in two steps of about sqrt(splitters)."""
    if not cuts:
        return records.withColumn("range", F.lit(0))
    spark, kind = records.sparkSession, records.select(F.struct(*keys).alias("key")).schema["key"].dataType.simpleString()
    width = max(1, math.isqrt(len(cuts)))
    fine = [cuts[i:i + width] for i in range(0, len(cuts), width)]
    found = spark.createDataFrame(
        [(1, [block[0] for block in fine], fine)], f"one int, coarse array<{kind}>, fine array<array<{kind}>>"
    )
    key = F.struct(*keys)
    block = F.size(F.filter("coarse", lambda s: s <= key))
    inside = F.size(F.filter(F.element_at("fine", F.greatest(block, F.lit(1))), lambda s: s <= key))
    return (
        records.withColumn("one", F.lit(1)).join(F.broadcast(found), "one")
        .withColumn("range", F.when(block == 0, 0).otherwise((block - 1) * width + inside))
        .drop("one", "coarse", "fine")
    )


def before(order: Column | str) -> Window:
    """Everything before a row; only for tables with one row per range."""
    return Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
