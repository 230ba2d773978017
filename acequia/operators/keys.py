"""Dense surrogate keys without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acequia.operators.dedupe import names


def key_bucket(keys: Sequence[str], digits: int = 3) -> Column:
    """Leading hex digits of the key's MD5: 16**digits even buckets for distinct keys."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.substring(F.md5(F.concat_ws("-", *parts).cast("binary")), 1, digits)


def assign_ids(
    df: DataFrame,
    id_col: str,
    keys: str | Sequence[str],
    start: Column | int = 0,
    digits: int = 3,
) -> DataFrame:
    """Number distinct members `start + 1 … start + n` without gaps.

    Members are ranked inside hash buckets and each bucket continues after the
    ones before it. A bucket depends on the key alone, so the numbering is the
    same under any partitioning and after lost executors, and one hot bucket
    cannot arise from distinct keys. `keys` must identify a row.
    """
    keys = names(keys)
    marked = df.withColumn("_bucket", key_bucket(keys, digits))
    # at most 16**digits rows from here on, whatever the size of the input
    sizes = marked.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(*keys))
    base = start if isinstance(start, Column) else F.lit(start)
    return (
        marked.withColumn("_rank", rank)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(id_col, (base + F.col("_offset") + F.col("_rank")).cast("long"))
        .drop("_bucket", "_rank", "_offset")
    )


def max_id(df: DataFrame, id_col: str) -> Column:
    """Highest id in use as a scalar subquery, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long").alias("m")).scalar()
