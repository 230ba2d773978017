"""Reductions to one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def names(value: str | Sequence[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def dedupe_keep_last(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """Last row of each key by the order columns, which must be total within a key.

    `row_number = 1` lets Spark keep only one row per key and map task before the
    shuffle (WindowGroupLimit), so a key that holds a third of the input sends one
    row per task.
    """
    latest = Window.partitionBy(*names(keys)).orderBy(*[F.col(c).desc() for c in names(order)])
    return df.withColumn("_rank", F.row_number().over(latest)).filter("_rank = 1").drop("_rank")


def duplicate_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count in `n`."""
    return df.groupBy(*names(keys)).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
