"""Help for keys that hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from acequia.operators.dedupe import names
from acequia.session import materialize

HOT_ROWS = 1_000_000
CHUNKS = 64


def lookup(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Equi join of a large side that may hold hot keys with a side unique per key.

    A right side that Spark measures as small is broadcast. Otherwise AQE splits
    hot partitions of a sort-merge join, but only where both inputs come straight
    from a shuffle made for this join. A right side that is itself an aggregate is
    already partitioned by the key and would suppress that, hence the key's hash
    as one more join column: it forces a shuffle of its own on both sides. Four
    bits of it do, and hardly add to what is shuffled.
    """
    keys = names(on)
    route = F.pmod(F.hash(*[F.col(k) for k in keys]), F.lit(16)).cast("byte")
    return (
        left.withColumn("_route", route)
        .join(right.withColumn("_route", route), [*keys, "_route"], how)
        .drop("_route")
    )


def widen(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a small input of heavy work over all cores.

    AQE merges small shuffle partitions by their bytes and cannot know that each
    row is about to become hundreds; a fixed number of partitions is left alone.
    """
    session = df.sparkSession
    n = max(int(session.conf.get("spark.sql.shuffle.partitions")), session.sparkContext.defaultParallelism)
    return df.repartition(n, *keys)


def measure_hot(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    min_rows: int | None = HOT_ROWS,
    chunks: int = CHUNKS,
) -> DataFrame | None:
    """Keys with more than `min_rows` rows and cut points of their order, or None.

    Runs one count per key (combined map-side), so that the usual input without hot
    keys gets the plain plan. All hot keys are found, in a stored table of `chunks`
    values for each, of which nothing reaches the driver; the table has at most
    1/min_rows of the rows. `min_rows=None` skips the count. The first order column
    must be a number, date or timestamp.
    """
    keys, first = names(keys), names(order)[0]
    kind = df.schema[first].dataType
    if not isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType)):
        raise TypeError(f"order column {first!r} must be a number, date or timestamp, not {kind.simpleString()}")
    if min_rows is None:
        return None
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > min_rows).select(*keys)
    if hot.isEmpty():
        return None
    cuts = [i / chunks for i in range(1, chunks)]
    hot = materialize(hot, "hot_keys").withColumn("_hot", F.lit(True))
    bounds = (
        lookup(df.select(*keys, first), hot, keys, "inner")
        .groupBy(*keys)
        .agg(F.percentile_approx(first, cuts).alias("_bounds"))
    )
    return materialize(bounds, "hot_bounds")


def split_hot(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], hot: DataFrame | None) -> DataFrame:
    """Add `_chunk`: consecutive ranges of the first order column for hot keys, null for others.

    Windows over (keys, _chunk) then see a slice of a hot key at a time. Null orders
    fall into the first slice. Takes the result of `measure_hot`.
    """
    if hot is None:
        return df
    first = F.col(names(order)[0])
    within = F.size(F.filter("_bounds", lambda b: b <= first))
    return (
        lookup(df, hot, keys)
        .withColumn("_chunk", F.when(F.col("_bounds").isNotNull(), within))
        .drop("_bounds")
    )


def _in_order(keys: Sequence[str], order: Sequence[str], hot: DataFrame | None):
    groups = keys if hot is None else [*keys, "_chunk"]
    return Window.partitionBy(*groups).orderBy(*[F.col(c).asc_nulls_first() for c in order])


def with_previous(
    df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], cols: Sequence[str], hot: DataFrame | None
) -> DataFrame:
    """Add struct `_prev` of the columns in the preceding row of the key, null in its first row.

    Expects the `_chunk` of `split_hot`. Inside a slice this is `lag`; the first row
    of a later slice takes the last row of the slice before it, from a table of one
    row per hot key and slice.
    """
    keys, order = names(keys), names(order)
    row = F.struct(*cols)
    out = df.withColumn("_prev", F.lag(row).over(_in_order(keys, order, hot)))
    if hot is None:
        return out
    ends = (
        df.filter(F.col("_chunk").isNotNull())
        .groupBy(*keys, "_chunk")
        .agg(F.max_by(row, F.struct(*order)).alias("_end"))
        .withColumn("_before", F.lag("_end").over(Window.partitionBy(*keys).orderBy("_chunk")))
        .select(*keys, "_chunk", "_before")
        .filter(F.col("_before").isNotNull())
    )
    return (
        out.join(ends, [*keys, "_chunk"], "left")
        .withColumn("_prev", F.coalesce("_prev", "_before"))
        .drop("_before")
    )


def with_last(
    df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], col: str, hot: DataFrame | None
) -> DataFrame:
    """Add `_last`: the last non-null value of a column up to each row of the key. Expects the `_chunk` of `split_hot`.

    Later slices of a hot key take over the last value of the slices before them,
    from a table of one row per hot key and slice.
    """
    keys, order = names(keys), names(order)
    upto = _in_order(keys, order, hot).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df.withColumn("_last", F.last(col, ignorenulls=True).over(upto))
    if hot is None:
        return out
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        df.filter(F.col("_chunk").isNotNull())
        .groupBy(*keys, "_chunk")
        .agg(F.max_by(col, F.when(F.col(col).isNotNull(), F.struct(*order))).alias("_end"))
        .select(*keys, "_chunk", F.last("_end", ignorenulls=True).over(earlier).alias("_before"))
        .filter(F.col("_before").isNotNull())
    )
    return out.join(ends, [*keys, "_chunk"], "left").withColumn("_last", F.coalesce("_last", "_before")).drop("_before")


def with_successor(
    df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], hot: DataFrame | None
) -> DataFrame:
    """Add boolean `_followed`: the key has a later row. Expects the `_chunk` of `split_hot`."""
    keys, order = names(keys), names(order)
    out = df.withColumn("_followed", F.lead(F.lit(True), 1, False).over(_in_order(keys, order, hot)))
    if hot is None:
        return out
    last = (
        df.filter(F.col("_chunk").isNotNull())
        .groupBy(*keys)
        .agg(F.max("_chunk").alias("_last"))
    )
    later = F.coalesce(F.col("_chunk") < F.col("_last"), F.lit(False))
    return (
        lookup(out, last, keys)
        .withColumn("_followed", F.col("_followed") | later)
        .drop("_last")
    )
