"""Type-2 history: versions with validity intervals."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acequia.functions.text import same_text, to_text
from acequia.functions.values import OPEN_END, as_date
from acequia.operators.keys import assign_ids, max_id
from acequia.operators.skew import HOT_ROWS, lookup, measure_hot, split_hot, with_last, with_previous, with_successor


# Versions of a key that are searched one by one.
FEW_VERSIONS = 64


def scd2(
    current: DataFrame,
    batch: DataFrame,
    key: str,
    tracked: Sequence[str],
    order_col: str,
    load_date: dt.date | str,
    id_col: str,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Apply a batch to a versioned dimension; returns its new snapshot.

    `current` holds id, key, tracked columns, `valid_from`, `valid_to` and
    `is_current`. Batch rows of a key apply in order; a row opens a version when it
    differs from the row before it, ignoring case and outer spaces, and a version
    with a successor is closed at the load date (half-open interval). Repeated
    batch rows count once, at their first position. Rows without key are ignored
    here; see `split_valid`. Keys with more than `hot_rows` batch rows are counted
    beforehand and folded in slices; None skips the count.

    Shuffles the current versions and the batch once, closed history not at all.
    """
    tracked = list(tracked)
    columns = [id_col, key, *tracked, "valid_from", "valid_to", "is_current"]
    day = as_date(load_date)
    rows = (
        batch.select(*[to_text(F.col(c)).alias(c) for c in (key, *tracked)], F.col(order_col).alias("_ord"))
        .filter(F.col(key).isNotNull())
        .groupBy(key, *tracked)
        .agg(F.min("_ord").alias("_ord"))
        .select(
            F.lit(None).cast("long").alias(id_col), key, *tracked,
            day.alias("valid_from"), F.lit(OPEN_END).alias("valid_to"), F.lit(True).alias("is_current"),
            "_ord",
        )
    )
    live = current.filter("is_current").select(*columns, F.lit(None).cast(rows.schema["_ord"].dataType).alias("_ord"))
    measured = batch.select(to_text(F.col(key)).alias(key), F.col(order_col).alias("_ord"))
    hot = measure_hot(measured, key, "_ord", hot_rows)
    fold = with_previous(split_hot(live.unionByName(rows), key, "_ord", hot), key, "_ord", tracked, hot)
    unchanged = F.col("_prev").isNotNull()
    for c in tracked:
        unchanged = unchanged & same_text(F.col(c), F.col(f"_prev.{c}"))
    versions = with_successor(fold.filter(~unchanged), key, "_ord", hot).select(
        id_col, key, *tracked, "valid_from",
        F.when(F.col("_followed"), day).otherwise(F.col("valid_to")).alias("valid_to"),
        (~F.col("_followed")).alias("is_current"),
        "_ord",
    )
    old = versions.filter(F.col("_ord").isNull()).select(*columns)
    new = assign_ids(
        versions.filter(F.col("_ord").isNotNull()), id_col, [key, "_ord"], max_id(current, id_col)
    ).select(*columns)
    return current.filter(~F.col("is_current")).select(*columns).unionByName(old).unionByName(new)


def current_only(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def as_of(fact: DataFrame, dim: DataFrame, key: str, date_col: str, id_col: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Add the id of the version valid on the fact's date, null when there is none.

    A fact takes the version that began last, if that has not ended. So a fact never
    becomes two rows, also where a broken history overlaps (of versions that begin
    together the one that ends last counts). Versions opened and closed on one day
    are empty intervals and are left out. Facts without key or date have no version.

    Where no key has more than FEW_VERSIONS, each key's versions are one row and the
    facts look theirs up, which needs no shuffle of the facts if Spark sees that the
    versions are small. Otherwise versions and facts of a key go by once, in the
    order of their dates: work is linear in facts and versions, and keys with more
    than `hot_rows` of them go by in slices, each beginning with the last version
    of those before it.
    """
    kind = "date" if dim.schema["valid_from"].dataType == fact.schema[date_col].dataType else "timestamp"
    version = F.struct(F.col("valid_to").cast(kind).alias("to"), F.col(id_col).alias("id"))
    versions = dim.filter("valid_from < valid_to").select(
        F.col(key).alias("_key"), F.col("valid_from").cast(kind).alias("_at"), version.alias("_version"), F.lit(False).alias("_later"))
    rows = fact.select(F.col(key).alias("_key"), F.col(date_col).cast(kind).alias("_at"), F.struct("*").alias("_fact"))
    placed = F.col("_key").isNotNull() & F.col("_at").isNotNull()
    both = versions.withColumn("_fact", F.lit(None).cast(rows.schema["_fact"].dataType)).unionByName(
        rows.filter(placed).withColumns({"_version": F.lit(None).cast(versions.schema["_version"].dataType), "_later": F.lit(True)}))
    most = versions.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if most <= FEW_VERSIONS:
        listed = versions.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("_at", "_version"))).alias("_versions"))
        held = lookup(rows, listed, "_key").withColumn("_last", F.get(F.reverse(F.filter("_versions", lambda v: v["_at"] <= F.col("_at"))), F.lit(0))["_version"])
        return held.select("_fact.*", F.when(F.col("_at") < F.col("_last.to"), F.col("_last.id")).alias(id_col))
    hot = measure_hot(both, "_key", "_at", hot_rows)
    passed = with_last(split_hot(both, "_key", "_at", hot), "_key", ["_at", "_later", "_version"], "_version", hot)
    found = F.when(F.col("_at") < F.col("_last.to"), F.col("_last.id"))
    held = passed.filter("_fact is not null").select("_fact.*", found.alias(id_col))
    return held.unionByName(rows.filter(~placed).select("_fact.*", F.lit(None).cast(dim.schema[id_col].dataType).alias(id_col)))


def history_check(dim: DataFrame, key: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Per key: versions, current versions, overlapping neighbours and a verdict.

    Versions sharing a start are ordered by their end. Hot keys are checked in slices.
    """
    order = ["valid_from", "valid_to"]
    hot = measure_hot(dim, key, order, hot_rows)
    chained = with_previous(split_hot(dim, key, order, hot), key, order, ["valid_to"], hot)
    return (
        chained.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("versions"),
            F.count_if("is_current").alias("current_versions"),
            F.count_if(F.col("_prev.valid_to") > F.col("valid_from")).alias("overlaps"),
        )
        .withColumn("sane", (F.col("current_versions") == 1) & (F.col("overlaps") == 0))
    )


def version_changes(before: DataFrame, after: DataFrame, id_col: str) -> DataFrame:
    """Count of versions that a load opened, closed and kept."""
    was = before.select(F.col(id_col), F.col("is_current").alias("_was"))
    change = (
        F.when(F.col("_was").isNull(), "opened")
        .when(F.col("_was") & ~F.col("is_current"), "closed")
        .otherwise("kept")
    )
    return (
        lookup(after, was, id_col)
        .groupBy(change.alias("change_type"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
