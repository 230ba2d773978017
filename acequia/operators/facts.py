"""Fact loads: key resolution, validation, composite keys and upserts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acequia.functions.text import composite_key, join_key, key_part
from acequia.functions.values import stamp
from acequia.operators.cleaning import split_valid
from acequia.operators.dedupe import dedupe_keep_last
from acequia.operators.skew import lookup
from acequia.operators.upsert import CHANGE, upsert

REQUEST_ID = "request_id"
LOADED_AT = "loaded_at"


@dataclass(frozen=True)
class Reference:
    """How a staged column finds its dimension row: by normalised text key, or by date."""

    column: str
    dim: DataFrame
    key: str
    id_col: str
    is_date: bool = False


def resolve_keys(staged: DataFrame, references: Sequence[Reference]) -> DataFrame:
    """Add each dimension's id, null where it has no such key.

    Only key and id of a dimension take part. Keys that differ in case or outer
    spaces alone are one key here, and the member with the lowest id stands for
    it, so that a staged row never becomes two; `key_twins` reports them. Spark
    broadcasts dimensions that it measures as small and splits hot keys for the
    others.
    """
    for ref in references:
        normal = (lambda c: c.cast("date")) if ref.is_date else join_key
        ids = ref.dim.groupBy(normal(F.col(ref.key)).alias("_key")).agg(F.min(ref.id_col).alias(ref.id_col))
        staged = lookup(staged.withColumn("_key", normal(F.col(ref.column))), ids, "_key").drop("_key")
    return staged


def key_twins(dim: DataFrame, key: str) -> DataFrame:
    """Keys of a dimension that differ in case or outer spaces alone: (join_key, spellings)."""
    found = dim.filter(F.col(key).isNotNull()).groupBy(join_key(F.col(key)).alias("join_key"))
    return found.agg(F.sort_array(F.collect_set(key)).alias("spellings")).filter(F.size("spellings") > 1)


def fact_rows(
    staged: DataFrame,
    references: Sequence[Reference],
    pk_cols: Sequence[str],
    quantity: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(valid rows with request id, foreign keys and quantity; rejected staged rows with their ids).

    The key columns become non-null texts. Without `quantity` every row counts once.
    """
    return split_facts(resolve_keys(staged, references), references, pk_cols, quantity)


def split_facts(
    resolved: DataFrame, references: Sequence[Reference], pk_cols: Sequence[str], quantity: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """`fact_rows` of rows whose keys are resolved already."""
    valid, rejects = split_valid(resolved, [r.id_col for r in references])
    rows = valid.withColumns({
        REQUEST_ID: composite_key(*[F.col(c) for c in pk_cols]),
        "quantity": (F.lit(1) if quantity is None else quantity).cast("double"),
        **{c: key_part(F.col(c)) for c in pk_cols},
    })
    return rows, rejects


def measures(references: Sequence[Reference]) -> list[str]:
    """What a fact holds beside its key and load stamp."""
    return [REQUEST_ID, *[r.id_col for r in references], "quantity"]


def load_facts(
    current: DataFrame,
    staged: DataFrame,
    references: Sequence[Reference],
    pk_cols: Sequence[str],
    order: str | Sequence[str],
    load_ts: dt.datetime | str,
    quantity: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(new fact snapshot with `change_type`, rejected rows).

    `current` holds the key columns as texts. Of several staged rows with one key
    the last stays. Loaded rows carry the load stamp, untouched rows keep theirs; a
    row whose values did not change counts as `matched` and is stamped as well.
    `fact_changes` and `merged_partitions` are the way for facts in partitions.
    """
    rows, rejects = fact_rows(staged, references, pk_cols, quantity)
    snapshot = upsert(current, stamp(rows, LOADED_AT, load_ts), list(pk_cols), measures(references), order, stamps=[LOADED_AT])
    return snapshot, rejects


def latest_facts(rows: DataFrame, pk_cols: Sequence[str], order: str | Sequence[str]) -> DataFrame:
    return dedupe_keep_last(rows, pk_cols, order)


def fact_changes(stored: DataFrame, rows: DataFrame, pk_cols: Sequence[str], attrs: Sequence[str], partition_cols: Sequence[str]) -> DataFrame:
    """The rows (one per key) with `change_type` and `_was`, the stored values and partition of their key.

    `inserted` rows have no `_was`; `updated` ones differ from it in a value or in
    their partition; `matched` ones bring nothing new. `stored` may be limited to
    the partitions that can hold the keys. Only keys, values and partition of the
    stored facts are read.
    """
    values = [*attrs, *partition_cols]
    before = stored.select(*pk_cols, F.struct(*values).alias("_was"))
    joined = rows.join(before, list(pk_cols), "left")
    differs = F.lit(False)
    for c in values:
        differs = differs | ~F.col(c).eqNullSafe(F.col("_was")[c])
    change = F.when(F.col("_was").isNull(), "inserted").when(differs, "updated").otherwise("matched")
    return joined.withColumn(CHANGE, change)


def partitions_touched(changes: DataFrame, partition_cols: Sequence[str]) -> list[tuple]:
    """Partitions that changes go to or come from: one row for each reaches the driver."""
    now = changes.select(*partition_cols)
    before = changes.filter("_was is not null").select(*[F.col("_was")[c].alias(c) for c in partition_cols])
    return sorted((tuple(r) for r in now.union(before).distinct().collect()), key=str)


def merged_partitions(stored: DataFrame, changes: DataFrame, pk_cols: Sequence[str]) -> DataFrame:
    """The stored facts of the touched partitions with the inserted and updated rows in place of their own."""
    others = stored.join(changes.select(*pk_cols), list(pk_cols), "left_anti")
    return others.unionByName(changes.select(*stored.columns))


def places_of(stored: DataFrame, rows: DataFrame, pk_cols: Sequence[str], partition_cols: Sequence[str]) -> list[tuple]:
    """Partitions that hold facts with the rows' keys; reads nothing but keys and partitions of the stored facts."""
    held = stored.select(*pk_cols, *partition_cols).join(rows.select(*pk_cols), list(pk_cols), "left_semi")
    return sorted((tuple(r) for r in held.select(*partition_cols).distinct().collect()), key=str)


def signed_changes(changes: DataFrame, values: Sequence[str]) -> DataFrame:
    """What the changes take from and add to sums: the old values with `sign` -1, the new ones with 1."""
    new = changes.select(*values, F.lit(1).alias("sign"))
    old = changes.filter("_was is not null").select(*[F.col("_was")[c].alias(c) for c in values], F.lit(-1).alias("sign"))
    return new.unionByName(old)


def id_twins(facts: DataFrame, pk_cols: Sequence[str]) -> DataFrame:
    """Request ids that stand for several keys, because parts hold the dash that joins them: (request_id, keys)."""
    distinct = facts.select(REQUEST_ID, *pk_cols).distinct()
    return distinct.groupBy(REQUEST_ID).agg(F.count(F.lit(1)).alias("keys")).filter("keys > 1")


def fk_counts(resolved: DataFrame, labels: Mapping[str, str], limit: float = 0.05) -> DataFrame:
    """One row: rows, valid, rejected, share rejected, alert flag and misses per key.

    `labels` maps id columns to the names of their miss counts.
    """
    missing = {name: F.count_if(F.col(c).isNull()).alias(name) for c, name in labels.items()}
    ok = F.lit(True)
    for c in labels:
        ok = ok & F.col(c).isNotNull()
    counts = resolved.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(ok).alias("valid"), *missing.values())
    share = F.coalesce(F.col("rejected") / F.when(F.col("n_rows") > 0, F.col("n_rows")), F.lit(0.0))
    return (
        counts.withColumn("rejected", F.col("n_rows") - F.col("valid"))
        .withColumn("rejected_share", share)
        .withColumn("alert", F.col("rejected_share") > limit)
    )
