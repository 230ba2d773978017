"""Type-1 upsert by natural key, change detection and load counts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acequia.functions.values import OPEN_END, as_date
from acequia.operators.dedupe import dedupe_keep_last, names
from acequia.operators.keys import assign_ids, max_id

CHANGE = "change_type"


def _differs(attrs: Sequence[str]) -> Column:
    test = F.lit(False)
    for c in attrs:
        test = test | ~F.col(f"b.{c}").eqNullSafe(F.col(f"c.{c}"))
    return test


def _keys_present(keys: Sequence[str]) -> Column:
    test = F.lit(True)
    for k in keys:
        test = test & F.col(k).isNotNull()
    return test


def upsert(
    current: DataFrame,
    batch: DataFrame,
    keys: str | Sequence[str],
    attrs: Sequence[str],
    order: str | Sequence[str],
    load_date: dt.date | str | None = None,
    id_col: str | None = None,
    stamps: Sequence[str] = (),
) -> DataFrame:
    """New snapshot of `current` after inserting or overwriting by key.

    Columns: those of `current` plus `change_type` (`inserted`, `updated`,
    `matched` when the batch brought nothing new, `kept` when it lacks the key).
    The last batch row of a key wins; rows with a null key are ignored. With a
    load date, inserted rows get a validity interval; with `id_col`, dense ids
    that follow the highest one in use, and known members keep theirs. `stamps` are
    batch columns that are overwritten like attributes but do not count as changes.
    """
    keys, attrs, stamps = names(keys), list(attrs), list(stamps)
    last = dedupe_keep_last(
        batch.filter(_keys_present(keys)).select(*dict.fromkeys([*keys, *attrs, *stamps, *names(order)])), keys, order
    ).select(*keys, *attrs, *stamps, F.lit(True).alias("_in"))
    on = [F.col(f"c.{k}") == F.col(f"b.{k}") for k in keys]
    seen = F.col("b._in").isNotNull()
    change = (
        F.when(F.col("c._old").isNull(), "inserted")
        .when(~seen, "kept")
        .when(_differs(attrs), "updated")
        .otherwise("matched")
    )
    known = current.withColumn("_old", F.lit(True)).alias("c")
    how = "left" if id_col else "full_outer"
    merged = known.join(last.alias("b"), on, how)
    validity = {}
    if load_date is not None:
        validity = {
            "valid_from": as_date(load_date), "valid_to": F.lit(OPEN_END), "is_current": F.lit(True),
        }
    out = []
    for c in current.columns:
        if c in keys:
            value = F.coalesce(f"c.{c}", f"b.{c}")
        elif c in attrs or c in stamps:
            value = F.when(seen, F.col(f"b.{c}")).otherwise(F.col(f"c.{c}"))
        elif c in validity:
            value = F.when(F.col("c._old").isNull(), validity[c]).otherwise(F.col(f"c.{c}"))
        else:
            value = F.col(f"c.{c}")
        out.append(value.alias(c))
    snapshot = merged.select(*out, change.alias(CHANGE))
    if not id_col:
        return snapshot
    # With ids, inserted rows take a way of their own: numbering needs their count.
    added = assign_ids(
        last.join(current.select(*keys), keys, "left_anti"), id_col, keys, max_id(current, id_col)
    )
    types = {f.name: f.dataType for f in current.schema.fields}
    return snapshot.unionByName(
        added.select(
            *[
                (F.col(c) if c in added.columns else validity.get(c, F.lit(None))).cast(types[c]).alias(c)
                for c in current.columns
            ],
            F.lit("inserted").alias(CHANGE),
        )
    )


def delta(current: DataFrame, batch: DataFrame, keys: str | Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """Batch rows that are new or differ from `current`; compares values, not hashes."""
    same = F.lit(True)
    for k in names(keys):
        same = same & (F.col(f"b.{k}") == F.col(f"c.{k}"))
    for a in attrs:
        same = same & F.col(f"b.{a}").eqNullSafe(F.col(f"c.{a}"))
    return batch.alias("b").join(current.select(*names(keys), *attrs).alias("c"), same, "left_anti")


def change_counts(snapshot: DataFrame) -> DataFrame:
    return snapshot.groupBy(CHANGE).agg(F.count(F.lit(1)).alias("n"))
