"""Counts, integrity checks and monitoring of loaded tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acequia.functions.text import is_demo, join_key
from acequia.operators.dedupe import duplicate_keys, names


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def orphan_count(facts: DataFrame, fk_cols: Sequence[str]) -> DataFrame:
    """Facts with at least one null foreign key, in `orphans`."""
    bad = F.lit(False)
    for c in fk_cols:
        bad = bad | F.col(c).isNull()
    return facts.agg(F.count_if(bad).alias("orphans"))


def orphans(staged: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Staged keys unknown to the dimension, with their number of rows.

    Keys shrink to one row per task before the comparison.
    """
    return (
        staged.filter(F.col(key).isNotNull())
        .groupBy(join_key(F.col(key)).alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
        .join(dim.select(join_key(F.col(dim_key)).alias("key")), "key", "left_anti")
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _stack(
        [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table"), "n") for t, df in tables.items()]
    )


def load_monitor(tables: Mapping[str, DataFrame], loaded_at: str = "loaded_at") -> DataFrame:
    """Per table: time of the last load and number of rows."""
    return _stack(
        [
            df.agg(F.max(loaded_at).alias("last_load"), F.count(F.lit(1)).alias("n")).select(
                F.lit(t).alias("table"), "last_load", "n"
            )
            for t, df in tables.items()
        ]
    )


def cleaning_summary(report: DataFrame, recoded: DataFrame, demo_col: str, code_col: str, default: str) -> DataFrame:
    """One row: original, removed, final and uncoded rows, from one pass over each frame."""
    before = report.agg(
        F.count(F.lit(1)).alias("original"), F.count_if(is_demo(F.col(demo_col))).alias("removed")
    )
    after = recoded.agg(
        F.count(F.lit(1)).alias("final"), F.count_if(F.col(code_col) == default).alias("without_code")
    )
    return before.select(
        "original", "removed", after.select("final").scalar().alias("final"),
        after.select("without_code").scalar().alias("without_code"),
    )


def null_profile(df: DataFrame, table: str) -> DataFrame:
    """Nulls and rows per column, from one aggregation: (table, column, nulls, n)."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)],
    )
    pairs = ", ".join(f"'{c}', c{i}" for i, c in enumerate(df.columns))
    return counts.select(
        F.lit(table).alias("table"), F.expr(f"stack({len(df.columns)}, {pairs}) as (`column`, nulls)"), "n"
    )


def cast_rejects(df: DataFrame, casts: Mapping[str, Callable[[Column], Column]], keys: Sequence[str]) -> DataFrame:
    """Texts that a cast cannot read: (keys, column, text, reason), from one pass without a shuffle.

    `casts` gives for a column the function that makes its struct of value and
    reason (`checked_number`, `checked_date`). The rows themselves go on with a
    null or default; this is the list of what that hides.
    """
    tried = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("text"), cast(F.col(c))["reason"].alias("reason")) for c, cast in casts.items()]
    failed = F.filter(F.array(*tried), lambda x: x["reason"].isNotNull())
    return df.select(*keys, F.explode(failed).alias("_r")).select(*keys, "_r.column", "_r.text", "_r.reason")


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Rejected texts per column and reason."""
    return rejects.groupBy("column", "reason").agg(F.count(F.lit(1)).alias("n"))


def check(name: str, table: str, failures: DataFrame) -> DataFrame:
    """(check, table, failures, passed) from a one-row frame whose only column is the failure count."""
    count = F.col("failures").cast("long")
    return failures.toDF("failures").select(
        F.lit(name).alias("check"), F.lit(table).alias("table"), count.alias("failures"),
        (count == 0).alias("passed"),
    )


def check_no_demo(df: DataFrame, col: str, table: str) -> DataFrame:
    return check("no_demo", table, df.agg(F.count_if(is_demo(F.col(col)))))


def check_row_counts(staged: DataFrame, loaded: DataFrame, table: str) -> DataFrame:
    """Difference in rows between a staged and a loaded table."""
    other = loaded.agg(F.count(F.lit(1)).alias("n")).scalar()
    return check("row_counts", table, staged.agg(F.abs(F.count(F.lit(1)) - other)))


def check_foreign_keys(facts: DataFrame, fk_cols: Sequence[str], table: str) -> DataFrame:
    return check("foreign_keys", table, orphan_count(facts, fk_cols))


def check_references(staged: DataFrame, dim: DataFrame, key: str, dim_key: str, table: str) -> DataFrame:
    """Rows whose key the dimension lacks."""
    return check("references", table, orphans(staged, dim, key, dim_key).agg(F.coalesce(F.sum("n"), F.lit(0))))


def check_unique(df: DataFrame, keys: str | Sequence[str], table: str) -> DataFrame:
    """Number of keys that occur more than once."""
    return check("unique_key", table, duplicate_keys(df, names(keys)).agg(F.count(F.lit(1))))


def check_dates(dates: DataFrame, first: dt.date | str, last: dt.date | str, table: str) -> DataFrame:
    """Dates that are null, out of range, or do not agree with their year and month."""
    d = F.col("date")
    good = (
        d.isNotNull()
        & d.between(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date"))
        & (F.col("year") == F.year(d))
        & (F.col("month") == F.month(d))
    )
    return check("valid_dates", table, dates.agg(F.count_if(~F.coalesce(good, F.lit(False)))))


def check_history(history: DataFrame, table: str) -> DataFrame:
    """Keys whose versions are not sane; takes the result of `history_check`."""
    return check("history", table, history.agg(F.count_if(~F.col("sane"))))


def check_measure(staged: DataFrame, facts: DataFrame, measure: Column, fact_measure: Column, table: str) -> DataFrame:
    """1 when the sums of a measure differ between staging and facts by more than 0.005, else 0."""
    loaded = facts.agg(F.coalesce(F.sum(fact_measure), F.lit(0.0)).alias("s")).scalar()
    off = F.abs(F.coalesce(F.sum(measure), F.lit(0.0)) - loaded) > 0.005
    return check("measure", table, staged.agg(off.cast("long")))


def check_ids(facts: DataFrame, dim: DataFrame, id_col: str, table: str) -> DataFrame:
    """Facts whose id the dimension lacks; null ids are `check_foreign_keys`'s."""
    held = facts.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
    return check(f"ids_{id_col}", table, held.join(dim.select(id_col), id_col, "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0))))


def checksum(*cols: str | Column) -> Column:
    """Aggregate: order-free checksum of a multiset of rows, the exact sum of their hashes.

    The hashes are summed as long numbers of 20, 22 and 22 bits, which costs a
    fraction of a sum of decimals; the sums become one decimal at the end.
    """
    h, low = F.xxhash64(*cols), F.lit(2**22 - 1)
    pieces = {2**44: F.shiftright(h, 44), 2**22: F.shiftright(h, 22).bitwiseAND(low), 1: h.bitwiseAND(low)}
    total = F.lit(0)
    for weight, piece in pieces.items():
        total = total + F.sum(piece).cast("decimal(20,0)") * F.lit(weight).cast("decimal(15,0)")
    return total.cast("decimal(38,0)")


def stated(spark: SparkSession, checks: Sequence[tuple[str, str, int]]) -> DataFrame:
    """Checks whose failures are known already: (check, table, failures)."""
    rows = [(name, table, int(n), n == 0) for name, table, n in checks]
    return spark.createDataFrame(rows, "`check` string, `table` string, failures long, passed boolean")


def dq_report(checks: Sequence[DataFrame]) -> DataFrame:
    return _stack(list(checks))
