"""Star-join reports and their stored aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acequia.operators.history import current_only


def equipment_by_month(facts: DataFrame, equipment: DataFrame, dates: DataFrame) -> DataFrame:
    """Quantity per year, month and current equipment name, in calendar order."""
    return (
        facts.join(current_only(equipment).select("equipment_id", "equipment"), "equipment_id")
        .join(dates.select("date_id", "year", "month"), "date_id")
        .groupBy("year", "month", "equipment")
        .agg(F.sum("quantity").alias("total"))
        .orderBy("year", "month", "equipment")
    )


def top_equipment(facts: DataFrame, equipment: DataFrame, dates: DataFrame, n: int = 20) -> DataFrame:
    """The n largest rows of the monthly report; names break ties, so the result is stable."""
    return (
        equipment_by_month(facts, equipment, dates)
        .orderBy(F.desc("year"), F.desc("month"), F.desc("total"), "equipment")
        .limit(n)
    )


def services_by_insurer(facts: DataFrame, insurers: DataFrame) -> DataFrame:
    """Requests and items per current insurer, most requests first."""
    return (
        facts.join(current_only(insurers).select("insurer_id", "insurer"), "insurer_id")
        .groupBy("insurer")
        .agg(F.count(F.lit(1)).alias("requests"), F.sum("quantity").alias("items"))
        .orderBy(F.desc("requests"), "insurer")
    )


def stored_sums(changes: DataFrame, keys: Sequence[str], stored: DataFrame | None = None, measure: str = "quantity") -> DataFrame:
    """Sums by key after signed changes: (keys, n, total); keys without facts left go.

    `changes` has a `sign` of 1 or -1 per row (see `signed_changes`); `stored` are
    the sums so far of the keys concerned. Totals are decimals, so that what is
    added and taken off again leaves nothing behind.
    """
    value = F.col(measure).cast("decimal(28,6)")
    sums = changes.groupBy(*keys).agg(F.sum("sign").cast("long").alias("n"), F.sum(value * F.col("sign")).cast("decimal(38,6)").alias("total"))
    if stored is not None:
        both = stored.select(*keys, "n", "total").unionByName(sums)
        sums = both.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,6)").alias("total"))
    return sums.filter("n > 0")


def stored_equipment_by_month(sums: DataFrame, equipment: DataFrame) -> DataFrame:
    """`equipment_by_month` from sums by (year, month, equipment_id)."""
    return (
        sums.join(current_only(equipment).select("equipment_id", "equipment"), "equipment_id")
        .groupBy("year", "month", "equipment").agg(F.sum("total").cast("double").alias("total"))
        .orderBy("year", "month", "equipment")
    )


def stored_services_by_insurer(sums: DataFrame, insurers: DataFrame) -> DataFrame:
    """`services_by_insurer` from sums by (year, insurer_id)."""
    return (
        sums.join(current_only(insurers).select("insurer_id", "insurer"), "insurer_id")
        .groupBy("insurer").agg(F.sum("n").alias("requests"), F.sum("total").cast("double").alias("items"))
        .orderBy(F.desc("requests"), "insurer")
    )


def store_by_year(report: DataFrame, path: str, years: Sequence[int] | None = None) -> None:
    """Store a report partitioned by its `year`; with `years`, only those are replaced."""
    rows = report if years is None else report.filter(F.col("year").isin(*years))
    mode = "static" if years is None else "dynamic"
    rows.hint("rebalance", "year").write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("year").parquet(path)


def read_stored(spark: SparkSession, path: str, years: Sequence[int] | None = None) -> DataFrame:
    """A stored report; only the partitions of the given years are read."""
    stored = spark.read.parquet(path)
    return stored if years is None else stored.filter(F.col("year").isin(*years))


def inspect(df: DataFrame, where: Column | None = None, n: int = 10) -> DataFrame:
    """Any n rows, optionally of those that meet a condition."""
    return (df if where is None else df.filter(where)).limit(n)
