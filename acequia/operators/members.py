"""Members that facts mention before their dimension knows them, and dates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acequia.functions.text import join_key, to_text
from acequia.functions.values import OPEN_END, as_date, date_parts
from acequia.operators.keys import assign_ids, max_id


def missing_members(
    dim: DataFrame,
    fact: DataFrame,
    key: str,
    fact_key: str,
    attrs: Mapping[str, Column],
    id_col: str,
    load_date: dt.date | str | None = None,
) -> DataFrame:
    """Members for the fact keys that the dimension lacks, in the dimension's columns.

    `attrs` gives values for attribute columns, as aggregates over the fact rows of
    a key or as literals. Keys compare trimmed and in upper case.
    """
    wanted = (
        fact.filter(F.col(fact_key).isNotNull())
        .groupBy(join_key(F.col(fact_key)).alias("_key"))
        .agg(F.min(to_text(F.col(fact_key))).alias("_nk"), *[v.alias(f"_a_{c}") for c, v in attrs.items()])
    )
    new = wanted.join(dim.select(join_key(F.col(key)).alias("_key")), "_key", "left_anti")
    values = {key: F.col("_nk"), **{c: F.col(f"_a_{c}") for c in attrs}}
    if load_date is not None:
        values |= {"valid_from": as_date(load_date), "valid_to": F.lit(OPEN_END), "is_current": F.lit(True)}
    numbered = assign_ids(new, id_col, "_key", max_id(dim, id_col))
    values[id_col] = F.col(id_col)
    return numbered.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in dim.schema.fields]
    )


def add_missing_members(dim: DataFrame, *args, **kwargs) -> DataFrame:
    """The dimension with its missing members appended; see `missing_members`."""
    return dim.unionByName(missing_members(dim, *args, **kwargs))


def distinct_dates(fact: DataFrame, *date_cols: str) -> DataFrame:
    """Distinct non-null dates of one or more columns, in column `date`."""
    dates = F.explode(F.array(*[F.col(c).cast("date") for c in date_cols])).alias("date")
    return fact.select(dates).filter("date is not null").distinct()


def extend_dates(dim_date: DataFrame, dates: DataFrame) -> DataFrame:
    """The date dimension (date_id, date, year, month) with missing dates added."""
    new = dates.select("date").distinct().join(dim_date.select("date"), "date", "left_anti")
    year, month = date_parts(F.col("date"))
    added = assign_ids(new, "date_id", "date", max_id(dim_date, "date_id"))
    return dim_date.unionByName(
        added.select("date_id", "date", year.alias("year"), month.alias("month"))
    )
