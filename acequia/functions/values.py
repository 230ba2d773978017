"""Numbers, dates and null literals as Column expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that a delimited reader takes for a missing value.
NULL_LITERALS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

DATE_FORMATS = (
    "yyyy-MM-dd", "d/M/yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "d/M/yyyy H:mm", "d/M/yyyy H:mm:ss",
)

NOT_A_NUMBER, NOT_FINITE, NOT_A_DATE = "not a number", "not finite", "not a date"

OPEN_END = dt.date(9999, 12, 31)

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def null_literals(c: Column) -> Column:
    return F.when(~c.isin(*NULL_LITERALS), c)


def to_number(c: Column, default: float = 0.0) -> Column:
    """Text to double; anything that is not a plain finite number gives the default."""
    text = F.trim(c.cast("string"))
    number = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    finite = number.isNotNull() & (F.abs(number) < F.lit(float("inf")))
    return F.when(finite, number).otherwise(F.lit(float(default)))


def parse_date(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that fits; null when none does.

    A format is tried on texts that hold its separators alone: a failed attempt
    costs several times a successful one.
    """
    return F.coalesce(*[F.when(_holds(c, f), F.try_to_timestamp(c, F.lit(f)).cast("date")) for f in formats])


def _holds(c: Column, fmt: str) -> Column:
    test = F.lit(True)
    for mark in "-/:":
        if mark in fmt:
            test = test & F.contains(c.cast("string"), F.lit(mark))
    return test


def checked_number(c: Column) -> Column:
    """Struct of `value` (double or null) and `reason`, why a text that is not blank gives none."""
    text = F.trim(c.cast("string"))
    number = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    finite = F.abs(number) < F.lit(float("inf"))
    reason = F.when(_blank(text), None).when(number.isNull(), NOT_A_NUMBER).when(~finite, NOT_FINITE)
    return F.struct(F.when(finite, number).alias("value"), reason.alias("reason"))


def checked_date(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Struct of `value` (date or null) and `reason`, as `checked_number`."""
    value = parse_date(c, formats)
    return F.struct(value.alias("value"), F.when(value.isNull() & ~_blank(F.trim(c.cast("string"))), NOT_A_DATE).alias("reason"))


def _blank(text: Column) -> Column:
    return text.isNull() | (null_literals(text).isNull())


def date_parts(c: Column) -> tuple[Column, Column]:
    return F.year(c), F.month(c)


def as_date(day: dt.date | str) -> Column:
    return F.lit(str(day)).cast("date")


def stamp(df: DataFrame, name: str, moment: dt.datetime | dt.date | str, kind: str = "timestamp") -> DataFrame:
    """Load stamp as a constant, so that re-executed tasks write the same value."""
    return df.withColumn(name, F.lit(str(moment)).cast(kind))
