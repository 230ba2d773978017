"""Row filters, recoding and cleaning of raw exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from acequia.functions.text import DEMO_TOKEN, is_demo, squeeze_spaces, trim_text
from acequia.functions.values import null_literals

NOT_APPLICABLE = "No Aplica"


def drop_demo(df: DataFrame, col: str, token: str = DEMO_TOKEN) -> DataFrame:
    """Remove rows whose column contains the token; rows with null stay."""
    return df.filter(~is_demo(F.col(col), token))


def keep_filled(df: DataFrame, *cols: str) -> DataFrame:
    """Rows in which all the columns hold something other than white space."""
    for c in cols:
        df = df.filter(F.col(c).isNotNull() & (trim_text(F.col(c)) != ""))
    return df


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def _map_text(df: DataFrame, fn) -> DataFrame:
    names = text_columns(df)
    return df.withColumns({c: fn(F.col(f"`{c}`")) for c in names}) if names else df


def nulls_from_text(df: DataFrame) -> DataFrame:
    """Turn the usual spellings of a missing value into null, in every text column."""
    return _map_text(df, null_literals)


def clean_whitespace(df: DataFrame) -> DataFrame:
    return _map_text(df, squeeze_spaces)


def project(df: DataFrame, columns: Sequence[str], aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Select columns in order, renaming those listed in `aliases`."""
    aliases = aliases or {}
    return df.select(*[F.col(f"`{c}`").alias(aliases.get(c, c)) for c in columns])


def recode(
    df: DataFrame,
    col: str,
    catalogue: DataFrame,
    name_col: str,
    code_col: str,
    default: str = NOT_APPLICABLE,
) -> DataFrame:
    """Replace a name by its catalogue code.

    Names are compared after trimming. A name listed twice in the catalogue
    yields a row per listing; names without code, unknown names and nulls get
    the default. The catalogue is broadcast only if Spark sees that it is small.
    """
    coded = catalogue.select(
        trim_text(F.col(name_col).cast("string")).alias("_name"),
        trim_text(F.col(code_col).cast("string")).alias("_code"),
    )
    return (
        df.withColumn(col, trim_text(F.col(col).cast("string")))
        .join(coded, F.col(col) == F.col("_name"), "left")
        .withColumn(col, F.coalesce(F.col("_code"), F.lit(default)))
        .drop("_name", "_code")
    )


def split_valid(df: DataFrame, fk_cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every foreign key, rows that miss at least one)."""
    complete = all_filled(fk_cols)
    return df.filter(complete), df.filter(~complete)


def all_filled(cols: Sequence[str]) -> Column:
    test = F.lit(True)
    for c in cols:
        test = test & F.col(c).isNotNull()
    return test
