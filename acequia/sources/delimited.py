"""Delimited text files, always read as text columns."""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from acequia.functions.values import null_literals
from acequia.operators.cleaning import nulls_from_text

# Encodings to try, under the names Spark knows them by.
UTF8, LATIN1 = "UTF-8", "ISO-8859-1"
SEPARATORS = ";,\t|"
SURPLUS, OPEN_QUOTE = "surplus fields", "quote left open"
_RAW = "_raw_record"  # where Spark puts rows with more or fewer fields than the header
_INVISIBLE = "\ufeff\u200b\u200c\u200d\u2060\u00a0"


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of a location on any storage that Spark reads."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def require_inputs(spark: SparkSession, paths: Sequence[str]) -> None:
    """Raise one error that names every missing input."""
    missing = []
    for path in paths:
        fs, jpath = _hadoop(spark, path)
        if not fs.exists(jpath):
            missing.append(path)
    if missing:
        raise FileNotFoundError("missing inputs: " + ", ".join(missing))


def separator_of(header: str, separators: str = SEPARATORS, default: str = SEPARATORS[0]) -> str:
    """Separator of a header line; the default for a header of one column."""
    if not any(c in header for c in separators):
        return default
    try:
        return csv.Sniffer().sniff(header, separators).delimiter
    except csv.Error as err:
        raise ValueError(f"no separator found in the header {header[:80]!r}") from err


@dataclass(frozen=True)
class FileFormat:
    """How a file is to be read: `multiline` if a quoted field holds a line break, `open` if its last quote is never closed."""

    file: str
    header: str
    sep: str
    encoding: str
    multiline: bool = False
    open: bool = False


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("at"),
    )


def file_formats(spark: SparkSession, path: str, separators: str = SEPARATORS) -> list[FileFormat]:
    """Format of every file under a path, one row per file on the driver.

    The encoding is decided over all lines of a file, in Spark: UTF-8 if all are
    valid UTF-8, else Latin-1, which decodes any bytes. Files with quotes are looked
    at once more, to find quoted line breaks (`quote_states`).
    """
    files = _lines(spark, path).groupBy("file").agg(
        F.bool_and(F.is_valid_utf8("value")).alias("utf8"), F.max(F.contains("value", F.lit('"'))).alias("quoted"),
        F.min(F.when(F.col("at.block") == 0, F.struct("at", F.col("value").cast("binary").alias("raw")))).alias("first"),
    )
    out, quoted = [], defaultdict(list)
    for r in files.orderBy("file").collect():
        encoding = UTF8 if r.utf8 else LATIN1
        header = bytes(r.first.raw).decode("utf-8-sig" if r.utf8 else "latin-1").rstrip("\r")
        out.append(FileFormat(r.file, header, separator_of(header, separators), encoding))
        if r.quoted:
            quoted[out[-1].sep].append(r.file)
    if not out:
        raise FileNotFoundError(f"no data in {path}")
    states = {file: state for sep, files in quoted.items() for file, state in quote_states(spark, files, sep).items()}
    return [replace(f, multiline=states.get(f.file, (False, False))[0], open=states.get(f.file, (False, False))[1]) for f in out]


def _field(sep: str) -> str:
    """Pattern of one field: quoted with doubled quotes inside, or plain; a plain one may hold quotes behind its first character."""
    c = re.escape(sep)
    return f'(?:"[^"]*+(?:""[^"]*+)*+"[^{c}]*+|[^{c}"][^{c}]*+|)'


def quote_states(spark: SparkSession, files: Sequence[str], sep: str) -> dict[str, tuple[bool, bool]]:
    """By file: does a quoted field go over the end of a line, and is a quote still open at the end.

    A line takes the state before it, in a quoted field or not, to the state
    behind it. Lines without quotes keep it; others may set it, or turn it around.
    So the last line that sets it and the number of turns after it give the state
    at the end, and no line needs those before it. Without a line that opens a
    quote from outside, no field is ever left open.
    """
    opens = f'(?s)^(?:{_field(sep)}{re.escape(sep)})*+"[^"]*+(?:""[^"]*+)*+$'
    lines = _lines(spark, list(files)).filter(F.contains("value", F.lit('"')))
    outside, inside = F.col("value").rlike(opens), F.concat(F.lit('"'), F.col("value")).rlike(opens)
    kinds = lines.select("file", "at", outside.alias("opens"), F.when(outside == inside, outside).alias("sets"), (outside & ~inside).alias("turns"))
    last = kinds.groupBy("file").agg(
        F.max("opens").alias("opens"), F.max(F.when(F.col("sets").isNotNull(), F.struct("at", "sets"))).alias("last"))
    after = kinds.join(last.select("file", "last"), "file").filter("turns and (last is null or at > last.at)")
    turns = after.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    found = last.join(turns, "file", "left").collect()  # a row for each file
    return {r.file: (r.opens, (bool(r.last and r.last.sets) + (r.n or 0)) % 2 == 1) for r in found}


def detect_format(spark: SparkSession, path: str, separators: str = SEPARATORS) -> tuple[str, str]:
    """(separator, encoding) shared by all files under a path."""
    found = {(f.sep, f.encoding) for f in file_formats(spark, path, separators)}
    if len(found) > 1:
        raise ValueError(f"files under {path} differ in format: {sorted(found)}")
    return found.pop()


def _clean(name: str) -> str:
    return name.translate(str.maketrans("", "", _INVISIBLE)).strip()


def clean_headers(df: DataFrame) -> DataFrame:
    """Trim column names and remove byte-order marks and invisible characters."""
    return df.toDF(*[_clean(c) for c in df.columns])


def read_with_rejects(
    spark: SparkSession,
    path: str,
    sep: str | None = None,
    encoding: str | None = None,
    schema: StructType | None = None,
    columns: Sequence[str] | None = None,
    multiline: bool = False,
    order: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected rows) of the delimited files under a path, all columns as text.

    Each file has its own separator and encoding (detected when not given) and its
    own column order: columns are found by header name, those that a file lacks
    are null. Quotes inside quoted fields are doubled. Files in which a quoted field
    holds a line break are found and read by one task each, others in parallel
    (`multiline` reads all files by one task each). A file whose last quote is
    never closed gives no rows and one reject. Short rows are filled with nulls;
    rows with more fields than the header, whose extra fields are not all empty,
    are rejected. Rejects are (file, fields, reason), with all their fields; those
    beyond the header as they stand. With a schema its columns are returned, in
    its order; one that no file has is an error. `order` names a column to add with
    the number of a row: files by their names, rows as they stand in them. It
    counts all rows of the files, in one more pass, whatever their number.
    """
    groups: dict[tuple, list[str]] = {}
    rejects = spark.createDataFrame([], "file string, fields array<string>, reason string")
    formats = file_formats(spark, path)
    for f in formats:
        use = sep or f.sep
        names = tuple(_clean(c) for c in next(csv.reader([f.header], delimiter=use)))
        if f.open:
            rejects = rejects.unionByName(spark.createDataFrame([(f.file, None, OPEN_QUOTE)], rejects.schema))
        groups.setdefault((use, encoding or f.encoding, names, multiline or f.multiline, f.open), []).append(f.file)
    wanted = [f.name for f in schema.fields] if schema is not None else list(dict.fromkeys(c for _, _, names, _, _ in groups for c in names))
    absent = [c for c in [*wanted, *(columns or ())] if not any(c in names for _, _, names, _, _ in groups)]
    if absent:
        raise ValueError(f"columns {absent} are in no file under {path}")
    rows, blocks = None, None
    for (use, code, names, whole, is_open), files in groups.items():
        if is_open:
            continue
        places = [f"_{i}" for i in range(len(names))]
        kinds = StructType([StructField(p, StringType()) for p in [*places, _RAW]])
        raw = spark.read.schema(kinds).options(
            header=True, sep=use, encoding=code, quote='"', escape='"', multiLine=whole, mode="PERMISSIVE", enforceSchema=True,
            columnNameOfCorruptRecord=_RAW,
        ).csv(files).select(
            "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
        # what stands behind the fields of the header; rows with as many fields have no raw record
        rest = F.regexp_extract(F.col(_RAW), f"(?s)^{_field(use)}(?:{re.escape(use)}{_field(use)}){{{len(names) - 1}}}{re.escape(use)}(.*)$", 1)
        # Spark refuses plans that read nothing but the raw record, hence the first field
        extra = F.coalesce(rest.rlike(f'[^{re.escape(use)}"\\r\\n]'), F.lit(False)) & (F.length(F.coalesce(places[0], F.lit(""))) >= 0)
        at = {c: i for i, c in reversed(list(enumerate(names)))}
        named = [(F.col(places[at[c]]) if c in at else F.lit(None).cast("string")).alias(c) for c in wanted]
        good = raw.filter(~extra).select(*named, *([F.col(c).alias(f"_{c}") for c in ("file", "block", "row")] if order else []))
        bad = raw.filter(extra).select(
            "file", F.concat(F.array(*places), F.split(rest, re.escape(use))).alias("fields"), F.lit(SURPLUS).alias("reason"))
        own = raw.groupBy("file", "block").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
        rows = good if rows is None else rows.unionByName(good)
        blocks = own if blocks is None else blocks.unionByName(own)
        rejects = rejects.unionByName(bad)
    if rows is None:
        rows = spark.createDataFrame([], StructType([StructField(c, StringType()) for c in wanted] + ([StructField(order, LongType())] if order else [])))
    elif order:
        # rows of a block are consecutive in one task; one row per file block is put in order
        before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
        starts = blocks.select(F.col("file").alias("_file"), F.col("block").alias("_block"),
                               (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("_shift"))
        rows = rows.join(starts, ["_file", "_block"]).select(*[f"`{c}`" for c in wanted], (F.col("_row") + F.col("_shift")).alias(order))
    rows = rows.withColumns({c: null_literals(F.col(f"`{c}`")) for c in wanted}) if order else nulls_from_text(rows)
    return (rows.select(*[f"`{c}`" for c in columns]) if columns else rows), rejects


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str | None = None,
    encoding: str | None = None,
    schema: StructType | None = None,
    columns: Sequence[str] | None = None,
    multiline: bool = False,
) -> DataFrame:
    """The rows of `read_with_rejects`; raises when anything is rejected."""
    rows, rejects = read_with_rejects(spark, path, sep, encoding, schema, columns, multiline)
    bad = rejects.limit(3).collect()
    if bad:
        raise ValueError(f"rejects under {path}: {[(r.reason, r.file if r.fields is None else r.fields) for r in bad]}")
    return rows
