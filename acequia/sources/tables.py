"""Staging tables, exports, partitioned facts and published snapshots."""

from __future__ import annotations

import datetime as dt
import json
from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from acequia.sources.delimited import _hadoop

ROWS = "rows"  # metric of every written table


def write_stage(df: DataFrame, root: str, name: str, **metrics: Column) -> dict:
    """Replace a staging table; returns the metrics gathered on the way, `rows` among them."""
    counted, seen = observed(df, **{ROWS: F.count(F.lit(1)), **metrics})
    counted.write.mode("overwrite").parquet(f"{root}/{name}")
    return seen.get


def read_stage(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")


def export_csv(df: DataFrame, path: str, sep: str = ",", run_ts: dt.datetime | None = None) -> str:
    """Write delimited UTF-8 part files, quotes doubled; with a run time, to `path_YYYYMMDD_HHMM`."""
    target = f"{path}_{run_ts:%Y%m%d_%H%M}" if run_ts else path
    df.write.mode("overwrite").options(header=True, sep=sep, encoding="UTF-8", quote='"', escape='"').csv(target)
    return target


def write_fact(df: DataFrame, path: str, partition_cols: Sequence[str] = ("year", "month")) -> None:
    """Write a fact partitioned by date columns.

    The rebalance hint gathers a partition's rows into few files, and splits those of
    a month that is too large for one task.
    """
    df.hint("rebalance", *partition_cols).write.mode("overwrite").partitionBy(*partition_cols).parquet(path)


def observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """The frame with aggregates that are gathered while it is written; read them with `.get` after the write."""
    seen = Observation()
    return df.observe(seen, *[m.alias(name) for name, m in metrics.items()]), seen


def partition_name(cols: Sequence[str], values: Sequence) -> str:
    """Folder of a partition, as Spark's writer names it for numbers and plain texts."""
    return "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(cols, values))


class Run:
    """Tables that become visible together.

    A run's manifest says for every table, or partition of a table, in which folder
    it was last written. What a run does not write is taken over from the run
    before by reference: neither read nor written. Run ids must sort in time order
    as texts. Nothing is visible before `publish`, which creates the run's marker
    last; a run that fails leaves no marker, and its id can be used again.
    """

    def __init__(self, spark: SparkSession, root: str, run_id: str, inherit: bool = True):
        last = current_run(spark, root)
        if last is not None and run_id <= last:
            raise FileExistsError(f"run {run_id} does not come after the published run {last}")
        self.spark, self.root, self.id = spark, root, run_id
        self.tables: dict[str, dict] = read_manifest(spark, root, last) if last is not None and inherit else {}
        self._written: list[str] = []

    def _folder(self, name: str) -> tuple[str, str]:
        """A folder of its own for every write of the run: a table may be read while its successor is written."""
        label = f"{self.id}.{len(self._written)}"
        path = f"{self.root}/tables/{name}/run={label}"
        self._written.append(path)
        return label, path

    def _drop(self, path: str) -> None:
        fs, folder = _hadoop(self.spark, path)
        fs.delete(folder, True)

    def write(
        self, name: str, df: DataFrame, partition_cols: Sequence[str] = (),
        same: Callable[[dict], bool] | None = None, **metrics: Column,
    ) -> dict:
        """Write a whole table; returns the metrics gathered on the way, `rows` among them.

        Columns whose name begins with `_` serve the metrics alone and are not
        stored. Where `same` finds in the metrics that nothing changed, the folder
        goes again and the table stays the one before.
        """
        label, path = self._folder(name)
        # counted behind the last shuffle, where a task that is run again counts once
        dealt = df.hint("rebalance", *partition_cols) if partition_cols else df
        counted, seen = observed(dealt, **{ROWS: F.count(F.lit(1)), **metrics})
        stored = counted.select(*[c for c in df.columns if not c.startswith("_")])
        stored.write.mode("overwrite").partitionBy(*partition_cols).parquet(path)
        got = seen.get
        if name in self.tables and same is not None and same(got):
            self._drop(path)
            return got
        parts = partitions_of(self.spark, path, len(partition_cols)) if partition_cols else [""]
        self.tables[name] = {
            "schema": _partitions_last(stored.schema, partition_cols).jsonValue(), "by": list(partition_cols),
            "parts": dict.fromkeys(parts, label), ROWS: got[ROWS],
        }
        return got

    def replace(self, name: str, df: DataFrame, partition_cols: Sequence[str], touched: Iterable[Sequence], **sums: Column) -> None:
        """Replace the touched partitions of a table by the rows of `df`; all others stay as they are.

        `df` must hold rows of touched partitions only. A touched partition without
        rows is no longer part of the table. `sums` are aggregates that the manifest
        keeps for each partition, taken from what was written; `sums_of` gives them.
        """
        touched = list(touched)
        gone = {partition_name(partition_cols, values) for values in touched}
        if not gone:
            return
        label, path = self._folder(name)
        write_fact(df, path, partition_cols)
        entry = self.tables.get(name, {"by": list(partition_cols), "parts": {}})
        written = partitions_of(self.spark, path, len(partition_cols))
        if not gone.issuperset(written):
            raise ValueError(f"rows of {name} outside the touched partitions: {sorted(set(written) - gone)[:5]}")
        kept = {p: run for p, run in entry["parts"].items() if p not in gone}
        known = {p: v for p, v in entry.get("sums", {}).items() if p in kept}
        self.tables[name] = {
            "schema": _partitions_last(df.schema, partition_cols).jsonValue(), "by": list(partition_cols),
            "parts": kept | dict.fromkeys(written, label), "sums": known,
        }
        if sums and written:
            found = self.read(name, touched).groupBy(*partition_cols).agg(*[c.alias(n) for n, c in sums.items()]).collect()
            known |= {partition_name(partition_cols, r[:len(partition_cols)]): {n: str(r[n] or 0) for n in sums} for r in found}

    def sums_of(self, name: str, touched: Iterable[Sequence]) -> dict[str, Decimal]:
        """Totals of the kept aggregates over partitions of a table, 0 for those that it does not have."""
        entry = self.tables.get(name, {"by": [], "sums": {}})
        out: dict[str, Decimal] = defaultdict(Decimal)
        for values in touched:
            for n, v in entry.get("sums", {}).get(partition_name(entry["by"], values), {}).items():
                out[n] += Decimal(v)
        return out

    def read(self, name: str, touched: Iterable[Sequence] | None = None, without: Iterable[Sequence] = ()) -> DataFrame:
        """A table as this run has it so far; with `touched`, only the files of these partitions, never those of `without`."""
        entry = self.tables[name]
        only = set(entry["parts"]) if touched is None else {partition_name(entry["by"], values) for values in touched}
        return _read(self.spark, self.root, name, entry, only - {partition_name(entry["by"], values) for values in without})

    def declare(self, name: str, schema: StructType, partition_cols: Sequence[str] = ()) -> None:
        """Add a table without rows, unless the run has it."""
        if name not in self.tables:
            self.tables[name] = {"schema": _partitions_last(schema, partition_cols).jsonValue(), "by": list(partition_cols), "parts": {}, ROWS: 0}

    def __contains__(self, name: str) -> bool:
        return name in self.tables

    def publish(self, check: Callable[[Run], DataFrame] | None = None, keep_runs: int | None = None) -> DataFrame | None:
        """Make the run the current one, unless a check (`passed` column) fails. Returns the checks.

        With `keep_runs`, older runs go, and of their files those that no kept run refers to.
        """
        checks = None
        if check is not None:
            checks = check(self)
            failed = [r.asDict() for r in checks.filter("not passed").limit(20).collect()]
            if failed:
                raise ValueError(f"run {self.id} failed its checks and is not published: {failed}")
        fs, path = _hadoop(self.spark, f"{self.root}/manifests/{self.id}")
        out = fs.create(path, True)
        out.write(bytearray(json.dumps(self.tables).encode()))
        out.close()
        fs, marker = _hadoop(self.spark, f"{self.root}/published/{self.id}")
        fs.create(marker, False).close()
        used = {f"{self.root}/tables/{name}/run={label}" for name, entry in self.tables.items() for label in entry["parts"].values()}
        for path in self._written:  # superseded within the run
            if path not in used:
                self._drop(path)
        if keep_runs:
            forget_runs(self.spark, self.root, keep_runs)
        return checks


def _partitions_last(schema: StructType, cols: Sequence[str]) -> StructType:
    return StructType([f for f in schema.fields if f.name not in cols] + [schema[c] for c in cols])


def partitions_of(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders below a written table."""
    found = [""]
    for _ in range(depth):
        below = []
        for part in found:
            fs, folder = _hadoop(spark, f"{path}/{part}")
            names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
            below += [f"{part}/{n}" if part else n for n in names if "=" in n]
        found = below
    return found


def _read(spark: SparkSession, root: str, name: str, entry: dict, only: set[str] | None = None) -> DataFrame:
    schema, base = StructType.fromJson(entry["schema"]), f"{root}/tables/{name}"
    paths = [f"{base}/run={run}/{part}".rstrip("/") for part, run in sorted(entry["parts"].items()) if only is None or part in only]
    if not paths:
        return spark.createDataFrame([], schema).limit(0)  # known to be empty when a join with it is planned
    reader = spark.read.schema(schema)
    if entry["by"]:
        return reader.option("basePath", base).parquet(*paths).select(*schema.names)
    return reader.parquet(*paths)


def read_manifest(spark: SparkSession, root: str, run_id: str) -> dict[str, dict]:
    """What a published run consists of: by table its schema, partition columns and folders."""
    fs, path = _hadoop(spark, f"{root}/manifests/{run_id}")
    stream = fs.open(path)
    try:
        return json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
    finally:
        stream.close()


def forget_runs(spark: SparkSession, root: str, keep_runs: int) -> None:
    """Remove all but the last runs, and the files to which none of these refers."""
    runs = published_runs(spark, root)
    old, kept = runs[:-keep_runs], runs[-keep_runs:]

    def places(ids: list[str]) -> set[tuple[str, str, str]]:
        return {(name, run, part) for i in ids for name, e in read_manifest(spark, root, i).items() for part, run in e["parts"].items()}

    needed = places(kept)
    folders = {(name, run) for name, run, _ in needed}
    for name, run, part in places(old) - needed:
        whole = (name, run) not in folders
        fs, path = _hadoop(spark, f"{root}/tables/{name}/run={run}" + ("" if whole else f"/{part}"))
        fs.delete(path, True)
    for i in old:
        for kind in ("published", "manifests"):  # the marker first: no reader may find a run without its manifest
            fs, path = _hadoop(spark, f"{root}/{kind}/{i}")
            fs.delete(path, True)


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Delete a folder when the driver's JVM ends."""
    fs, folder = _hadoop(spark, path)
    fs.deleteOnExit(folder)


def publish(
    snapshots: Mapping[str, DataFrame],
    root: str,
    run_id: str,
    check: Callable[[dict[str, DataFrame]], DataFrame] | None = None,
    keep_runs: int | None = None,
    partitions: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame | None:
    """Write a set of tables as a run of their own and make them visible together.

    `check` gets the written tables and returns checks with a `passed` column:
    unless all pass, nothing is published. Returns the checks. `partitions` names
    the columns by which a table's files are partitioned. See `Run` for runs that
    write only what changed.
    """
    spark = next(iter(snapshots.values())).sparkSession
    run = Run(spark, root, run_id, inherit=False)
    for name, df in snapshots.items():
        run.write(name, df, (partitions or {}).get(name, ()))
    return run.publish((lambda r: check({name: r.read(name) for name in snapshots})) if check else None, keep_runs)


def published_runs(spark: SparkSession, root: str) -> list[str]:
    """Published runs from the oldest to the current one."""
    fs, folder = _hadoop(spark, f"{root}/published")
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def current_run(spark: SparkSession, root: str) -> str | None:
    """Latest published run, None before the first."""
    return next(reversed(published_runs(spark, root)), None)


def run_tables(spark: SparkSession, root: str, run_id: str) -> set[str]:
    return set(read_manifest(spark, root, run_id))


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    run = current_run(spark, root)
    if run is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    return _read(spark, root, name, read_manifest(spark, root, run)[name])
