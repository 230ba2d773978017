"""From the files of a delivery to a published warehouse."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acequia.functions.text import is_demo
from acequia.operators.cleaning import NOT_APPLICABLE
from acequia.plans.cleaning import clean_history, clean_orders, clean_report
from acequia.plans.loading import SEQ, load_run
from acequia.schemas import rename
from acequia.sources.delimited import read_with_rejects, require_inputs
from acequia.sources.tables import export_csv, observed, read_stage, write_stage

SOURCES = ("insurers", "patients", "equipment", "drugs", "supplies", "orders", "report", "history")
# Columns that the loads need; those that a file lacks are null.
NEEDED = {
    "insurers": ("insurer_nk", "insurer"),
    "patients": ("document", "name", "city", "state", "insurer", "zone", "admitted"),
    "equipment": ("equipment_nk", "equipment", "state"),
    "drugs": ("code", "name", "form", "route"),
    "orders": ("document", "order_number", "item", "quantity"),
    "report": ("equipment_nk", "serial", "document", "insurer_nk", "delivered", "quantity"),
    "history": ("item", "order_number", "document", "sent", "insurer_nk"),
}


@dataclass(frozen=True)
class Delivery:
    """What a run found: checks, rejects by table and by source, cleaning counts, and counts by staged source and loaded table.

    All counts are gathered while the tables are written.
    """

    checks: DataFrame
    rejects: dict[str, DataFrame]
    surplus: dict[str, DataFrame]
    summary: DataFrame
    staged: dict[str, dict[str, int]]
    counts: dict[str, dict[str, int]]


def _staged(rows: DataFrame, source: str) -> DataFrame:
    named = rename(rows, source)
    lacking = {c: F.lit(None).cast("string") for c in NEEDED[source] if c not in named.columns}
    return named.withColumns(lacking).select(*NEEDED[source], SEQ) if lacking else named.select(*NEEDED[source], SEQ)


def run_from_files(
    spark: SparkSession, inputs: Mapping[str, str], root: str, run_id: str, load_date: dt.date | str,
    load_ts: dt.datetime | str, export: str | None = None, multiline: bool = False,
) -> Delivery:
    """Read, clean, stage, load, check and publish; `inputs` maps each of `SOURCES` to a file or folder.

    Missing inputs are named together before anything is read. Cleaned tables are
    staged under `root/staging` and, with `export`, written as delimited files.
    A run whose checks fail raises and publishes nothing.
    """
    lacking = [s for s in SOURCES if s not in inputs]
    if lacking:
        raise ValueError(f"no input given for {lacking}")
    require_inputs(spark, [inputs[s] for s in SOURCES])
    read = {s: read_with_rejects(spark, inputs[s], multiline=multiline, order=SEQ) for s in SOURCES}
    raw = {s: rows for s, (rows, _) in read.items()}
    report, before = observed(raw["report"], original=F.count(F.lit(1)), removed=F.count_if(is_demo(F.col("Documento Paciente"))))
    report, after = observed(clean_report(report, raw["insurers"]), final=F.count(F.lit(1)), without_code=F.count_if(F.col("Aseguradora") == NOT_APPLICABLE))
    cleaned = {
        **raw,
        "report": report,
        "history": clean_history(raw["history"]),
        "orders": clean_orders(raw["orders"], raw["supplies"], raw["drugs"], SEQ),
    }
    staging, counts = f"{root}/staging", {}
    for source, (key, *_) in NEEDED.items():
        counts[source] = write_stage(_staged(cleaned[source], source), staging, source, blank=F.count_if(F.col(key).isNull()))
        if export:
            export_csv(cleaned[source].drop(SEQ), f"{export}/{source}", ";")
    staged = {s: read_stage(spark, staging, s) for s in NEEDED}
    cleaning = {**before.get, **after.get}
    summary = spark.createDataFrame([tuple(cleaning.values())], ", ".join(f"{c} long" for c in cleaning))
    done = load_run(spark, root, staged, run_id, load_date, load_ts)
    return Delivery(done.checks, done.rejects, {s: bad for s, (_, bad) in read.items()}, summary, counts, done.counts)
