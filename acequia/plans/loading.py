"""Dimension and fact loads from staged tables, and the run that ties them together.

Staged tables use the names of `schemas.ALIASES` and carry their row order in
`seq`. Dimensions and facts have the schemas of `schemas`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from acequia import schemas
from acequia.functions.text import key_text, to_text, truncate
from acequia.functions.values import checked_date, checked_number, parse_date, stamp, to_number
from acequia.operators import quality as q
from acequia.operators.dedupe import dedupe_keep_last
from acequia.operators.facts import (
    LOADED_AT, Reference, fact_changes, load_facts, measures, merged_partitions, partitions_touched, places_of, resolve_keys, signed_changes, split_facts,
)
from acequia.operators.history import current_only, history_check, scd2
from acequia.operators.members import add_missing_members, distinct_dates, extend_dates
from acequia.operators.reports import stored_sums
from acequia.operators.upsert import CHANGE, upsert
from acequia.session import materialize
from acequia.sources.tables import ROWS, Run, current_run, observed, read_published

SEQ = "seq"
_CHANGE = "_change"
UNKNOWN = "SIN NOMBRE"
TABLES = {
    "dim_insurer": schemas.DIM_INSURER, "dim_patient": schemas.DIM_PATIENT, "dim_equipment": schemas.DIM_EQUIPMENT,
    "dim_order": schemas.DIM_ORDER, "dim_drug": schemas.DIM_DRUG, "dim_date": schemas.DIM_DATE,
    "fact_equipment": schemas.FACT_EQUIPMENT, "fact_service": schemas.FACT_SERVICE,
}

FACTS = ("fact_equipment", "fact_service")
BY_MONTH = ("year", "month")


@dataclass(frozen=True)
class FactSpec:
    """A fact kept by month: its key columns, staged date, schema, and the table and keys of its stored sums by year."""

    table: str
    keys: tuple[str, ...]
    day: str
    schema: StructType
    sums: str
    sum_keys: tuple[str, ...]

    def by_month(self) -> StructType:
        return StructType([*self.schema.fields, *[StructField(c, IntegerType()) for c in BY_MONTH]])

    def sums_schema(self) -> StructType:
        kinds = {f.name: f for f in self.by_month().fields}
        return StructType([*[kinds[k] for k in self.sum_keys], *schemas.SUMS.fields, kinds["year"]])


SPECS = {
    "fact_equipment": FactSpec(
        "fact_equipment", ("equipment_nk", "serial", "delivered"), "delivered", schemas.FACT_EQUIPMENT, "sum_equipment", ("month", "equipment_id")),
    "fact_service": FactSpec(
        "fact_service", ("order_number", "document", "item", "sent"), "sent", schemas.FACT_SERVICE, "sum_service", ("insurer_id",)),
}

Tables = Mapping[str, DataFrame]


def empty_warehouse(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], schema) for name, schema in TABLES.items()}


def current_warehouse(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The published tables, or empty ones before the first run."""
    if current_run(spark, root) is None:
        return empty_warehouse(spark)
    return {name: read_published(spark, root, name).select(*schema.names) for name, schema in TABLES.items()}


def dimension_batches(staged: Tables) -> dict[str, tuple[DataFrame, str]]:
    """Cleaned batch and natural key of each master dimension; blank keys become null."""

    def keyed(source: str, key: str, **more) -> tuple[DataFrame, str]:
        return staged[source].withColumns({key: key_text(F.col(key)), **more}), key

    def short(column: str, n: int):
        return truncate(to_text(F.col(column)), n)

    return {
        "dim_insurer": keyed("insurers", "insurer_nk", insurer=to_text(F.col("insurer"))),
        "dim_patient": keyed("patients", "document", admitted=parse_date(F.col("admitted"))),
        "dim_equipment": keyed("equipment", "equipment_nk"),
        "dim_order": keyed("orders", "order_number", item=short("item", 255), quantity=to_number(F.col("quantity"))),
        "dim_drug": keyed("drugs", "code", name=short("name", 255), form=short("form", 100), route=short("route", 100)),
    }


def dimension_rejects(staged: Tables) -> DataFrame:
    """Master rows without a natural key, which no dimension takes: (table, seq, reason, row as JSON)."""
    out = None
    for name, (batch, key) in dimension_batches(staged).items():
        lost = batch.filter(F.col(key).isNull()).select(
            F.lit(name).alias("table"), F.col(SEQ).cast("long").alias(SEQ), F.lit(f"no {key}").alias("reason"),
            F.to_json(F.struct(*batch.columns)).alias("row"),
        )
        out = lost if out is None else out.unionByName(lost)
    return out


# Staged texts that the loads read as numbers and dates.
CASTS = {
    "patients": {"admitted": checked_date}, "orders": {"quantity": checked_number},
    "report": {"delivered": checked_date, "quantity": checked_number}, "history": {"sent": checked_date},
}


def value_rejects(staged: Tables) -> DataFrame:
    """Texts in staged number and date columns that cannot be read: (source, seq, column, text, reason).

    Such an attribute is loaded as null, such a quantity as 0, and a fact without
    date is rejected; here they are listed one by one.
    """
    out = None
    for source, casts in CASTS.items():
        found = q.cast_rejects(staged[source].withColumn(SEQ, F.col(SEQ).cast("long")), casts, [SEQ]).select(F.lit(source).alias("source"), SEQ, "column", "text", "reason")
        out = found if out is None else out.unionByName(found)
    return out


def load_dimensions(
    current: Tables, staged: Tables, load_date: dt.date | str, versioned: tuple[str, ...] = ("dim_equipment",), changes: bool = False
) -> dict[str, DataFrame]:
    """New snapshots of the five master dimensions.

    Insurers and patients are overwritten in place unless listed in `versioned`.
    Rows without natural key are left out; `dimension_rejects` lists them. With
    `changes` those overwritten in place say so in `_change`.
    """
    batches = dimension_batches(staged)

    def members(name: str, attrs: list[str], id_col: str | None, dated: bool = True) -> DataFrame:
        batch, key = batches[name]
        if name in versioned:
            return scd2(current[name], batch, key, attrs, SEQ, load_date, id_col)
        return upsert(current[name], batch, key, attrs, SEQ, load_date if dated else None, id_col).withColumnRenamed(CHANGE, _CHANGE)

    people = ["name", "city", "state", "insurer", "zone", "admitted"]
    snapshots = {
        "dim_insurer": members("dim_insurer", ["insurer"], "insurer_id"),
        "dim_patient": members("dim_patient", people, "patient_id"),
        "dim_equipment": members("dim_equipment", ["equipment", "state"], "equipment_id"),
        "dim_order": members("dim_order", ["item", "quantity"], "order_id", dated=False),
        "dim_drug": members("dim_drug", ["name", "form", "route"], None, dated=False),
    }
    return snapshots if changes else {name: df.drop(_CHANGE) for name, df in snapshots.items()}


def _fact_codes(staged: DataFrame, *columns: str) -> DataFrame:
    """Codes of a staged fact in the form that the dimensions hold."""
    return staged.withColumns({c: key_text(F.col(c)) for c in columns})


def _fact_dimensions(warehouse: Tables, staged: DataFrame, day: str, load_date) -> dict[str, DataFrame]:
    """Patients, insurers and dates completed by what a staged fact mentions."""
    name = F.min("patient") if "patient" in staged.columns else F.lit(UNKNOWN)
    return {
        "dim_patient": add_missing_members(
            warehouse["dim_patient"], staged, "document", "document", {"name": name}, "patient_id", load_date
        ),
        "dim_insurer": add_missing_members(
            warehouse["dim_insurer"], staged, "insurer_nk", "insurer_nk", {"insurer": F.lit(UNKNOWN)},
            "insurer_id", load_date,
        ),
        "dim_date": extend_dates(warehouse["dim_date"], distinct_dates(staged, day)),
    }


def _references(dims: Tables, day: str) -> list[Reference]:
    return [
        Reference("document", current_only(dims["dim_patient"]), "document", "patient_id"),
        Reference("insurer_nk", current_only(dims["dim_insurer"]), "insurer_nk", "insurer_id"),
        Reference(day, dims["dim_date"], "date", "date_id", is_date=True),
    ]


def equipment_facts(warehouse: Tables, report: DataFrame, load_date) -> tuple[dict[str, DataFrame], DataFrame, list[Reference], Column | None]:
    """Completed dimensions, staged facts of the equipment report, their references and quantity; key: code, serial, date."""
    staged = _fact_codes(report, "equipment_nk", "document", "insurer_nk").withColumns(
        {
            "delivered": parse_date(F.col("delivered")),
            "quantity": to_number(F.col("quantity")),
        }
    )
    return _fact_dimensions(warehouse, staged, "delivered", load_date), staged, [
        Reference("equipment_nk", current_only(warehouse["dim_equipment"]), "equipment_nk", "equipment_id"),
    ], F.col("quantity")


def service_facts(warehouse: Tables, history: DataFrame, load_date) -> tuple[dict[str, DataFrame], DataFrame, list[Reference], Column | None]:
    """The same of the service history; each request counts one."""
    staged = _fact_codes(history, "order_number", "document", "insurer_nk").withColumn("sent", parse_date(F.col("sent")))
    dims = _fact_dimensions(warehouse, staged, "sent", load_date)
    dims["dim_order"] = add_missing_members(
        warehouse["dim_order"], staged, "order_number", "order_number", {"item": F.min("item"), "quantity": F.lit(1.0)},
        "order_id",
    )
    return dims, staged, [], None


def _all_references(name: str, own: Sequence[Reference], dims: Tables) -> list[Reference]:
    orders = [Reference("order_number", dims["dim_order"], "order_number", "order_id")] if name == "fact_service" else []
    return [*own, *orders, *_references(dims, SPECS[name].day)]


def _load_snapshot(name: str, prepared, warehouse: Tables, load_ts) -> tuple[dict[str, DataFrame], DataFrame]:
    dims, staged, own, quantity = prepared
    dims = {k: materialize(v, k) for k, v in dims.items()}
    references = _all_references(name, own, dims)
    facts, rejects = load_facts(warehouse[name], staged, references, SPECS[name].keys, SEQ, load_ts, quantity)
    return {**dims, name: facts.drop(CHANGE)}, rejects


def load_equipment(warehouse: Tables, report: DataFrame, load_date, load_ts) -> tuple[dict[str, DataFrame], DataFrame]:
    """(changed tables, rejected rows) of the equipment report, as whole snapshots; `merge_fact` is the way by partition."""
    return _load_snapshot("fact_equipment", equipment_facts(warehouse, report, load_date), warehouse, load_ts)


def load_services(warehouse: Tables, history: DataFrame, load_date, load_ts) -> tuple[dict[str, DataFrame], DataFrame]:
    """(changed tables, rejected rows) of the service history, as whole snapshots."""
    return _load_snapshot("fact_service", service_facts(warehouse, history, load_date), warehouse, load_ts)


@dataclass(frozen=True)
class FactLoad:
    """What became of the staged rows of a fact, and what the touched partitions should hold against what they do."""

    table: str
    counts: dict[str, int]
    touched: list[tuple]
    expected: dict[str, Decimal]
    found: dict[str, Decimal]
    rejects: DataFrame

    def checks(self) -> list[tuple[str, str, int]]:
        """Staged rows not accounted for, and sums of the written partitions that are off: (check, table, failures)."""
        c = self.counts
        lost = abs(c["staged"] - sum(c[k] for k in ("inserted", "updated", "matched", "superseded", "rejected")))
        return [("accounting", self.table, lost)] + [
            (kind, self.table, int(self.expected.get(kind, Decimal()) != self.found.get(kind, Decimal()))) for kind in ("stored_rows", "checksum", "measure")]


def _counted(df: DataFrame, label: str, where: Column | None = None, **metrics: Column) -> tuple[DataFrame, dict]:
    """The frame, stored, and metrics of all its rows; with `where`, these rows alone are stored."""
    frame, seen = observed(df, **metrics)
    return materialize(frame if where is None else frame.filter(where), label), seen.get


def _sums(pk: Sequence[str], values: Sequence[str], at=F.col) -> dict[str, Column]:
    """Rows, checksum and measure of facts; `at` finds the columns beside the key."""
    return {
        "stored_rows": F.count(F.lit(1)), "checksum": q.checksum(*pk, *[at(v) for v in values]),
        "measure": F.sum(at("quantity").cast("decimal(28,6)")),
    }


def merge_fact(run: Run, spec: FactSpec, staged: DataFrame, references: Sequence[Reference], load_ts, quantity: Column | None = None,
               moving: bool = False, order: str = SEQ) -> FactLoad:
    """Merge staged rows into a fact of the run, month by month.

    Only months that the batch can change are read, and only those that it does
    change are written, with a stamp for the inserted and updated facts; a fact
    that the batch repeats unchanged keeps its stamp, so a repeated batch writes
    nothing. The last staged row of a key wins. Where a key fixes its date, as for
    both facts here, the batch's own months are enough; with `moving`, its keys are
    looked up in all other stored months first (keys alone are read), and a fact
    whose date changed moves. The sums of the fact follow by the signed changes.
    """
    name, pk, attrs = spec.table, list(spec.keys), measures(references)
    ids, day = [r.id_col for r in references], F.col(spec.day)
    missing = F.lit(False)
    for c in ids:
        missing = missing | F.col(c).isNull()
    parts = {"year": F.year(day), "month": F.month(day)}
    resolved, n = _counted(resolve_keys(staged, references).withColumns(parts), f"{name}_resolved", valid=F.count_if(~missing), rejected=F.count_if(missing))
    valid, rejects = split_facts(resolved, references, pk, quantity)
    latest = stamp(dedupe_keep_last(valid, pk, order), LOADED_AT, load_ts).select(*pk, *attrs, LOADED_AT, *BY_MONTH)
    # not stored: a key's last row meets its stored fact in the task that picked it
    batch, unique = observed(latest, rows=F.count(F.lit(1)))
    declare_fact(run, spec)
    near = {tuple(r) for r in valid.select(*BY_MONTH).distinct().collect()}
    if moving:
        near |= set(places_of(run.read(name, without=near), valid, pk, BY_MONTH))
    kinds = {k: F.count_if(F.col(CHANGE) == k) for k in ("inserted", "updated", "matched")}
    changes, kind = _counted(
        fact_changes(run.read(name, near), batch, pk, attrs, BY_MONTH), f"{name}_changes", F.col(CHANGE) != "matched", **kinds)
    touched = partitions_touched(changes, BY_MONTH)
    counts = {"staged": staged.count(), **kind, "superseded": n["valid"] - unique.get["rows"], "rejected": n["rejected"]}
    values = [*attrs, *BY_MONTH]
    expected, found = run.sums_of(name, touched), {}
    if touched:
        new = changes.agg(*[c.alias(k) for k, c in _sums(pk, values).items()]).first()
        old = changes.filter("_was is not null").agg(*[c.alias(k) for k, c in _sums(pk, values, lambda v: F.col("_was")[v]).items()]).first()
        for k in new.asDict():
            expected[k] += Decimal(new[k] or 0) - Decimal(old[k] or 0)
        run.replace(name, merged_partitions(run.read(name, touched), changes, pk), BY_MONTH, touched, **_sums(pk, values))
        found = run.sums_of(name, touched)
        update_sums(run, spec, signed_changes(changes, values), sorted({year for year, _ in touched}))
    return FactLoad(name, counts, touched, expected, found, rejects)


def declare_fact(run: Run, spec: FactSpec) -> None:
    """Readers find a fact and its sums, empty or not."""
    run.declare(spec.table, spec.by_month(), BY_MONTH)
    run.declare(spec.sums, spec.sums_schema(), ["year"])


def update_sums(run: Run, spec: FactSpec, signed: DataFrame, years: Sequence[int]) -> None:
    """Apply signed changes of a fact to its stored sums; only the touched years are read and written."""
    touched, columns = [(y,) for y in years], [f.name for f in spec.sums_schema().fields]
    sums = stored_sums(signed, ["year", *spec.sum_keys], run.read(spec.sums, touched))
    run.replace(spec.sums, sums.select(*columns), ["year"], touched)


def validate(warehouse: Tables, loads: Sequence[FactLoad] = (), staged: Tables | None = None) -> DataFrame:
    """Integrity checks of a loaded warehouse; with the loads and staged tables also whether every staged row is accounted for.

    The facts of `warehouse` may be limited to the partitions that a run wrote.
    """
    ids = {"fact_equipment": ["equipment_id", "patient_id", "insurer_id", "date_id"], "fact_service": ["order_id", "patient_id", "insurer_id", "date_id"]}
    checks = [
        q.check_no_demo(warehouse["dim_patient"], "document", "dim_patient"),
        q.check_dates(warehouse["dim_date"], "1900-01-01", "2199-12-31", "dim_date"),
        q.check_history(history_check(warehouse["dim_equipment"], "equipment_nk"), "dim_equipment"),
    ]
    for fact, fk in ids.items():
        checks += [q.check_foreign_keys(warehouse[fact], fk, fact), q.check_unique(warehouse[fact], SPECS[fact].keys, fact)]
        checks += [q.check_ids(warehouse[fact], warehouse["dim_" + c.removesuffix("_id")], c, fact) for c in fk]
    if staged is not None:
        for name, (batch, key) in dimension_batches(staged).items():
            checks.append(q.check_references(batch.filter(F.col(key).isNotNull()), warehouse[name], key, key, name))
    stated = [c for load in loads for c in load.checks()]
    if stated:
        checks.append(q.stated(warehouse["dim_date"].sparkSession, stated))
    return q.dq_report(checks)


@dataclass(frozen=True)
class Loaded:
    """A published run: checks, rejects by table, counts by table."""

    checks: DataFrame
    rejects: dict[str, DataFrame]
    counts: dict[str, dict[str, int]] = field(default_factory=dict)


def _write_dimension(run: Run, name: str, snapshot: DataFrame) -> dict[str, int]:
    """Write a snapshot unless it equals the table that the run has; returns its counts."""
    before = run.tables[name][ROWS] if name in run else 0
    if _CHANGE in snapshot.columns:
        kinds = {k: F.count_if(F.col(_CHANGE) == k) for k in ("inserted", "updated", "matched", "kept")}
        return run.write(name, snapshot, same=lambda m: m["inserted"] + m["updated"] == 0, **kinds)
    # histories and completed dimensions only ever grow
    counts = run.write(name, snapshot, same=lambda m: m[ROWS] == before)
    return {**counts, "inserted": counts[ROWS] - before}


def load_run(spark: SparkSession, root: str, staged: Tables, run_id: str, load_date, load_ts, keep_runs: int | None = None) -> Loaded:
    """Dimensions, equipment facts, service facts, checks, publish.

    All tables of the run become visible together or not at all; a run whose checks
    fail is not published. Tables and months of facts that the run does not change
    stay where they are. Rejects of the dimensions are under `dimensions`, unreadable
    numbers and dates under `values`. Counts:
    `inserted`, `updated`, `matched`, `kept` members of dimensions overwritten in
    place, `inserted` versions or members of the others, and for facts what became
    of the staged rows.
    """
    run = Run(spark, root, run_id)
    for spec in SPECS.values():
        declare_fact(run, spec)

    def table(name: str) -> DataFrame:
        return run.read(name).select(*TABLES[name].names) if name in run else spark.createDataFrame([], TABLES[name])

    dims = [name for name in TABLES if name not in FACTS]
    before = {name: table(name) for name in dims}
    counts = {name: _write_dimension(run, name, df) for name, df in load_dimensions(before, staged, load_date, changes=True).items()}
    loads = []
    for fact, prepare, source in (("fact_equipment", equipment_facts, "report"), ("fact_service", service_facts, "history")):
        completed, rows, own, quantity = prepare({name: table(name) for name in dims}, staged[source], load_date)
        for name, df in completed.items():
            added = _write_dimension(run, name, df)["inserted"]
            counts.setdefault(name, {})["completed"] = counts.get(name, {}).get("completed", 0) + added
        load = merge_fact(run, SPECS[fact], rows, _all_references(fact, own, {name: table(name) for name in dims}), load_ts, quantity)
        loads.append(load)
        counts[fact] = {**load.counts, "months": len(load.touched)}

    def check(done: Run) -> DataFrame:
        facts = {load.table: done.read(load.table, load.touched) for load in loads}
        return validate({name: table(name) for name in dims} | facts, loads, staged)

    checks = run.publish(check, keep_runs)
    return Loaded(checks, {"dimensions": dimension_rejects(staged), "values": value_rejects(staged), **{load.table: load.rejects for load in loads}}, counts)


def run_all(spark: SparkSession, root: str, staged: Tables, run_id: str, load_date, load_ts) -> tuple[DataFrame, dict[str, DataFrame]]:
    """`load_run`, as (checks, rejects by table)."""
    done = load_run(spark, root, staged, run_id, load_date, load_ts)
    return done.checks, done.rejects
