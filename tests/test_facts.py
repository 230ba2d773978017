"""Facts kept by month: what a load reads, writes, counts and refuses."""

import os
import shutil
from glob import glob

import pytest
from pyspark.sql import functions as F

from acequia.operators.facts import Reference, id_twins, latest_facts, load_facts
from acequia.operators.reports import equipment_by_month, inspect, services_by_insurer, stored_equipment_by_month, stored_services_by_insurer
from acequia.plans import loading
from acequia.plans.loading import SPECS, FactSpec, load_run, merge_fact
from acequia.sources import tables as t
from tests.test_jobs import staged


def reports(spark, rows):
    """Staged tables whose report holds (equipment, serial, date, quantity)."""
    tables = staged(spark)
    data = [(e, s, "100", "01", d, q, i) for i, (e, s, d, q) in enumerate(rows)]
    tables["report"] = spark.createDataFrame(data, tables["report"].schema)
    return tables


def facts(spark, root):
    rows = t.read_published(spark, root, "fact_equipment").collect()
    return sorted((r.equipment_nk, r.serial, r.delivered, r.quantity, f"{r.loaded_at:%d}", r.month) for r in rows)


def parts(spark, root, name):
    return t.read_manifest(spark, root, t.current_run(spark, root))[name]["parts"]


def test_only_changed_months_are_read_and_written(spark, tmp_path):
    root = str(tmp_path)
    first = [("510", "S1", "2024-05-03", "1"), ("510", "S2", "2024-06-03", "2"), ("510", "S3", "2024-07-03", "4")]
    load_run(spark, root, reports(spark, first), "1", "2024-06-15", "2024-06-15 06:00:00")
    before = parts(spark, root, "fact_equipment")
    # unreadable months prove that the next loads do not look at them
    hidden = [f"{root}/tables/fact_equipment/run={before[p]}/{p}" for p in ("year=2024/month=5", "year=2024/month=7")]
    saved = {}
    for folder in hidden:
        for file in glob(f"{folder}/*.parquet"):
            with open(file, "rb") as f:
                saved[file] = f.read()
            with open(file, "wb") as f:
                f.write(b"broken")
    done = load_run(spark, root, reports(spark, [("510", "S2", "2024-06-03", "5"), ("510", "S9", "2024-06-09", "1")]), "2", "2024-06-16", "2024-06-16 06:00:00")
    after = parts(spark, root, "fact_equipment")
    assert [p for p in after if after[p] != before[p]] == ["year=2024/month=6"]
    assert done.counts["fact_equipment"] == {
        "staged": 2, "inserted": 1, "updated": 1, "matched": 0, "superseded": 0, "rejected": 0, "months": 1}
    for file, content in saved.items():
        with open(file, "wb") as f:
            f.write(content)
        crc = os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    assert facts(spark, root) == [
        ("510", "S1", "2024-05-03", 1.0, "15", 5), ("510", "S2", "2024-06-03", 5.0, "16", 6), ("510", "S3", "2024-07-03", 4.0, "15", 7),
        ("510", "S9", "2024-06-09", 1.0, "16", 6)]


def test_a_repeated_run_writes_no_table(spark, tmp_path):
    root, tables = str(tmp_path), staged(spark)
    load_run(spark, root, tables, "1", "2024-06-15", "2024-06-15 06:00:00")
    first, folders = t.read_manifest(spark, root, "1"), sorted(glob(f"{root}/tables/*/*"))
    done = load_run(spark, root, tables, "2", "2024-06-16", "2024-06-16 06:00:00")
    assert t.read_manifest(spark, root, "2") == first and sorted(glob(f"{root}/tables/*/*")) == folders
    assert done.counts["fact_equipment"] == {
        "staged": 4, "inserted": 0, "updated": 0, "matched": 2, "superseded": 1, "rejected": 1, "months": 0}
    assert done.counts["dim_drug"] == {"rows": 1, "inserted": 0, "updated": 0, "matched": 1, "kept": 0}


def test_keys_with_dashes_stay_apart(spark, tmp_path):
    root = str(tmp_path)
    tables = reports(spark, [("a-b", "c", "2024-06-03", "1"), ("a", "b-c", "2024-06-03", "2")])
    tables["equipment"] = spark.createDataFrame([("a-b", "X", "ACTIVO", 0), ("a", "Y", "ACTIVO", 1)], tables["equipment"].schema)
    done = load_run(spark, root, tables, "1", "2024-06-15", "2024-06-15 06:00:00")
    assert done.rejects["fact_equipment"].count() == 0
    found = t.read_published(spark, root, "fact_equipment")
    assert sorted((r.equipment_nk, r.serial, r.quantity) for r in found.collect()) == [("a", "b-c", 2.0), ("a-b", "c", 1.0)]
    assert [tuple(r) for r in id_twins(found, SPECS["fact_equipment"].keys).collect()] == [("a-b-c-2024-06-03", 2)]


def test_snapshots_keep_missing_key_parts(spark):
    dim = spark.createDataFrame([("x", 1)], "k string, k_id long")
    current = spark.createDataFrame([], "k string, part string, request_id string, k_id long, quantity double, loaded_at timestamp")
    rows = spark.createDataFrame([("x", None, 1), ("x", None, 2), ("x", "p", 3), ("y", "p", 4)], "k string, part string, seq int")
    new, rejects = load_facts(current, rows, [Reference("k", dim, "k", "k_id")], ["k", "part"], "seq", "2024-06-15")
    assert sorted((r.k, r.part, r.request_id) for r in new.collect()) == [("x", "", "x-"), ("x", "p", "x-p")]
    assert rejects.count() == 1
    assert latest_facts(rows, ["k", "part"], "seq").count() == 3


def test_lost_rows_stop_the_publish(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    load_run(spark, root, staged(spark), "1", "2024-06-15", "2024-06-15 06:00:00")
    kept = loading.merged_partitions
    monkeypatch.setattr(loading, "merged_partitions", lambda *a: kept(*a).filter("serial <> 'S9'"))
    lossy = reports(spark, [("510", "S9", "2024-06-20", "1"), ("510", "S8", "2024-06-20", "1")])
    with pytest.raises(ValueError, match="checksum"):
        load_run(spark, root, lossy, "2", "2024-06-16", "2024-06-16 06:00:00")
    monkeypatch.setattr(loading, "merged_partitions", kept)
    resolve = loading.resolve_keys
    monkeypatch.setattr(loading, "resolve_keys", lambda staged, refs: resolve(staged, refs).filter("seq <> 0"))
    with pytest.raises(ValueError, match="accounting"):
        load_run(spark, root, lossy, "2", "2024-06-16", "2024-06-16 06:00:00")
    assert t.current_run(spark, root) == "1"


def test_a_fact_whose_date_changes_moves(spark, tmp_path):
    schema = spark.createDataFrame([], "trip string, request_id string, car_id long, quantity double, loaded_at timestamp").schema
    spec = FactSpec("fact_trip", ("trip",), "day", schema, "sum_trip", ("car_id",))
    cars = [Reference("car", spark.createDataFrame([("c", 1)], "car string, car_id long"), "car", "car_id")]

    def load(run_id, rows):
        run = t.Run(spark, str(tmp_path), run_id)
        data = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "trip string, car string, day string, quantity double, seq int")
        done = merge_fact(run, spec, data.withColumn("day", F.col("day").cast("date")), cars, f"2024-01-0{run_id}", F.col("quantity"), moving=True)
        assert not any(n for _, _, n in done.checks())
        run.publish()
        return done.counts

    load("1", [("t1", "c", "2023-12-30", 1.0), ("t2", "c", "2023-12-31", 2.0), ("t3", "c", "2023-11-05", 4.0)])
    assert load("2", [("t1", "c", "2024-01-01", 1.5), ("t4", "c", "2024-01-02", 8.0)])["updated"] == 1
    rows = t.read_published(spark, str(tmp_path), "fact_trip").collect()
    assert sorted((r.trip, r.year, r.month, r.quantity) for r in rows) == [
        ("t1", 2024, 1, 1.5), ("t2", 2023, 12, 2.0), ("t3", 2023, 11, 4.0), ("t4", 2024, 1, 8.0)]
    sums = t.read_published(spark, str(tmp_path), "sum_trip").collect()
    assert sorted((r.year, r.n, float(r.total)) for r in sums) == [(2023, 2, 6.0), (2024, 2, 9.5)]
    load("3", [("t2", "c", "2024-01-05", 2.0), ("t3", "c", "2024-01-05", 4.0)])
    assert set(parts(spark, str(tmp_path), "fact_trip")) == {"year=2024/month=1"}
    assert set(parts(spark, str(tmp_path), "sum_trip")) == {"year=2024"}


def test_stored_sums_follow_three_loads(spark, tmp_path):
    root = str(tmp_path)
    loads = [
        [("510", "S1", "2023-05-03", "0.1"), ("510", "S2", "2024-06-03", "0.2"), ("510", "S3", "2024-07-03", "4")],
        [("510", "S1", "2023-05-03", "0.3"), ("510", "S4", "2024-07-09", "1"), ("510", "S4", "2024-07-09", "1.1")],
        [("510", "S1", "2023-05-03", "0"), ("510", "S2", "2024-06-03", "7"), ("510", "S5", "2025-01-01", "2")],
    ]
    for i, rows in enumerate(loads, 1):
        load_run(spark, root, reports(spark, rows), str(i), f"2024-06-1{i}", f"2024-06-1{i} 06:00:00")
        read = lambda name: t.read_published(spark, root, name)
        dates, equipment, insurers = read("dim_date"), read("dim_equipment"), read("dim_insurer")
        flat = lambda df: [tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect()]
        months = equipment_by_month(read("fact_equipment").drop("year", "month"), equipment, dates)
        assert flat(stored_equipment_by_month(read("sum_equipment"), equipment)) == flat(months)
        assert flat(stored_services_by_insurer(read("sum_service"), insurers)) == flat(services_by_insurer(read("fact_service"), insurers))
    assert parts(spark, root, "sum_equipment")["year=2024"].startswith("3.")


def test_old_runs_keep_what_later_ones_refer_to(spark, tmp_path):
    root = str(tmp_path)
    for i in range(1, 4):
        run = t.Run(spark, root, str(i))
        if i == 1:
            run.write("x", spark.range(3))
            run.write("y", spark.sql("select 1 as v, explode(sequence(1, 3)) as month"), ["month"])
        else:
            run.replace("y", spark.sql(f"select {i} as v, {i} as month"), ["month"], [(i,)])
        run.publish(keep_runs=1)
    assert t.published_runs(spark, root) == ["3"] and t.read_published(spark, root, "x").count() == 3
    assert sorted(map(tuple, t.read_published(spark, root, "y").collect())) == [(1, 1), (2, 2), (3, 3)]
    assert not glob(f"{root}/tables/y/run=1.*/month=[23]") and glob(f"{root}/tables/y/run=1.*/month=1")
    with pytest.raises(ValueError, match="outside"):
        t.Run(spark, root, "4").replace("y", spark.sql("select 1 as v, 9 as month"), ["month"], [(1,)])
    shutil.rmtree(f"{root}/tables/x")
    assert t.read_published(spark, root, "y").count() == 3


def test_unreadable_numbers_and_dates_are_listed(spark, tmp_path):
    tables = reports(spark, [("510", "S1", "2024-06-03", "3 kg"), ("510", "S2", "03.06.2024", "2"), ("510", "S3", "2024-06-04", None)])
    patients = tables["patients"].withColumn("admitted", F.lit("soon"))
    found = loading.value_rejects({**tables, "patients": patients})
    assert sorted((r.source, r.seq, r.column, r.text, r.reason) for r in found.collect()) == [
        ("patients", 0, "admitted", "soon", "not a date"), ("report", 0, "quantity", "3 kg", "not a number"),
        ("report", 1, "delivered", "03.06.2024", "not a date")]


def test_inspect_shows_some_rows_that_meet_a_condition(spark):
    rows = inspect(spark.range(100), F.col("id") > 20, 5).collect()
    assert len(rows) == 5 and all(r.id > 20 for r in rows) and inspect(spark.range(3)).count() == 3
