"""Plans of the queries on the equipment report: what is joined, shuffled and read once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from acequia import registry
from acequia.functions.values import parse_date
from acequia.operators.facts import Reference
from acequia.operators.quality import checksum
from acequia.plans import loading
from acequia.registry.scenario import Tables, staged_report
from acequia.sources import tables as t


def plan(df, stage="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), stage)().toString()


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """Four orders of three customers; customer 2 is no patient, part 3 no equipment, order 4 has no document."""
    folder, day = str(tmp_path_factory.mktemp("tables")), dt.datetime(1996, 1, 2)
    tables = {
        "nation": ([(0, "A", 0), (1, "B", 4)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(1, "Ana", 0, 5.0, "X"), (2, "Demo", 0, -1.0, "X"), (3, "Eva", 1, 1.0, "Y")],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "part": ([(1, "p1", "STD", 1), (2, "p2", "STD", 13), (3, "p3", "PROMO", 1)], "p_partkey long, p_name string, p_type string, p_size int"),
        "orders": ([(1, 1, "F", day, "1-URGENT"), (2, 2, "O", day, "1-URGENT"), (3, 3, "O", day, "1-URGENT"), (4, 1, "F", day, "5-LOW")],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(1, 1, 7, 1, 2.0, day), (1, 1, 8, 1, 3.0, day), (1, 3, 7, 2, 1.0, day), (2, 1, 7, 1, 5.0, day), (3, 1, 7, 1, 1.0, dt.datetime(1996, 2, 3)), (4, 2, 7, 1, 1.0, day)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_shipdate timestamp"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_dates_of_every_format_and_none(spark):
    texts = ["2024-06-15", "5/6/2024", "2024-06-15 10:11:12", "2024-06-15T10:11:12", "15/06/2024 9:05", "15/06/2024 9:05:06", "2024-06", "15/06", "", "x-y/z:", None]
    out = spark.createDataFrame([(c,) for c in texts], "c string").select(parse_date(F.col("c")).cast("string"))
    assert [r[0] for r in out.collect()] == ["2024-06-15", "2024-06-05", *["2024-06-15"] * 4, *[None] * 5]
    # no text without a colon reaches a format with one
    assert plan(out).lower().count("contains(") >= 6


def test_orders_find_customers_before_lines(spark, root):
    text = plan(staged_report(Tables(spark, root)))
    assert "l_orderkey" in text.split("Join Inner, ")[1].splitlines()[0]


def test_dq_report_joins_and_resolves_once(spark, root):
    out = registry.queries()["dq_report"](spark, root)
    assert "Join Inner, (l_orderkey" not in plan(out)  # the checks read stored rows
    assert {r.check: r.failures for r in out.collect()} == {
        "no_demo": 1, "row_counts": 4, "foreign_keys": 4, "references": 1, "unique_key": 1, "valid_dates": 0, "history": 1, "measure": 1}


def test_equipment_load_reads_the_report_once(spark, root):
    out = registry.queries()["fact_equipment_load"](spark, root)
    assert "Join Inner, (l_orderkey" not in plan(out)  # the report is stored
    rows = {r.request_id: (r.quantity, r.change_type) for r in out.collect()}
    assert rows == {"1-1-1996-01-02": (5.0, "updated"), "1-1-1996-02-03": (1.0, "inserted")}


def test_a_month_merge_stores_no_batch_and_looks_keys_up_in_other_months_only(spark, tmp_path, monkeypatch):
    schema = spark.createDataFrame([], "trip string, request_id string, car_id long, quantity double, loaded_at timestamp").schema
    spec = loading.FactSpec("fact_trip", ("trip",), "day", schema, "sum_trip", ("car_id",))
    cars = [Reference("car", spark.createDataFrame([("c", 1)], "car string, car_id long"), "car", "car_id")]
    searched, labels, find, store = [], [], loading.places_of, loading.materialize

    def places(stored, *args):
        searched.append({(r.year, r.month) for r in stored.select("year", "month").distinct().collect()})
        return find(stored, *args)

    monkeypatch.setattr(loading, "places_of", places)
    monkeypatch.setattr(loading, "materialize", lambda df, label: labels.append((label, out := store(df, label))) or out)

    def load(run_id, rows):
        run = t.Run(spark, str(tmp_path), run_id)
        data = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "trip string, car string, day string, quantity double, seq int")
        done = loading.merge_fact(run, spec, data.withColumn("day", F.col("day").cast("date")), cars, f"2024-01-0{run_id}", F.col("quantity"), moving=True)
        assert not any(n for _, _, n in done.checks())
        run.publish()
        return done.counts

    load("1", [("t1", "c", "2023-11-30", 1.0), ("t2", "c", "2023-12-31", 2.0), ("t3", "c", "2024-01-05", 4.0)])
    # t1 moves, t2 comes twice, t3 brings nothing new, t5 has no car
    counts = load("2", [("t1", "c", "2024-01-01", 1.0), ("t2", "c", "2023-12-30", 3.0), ("t2", "c", "2023-12-31", 5.0), ("t3", "c", "2024-01-05", 4.0), ("t5", "x", "2024-01-05", 4.0)])
    assert counts == {"staged": 5, "inserted": 0, "updated": 2, "matched": 1, "superseded": 1, "rejected": 1}
    assert searched == [set(), {(2023, 11)}]  # the batch's own months are read anyway
    assert [name for name, _ in labels] == ["fact_trip_resolved", "fact_trip_changes"] * 2
    assert labels[-1][1].filter("change_type = 'matched'").isEmpty()
    rows = t.read_published(spark, str(tmp_path), "fact_trip").collect()
    assert sorted((r.trip, r.year, r.month, r.quantity) for r in rows) == [("t1", 2024, 1, 1.0), ("t2", 2023, 12, 5.0), ("t3", 2024, 1, 4.0)]


def test_checksum_is_the_sum_of_the_hashes(spark):
    rows = spark.range(1000)
    got = rows.agg(checksum("id").alias("c"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("d")).first()
    assert got.c == got.d and rows.limit(0).agg(checksum("id")).first()[0] is None
