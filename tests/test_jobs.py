import datetime as dt

import pytest
from pyspark.sql import functions as F

from acequia import schemas, session
from acequia.operators.facts import key_twins
from acequia.plans.loading import TABLES, run_all
from acequia.sources import delimited as d
from acequia.sources import tables as t
from acequia.streaming.incremental import upsert_stream


def test_delimited_detection_and_nulls(spark, tmp_path):
    latin = tmp_path / "a.csv"
    latin.write_bytes(" Código ;Nombre\n510;Bomba\n;n/a\n".encode("latin-1"))
    assert d.detect_format(spark, str(latin)) == (";", d.LATIN1)
    df = d.read_delimited(spark, str(latin))
    assert df.columns == ["Código", "Nombre"]
    assert {tuple(r) for r in df.collect()} == {("510", "Bomba"), (None, None)}
    bom = tmp_path / "b.csv"
    bom.write_bytes("﻿Código,Valor\n510,1.0\n".encode("utf-8"))
    assert d.detect_format(spark, str(bom)) == (",", d.UTF8)
    got = d.read_delimited(spark, str(bom), columns=["Código"])
    assert got.columns == ["Código"] and got.first()[0] == "510"
    assert "inferSchema" not in got.schema.json()
    with pytest.raises(FileNotFoundError, match="x.csv.*y.csv"):
        d.require_inputs(spark, [str(latin), str(tmp_path / "x.csv"), str(tmp_path / "y.csv")])


def test_delimited_encoding_is_decided_over_all_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_bytes("Codigo;Nombre\n1;Acetaminofén\n".encode("latin-1"))
    (tmp_path / "in" / "b.csv").write_bytes("Nombre,Codigo\nCatéter,2\n".encode("utf-8"))
    df = d.read_delimited(spark, str(tmp_path / "in"))
    assert sorted(map(tuple, df.select("Codigo", "Nombre").collect())) == [("1", "Acetaminofén"), ("2", "Catéter")]
    with pytest.raises(ValueError, match="differ in format"):
        d.detect_format(spark, str(tmp_path / "in"))
    with pytest.raises(ValueError, match="Precio"):
        d.read_delimited(spark, str(tmp_path / "in"), columns=["Precio"])


def test_delimited_quotes_short_and_surplus_rows(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('A;B;C\n"Tubo 5"" largo; azul";R1;x\nshort;R2\n3;"x";R3;extra\n4;y;z;\n', encoding="utf-8")
    rows, rejects = d.read_with_rejects(spark, str(path))
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(
        [('Tubo 5" largo; azul', "R1", "x"), ("short", "R2", None), ("4", "y", "z")], key=str)
    assert [r.fields[:4] for r in rejects.collect()] == [["3", "x", "R3", "extra"]]
    with pytest.raises(ValueError, match="surplus"):
        d.read_delimited(spark, str(path))
    path.write_text('A;B\n"one\ntwo";2\n', encoding="utf-8")
    assert d.read_delimited(spark, str(path), multiline=True).first().A == "one\ntwo"
    path.write_text("Solo\nuno\n", encoding="utf-8")
    assert [r.Solo for r in d.read_delimited(spark, str(path)).collect()] == ["uno"]
    schema = schemas.text_schema("B", "A")
    path.write_text("A;B\n1;2\n", encoding="utf-8")
    assert tuple(d.read_delimited(spark, str(path), schema=schema).first()) == ("2", "1")


def test_quoted_line_breaks_are_found(spark, tmp_path):
    (tmp_path / "a.csv").write_text('A;B;C\n1;"two\nlines; and ""quotes""";3\nTubo 5" x;y;z\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text('A;B;C\n7;say "hi;8\n9;5" x;"a"" b"\n', encoding="utf-8")
    (tmp_path / "c.csv").write_text('A;B;C\n4;"open;5\n6;x;y\n', encoding="utf-8")
    formats = {f.file.rsplit("/", 1)[1]: (f.multiline, f.open) for f in d.file_formats(spark, str(tmp_path))}
    assert formats == {"a.csv": (True, False), "b.csv": (False, False), "c.csv": (True, True)}
    rows, rejects = d.read_with_rejects(spark, str(tmp_path), order="seq")
    assert [tuple(r) for r in rows.orderBy("seq").collect()] == [
        ("1", 'two\nlines; and "quotes"', "3", 0), ('Tubo 5" x', "y", "z", 1), ("7", 'say "hi', "8", 2), ("9", '5" x', 'a" b', 3)]
    assert [(r.file.rsplit("/", 1)[1], r.fields, r.reason) for r in rejects.collect()] == [("c.csv", None, d.OPEN_QUOTE)]
    with pytest.raises(ValueError, match="quote left open"):
        d.read_delimited(spark, str(tmp_path / "c.csv"))


def test_quote_states_follow_the_lines(spark, tmp_path):
    import random

    def plain(lines):
        state, crossed = False, False
        for line in lines:
            text, i, start = line, 0, True
            while i < len(text):
                c = text[i]
                if state:
                    if c == '"' and text[i + 1:i + 2] == '"':
                        i += 1
                    elif c == '"':
                        state = start = False
                elif start and c == '"':
                    state = True
                else:
                    start = c == ";"
                i += 1
            crossed |= state
        return crossed, state

    rng, want = random.Random(3), {}
    for n in range(30):
        lines = ["".join(rng.choice(['"', ";", "a", '""', ';"', '";']) for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(1, 6))]
        path = tmp_path / f"{n:02}.csv"
        path.write_text("\n".join(["x", *lines]) + "\n", encoding="utf-8")
        if any('"' in line for line in lines):
            want[path.name] = plain(lines)
    found = d.quote_states(spark, [str(tmp_path / n) for n in want], ";")
    assert {f.rsplit("/", 1)[1]: s for f, s in found.items() if want[f.rsplit("/", 1)[1]][0]} == {n: s for n, s in want.items() if s[0]}
    assert not any(s[1] for f, s in found.items() if not want[f.rsplit("/", 1)[1]][0] and not s[0])


def test_any_number_of_surplus_fields(spark, tmp_path):
    path = tmp_path / "w.csv"
    path.write_text("A;B\n1;2" + ";" * 16 + "lost\n3;4" + ";" * 40 + "\n5;6\n", encoding="utf-8")
    rows, rejects = d.read_with_rejects(spark, str(path), order="seq")
    assert sorted(map(tuple, rows.collect())) == [("3", "4", 1), ("5", "6", 2)]
    assert [(r.fields[0], r.fields[-1], len(r.fields), r.reason) for r in rejects.collect()] == [("1", "lost", 18, d.SURPLUS)]


def test_row_numbers_over_many_blocks(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text("A;B\n" + "".join(f"{name}{i};{'x' * 40}\n" for i in range(3_000)), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows, _ = d.read_with_rejects(spark, str(tmp_path), order="seq")
        assert [r.A for r in rows.orderBy("seq").collect()] == [f"{n}{i}" for n in "ab" for i in range(3_000)]
        assert rows.agg(F.min("seq"), F.max("seq")).first()[:] == (0, 5_999)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_export_reads_back(spark, tmp_path):
    rows = [('say "hi"; ok', "a,b"), ("\\", "ñ")]
    out = t.export_csv(spark.createDataFrame(rows, "x string, y string"), str(tmp_path / "e"), ";")
    assert sorted(map(tuple, d.read_delimited(spark, out).collect())) == sorted(rows)


def test_stage_export_and_partitions(spark, tmp_path):
    df = spark.sql("select 1 as id, 2024 as year, 6 as month, 'é;x' as name")
    t.write_stage(df, str(tmp_path), "stg")
    assert t.read_stage(spark, str(tmp_path), "stg").count() == 1
    path = t.export_csv(df, str(tmp_path / "out"), ";", dt.datetime(2024, 6, 15, 7, 5))
    assert path.endswith("out_20240615_0705")
    assert d.read_delimited(spark, path).first()["name"] == "é;x"
    t.write_fact(df, str(tmp_path / "fact"))
    pruned = spark.read.parquet(str(tmp_path / "fact")).filter("year = 2024 and month = 6")
    assert pruned.count() == 1
    assert "PartitionFilters: [isnotnull(year" in pruned._jdf.queryExecution().toString()


def test_publish_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path)
    t.publish({"x": spark.range(1)}, root, "1")
    bad = spark.range(1).select(F.raise_error(F.lit("boom")).alias("id"))
    with pytest.raises(Exception, match="boom"):
        t.publish({"x": spark.range(5), "y": bad}, root, "2")
    assert t.current_run(spark, root) == "1" and t.read_published(spark, root, "x").count() == 1
    t.publish({"x": spark.range(7)}, root, "3")
    assert t.read_published(spark, root, "x").count() == 7
    with pytest.raises(FileExistsError):
        t.publish({"x": spark.range(9)}, root, "10")
    failing = spark.sql("select 'c' as name, false as passed")
    with pytest.raises(ValueError, match="checks"):
        t.publish({"x": spark.range(9)}, root, "4", lambda tables: failing)
    assert t.current_run(spark, root) == "3"
    t.publish({"x": spark.range(2)}, root, "5", keep_runs=1)
    assert t.published_runs(spark, root) == ["5"] and t.read_published(spark, root, "x").count() == 2


def test_cluster_needs_a_shared_folder(spark):
    class Context:
        master = "spark://host:7077"

    class Session:
        conf = {}
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_codes_twins_and_rejects(spark, tmp_path):
    tables = staged(spark)

    def frame(rows, like):
        return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], tables[like].schema)

    tables["insurers"] = frame([("01", "Salud A"), (None, "Sin codigo"), (" ", "Blanco")], "insurers")
    tables["patients"] = frame([("100.0", "Ana", "Cali", "A", "01", "Z", "5/6/2024")], "patients")
    tables["equipment"] = frame([("ab1", "Bomba", "ACTIVO"), ("AB1", "Bomba 2", "ACTIVO")], "equipment")
    tables["report"] = frame([("ab1", "S1", "100", "01.0", "5/6/2024", "1"), ("AB1", "S2", "100.0", "01", "2024-06-15T10:00:00", "1")], "report")
    tables["history"] = frame([("P1.0", "100", "Gasa", "01.0", "05/06/2024 10:00")], "history")
    _, rejects = run_all(spark, str(tmp_path), tables, "1", "2024-06-15", "2024-06-15 06:00:00")
    read = lambda name: t.read_published(spark, str(tmp_path), name)
    assert [r.insurer_nk for r in read("dim_insurer").collect()] == ["01"]
    assert [r.document for r in read("dim_patient").collect()] == ["100"]
    facts = read("fact_equipment").collect()
    assert len(facts) == 2 and len({r.equipment_id for r in facts}) == 1
    assert rejects["fact_equipment"].count() == 0 and rejects["fact_service"].count() == 0
    assert sorted((r.table, r.seq, r.reason) for r in rejects["dimensions"].collect()) == [
        ("dim_insurer", 1, "no insurer_nk"), ("dim_insurer", 2, "no insurer_nk")]
    assert [r.spellings for r in key_twins(read("dim_equipment"), "equipment_nk").collect()] == [["AB1", "ab1"]]


def staged(spark):
    def frame(rows, columns):
        return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], f"{columns}, seq int")

    return {
        "insurers": frame([("01.0", " Salud A ")], "insurer_nk string, insurer string"),
        "patients": frame([("100", "Ana", "Cali", "A", "01", "Z", "2024-01-01")], "document string, name string, city string, state string, insurer string, zone string, admitted string"),
        "equipment": frame([("510.0", "Bomba", "ACTIVO")], "equipment_nk string, equipment string, state string"),
        "orders": frame([("P1", "Gasa", "2")], "order_number string, item string, quantity string"),
        "drugs": frame([("M1", "Dipirona", "tab", "oral")], "code string, name string, form string, route string"),
        "report": frame(
            [("510", "S1", "100", "01", "15/06/2024", "1"), ("510", "S1", "100", "01", "15/06/2024", "3"),
             ("999", "S2", "100", "01", "2024-06-16", "1"), ("510", "S3", "200", "02", "2024-06-16", "2")],
            "equipment_nk string, serial string, document string, insurer_nk string, delivered string, quantity string",
        ),
        "history": frame(
            [("P1", "100", "Gasa", "01", "2024-06-15"), ("P9", "300", "Venda", "01", "2024-06-17")],
            "order_number string, document string, item string, insurer_nk string, sent string",
        ),
    }


def test_full_run_and_rerun(spark, tmp_path):
    root = str(tmp_path)
    checks, rejects = run_all(spark, root, staged(spark), "20240615", "2024-06-15", "2024-06-15 06:00:00")
    assert checks.filter("not passed").count() == 0
    assert [r.equipment_nk for r in rejects["fact_equipment"].collect()] == ["999"]
    facts = t.read_published(spark, root, "fact_equipment")
    assert sorted((r.request_id, r.quantity) for r in facts.collect()) == [("510-S1-2024-06-15", 3.0), ("510-S3-2024-06-16", 2.0)]
    june = facts.filter("year = 2024 and month = 6")
    assert june.count() == 2 and "PartitionFilters: [isnotnull(year" in june._jdf.queryExecution().toString()
    first = {name: t.read_published(spark, root, name).count() for name in TABLES}
    assert first["dim_patient"] == 3 and first["dim_insurer"] == 2 and first["dim_date"] == 3 and first["dim_order"] == 2
    assert t.read_published(spark, root, "dim_patient").schema.names == schemas.DIM_PATIENT.names
    run_all(spark, root, staged(spark), "20240616", "2024-06-16", "2024-06-16 06:00:00")
    assert {name: t.read_published(spark, root, name).count() for name in TABLES} == first


def test_stream_applies_each_batch_once(spark, tmp_path):
    root, arriving = str(tmp_path / "wh"), str(tmp_path / "in")
    initial = spark.createDataFrame([("A", "old")], "k string, v string")
    batch = spark.createDataFrame([("A", "x", 1), ("A", "old", 2), ("B", "new", 3)], "k string, v string, seq int")

    def run():
        stream = spark.readStream.schema(batch.schema).parquet(arriving)
        upsert_stream(stream, initial, root, "t", ["k"], ["v"], "seq", str(tmp_path / "cp")).awaitTermination()
        return sorted(map(tuple, t.read_published(spark, root, "t").collect()))

    batch.write.parquet(arriving)
    assert run() == [("A", "old"), ("B", "new")]
    spark.createDataFrame([("B", "newer", 4)], batch.schema).write.mode("append").parquet(arriving)
    assert run() == [("A", "old"), ("B", "newer")]
    assert run() == [("A", "old"), ("B", "newer")]
