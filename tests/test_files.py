"""A delivery of CSV files, cleaned, loaded, checked and published."""

import pytest

from acequia.plans.files import SOURCES, run_from_files
from acequia.plans.loading import TABLES
from acequia.sources import tables as t

FILES = {
    "insurers": ("Aseguradora;Codigo Sistema\nSalud A;01.0\nSalud B;02\n", "latin-1"),
    "patients": ("Identificacion;Nombre;Municipio;Nombre Estado;Aseguradora;Zona;Fecha Ingreso\n100.0;Añá;Cali;A;01;Z;5/6/2024\n;Nadie;;;;;\n", "latin-1"),
    "equipment": ("Código Interno;Nombre Equipo;EQUIPO ACTIVO\n510.0;Bomba;ACTIVO\n", "utf-8-sig"),
    "drugs": ("codigo;Código del Medicamento;Nombre;forma_farmaceutica;via_administracion\nM1;M1;Dipirona 500 mg;tab;oral\n", "utf-8"),
    "supplies": ("CODIGO INTERNO;DESCRIPCIÓN DEL INSUMO\nI1;Gasa estéril\n", "latin-1"),
    "orders": ("Cedula;Numero Pedido;Insumo Solicitado;Cantidad\n100;P1;gasa esteril;2\ndemo1;P2;gasa esteril;2\n100;P3;algo sin codigo;2\n", "latin-1"),
    "report": ("Codigo;Numero Serie;Documento Paciente;Aseguradora;Fecha Entregado;Cantidad Equipos\n510;S1;100; Salud A ;15/06/2024;1\n510;S1;100;Salud A;15/06/2024;3\n510;S2;xDemo9;Salud A;15/06/2024;1\n510;S3;100;Otra;2024-06-16;2;extra\n", "latin-1"),
    "history": ("Servicio;Numero de pedido;Identificacion Paciente;Fecha envio a logistica;Aseguradora;Estado del pedido\nGasa;P1;100;2024-06-15;01;ok\n", "utf-8"),
}


def test_from_files_to_a_published_warehouse(spark, tmp_path):
    inputs = {}
    for source, (text, encoding) in FILES.items():
        inputs[source] = str(tmp_path / f"{source}.csv")
        (tmp_path / f"{source}.csv").write_bytes(text.encode(encoding))
    root, out = str(tmp_path / "wh"), str(tmp_path / "out")
    assert set(inputs) == set(SOURCES)
    done = run_from_files(spark, inputs, root, "1", "2024-06-20", "2024-06-20 06:00:00", out)
    read = lambda name: t.read_published(spark, root, name).collect()
    assert done.checks.filter("not passed").count() == 0
    assert [(r.insurer_nk, r.insurer) for r in sorted(read("dim_insurer"))] == [("01", "Salud A"), ("02", "Salud B")]
    assert [(r.document, r.name, str(r.admitted)) for r in read("dim_patient")] == [("100", "Añá", "2024-06-05")]
    assert [(r.order_number, r.item, r.quantity) for r in read("dim_order")] == [("P1", "I1", 2.0)]
    assert [(r.request_id, r.quantity) for r in read("fact_equipment")] == [("510-S1-2024-06-15", 3.0)]
    assert [r.fields[6] for r in done.surplus["report"].collect()] == ["extra"]
    assert [r.table for r in done.rejects["dimensions"].collect()] == ["dim_patient"]
    counts = {name: len(read(name)) for name in TABLES}
    run_from_files(spark, inputs, root, "2", "2024-06-21", "2024-06-21 06:00:00")
    assert {name: len(read(name)) for name in TABLES} == counts and t.current_run(spark, root) == "2"
    with pytest.raises(FileNotFoundError, match="gone.csv"):
        run_from_files(spark, {**inputs, "report": str(tmp_path / "gone.csv")}, root, "3", "2024-06-22", "2024-06-22 06:00:00")
