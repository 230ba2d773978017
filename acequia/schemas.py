"""Column names, aliases and warehouse schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BooleanType, DateType, DecimalType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampType,
)


def text_schema(*names: str) -> StructType:
    """Every source column is read as text; casts are explicit and come later."""
    return StructType([StructField(n, StringType()) for n in names])


def _schema(**columns) -> StructType:
    return StructType([StructField(n, t) for n, t in columns.items()])


_S, _L, _D, _B, _I, _F, _T = (
    StringType(), LongType(), DateType(), BooleanType(), IntegerType(), DoubleType(), TimestampType(),
)

DIM_INSURER = _schema(insurer_id=_L, insurer_nk=_S, insurer=_S, valid_from=_D, valid_to=_D, is_current=_B)
DIM_PATIENT = _schema(
    patient_id=_L, document=_S, name=_S, city=_S, state=_S, insurer=_S, zone=_S,
    admitted=_D, valid_from=_D, valid_to=_D, is_current=_B,
)
DIM_EQUIPMENT = _schema(
    equipment_id=_L, equipment_nk=_S, equipment=_S, state=_S, valid_from=_D, valid_to=_D, is_current=_B,
)
DIM_ORDER = _schema(order_id=_L, order_number=_S, item=_S, quantity=_F)
DIM_DRUG = _schema(code=_S, name=_S, form=_S, route=_S)
DIM_DATE = _schema(date_id=_L, date=_D, year=_I, month=_I)
# The key of a fact are its key texts; `request_id` joins them for reading alone.
FACT_EQUIPMENT = _schema(
    equipment_nk=_S, serial=_S, delivered=_S, request_id=_S, equipment_id=_L, patient_id=_L, insurer_id=_L, date_id=_L, quantity=_F, loaded_at=_T,
)
FACT_SERVICE = _schema(
    order_number=_S, document=_S, item=_S, sent=_S, request_id=_S, order_id=_L, patient_id=_L, insurer_id=_L, date_id=_L, quantity=_F, loaded_at=_T,
)
# Stored sums of a fact, beside their keys.
SUMS = _schema(n=_L, total=DecimalType(38, 6))

# Header texts of the source files -> names used here. Where files
# are known under several headers, each of them is listed.
ALIASES = {
    "insurers": {"Codigo Sistema": "insurer_nk", "Aseguradora": "insurer"},
    "patients": {
        "Identificacion": "document", "Nombre": "name", "Municipio": "city",
        "Nombre Estado": "state", "Aseguradora": "insurer", "Zona": "zone",
        "Fecha Ingreso": "admitted",
    },
    "equipment": {
        "Código Interno": "equipment_nk", "Nombre Equipo": "equipment", "EQUIPO ACTIVO": "state",
    },
    "drugs": {
        "Código del Medicamento": "code", "codigo": "code", "Nombre": "name", "nombre": "name",
        "forma_farmaceutica": "form", "via_administracion": "route",
    },
    "supplies": {"CODIGO INTERNO": "code", "DESCRIPCIÓN DEL INSUMO": "name"},
    "orders": {
        "Cedula": "document", "Numero Pedido": "order_number", "Insumo Solicitado": "item",
        "Cantidad": "quantity",
    },
    "report": {
        "Codigo": "equipment_nk", "Código Interno": "equipment_nk", "Equipo": "equipment",
        "Documento Paciente": "document", "Aseguradora": "insurer_nk",
        "Fecha Entregado": "delivered", "Cantidad Equipos": "quantity",
        "Estado Equipo": "state", "Numero Serie": "serial",
    },
    "history": {
        "Servicio": "item", "Numero de pedido": "order_number",
        "Identificacion Paciente": "document", "Fecha envio a logistica": "sent",
        "Aseguradora": "insurer_nk", "Estado del pedido": "order_state",
    },
}


def rename(df: DataFrame, source: str) -> DataFrame:
    """Apply the aliases of one source; other columns pass through.

    Of several columns with one alias the first is renamed, the others keep their names.
    """
    known, used = {}, set(df.columns)
    for c in df.columns:
        alias = ALIASES[source].get(c)
        if alias is not None and alias not in used:
            known[c] = alias
            used.add(alias)
    return df.withColumnsRenamed(known)
