"""Cleaning jobs over DataFrames as read from the source files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acequia.operators.cleaning import clean_whitespace, drop_demo, keep_filled, recode
from acequia.operators.matching import THRESHOLD, build_catalogue, code_orders


def clean_report(
    report: DataFrame, insurers: DataFrame, document: str = "Documento Paciente",
    insurer: str = "Aseguradora", code: str = "Codigo Sistema",
) -> DataFrame:
    """Equipment report without demo rows, insurers replaced by their codes."""
    return recode(drop_demo(report, document), insurer, insurers, insurer, code)


def clean_history(history: DataFrame, document: str = "Identificacion Paciente") -> DataFrame:
    """Requested-supplies history without demo rows and surplus white space."""
    return drop_demo(clean_whitespace(history), document)


def clean_orders(
    orders: DataFrame, supplies: DataFrame, drugs: DataFrame, order: str,
    document: str = "Cedula", item: str = "Insumo Solicitado",
    threshold: int = THRESHOLD, use_fuzzy: bool = True,
) -> DataFrame:
    """Order lines that could be coded, with the code in place of the item text.

    `order` names the column that holds the row order of the two catalogues.
    """
    catalogue = build_catalogue(
        [
            (supplies, "CODIGO INTERNO", "DESCRIPCIÓN DEL INSUMO", order),
            (drugs, "Código del Medicamento", "Nombre", order),
        ]
    )
    coded = code_orders(drop_demo(orders, document), catalogue, item, threshold, use_fuzzy)
    return keep_filled(coded, "code").withColumn(item, F.col("code")).select(*[f"`{c}`" for c in orders.columns])
