"""Star-join reports on the shared tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acequia.operators.members import distinct_dates, extend_dates
from acequia.operators.reports import equipment_by_month, read_stored, services_by_insurer, store_by_year, top_equipment
from acequia.registry.scenario import Tables, equipment, first_dates, insurers, sql_rank, with_ctes
from acequia.session import shared_dir


def all_dates(t: Tables) -> DataFrame:
    return extend_dates(first_dates(t), distinct_dates(t.lineitem, "l_shipdate"))


_ALL_DATES = (
    "first_dates",
    ("max_date", "SELECT max(date_id) AS m FROM first_dates"),
    ("new_dates", """SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem
                     WHERE CAST(l_shipdate AS DATE) NOT IN (SELECT date FROM first_dates)"""),
    ("all_dates", f"""SELECT * FROM first_dates UNION ALL
        SELECT m + {sql_rank("CAST(date AS VARCHAR)", "date")}, date, CAST(year(date) AS INTEGER),
               CAST(month(date) AS INTEGER) FROM new_dates, max_date"""),
)


def _equipment_facts(t: Tables, dates: DataFrame) -> DataFrame:
    lines = t.lineitem.select(
        (F.col("l_partkey") + 1).alias("equipment_id"), F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_quantity").alias("quantity"),
    )
    return lines.join(dates.select("date", "date_id"), "date").drop("date")


def report_equipment_month(spark, root):
    t = Tables(spark, root)
    dates = all_dates(t)
    return equipment_by_month(_equipment_facts(t, dates), equipment(t), dates)


def report_top_equipment(spark, root):
    t = Tables(spark, root)
    dates = all_dates(t)
    return top_equipment(_equipment_facts(t, dates), equipment(t), dates)


def report_services_insurer(spark, root):
    t = Tables(spark, root)
    facts = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.customer, F.col("o_custkey") == F.col("c_custkey")
    ).select((F.col("c_nationkey") + 1).cast("long").alias("insurer_id"), F.col("l_quantity").alias("quantity"))
    return services_by_insurer(facts, insurers(t))


def report_stored(spark, root):
    """The monthly report, stored by year and read back."""
    path = f"{shared_dir(spark)}/report-{uuid.uuid4().hex}"
    store_by_year(report_equipment_month(spark, root), path)
    return read_stored(spark, path).select("year", "month", "equipment", "total")


def dim_date_build(spark, root):
    return all_dates(Tables(spark, root)).select("date_id", F.col("date").cast("string").alias("date"), "year", "month")


QUERIES = {
    "report_equipment_month": report_equipment_month,
    "report_top_equipment": report_top_equipment,
    "report_services_insurer": report_services_insurer,
    "report_stored": report_stored,
    "dim_date_build": dim_date_build,
}

_MONTHLY = """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, equipment,
           sum(l_quantity) AS total
    FROM lineitem JOIN dim_equipment ON equipment_id = l_partkey + 1
    WHERE is_current GROUP BY 1, 2, 3"""

SQL = {
    "report_equipment_month": with_ctes("dim_equipment", select=_MONTHLY),
    "report_stored": with_ctes("dim_equipment", select=_MONTHLY),
    "report_top_equipment": with_ctes(
        "dim_equipment", select=_MONTHLY + " ORDER BY year DESC, month DESC, total DESC, equipment LIMIT 20"
    ),
    "report_services_insurer": with_ctes(
        "dim_insurer",
        select="""SELECT insurer, count(*) AS requests, sum(l_quantity) AS items
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
                  JOIN dim_insurer ON insurer_id = c_nationkey + 1 WHERE is_current GROUP BY insurer""",
    ),
    "dim_date_build": with_ctes(
        *_ALL_DATES, select="SELECT date_id, CAST(date AS VARCHAR) AS date, year, month FROM all_dates"
    ),
}
