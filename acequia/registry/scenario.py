"""Warehouse tables derived from the shared tables, as DataFrames and as SQL.

Every frame reads its tables whole. Where a dimension must lack members, have
closed versions or dirty values, attributes decide (segment, type, balance), and
`CTES` states the same rule in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOAD_DATE = "1998-06-15"
FIRST_LOAD = "1995-06-01"
OLD_STAMP = "1998-01-01 06:00:00"
NEW_STAMP = "1998-06-15 06:00:00"


class Tables:
    """Lazy access to one folder of Parquet tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def iso(df: DataFrame, *cols: str) -> DataFrame:
    """Dates and timestamps as text, for comparison across engines."""
    return df.withColumns({c: text(c) for c in cols})


def _valid(df: DataFrame, current: Column) -> DataFrame:
    end = F.when(current, F.lit("9999-12-31")).otherwise(F.lit("1997-01-01"))
    return df.withColumns(
        {"valid_from": F.lit(FIRST_LOAD).cast("date"), "valid_to": end.cast("date"), "is_current": current}
    )


# -- dimensions as they stand before a load ------------------------------------


def insurers(t: Tables) -> DataFrame:
    """Nations as insurers; those of region 4 are not known yet."""
    known = t.nation.filter("n_regionkey <> 4").select(
        (F.col("n_nationkey") + 1).cast("long").alias("insurer_id"), text("n_nationkey").alias("insurer_nk"),
        F.col("n_name").alias("insurer"),
    )
    return _valid(known, F.lit(True))


def patients(t: Tables) -> DataFrame:
    """Customers as patients; those with a negative balance are not known yet."""
    known = t.customer.filter("c_acctbal >= 0").select(
        (F.col("c_custkey") + 1).alias("patient_id"), text("c_custkey").alias("document"),
        F.col("c_name").alias("name"), F.lit("1-URGENT").alias("city"), F.lit("O").alias("state"),
        F.col("c_mktsegment").alias("zone"),
    )
    return _valid(known, F.lit(True))


def equipment(t: Tables) -> DataFrame:
    """Parts as equipment; type PROMO is unknown and size 13 has only a closed version."""
    known = t.part.filter("p_type <> 'PROMO'").select(
        (F.col("p_partkey") + 1).alias("equipment_id"), text("p_partkey").alias("equipment_nk"),
        F.col("p_name").alias("equipment"), F.col("p_type").alias("state"), "p_size",
    )
    return _valid(known, F.col("p_size") != 13).drop("p_size")


def first_dates(t: Tables) -> DataFrame:
    """Date dimension of the order dates, numbered as year, month, day."""
    day = F.col("o_orderdate").cast("date")
    return (
        t.orders.select(day.alias("date")).distinct()
        .select(
            F.date_format("date", "yyyyMMdd").cast("long").alias("date_id"), "date",
            F.year("date").alias("year"), F.month("date").alias("month"),
        )
    )


# -- staged sources --------------------------------------------------------------


def staged_report(t: Tables) -> DataFrame:
    """Order lines as the equipment report, all text, with padded codes.

    Orders find their customers first, so that the lines are shuffled once.
    """
    placed = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return (
        t.lineitem.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.concat(F.lit(" "), text("l_partkey"), F.lit(" ")).alias("equipment_nk"),
            text("l_linenumber").alias("serial"),
            F.when(F.col("o_orderpriority") != "5-LOW", text("c_custkey")).alias("document"),
            F.col("c_name").alias("patient"),
            text("c_nationkey").alias("insurer_nk"),
            F.date_format("l_shipdate", "dd/MM/yyyy").alias("delivered"),
            text("l_quantity").alias("quantity"),
            "l_orderkey", "l_suppkey", "o_orderstatus",
        )
    )


def staged_services(t: Tables) -> DataFrame:
    """Events as service requests; an event type of a user is an order."""
    return t.events.join(t.customer, F.col("user_id") == F.col("c_custkey")).select(
        text("user_id").alias("document"), F.concat_ws("/", text("user_id"), "event_type").alias("order_number"),
        text("c_nationkey").alias("insurer_nk"), F.col("ts").cast("date").alias("sent"),
        "event_type", "event_id",
    )


CTES = {
    "dim_insurer": f"""
        SELECT n_nationkey + 1 AS insurer_id, CAST(n_nationkey AS VARCHAR) AS insurer_nk, n_name AS insurer,
               DATE '{FIRST_LOAD}' AS valid_from, DATE '9999-12-31' AS valid_to, TRUE AS is_current
        FROM nation WHERE n_regionkey <> 4""",
    "dim_patient": f"""
        SELECT c_custkey + 1 AS patient_id, CAST(c_custkey AS VARCHAR) AS document, c_name AS name,
               '1-URGENT' AS city, 'O' AS state, c_mktsegment AS zone,
               DATE '{FIRST_LOAD}' AS valid_from, DATE '9999-12-31' AS valid_to, TRUE AS is_current
        FROM customer WHERE c_acctbal >= 0""",
    "dim_equipment": f"""
        SELECT p_partkey + 1 AS equipment_id, CAST(p_partkey AS VARCHAR) AS equipment_nk,
               p_name AS equipment, p_type AS state, DATE '{FIRST_LOAD}' AS valid_from,
               CASE WHEN p_size <> 13 THEN DATE '9999-12-31' ELSE DATE '1997-01-01' END AS valid_to,
               p_size <> 13 AS is_current
        FROM part WHERE p_type <> 'PROMO'""",
    "first_dates": """
        SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_id, CAST(o_orderdate AS DATE) AS date,
               CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
        FROM orders""",
    "report": """
        SELECT ' ' || l_partkey || ' ' AS equipment_nk, CAST(l_linenumber AS VARCHAR) AS serial,
               CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(c_custkey AS VARCHAR) END AS document,
               c_name AS patient, CAST(c_nationkey AS VARCHAR) AS insurer_nk,
               CAST(l_shipdate AS DATE) AS delivered, l_quantity AS quantity,
               l_orderkey, l_suppkey, o_orderstatus
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "services": """
        SELECT CAST(user_id AS VARCHAR) AS document, user_id || '/' || event_type AS order_number,
               CAST(c_nationkey AS VARCHAR) AS insurer_nk, CAST(ts AS DATE) AS sent, event_type, event_id
        FROM events JOIN customer ON user_id = c_custkey""",
}


def with_ctes(*names_or_pairs: str | tuple[str, str], select: str) -> str:
    """SQL of a select over named scenario tables and (name, body) pairs, in order."""
    parts = [(n, CTES[n]) if isinstance(n, str) else n for n in names_or_pairs]
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in parts) + "\n" + select


def sql_rank(key: str, order: str) -> str:
    """The numbering of `assign_ids` in SQL."""
    return f"row_number() OVER (ORDER BY substr(md5({key}), 1, 3), {order})"
