"""Facts kept by month, with keys that hold dashes, corrections and moves, on the shared tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from acequia.operators.facts import Reference, fact_rows, id_twins, load_facts
from acequia.plans.loading import FactSpec, merge_fact
from acequia.registry.scenario import NEW_STAMP, OLD_STAMP, Tables, text, with_ctes
from acequia.session import shared_dir
from acequia.sources.tables import Run, read_published, remove_at_exit

_ORDER = ["l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"]


def _suppliers(t: Tables) -> Reference:
    known = t.supplier.select(text("s_suppkey").alias("supplier_nk"), (F.col("s_suppkey") + 1).alias("supplier_id"))
    return Reference("supplier_nk", known, "supplier_nk", "supplier_id")


# -- keys whose parts hold the dash -------------------------------------------------

_TWIN_KEY = ["part_a", "part_b"]


def _dashed(t: Tables) -> DataFrame:
    """Every line twice, under keys that differ but read alike when joined by dashes."""
    order, line, supplier = text("l_orderkey"), text("l_linenumber"), text("l_suppkey")
    lines = t.lineitem.select("*", supplier.alias("supplier_nk"))
    first = lines.select(F.concat_ws("-", order, line).alias("part_a"), supplier.alias("part_b"), F.col("l_quantity").alias("pieces"), "supplier_nk", *_ORDER, "l_returnflag")
    second = lines.select(order.alias("part_a"), F.concat_ws("-", line, supplier).alias("part_b"), (F.col("l_quantity") + 1).alias("pieces"), "supplier_nk", *_ORDER, "l_returnflag")
    return first.unionByName(second)


def fact_dashed_keys(spark, root):
    """Facts with one request id and different keys are different facts."""
    t = Tables(spark, root)
    staged, suppliers = _dashed(t), _suppliers(t)
    known = staged.filter("l_returnflag = 'R' and part_a like '%-%'").select(
        *_TWIN_KEY, F.concat_ws("-", *_TWIN_KEY).alias("request_id"), (F.col("supplier_nk").cast("long") + 1).alias("supplier_id"),
        F.lit(0.0).alias("quantity"), F.lit(OLD_STAMP).cast("timestamp").alias("loaded_at")).distinct()
    snapshot, _ = load_facts(known, staged, [suppliers], _TWIN_KEY, _ORDER, NEW_STAMP, F.col("pieces"))
    return snapshot.drop("loaded_at")


def fact_id_twins(spark, root):
    t = Tables(spark, root)
    rows, _ = fact_rows(_dashed(t), [_suppliers(t)], _TWIN_KEY, F.col("pieces"))
    return id_twins(rows, _TWIN_KEY)


# -- three loads into months ---------------------------------------------------------

_SCHEMA = "order_key string, line string, request_id string, supplier_id bigint, quantity double, loaded_at timestamp"
_MOVED_DAYS = 40


def _loads(t: Tables) -> list[DataFrame]:
    """Returned lines first; then all returned or accepted ones, a quarter of them shipped later; then corrected quantities."""
    lines = t.lineitem.select(
        text("l_orderkey").alias("order_key"), text("l_linenumber").alias("line"), text("l_suppkey").alias("supplier_nk"),
        F.col("l_shipdate").cast("date").alias("shipped"), F.col("l_quantity").alias("pieces"), *_ORDER, "l_returnflag", "l_linestatus")
    later = F.when(F.col("l_linestatus") == "F", F.date_add("shipped", _MOVED_DAYS)).otherwise(F.col("shipped"))
    return [
        lines.filter("l_returnflag = 'R'"),
        lines.filter("l_returnflag in ('R', 'A')").withColumn("shipped", later),
        lines.filter("l_returnflag = 'N' or l_linestatus = 'F'").withColumns({"shipped": later, "pieces": F.col("pieces") + F.lit(0.5)}),
    ]


def _loaded(t: Tables) -> str:
    """Root of a warehouse after the three loads, each a run of its own."""
    spark, root = t.spark, f"{shared_dir(t.spark)}/months-{uuid.uuid4().hex}"
    remove_at_exit(spark, root)
    schema: StructType = spark.createDataFrame([], _SCHEMA).schema
    spec = FactSpec("fact_line", ("order_key", "line"), "shipped", schema, "sum_line", ("supplier_id",))
    for i, staged in enumerate(_loads(t), 1):
        run = Run(spark, root, str(i))
        done = merge_fact(run, spec, staged, [_suppliers(t)], f"2024-01-0{i}", F.col("pieces"), moving=True, order=_ORDER)
        lost = [c for c in done.checks() if c[2]]
        if lost:
            raise ValueError(f"load {i} does not add up: {lost}")
        run.publish()
    return root


def fact_month_merge(spark, root):
    """Facts after three loads by month; a fact whose date changed has moved. `load` is the one that last changed it."""
    facts = read_published(spark, _loaded(Tables(spark, root)), "fact_line")
    return facts.select("order_key", "line", "request_id", "supplier_id", "quantity", "year", "month", F.dayofmonth("loaded_at").alias("load"))


def report_sums_kept(spark, root):
    """Sums by year and supplier that the three loads maintained through their changes."""
    sums = read_published(spark, _loaded(Tables(spark, root)), "sum_line")
    return sums.select("year", "supplier_id", "n", F.col("total").cast("double").alias("total"))


QUERIES = {
    "fact_dashed_keys": fact_dashed_keys,
    "fact_id_twins": fact_id_twins,
    "fact_month_merge": fact_month_merge,
    "report_sums_kept": report_sums_kept,
}

_DASHED = (
    ("lines", "SELECT l.*, l_suppkey + 1 AS supplier_id FROM lineitem l JOIN supplier ON s_suppkey = l_suppkey"),
    ("staged", """
        SELECT l_orderkey || '-' || l_linenumber AS part_a, CAST(l_suppkey AS VARCHAR) AS part_b, l_quantity AS quantity, * EXCLUDE (l_quantity), l_quantity FROM lines
        UNION ALL
        SELECT CAST(l_orderkey AS VARCHAR), l_linenumber || '-' || l_suppkey, l_quantity + 1, * EXCLUDE (l_quantity), l_quantity FROM lines"""),
)
_LAST = "ORDER BY l_partkey DESC, l_quantity DESC, l_extendedprice DESC, l_shipdate DESC) = 1"


def _load_sql(where: str, shipped: str, quantity: str) -> str:
    return f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS order_key, CAST(l_linenumber AS VARCHAR) AS line, supplier_id, {quantity} AS quantity,
               CAST(year({shipped}) AS INTEGER) AS year, CAST(month({shipped}) AS INTEGER) AS month
        FROM lines WHERE {where} QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber {_LAST}"""


_DAY = "CAST(l_shipdate AS DATE)"
_LATER = f"(CASE WHEN l_linestatus = 'F' THEN CAST({_DAY} + INTERVAL {_MOVED_DAYS} DAY AS DATE) ELSE {_DAY} END)"


def _apply(name: str, before: str, batch: str, number: int) -> tuple[str, str]:
    values = ("supplier_id", "quantity", "year", "month")
    differs = " OR ".join(f"b.{c} IS DISTINCT FROM n.{c}" for c in values)
    picked = ", ".join(f"CASE WHEN n.order_key IS NULL THEN b.{c} ELSE n.{c} END AS {c}" for c in values)
    return (name, f"""
        SELECT order_key, line, {picked},
               CASE WHEN n.order_key IS NOT NULL AND (b.order_key IS NULL OR {differs}) THEN {number} ELSE b.load END AS load
        FROM {before} b FULL JOIN {batch} n USING (order_key, line)""")


_MONTHS = (
    _DASHED[0],
    ("l1", _load_sql("l_returnflag = 'R'", _DAY, "l_quantity")),
    ("l2", _load_sql("l_returnflag IN ('R', 'A')", _LATER, "l_quantity")),
    ("l3", _load_sql("l_returnflag = 'N' OR l_linestatus = 'F'", _LATER, "l_quantity + 0.5")),
    ("f1", "SELECT *, 1 AS load FROM l1"),
    _apply("f2", "f1", "l2", 2),
    _apply("f3", "f2", "l3", 3),
)

SQL = {
    "fact_dashed_keys": with_ctes(
        *_DASHED,
        ("known", "SELECT DISTINCT part_a, part_b, supplier_id, 0.0 AS quantity FROM staged WHERE l_returnflag = 'R' AND part_a LIKE '%-%'"),
        ("now", f"SELECT part_a, part_b, supplier_id, quantity FROM staged QUALIFY row_number() OVER (PARTITION BY part_a, part_b {_LAST}"),
        select="""SELECT part_a, part_b, part_a || '-' || part_b AS request_id, n.supplier_id, n.quantity,
                  CASE WHEN o.part_a IS NULL THEN 'inserted' WHEN o.quantity <> n.quantity OR o.supplier_id <> n.supplier_id THEN 'updated' ELSE 'matched' END AS change_type
                  FROM now n LEFT JOIN known o USING (part_a, part_b)""",
    ),
    "fact_id_twins": with_ctes(
        *_DASHED,
        select="""SELECT part_a || '-' || part_b AS request_id, count(DISTINCT (part_a, part_b)) AS keys FROM staged
                  GROUP BY 1 HAVING count(DISTINCT (part_a, part_b)) > 1""",
    ),
    "fact_month_merge": with_ctes(*_MONTHS, select="SELECT *, order_key || '-' || line AS request_id FROM f3"),
    "report_sums_kept": with_ctes(*_MONTHS, select="SELECT year, supplier_id, count(*) AS n, sum(quantity) AS total FROM f3 GROUP BY year, supplier_id"),
}
