"""Fact loads and data quality on the shared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acequia.functions.text import composite_key
from acequia.functions.values import parse_date, stamp, to_number
from acequia.operators import quality as q
from acequia.operators.dedupe import dedupe_keep_last, duplicate_keys as repeated
from acequia.operators.facts import (
    Reference, fact_rows, fk_counts, latest_facts, load_facts, resolve_keys, split_facts,
)
from acequia.operators.history import current_only, history_check
from acequia.operators.members import add_missing_members, distinct_dates, extend_dates
from acequia.registry.reports import _ALL_DATES, all_dates
from acequia.registry.scenario import (
    LOAD_DATE, NEW_STAMP, OLD_STAMP, Tables, equipment, first_dates, insurers, iso, patients,
    sql_rank, staged_report, staged_services, with_ctes,
)
from acequia.session import materialize

# -- equipment facts ---------------------------------------------------------------


def _report(t: Tables) -> DataFrame:
    return staged_report(t).withColumns(
        {"delivered": parse_date(F.col("delivered")), "quantity": to_number(F.col("quantity"))}
    )


def _plain_references(t: Tables) -> list[Reference]:
    """Dimensions as they are: some staged keys stay unresolved.

    The few dates are stored, so that Spark knows their size and broadcasts them.
    """
    dates = materialize(first_dates(t), "first_dates")
    return [
        Reference("equipment_nk", current_only(equipment(t)), "equipment_nk", "equipment_id"),
        Reference("document", patients(t), "document", "patient_id"),
        Reference("insurer_nk", insurers(t), "insurer_nk", "insurer_id"),
        Reference("delivered", dates, "date", "date_id", is_date=True),
    ]


def _completed_references(t: Tables, staged: DataFrame) -> list[Reference]:
    """Dimensions after adding the dates, patients and insurers that the report mentions, each stored once."""
    people = add_missing_members(
        patients(t), staged, "document", "document", {"name": F.min("patient")}, "patient_id", LOAD_DATE
    )
    payers = add_missing_members(
        insurers(t), staged, "insurer_nk", "insurer_nk", {"insurer": F.lit("SIN NOMBRE")}, "insurer_id", LOAD_DATE
    )
    dates = extend_dates(first_dates(t), distinct_dates(staged, "delivered"))
    return [
        Reference("equipment_nk", current_only(equipment(t)), "equipment_nk", "equipment_id"),
        Reference("document", materialize(people, "patients"), "document", "patient_id"),
        Reference("insurer_nk", materialize(payers, "insurers"), "insurer_nk", "insurer_id"),
        Reference("delivered", materialize(dates, "dates"), "date", "date_id", is_date=True),
    ]


_PK = ["equipment_nk", "serial", "delivered"]
_ORDER = ["l_orderkey", "l_suppkey", "document"]
_FACT_COLUMNS = ["request_id", "equipment_id", "patient_id", "insurer_id", "date_id", "quantity"]


def _trimmed(df: DataFrame) -> DataFrame:
    return df.withColumn("equipment_nk", F.trim("equipment_nk"))


def _first_facts(t: Tables, staged: DataFrame) -> DataFrame:
    """Facts of an earlier load: finished orders, resolved by the plain dimensions."""
    rows, _ = fact_rows(staged.filter("o_orderstatus = 'F'"), _plain_references(t), _PK, F.lit(0))
    return stamp(latest_facts(rows, _PK, _ORDER).select(*_PK, *_FACT_COLUMNS), "loaded_at", OLD_STAMP)


def _load_equipment(t: Tables) -> tuple[DataFrame, DataFrame]:
    staged = materialize(_trimmed(_report(t)), "report")
    return load_facts(
        _first_facts(t, staged), staged, _completed_references(t, staged), _PK, _ORDER, NEW_STAMP, F.col("quantity")
    )


def fact_equipment_load(spark, root):
    snapshot, _ = _load_equipment(Tables(spark, root))
    return snapshot.drop(*_PK).withColumn("loaded_at", F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss"))


def fact_equipment_valid(spark, root):
    """Lines whose keys all resolve against the plain dimensions."""
    t = Tables(spark, root)
    rows, _ = fact_rows(_trimmed(_report(t)), _plain_references(t), _PK, F.col("quantity"))
    return rows.select(*_FACT_COLUMNS, "l_orderkey", "l_suppkey")


_IDS = {
    "equipment_id": "no_equipment", "patient_id": "no_patient", "insurer_id": "no_insurer", "date_id": "no_date",
}


def fk_rejects(spark, root):
    t = Tables(spark, root)
    return fk_counts(resolve_keys(_report(t), _plain_references(t)), _IDS)


def orphans_fact(spark, root):
    t = Tables(spark, root)
    return q.orphan_count(resolve_keys(_report(t), _plain_references(t)), list(_IDS)[:3])


def orphans_staging(spark, root):
    t = Tables(spark, root)
    return q.orphans(_report(t), equipment(t), "equipment_nk", "equipment_nk")


# -- service facts -----------------------------------------------------------------


def fact_services_upsert(spark, root):
    """Counts one per request; orders, dates and unknown insurers are created on the way."""
    t = Tables(spark, root)
    staged = staged_services(t)
    known = staged.filter("event_type <> 'error'").groupBy("order_number").agg(F.min("event_id").alias("order_id"))
    orders = add_missing_members(known, staged, "order_number", "order_number", {}, "order_id")
    payers = add_missing_members(
        insurers(t), staged, "insurer_nk", "insurer_nk", {"insurer": F.lit("SIN NOMBRE")}, "insurer_id", LOAD_DATE
    )
    dates = extend_dates(first_dates(t), distinct_dates(staged, "sent"))
    references = [
        Reference("order_number", orders, "order_number", "order_id"),
        Reference("document", patients(t), "document", "patient_id"),
        Reference("insurer_nk", materialize(payers, "insurers"), "insurer_nk", "insurer_id"),
        Reference("sent", materialize(dates, "dates"), "date", "date_id", is_date=True),
    ]
    key = ["order_number", "sent"]
    before = staged.filter("event_type = 'click'").select("order_number", F.col("sent").cast("string").alias("sent")).distinct()
    current = stamp(
        before.select(
            *key, composite_key(*[F.col(c) for c in key]).alias("request_id"), *[F.lit(0).cast("long").alias(c) for c in ("order_id", "patient_id", "insurer_id", "date_id")],
            F.lit(1.0).alias("quantity"),
        ),
        "loaded_at", OLD_STAMP,
    )
    snapshot, _ = load_facts(current, staged, references, key, "event_id", NEW_STAMP)
    return snapshot.drop(*key).withColumn("loaded_at", F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss"))


# -- duplicates and monitoring -----------------------------------------------------

_LINE = ["l_orderkey", "l_linenumber"]


def dedupe_lines(spark, root):
    lines = Tables(spark, root).lineitem
    return iso(dedupe_keep_last(lines, _LINE, ["l_shipdate", "l_partkey", "l_suppkey"]).withColumn(
        "l_shipdate", F.col("l_shipdate").cast("date")), "l_shipdate")


def duplicate_keys(spark, root):
    return repeated(Tables(spark, root).lineitem, _LINE)


def table_counts(spark, root):
    t = Tables(spark, root)
    return q.table_counts(
        {
            "dim_equipment": current_only(equipment(t)), "dim_patient": current_only(patients(t)),
            "dim_insurer": current_only(insurers(t)), "dim_order": t.orders, "stg_report": t.lineitem,
            "stg_services": t.events,
        }
    )


def load_monitor(spark, root):
    t = Tables(spark, root)
    facts = {
        "fact_equipment": t.lineitem.select(F.col("l_shipdate").alias("loaded_at")),
        "fact_service": t.events.select(F.col("ts").alias("loaded_at")),
        "fact_order": t.orders.select(F.col("o_orderdate").alias("loaded_at")),
    }
    return q.load_monitor(facts).withColumn("last_load", F.date_format("last_load", "yyyy-MM-dd HH:mm:ss"))


def null_profile(spark, root):
    """Nulls per column of the resolved report, before rejection."""
    t = Tables(spark, root)
    resolved = resolve_keys(_report(t), _plain_references(t))
    return q.null_profile(resolved.drop("l_orderkey", "l_suppkey", "o_orderstatus"), "stg_report")


def dq_report(spark, root):
    """All checks read the staged and the resolved rows, both stored once, with the columns that the checks need."""
    t = Tables(spark, root)
    staged = materialize(_trimmed(_report(t)).select(*_PK, "document", "insurer_nk", "quantity"), "report")
    references = _plain_references(t)
    resolved = materialize(resolve_keys(staged, references).select(*_PK, "quantity", *_IDS), "resolved")
    valid, _ = split_facts(resolved, references, _PK, F.col("quantity"))
    dates = all_dates(t)
    return q.dq_report(
        [
            q.check_no_demo(t.customer, "c_name", "customer"),
            q.check_row_counts(staged, valid, "fact_equipment"),
            q.check_foreign_keys(resolved, list(_IDS), "stg_report"),
            q.check_references(staged, equipment(t), "equipment_nk", "equipment_nk", "stg_report"),
            q.check_unique(valid, "request_id", "fact_equipment"),
            q.check_dates(dates, "1995-06-01", "2030-12-31", "dim_date"),
            q.check_history(history_check(equipment(t), "equipment_nk"), "dim_equipment"),
            q.check_measure(staged, valid, F.col("quantity"), F.col("quantity"), "fact_equipment"),
        ]
    )


QUERIES = {
    "fact_equipment_load": fact_equipment_load,
    "fact_equipment_valid": fact_equipment_valid,
    "fact_services_upsert": fact_services_upsert,
    "fk_rejects": fk_rejects,
    "orphans_fact": orphans_fact,
    "orphans_staging": orphans_staging,
    "dedupe_keep_last": dedupe_lines,
    "duplicate_keys": duplicate_keys,
    "table_counts": table_counts,
    "load_monitor": load_monitor,
    "null_profile": null_profile,
    "dq_report": dq_report,
}

_RESOLVED = (
    "dim_equipment", "dim_patient", "dim_insurer", "first_dates", "report",
    ("resolved", """
        SELECT r.* REPLACE (trim(r.equipment_nk) AS equipment_nk), equipment_id, patient_id, insurer_id, date_id
        FROM report r LEFT JOIN dim_equipment e ON e.equipment_nk = trim(r.equipment_nk) AND e.is_current
        LEFT JOIN dim_patient p ON p.document = r.document LEFT JOIN dim_insurer i ON i.insurer_nk = r.insurer_nk
        LEFT JOIN first_dates f ON f.date = r.delivered"""),
    ("valid", """
        SELECT concat_ws('-', equipment_nk, serial, delivered) AS request_id, equipment_id, patient_id, insurer_id,
               date_id, quantity, l_orderkey, l_suppkey, document, o_orderstatus FROM resolved
        WHERE equipment_id IS NOT NULL AND patient_id IS NOT NULL AND insurer_id IS NOT NULL AND date_id IS NOT NULL"""),
)

_LATEST = "QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY l_orderkey DESC, l_suppkey DESC, document DESC) = 1"


def _added(name: str, dim: str, key: str, id_col: str, source: str) -> tuple[str, str]:
    """CTE of keys and ids of a dimension with the members that `column relation` mentions."""
    column, relation = source.split()
    return (
        name,
        f"""SELECT {key}, {id_col} FROM {dim} UNION ALL
            SELECT {key}, (SELECT max({id_col}) FROM {dim}) + {sql_rank(f"CAST({key} AS VARCHAR)", key)}
            FROM (SELECT DISTINCT {column} AS {key} FROM {relation}
                  WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {dim}))""",
    )


def _fact_upsert_sql(rows: str, ids: list[str]) -> tuple:
    """CTE `facts`: relation `before` after the one-row-per-key relation `rows`."""
    attrs = [*ids, "quantity"]
    values = ", ".join(f"CASE WHEN n.request_id IS NULL THEN o.{c} ELSE n.{c} END AS {c}" for c in attrs)
    differs = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in attrs)
    return (
        ("facts", f"""
            SELECT coalesce(n.request_id, o.request_id) AS request_id, {values},
                   CASE WHEN n.request_id IS NULL THEN '{OLD_STAMP}' ELSE '{NEW_STAMP}' END AS loaded_at,
                   CASE WHEN o.request_id IS NULL THEN 'inserted' WHEN n.request_id IS NULL THEN 'kept'
                        WHEN {differs} THEN 'updated' ELSE 'matched' END AS change_type
            FROM before o FULL JOIN {rows} n ON o.request_id = n.request_id"""),
    )


_SERVICE_IDS = ["order_id", "patient_id", "insurer_id", "date_id"]
_EQUIPMENT_IDS = list(_IDS)

SQL = {
    "fact_equipment_load": with_ctes(
        *_RESOLVED,
        ("before", f"SELECT * REPLACE (0.0 AS quantity) FROM valid WHERE o_orderstatus = 'F' {_LATEST}"),
        _added("all_patients", "dim_patient", "document", "patient_id", "document report"),
        _added("all_insurers", "dim_insurer", "insurer_nk", "insurer_id", "insurer_nk report"),
        _added("all_dates", "first_dates", "date", "date_id", "delivered report"),
        ("now", f"""
            SELECT concat_ws('-', trim(r.equipment_nk), serial, delivered) AS request_id, equipment_id, patient_id,
                   insurer_id, date_id, quantity
            FROM report r JOIN dim_equipment e ON e.equipment_nk = trim(r.equipment_nk) AND e.is_current
            JOIN all_patients p ON p.document = r.document JOIN all_insurers i ON i.insurer_nk = r.insurer_nk
            JOIN all_dates d ON d.date = r.delivered
            QUALIFY row_number() OVER (PARTITION BY concat_ws('-', trim(r.equipment_nk), serial, delivered)
                    ORDER BY l_orderkey DESC, l_suppkey DESC, r.document DESC) = 1"""),
        *_fact_upsert_sql("now", _EQUIPMENT_IDS), select="SELECT * FROM facts",
    ),
    "fact_equipment_valid": with_ctes(
        *_RESOLVED, select="SELECT * EXCLUDE (document, o_orderstatus) FROM valid"
    ),
    "fact_services_upsert": with_ctes(
        "dim_patient", "dim_insurer", "first_dates", "services",
        ("staged", "SELECT *, order_number || '-' || sent AS request_id FROM services"),
        ("before", """SELECT DISTINCT request_id, 0 AS order_id, 0 AS patient_id, 0 AS insurer_id, 0 AS date_id,
                      1.0::DOUBLE AS quantity FROM staged WHERE event_type = 'click'"""),
        ("known", "SELECT order_number, min(event_id) AS order_id FROM staged WHERE event_type <> 'error' GROUP BY 1"),
        ("all_orders", f"""SELECT order_number, order_id FROM known UNION ALL
            SELECT order_number, (SELECT max(order_id) FROM known) + {sql_rank("upper(order_number)", "upper(order_number)")}
            FROM (SELECT DISTINCT order_number FROM staged WHERE order_number NOT IN (SELECT order_number FROM known))"""),
        _added("all_insurers", "dim_insurer", "insurer_nk", "insurer_id", "insurer_nk staged"),
        _added("all_dates", "first_dates", "date", "date_id", "sent staged"),
        ("now", """
            SELECT request_id, order_id, patient_id, insurer_id, date_id, 1.0::DOUBLE AS quantity
            FROM staged s JOIN all_orders o ON o.order_number = s.order_number
            JOIN dim_patient p ON p.document = s.document JOIN all_insurers i ON i.insurer_nk = s.insurer_nk
            JOIN all_dates d ON d.date = s.sent
            QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY event_id DESC) = 1"""),
        *_fact_upsert_sql("now", _SERVICE_IDS), select="SELECT * FROM facts",
    ),
    "fk_rejects": with_ctes(
        *_RESOLVED,
        select="""SELECT *, rejected / n_rows AS rejected_share, rejected / n_rows > 0.05 AS alert FROM (
                  SELECT count(*) AS n_rows, (SELECT count(*) FROM valid) AS valid,
                  count(*) - (SELECT count(*) FROM valid) AS rejected,
                  count(*) FILTER (WHERE equipment_id IS NULL) AS no_equipment,
                  count(*) FILTER (WHERE patient_id IS NULL) AS no_patient,
                  count(*) FILTER (WHERE insurer_id IS NULL) AS no_insurer,
                  count(*) FILTER (WHERE date_id IS NULL) AS no_date FROM resolved)""",
    ),
    "orphans_fact": with_ctes(
        *_RESOLVED,
        select="""SELECT count(*) AS orphans FROM resolved
                  WHERE equipment_id IS NULL OR patient_id IS NULL OR insurer_id IS NULL""",
    ),
    "orphans_staging": with_ctes(
        "dim_equipment", "report",
        select="""SELECT trim(equipment_nk) AS key, count(*) AS n FROM report
                  WHERE trim(equipment_nk) NOT IN (SELECT equipment_nk FROM dim_equipment) GROUP BY 1""",
    ),
    "dedupe_keep_last": """
        SELECT * REPLACE (CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate) FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""",
    "duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "table_counts": with_ctes(
        "dim_equipment", "dim_patient", "dim_insurer",
        select="""SELECT 'dim_equipment' AS "table", count(*) AS n FROM dim_equipment WHERE is_current
                  UNION ALL SELECT 'dim_patient', count(*) FROM dim_patient WHERE is_current
                  UNION ALL SELECT 'dim_insurer', count(*) FROM dim_insurer WHERE is_current
                  UNION ALL SELECT 'dim_order', count(*) FROM orders
                  UNION ALL SELECT 'stg_report', count(*) FROM lineitem
                  UNION ALL SELECT 'stg_services', count(*) FROM events""",
    ),
    "load_monitor": """
        SELECT 'fact_equipment' AS "table", strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') AS last_load, count(*) AS n FROM lineitem
        UNION ALL SELECT 'fact_service', strftime(max(ts), '%Y-%m-%d %H:%M:%S'), count(*) FROM events
        UNION ALL SELECT 'fact_order', strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S'), count(*) FROM orders""",
    "null_profile": with_ctes(
        *_RESOLVED,
        select=" UNION ALL ".join(
            f"""SELECT 'stg_report' AS "table", '{c}' AS "column",
                count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(*) AS n FROM resolved"""
            for c in ("equipment_nk", "serial", "document", "patient", "insurer_nk", "delivered", "quantity", *_IDS)
        ),
    ),
    "dq_report": with_ctes(
        *_RESOLVED, *_ALL_DATES[1:],
        ("counts", """
            SELECT 'no_demo' AS "check", 'customer' AS "table",
                   (SELECT count(*) FROM customer WHERE contains(upper(c_name), 'DEMO')) AS failures
            UNION ALL SELECT 'row_counts', 'fact_equipment', (SELECT count(*) FROM report) - (SELECT count(*) FROM valid)
            UNION ALL SELECT 'foreign_keys', 'stg_report', (SELECT count(*) FROM resolved WHERE equipment_id IS NULL
                      OR patient_id IS NULL OR insurer_id IS NULL OR date_id IS NULL)
            UNION ALL SELECT 'references', 'stg_report', (SELECT count(*) FROM report
                      WHERE trim(equipment_nk) NOT IN (SELECT equipment_nk FROM dim_equipment))
            UNION ALL SELECT 'unique_key', 'fact_equipment', (SELECT count(*) FROM
                      (SELECT request_id FROM valid GROUP BY 1 HAVING count(*) > 1))
            UNION ALL SELECT 'valid_dates', 'dim_date', (SELECT count(*) FROM all_dates
                      WHERE date NOT BETWEEN DATE '1995-06-01' AND DATE '2030-12-31')
            UNION ALL SELECT 'history', 'dim_equipment', (SELECT count(*) FROM dim_equipment WHERE NOT is_current)
            UNION ALL SELECT 'measure', 'fact_equipment',
                      CASE WHEN (SELECT sum(quantity) FROM report) <> (SELECT sum(quantity) FROM valid) THEN 1 ELSE 0 END"""),
        select='SELECT *, failures = 0 AS passed FROM counts',
    ),
}
