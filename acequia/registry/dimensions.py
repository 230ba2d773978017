"""Dimension maintenance on the shared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acequia.functions.text import clean_code, to_text, truncate
from acequia.functions.values import to_number
from acequia.operators.history import as_of, history_check, scd2, version_changes
from acequia.operators.keys import assign_ids
from acequia.operators.members import add_missing_members
from acequia.operators.upsert import change_counts, delta, upsert
from acequia.plans.loading import dimension_rejects
from acequia.registry.scenario import (
    LOAD_DATE, Tables, equipment, insurers, iso, patients, sql_rank, text, with_ctes,
)

# -- type 1 ------------------------------------------------------------------------


def dim_insurer_upsert(spark, root):
    """Each supplier reports the insurer of its nation; the last one names it."""
    t = Tables(spark, root)
    batch = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        text("n_nationkey").alias("insurer_nk"), F.concat_ws(" / ", "n_name", "s_name").alias("insurer"), "s_suppkey"
    )
    out = upsert(insurers(t), batch, "insurer_nk", ["insurer"], "s_suppkey", LOAD_DATE, "insurer_id")
    return iso(out, "valid_from", "valid_to")


def _patient_batch(t: Tables) -> DataFrame:
    """Each order brings the state of its patient."""
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        text("o_custkey").alias("document"), F.upper("c_name").alias("name"),
        F.col("o_orderpriority").alias("city"), F.col("o_orderstatus").alias("state"),
        F.col("c_mktsegment").alias("zone"), "o_orderkey",
    )


_PATIENT_ATTRS = ["name", "city", "state", "zone"]


def _patients_loaded(t: Tables) -> DataFrame:
    return upsert(patients(t), _patient_batch(t), "document", _PATIENT_ATTRS, "o_orderkey", LOAD_DATE, "patient_id")


def dim_patient_upsert(spark, root):
    return iso(_patients_loaded(Tables(spark, root)), "valid_from", "valid_to")


def upsert_counts(spark, root):
    """Changes of the patient load, by kind."""
    return change_counts(_patients_loaded(Tables(spark, root)))


def dim_order_upsert(spark, root):
    t = Tables(spark, root)
    known = t.orders.filter("o_orderstatus = 'F'").select(
        (F.col("o_orderkey") + 1).alias("order_id"), F.concat(F.lit("P"), text("o_orderkey")).alias("order_number"),
        F.col("o_orderpriority").alias("item"), F.lit(9.0).alias("quantity"),
    )
    dirty = F.when(F.col("l_returnflag") == "R", F.lit("x")).otherwise(F.concat(F.lit(" "), text("l_quantity"), F.lit(" ")))
    batch = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        to_text(F.concat(F.lit(" P"), text("l_orderkey"), F.lit(" "))).alias("order_number"),
        truncate(to_text(F.concat(F.lit("  "), F.repeat(F.concat_ws(" ", "p_name", "p_type"), 30))), 255).alias("item"),
        to_number(dirty).alias("quantity"), "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
    )
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    return upsert(known, batch, "order_number", ["item", "quantity"], order, id_col="order_id")


def dim_drug_upsert(spark, root):
    """Keyed by code alone, without surrogate id or validity."""
    t = Tables(spark, root)
    drugs = t.part.select(
        clean_code(F.concat(F.lit("M"), text("p_partkey"), F.lit(".0"))).alias("code"), "p_partkey",
        truncate(to_text(F.concat(F.lit(" "), F.col("p_name"))), 255).alias("name"),
        truncate(F.repeat("p_type", 20), 100).alias("form"), F.col("p_brand").alias("route"), "p_size",
    )
    known = drugs.filter("p_size <= 25").select(
        "code", "name", F.when(F.col("p_size") > 5, F.col("form")).alias("form"), "route"
    )
    out = upsert(known, drugs, "code", ["name", "form", "route"], "p_partkey")
    return out


# -- type 2 ------------------------------------------------------------------------


def _equipment_batch(t: Tables) -> DataFrame:
    """Two reports per part: changes in case, spaces and name, then small parts retire."""
    name = (
        F.when(F.col("p_brand") == "Brand#1", F.upper("p_name"))
        .when(F.col("p_type") == "ECONOMY", F.concat(F.col("p_name"), F.lit("+")))
        .otherwise(F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")))
    )
    first = t.part.select(text("p_partkey").alias("equipment_nk"), name.alias("equipment"), F.col("p_type").alias("state"), F.col("p_partkey").alias("seq"))
    second = t.part.filter("p_type = 'SMALL'").select(
        text("p_partkey").alias("equipment_nk"), F.col("p_name").alias("equipment"), F.lit("INACTIVO").alias("state"),
        (F.col("p_partkey") + 1_000_000_000).alias("seq"),
    )
    return first.unionByName(second)


def _equipment_loaded(t: Tables) -> DataFrame:
    return scd2(equipment(t), _equipment_batch(t), "equipment_nk", ["equipment", "state"], "seq", LOAD_DATE, "equipment_id")


def dim_equipment_scd2(spark, root):
    return iso(_equipment_loaded(Tables(spark, root)), "valid_from", "valid_to")


def scd2_changes(spark, root):
    """Versions that the equipment load opened, closed and kept."""
    t = Tables(spark, root)
    return version_changes(equipment(t), _equipment_loaded(t), "equipment_id")


def _patients_versioned(t: Tables) -> DataFrame:
    return scd2(patients(t), _patient_batch(t), "document", ["city", "state"], "o_orderkey", LOAD_DATE, "patient_id")


def dim_patient_scd2(spark, root):
    return iso(_patients_versioned(Tables(spark, root)), "valid_from", "valid_to")


def scd2_check(spark, root):
    return history_check(_patients_versioned(Tables(spark, root)), "document")


def scd2_as_of(spark, root):
    """Version of the equipment on the day each line was shipped."""
    t = Tables(spark, root)
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text("l_partkey").alias("equipment_nk"),
        F.col("l_shipdate").cast("date").alias("shipped"),
    )
    found = as_of(lines, _equipment_loaded(t), "equipment_nk", "shipped", "equipment_id")
    return iso(found.withColumn("equipment_id", F.coalesce("equipment_id", F.lit(-1))), "shipped").drop("equipment_nk")


# -- keys, members, deltas ---------------------------------------------------------


def surrogate_keys(spark, root):
    """Dense ids for the distinct pairs of user and event type, continuing after 1000."""
    members = Tables(spark, root).events.select("user_id", "event_type").distinct()
    return assign_ids(members, "member_id", ["user_id", "event_type"], 1000)


def dim_inferred_members(spark, root):
    """Patients known only from their orders."""
    t = Tables(spark, root)
    seen = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit(" "), text("o_custkey")).alias("doc"), "c_name"
    )
    out = add_missing_members(
        patients(t).drop("city", "state"), seen, "document", "doc",
        {"name": F.min("c_name"), "zone": F.lit("No Aplica")}, "patient_id", LOAD_DATE,
    )
    return iso(out, "valid_from", "valid_to")


def incremental_delta(spark, root):
    """Orders' view of a patient that the dimension does not hold yet."""
    t = Tables(spark, root)
    return delta(patients(t), _patient_batch(t), "document", ["city", "state", "zone"])


def broken_history(t: Tables):
    """Versions of the parts: large ones overlap, those of type PROMO have two current versions."""
    def version(since, until, current):
        return F.struct(since.cast("date").alias("valid_from"), F.lit(until).cast("date").alias("valid_to"), F.lit(current).alias("is_current"))

    start = F.when(F.col("p_size") > 25, "1996-06-01").otherwise("1997-01-01")
    both = F.array(version(F.lit("1995-06-01"), "1997-01-01", False), version(start, "9999-12-31", True))
    more = F.array(version(F.lit("1998-01-01"), "9999-12-31", True))
    found = F.when(F.col("p_type") == "PROMO", F.concat(both, more)).otherwise(both)
    return t.part.select(F.col("p_partkey").cast("string").alias("equipment_nk"), F.explode(found).alias("v")).select("equipment_nk", "v.*")


def history_breaks(spark, root):
    return history_check(broken_history(Tables(spark, root)), "equipment_nk")


def dim_rejects(spark, root):
    """Master rows without natural key, by table and reason."""
    t = Tables(spark, root)
    nothing = F.lit(None).cast("string")
    staged = {
        "insurers": t.nation.select(F.when(F.col("n_regionkey") != 4, text("n_nationkey")).alias("insurer_nk"), F.col("n_name").alias("insurer"), "n_nationkey"),
        "patients": t.customer.select(F.when(F.col("c_acctbal") < 0, "  ").otherwise(text("c_custkey")).alias("document"), nothing.alias("admitted"), "c_custkey"),
        "equipment": t.part.select(F.when(F.col("p_size") != 13, F.concat(text("p_partkey"), F.lit(".0"))).otherwise(".0").alias("equipment_nk"), "p_partkey"),
        "orders": t.orders.select(F.when(F.col("o_orderpriority") != "5-LOW", text("o_orderkey")).alias("order_number"), nothing.alias("item"), nothing.alias("quantity"), "o_orderkey"),
        "drugs": t.supplier.select(F.when(F.col("s_acctbal") >= 0, text("s_suppkey")).otherwise("").alias("code"), *[nothing.alias(c) for c in ("name", "form", "route")], "s_suppkey"),
    }
    staged = {name: df.select(*df.columns[:-1], F.col(df.columns[-1]).alias("seq")) for name, df in staged.items()}
    return dimension_rejects(staged).select("table", "seq", "reason")


QUERIES = {
    "dim_insurer_upsert": dim_insurer_upsert,
    "dim_patient_upsert": dim_patient_upsert,
    "upsert_counts": upsert_counts,
    "dim_order_upsert": dim_order_upsert,
    "dim_drug_upsert": dim_drug_upsert,
    "dim_equipment_scd2": dim_equipment_scd2,
    "scd2_changes": scd2_changes,
    "dim_patient_scd2": dim_patient_scd2,
    "scd2_check": scd2_check,
    "scd2_as_of": scd2_as_of,
    "surrogate_keys": surrogate_keys,
    "dim_inferred_members": dim_inferred_members,
    "incremental_delta": incremental_delta,
    "history_breaks": history_breaks,
    "dim_rejects": dim_rejects,
}


def _upsert_sql(dim: str, key: str, attrs: list[str], id_col: str | None, validity: bool) -> tuple:
    """CTE `loaded`: `dim` after the one-row-per-key relation `last`."""
    new = {key: f"l.{key}", **{a: f"l.{a}" for a in attrs}}
    if id_col:
        rank = f"row_number() OVER (ORDER BY substr(md5(l.{key}), 1, 3), l.{key})"
        new[id_col] = f"(SELECT max({id_col}) FROM {dim}) + {rank}"
    if validity:
        new |= {"valid_from": f"DATE '{LOAD_DATE}'", "valid_to": "DATE '9999-12-31'", "is_current": "TRUE"}
    old = {c: f"CASE WHEN l.{key} IS NULL THEN d.{c} ELSE l.{c} END" if c in attrs else f"d.{c}" for c in new}
    differs = " OR ".join(f"d.{a} IS DISTINCT FROM l.{a}" for a in attrs)
    known = ", ".join(f"{v} AS {c}" for c, v in old.items())
    added = ", ".join(f"{v} AS {c}" for c, v in new.items())
    return (
        ("loaded", f"""
            SELECT {known}, CASE WHEN l.{key} IS NULL THEN 'kept' WHEN {differs} THEN 'updated' ELSE 'matched' END AS change_type
            FROM {dim} d LEFT JOIN last l USING ({key})
            UNION ALL BY NAME
            SELECT {added}, 'inserted' AS change_type FROM last l
            WHERE l.{key} NOT IN (SELECT {key} FROM {dim})"""),
    )


_DATES = "* REPLACE (CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to)"

_PATIENT_BATCH = ("batch", """
    SELECT CAST(o_custkey AS VARCHAR) AS document, upper(c_name) AS name, o_orderpriority AS city,
           o_orderstatus AS state, c_mktsegment AS zone, o_orderkey AS seq
    FROM orders JOIN customer ON o_custkey = c_custkey""")
_PATIENTS_LOADED = (
    "dim_patient", _PATIENT_BATCH,
    ("last", "SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY document ORDER BY seq DESC) = 1"),
    *_upsert_sql("dim_patient", "document", _PATIENT_ATTRS, "patient_id", True),
)


def _scd2_sql(dim: str, key: str, tracked: list[str], id_col: str) -> tuple:
    """CTE `versioned`: `dim` after the relation `batch` with its order in `seq`."""
    same = " AND ".join(f"upper(trim({c})) = upper(trim(lag({c}) OVER w))" for c in tracked)
    cols = ", ".join([key, *tracked])
    trimmed = ", ".join(f"trim({c}) AS {c}" for c in [key, *tracked])
    return (
        ("folded", f"""
            SELECT {id_col}, {cols}, valid_from, valid_to, -1 AS seq FROM {dim} WHERE is_current
            UNION ALL
            SELECT NULL, {cols}, DATE '{LOAD_DATE}', DATE '9999-12-31', min(seq)
            FROM (SELECT {trimmed}, seq FROM batch) GROUP BY ALL"""),
        ("opened", f"SELECT * FROM folded WINDOW w AS (PARTITION BY {key} ORDER BY seq) QUALIFY NOT coalesce({same}, FALSE)"),
        ("closed", f"SELECT *, lead(seq) OVER (PARTITION BY {key} ORDER BY seq) IS NOT NULL AS followed FROM opened"),
        ("versioned", f"""
            SELECT {id_col}, {cols}, valid_from, valid_to, is_current FROM {dim} WHERE NOT is_current
            UNION ALL
            SELECT {id_col}, {cols}, valid_from, CASE WHEN followed THEN DATE '{LOAD_DATE}' ELSE valid_to END, NOT followed
            FROM closed WHERE seq < 0
            UNION ALL
            SELECT (SELECT max({id_col}) FROM {dim}) + {sql_rank(f"{key} || '-' || seq", f"{key}, seq")}, {cols},
                   valid_from, CASE WHEN followed THEN DATE '{LOAD_DATE}' ELSE valid_to END, NOT followed
            FROM closed WHERE seq >= 0"""),
    )


_EQUIPMENT_BATCH = ("batch", """
    SELECT CAST(p_partkey AS VARCHAR) AS equipment_nk,
           CASE WHEN p_brand = 'Brand#1' THEN upper(p_name) WHEN p_type = 'ECONOMY' THEN p_name || '+'
                ELSE '  ' || p_name || ' ' END AS equipment, p_type AS state, p_partkey AS seq FROM part
    UNION ALL
    SELECT CAST(p_partkey AS VARCHAR), p_name, 'INACTIVO', p_partkey + 1000000000 FROM part WHERE p_type = 'SMALL'""")
_EQUIPMENT_LOADED = ("dim_equipment", _EQUIPMENT_BATCH, *_scd2_sql("dim_equipment", "equipment_nk", ["equipment", "state"], "equipment_id"))
_PATIENTS_VERSIONED = ("dim_patient", _PATIENT_BATCH, *_scd2_sql("dim_patient", "document", ["city", "state"], "patient_id"))

SQL = {
    "dim_insurer_upsert": with_ctes(
        "dim_insurer",
        ("last", """SELECT CAST(n_nationkey AS VARCHAR) AS insurer_nk, n_name || ' / ' || s_name AS insurer
                    FROM supplier JOIN nation ON s_nationkey = n_nationkey
                    QUALIFY row_number() OVER (PARTITION BY n_nationkey ORDER BY s_suppkey DESC) = 1"""),
        *_upsert_sql("dim_insurer", "insurer_nk", ["insurer"], "insurer_id", True),
        select=f"SELECT {_DATES} FROM loaded",
    ),
    "dim_patient_upsert": with_ctes(*_PATIENTS_LOADED, select=f"SELECT {_DATES} FROM loaded"),
    "upsert_counts": with_ctes(*_PATIENTS_LOADED, select="SELECT change_type, count(*) AS n FROM loaded GROUP BY 1"),
    "dim_order_upsert": with_ctes(
        ("known", """SELECT o_orderkey + 1 AS order_id, 'P' || o_orderkey AS order_number, o_orderpriority AS item,
                     9.0::DOUBLE AS quantity FROM orders WHERE o_orderstatus = 'F'"""),
        ("last", """SELECT 'P' || l_orderkey AS order_number, substr(repeat(p_name || ' ' || p_type, 30), 1, 255) AS item,
                    CASE WHEN l_returnflag = 'R' THEN 0.0 ELSE l_quantity END AS quantity
                    FROM lineitem JOIN part ON l_partkey = p_partkey
                    QUALIFY row_number() OVER (PARTITION BY l_orderkey
                            ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_shipdate DESC) = 1"""),
        *_upsert_sql("known", "order_number", ["item", "quantity"], "order_id", False),
        select="SELECT * FROM loaded",
    ),
    "dim_drug_upsert": with_ctes(
        ("last", """SELECT 'M' || p_partkey AS code, p_name AS name, substr(repeat(p_type, 20), 1, 100) AS form,
                    p_brand AS route, p_size FROM part"""),
        ("known", """SELECT code, name, CASE WHEN p_size > 5 THEN form END AS form, route FROM last WHERE p_size <= 25"""),
        *_upsert_sql("known", "code", ["name", "form", "route"], None, False),
        select="SELECT * FROM loaded",
    ),
    "dim_equipment_scd2": with_ctes(*_EQUIPMENT_LOADED, select=f"SELECT {_DATES} FROM versioned"),
    "scd2_changes": with_ctes(
        *_EQUIPMENT_LOADED,
        select="""SELECT CASE WHEN d.equipment_id IS NULL THEN 'opened'
                         WHEN d.is_current AND NOT v.is_current THEN 'closed' ELSE 'kept' END AS change_type,
                  count(*) AS n FROM versioned v LEFT JOIN dim_equipment d USING (equipment_id) GROUP BY 1""",
    ),
    "dim_patient_scd2": with_ctes(*_PATIENTS_VERSIONED, select=f"SELECT {_DATES} FROM versioned"),
    "scd2_check": with_ctes(
        *_PATIENTS_VERSIONED,
        select="""SELECT *, current_versions = 1 AND "overlaps" = 0 AS sane FROM (
                  SELECT document, count(*) AS versions, count(*) FILTER (WHERE is_current) AS current_versions,
                         count(*) FILTER (WHERE overlapped) AS "overlaps"
                  FROM (SELECT *, lead(valid_from) OVER (PARTITION BY document ORDER BY valid_from, valid_to) < valid_to AS overlapped
                        FROM versioned) GROUP BY document)""",
    ),
    "scd2_as_of": with_ctes(
        *_EQUIPMENT_LOADED,
        select="""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipped,
                  coalesce(equipment_id, -1) AS equipment_id
                  FROM lineitem LEFT JOIN versioned ON equipment_nk = CAST(l_partkey AS VARCHAR)
                       AND l_shipdate >= valid_from AND l_shipdate < valid_to""",
    ),
    "surrogate_keys": f"""
        SELECT user_id, event_type, 1000 + {sql_rank("user_id || '-' || event_type", "user_id, event_type")} AS member_id
        FROM (SELECT DISTINCT user_id, event_type FROM events)""",
    "dim_inferred_members": with_ctes(
        "dim_patient",
        ("missing", """SELECT CAST(o_custkey AS VARCHAR) AS document, min(c_name) AS name
                       FROM orders JOIN customer ON o_custkey = c_custkey
                       WHERE CAST(o_custkey AS VARCHAR) NOT IN (SELECT document FROM dim_patient) GROUP BY 1"""),
        ("extended", f"""SELECT patient_id, document, name, zone, valid_from, valid_to, is_current FROM dim_patient
                         UNION ALL
                         SELECT (SELECT max(patient_id) FROM dim_patient) + {sql_rank("document", "document")},
                                document, name, 'No Aplica', DATE '{LOAD_DATE}', DATE '9999-12-31', TRUE FROM missing"""),
        select=f"SELECT {_DATES} FROM extended",
    ),
    "incremental_delta": with_ctes(
        "dim_patient", _PATIENT_BATCH,
        select="""SELECT document, name, city, state, zone, seq AS o_orderkey FROM batch b
                  WHERE NOT EXISTS (SELECT 1 FROM dim_patient d WHERE d.document = b.document
                        AND d.city = b.city AND d.state = b.state AND d.zone = b.zone)""",
    ),
    "history_breaks": """
        WITH versions AS (
          SELECT CAST(p_partkey AS VARCHAR) AS equipment_nk, DATE '1995-06-01' AS valid_from, DATE '1997-01-01' AS valid_to, FALSE AS is_current FROM part
          UNION ALL SELECT CAST(p_partkey AS VARCHAR), CASE WHEN p_size > 25 THEN DATE '1996-06-01' ELSE DATE '1997-01-01' END, DATE '9999-12-31', TRUE FROM part
          UNION ALL SELECT CAST(p_partkey AS VARCHAR), DATE '1998-01-01', DATE '9999-12-31', TRUE FROM part WHERE p_type = 'PROMO'),
        chained AS (SELECT *, lag(valid_to) OVER (PARTITION BY equipment_nk ORDER BY valid_from, valid_to) AS before FROM versions),
        counted AS (
          SELECT equipment_nk, count(*) AS versions, count(*) FILTER (WHERE is_current) AS current_versions,
                 count(*) FILTER (WHERE before > valid_from) AS "overlaps" FROM chained GROUP BY equipment_nk)
        SELECT *, current_versions = 1 AND "overlaps" = 0 AS sane FROM counted""",
    "dim_rejects": """
        SELECT 'dim_insurer' AS "table", CAST(n_nationkey AS BIGINT) AS seq, 'no insurer_nk' AS reason FROM nation WHERE n_regionkey = 4
        UNION ALL SELECT 'dim_patient', c_custkey, 'no document' FROM customer WHERE c_acctbal < 0
        UNION ALL SELECT 'dim_equipment', p_partkey, 'no equipment_nk' FROM part WHERE p_size = 13
        UNION ALL SELECT 'dim_order', o_orderkey, 'no order_number' FROM orders WHERE o_orderpriority = '5-LOW'
        UNION ALL SELECT 'dim_drug', s_suppkey, 'no code' FROM supplier WHERE s_acctbal < 0""",
}
