"""Cleaning and scalar functions on the shared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acequia.functions.text import DROPPED_UNITS, GLUED_UNITS, PLURAL_UNITS, STOP_WORDS, normalize_text
from acequia.functions.values import NULL_LITERALS, checked_date, checked_number, to_number
from acequia.operators.cleaning import NOT_APPLICABLE, clean_whitespace, drop_demo, nulls_from_text, recode
from acequia.operators.quality import cast_rejects, cleaning_summary as summarise, reject_counts
from acequia.registry.scenario import Tables, text, with_ctes


def _documents_with_demo(t: Tables) -> DataFrame:
    demo = (F.col("c_mktsegment") == "MACHINERY") & (F.col("c_acctbal") < 2000)
    missing = (F.col("c_mktsegment") == "HOUSEHOLD") & (F.col("c_acctbal") < 1000)
    return t.customer.select(
        "c_custkey", "c_nationkey",
        F.when(demo, F.concat(F.lit("xDemo-"), text("c_custkey")))
        .when(~missing, F.col("c_name")).alias("document"),
    )


_DOCUMENTS_SQL = """
    SELECT c_custkey, c_nationkey,
           CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 2000 THEN 'xDemo-' || c_custkey
                WHEN NOT (c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 1000) THEN c_name END AS document
    FROM customer"""


def demo_filter(spark, root):
    kept = drop_demo(_documents_with_demo(Tables(spark, root)), "document")
    return kept.select("c_custkey", F.coalesce("document", F.lit("(null)")).alias("document"))


def null_literals(spark, root):
    label = F.col("o_orderpriority")
    dirty = (
        F.when(label == "1-URGENT", F.lit("")).when(label == "4-NOT SPECIFIED", F.lit("n/a"))
        .when(label == "5-LOW", F.lit("NULL")).otherwise(label)
    )
    clean = nulls_from_text(Tables(spark, root).orders.select("o_orderkey", "o_orderstatus", dirty.alias("label")))
    return clean.withColumn("label", F.coalesce("label", F.lit("(null)")))


def numeric_coerce(spark, root):
    balance, segment = text("c_acctbal"), F.col("c_mktsegment")
    dirty = (
        F.when(segment == "BUILDING", F.concat(F.lit("  "), balance, F.lit(" ")))
        .when(segment == "MACHINERY", F.concat(F.lit("x"), balance))
        .when(segment == "FURNITURE", F.concat(balance, F.lit("d")))
        .when(segment == "AUTOMOBILE", F.concat(balance, F.lit("e2")))
    )
    return Tables(spark, root).customer.select("c_custkey", to_number(dirty).alias("number"))


def whitespace_clean(spark, root):
    t = Tables(spark, root)
    raw = t.customer.select(
        "c_custkey", F.concat(F.lit("  \t"), "c_name", F.lit("   \n "), "c_mktsegment", F.lit(" ")).alias("name"),
        F.concat("c_mktsegment", F.lit("\t\t"), text("c_nationkey")).alias("zone"),
    )
    return clean_whitespace(raw)


def text_normalize(spark, root):
    return Tables(spark, root).documents.select("doc_id", normalize_text(F.col("text")).alias("name"))


def _sql_normalize(c: str) -> str:
    steps = [
        (rf"\b({'|'.join(PLURAL_UNITS)})S\b", r"\1"),
        (rf"\b({'|'.join(DROPPED_UNITS)})\b", ""),
        (rf"\b(\d+)\s*({'|'.join(GLUED_UNITS)})\b", r"\1\2"),
        (rf"\b({'|'.join(STOP_WORDS)})\b", ""),
        ("[^A-Z0-9]+", " "),
    ]
    sql = f"strip_accents(upper(replace(coalesce({c}, ''), 'ß', 'SS')))"
    for pattern, new in steps:
        sql = f"regexp_replace({sql}, '{pattern}', '{new}', 'g')"
    return f"trim({sql})"


def _insurer_catalogue(t: Tables) -> DataFrame:
    """No entry for region 4, no code for region 3, two codes for region 0."""
    region, name = F.col("n_regionkey"), F.col("n_name")
    once = t.nation.filter(region != 4).select(
        F.concat(name, F.lit(" ")).alias("insurer"), F.when(region != 3, text("n_nationkey")).alias("code")
    )
    twice = t.nation.filter(region == 0).select(
        name.alias("insurer"), F.concat(F.lit("X"), text("n_nationkey")).alias("code")
    )
    return once.unionByName(twice)


_CATALOGUE_SQL = """
    SELECT n_name AS insurer, CASE WHEN n_regionkey <> 3 THEN CAST(n_nationkey AS VARCHAR) END AS code
    FROM nation WHERE n_regionkey <> 4
    UNION ALL SELECT n_name, 'X' || n_nationkey FROM nation WHERE n_regionkey = 0"""


def _report(t: Tables) -> DataFrame:
    return _documents_with_demo(t).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "document", F.concat(F.lit(" "), "n_name", F.lit(" ")).alias("insurer")
    )


_REPORT_SQL = """
    SELECT c_custkey, document, n_name AS insurer
    FROM documents_with_demo JOIN nation ON c_nationkey = n_nationkey"""

_RECODED_SQL = f"""
    SELECT c_custkey, coalesce(code, '{NOT_APPLICABLE}') AS insurer
    FROM report r LEFT JOIN catalogue c ON r.insurer = c.insurer
    WHERE NOT coalesce(contains(upper(document), 'DEMO'), FALSE)"""


def _recoded(t: Tables) -> DataFrame:
    return recode(drop_demo(_report(t), "document"), "insurer", _insurer_catalogue(t), "insurer", "code")


def insurer_recode(spark, root):
    return _recoded(Tables(spark, root)).select("c_custkey", "insurer")


def cleaning_summary(spark, root):
    t = Tables(spark, root)
    return summarise(_report(t), _recoded(t), "document", "insurer", NOT_APPLICABLE)


def _typed(t: Tables) -> DataFrame:
    """Order lines with quantities and dates as people type them, some unreadable."""
    number, day, line = F.col("l_quantity").cast("string"), F.col("l_shipdate").cast("date"), F.col("l_linenumber")
    quantity = (
        F.when(line == 1, number).when(line == 2, F.concat(F.lit(" "), number, F.lit(" "))).when(line == 3, F.concat(number, F.lit(" kg")))
        .when(line == 4, F.lit("1e400")).when(line == 5, F.lit("n/a"))
    )
    shipped = (
        F.when(line == 1, F.date_format(day, "yyyy-MM-dd")).when(line == 2, F.date_format(day, "dd/MM/yyyy")).when(line == 3, F.date_format(day, "yyyyMMdd"))
        .when(line == 4, F.concat(F.lit("31/02/"), F.year(day))).when(line == 5, F.lit(" "))
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", quantity.alias("quantity"), shipped.alias("shipped"))


def value_rejects(spark, root):
    casts = {"quantity": checked_number, "shipped": checked_date}
    return cast_rejects(_typed(Tables(spark, root)), casts, ["l_orderkey", "l_linenumber", "l_partkey"])


def value_reject_counts(spark, root):
    return reject_counts(value_rejects(spark, root))


_REJECTED = """
    SELECT l_orderkey, l_linenumber, l_partkey, 'quantity' AS "column",
           CASE WHEN l_linenumber = 3 THEN l_quantity || ' kg' ELSE '1e400' END AS text,
           CASE WHEN l_linenumber = 3 THEN 'not a number' ELSE 'not finite' END AS reason
    FROM lineitem WHERE l_linenumber IN (3, 4)
    UNION ALL
    SELECT l_orderkey, l_linenumber, l_partkey, 'shipped',
           CASE WHEN l_linenumber = 3 THEN strftime(l_shipdate, '%Y%m%d') ELSE '31/02/' || year(l_shipdate) END, 'not a date'
    FROM lineitem WHERE l_linenumber IN (3, 4)"""


QUERIES = {
    "value_rejects": value_rejects,
    "value_reject_counts": value_reject_counts,
    "demo_filter": demo_filter,
    "null_literals": null_literals,
    "numeric_coerce": numeric_coerce,
    "whitespace_clean": whitespace_clean,
    "text_normalize": text_normalize,
    "insurer_recode": insurer_recode,
    "cleaning_summary": cleaning_summary,
}

_NULLS = ", ".join(f"'{v}'" for v in NULL_LITERALS)
_RECODE_CTES = (
    ("documents_with_demo", _DOCUMENTS_SQL), ("report", _REPORT_SQL), ("catalogue", _CATALOGUE_SQL),
    ("recoded", _RECODED_SQL),
)

SQL = {
    "value_rejects": _REJECTED,
    "value_reject_counts": f"SELECT \"column\", reason, count(*) AS n FROM ({_REJECTED}) GROUP BY ALL",
    "demo_filter": with_ctes(
        ("d", _DOCUMENTS_SQL),
        select="""SELECT c_custkey, coalesce(document, '(null)') AS document FROM d
                  WHERE NOT coalesce(contains(upper(document), 'DEMO'), FALSE)""",
    ),
    "null_literals": f"""
        SELECT o_orderkey, o_orderstatus, CASE WHEN label IN ({_NULLS}) THEN '(null)' ELSE label END AS label
        FROM (SELECT o_orderkey, o_orderstatus,
                     CASE o_orderpriority WHEN '1-URGENT' THEN '' WHEN '4-NOT SPECIFIED' THEN 'n/a'
                          WHEN '5-LOW' THEN 'NULL' ELSE o_orderpriority END AS label FROM orders)""",
    "numeric_coerce": r"""
        SELECT c_custkey,
               CASE WHEN regexp_full_match(trim(t), '[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?')
                    THEN CAST(trim(t) AS DOUBLE) ELSE 0.0 END AS number
        FROM (SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN '  ' || c_acctbal || ' '
                     WHEN 'MACHINERY' THEN 'x' || c_acctbal WHEN 'FURNITURE' THEN c_acctbal || 'd'
                     WHEN 'AUTOMOBILE' THEN c_acctbal || 'e2' END AS t FROM customer)""",
    "whitespace_clean": """
        SELECT c_custkey, c_name || ' ' || c_mktsegment AS name, c_mktsegment || ' ' || c_nationkey AS zone
        FROM customer""",
    "text_normalize": f"SELECT doc_id, {_sql_normalize('text')} AS name FROM documents",
    "insurer_recode": with_ctes(*_RECODE_CTES, select="SELECT * FROM recoded"),
    "cleaning_summary": with_ctes(
        *_RECODE_CTES,
        select=f"""SELECT count(*) AS original,
                   count(*) FILTER (WHERE contains(upper(document), 'DEMO')) AS removed,
                   (SELECT count(*) FROM recoded) AS final,
                   (SELECT count(*) FROM recoded WHERE insurer = '{NOT_APPLICABLE}') AS without_code
                   FROM report""",
    ),
}
