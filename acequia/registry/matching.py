"""Catalogue and record linkage on the shared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acequia.operators import matching as m
from acequia.operators.cleaning import keep_filled
from acequia.registry.cleaning import _sql_normalize
from acequia.registry.scenario import Tables, text, with_ctes
from acequia.session import materialize


def _catalogue(t: Tables) -> DataFrame:
    """Parts listed as supplies, then as drugs; some drugs lack their code."""
    supplies = t.part.select(
        "p_partkey", F.concat(F.lit("I"), text("p_partkey"), F.lit(".0")).alias("code"),
        F.concat_ws(" ", "p_name", "p_type").alias("name"),
    )
    no_code = (F.col("p_brand") == "Brand#3") & (F.col("p_size") < 10)
    drugs = t.part.select(
        "p_partkey", F.when(~no_code, F.concat(F.lit("M"), text("p_partkey"))).alias("code"),
        F.concat(F.col("p_name"), F.lit(" de "), text("p_size"), F.lit(" mg "), F.col("p_type")).alias("name"),
    )
    return m.build_catalogue([(supplies, "code", "name", "p_partkey"), (drugs, "code", "name", "p_partkey")])


def _orders(t: Tables) -> DataFrame:
    """Order lines with a free-text request: accents, stop words, extra words, typos, other things."""
    name, size, kind = F.col("p_name"), text("p_size"), F.col("p_type")
    typo = F.concat(F.substring(name, 1, 1), F.expr("substring(p_name, 3)"))
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    request = (
        F.when((flag == "N") & (status == "O"), F.concat_ws(" ", F.regexp_replace(name, "o", "ó"), size, F.lit("mg"), kind))
        .when(flag == "N", F.concat(F.lit("El "), name, F.lit(" de "), size, F.lit("  MG "), kind))
        .when((flag == "R") & (status == "O"), F.concat(F.lit("Paquete "), name, F.lit(" "), size, F.lit(" mg "), kind, F.lit(" grande")))
        .when(flag == "R", F.concat_ws(" ", typo, size, F.lit("mg"), kind))
        .when(status == "F", F.concat(kind, F.lit(" "), size, F.lit(" mg "), typo))
        .otherwise(F.concat(F.lit("Silla de ruedas "), text("l_suppkey")))
    )
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text("l_shipdate").alias("shipped"),
        request.alias("request"),
    )


def _names(t: Tables) -> DataFrame:
    return m.distinct_names(_orders(t), "request")


def catalog_build(spark, root):
    return _catalogue(Tables(spark, root)).select(
        "name", "code", F.col("pos.source").alias("pos_source"), F.col("pos.ord").alias("pos_ord")
    )


def match_exact(spark, root):
    t = Tables(spark, root)
    return m.match_exact(_names(t), _catalogue(t))


def match_partial(spark, root):
    t = Tables(spark, root)
    return m.match_partial(_names(t), materialize(_catalogue(t), "catalogue"))


def match_fuzzy(spark, root):
    t = Tables(spark, root)
    catalogue, names = materialize(_catalogue(t), "catalogue"), _names(t)
    return m.match_fuzzy(names.join(catalogue.select("name"), "name", "left_anti"), catalogue)


def _coded(t: Tables) -> DataFrame:
    return m.code_orders(_orders(t), _catalogue(t), "request")


def order_coding(spark, root):
    coded = keep_filled(_coded(Tables(spark, root)), "code")
    return coded.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "shipped", F.col("code").alias("request"), "step")


def match_rates(spark, root):
    return m.match_rates(_coded(Tables(spark, root)))


QUERIES = {
    "catalog_build": catalog_build,
    "match_exact": match_exact,
    "match_partial": match_partial,
    "match_fuzzy": match_fuzzy,
    "order_coding": order_coding,
    "match_rates": match_rates,
}

_CATALOGUE = (
    ("listed", f"""
        SELECT code, {_sql_normalize('name')} AS name, source, ord FROM (
            SELECT 'I' || p_partkey AS code, p_name || ' ' || p_type AS name, 0 AS source, p_partkey AS ord FROM part
            UNION ALL
            SELECT 'M' || p_partkey, p_name || ' de ' || p_size || ' mg ' || p_type, 1, p_partkey FROM part
            WHERE NOT (p_brand = 'Brand#3' AND p_size < 10))"""),
    ("catalogue", """
        SELECT name, arg_max(code, source * 1000000000000 + ord) AS code,
               min(source * 1000000000000 + ord) AS pos
        FROM listed WHERE name <> '' GROUP BY name"""),
)

_ORDERS = (
    ("typed", """
        SELECT *, substr(p_name, 1, 1) || substr(p_name, 3) AS typo
        FROM lineitem JOIN part ON l_partkey = p_partkey"""),
    ("requested", f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS VARCHAR) AS shipped,
               {_sql_normalize('''CASE
               WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN replace(p_name, 'o', 'ó') || ' ' || p_size || ' mg ' || p_type
               WHEN l_returnflag = 'N' THEN 'El ' || p_name || ' de ' || p_size || '  MG ' || p_type
               WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'Paquete ' || p_name || ' ' || p_size || ' mg ' || p_type || ' grande'
               WHEN l_returnflag = 'R' THEN typo || ' ' || p_size || ' mg ' || p_type
               WHEN l_linestatus = 'F' THEN p_type || ' ' || p_size || ' mg ' || typo
               ELSE 'Silla de ruedas ' || l_suppkey END''')} AS name
        FROM typed"""),
    ("names", "SELECT DISTINCT name FROM requested WHERE name <> ''"),
)

_EXACT = ("exact", "SELECT name, code FROM names JOIN catalogue USING (name)")


def _partial_sql(source: str) -> tuple:
    """Brute force: every name against every entry's first four words."""
    return (
        ("words", """
            SELECT code, pos, ws[1] AS w1, coalesce(ws[2], '') AS w2, coalesce(ws[3], '') AS w3,
                   coalesce(ws[4], '') AS w4 FROM (SELECT *, string_split(name, ' ') AS ws FROM catalogue)"""),
        ("partial", f"""
            SELECT name, arg_min(code, pos) AS code FROM {source} JOIN words
            ON contains(name, w1) AND contains(name, w2) AND contains(name, w3) AND contains(name, w4)
            GROUP BY name"""),
    )


def _fuzzy_sql(source: str) -> tuple:
    """Longest common subsequence row by row of its table, for pairs that edit distance lets through."""
    return (
        ("asked", f"SELECT name, array_to_string(list_sort(string_split(name, ' ')), ' ') AS a FROM {source}"),
        ("entries", """
            SELECT array_to_string(list_sort(string_split(name, ' ')), ' ') AS b, arg_min(code, pos) AS code,
                   min(pos) AS pos FROM catalogue GROUP BY 1"""),
        ("pairs", """
            SELECT DISTINCT a, b FROM asked JOIN entries
            ON 200 * least(length(a), length(b)) >= 85 * (length(a) + length(b))
               AND 100 * levenshtein(a, b) <= 15 * (length(a) + length(b))"""),
        ("lcs", """
            SELECT a, b, 1 AS i, list_transform(range(0, length(b) + 1), lambda x: 0) AS prev FROM pairs
            UNION ALL
            SELECT a, b, i + 1, list_reduce(range(1, length(b) + 1), lambda acc, j: list_append(acc,
                   CASE WHEN substr(a, i, 1) = substr(b, j, 1) THEN prev[j] + 1
                        ELSE greatest(prev[j + 1], acc[len(acc)]) END), [0])
            FROM lcs WHERE i <= length(a)"""),
        ("scored", """
            SELECT name, code, pos, 200.0::DOUBLE * prev[len(prev)] / (length(a) + length(b)) AS score
            FROM lcs JOIN asked USING (a) JOIN entries USING (b)
            WHERE i = length(a) + 1 AND 200 * prev[len(prev)] >= 85 * (length(a) + length(b))"""),
        ("fuzzy", """
            SELECT name, arg_min(code, (-score, pos)) AS code, max(score) AS score FROM scored GROUP BY name"""),
    )


_CASCADE = (
    *_CATALOGUE, *_ORDERS, _EXACT,
    ("rest1", "SELECT name FROM names WHERE name NOT IN (SELECT name FROM exact)"),
    *_partial_sql("rest1"),
    ("rest2", "SELECT name FROM rest1 WHERE name NOT IN (SELECT name FROM partial)"),
    *_fuzzy_sql("rest2"),
    ("coded", """
        SELECT *, 'exact' AS step FROM exact UNION ALL SELECT *, 'partial' FROM partial
        UNION ALL SELECT name, code, 'fuzzy' FROM fuzzy"""),
)


def _recursive(*ctes, select: str) -> str:
    return with_ctes(*ctes, select=select).replace("WITH ", "WITH RECURSIVE ", 1)


SQL = {
    "catalog_build": with_ctes(
        *_CATALOGUE,
        select="""SELECT name, code, CAST(pos // 1000000000000 AS INTEGER) AS pos_source,
                  pos % 1000000000000 AS pos_ord FROM catalogue""",
    ),
    "match_exact": with_ctes(*_CATALOGUE, *_ORDERS, _EXACT, select="SELECT * FROM exact"),
    "match_partial": with_ctes(*_CATALOGUE, *_ORDERS, *_partial_sql("names"), select="SELECT * FROM partial"),
    "match_fuzzy": _recursive(
        *_CATALOGUE, *_ORDERS,
        ("rest", "SELECT name FROM names WHERE name NOT IN (SELECT name FROM catalogue)"),
        *_fuzzy_sql("rest"), select="SELECT name, code, score FROM fuzzy",
    ),
    "order_coding": _recursive(
        *_CASCADE,
        select="""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, shipped, code AS request, step
                  FROM requested JOIN coded USING (name)""",
    ),
    "match_rates": _recursive(
        *_CASCADE,
        select="""SELECT coalesce(step, 'none') AS step, count(*) AS n,
                  CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM requested) AS share
                  FROM requested LEFT JOIN coded USING (name) GROUP BY 1""",
    ),
}
