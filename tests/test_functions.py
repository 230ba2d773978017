import unicodedata

import pandas as pd
import pytest
from pyspark.sql import functions as F

from acequia.functions.similarity import lcs_lengths, token_sort_similarity
from acequia.functions.text import composite_key, normalize_text, strip_accents
from acequia.functions.values import null_literals, parse_date, to_number

GOLDEN = {
    "Jeringa de 10 ml x 1": "JERINGA 10ML 1",
    "Acetaminofén 500 mg tableta": "ACETAMINOFEN 500MG TABLETA",
    "Catéter 20 cms": "CATETER 20 CM",
    "GASA 10X10": "GASA 10X10",
    "Solución oral": "SOLUCION",
    "Oral": "",
    "½ LITRO": "1 2 LITRO",
    "A/B-C": "B C",
    "0.5 MG": "0 5MG",
    "10MGS": "10MGS",
    "Straße 5 ª": "STRASSE 5",
    None: "",
}


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")


def results(df):
    return [r[0] for r in df.orderBy("i").select("out").collect()]


def test_normalize_golden(spark):
    out = column(spark, list(GOLDEN)).withColumn("out", normalize_text(F.col("c")))
    assert results(out) == list(GOLDEN.values())


def test_strip_accents_keeps_what_matters_of_all_unicode(spark):
    chars = [chr(c) for c in range(0x21, 0x20000, 7) if not 0xD800 <= c <= 0xDFFF]
    out = results(column(spark, chars).withColumn("out", strip_accents(F.col("c"))))

    def ascii_part(text):
        return "".join(c for c in text if c.isascii())

    for ch, got in zip(chars, out):
        want = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        assert ascii_part(got) == ascii_part(want), hex(ord(ch))


@pytest.mark.parametrize(
    "a,b,score",
    [
        ("JERINGA 10ML", "JERINGAS 10ML", 96.0),
        ("TABLETA ACETAMINOFEN 500MG", "ACETAMINOFEN 500MG TABLETA", 100.0),
        ("ABCDEFGHIJKLMNOPQRST", "ABCDEFGHIJKLMNOPQXYZ", 85.0),
        ("CATETER 20CM", "CATETER 22CM", 91.667),
        ("GASA", "GASAS", 88.889),
        ("DIPIRONA", "DIPIRINA", 87.5),
        ("GUANTE", "GUANTES LATEX", 63.158),
    ],
)
def test_similarity_golden(spark, a, b, score):
    row = spark.createDataFrame([(a, b)], "a string, b string")
    got = row.select(token_sort_similarity(F.col("a"), F.col("b"))).first()[0]
    assert got == pytest.approx(score, abs=5e-4)


def test_lcs_around_word_size():
    def table(x, y):
        row = [0] * (len(y) + 1)
        for c in x:
            new = [0]
            for j, d in enumerate(y):
                new.append(row[j] + 1 if c == d else max(row[j + 1], new[-1]))
            row = new
        return row[-1]

    import random

    random.seed(5)
    texts = [["".join(random.choice("ABÉ 1") for _ in range(random.choice([0, 1, 7, 63, 64, 65, 90]))) for _ in range(80)] for _ in "xy"]
    got = lcs_lengths(pd.Series(texts[0]), pd.Series(texts[1])).tolist()
    assert got == [table(x, y) for x, y in zip(*texts)]


def test_values(spark):
    numbers = ["3", " 4.5 ", "x", None, "1d", "nan", "inf", "1e400", "-.5", "2e1"]
    out = column(spark, numbers).withColumn("out", to_number(F.col("c")))
    assert results(out) == [3.0, 4.5, 0, 0, 0, 0, 0, 0, -0.5, 20.0]
    out = column(spark, ["n/a", "", "NULL", "None", "A", None]).withColumn("out", null_literals(F.col("c")))
    assert results(out) == [None, None, None, None, "A", None]
    out = column(spark, ["2024-06-15", "15/06/2024", "bad"]).withColumn("out", parse_date(F.col("c")).cast("string"))
    assert results(out) == ["2024-06-15", "2024-06-15", None]
    keys = spark.createDataFrame([("510", "S9", None)], "a string, b string, c string")
    assert keys.select(composite_key(F.col("a"), F.col("b"), F.col("c"))).first()[0] == "510-S9-"
