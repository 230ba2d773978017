import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from acequia.functions.text import normalize_text
from acequia.operators import matching as m
from acequia.plans.cleaning import clean_orders, clean_report


def catalogue_of(spark, names):
    rows = [(n, f"c{i}", (0, i)) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "name string, code string, pos struct<source:int,ord:bigint>")


def lcs(x, y):
    row = [0] * (len(y) + 1)
    for c in x:
        new = [0]
        for j, d in enumerate(y):
            new.append(row[j] + 1 if c == d else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def random_names(rng, n):
    words = ["".join(rng.choice("ABCDE1") for _ in range(rng.randint(1, 7))) for _ in range(25)]
    return sorted({" ".join(rng.choice(words) for _ in range(rng.randint(1, 5))) for _ in range(n)})


def mutated(rng, names):
    out = set()
    for name in names:
        chars = list(name)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(chars) or 1)  # a short name may have lost all its letters
            chars[at: at + rng.randint(0, 1)] = rng.choice(["", "A", "Z9"])
        words = " ".join("".join(chars).split()).split()
        rng.shuffle(words)
        if words:
            out.add(" ".join(words))
    return sorted(out)


@pytest.mark.parametrize("threshold", [50, 70, 85, 95])
def test_fuzzy_equals_brute_force(spark, threshold):
    rng = random.Random(threshold)
    entries = random_names(rng, 60)
    names = mutated(rng, entries)
    want = {}
    for name in names:
        a = " ".join(sorted(name.split(" ")))
        best = None
        for i, entry in enumerate(entries):
            b = " ".join(sorted(entry.split(" ")))
            n = lcs(a, b)
            score = 200.0 * n / (len(a) + len(b))
            if 200 * n >= threshold * (len(a) + len(b)) and (best is None or score > best[1]):
                best = (f"c{i}", score)
        if best:
            want[name] = best
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: (r.code, r.score) for r in m.match_fuzzy(frame, catalogue_of(spark, entries), threshold).collect()}
    assert got == want


@pytest.mark.parametrize("limit", [0, m.BROADCAST_BYTES])
def test_partial_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(m, "BROADCAST_BYTES", limit)
    rng = random.Random(3)
    entries = random_names(rng, 80)
    names = sorted(set(random_names(rng, 150)) | {f"{e} EXTRA" for e in entries[:20]})
    want = {}
    for name in names:
        hit = next((i for i, e in enumerate(entries) if all(w in name for w in e.split()[:4])), None)
        if hit is not None:
            want[name] = f"c{hit}"
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: r.code for r in m.match_partial(frame, catalogue_of(spark, entries)).collect()}
    assert got == want


def test_impossible_thresholds_are_refused(spark):
    frame = spark.createDataFrame([("A",)], "name string")
    for threshold in (0, 101):
        with pytest.raises(ValueError):
            m.match_fuzzy(frame, catalogue_of(spark, ["A"]), threshold)


def test_few_pairs_are_tested():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ", k=rng.randint(3, 8))) for _ in range(60)]
    shares = []
    for n in (300, 3_000):
        entries = sorted({" ".join(sorted(rng.choices(vocabulary, k=3))) for _ in range(n)})
        names = sorted({" ".join(sorted(rng.choices(vocabulary, k=3))) for _ in range(200)})
        counts = Counter(p for e in entries for p in m._pieces_of(e))
        order = {p: i for i, (p, _) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0])))}
        held = Counter(k for keys in m.prefix_keys(pd.Series(entries), order, 85, m.DEPTH, False) for k in keys.tolist())
        tested = sum(held[k] for keys in m.prefix_keys(pd.Series(names), order, 85, m.DEPTH, True) for k in keys.tolist())
        shares.append(tested / len(entries) / len(names))
    assert shares[0] < 0.1 and shares[1] < 0.1


def masters(spark):
    supplies = spark.createDataFrame(
        [("I1.0", "Jeringa 10 ml", 0), ("I2", "Gasa", 1), ("I3", "Gasa estéril", 2)],
        "`CODIGO INTERNO` string, `DESCRIPCIÓN DEL INSUMO` string, seq int",
    )
    drugs = spark.createDataFrame(
        [("M1", "JERINGA 10ML", 0), ("M2", "Acetaminofén 500 mg tableta", 1), (None, "Sin código", 2), ("M3", " ", 3)],
        "`Código del Medicamento` string, Nombre string, seq int",
    )
    return supplies, drugs


def test_catalogue_and_cascade_golden(spark):
    supplies, drugs = masters(spark)
    cat = m.build_catalogue(
        [(supplies, "CODIGO INTERNO", "DESCRIPCIÓN DEL INSUMO", "seq"), (drugs, "Código del Medicamento", "Nombre", "seq")]
    )
    assert [(r.name, r.code) for r in cat.orderBy("pos").collect()] == [
        ("JERINGA 10ML", "M1"), ("GASA", "I2"), ("GASA ESTERIL", "I3"), ("ACETAMINOFEN 500MG TABLETA", "M2"),
    ]
    orders = spark.createDataFrame(
        [
            ("1", "Jeringa de 10 ml"), ("2", "Paquete gasa estéril grande"), ("3", "Acetaminofem 500 mg tableta"),
            ("4", "Silla de ruedas"), ("demo-5", "Gasa"), (None, "Gasa"),
        ],
        "Cedula string, `Insumo Solicitado` string",
    )
    out = clean_orders(orders, supplies, drugs, "seq")
    assert out.columns == orders.columns
    assert {tuple(r) for r in out.collect()} == {("1", "M1"), ("2", "I2"), ("3", "M2"), (None, "I2")}
    strict = clean_orders(orders, supplies, drugs, "seq", use_fuzzy=False)
    assert {r[0] for r in strict.collect()} == {"1", "2", None}
    steps = m.code_orders(orders, cat, "Insumo Solicitado").groupBy("step").count().collect()
    assert dict(map(tuple, steps)) == {"exact": 3, "partial": 1, "fuzzy": 1, "none": 1}


def test_empty_names_match_nothing(spark):
    frame = spark.createDataFrame([("Oral",)], "c string").select(normalize_text(F.col("c")).alias("name"))
    cat = catalogue_of(spark, ["A", "GASA"])
    assert m.match_names(frame, cat).count() == 0


def test_insurer_recode_golden(spark):
    cat = spark.createDataFrame(
        [("Salud A", "01"), ("Salud B ", "02"), ("Salud B", "03"), ("Salud C", None)], "Aseguradora string, `Codigo Sistema` string"
    )
    rows = [("1", " Salud A "), ("2", "Salud B"), ("3", "Salud C"), ("4", "Otra"), ("5", None), ("xDemo9", "Salud A")]
    report = spark.createDataFrame(rows, "`Documento Paciente` string, Aseguradora string")
    got = sorted(tuple(r) for r in clean_report(report, cat).collect())
    assert got == [
        ("1", "01"), ("2", "02"), ("2", "03"), ("3", "No Aplica"), ("4", "No Aplica"), ("5", "No Aplica"),
    ]
