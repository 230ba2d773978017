"""The pipeline's stages on a small corpus, each against plain Python on its own input."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from acequia.llm.registry import CAPACITY
from tests.llm.helpers import nothing
from tests.llm.test_duplicates import brute


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    rng = random.Random(8)
    vocabulary = {"en": "the of and to in that with for on at".split(), "de": "der die und zu den mit von auf im nicht".split()}
    rows, labels = [], []
    for i in range(120):
        lang = "de" if i % 4 == 0 else "en"
        text = "\n".join(" ".join(rng.choice(vocabulary[lang]) + rng.choice(["", "er", "in"]) for _ in range(12)) for _ in range(4))
        if i % 3 == 0:
            text += "\nAll rights reserved by the makers"
        rows.append([i, text, lang, f"s{i % 3}", len(text)])
        labels.append((i, 1, 0))
    for i, copied in ((200, 5), (201, 5), (202, 7)):
        rows.append([i, rows[copied][1] + " extra", rows[copied][2], "s9", None])
    rows += [[300, "@@## $$ %% &&" * 30, "en", "s1", None], [301, None, "en", "s1", None], [302, "", None, None, None], rows[9], [None, rows[11][1], "en", "s2", 1]]
    labels += [(300, 0, 0), (None, 1, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.withColumn("key", F.lit("k")).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root)


def test_stages_keep_their_promises(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, tables = docs.columns, {"start": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, corpus).write.parquet(str(tmp_path / name))
        docs = tables[name] = spark.read.parquet(str(tmp_path / name))
        assert name == "packing" or docs.columns == columns
    held = {n: t.collect() for n, t in tables.items()}
    ids = {n: [r.doc_id for r in rows] for n, rows in held.items()}
    # quality: junk and empty texts go, nearly all of the trusted stay
    assert not {300, 301, 302} & set(ids["quality"])
    assert len(set(range(120)) & set(ids["quality"])) >= 116
    # lines: the boilerplate goes, all else stays
    before = {r.doc_id: r.text for r in held["quality"]}
    assert len(held["lines"]) == len(held["quality"])
    for r in held["lines"]:
        lines = [x for x in before[r.doc_id].split("\n") if x != "All rights reserved by the makers"]
        assert r.text == "\n".join(lines) and r.n_chars == len(r.text)
    # near duplicates: as brute force says, and one row of each
    want = {doc_id for doc_id, _, _, kept in brute([(r.doc_id, r.text) for r in held["lines"]], 5) if kept}
    assert sorted(ids["near_duplicates"]) == sorted(want)
    # mixing: the smaller language gains
    tokens = lambda rows, lang: sum(len(r.text.split()) for r in rows if r.lang == lang)
    share = lambda rows: tokens(rows, "de") / (tokens(rows, "de") + tokens(rows, "en"))
    assert share(held["mixing"]) > share(held["near_duplicates"])
    assert set(ids["mixing"]) <= set(ids["near_duplicates"])
    # packing: every sequence whole, no bin too full, no conflicts
    bins = {}
    for r in held["packing"]:
        bins.setdefault((r.shard, r.bin), []).append(r)
    assert sum(r.n_tokens for r in held["packing"]) == sum(len(r.text.split()) for r in held["mixing"])
    for own in bins.values():
        assert sum(r.n_tokens for r in own) <= CAPACITY
        sources = [r.source for r in own if r.source is not None]
        assert len(sources) == len(set(sources))


def test_run_applies_the_stages(spark, corpus):
    assert corpus_pipeline.run(spark, corpus).count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_of_no_documents(spark, corpus):
    docs = nothing(spark)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, corpus).count() == 0, name
