"""A corpus pipeline of five stages over `documents`."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acequia.llm.common import content_key
from acequia.llm.kneser_ney import classify
from acequia.llm.line_templates import without_recurring_lines
from acequia.llm.minhash import minhash_components
from acequia.llm.mixing import copies, mix
from acequia.llm.packing import pack
from acequia.llm.registry import MIX_EXPONENT, labelled_domains, packable, trusted_documents
from acequia.session import shared_dir
from acequia.sources.tables import remove_at_exit


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose perplexity lies within the quantiles of trusted text.

    Null and empty texts are rejected; equal rows get one verdict, rows without id
    theirs; where a language has no trusted text all its rows with text stay.
    No rows give none. The columns are those of `docs`, whatever their names.
    """
    kept = classify(docs, trusted_documents(spark, sf_dir), content_key()).filter("kept").select(F.col("key").alias("content")).distinct()
    return docs.join(kept, content_key() == kept["content"], "left_semi")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines of recurring templates; n_chars follows the text.

    Null and empty texts stay as they are, a text may become empty; equal rows count
    as one document and get equal texts. No rows give none.
    """
    shorter = without_recurring_lines(docs, content_key())
    return shorter.withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of each group of near copies the document with the least id, once.

    Rows of one id and text are one document; of several texts with the least id
    each stays. Null and empty texts are like nothing and stay. No rows give none.
    """
    kept = minhash_components(docs, shingle_words=5, key=content_key()).filter("kept").select(F.col("key").alias("content")).distinct()
    return docs.join(kept, content_key() == kept["content"], "left_semi").dropDuplicates(["doc_id", "text"])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the languages' expected tokens meet the target weights.

    Blank and null texts have the prior as posterior; equal rows have equal rates.
    Without labelled rows every document stays once. No rows give none.
    """
    mixture = mix(docs, labelled_domains(spark, sf_dir, docs), MIX_EXPONENT)
    rate = mixture.rate(mixture.posterior(F.col("text")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), copies(rate, content_key()).alias("times"))
    return rows.filter("times > 0").select("doc", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy")).select("doc.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of the documents' sequences; see `pack`. Blank and null texts are sequences of no tokens."""
    return pack(packable(docs)).drop("key")


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

# Perplexity, projected gradient and best-fit packing are not SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again; the folders go when the driver's JVM ends."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    remove_at_exit(spark, base)
    for name, stage in STAGES:
        path = f"{base}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
