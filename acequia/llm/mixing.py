"""Mixing domains to target weights with soft membership.

A naive Bayes classifier trained on a labelled table gives every document its
posterior over the domains. Nonnegative document rates then minimise the weighted
squares between the domains' expected token totals (rate * tokens * posterior,
summed) and their targets, by projected gradient: every step sends one number per
domain to the driver, and the rates are replayed from the history of steps, so that
no state but the posteriors is stored.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acequia.llm.common import lean
from acequia.session import materialize

BUCKETS = 4096
SMOOTHING = 1.0
# Evidence of a text counts as that of so many byte trigrams at most; keeps posteriors soft.
EVIDENCE = 3.0
STEPS = 60
STEP = 0.9
TOLERANCE = 1e-6
MOST_DOMAINS = 256


def buckets(text: str | bytes | None) -> np.ndarray:
    """Counts of hashed byte trigrams of the whole text."""
    raw = text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(BUCKETS)
    h = (b[:-2] * 0x9E3779B1 ^ b[1:-1] * 0x85EBCA6B ^ b[2:] * 0xC2B2AE35) >> 20
    return np.bincount(h, minlength=BUCKETS).astype(np.float64)


def words(raw: bytes) -> int:
    """Words between ASCII white space; the number that `tokens_of` gives."""
    b = np.frombuffer(raw, np.uint8)
    inside = (b != 32) & ((b < 9) | (b > 13))
    return int(inside[:1].sum() + (inside[1:] & ~inside[:-1]).sum())


def _counts(domains: list[str]) -> Callable:
    place = {d: i for i, d in enumerate(domains)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, docs = np.zeros((len(domains), BUCKETS)), np.zeros(len(domains))
        for batch in batches:
            for domain, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if domain in place:
                    total[place[domain]] += buckets(text.as_py())
                    docs[place[domain]] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(domains))), pa.array(list(total), pa.list_(pa.float64())), pa.array(docs)], ["domain", "counts", "docs"])

    return run


def train(labelled: DataFrame, domains: list[str]) -> np.ndarray:
    """Log-likelihood of every bucket by domain, with the log prior in a last column; from all labelled rows."""
    sums = (
        labelled.select("domain", "text").mapInArrow(lean(_counts(domains)), "domain bigint, counts array<double>, docs double")
        .select("domain", "docs", F.posexplode("counts").alias("bucket", "n"))
        .groupBy("domain", "bucket").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .collect()  # domains * BUCKETS numbers
    )
    counts, docs = np.full((len(domains), BUCKETS), SMOOTHING), np.ones(len(domains))
    for r in sums:
        counts[r.domain, r.bucket] += r.n
        docs[r.domain] = 1.0 + r.docs
    like = np.log(counts / counts.sum(axis=1, keepdims=True))
    return np.hstack([like, np.log(docs / docs.sum())[:, None]])


def membership(model: np.ndarray, text: str | bytes | None) -> np.ndarray:
    """Posterior over the domains; the prior for texts under 3 bytes."""
    n = buckets(text)
    size = n.sum()
    score = model[:, -1] + (model[:, :-1] @ n) * (min(1.0, EVIDENCE / size) if size else 0.0)
    p = np.exp(score - score.max())
    return p / p.sum()


def posterior(model: np.ndarray) -> Callable:
    """Arrow UDF: `membership` of each text."""

    @F.pandas_udf("array<double>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            yield pd.Series([membership(model, text) for text in series])

    return run


def _classified(model: np.ndarray) -> Callable:
    """Rows (doc_id, key, n_tokens, p) of rows (doc_id, key, text); every text is read once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(2).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([words(t) for t in texts], pa.int64()),
                 pa.array([membership(model, t) for t in texts], pa.list_(pa.float64()))],
                ["doc_id", "key", "n_tokens", "p"])

    return run


def _state(docs: DataFrame, key: Column | None, model: np.ndarray) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.lit(None).cast("long") if key is None else key).alias("key"), "text")
    return materialize(rows.mapInArrow(lean(_classified(model)), "doc_id bigint, key bigint, n_tokens bigint, p array<double>"), "mixture")


def replay(p: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    """Rates after the steps: projected gradient from 1, in the metric of the documents' tokens."""
    r = np.ones(len(p))
    for g in steps:
        r = np.maximum(r - p @ g, 0.0)
    return r


def _totals(steps: list[np.ndarray], k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k)
        for batch in batches:
            t = batch.column(0).to_numpy(zero_copy_only=False).astype(np.float64)
            p = batch.column(1).values.to_numpy()[batch.column(1).offsets[0].as_py():].reshape(-1, k)[:len(t)]
            total += (replay(p, steps) * t) @ p
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["totals"])

    return run


def fit(state: DataFrame, targets: np.ndarray) -> list[np.ndarray]:
    """Steps of the projected gradient over (n_tokens, p): each a vector of one number per domain."""
    k = len(targets)
    steps: list[np.ndarray] = []
    scale = None
    for _ in range(STEPS):
        rows = state.select("n_tokens", "p").mapInArrow(_totals(steps, k), "totals array<double>")
        sums = rows.select(F.posexplode("totals").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
        got = np.zeros(k)
        for r in sums:
            got[r.i] = r.x
        if scale is None:
            scale = np.maximum(got, 1e-12)  # tokens of each domain at rate 1
        off = (got - targets) / scale
        if np.abs(got - targets).max() <= TOLERANCE * max(targets.sum(), 1e-12):
            break
        steps.append(STEP * off)
    return steps


class Mixture:
    """Classifier, targets and fitted steps; gives rates and posteriors as columns of any table with a text.

    `state` has what the classifier found in the documents mixed: (doc_id, key, n_tokens, p).
    """

    def __init__(self, domains: list[str], model: np.ndarray, targets: np.ndarray, steps: list[np.ndarray], state: DataFrame):
        self.domains, self.model, self.targets, self.steps, self.state = domains, model, targets, steps, state

    def rated(self) -> DataFrame:
        """(doc_id, key, n_tokens, posterior, rate) of the documents mixed, without reading them again."""
        return self.state.select("doc_id", "key", "n_tokens", F.col("p").alias("posterior"), self.rate(F.col("p")).alias("rate"))

    def rate(self, p: Column) -> Column:
        steps = self.steps

        @F.pandas_udf("double")
        def run(series: pd.Series) -> pd.Series:
            if not len(series):
                return pd.Series([], dtype="float64")
            return pd.Series(replay(np.stack(series.to_numpy()), steps))

        return run(p)

    def posterior(self, text: Column) -> Column:
        return posterior(self.model)(text)


def tokens_of(text: Column) -> Column:
    """Words between white space; a stand-in for any token count."""
    trimmed = F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, " "))).cast("long")


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | float, key: Column | None = None) -> Mixture:
    """Fit rates so that the domains' expected token totals meet the target weights.

    `docs` has doc_id and text, `key` tells its rows apart where that matters to the
    caller; `labelled` has text and domain. `weights` gives each domain's
    share of the tokens, or an exponent: shares are then those of the labelled
    rows' domains among the documents, raised to it (below 1: small domains gain).
    The total of the targets is the total of the tokens. Domains that cannot reach
    their target at nonnegative rates come as near as least squares allow.

    Null and blank texts have 0 tokens, weigh nothing and have the prior as
    posterior. Rows labelled with null or other domains are not trained on;
    without any labelled domain every rate is 1. At most MOST_DOMAINS domains.
    """
    if isinstance(weights, dict):
        domains = sorted(weights)
    else:
        found = labelled.select("domain").dropna().distinct().limit(MOST_DOMAINS + 1).collect()
        domains = sorted(r.domain for r in found)
    if len(domains) > MOST_DOMAINS:
        raise ValueError("too many domains")
    if not domains:
        model = np.zeros((1, BUCKETS + 1))
        return Mixture([], model, np.zeros(1), [], _state(docs, key, model))
    model = train(labelled, domains)
    every = _state(docs, key, model)
    state = every.filter("n_tokens > 0")
    sums = state.select("n_tokens", F.posexplode("p").alias("i", "x")).groupBy("i").agg(F.sum(F.col("x") * F.col("n_tokens")).alias("t")).collect()
    total = np.zeros(len(domains))
    for r in sums:
        total[r.i] = r.t
    share = np.array([weights[d] for d in domains], float) if isinstance(weights, dict) else np.power(total, weights)
    targets = share / max(share.sum(), 1e-300) * total.sum()
    return Mixture(domains, model, targets, fit(state, targets), every)


def with_rates(docs: DataFrame, mixture: Mixture) -> DataFrame:
    """Adds n_tokens, posterior and rate to any rows with a text; columns of these names are replaced."""
    held = docs.withColumns({"n_tokens": tokens_of(F.col("text")), "posterior": mixture.posterior(F.col("text"))})
    return held.withColumn("rate", mixture.rate(F.col("posterior")))


def copies(rate: Column, key: Column) -> Column:
    """Whole copies for a rate: its floor, and one more for the keys whose hash falls below the fraction."""
    u = F.pmod(F.xxhash64(key, F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + (u < rate - F.floor(rate)).cast("int")).cast("int")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
