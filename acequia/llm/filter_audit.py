"""Which filter removes what, in every order of the filters.

Every document has a mask of the filters it fails. In an order of the filters it is
removed at the first one of its mask. Orders are numbered by their Lehmer rank, that
is lexicographically, so the orders that begin with the same letters are an interval
of ranks; a mask is removed at step d in the intervals of those beginnings of d
letters whose last one alone is in the mask. The masks' counts are added at the
begin of each interval and taken off at its end, and prefix sums over the ranks
give the counts of every order and step at once.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acequia.session import materialize

FILTERS = "ABCDE"
LEAST_WORDS = 200
DISTINCT_PERCENT = 50
CAPITALS_PERCENT = 2
MARKS = re.compile(rb"[#$%&*|]")
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_SLICE = 1 << 20  # bytes of a text that are cut into words at once


def word_counts(text: bytes) -> tuple[int, int]:
    """Words and distinct words between ASCII white space; the text is cut slice by slice."""
    total, distinct, at = 0, set(), 0
    while at < len(text):
        gap = _SPACE.search(text, at + _SLICE)
        end = gap.start() if gap else len(text)
        words = text[at:end].split()
        total += len(words)
        distinct.update(words)
        at = end
    return total, len(distinct)


def failures(text: bytes) -> int:
    """Bits 0 to 3: the text fails filter A, B, C, D."""
    total, distinct = word_counts(text)
    b = np.frombuffer(text, np.uint8)
    capitals, chars = int(((b >= 65) & (b <= 90)).sum()), int(((b & 0xC0) != 0x80).sum())
    failed = (total < LEAST_WORDS, 100 * distinct < DISTINCT_PERCENT * total, 100 * capitals > CAPITALS_PERCENT * chars,
              MARKS.search(text) is not None)
    return sum(1 << i for i, f in enumerate(failed) if f)


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t.as_py() for t in batch.column(2).cast(pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
             pa.array([failures(t) for t in texts], pa.int32())],
            ["doc_id", "part", "digest", "mask"])


def masks(docs: DataFrame) -> DataFrame:
    """Every row's part and failed filters: (doc_id, part, mask); bit i of the mask is filter i of FILTERS.

    Filter E fails where a smaller doc_id has the same text. The least id of a
    text is joined back on text and id together, so that copies are no hot key.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    own = materialize(rows.mapInArrow(_judged, "doc_id bigint, part string, digest binary, mask int"), "masks")
    firsts = own.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    copied = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return own.join(firsts, ["digest", "doc_id"], "left").select("doc_id", "part", (F.col("mask") + F.when(copied, 16).otherwise(0)).alias("mask"))


def mask_counts(marked: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by part and mask: (part, mask, n, good, toxic); a document is good or toxic if a label row says so."""
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    return marked.join(known, "doc_id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))


def lehmer_rank(prefix: tuple[int, ...], k: int) -> int:
    """Rank of the first order of k letters that begins so."""
    rank = 0
    for i, letter in enumerate(prefix):
        smaller = sum(1 for other in range(letter) if other not in prefix[:i])
        rank += smaller * factorial(k - 1 - i)
    return rank


def intervals(k: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, begin, end): ranks from begin to before end remove the mask at that step; adjoining ones are one."""
    found: dict[tuple[int, int], list[list[int]]] = {}
    for step in range(1, k + 1):
        width = factorial(k - step)
        for prefix in permutations(range(k), step):  # ascending ranks
            begin = lehmer_rank(prefix, k)
            passed = sum(1 << letter for letter in prefix[:-1])
            for mask in range(1, 1 << k):
                if mask & passed or not mask >> prefix[-1] & 1:
                    continue
                own = found.setdefault((mask, step), [])
                if own and own[-1][1] == begin:
                    own[-1][1] = begin + width
                else:
                    own.append([begin, begin + width])
    return [(mask, step, begin, end) for (mask, step), own in found.items() for begin, end in own]


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Totals of every part, order and step from the counts by mask: see `audit_filters`."""
    k, spark = len(filters), counts.sparkSession
    ranks = factorial(k)
    # fixed tables: a few thousand interval ends, one row for each order
    ends = [(mask, step, rank, sign) for mask, step, begin, end in intervals(k) for rank, sign in ((begin, 1), (end, -1)) if rank < ranks]
    steps = F.broadcast(spark.createDataFrame(ends, "mask int, step int, rank int, sign int"))
    orders = F.broadcast(spark.createDataFrame([(i, "".join(p)) for i, p in enumerate(permutations(filters))], "rank int, filter_order string"))
    measures = ("n", "good", "toxic")
    changes = counts.join(steps, "mask").groupBy("part", "step", "rank").agg(*[F.sum(F.col(m) * F.col("sign")).alias(m) for m in measures])

    def by_filter(test) -> F.Column:
        return F.array(*[F.sum(F.when(test(1 << i), F.col("n")).otherwise(0)) for i in range(k)])

    parts = counts.groupBy("part").agg(
        F.sum("n").alias("total"), by_filter(lambda bit: F.col("mask").bitwiseAND(bit) > 0).alias("fails"),
        by_filter(lambda bit: F.col("mask") == bit).alias("unique"))
    grid = parts.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(k)))).withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(ranks - 1))))
    # all windows below lie within a part, so that one shuffle by part serves them
    cells = grid.join(changes, ["part", "step", "rank"], "left").repartition("part")
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    summed = cells.select("part", "step", "rank", "total", "fails", "unique", *[F.sum(F.coalesce(m, F.lit(0))).over(along).alias(m) for m in measures])
    named = summed.join(orders, "rank").withColumn("place", F.instr(F.lit(filters), F.col("filter_order").substr(F.col("step"), F.lit(1))))
    upto = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    failing = F.element_at("fails", F.col("place"))
    return named.select(
        "part", "filter_order", "step", (F.col("total") - F.sum("n").over(upto)).alias("kept"), F.col("n").alias("removed"),
        (failing - F.col("n")).alias("redundant"), F.element_at("unique", F.col("place")).alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), F.sum("n").over(Window.partitionBy("part", "place")).alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Effect of five filters in all 120 orders, by source: one row per part, filter_order and step, zeros included.

    A fails texts of under 200 words, B those whose distinct words are under half
    of them, C those with over 2 % capital letters A-Z among the code points, D
    those with one of `#$%&*|`, E texts equal to that of a smaller doc_id, whatever
    happened to that one. Columns, as counts of documents of the part: kept (after
    the step), removed (by it), redundant (fail its filter, removed before),
    unique_fails (fail its filter alone), good_lost and toxic_lost (removed by it,
    quality or toxic 1 in `labels`), shapley (removed by its filter, summed over
    all orders).

    Null texts count as empty ones, null sources as the empty source. Rows without
    id are counted, but no copies and without labels. Repeated rows count each;
    those of the least id are no copies of each other. Of several label rows of a
    document any may make it good or toxic. Other columns are ignored, whatever
    their names. No documents give no rows.
    """
    return audit(materialize(mask_counts(masks(docs), labels), "mask_counts"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
