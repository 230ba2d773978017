"""Helpers that several corpus operators share."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acequia.session import materialize

# Largest table of 8-byte keys sent whole to every executor; beyond it the join shuffles.
BROADCAST_KEYS = 2_000_000
# Rounds of the component search; the edges at least halve their depth in each.
MAX_ROUNDS = 60


# Blocks from this size on go back to the system as soon as they are free (glibc otherwise raises its bound).
_MAPPED_BYTES = 1 << 20


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task function whose worker keeps no memory for later tasks: workers are used again, their free memory is not.

    An executor's JVM and its Python workers share one memory limit, so what a worker
    holds back without need is missing elsewhere.
    """

    def wrapped(batches: Iterator) -> Iterator:
        try:
            libc = ctypes.CDLL("libc.so.6")
            libc.mallopt(-3, _MAPPED_BYTES)  # M_MMAP_THRESHOLD
        except (OSError, AttributeError):  # another C library
            libc = None
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if libc is not None:
                libc.malloc_trim(0)

    return wrapped


def worker_cache() -> dict:
    """Objects that the tasks of one Python worker share.

    Functions travel to the workers by value, each with globals of its own, so a
    cache among these would last for one task; a module of the worker holds it.
    """
    holder = sys.modules.setdefault("acequia_worker_cache", types.ModuleType("acequia_worker_cache"))
    return holder.__dict__.setdefault("held", {})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def content_key() -> Column:
    """One number for a document's id and text; equal rows share it, nulls are allowed."""
    return F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(-1)), F.col("doc_id").isNull(), F.coalesce("text", F.lit("")),
                      F.col("text").isNull())


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_KEYS) -> DataFrame:
    """Mark a narrow table for broadcast when a count shows at most `most` rows; else leave the join to shuffle."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch's edges as stars: every node of the batch with the least node that the batch connects it to."""
    for batch in batches:
        up: dict[int, int] = {}

        def find(x: int) -> int:
            while up.setdefault(x, x) != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                up[max(a, b)] = min(a, b)
        stars = [(x, find(x)) for x in list(up) if up[x] != x]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in stars], pa.int64()), pa.array([r for _, r in stars], pa.int64())], ["u", "v"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge list of long ids: (node, root), root the least id of the component.

    Batches of edges are first reduced to stars where they lie. Large-star and
    small-star rounds (each node hands its neighbours to its least neighbour)
    follow until every node points at its root. Every step is an aggregate or an
    equi-join on node ids, so a hub is never gathered in one group; each round is
    written to the shared folder, which also cuts the lineage. Only nodes that
    have an edge are returned; no edges give an empty table.
    """
    clean = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).filter("u <> v")
    state = materialize(clean.mapInArrow(_forests, "u bigint, v bigint").distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        # done when every node has one edge and what it points at has none
        roots = state.select(F.col("v").alias("u")).distinct().withColumn("root", F.lit(1))
        degrees = state.groupBy("u").agg(F.count("*").alias("n"))
        if degrees.join(roots, "u", "left").filter("n > 1 or root is not null").isEmpty():
            break
        both = state.select("u", "v").union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = materialize(
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large"
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        state = materialize(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "small")
    else:
        raise RuntimeError("component search did not settle")
    roots = state.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
