"""Best-fit packing of token sequences into bins, with conflicts.

Texts longer than a bin are cut into pieces. Pieces are dealt over shards of bounded
size, and each shard is packed by itself, longest piece first. Open bins are kept in
the order of their free room; a bin carries a bitmap of its sources and one of
its duplicate clusters. From the tightest bin with room enough the search goes on
to the next roomier one until it finds one that holds neither the piece's source
(beyond the allowed number) nor its cluster; without one a new bin is opened.
"""

from __future__ import annotations

import sys
from bisect import bisect_left, insort
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
SHARD_PIECES = 4096


def best_fit(lengths: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[int]:
    """Bin of every piece, in the given order; no bin holds a source or a cluster twice (-1: free of conflict)."""
    order: list[tuple[int, int]] = []  # (room, bin), tightest first
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    out = []
    for length, source, cluster in zip(lengths, sources, clusters):
        s, c = (1 << source if source >= 0 else 0), (1 << cluster if cluster >= 0 else 0)
        at = bisect_left(order, (length, -1))
        while at < len(order) and (source_bits[order[at][1]] & s or cluster_bits[order[at][1]] & c):
            at += 1
        if at < len(order):
            room, chosen = order.pop(at)
        else:
            room, chosen = capacity, len(source_bits)
            source_bits.append(0)
            cluster_bits.append(0)
        source_bits[chosen] |= s
        cluster_bits[chosen] |= c
        insort(order, (room - length, chosen))
        out.append(chosen)
    return out


def _numbered(values: pd.Series) -> list[int]:
    """A bit for every value that occurs twice or more; others conflict with nothing."""
    codes, _ = pd.factorize(values)
    counts = np.bincount(codes[codes >= 0], minlength=1)
    bit = np.where(counts > 1, np.cumsum(counts > 1) - 1, -1)
    return [int(bit[c]) if c >= 0 else -1 for c in codes]


def _pack(capacity: int) -> Callable:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["n_tokens", "key", "copy", "piece"], ascending=[False, True, True, True], ignore_index=True)
        frame["bin"] = best_fit(frame["n_tokens"].tolist(), _numbered(frame["source"]), _numbered(frame["cluster"]), capacity)
        frame["slot"] = frame.groupby("bin").cumcount()
        return frame[["doc_id", "key", "piece", "start", "n_tokens", "source", "cluster", "shard", "bin", "slot"]]

    return run


def pack(sequences: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Bins of at most `capacity` tokens: (doc_id, key, piece, start, n_tokens, source, cluster, shard, bin, slot).

    `sequences` has doc_id, key (a long that tells texts apart), n_tokens, source
    and cluster. A sequence longer than the capacity is cut into pieces of the
    capacity and a rest; `start` is a piece's first token. No bin holds two pieces
    of one source or of one cluster; null sources and clusters conflict with
    nothing. (shard, bin) names a bin, `slot` counts its pieces from 0. Empty or
    null sequences take a place of 0 tokens, subject to the same rule. Repeated
    rows are packed like others. A shard holds about `shard_pieces` pieces drawn
    by hash, whatever their source or cluster, so hot ones spread evenly. No rows
    give none.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    n = F.greatest(F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)), F.lit(0))
    # the row number only tells repeated rows apart, so that copies spread over the shards
    rows = sequences.select("doc_id", "key", n.alias("length"), "source", "cluster", F.monotonically_increasing_id().alias("copy"))
    last = F.greatest(F.floor((F.col("length") - 1) / capacity), F.lit(0))
    pieces = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    pieces = pieces.select(
        "doc_id", "key", "copy", "piece", (F.col("piece") * capacity).alias("start"),
        F.least(F.col("length") - F.col("piece") * capacity, F.lit(capacity)).alias("n_tokens"), "source", "cluster",
    )
    shards = max(1, -(-(rows.agg(F.sum(last + 1)).first()[0] or 0) // shard_pieces))
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("key", "copy", "piece"), F.lit(shards)))
    kinds = {f.name: f.dataType.simpleString() for f in sequences.schema.fields}
    schema = (f"doc_id {kinds['doc_id']}, key bigint, piece bigint, start bigint, n_tokens bigint, source {kinds['source']}, "
              f"cluster {kinds['cluster']}, shard bigint, bin bigint, slot bigint")
    return pieces.groupBy("shard").applyInPandas(_pack(capacity), schema)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
