"""Near-duplicate documents: MinHash with tensored banding, links confirmed on full shingle sets.

Two small collections of keys, A and B, are made from a document's minhashes; the
key of table (i, j) joins key i of A with key j of B. `m` keys a side thus serve m * m
tables: with 2 minhashes a key and m = 12, 48 minhashes do the work of 576. A pair of
similarity 0.8 misses all tables with probability under 1e-5.

Documents with equal shingle sets form a class and are compared once. In every
table a bucket's least and greatest class are compared with all its members; what
these links leave in different components is then compared in blocks, by matrix
products within a task, so no link inside a bucket is lost, while the pairs of a
large group of near copies never become rows.
"""

from __future__ import annotations

import math
import pickle
import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acequia.llm.common import broadcast_if_small, components, lean
from acequia.session import discard, materialize

WORDS = re.compile(rb"[^\x20\x09-\x0d]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_MOST_WORDS_KEPT = 100_000  # word hashes kept by a task before the table is started anew
_MIX = np.uint64(0x9E3779B97F4A7C15)
_CELLS = 2_000_000
# Blocks of classes that are compared all with all: shingles a block holds at most about, the
# ratio between the set sizes of neighbouring blocks, and elements taken into one matrix product.
BLOCK_SHINGLES = 100_000
SIZE_STEP = 1.05
COLUMNS = 4096


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MOST_WORDS_KEPT:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


def _scramble(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, k: int, hashes: dict) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct k-word shingles; with fewer words one for the whole sequence."""
    words = WORDS.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    span = min(k, len(w))
    out = np.full(len(w) - span + 1, np.uint64(span))
    for i in range(span):
        out = _scramble(out * _MIX + w[i:len(w) - span + 1 + i])
    return np.unique(out)


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    return rng.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def minhashes(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least of each hash function over the set, in pieces so that long texts need no more memory."""
    out = np.full(len(a), np.iinfo(np.uint64).max)
    step = max(1, _CELLS // len(a))
    for i in range(0, len(shingles), step):
        x = shingles[i:i + step, None] * a + b
        out = np.minimum(out, (x ^ (x >> np.uint64(32))).min(axis=0))
    return out


def _signatures(k: int, m: int, per_key: int) -> Callable:
    """Per document its class (a hash of the set) and the 2 * m collection keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        a, b = _seeds(2 * m * per_key)
        for batch in batches:
            sizes, classes, keys = [], [], []
            for text in batch.column(2):
                s = shingle_set(text.as_py(), k, hashes)
                sizes.append(len(s))
                if not len(s):
                    classes.append(None)
                    keys.append(None)
                    continue
                classes.append(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64))
                low = minhashes(s, a, b).reshape(2 * m, per_key)
                key = np.arange(2 * m, dtype=np.uint64)
                for j in range(per_key):
                    key = _scramble(key * _MIX + low[:, j])
                keys.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "key", "n_shingles", "class", "keys"])

    return run


def _sets(k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            sets = [shingle_set(text.as_py(), k, hashes) for text in batch.column(0)]
            classes = [np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64) for s in sets]
            for i in range(0, len(sets), 256):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(classes[i:i + 256], pa.int64()), pa.array([s.tobytes() for s in sets[i:i + 256]], pa.binary())],
                    ["class", "shingles"])

    return run


def _confirmed(percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _survivors(classes: DataFrame) -> DataFrame:
    """Collection keys that another class shares: (class, n, side, key).

    A table needs a shared key of A and one of B, so that keys of a single class
    cannot make a candidate and go before the tables are formed.
    """
    m = F.size("keys") / 2
    slots = classes.select("class", "n", F.posexplode("keys").alias("slot", "key"), m.alias("m"))
    slots = slots.select("class", "n", (F.col("slot") >= F.col("m")).alias("side"), "key")
    shared = materialize(
        slots.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).filter("lo <> hi").select("key"), "shared"
    )
    return slots.join(shared, "key")


def _table_keys(survivors: DataFrame) -> DataFrame:
    """One key per table in which a class can meet another: pairs of its shared A and B keys."""
    sides = survivors.groupBy("class", "n").agg(
        F.collect_set(F.when(~F.col("side"), F.col("key"))).alias("left"), F.collect_set(F.when(F.col("side"), F.col("key"))).alias("right")
    )  # at most m keys a side
    return (
        sides.select("class", "n", "right", F.explode("left").alias("x"))
        .select("class", "n", "x", F.explode("right").alias("y"))
        .select(F.xxhash64("x", "y").alias("key"), "class", "n")
    )


def _may_link(percent: int):
    return F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent


def minhash_components(docs: DataFrame, shingle_words: int = 5, percent: int = 80, m: int = 12, per_key: int = 2,
                       key: Column | None = None) -> DataFrame:
    """Groups of near-duplicate rows: (doc_id, key, n_shingles, component_id, kept).

    Texts are lower-cased (A-Z) and cut at ASCII white space into words; two rows
    link when 100 * intersection >= percent * union of their sets of
    `shingle_words`-word shingles (with fewer words: the whole sequence as one).
    component_id is the least doc_id reachable over links, kept says that the row
    holds it. Null, empty and blank texts have no shingles and stay alone. Repeated
    rows share a component and are all kept or not; rows without id take part
    and get their component's id, null if it has none. `key` is any long column by
    which a caller tells rows apart (default null); other columns are ignored. No
    rows give none.
    """
    key = F.lit(None).cast("long") if key is None else key
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"), "text")
    signed = materialize(
        rows.mapInArrow(lean(_signatures(shingle_words, m, per_key)), "doc_id bigint, key bigint, n_shingles bigint, class bigint, keys array<bigint>"), "signed"
    )
    classes = signed.filter("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys")
    )
    tables = materialize(_table_keys(_survivors(classes)), "tables")
    ends = materialize(
        tables.groupBy("key").agg(F.min(F.struct("class", "n")).alias("lo"), F.max(F.struct("class", "n")).alias("hi"))
        .filter("lo.class <> hi.class"), "ends"
    )
    met = tables.join(ends, "key").select("class", "n", F.explode(F.array("lo", "hi")).alias("end"))
    first = materialize(_pairs(met.select("class", "n", F.col("end.class").alias("other"), F.col("end.n").alias("m")), percent), "pairs")
    sets = materialize(_class_sets(rows, signed, tables.join(ends.select("key"), "key").select("class").distinct(), shingle_words), "sets")
    links = materialize(_verify(first, sets, percent), "links")
    roots = components(links)
    # what the ends of the buckets left apart
    placed = tables.join(ends.select("key"), "key").join(roots.withColumnRenamed("node", "class"), "class", "left").select(
        "key", "class", "n", F.coalesce("root", "class").alias("root")
    )
    open_keys = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("key", "lo")
    placed = materialize(placed.join(open_keys, "key").select("class", "n", "root", "lo").distinct(), "open")
    late = _links_in_blocks(placed, sets, percent)
    groups = components(late).select(F.col("node").alias("root"), F.col("root").alias("top"))
    ids = classes.select("class", F.col("doc_id").alias("least")).join(roots.withColumnRenamed("node", "class"), "class", "left")
    ids = ids.select(F.coalesce("root", "class").alias("root"), "class", "least").join(groups, "root", "left")
    ids = materialize(ids.select("class", F.coalesce("top", "root").alias("root"), "least"), "ids")
    discard(tables, ends, first, sets, links, placed, late)
    least = ids.groupBy("root").agg(F.min("least").alias("component_id"))
    found = ids.join(least, "root").select("class", "component_id")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return signed.select("doc_id", "key", "n_shingles", "class").join(found, "class", "left").select(
        "doc_id", "key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def _links_in_blocks(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Components with linked classes that share a bucket: (a, b) as component roots, enough to connect what is linked.

    `placed` has class, n, root (its component) and lo (a component met in a
    bucket). Components that meet in buckets, directly or over others, form a pool;
    a pool's classes are compared in blocks of bounded size, block against block
    where the set sizes allow the similarity. Only links that connect components
    leave a task.
    """
    pools = components(placed.select("root", "lo").distinct(), "root", "lo")
    members = placed.select("class", "n", "root").distinct().join(pools.select(F.col("node").alias("root"), F.col("root").alias("pool")), "root")
    members = members.withColumn("size", F.floor(F.log("n") / math.log(SIZE_STEP)).cast("int"))
    chunks = members.groupBy("pool", "size").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("chunks"))
    members = members.join(chunks, ["pool", "size"]).withColumn("chunk", F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int"))
    members = members.select("class", "root", F.struct("pool", "size", "chunk").alias("block"))
    blocks = materialize(
        members.join(sets, "class").groupBy("block").applyInPandas(
            _blocked, "block struct<pool: bigint, size: int, chunk: int>, body binary"
        ),
        "blocks",
    )
    ids = blocks.select("block", F.col("block.pool").alias("pool"))
    other = ids.select(F.col("block").alias("other"), "pool")
    reach = math.ceil(math.log(100 / percent) / math.log(SIZE_STEP)) + 1
    near = F.abs(F.col("block.size") - F.col("other.size")) <= reach
    met = materialize(ids.join(other, "pool").filter((F.col("block") <= F.col("other")) & near).select("block", "other"), "block_pairs")
    bodies = blocks.select(F.col("block").alias("other"), F.col("body").alias("other_body"))
    both = met.join(blocks, "block").join(bodies, "other").select("body", "other_body", (F.col("block") == F.col("other")).alias("same"))
    late = materialize(both.mapInPandas(lean(_linked_blocks(percent)), "a bigint, b bigint"), "late_links")
    discard(blocks, met)
    return late


def _blocked(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("class")
    body = pickle.dumps((frame["class"].to_numpy(), frame["root"].to_numpy(), frame["shingles"].tolist()))
    return pd.DataFrame({"block": [frame["block"].iloc[0]], "body": [body]})


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of the left with all of the right, by matrix products over shared elements."""
    rows = [np.repeat(np.arange(len(side)), [len(s) for s in side]) for side in (left, right)]
    values = [np.concatenate(side) for side in (left, right)]
    shared = np.intersect1d(*values)
    out = np.zeros((len(left), len(right)), np.float32)
    found = []
    for row, value in zip(rows, values):
        at = np.searchsorted(shared, value)
        hit = (at < len(shared)) & (shared[np.minimum(at, max(len(shared) - 1, 0))] == value) if len(shared) else np.zeros(len(value), bool)
        order = np.argsort(at[hit], kind="stable")
        found.append((row[hit][order], at[hit][order]))
    for s in range(0, len(shared), COLUMNS):
        sides = []
        for (row, at), n in zip(found, (len(left), len(right))):
            lo, hi = np.searchsorted(at, [s, s + COLUMNS])
            dense = np.zeros((n, min(COLUMNS, len(shared) - s)), np.float32)
            dense[row[lo:hi], at[lo:hi] - s] = 1.0
            sides.append(dense)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def _linked_blocks(percent: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for body, other, same in zip(frame["body"], frame["other_body"], frame["same"]):
                a, root_a, sets_a = pickle.loads(body)
                b, root_b, sets_b = (a, root_a, sets_a) if same else pickle.loads(other)
                sets_a, sets_b = ([np.frombuffer(s, np.uint64) for s in side] for side in (sets_a, sets_b))
                both = common_counts(sets_a, sets_b)
                union = np.array([len(s) for s in sets_a])[:, None] + np.array([len(s) for s in sets_b])[None, :] - both
                hits = np.nonzero((100 * both >= percent * union) & (root_a[:, None] != root_b[None, :]))
                up: dict[int, int] = {}

                def find(x: int) -> int:
                    while up.setdefault(x, x) != x:
                        up[x] = up[up[x]]
                        x = up[x]
                    return x

                out = []
                for i, j in zip(*hits):
                    x, y = find(root_a[i]), find(root_b[j])
                    if x != y:
                        up[x] = y
                        out.append((root_a[i], root_b[j]))
                yield pd.DataFrame({"a": pd.Series([x for x, _ in out], dtype="int64"), "b": pd.Series([y for _, y in out], dtype="int64")})

    return run


def _pairs(met: DataFrame, percent: int) -> DataFrame:
    """Distinct class pairs (a < b) whose set sizes allow the similarity."""
    return (
        met.filter("class <> other")
        .select(
            F.least("class", "other").alias("a"), F.greatest("class", "other").alias("b"),
            F.col("n").alias("na"), F.col("m").alias("nb"),
        )
        .filter(_may_link(percent)).select("a", "b").distinct()
    )


def _class_sets(rows: DataFrame, signed: DataFrame, wanted: DataFrame, shingle_words: int) -> DataFrame:
    """Full shingle sets of the wanted classes, from one row of each: (class, shingles)."""
    holders = signed.join(broadcast_if_small(wanted), "class").groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    ids = broadcast_if_small(materialize(holders.select("doc_id").distinct(), "holders"))
    texts = rows.join(ids, rows.doc_id.eqNullSafe(ids.doc_id), "left_semi").select("text")
    return texts.mapInArrow(lean(_sets(shingle_words)), "class bigint, shingles binary").dropDuplicates(["class"])


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left, right = (sets.select(F.col("class").alias(c), F.col("shingles").alias(f"set_{c}")) for c in "ab")
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")
    return both.mapInArrow(lean(_confirmed(percent)), "a bigint, b bigint")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
