"""Merkle manifest of a dataset, with digests that resume where a child is replaced.

Leaves are ranked inside their tree, and 8 consecutive nodes become the digest of
their texts until one is left. A parent keeps a copy of its hash state before each
child slot; to replace a child, the state of its slot is resumed with the new digest
and the siblings to its right, those to the left are never hashed again. Spark deals
the leaves out in blocks that are whole subtrees; the blocks' roots are the leaves of
the next stage, and every block gets the nodes on its way to the root, so that a leaf
is folded in its block's task.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acequia.llm.common import broadcast_if_small
from acequia.llm.ranges import sampled, splitters, with_range
from acequia.session import materialize

FANOUT = 8
BLOCK_LEVELS = 4  # a block has up to 8 ** 4 leaves
DIGEST = 64  # characters of a digest
# Up to so many rows are ranked by one task; more are put into 64 ranges or more, of a million rows at most on average.
ONE_RANGE = 8192
LEAST_RANGES = 64
RANGE_ROWS = 1 << 20
SAMPLES_PER_RANGE = 16


def leaf_digest(*values: Column) -> Column:
    """Digest of values: each `-` if null, else its UTF-8 length, `:` and itself; integers are decimal."""
    parts = []
    for v in values:
        text = v.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def ranked(rows: DataFrame, tree: str, keys: Sequence[str]) -> DataFrame:
    """Add `rank` (from 0 by the keys, inside the tree) and `n` (the tree's rows); keys tell all rows apart."""
    order = [tree, *keys]
    total = rows.count()
    ranges = 1 if total <= ONE_RANGE else max(LEAST_RANGES, total // RANGE_ROWS)
    cuts = []
    if ranges > 1:
        narrow = rows.select(*order, F.lit(1).alias("_one"))
        step = max(total / (ranges * SAMPLES_PER_RANGE), 1.0)
        cuts = splitters(sampled(narrow, order, "_one", step, 5), order, ranges, "_one", step)
    placed = with_range(rows, order, cuts)
    counts = materialize(placed.groupBy("range", tree).agg(F.count("*").alias("held")), "range_counts")
    earlier = Window.partitionBy(tree).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a tree's ranges, not its rows
    starts = materialize(counts.select(
        "range", tree, F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("row0"), F.sum("held").over(Window.partitionBy(tree)).alias("n")), "starts")
    inside = Window.partitionBy("range", tree).orderBy(*keys)
    numbered = placed.withColumn("_place", F.row_number().over(inside) - 1)
    return numbered.join(broadcast_if_small(starts), ["range", tree]).withColumn("rank", F.col("row0") + F.col("_place")).drop("range", "row0", "_place")


def levels_of(n: int) -> int:
    """Rounds until one node is left."""
    rounds = 0
    while n > 1:
        n, rounds = -(-n // FANOUT), rounds + 1
    return rounds


class Parent:
    """Concatenated digests of the children, the hash state before each of them, and the digest of all."""

    def __init__(self, children: bytes):
        self.children, self.states = children, []
        state = hashlib.sha256()
        for at in range(0, len(children), DIGEST):
            self.states.append(state.copy())
            state.update(children[at:at + DIGEST])
        self.digest = state.hexdigest().encode()

    def siblings(self, slot: int) -> bytes:
        return self.children[:slot * DIGEST] + self.children[(slot + 1) * DIGEST:]

    def fold(self, slot: int, digest: bytes) -> bytes:
        """The digest with another child in the slot."""
        state = self.states[slot].copy()
        state.update(digest)
        state.update(self.children[(slot + 1) * DIGEST:])
        return state.hexdigest().encode()


def subtree(nodes: list[bytes], rounds: int) -> list[list[Parent]]:
    """Parents of each round over consecutive nodes, the first of which begins a run."""
    out = []
    for _ in range(rounds):
        parents = [Parent(b"".join(nodes[i:i + FANOUT])) for i in range(0, len(nodes), FANOUT)]
        out.append(parents)
        nodes = [p.digest for p in parents]
    return out


def _roots(depth: int) -> Callable:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rank")
        tree, block, n = frame["tree"].iloc[0], int(frame["block"].iloc[0]), int(frame["n"].iloc[0])
        rounds = min(depth, levels_of(n))
        parents = subtree([h.encode() for h in frame["h"]], rounds)
        digest = parents[-1][0].digest.decode() if rounds else frame["h"].iloc[0]
        return pd.DataFrame({"tree": [tree], "rank": [block], "n": [-(-n // FANOUT ** rounds)], "h": [digest]})

    return run


def _in_blocks(nodes: DataFrame, depth: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("rank") / FANOUT ** depth).cast("long"))


def stages(nodes: DataFrame, depth: int = BLOCK_LEVELS) -> list[DataFrame]:
    """(tree, rank, n, h) of the nodes, of their blocks' roots and so on until every tree has one node; at least two tables."""
    out = [nodes.select("tree", "rank", "n", "h")]
    while True:
        roots = _in_blocks(out[-1], depth).groupBy("tree", "block").applyInPandas(_roots(depth), "tree string, rank bigint, n bigint, h string")
        out.append(materialize(roots, "nodes"))
        if out[-1].filter("n > 1").isEmpty():
            return out


def _spelled(slot: int, parent: Parent) -> str:
    return f"{slot}:{parent.children.decode()}"


def _way(levels: Sequence[str]) -> list[tuple[int, Parent]]:
    out = []
    for level in levels:
        slot, children = level.split(":")
        out.append((int(slot), Parent(children.encode())))
    return out


def _extended(depth: int) -> Callable:
    def run(nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("rank")
        parents = subtree([h.encode() for h in nodes["h"]], min(depth, levels_of(int(nodes["n"].iloc[0])))) if len(nodes) else []
        ways = [
            [_spelled(i // FANOUT ** level % FANOUT, row[i // FANOUT ** (level + 1)]) for level, row in enumerate(parents)] + list(above["way"].iloc[0])
            for i in range(len(nodes))
        ]
        n = len(nodes)
        return pd.DataFrame({"tree": nodes["tree"], "rank": nodes["rank"], "way": ways, "subroot": [above["subroot"].iloc[0]] * n,
                             "root": [above["root"].iloc[0]] * n})

    return run


_WAYS = "tree string, rank bigint, way array<string>, subroot string, root string"


def ways(nodes: list[DataFrame], top: DataFrame, last: int, depth: int = BLOCK_LEVELS) -> DataFrame:
    """From stage `last` the way up of every node: `top` has those of the trees' roots; one string per level, `slot:children`."""
    for stage in reversed(nodes[last:-1]):
        above = top.withColumnRenamed("rank", "block").groupBy("tree", "block")
        top = materialize(_in_blocks(stage, depth).groupBy("tree", "block").cogroup(above).applyInPandas(_extended(depth), _WAYS), "ways")
    return top


_FOLDED = "doc_id bigint, tree string, rank bigint, leaf string, subroot string, root string, folded_root string, proof_sha256 string"


def _folded(depth: int, proofs: bool) -> Callable:
    def run(leaves: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        leaves = leaves.sort_values("rank", ignore_index=True)
        nodes = [h.encode() for h in leaves["h"]]
        parents = subtree(nodes, min(depth, levels_of(int(leaves["n"].iloc[0])))) if nodes else []
        upper = _way(above["way"].iloc[0])
        beyond = b"".join(p.siblings(slot) for slot, p in upper)
        roots, hashes, listed = [], [], []
        for i, (digest, other) in enumerate(zip(nodes, leaves["replacement"])):
            digest = other.encode() if isinstance(other, str) else digest
            proof = []
            for row in parents:
                i, slot = divmod(i, FANOUT)
                proof.append(row[i].siblings(slot))
                digest = row[i].fold(slot, digest)
            for slot, parent in upper:
                digest = parent.fold(slot, digest)
            joined = b"".join(proof) + beyond
            roots.append(digest.decode())
            hashes.append(hashlib.sha256(joined).hexdigest())
            if proofs:
                text = joined.decode()
                listed.append([text[at:at + DIGEST] for at in range(0, len(text), DIGEST)])
        out = leaves[["doc_id", "tree", "rank"]].assign(
            leaf=leaves["h"], subroot=above["subroot"].iloc[0], root=above["root"].iloc[0], folded_root=roots, proof_sha256=hashes)
        return out.assign(proof=listed) if proofs else out

    return run


@dataclass(frozen=True)
class Manifest:
    """Ranked leaves (tree, doc_id, rank, n, h, replacement) and the ways of their blocks to the root."""

    leaves: DataFrame
    ways: DataFrame
    depth: int

    def fold(self, proofs: bool = False) -> DataFrame:
        """For every leaf the root and the root after replacing this leaf alone.

        Columns: doc_id, tree, rank, leaf, subroot (of its tree), root, folded_root
        (recomputed from the leaf's replacement, or from the leaf if that is null) and
        proof_sha256, the digest of the siblings on the way up, level by level, from
        left to right; with `proofs` these siblings too, as `proof`.
        """
        above = self.ways.withColumnRenamed("rank", "block").groupBy("tree", "block")
        schema = _FOLDED + (", proof array<string>" if proofs else "")
        return _in_blocks(self.leaves, self.depth).groupBy("tree", "block").cogroup(above).applyInPandas(_folded(self.depth, proofs), schema)


def manifest(leaves: DataFrame, depth: int = BLOCK_LEVELS) -> Manifest:
    """Trees over digests: `leaves` has tree, doc_id, leaf and replacement (a digest or null).

    Leaves of a tree ascend by doc_id (null first), equal ids by their digests;
    repeated rows are leaves each. 8 consecutive nodes become one until one is
    left, the subroot; a lone leaf is its own. The subroots in the order of the
    trees (null first, then by UTF-8 bytes) form the last tree in the same way,
    whose root is the root. A hot tree is dealt out like others, in blocks. Other
    columns are ignored; no rows give no root.
    """
    # an order-preserving name without nulls
    tree = F.when(F.col("tree").isNull(), "0").otherwise(F.concat(F.lit("1"), F.col("tree")))
    rows = materialize(leaves.select(
        tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), F.col("leaf").alias("h"), "replacement", F.monotonically_increasing_id().alias("row")),
        "leaves")
    own = materialize(ranked(rows, "tree", ["doc_id", "h", "row"]).drop("row"), "ranked")
    nodes = stages(own, depth)
    roots = nodes[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "h")
    last = materialize(ranked(roots, "tree", ["of"]), "subroots")
    above = stages(last, depth)
    top = above[-1].select("tree", "rank", F.array().cast("array<string>").alias("way"), F.lit("").alias("subroot"), F.col("h").alias("root"))
    found = ways(above, top, 0, depth).drop("tree", "subroot")
    subroots = last.select("of", "rank", F.col("h").alias("subroot")).join(found, "rank")
    top = subroots.select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("rank"), "way", "subroot", "root")
    return Manifest(own, ways(nodes, top, 1, depth), depth)


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def document_leaves(docs: DataFrame) -> DataFrame:
    """Leaves of documents in a tree per language, where every third id (by its checksum) is tampered with: lower-cased A-Z.

    A row without id is never tampered with; null texts stay null. Texts without
    capitals keep their digest.
    """
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    changed = leaf_digest(*[lowered if c == "text" else F.col(c) for c in FIELDS])
    return docs.select(F.col("lang").alias("tree"), "doc_id", leaf_digest(*[F.col(c) for c in FIELDS]).alias("leaf"),
                       F.when(struck, changed).alias("replacement"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
