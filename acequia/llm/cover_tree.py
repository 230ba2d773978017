"""Exact near-duplicate vectors by dual traversal of cover trees.

Vectors are put on the unit sphere; cosine >= c means a distance of at most
sqrt(2 - 2c). Pivots cut the set into cells, cells into blocks of bounded size, and
each block carries a cover tree: nested levels whose radii halve, every node with
the true radius that covers its descendants. A pair of trees is traversed from the
roots: node pairs too far apart for their covering radii are pruned, node pairs
whose members must all link are counted as a whole, the rest go down a level.
"""

from __future__ import annotations

import math
import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acequia.llm.common import components
from acequia.session import materialize

BLOCK_ROWS = 2048
MOST_PIVOTS = 256  # bounds the pivots and the table of cell pairs (its square) on the driver
LEVELS = 7  # radii 2, 1, 1/2, ... below the root
_WIDE = 48  # children from which two families meet in a matrix product
_LISTED = 500_000  # child pairs listed at once
_MARGIN = 1e-5  # on cosines in single precision
_SLACK = 1e-9  # the bounds leave this much to rounding; what lies between is compared itself


def unit(vectors: np.ndarray) -> np.ndarray:
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Tree:
    """Cover tree of one block, stored level by level.

    points[level] are the node centres (row numbers; a centre stays one on all lower
    levels), radius[level] the true covering radii, first[level] where each node's
    children begin on the next level. order lists the rows so that the members of
    every node are neighbours: from start[level][i] up to start[level][i + 1].
    """

    def __init__(self, x: np.ndarray, levels: int = LEVELS):
        n = len(x)
        dist = np.sqrt(np.maximum(2.0 - 2.0 * (x @ x.T), 0.0))
        np.fill_diagonal(dist, 0.0)
        groups = [(0, np.arange(n))]
        self.points, self.radius, self.first, sizes = [], [], [], []
        for level in range(levels + 1):
            self.points.append(np.array([c for c, _ in groups], np.int32))
            self.radius.append(np.array([dist[c, rows].max() for c, rows in groups]))
            sizes.append(np.array([len(rows) for _, rows in groups]))
            if level == levels or not self.radius[-1].any():
                break
            below, first = [], [0]
            for centre, rows in groups:
                below.extend([(centre, rows)] if len(rows) == 1 else _net(dist, centre, rows, 2.0 ** -level))
                first.append(len(below))
            self.first.append(np.array(first, np.int32))
            groups = below
        self.order = np.concatenate([rows for _, rows in groups]).astype(np.int32)
        self.start = [np.concatenate([[0], np.cumsum(s)]).astype(np.int32) for s in sizes]
        self.x, self.near = x, x.astype(np.float32)


def _net(dist: np.ndarray, centre: int, rows: np.ndarray, radius: float) -> list:
    """Centres more than `radius` apart that cover the rows, the node's own centre first, with their members."""
    out = []
    while len(rows):
        near = dist[centre, rows] <= radius
        near |= rows == centre
        out.append((centre, rows[near]))
        rows = rows[~near]
        if len(rows):
            centre = rows[0]
    return out


def traverse(a: Tree, b: Tree, cosine: float, wa: np.ndarray, wb: np.ndarray, same: bool):
    """Weighted links of each row of a and of b, and enough links to connect what is linked: (count_a, count_b, pairs)."""
    reach = math.sqrt(2.0 - 2.0 * cosine)
    count_a, count_b = np.zeros(len(a.x), np.int64), np.zeros(len(b.x), np.int64)
    sum_a, sum_b = (np.concatenate([[0], np.cumsum(w[t.order])]) for w, t in ((wa, a), (wb, b)))
    pairs: list[tuple[int, int]] = []
    ia, ib, level = np.array([0]), np.array([0]), 0
    while len(ia):
        last_a, last_b = level >= len(a.first), level >= len(b.first)
        la, lb = min(level, len(a.first)), min(level, len(b.first))
        keep_a, keep_b = [], []
        for s in range(0, len(ia), 1 << 16):
            i, j = ia[s:s + (1 << 16)], ib[s:s + (1 << 16)]
            d = _distances(a.x[a.points[la]], b.x[b.points[lb]], i, j)
            spread = a.radius[la][i] + b.radius[lb][j]
            far = d - spread > reach + _SLACK
            # all members link: count the subtrees whole and connect them through their centres
            whole = ~far & (d + spread < reach - _SLACK)
            if same:
                whole &= (i != j) | (spread == 0)
            for u, v in zip(i[whole], j[whole]):
                au, ae = a.start[la][u], a.start[la][u + 1]
                bu, be = b.start[lb][v], b.start[lb][v + 1]
                ra, rb = a.order[au:ae], b.order[bu:be]
                count_a[ra] += sum_b[be] - sum_b[bu]
                count_b[rb] += wb[rb] if same and u == v else sum_a[ae] - sum_a[au]
                pairs.extend((r, rb[0]) for r in ra)
                pairs.extend((ra[0], r) for r in rb[1:])
            rest = ~far & ~whole
            keep_a.append(i[rest])
            keep_b.append(j[rest])
        ia, ib = np.concatenate(keep_a), np.concatenate(keep_b)
        if last_a and last_b:
            for u, v in zip(ia, ib):
                ra = a.order[a.start[la][u]:a.start[la][u + 1]]
                rb = b.order[b.start[lb][v]:b.start[lb][v + 1]]
                hit = a.x[ra] @ b.x[rb].T >= cosine
                count_a[ra] += hit @ wb[rb]
                count_b[rb] += wb[rb] if same and u == v else hit.T @ wa[ra]
                pairs.extend(_spanning(hit, ra, rb))
            break
        ia, ib = _children(a, b, la, lb, last_a, last_b, ia, ib, reach)
        if same:
            # below equal or mirrored nodes every pair comes twice
            na, nb = min(level + 1, len(a.first)), min(level + 1, len(b.first))
            assert na == nb
            once = ia <= ib
            ia, ib = ia[once], ib[once]
        level += 1
    if same:
        # each pair of different nodes was met once; within a node the first sum holds all, the second the row itself
        count_a = count_a + count_b
        count_b = np.zeros_like(count_b)
    return count_a, count_b, pairs


def _distances(xa: np.ndarray, xb: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * np.einsum("ij,ij->i", xa[i], xb[j]), 0.0))


def _families(first: np.ndarray | None, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the children of each node begin and how many there are; on the last level a node is its own child."""
    if first is None:
        return nodes, np.ones(len(nodes), np.int64)
    return first[nodes], first[nodes + 1] - first[nodes]


def _children(a: Tree, b: Tree, la: int, lb: int, last_a: bool, last_b: bool, ia, ib, reach: float):
    """Pairs of children of the given node pairs that the covering bounds leave.

    Wide families (the root's, as a rule) meet in one matrix product, in single
    precision with a margin, since all that is left is measured again; the others are listed.
    """
    na, nb = (la if last_a else la + 1), (lb if last_b else lb + 1)
    pa, pb, ra, rb = a.points[na], b.points[nb], a.radius[na], b.radius[nb]
    start_a, n_a = _families(None if last_a else a.first[la], ia)
    start_b, n_b = _families(None if last_b else b.first[lb], ib)
    wide = (n_a > _WIDE) & (n_b > _WIDE)
    out_a, out_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for u, nu, v, nv in zip(start_a[wide], n_a[wide], start_b[wide], n_b[wide]):
        ka, kb = np.arange(u, u + nu), np.arange(v, v + nv)
        dots = a.near[pa[ka]] @ b.near[pb[kb]].T
        x, y = np.nonzero(_within(dots, ra[ka], rb[kb], reach + _SLACK))
        out_a.append(ka[x])
        out_b.append(kb[y])
    start_a, n_a, start_b, n_b = (x[~wide] for x in (start_a, n_a, start_b, n_b))
    many = n_a * n_b
    cuts = np.searchsorted(np.cumsum(many), np.arange(0, many.sum() + _LISTED, _LISTED))
    for s, e in zip(cuts, [*cuts[1:], len(many)]):
        if s == e:
            continue
        m = many[s:e]
        family = np.repeat(np.arange(s, e), m)
        place = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        ka, kb = start_a[family] + place // n_b[family], start_b[family] + place % n_b[family]
        keep = _distances(a.x[pa], b.x[pb], ka, kb) <= reach + ra[ka] + rb[kb] + _SLACK
        out_a.append(ka[keep])
        out_b.append(kb[keep])
    return np.concatenate(out_a), np.concatenate(out_b)


def _within(dots: np.ndarray, ra: np.ndarray, rb: np.ndarray, reach: float) -> np.ndarray:
    """distance <= reach + ra + rb, as a bound on a cosine in single precision; most nodes are single vectors of radius 0."""
    reach, ra, rb = np.float32(math.sqrt(reach ** 2 + 2 * _MARGIN)), ra.astype(np.float32), rb.astype(np.float32)
    out = dots >= 1 - reach ** 2 / 2
    wide_a, wide_b = np.nonzero(ra)[0], np.nonzero(rb)[0]
    if len(wide_a):
        out[wide_a] = dots[wide_a] >= 1 - (reach + ra[wide_a][:, None] + rb[None, :]) ** 2 / 2
    if len(wide_b):
        out[:, wide_b] = dots[:, wide_b] >= 1 - (reach + ra[:, None] + rb[wide_b][None, :]) ** 2 / 2
    return out


def _spanning(hit: np.ndarray, ra: np.ndarray, rb: np.ndarray) -> list[tuple[int, int]]:
    """At most rows + columns of the links, connecting what they all connect."""
    out, owner = [], {}
    for i in range(len(ra)):
        cols = np.nonzero(hit[i])[0]
        if len(cols):
            fresh = [c for c in cols if c not in owner]
            old = {owner[c]: c for c in cols if c in owner}
            owner.update(dict.fromkeys(fresh, i))
            out.extend((ra[i], rb[c]) for c in [*fresh, *old.values()])
    return out


def forest(pairs: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs over nodes 0 to n - 1."""
    up = list(range(n))

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    out = []
    for a, b in pairs:
        ra, rb = find(a), find(b)
        if ra != rb:
            up[ra] = rb
            out.append((a, b))
    return out


def _small(x: np.ndarray) -> np.ndarray:
    """The vectors in single precision if that loses nothing."""
    half = x.astype(np.float32)
    return half if (half == x).all() else x


def _build(frame: pd.DataFrame) -> pd.DataFrame:
    """One block: its rows' ids and weights, and its tree."""
    frame = frame.sort_values("node")
    raw = np.stack(frame["embedding"].to_numpy()).astype(np.float64)
    tree = Tree(unit(raw))
    first = frame.iloc[0]
    kept = {k: v for k, v in vars(tree).items() if k not in ("x", "near")}
    body = pickle.dumps((frame["node"].to_numpy(), frame["members"].to_numpy(), _small(raw), kept))
    return pd.DataFrame({"cell": [first.cell], "block": [first.block], "body": [body]})


def _load(body: bytes) -> tuple[np.ndarray, np.ndarray, Tree]:
    node, members, raw, parts = pickle.loads(body)
    tree = Tree.__new__(Tree)
    vars(tree).update(parts)
    tree.x = unit(raw.astype(np.float64))
    tree.near = tree.x.astype(np.float32)
    return node, members, tree


def _linked(cosine: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for left, right, same in zip(frame["left"], frame["right"], frame["same"]):
                node_a, wa, ta = _load(left)
                node_b, wb, tb = (node_a, wa, ta) if same else _load(right)
                count_a, count_b, pairs = traverse(ta, tb, cosine, wa, wb, same)
                if same:
                    count_a = count_a - 2 * wa
                    edges = forest([(int(a), int(b)) for a, b in pairs if a != b], len(node_a))
                    ends = [(node_a[a], node_a[b]) for a, b in edges]
                else:
                    edges = forest([(int(a), len(node_a) + int(b)) for a, b in pairs], len(node_a) + len(node_b))
                    ends = [(node_a[a], node_b[b - len(node_a)]) for a, b in edges]
                counts = [(x, c) for x, c in zip(np.concatenate([node_a, node_b]), np.concatenate([count_a, count_b])) if c]
                yield pd.DataFrame({
                    "a": pd.Series([x for x, _ in counts] + [x for x, _ in ends], dtype="int64"),
                    "b": pd.Series([None] * len(counts) + [y for _, y in ends], dtype="Int64"),
                    "n": pd.Series([c for _, c in counts] + [0] * len(ends), dtype="int64"),
                })

    return run


def _cells(classes: DataFrame, pivots: np.ndarray) -> DataFrame:
    """The nearest pivot of every vector and the distance to it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            if len(frame):
                x = unit(np.stack(frame["embedding"].to_numpy()).astype(np.float64))
                dots = x @ pivots.T
                cell = dots.argmax(axis=1)
                off = np.sqrt(np.maximum(2.0 - 2.0 * dots[np.arange(len(x)), cell], 0.0))
                yield frame.assign(cell=cell.astype("int32"), off=off)

    return classes.mapInPandas(run, "node bigint, embedding array<double>, members bigint, cell int, off double")


def _links_of_dimension(classes: DataFrame, n: int, cosine: float) -> DataFrame:
    spark = classes.sparkSession
    k = min(MOST_PIVOTS, -(-n // BLOCK_ROWS))
    # a bounded sample: the classes with the least hashes
    drawn = classes.orderBy(F.xxhash64("node"), "node").limit(k).select("embedding").collect()
    pivots = unit(np.array([r.embedding for r in drawn], np.float64))
    celled = materialize(_cells(classes, pivots), "cells")
    sizes = {r.cell: (r.n, r.off) for r in celled.groupBy("cell").agg(F.count("*").alias("n"), F.max("off").alias("off")).collect()}
    counts = spark.createDataFrame([(c, -(-s // BLOCK_ROWS)) for c, (s, _) in sizes.items()], "cell int, blocks int")
    spread = celled.join(F.broadcast(counts), "cell").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    trees = materialize(
        spread.select("node", "embedding", "members", "cell", "block").groupBy("cell", "block").applyInPandas(
            _build, "cell int, block int, body binary"
        ),
        "trees",
    )
    # covering bound between cells; a table of at most MOST_PIVOTS squared rows
    apart = np.sqrt(np.maximum(2.0 - 2.0 * (pivots @ pivots.T), 0.0))
    reach = math.sqrt(2.0 - 2.0 * cosine) + _SLACK
    near = [(int(c), int(d)) for c in sizes for d in sizes if c <= d and apart[c, d] <= sizes[c][1] + sizes[d][1] + reach]
    cells = spark.createDataFrame(near, "cell int, other int")
    left = trees.select("cell", F.col("block").alias("left_block"), F.col("body").alias("left"))
    right = trees.select(F.col("cell").alias("other"), F.col("block").alias("right_block"), F.col("body").alias("right"))
    same = (F.col("cell") == F.col("other")) & (F.col("left_block") == F.col("right_block"))
    pairs = (
        left.join(cells, "cell").join(right, "other")
        .filter((F.col("cell") < F.col("other")) | (F.col("left_block") <= F.col("right_block")))
        .select("left", "right", same.alias("same"))
    )
    return materialize(pairs.mapInPandas(_linked(cosine), "a bigint, b bigint, n bigint"), "vector_links")


def vector_components(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """Groups of near-duplicate vectors: (vec_id, n_links, component_id, kept), one row per input row.

    Two rows link when the cosine of their vectors, in double precision, is at
    least `cosine`; n_links counts the other rows linked directly, component_id is
    the least vec_id reachable, kept says that the row holds it. Vectors that are
    null, empty, zero or hold null, NaN or infinite components link with nothing;
    vectors of different lengths do not link. Equal vectors are compared once.
    Rows without id take part; no rows give none.
    """
    if not 0.0 < cosine < 1.0:
        raise ValueError("cosine must lie between 0 and 1")
    value = F.col("embedding").cast("array<double>")
    size = F.aggregate("v", F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x)))
    fine = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), value.alias("v")).select(
        "vec_id", F.when(fine, F.when(size > 0, F.col("v"))).alias("v")
    )
    rows = rows.withColumn("node", F.when(F.col("v").isNotNull(), F.xxhash64(F.transform("v", lambda x: x + 0.0))))
    classes = materialize(
        rows.filter("v is not null").groupBy("node").agg(
            F.first("v").alias("embedding"), F.count("*").alias("members"), F.min("vec_id").alias("least")
        ),
        "vectors",
    )
    parts = classes.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).collect()
    spark = vectors.sparkSession
    links = spark.createDataFrame([], "a bigint, b bigint, n bigint")
    for part in parts:
        own = classes.filter(F.size("embedding") == part.d).select("node", "embedding", "members")
        links = links.union(_links_of_dimension(own, part.n, cosine))
    counts = links.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    groups = components(links.filter("b is not null").select("a", "b"))
    named = classes.select("node", "members", "least").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    found = named.join(least, "root").join(counts, "node", "left").select(
        "node", "component_id", (F.coalesce("n", F.lit(0)) + F.col("members") - 1).alias("n_links")
    )
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return rows.select("vec_id", "node").join(found, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
