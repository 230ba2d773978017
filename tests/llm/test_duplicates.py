import random
import re

import numpy as np
import pytest

from acequia.llm.common import components
from acequia.llm.cover_tree import Tree, traverse, unit, vector_components
from acequia.llm.minhash import common_counts, minhash_components
from tests.llm.helpers import awkward, documents, nothing, words


def union_find(pairs):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(up)}


@pytest.mark.parametrize("pairs", [
    [], [(1, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 80)], [(5, 5), (7, 8), (8, 7), (9, 7), (-3, 8)],
    [(random.Random(i).randint(0, 90), random.Random(-i).randint(0, 90)) for i in range(70)],
])
def test_components(spark, pairs):
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == union_find([p for p in pairs if p[0] != p[1]])


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, k):
    sets = [shingles(t, k) for _, t in rows]
    pairs = [
        (i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
        and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    root = union_find(pairs)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root.get(j, j) == root.get(i, i) and rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((doc_id, len(sets[i]), least, doc_id == least))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def test_near_copies_equal_brute_force(spark):
    rng = random.Random(2)
    base = words("b", 120).split()
    rows = [(0, " ".join(base))]
    for i in range(1, 160):  # edits of one text: links and non-links side by side
        w = list(base)
        for _ in range(rng.randint(0, 7)):
            w[rng.randrange(len(w))] = f"e{i}x{rng.randint(0, 3)}"
        rows.append((i, " ".join(w)))
    rows += [(200 + i, words(f"c{i % 4}-", 30 + i % 3)) for i in range(20)] + [(300, "One two THREE"), (301, "one  two\nthree"), (302, "one two")]
    assert found(minhash_components(documents(spark, rows), 4)) == brute(rows, 4)


def test_near_copies_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows, 5)
    assert found(minhash_components(docs)) == want
    assert minhash_components(nothing(spark)).count() == 0


def test_common_counts():
    rng = np.random.default_rng(1)
    left = [np.unique(rng.integers(0, 60, rng.integers(1, 40))).astype(np.uint64) for _ in range(9)]
    right = [np.unique(rng.integers(0, 90, rng.integers(1, 40))).astype(np.uint64) for _ in range(7)]
    assert (common_counts(left, right) == [[len(np.intersect1d(x, y)) for y in right] for x in left]).all()
    assert (common_counts(left[:1], [np.array([10**12], np.uint64)]) == 0).all()


@pytest.mark.parametrize("n,m,d", [(250, 180, 6), (1, 40, 3), (40, 1, 64), (2, 2, 2), (120, 120, 1)])
def test_dual_traversal_equals_products(n, m, d):
    rng = np.random.default_rng(n)
    base = rng.normal(size=(30, d))
    x, y = (unit(base[rng.integers(0, 30, k)] + rng.normal(size=(k, d)) * 0.1) for k in (n, m))
    wx, wy = rng.integers(1, 5, n), rng.integers(1, 5, m)
    a, b = Tree(x), Tree(y)
    hit = x @ y.T >= 0.95
    ca, cb, pairs = traverse(a, b, 0.95, wx, wy, False)
    assert (ca == hit @ wy).all() and (cb == hit.T @ wx).all() and all(hit[i, j] for i, j in pairs)
    joined, full = (union_find([(int(i), n + int(j)) for i, j in p]) for p in (pairs, np.argwhere(hit)))
    assert joined == full
    own = x @ x.T >= 0.95
    ca, _, pairs = traverse(a, a, 0.95, wx, wx, True)
    assert (ca - 2 * wx == own @ wx - wx).all() and all(own[i, j] for i, j in pairs)


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 8))
    vectors = [(base[i % 40] + rng.normal(size=8) * 0.12).astype(np.float32).tolist() for i in range(150)]
    vectors += [vectors[3], vectors[3], [2 * x for x in vectors[3]]]
    rows = [(i + 10, v) for i, v in enumerate(vectors)]
    rows += [(5, vectors[3]), (1000, None), (1001, []), (1002, [0.0] * 8), (1003, [float("nan")] * 8), (1004, [1.0, None] + [0.0] * 6),
             (1005, [float("inf")] + [0.0] * 7), (1006, vectors[3][:4]), (None, vectors[3]), (None, None), (11, vectors[1])]

    def fine(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    def cosine(u, v):
        u, v = np.array(u, float), np.array(v, float)
        return u @ v / np.sqrt((u @ u) * (v @ v))

    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if fine(rows[i][1]) and fine(rows[j][1])
             and len(rows[i][1]) == len(rows[j][1]) and cosine(rows[i][1], rows[j][1]) >= 0.95]
    root = union_find(pairs)
    want = []
    for i, (vec_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root.get(j, j) == root.get(i, i) and rows[j][0] is not None]
        least = min(ids) if ids else None
        want.append((vec_id, sum(i in p for p in pairs), least, vec_id == least))
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<float>, node int")
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in vector_components(frame).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert vector_components(frame.limit(0)).count() == 0
    assert vector_components(frame.filter("embedding is null")).count() == 2


def test_near_dedup_leaves_no_finished_steps_on_disk(spark):
    from pathlib import Path

    from acequia.session import shared_dir

    rows = [(i, words("w", 40) + f" end{i}") for i in range(6)] + [(9, words("other", 30))]
    base = Path(shared_dir(spark).removeprefix("file:"))
    before = set(base.iterdir())
    found = minhash_components(documents(spark, rows))
    left = {p.name.rsplit("-", 1)[0] for p in set(base.iterdir()) - before}
    assert left.isdisjoint({"tables", "ends", "pairs", "sets", "links", "open", "blocks", "block_pairs", "late_links"}) and {"signed", "ids"} <= left
    assert sorted((r.doc_id, r.component_id) for r in found.collect()) == [(i, 0) for i in range(6)] + [(9, 9)]
