"""The manifest against plain hashing of whole trees."""

import hashlib
import random
import zlib

import pytest

from acequia.llm.merkle import FIELDS, Parent, document_leaves, manifest
from tests.llm.helpers import awkward, documents, nothing


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [text if c == "text" else row[c] for c in FIELDS]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def root_of(nodes):
    while len(nodes) > 1:
        nodes = [H(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0]


def siblings(nodes, i):
    out = []
    while len(nodes) > 1:
        run = i // 8 * 8
        out += [h for j, h in enumerate(nodes[run:run + 8], run) if j != i]
        nodes, i = [H(*nodes[k:k + 8]) for k in range(0, len(nodes), 8)], i // 8
    return out


def brute(rows):
    order = lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text))
    langs = sorted({r.lang for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = {v: sorted((r for r in rows if r.lang == v), key=order) for v in langs}
    leaves = {v: [leaf(r, r.text) for r in own] for v, own in trees.items()}
    subroots = [root_of(leaves[v]) for v in langs]
    out = []
    for k, v in enumerate(langs):
        for i, r in enumerate(trees[v]):
            text = r.text
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            changed = [*leaves[v][:i], leaf(r, text), *leaves[v][i + 1:]]
            folded = root_of([*subroots[:k], root_of(changed), *subroots[k + 1:]])
            proof = siblings(leaves[v], i) + siblings(subroots, k)
            out.append((str(r.doc_id), leaves[v][i], subroots[k], root_of(subroots), H(*proof), folded, proof))
    return sorted(out)


def found(docs, depth):
    rows = manifest(document_leaves(docs), depth).fold(proofs=True).collect()
    return sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, list(r.proof)) for r in rows)


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_equals_plain_trees(spark, depth):
    rng = random.Random(depth)
    sizes = {"en": 100, "de": 9, "fr": 8, "é": 1, "z": 65, "Z": 7}
    texts, langs = [], {}
    for lang, n in sizes.items():
        for _ in range(n):
            i = len(texts)
            texts.append((i, rng.choice(["Capital Letters É", "none here", "", None])))
            langs[i] = lang
    rng.shuffle(texts)
    docs = documents(spark, texts, langs)
    got = found(docs, depth)
    assert got == brute(docs.collect())
    assert any(r[3] != r[5] for r in got) and any(r[3] == r[5] for r in got)


def test_many_trees(spark):
    docs = documents(spark, [(i, "A") for i in range(150)], {i: f"l{i // 2}" for i in range(150)})
    assert found(docs, 1) == brute(docs.collect())


def test_awkward_rows(spark):
    docs = awkward(spark)
    nulls = spark.createDataFrame([(50, "No Language", None, None, None, "k", 1, 0.5)], docs.schema)
    assert found(docs.union(nulls), 4) == brute(docs.union(nulls).collect())
    assert manifest(document_leaves(nothing(spark))).fold().count() == 0


def test_rows_over_ranges(spark, monkeypatch):
    import acequia.llm.merkle as m

    monkeypatch.setattr(m, "ONE_RANGE", 10)
    docs = documents(spark, [(i, f"Text {i % 5}") for i in range(400)] + [(7, "Text 2")] * 20)
    assert found(docs, 2) == brute(docs.collect())


def test_parent_resumes_at_every_slot():
    children = [H(str(i)).encode() for i in range(5)]
    parent = Parent(b"".join(children))
    new = H("new").encode()
    for slot in range(5):
        whole = b"".join([*children[:slot], new, *children[slot + 1:]])
        assert parent.fold(slot, new).decode() == hashlib.sha256(whole).hexdigest()
        assert parent.siblings(slot) == b"".join(children[:slot] + children[slot + 1:])
