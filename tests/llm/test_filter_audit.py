"""The audit of filters against a plain walk through all orders."""

import random
import re
from itertools import permutations

from acequia.llm.filter_audit import _SLICE, audit_filters, failures, intervals, lehmer_rank, word_counts
from tests.llm.helpers import nothing

LABELS = "doc_id bigint, quality int, toxic int, source string"
DOCS = "doc_id bigint, text string, source string, mask int, part string, n bigint"


def failed(text, smaller_exists):
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", text) if w]
    out = set()
    if len(words) < 200:
        out.add("A")
    if 100 * len(set(words)) < 50 * len(words):
        out.add("B")
    if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text):
        out.add("C")
    if set(text) & set("#$%&*|"):
        out.add("D")
    if smaller_exists:
        out.add("E")
    return out


def brute(docs, labels):
    good, toxic = {d for d, q, _, _ in labels if q == 1} - {None}, {d for d, _, t, _ in labels if t == 1} - {None}
    rows = [(d, t or "", s or "") for d, t, s in docs]
    marked = [(d, s, failed(t, d is not None and any(o is not None and o < d and u == t for o, u, _ in rows))) for d, t, s in rows]
    out = {}
    for part in {s for _, s, _ in marked}:
        own = [(d, f) for d, s, f in marked if s == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [d for d, f in left if letter in f]
                left = [(d, f) for d, f in left if letter not in f]
                shapley[letter] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(letter in f for _, f in own) - len(gone), sum(f == {letter} for _, f in own),
                    len([d for d in gone if d in good]), len([d for d in gone if d in toxic]), letter]
        for key, row in out.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]]
    return out


def found(df):
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in rows}
    assert len(out) == len(rows)
    return out


def corpus():
    rng = random.Random(4)
    docs = []
    for i in range(150):
        n = rng.choice([3, 199, 200, 260])
        text = " ".join(rng.choice(["same", f"w{j}"]) if i % 3 else f"w{j}" for j in range(n))
        text += rng.choice(["", " #", " ABCDEFGHIJKLMNOP" * 3, " nbsp"])
        docs.append((i, text, rng.choice(["web", "web", "books", None, ""])))
    docs += [(200 + i, docs[i][1], "web") for i in range(30)] + [docs[4], (None, docs[5][1], "web"), (None, None, None), (300, None, "x"), (301, "", "x")]
    docs.append((302, "Long tail " * 300_000, "long"))
    labels = [(i, i % 2, int(i % 7 == 0), "l") for i in range(0, 240, 2)] + [(3, 0, 0, "l"), (3, 1, 1, "l"), (None, 1, 1, "l"), (5, None, None, "l")]
    return docs, labels


def test_audit_equals_walk_through_orders(spark):
    docs, labels = corpus()
    given = spark.createDataFrame([(d, t, s, 1, "p", 9) for d, t, s in docs], DOCS)
    assert found(audit_filters(given, spark.createDataFrame(labels, LABELS))) == brute(docs, labels)


def test_audit_of_nothing(spark):
    none = spark.createDataFrame([], LABELS)
    assert audit_filters(nothing(spark), none).count() == 0
    docs, _ = corpus()
    given = spark.createDataFrame([(d, t, s, 1, "p", 9) for d, t, s in docs[:40]], DOCS)
    assert found(audit_filters(given, none)) == brute(docs[:40], [])


def test_ranks_and_intervals():
    for rank, order in enumerate(permutations(range(5))):
        assert lehmer_rank(order, 5) == rank
    cover = {}
    for mask, _, begin, end in intervals(4):
        for rank in range(begin, end):
            cover[mask, rank] = cover.get((mask, rank), 0) + 1
    assert cover == {(m, r): 1 for m in range(1, 16) for r in range(24)}  # removed once in every order


def test_words_across_slices():
    text = (b"ab " * (_SLICE // 2)) + b"x" * (2 * _SLICE) + b"\x0b\x1cend"
    assert word_counts(text) == (_SLICE // 2 + 2, 3)
    assert failures(b"") == 1
