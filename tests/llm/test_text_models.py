import hashlib
import math
import random
import tempfile
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from acequia.llm.common import content_key
from acequia.llm.imatch import BAND, fingerprint_documents, lexicon, term_slots
from acequia.llm.kneser_ney import classify, decode, encode
from acequia.llm.line_templates import drop_recurring_lines, without_recurring_lines
from acequia.llm.mixing import MOST_DOMAINS, copies, mix, replay, with_rates
from acequia.llm.url_filter import judge, patterns_of
from tests.llm.helpers import awkward, documents, nothing, words


class PlainModel:
    """Interpolated modified Kneser-Ney by dictionaries."""

    def __init__(self, texts):
        c3 = Counter(("\x02\x02" + t)[i:i + 3] for t in texts for i in range(len(t)))
        c2 = Counter(g[1:] for g in c3)
        c1 = Counter(g[1:] for g in c2)
        self.symbols, self.orders = len(c1) + 1, []
        for counts in (c1, c2, c3):
            n = [sum(v == i for v in counts.values()) for i in (1, 2, 3, 4)]
            d = []
            for i in (1, 2, 3):
                y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else math.nan
                x = i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] else math.nan
                d.append(x if 0 < x < i else 0.5)
            self.orders.append((counts, d))

    def p(self, gram):
        p = 1 / self.symbols
        for k, (counts, d) in enumerate(self.orders, 1):
            part = gram[3 - k:]
            own = {g: v for g, v in counts.items() if g[:-1] == part[:-1]}
            if own:
                total, freed = sum(own.values()), sum(d[min(v, 3) - 1] for v in own.values())
                held = counts[part] - d[min(counts[part], 3) - 1] if part in counts else 0.0
                p = (held + freed * p) / total
        return p

    def perplexity(self, text):
        padded = "\x02\x02" + text
        return math.exp(-sum(math.log(self.p(padded[i:i + 3])) for i in range(len(text))) / len(text))


def test_pair_codes_round_trip():
    rng = np.random.default_rng(2)
    starts = np.array([0, 3, 4, 10])
    place = np.concatenate([np.sort(rng.choice(60_000, k, replace=False)) for k in (3, 1, 6, 20)])
    n = rng.choice([1, 2, 15, 16, 400, 70_000], len(place))
    codes, ends = encode(place, n, starts)
    assert list(ends[-2:]) == [len(codes)] * 2
    sizes = np.diff(ends[:-1]) // 2
    at, freq = decode(np.frombuffer(codes, np.uint16), sizes)
    row = np.repeat(np.arange(4), sizes)
    for r, (lo, hi) in enumerate(zip(starts, [*starts[1:], len(place)])):
        got = np.bincount(at[row == r], freq[row == r], minlength=60_000)
        want = np.zeros(60_000)
        want[place[lo:hi]] = n[lo:hi]
        assert (got == want).all()


def test_perplexity_equals_plain_model(spark):
    good = {i: words("ab", 3 + i % 4, i) for i in range(12)} | {i: f"uno dos {i} tres" for i in range(20, 26)}
    rows = list(good.items()) + [(40, "zz!!zz"), (41, "ab1 ab2"), (42, None), (43, ""), (44, "xx"), (41, "ab1 ab2"), (None, "ab9"), (45, "q" * 40_000)]
    langs = {i: "es" for i in range(20, 26)} | {44: "none", 40: None}
    docs = documents(spark, rows, langs)
    trusted = spark.createDataFrame([(i,) for i in good] + [(None,), (3,)], "doc_id bigint")
    got = classify(docs, trusted, F.lit(1).cast("long"), quantiles=(0.0, 1.0)).collect()
    models = {"en": PlainModel([t for i, t in good.items() if i < 20]), "es": PlainModel([t for i, t in good.items() if i >= 20])}
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        if r.lang in models and texts[r.doc_id]:
            assert r.perplexity == pytest.approx(models[r.lang].perplexity(texts[r.doc_id]), rel=1e-9)
            assert r.kept == (r.low <= r.perplexity <= r.high)
        elif r.lang in models:
            assert r.perplexity is None and not r.kept
        else:
            assert r.perplexity is None and r.kept
    assert all(r.kept for r in got if r.doc_id in good)
    assert not next(r for r in got if r.doc_id == 45).kept
    assert classify(nothing(spark), trusted, F.lit(1).cast("long")).count() == 0
    untrained = classify(docs, trusted.limit(0), content_key()).collect()
    assert all(r.kept == bool(texts[r.doc_id]) for r in untrained)


def test_lines_of_recurring_templates(spark):
    own = {i: "\n".join(words(f"d{chr(97 + i)}{chr(97 + j)}x", 9).translate({c: c + 17 for c in range(48, 58)}) for j in range(6)) for i in range(8)}
    rows = []
    for i, text in own.items():
        lines = text.split("\n")
        lines.insert(i % 6, f"Page {i * 7} of {i * 9} printed on day {i}")
        if i < 5:
            lines.insert(0, f"This file was made by user {'abcdefgh'[i]}name for the whole team of editors")
        if i < 2:
            lines.insert(3, "Seen twice only")
        rows.append((i, "\n".join(lines)))
    rows += [(20 + i, own[7] + "\ncopied") for i in range(3)] + [(30, None), (31, ""), (32, "\n \n")] + [(33, "one row\nrepeated")] * 4
    docs = documents(spark, rows)
    got = {r.doc_id: r for r in drop_recurring_lines(docs, content_key()).collect()}
    for i, text in own.items():
        if i == 7:
            continue
        want = text.split("\n")
        if i < 2:  # where the line stood before its neighbours went
            with_line = dict(rows)[i].split("\n")
            want = [x for x in with_line if not x.startswith(("Page", "This file"))]
        assert got[i].text == "\n".join(want), i
        assert got[i].n_recurring == 1 + (i < 5) and not got[i].whole
    for i in (20, 21, 22):
        assert got[i].whole and got[i].text == own[7] + "\ncopied"
    assert got[30].text is None and got[30].n_lines == 0 and got[31].text == "" and got[32].text == "\n \n"
    assert got[33].text == "one row\nrepeated"
    same = without_recurring_lines(docs.withColumn("whole", F.lit("w")).withColumn("n_lines", F.lit("n")), content_key())
    assert same.columns == [*docs.columns, "whole", "n_lines"] and same.count() == len(rows)
    assert without_recurring_lines(nothing(spark), content_key()).count() == 0


def test_fingerprints(spark):
    rows = [(i, " ".join(f"w{(i * 7 + j * j) % 60}" for j in range(5 + i % 30))) for i in range(60)]
    rows += [(100, rows[5][1]), (101, "solitary"), (102, ""), (103, None), (104, "ünï 😀 x"), (105, words("long", 20_000))]
    docs = documents(spark, rows)
    got = {r.doc_id: r for r in fingerprint_documents(docs).collect()}
    ordered = sorted(rows, key=lambda r: -r[0])

    def like(a, b):
        pairs = list(zip(a.split("."), b.split(".")))
        return sum(x == y != "" for x, y in pairs) / sum(bool(x or y) for x, y in pairs)

    for at, (doc_id, text) in enumerate(ordered):
        text, after = text or "", ordered[(at + 1) % len(ordered)]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + (after[1] or "")[:cut]
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(like(r.fingerprint, r.edited_fingerprint))
        assert r.near_next == pytest.approx(like(r.fingerprint, got[after[0]].fingerprint))
        assert edited != text or r.fingerprint == r.edited_fingerprint and r.near_edited == 1.0
    assert got[100].fingerprint == got[5].fingerprint and got[102].fingerprint == got[103].fingerprint
    assert got[101].fingerprint != got[102].fingerprint
    twice = fingerprint_documents(awkward(spark)).collect()
    assert len(twice) == 12 and len({r.fingerprint for r in twice if r.n_chars == 30}) == 1
    assert fingerprint_documents(nothing(spark)).count() == 0
    one = fingerprint_documents(documents(spark, [(1, "a b c")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_lexicon_is_the_band(spark):
    texts = spark.createDataFrame([(" ".join(f"t{j}" for j in range(100) if i % (j + 1) == 0),) for i in range(1, 101)], "text string")
    slots = 1 << 12
    bits = lexicon(texts, BAND, slots).first().lexicon
    df = Counter(s for r in texts.select(term_slots(F.col("text"), slots).alias("s")).collect() for s in r.s)
    held = {w * 64 + b for w, x in enumerate(bits) for b in range(64) if x >> b & 1}
    assert len(bits) == slots // 64 and held == {s for s, n in df.items() if 2 <= n <= 25}


def test_mixture_meets_targets(spark):
    rows = [(i, words("der", 4 + i % 9)) for i in range(60)] + [(100 + i, words("que", 6)) for i in range(30)] + [(200 + i, words("th", 20)) for i in range(10)]
    docs = documents(spark, [*rows, (400, None), (401, ""), (402, "a"), (1, rows[1][1])])
    labelled = docs.filter("doc_id % 2 = 0").select(
        "text", F.when(F.col("doc_id") < 100, "d").when(F.col("doc_id") < 200, "q").when(F.col("doc_id") < 300, "t").alias("domain"))
    weights = {"d": 1.0, "q": 2.0, "t": 1.0}
    got = with_rates(docs, mix(docs, labelled, weights)).collect()
    total = sum(r.n_tokens for r in got)
    for k, d in enumerate(sorted(weights)):
        assert sum(r.rate * r.n_tokens * r.posterior[k] for r in got) == pytest.approx(total * weights[d] / 4, rel=1e-4)
    assert all(r.rate >= 0 and sum(r.posterior) == pytest.approx(1) for r in got)
    right = [max(range(3), key=lambda k: r.posterior[k]) == (r.doc_id >= 100) + (r.doc_id >= 200) for r in got if r.doc_id < 300]
    assert sum(right) / len(right) > 0.95
    free = mix(docs, labelled.filter("domain is null"), 0.5)
    assert {r.rate for r in with_rates(docs, free).collect()} == {1.0}
    assert with_rates(nothing(spark), mix(nothing(spark), labelled, weights)).count() == 0
    assert replay(np.array([[1.0]]), [np.array([3.0])]) == [0.0]
    assert MOST_DOMAINS >= len(weights)


def test_copies_follow_the_rate(spark):
    got = spark.range(20_000).select(copies(F.lit(1.3), F.col("id")).alias("c")).groupBy("c").count().collect()
    assert {r.c for r in got} == {1, 2} and sum(r.c * r["count"] for r in got) / 20_000 == pytest.approx(1.3, abs=0.02)


def test_url_filter_as_of(spark):
    entries = spark.createDataFrame([
        ("bad.com", False, "add", 100), ("bad.com", False, "remove", 200), ("bad.com", False, "add", 300), ("bad.com", False, "add", 350),
        ("Bad.com/good", True, "add", 120), ("x.bad.com/good", False, "add", 130), ("both.org", True, "add", 10), ("both.org", False, "add", 10),
        ("flip.org", False, "add", 50), ("flip.org", False, "remove", 50), (None, False, "add", 1), ("", False, "add", 1), ("bad.com", None, "add", 1),
        ("bad.com", False, "other", 1), ("old.net", False, "add", 5), ("old.net", False, "remove", 20_000_000),
    ], "pattern string, allow boolean, action string, at bigint")
    rows = [
        (1, "http://bad.com/x", 99, False), (2, "http://bad.com/x", 100, True), (3, "http://BAD.com:80", 199, True), (4, "http://bad.com/", 200, False),
        (5, "https://u@a.b.bad.com/p?q#f", 300, True), (6, "http://bad.com/good/page", 150, False), (7, "http://bad.com/goodness", 150, True),
        (8, "http://x.bad.com/good", 150, True), (9, "http://notbad.com", 150, False), (10, "http://both.org/a", 15, True),
        (11, "http://flip.org", 60, False), (12, None, 60, False), (13, "no url", 150, False), (14, "http://bad.com", None, False),
        (None, "http://bad.com", 150, True), (2, "http://bad.com/x", 100, True), (15, "http://old.net/", 19_999_999, True), (16, "http://old.net/", 20_000_000, False),
    ]
    captures = spark.createDataFrame([r[:3] for r in rows], "capture_id bigint, url string, fetched_at bigint")
    got = sorted((str(r.capture_id), r.blocked) for r in judge(captures, entries).collect())
    assert got == sorted((str(r[0]), r[3]) for r in rows)
    assert judge(captures.limit(0), entries).count() == 0
    assert not any(r.blocked for r in judge(captures, entries.limit(0)).collect())
    one = captures.limit(1).select(patterns_of(F.lit("http://a.b.c/d//e/?x")).alias("p")).first().p
    assert one == ["a.b.c", "b.c", "c", "a.b.c/d", "a.b.c/d/e"]


def _own_lines(i, n):
    """Lines that no other text has."""
    letters = str.maketrans("0123456789", "abcdefghij")
    return [words(f"own{i}x{j}y", 9).translate(letters) for j in range(n)]


def test_recurring_lines_go_from_texts_they_mostly_make_up(spark):
    passage = [" ".join(f"{w}{c}" for c in "abcdefghijkl") for w in ("vow", "sum", "rig", "tan")]
    rows = [(i, "\n".join(passage + _own_lines(i, 2))) for i in range(4)]  # two thirds are shared
    copied = _own_lines(90, 12)
    rows += [(10 + i, "\n".join(copied[:-1] + [copied[-1] + f" end{'abcd'[i]}"])) for i in range(4)]
    got = {r.doc_id: r for r in drop_recurring_lines(documents(spark, rows), content_key()).collect()}
    for i in range(4):
        assert got[i].text == "\n".join(_own_lines(i, 2)) and got[i].n_recurring == 4 and not got[i].whole
        assert got[10 + i].text == dict(rows)[10 + i] and got[10 + i].whole


def test_common_values_of_fields_are_not_constants(spark):
    names, kinds = [f"name{c}" for c in "abcdefghij"], [f"kind{c}" for c in "klmnopqrst"]
    rows = [(i, f"This notice was sent to {names[i % 10]} by the office for {kinds[i // 10]} and needs no answer\n" + "\n".join(_own_lines(i, 3)))
            for i in range(100)]  # every value in ten documents, every pair of values in one
    got = drop_recurring_lines(documents(spark, rows), content_key()).collect()
    assert [r.doc_id for r in got if r.text != "\n".join(_own_lines(r.doc_id, 3))] == []


def test_long_lines_recur_in_two_documents(spark):
    passage, short = " ".join(f"w{c}{d}" for c in "abcdef" for d in "klmnopqrst"), "seen in two texts only"
    rows = [(i, "\n".join([*_own_lines(i, 12), passage, short])) for i in range(2)]
    copied = " ".join(f"z{c}{d}" for c in "abcdef" for d in "klmnopqrst")
    rows += [(10 + i, copied + f"\nend{'ab'[i]}") for i in range(2)]  # two near copies
    got = {r.doc_id: r.text for r in drop_recurring_lines(documents(spark, rows), content_key()).collect()}
    for i in range(2):
        assert got[i] == "\n".join([*_own_lines(i, 12), short]) and got[10 + i] == dict(rows)[10 + i]


def test_url_filter_keeps_the_case_of_paths(spark):
    entries = spark.createDataFrame(
        [("bad.com", False, "add", 1), ("Bad.com/Blog", True, "add", 1)], "pattern string, allow boolean, action string, at bigint")
    captures = spark.createDataFrame(
        [(1, "http://BAD.com/Blog/x", 5), (2, "http://bad.com/blog/x", 5)], "capture_id bigint, url string, fetched_at bigint")
    got = {r.capture_id: (r.pattern, r.n_active, r.blocked) for r in judge(captures, entries).collect()}
    assert got == {1: ("bad.com/Blog", 2, False), 2: ("bad.com", 1, True)}


def test_mixture_equals_plain_classifier_and_solver(spark):
    """Posteriors of a plain naive Bayes over byte trigrams, rates of a plain projected gradient on all rows at once."""
    from acequia.llm import mixing as x

    rng = random.Random(12)
    kinds = {"d": "der die das und", "q": "que los las por", "t": "the and that with"}
    rows = [(i, " ".join(rng.choice(kinds["dqt"[i % 3]].split()) for _ in range(rng.choice([1, 5, 40])))) for i in range(90)]
    docs = documents(spark, [*rows, (400, None), (401, ""), (402, "é"), (403, words("der", 5_000)), (5, rows[5][1])])
    labelled = docs.filter("doc_id < 60").select("text", F.element_at(F.array(*map(F.lit, "dqt")), F.col("doc_id").cast("int") % 3 + 1).alias("domain"))
    weights = {"d": 3.0, "q": 1.0, "t": 1.0}
    got = {(r.doc_id, r.n_tokens): r for r in mix(docs, labelled, weights, F.xxhash64("doc_id")).rated().collect()}

    def trigrams(text):
        b = (text or "").encode()
        return Counter(((b[i] * 0x9E3779B1 ^ b[i + 1] * 0x85EBCA6B ^ b[i + 2] * 0xC2B2AE35) & 0xFFFFFFFF) >> 20 for i in range(len(b) - 2))

    counts, held = {k: Counter() for k in "dqt"}, Counter()
    for i, text in [*rows[:60], rows[5]]:  # the repeated row counts twice
        counts["dqt"[i % 3]].update(trigrams(text))
        held["dqt"[i % 3]] += 1
    plain = []
    for r in docs.collect():
        found = trigrams(r.text)
        size, score = sum(found.values()), []
        for k in "dqt":
            every = sum(counts[k].values()) + x.SMOOTHING * x.BUCKETS
            like = sum(n * np.log((counts[k][h] + x.SMOOTHING) / every) for h, n in found.items())
            score.append(np.log((held[k] + 1) / (sum(held.values()) + 3)) + (like * min(1.0, x.EVIDENCE / size) if size else 0.0))
        p = np.exp(np.array(score) - max(score))
        plain.append((r.doc_id, len((r.text or "").split()), p / p.sum()))
    t, p = np.array([n for _, n, _ in plain], float), np.array([q for *_, q in plain])
    targets = np.array([3.0, 1.0, 1.0]) / 5 * t.sum()
    rate, scale = np.ones(len(t)), None
    for _ in range(x.STEPS):
        sums = (rate * t) @ p
        scale = np.maximum(sums, 1e-12) if scale is None else scale
        if np.abs(sums - targets).max() <= x.TOLERANCE * targets.sum():
            break
        rate = np.maximum(rate - p @ (x.STEP * (sums - targets) / scale), 0.0)
    assert len(got) == len({(d, n) for d, n, _ in plain})
    for (doc_id, n, q), want in zip(plain, rate):
        r = got[doc_id, n]
        assert r.posterior == pytest.approx(q.tolist(), rel=1e-9) and r.rate == pytest.approx(want, rel=1e-6, abs=1e-9)


def test_leaves_of_few_and_many_lines_agree(spark, monkeypatch):
    import acequia.llm.line_templates as t

    rng = random.Random(9)
    filler = "the office sends this note to all members of the house and asks for".split()
    # leaves of 1 to 9 distinct lines that vary in some words
    rows = [(i, "\n".join(" ".join([f"lead{'abcdefghi'[j]}", "note", *[w if rng.random() < 0.85 else rng.choice(filler) for w in filler], f"n{i}"])
                          for j in range(9) if i <= j * 2 + 2)) for i in range(20)]

    def found():
        return sorted(tuple(r) for r in t.recurring_lines(documents(spark, rows), content_key()).collect())

    by_lines = found()
    monkeypatch.setattr(t, "LEAF_LINES", 1)
    assert by_lines and found() == by_lines


def test_line_dedup_leaves_no_finished_steps_on_disk(spark):
    from pathlib import Path

    from acequia.session import discard, shared_dir

    rows = [(i, f"a notice that many of the documents hold\nown {'abcdef'[i]}") for i in range(6)]
    base = Path(shared_dir(spark).removeprefix("file:"))
    before = set(base.iterdir())
    assert drop_recurring_lines(documents(spark, rows), content_key()).filter("n_recurring = 1").count() == 6
    left = {p.name.rsplit("-", 1)[0] for p in set(base.iterdir()) - before}
    assert left.isdisjoint({"leaves", "lines", "distinct_lines", "leaf_sizes", "owned", "held", "at_risk", "shingles", "classes"}) and "shared" in left
    other = tempfile.mkdtemp(prefix="other-")
    spark.range(1).write.mode("overwrite").parquet(f"{other}/t")
    with pytest.raises(ValueError):
        discard(spark.read.parquet(f"{other}/t"))
