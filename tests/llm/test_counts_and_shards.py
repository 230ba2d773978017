import random
import zlib

import pytest
from pyspark.sql import functions as F

from acequia.llm.packing import best_fit, pack
from acequia.llm.sharding import shard_by_bytes
from acequia.llm.token_counts import PreTokenizer, count_tokens, public_file
from tests.llm.helpers import awkward, documents, nothing, words

FILE = "byte_bpe_50k.json"


def test_token_counts_equal_library(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_file(FILE))
    docs = awkward(spark)
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(docs, lambda: public_file(FILE), 512).collect())
    want = []
    for r in docs.collect():
        text = r.text or ""
        n = len(tok.encode(text, add_special_tokens=False).ids)
        want.append((r.doc_id or -1, len(text.encode()), n, n > 512))
    assert got == sorted(want)
    assert count_tokens(nothing(spark), lambda: public_file(FILE), 512).count() == 0


def test_pre_tokens_of_odd_characters():
    tok = PreTokenizer(public_file(FILE))
    rng = random.Random(3)
    alphabet = [chr(i) for i in range(0x20, 0x250)] + list("\u0085  　‍́️²½٣一😀\x1c")
    bits = alphabet + [" ", "  ", "\n", "'s", "'ll", "1", "<|endoftext|>"] * 20
    for _ in range(2000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        counts, special = tok.count(text)
        assert sum(tok.pieces(w) * n for w, n in counts.items()) + special == len(tok.tok.encode(text, add_special_tokens=False).ids)


def test_frequent_pre_tokens_are_folded(spark):
    docs = documents(spark, [(i, "the the cat " * (i % 5) + words("w", i % 7)) for i in range(300)])
    got = {r.doc_id: r.n_tokens for r in count_tokens(docs, lambda: public_file(FILE), 5).collect()}
    tok = PreTokenizer(public_file(FILE)).tok
    assert got == {r.doc_id: len(tok.encode(r.text).ids) for r in docs.collect()}


def check_shards(docs, shards):
    rows = [(r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in shard_by_bytes(docs, shards).collect()]
    want = sorted((r.doc_id or -1, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert sorted((d or -1, s, c) for d, s, c, _, _ in rows) == want
    total, most = sum(r[1] for r in rows), max((r[1] for r in rows), default=0)
    for shard in range(shards):
        own = [r for r in rows if r[3] == shard]
        assert sorted(r[4] for r in own) == list(range(len(own)))
        assert abs(sum(r[1] for r in own) - total / shards) <= most
    assert all(0 <= r[3] < shards for r in rows)
    return rows


def test_shards_balance_bytes(spark):
    rng = random.Random(1)
    docs = documents(spark, [(i, words("t", rng.randint(0, 60), i % 50)) for i in range(1500)])
    check_shards(docs, 7)


def test_shards_with_hot_text_and_repeated_rows(spark):
    docs = documents(spark, [(i, "same text for a third") for i in range(400)] + [(9, "repeated row")] * 400 + [(i, words("u", i % 9)) for i in range(400)])
    rows = check_shards(docs, 5)
    hot = zlib.crc32(b"same text for a third")
    assert len({r[3] for r in rows if r[2] == hot}) > 1


def test_shards_of_awkward_rows(spark):
    check_shards(awkward(spark), 3)
    check_shards(nothing(spark), 3)
    with pytest.raises(ValueError):
        shard_by_bytes(nothing(spark), 0)


def naive_best_fit(lengths, sources, clusters, capacity):
    bins, out = [], []
    for n, s, c in zip(lengths, sources, clusters):
        fits = [(room, i) for i, (room, ss, cc) in enumerate(bins) if room >= n and (s < 0 or s not in ss) and (c < 0 or c not in cc)]
        if fits:
            _, i = min(fits)
        else:
            bins.append((capacity, set(), set()))
            i = len(bins) - 1
        room, ss, cc = bins[i]
        bins[i] = (room - n, ss | {s}, cc | {c})
        out.append(i)
    return out


def test_best_fit_equals_scan_of_all_bins():
    rng = random.Random(5)
    for _ in range(30):
        n = rng.randint(0, 120)
        args = [sorted((rng.randint(0, 50) for _ in range(n)), reverse=True), [rng.randint(-1, 8) for _ in range(n)], [rng.randint(-1, 20) for _ in range(n)]]
        assert best_fit(*args, 64) == naive_best_fit(*args, 64)


def test_pack_rules(spark):
    rows = [(i, i, i % 90 if i % 10 else 250, ["a", "b", None, f"s{i}"][i % 4], None if i % 3 else i % 30) for i in range(600)]
    rows += [(700, 700, None, "a", 1), (701, 701, 0, None, None), (None, 702, 3, "b", 2), (705, 705, 5, "a", None), (705, 705, 5, "a", None)]
    got = pack(spark.createDataFrame(rows, "doc_id bigint, key bigint, n_tokens int, source string, cluster bigint"), 100, 200).collect()
    bins = {}
    for r in got:
        bins.setdefault((r.shard, r.bin), []).append(r)
    for own in bins.values():
        assert sum(r.n_tokens for r in own) <= 100
        assert sorted(r.slot for r in own) == list(range(len(own)))
        for column in ("source", "cluster"):
            held = [r[column] for r in own if r[column] is not None]
            assert len(held) == len(set(held))
    whole = {}
    for r in got:
        whole.setdefault(r.key, []).append((r.start, r.n_tokens))
    for doc_id, key, n, _, _ in rows:
        pieces = sorted(whole[key])
        assert sum(t for _, t in pieces) == (n or 0) * (2 if key == 705 else 1)
    assert sorted(whole[0]) == [(0, 100), (100, 100), (200, 50)]
    empty = spark.createDataFrame([], "doc_id bigint, key bigint, n_tokens int, source string, cluster bigint")
    assert pack(empty, 100).count() == 0
