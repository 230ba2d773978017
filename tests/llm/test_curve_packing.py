"""Packing along the curve: ids as the library gives them, every id once, no padding, like documents together."""

import random
from functools import partial
from itertools import product

import numpy as np
import pytest

from acequia.llm.curve_packing import BITS, END_ID, Projection, WordTokens, hilbert, pack_along_curve, sequence_starts
from acequia.llm.token_counts import public_file
from tests.llm.helpers import awkward, documents, nothing, words

FILE = "word_bpe_49k.json"


def encoded(texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_file(FILE))
    return [tok.encode(t, add_special_tokens=False).ids + [END_ID] for t in texts]


def check(docs, capacity):
    rows = pack_along_curve(docs, partial(public_file, FILE), capacity).collect()
    sequences, documents_ = {}, {}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        documents_.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, ids))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity and at & (at - 1) == 0  # full, or a power of two: nothing to pad
    want = {}
    for r, ids in zip(docs.collect(), encoded([r.text or "" for r in docs.collect()])):
        want.setdefault((r.doc_id, len(ids)), []).append(ids)
    assert {k: sum(len(ids) for _, ids in v) for k, v in documents_.items()} == {k: sum(map(len, v)) for k, v in want.items()}
    for key, own in want.items():
        if len(own) == 1:
            assert sum((ids for _, ids in sorted(documents_[key])), []) == own[0]
            at = 0
            for start, ids in sorted(documents_[key]):
                assert start == at
                at += len(ids)
        else:  # rows with one id: the same pieces all in all
            assert sorted(sum((ids for _, ids in documents_[key]), [])) == sorted(sum(own, []))
    return rows


@pytest.mark.parametrize("capacity", [1, 64, 2048])
def test_every_id_in_one_piece(spark, capacity):
    texts = [(i, words("w", i % 50) + " It's the END of №" * (i % 3)) for i in range(60)]
    check(documents(spark, texts + [(100, None), (101, "")]), capacity)


def test_awkward_rows(spark):
    check(awkward(spark), 256)
    assert pack_along_curve(nothing(spark), partial(public_file, FILE)).count() == 0
    with pytest.raises(ValueError):
        pack_along_curve(nothing(spark), partial(public_file, FILE), 100)


def test_words_equal_library():
    tok = WordTokens(public_file(FILE), 2)
    rng = random.Random(6)
    alphabet = [chr(i) for i in range(0x250)] + list("ΣςσİıſḰͅ​ 　ﬁǅ²½٣一😀͸́ẞ")
    bits = alphabet + [" ", "  ", "\n", "'s", "'LL", "1", "é", "<|endoftext|>", "<|startoftext|", "Ünïcode", "STRASSE"] * 20
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        assert np.frombuffer(tok.ids(text), "<u2").tolist() == tok.tok.encode(text, add_special_tokens=False).ids, repr(text)
    assert len(tok.agreed) > 300  # most characters take the short way


def test_long_texts_are_cut_at_white_space():
    import acequia.llm.curve_packing as c

    tok, text = WordTokens(public_file(FILE), 2), "alpha, beta's\tgamma!!\x1c! " * 200
    whole = tok.ids(text)
    c_slice, c._SLICE = c._SLICE, 7
    try:
        assert tok.ids(text) == whole
    finally:
        c._SLICE = c_slice


@pytest.mark.parametrize("dimensions,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(dimensions, bits):
    cells = np.array(list(product(range(1 << bits), repeat=dimensions)))
    keys = hilbert(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_like_documents_are_neighbours(spark):
    rng = random.Random(2)
    topics = [[f"{t}{j}" for j in range(30)] for t in ("sea", "law", "war", "tax")]
    docs = documents(spark, [(i, " ".join(rng.choice(topics[i % 4]) for _ in range(80))) for i in range(200)])
    rows = pack_along_curve(docs, partial(public_file, FILE)).collect()
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)) if r.start == 0]
    alike = sum(a % 4 == b % 4 for a, b in zip(order, order[1:]))
    assert alike > 140  # 50 by chance


def test_sequences_after_the_full_ones():
    assert sequence_starts(4096, 2048) == [] and sequence_starts(0, 8) == []
    assert sequence_starts(8 + 7, 8) == [8, 12, 14]
    assert Projection()(np.array([], np.int64)) == [0.0] * 4 and BITS * 4 < 63
