"""Token-sort similarity: 200 * LCS / (len a + len b) of the word-sorted texts."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from acequia.functions.text import sorted_words

_ONE = np.uint64(1)
_MASK_CELLS = 4_000_000
# Names are far shorter; single long texts are quicker as one integer than as many words.
_MOST_LENGTH = 1024


def _code_matrix(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points padded with zeros, and lengths."""
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    out = np.zeros((len(texts), max(int(lengths.max(initial=0)), 1)), dtype=np.uint32)
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = flat
    return out, lengths


def _lcs_words(left: list[str], right: list[str]) -> np.ndarray:
    """LCS lengths of all pairs at once; the left texts fill as many 64-bit words as the longest needs.

    Bit-parallel: bit i of a row is cleared once left[i] ends a longer common
    subsequence; one pass over the right texts updates all rows together, the carry
    of each addition going on into the next word.
    """
    a, a_len = _code_matrix(left)
    b, b_len = _code_matrix(right)
    symbols, dense = np.unique(np.concatenate([a.ravel(), b.ravel()]), return_inverse=True)
    dense = dense.ravel()
    a_sym = dense[: a.size].reshape(a.shape)
    b_sym = dense[a.size:].reshape(b.shape)
    rows, words = np.arange(len(left)), -(-a.shape[1] // 64)
    masks = np.zeros((words, len(left), len(symbols)), dtype=np.uint64)
    for i in range(a.shape[1]):
        live = i < a_len
        masks[i // 64, rows[live], a_sym[live, i]] |= _ONE << np.uint64(i % 64)
    state = np.full((words, len(left)), np.iinfo(np.uint64).max, dtype=np.uint64)
    for j in range(b.shape[1]):
        live, carry = j < b_len, np.zeros(len(left), np.uint64)
        for w in range(words):
            hit = np.where(live, masks[w, rows, b_sym[:, j]], np.uint64(0))
            common = state[w] & hit
            added = state[w] + common
            total = added + carry
            carry = ((added < common) | (total < carry)).astype(np.uint64)
            state[w] = total | (state[w] & ~hit)
    out = np.zeros(len(left), np.int32)
    for w in range(words):
        bits = np.clip(a_len - 64 * w, 0, 64).astype(np.uint64)
        used = np.where(bits >= 64, np.iinfo(np.uint64).max, (_ONE << np.minimum(bits, np.uint64(63))) - _ONE)
        out += np.bitwise_count(~state[w] & used).astype(np.int32)
    return out


def _lcs_long(left: str, right: str) -> int:
    """The same recurrence on one arbitrary-width integer, for the few texts beyond _MOST_LENGTH characters."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(left):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(left)) - 1
    state = full
    for ch in right:
        common = state & masks.get(ch, 0)
        state = ((state + common) | (state - common)) & full
    return len(left) - state.bit_count()


def lcs_lengths(left: pd.Series, right: pd.Series) -> pd.Series:
    out = np.zeros(len(left), dtype=np.int32)
    # the bit vector runs over the shorter text; pairs of like lengths go together
    pairs = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(left, right)]
    most = [i for i, (_, y) in enumerate(pairs) if len(y) <= _MOST_LENGTH]
    most.sort(key=lambda i: (-(-len(pairs[i][0]) // 64), len(pairs[i][1])))
    at = 0
    while at < len(most):
        words = max(1, -(-len(pairs[most[at]][0]) // 64))
        step = max(64, _MASK_CELLS // (128 * words))
        idx = [i for i in most[at: at + step] if max(1, -(-len(pairs[i][0]) // 64)) == words]
        out[idx] = _lcs_words([pairs[i][0] for i in idx], [pairs[i][1] for i in idx])
        at += len(idx)
    for i, (x, y) in enumerate(pairs):
        if len(y) > _MOST_LENGTH:
            out[i] = _lcs_long(x, y)
    return pd.Series(out)


# Executors get the functions themselves and need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Declared non-deterministic so that the optimizer neither repeats it per use nor
# moves a filter on its result below the step that makes pairs distinct.
_lcs = F.pandas_udf(lcs_lengths, IntegerType()).asNondeterministic()


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two non-null texts."""
    return _lcs(a, b)


def ratio(lcs: Column, a: Column, b: Column) -> Column:
    """Score 0-100 from an LCS length; two empty texts are equal."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(F.lit(200.0) * lcs / total)


def token_sort_similarity(a: Column, b: Column) -> Column:
    """Word-order-free similarity of two texts, 0-100."""
    x, y = sorted_words(a), sorted_words(b)
    return ratio(lcs_length(x, y), x, y)
