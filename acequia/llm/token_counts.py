"""Token counts through pre-tokens.

A tokenizer of the pair-merging kind first cuts a text into pre-tokens and then
encodes each by itself. Counting the pieces once per distinct pre-token and
joining these counts to the documents' pre-token frequencies gives the
documents' lengths; the ids are never made.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acequia.llm.common import worker_cache
from acequia.session import materialize

# (document, pre-token) pairs held by a task before they are handed on.
FLUSH_PAIRS = 3_000_000
# A pre-token in this many documents of one flush is counted there and added to the documents'
# heads: no long row lists are shuffled, and no pre-token becomes a hot join key.
FOLD_ROWS = 6
_PART_BITS = 33  # a row's number: partition above, place in its scan task below
_FREQ_BITS = 15  # a pair in one int: place in the flush above, frequency below
_MOST_FREQ = (1 << _FREQ_BITS) - 1
_MOST_ROWS = 1 << 16

_HEAD = pa.list_(pa.struct([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("tokens", pa.int64())]))
_SEEN = pa.schema([("pre", pa.string()), ("base", pa.int64()), ("pairs", pa.list_(pa.int32())), ("heads", _HEAD)])
_SEEN_DDL = "pre string, base bigint, pairs array<int>, heads array<struct<doc_id: bigint, n_bytes: bigint, tokens: bigint>>"


def public_file(name: str) -> str:
    """Place of an installed tokenizer file on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


# The pattern by which byte-level pre-tokenizers cut texts (fixed value).
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class PreTokenizer:
    """Pre-tokens of texts as a tokenizer file's library cuts them, and the pieces of each.

    Byte-level files cut by a fixed pattern, which a compiled expression applies
    several times faster. How it cuts depends on each character's class alone, so
    every character that is not ASCII is tried once against the library; texts with
    a character on which they differ, and other kinds of files, take the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        added = self.tok.get_added_tokens_decoder().values()
        if self.tok.pre_tokenizer is None or any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
            raise ValueError("needs a pre-tokenizer, and added tokens that are matched as they are")
        words = sorted((t.content for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, words))) if words else None
        kind = json.loads(self.tok.to_str())["pre_tokenizer"]
        plain = kind["type"] == "ByteLevel" and kind.get("use_regex", True) and not kind["add_prefix_space"]
        self.cut = regex.compile(BYTE_LEVEL).findall if plain and self.tok.normalizer is None else None
        self.agreed = {chr(i) for i in range(128)}

    def _by_library(self, text: str) -> list[str]:
        if self.tok.normalizer is not None:
            text = self.tok.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]

    def _agrees(self, chars: set[str]) -> bool:
        for c in chars:
            probe = f"a{c}a1{c}1!{c}! {c} {c}{c}a {c}1 {c}!"
            if self.cut(probe) != self._by_library(probe):
                return False
            self.agreed.add(c)
        return True

    def count(self, text: str) -> tuple[Counter, int]:
        """Frequencies of pre-tokens, and how many added tokens the text holds."""
        parts = self.special.split(text) if self.special else [text]
        found = Counter()
        fast = self.cut is not None and self._agrees(set(text) - self.agreed)
        for part in parts:
            if part:
                found.update(self.cut(part) if fast else self._by_library(part))
        return found, len(parts) - 1

    def pieces(self, pre: str) -> int:
        """Tokens of one pre-token."""
        tokenize = self.tok.model.tokenize
        return sum(len(tokenize(w)) for w, _ in self.tok.pre_tokenizer.pre_tokenize_str(pre))


def _loaded(path: str) -> PreTokenizer:
    held = worker_cache()
    key = ("pre-tokens", path)
    if key not in held:
        held[key] = PreTokenizer(path)
    return held[key]


def _frequencies(locate: Callable[[], str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _loaded(locate())
        base = TaskContext.get().partitionId() << _PART_BITS
        held: dict[str, array] = {}
        heads, n_pairs = [], 0

        def flush() -> pa.RecordBatch:
            for pre in [w for w, pairs in held.items() if len(pairs) >= FOLD_ROWS]:
                pieces = tok.pieces(pre)
                for pair in held.pop(pre):
                    heads[pair >> _FREQ_BITS]["tokens"] += pieces * (pair & _MOST_FREQ)
            n = len(held)
            ends = np.zeros(n + 2, np.int32)
            np.cumsum([len(x) for x in held.values()], out=ends[1:-1])
            ends[-1] = ends[-2]
            flat = np.frombuffer(b"".join(x.tobytes() for x in held.values()), np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array([*held, None], pa.string()), pa.array(np.full(n + 1, base, np.int64)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array([*[None] * n, heads], _HEAD)],
                schema=_SEEN)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                counts, n_special = tok.count(text)
                here = len(heads) << _FREQ_BITS
                heads.append({"doc_id": doc_id, "n_bytes": len(text.encode()), "tokens": n_special})
                for pre, n in counts.items():
                    pairs = held.get(pre)
                    if pairs is None:
                        pairs = held[pre] = array("I")
                    while n > _MOST_FREQ:
                        pairs.append(here | _MOST_FREQ)
                        n -= _MOST_FREQ
                    pairs.append(here | n)
                n_pairs += len(counts)
                if n_pairs >= FLUSH_PAIRS or len(heads) == _MOST_ROWS:
                    yield flush()
                    base += len(heads)
                    held, heads, n_pairs = {}, [], 0
        if heads:
            yield flush()

    return run


def _pieces(locate: Callable[[], str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _loaded(locate())
        for batch in batches:
            n = [tok.pieces(pre) for pre in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int32())], ["pre", "pieces"])

    return run


def count_tokens(docs: DataFrame, locate: Callable[[], str], limit: int) -> DataFrame:
    """Tokens of every row's whole text: (doc_id, n_bytes, n_tokens, over_limit).

    `locate` gives the place of a tokenizer file (.json) on the machine that runs
    it. Counts equal the library's encoding without begin, end or added special
    tokens; strings of special tokens inside a text count as one token each, the
    library's default. Null and empty texts have 0 bytes and 0 tokens; repeated
    rows are counted row by row; rows without id are kept. `n_bytes` are UTF-8
    bytes, `over_limit` is n_tokens > limit.
    """
    # written once: heads and pre-tokens alone are read back where no more is needed
    seen = materialize(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_frequencies(locate), _SEEN_DDL), "pre-tokens"
    )
    words = seen.filter("pre is not null").select("pre", "base", "pairs")
    pieces = words.select("pre").distinct().mapInArrow(_pieces(locate), "pre string, pieces int")
    pairs = words.join(pieces, "pre").select("base", "pieces", F.explode("pairs").alias("x"))
    sums = pairs.groupBy((F.col("base") + F.shiftrightunsigned("x", _FREQ_BITS)).alias("row")).agg(
        F.sum(F.col("x").bitwiseAND(_MOST_FREQ).cast("long") * F.col("pieces")).alias("rest")
    )
    heads = seen.filter("pre is null").select("base", F.posexplode("heads").alias("place", "head"))
    total = F.col("head.tokens") + F.coalesce("rest", F.lit(0))
    return (
        heads.withColumn("row", F.col("base") + F.col("place")).join(sums, "row", "left")
        .select("head.doc_id", "head.n_bytes", total.alias("n_tokens"), (total > limit).alias("over_limit"))
    )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
