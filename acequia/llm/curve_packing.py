"""Packing along a space-filling curve.

A document's token ids are hashed into a signed vector, which a random projection
takes to a few dimensions. The position on a Hilbert curve through these dimensions
orders the documents: like ones are neighbours. Ranges of the curve with about
equal tokens are sorted each for itself, exact totals of the ranges give every
document its place in one long row of tokens, and the row is cut into sequences.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acequia.llm.common import worker_cache
from acequia.llm.ranges import before, sampled, splitters, with_range
from acequia.session import materialize

CAPACITY = 2048
END_ID = 1
VECTOR = 512  # places of the hashed vector
DIMENSIONS = 4
BITS = 12  # of each dimension on the curve
SPREAD = 3.0  # standard deviations on either side that the curve tells apart
LEAST_RANGES = 64
RANGE_TOKENS = 1 << 26
SAMPLES_PER_RANGE = 16
_SLICE = 1 << 20  # characters that are cut into words at once
_MOST_WORDS = 300_000  # words, and runs between white space, kept with their ids; each of _MOST_LETTERS at most
_MOST_LETTERS = 40
_ENDS = "abcdefghijklmnopqrstuvwxyz.,;:!?"


class WordTokens:
    """Ids of texts as a tokenizer file's library gives them, without added tokens around them.

    Files whose normalizer composes, folds white space and lower-cases, and whose
    pre-tokenizer keeps the matches of one pattern, are cut at white space and by that
    pattern here and encoded word by word, a distinct one once as a rule. Characters are tried against the
    library when first met; texts with one on which the two differ, texts that are
    not composed, and other kinds of files are encoded by the library.
    """

    def __init__(self, path: str, id_bytes: int):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        if self.tok.get_vocab_size(with_added_tokens=True) > 1 << 8 * id_bytes:
            raise ValueError("ids need more bytes")
        self.kind = np.dtype(f"<u{id_bytes}")
        added = self.tok.get_added_tokens_decoder()
        self.special = {t.content: self._packed([i]) for i, t in added.items()}
        words = sorted(self.special, key=len, reverse=True)
        self.parts = re.compile(f"({'|'.join(map(re.escape, words))})") if words else None
        spec = json.loads(self.tok.to_str())
        steps = [s["type"] for s in (spec["normalizer"] or {}).get("normalizers", [])]
        cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        plain = (
            steps == ["NFC", "Replace", "Lowercase"] and spec["normalizer"]["normalizers"][1] == {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
            and [c["type"] for c in cuts] == ["Split", "ByteLevel"] and cuts[0]["invert"] and cuts[0]["behavior"] == "Removed" and not cuts[1]["use_regex"]
            and not cuts[1]["add_prefix_space"] and not any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added.values())
        )
        self.cut = regex.compile(cuts[0]["pattern"]["Regex"]).findall if plain else None
        self.byte_level = None
        if plain:
            from tokenizers.pre_tokenizers import ByteLevel

            self.byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.agreed: set[str] = set()
        self.refused: set[str] = {"Σ"}  # lower-cased by its place in the word
        self.words: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}
        self.tokenize = self.tok.model.tokenize

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _keep(self, held: dict[str, bytes], text: str, packed: bytes) -> bytes:
        if len(text) <= _MOST_LETTERS:
            if len(held) >= _MOST_WORDS:
                held.clear()
            held[text] = packed
        return packed

    def _by_library(self, text: str) -> bytes:
        return self._packed(self.tok.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        # printable ASCII stands for itself in the byte-level alphabet
        mapped = [word] if word.isascii() and word.isprintable() else [m for m, _ in self.byte_level.pre_tokenize_str(word)]
        width, order = self.kind.itemsize, "little"
        return self._keep(self.words, word, b"".join([t.id.to_bytes(width, order) for m in mapped for t in self.tokenize(m)]))

    def _run(self, run: str) -> bytes:
        """Ids of what stands between white space; plain words, with a mark behind them or not, need no pattern."""
        low, known = run.lower(), self.words.get
        if low.isascii() and low[:-1].isalpha() and low[-1] in _ENDS:
            words = [low] if low[-1].isalpha() else [low[:-1], low[-1]]
        else:
            words = self.cut(low)
        return self._keep(self.runs, run, b"".join([known(w) or self._word(w) for w in words]))

    def _by_words(self, text: str) -> bytes:
        out, known, at = [], self.runs.get, 0
        while at < len(text):
            end = at + _SLICE
            while end < len(text) and text[end] not in " \n\t":
                end += 1
            out += [known(run) or self._run(run) for run in text[at:end].split()]
            at = end
        return b"".join(out)

    def _agrees(self, text: str) -> bool:
        chars = set(text)
        for c in chars - self.agreed - self.refused:
            probe = f"a{c}b {c}c1{c}1!{c}!{c} {c}{c}{c}'s{c}'{c}d"
            same = unicodedata.category(c) != "Cn" and unicodedata.is_normalized("NFC", probe) and self._by_words(probe) == self._by_library(probe)
            (self.agreed if same else self.refused).add(c)
        return chars.isdisjoint(self.refused) and (text.isascii() or unicodedata.is_normalized("NFC", text))

    def ids(self, text: str) -> bytes:
        """The text's ids, packed."""
        if self.cut is None:
            return self._by_library(text)
        out = []
        for part in self.parts.split(text) if self.parts else [text]:
            if part:
                out.append(self.special.get(part) or (self._by_words(part) if self._agrees(part) else self._by_library(part)))
        return b"".join(out)


def _loaded(path: str, id_bytes: int) -> WordTokens:
    held = worker_cache()
    key = ("words", path, id_bytes)
    if key not in held:
        held[key] = WordTokens(path, id_bytes)
    return held[key]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well-mixed bits of consecutive numbers."""
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Projection:
    """Hashed vectors of token ids, and their projection to a few dimensions."""

    def __init__(self, size: int = VECTOR, dimensions: int = DIMENSIONS):
        self.size = size
        signs = _mixed(np.arange(size * dimensions) + (1 << 40)) & np.uint64(1)
        self.matrix = np.where(signs, 1.0, -1.0).reshape(size, dimensions)
        self.places, self.signs = np.empty(0, np.int64), np.empty(0)

    def vector(self, ids: np.ndarray) -> np.ndarray:
        """Signed counts of hashed ids, damped by a square root, of length 1 (0 if they cancel out)."""
        if len(ids) and int(ids.max()) >= len(self.places):
            h = _mixed(np.arange(int(ids.max()) + 1))
            self.places, self.signs = (h % np.uint64(self.size)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)
        v = np.bincount(self.places[ids], self.signs[ids], minlength=self.size) if len(ids) else np.zeros(self.size)
        v = np.sign(v) * np.sqrt(np.abs(v))
        norm = np.sqrt(v @ v)
        return v / norm if norm else v

    def __call__(self, ids: np.ndarray) -> list[float]:
        return (self.vector(ids) @ self.matrix).tolist()


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of cells (rows of unsigned coordinates below 2 ** bits), by bitwise rotations."""
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    top = 1 << (bits - 1)
    bit = top
    while bit > 1:  # undo the rotations and reflections of each level
        low = bit - 1
        for i in range(len(x)):
            flip = (x[i] & bit) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
        bit >>= 1
    for i in range(1, len(x)):  # Gray code
        x[i] = x[i] ^ x[i - 1]
    turn, bit = np.zeros_like(x[0]), top
    while bit > 1:
        turn = np.where((x[-1] & bit) != 0, turn ^ (bit - 1), turn)
        bit >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            key = key << 1 | (c ^ turn) >> b & 1
    return key


def _tokenized(locate: Callable[[], str], id_bytes: int, end_id: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, project = _loaded(locate(), id_bytes), Projection()
        end = np.array([end_id], tok.kind).tobytes()
        for batch in batches:
            packed = [tok.ids(t.as_py() or "") for t in batch.column(2)]
            places = [project(np.frombuffer(p, tok.kind)) for p in packed]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(p) // id_bytes + 1 for p in packed], pa.int64()),
                 pa.array(places, pa.list_(pa.float64())), pa.array([p + end for p in packed], pa.binary())],
                ["row", "doc_id", "n", "place", "ids"])

    return run


def _keyed(middle: list[float], deviation: list[float]) -> Callable:
    mean, step = np.array(middle), np.where(np.array(deviation) > 0, deviation, 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = (np.array(batch.column(2).to_pylist()) - mean) / step
            cells = np.clip((at / SPREAD + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hilbert(cells, BITS))], ["row", "n", "key"])

    return run


def along_curve(tokens: DataFrame) -> DataFrame:
    """Keys on the curve: (row, n, key), from rows of (row, n, place); coordinates are scaled by their mean and deviation."""
    moments = [f(F.col("place")[i]) for i in range(DIMENSIONS) for f in (F.avg, F.stddev_pop)]
    found = [x or 0.0 for x in tokens.agg(*moments).first()]
    keyed = _keyed([round(x, 6) for x in found[::2]], [round(x, 6) for x in found[1::2]])
    return tokens.select("row", "n", "place").mapInArrow(keyed, "row bigint, n bigint, key bigint")


def offsets(curve: DataFrame) -> tuple[DataFrame, int]:
    """Where each row's tokens begin when all rows follow each other by (key, row): (row, begin), and the sum of all n."""
    total = curve.agg(F.sum("n")).first()[0] or 0
    keys = ["key", "row"]
    ranges = max(LEAST_RANGES, total // RANGE_TOKENS)
    step = max(total / (ranges * SAMPLES_PER_RANGE), 1.0)
    cuts = splitters(sampled(curve, keys, "n", step, 7), keys, ranges, "n", step)
    placed = with_range(curve, keys, cuts)
    held = placed.groupBy("range").agg(F.sum("n").alias("held"))
    starts = held.select("range", F.coalesce(F.sum("held").over(before("range")), F.lit(0)).alias("begin"))  # a row for each range
    inside = Window.partitionBy("range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumn("upto", F.sum("n").over(inside) - F.col("n"))
    return summed.join(F.broadcast(starts), "range").select("row", (F.col("begin") + F.col("upto")).alias("begin")), total


def sequence_starts(total: int, capacity: int) -> list[int]:
    """Where the sequences after the full ones begin: the rest is cut into powers of two, which need no padding."""
    at = total // capacity * capacity
    out = []
    while at < total:
        out.append(at)
        at += 1 << ((total - at).bit_length() - 1)
    return out


_PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
_FLUSH = 1 << 22  # bytes of ids in a batch of pieces


def _cut(total: int, capacity: int, id_bytes: int) -> Callable:
    full, tail, kind = total // capacity, sequence_starts(total, capacity), np.dtype(f"<u{id_bytes}")
    names = [f.split()[0] for f in _PIECES.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.binary()]

    def bounds(at: int) -> tuple[int, int, int]:
        """Sequence of a place in the long row, with begin and end."""
        if at < full * capacity:
            number = at // capacity
            return number, number * capacity, (number + 1) * capacity
        i = bisect_right(tail, at) - 1
        return full + i, tail[i], tail[i + 1] if i + 1 < len(tail) else total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for doc_id, begin, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                ids = np.frombuffer(packed.as_buffer(), kind).astype("<u4")
                at = 0
                while at < len(ids):
                    number, first, end = bounds(begin + at)
                    n = min(len(ids) - at, end - begin - at)
                    held.append((doc_id, at, n, len(ids), number, begin + at - first, ids[at:at + n].tobytes()))
                    at, size = at + n, size + 4 * n
                    if size >= _FLUSH:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)

    return run


def pack_along_curve(docs: DataFrame, locate: Callable[[], str], capacity: int = CAPACITY, end_id: int = END_ID, id_bytes: int = 2) -> DataFrame:
    """Pieces of the documents in sequences: (doc_id, start, length, doc_tokens, sequence_id, offset, ids).

    `docs` has doc_id and text; `locate` gives the place of a tokenizer file (.json)
    on the machine that runs it. A document is its text's ids, without added
    tokens around them, then `end_id`; `ids` holds a piece's, as little-endian
    unsigned 32-bit numbers (inside, `id_bytes` are kept for each). Like documents
    follow each other, and a document goes on where the one before ends: every
    sequence but the last ones is full, and these are powers of two, so that no
    sequence needs padding. `capacity` must be a power of two. `start` counts the
    document's ids before the piece, `offset` the sequence's.

    Null and empty texts are the end id alone. Rows with equal ids or texts are
    documents each, copies being neighbours. A text of any length is cut into as
    many pieces as it takes; a hot group of copies is cut like other ranges. Other
    columns are ignored, whatever their names. No rows give none.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    tokens = materialize(
        rows.mapInArrow(_tokenized(locate, id_bytes, end_id), "row bigint, doc_id bigint, n bigint, place array<double>, ids binary"), "tokens")
    curve = materialize(along_curve(tokens), "curve")
    begins, total = offsets(curve)
    return tokens.select("row", "doc_id", "ids").join(begins, "row").select("doc_id", "begin", "ids").mapInArrow(_cut(total, capacity, id_bytes), _PIECES)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
