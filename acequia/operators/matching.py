"""Linking free-text names to catalogue codes: exact, partial, fuzzy.

Names are normalised (`normalize_text`) and distinct before any of the searches,
so copies of a request cost nothing. Partial and fuzzy matching never compare all
pairs: both reduce to equi joins on pieces that any match must share.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acequia.functions.similarity import lcs_length, ratio
from acequia.functions.text import clean_code, contains_all, first_words, normalize_text, sorted_words
from acequia.operators.cleaning import keep_filled
from acequia.operators.skew import lookup, widen
from acequia.session import materialize

THRESHOLD = 85
# Letters in a key of the fuzzy search; below the deep threshold sets of several would be too many.
DEPTH = 3
DEEP_THRESHOLD = 80
FIRST_WORDS = 4

# Piece lengths of the partial search; the short ones serve entries without longer words.
LONG_GRAMS = (5, 3)
SHORT_GRAMS = (2, 1)

# Largest catalogue sent whole to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024

# Letters of normalised names, for the letter-count signature of the fuzzy search.
ALPHABET = " 0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_COUNTED = 3  # occurrences of a letter that are told apart
_PER_WORD = 63 // _COUNTED


def build_catalogue(sources: Sequence[tuple[DataFrame, str, str, str]]) -> DataFrame:
    """One entry per normalised name: (name, code, pos).

    Sources are (frame, code column, name column, order column), in order of
    precedence. A repeated name keeps its first place and takes its last code.
    `pos` is (source number, order) and sorts the entries. Rows without code or
    name, and names that normalise to nothing, are left out.
    """
    parts = []
    for i, (df, code, name, order) in enumerate(sources):
        rows = df.select(
            clean_code(F.col(code)).alias("code"), F.col(name).alias("raw"),
            F.struct(F.lit(i).alias("source"), F.col(order).cast("long").alias("ord")).alias("pos"),
        )
        parts.append(keep_filled(rows, "code", "raw"))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return (
        union.withColumn("name", normalize_text(F.col("raw")))
        .filter(F.col("name") != "")
        .groupBy("name")
        .agg(F.max_by("code", "pos").alias("code"), F.min("pos").alias("pos"))
    )


def spellings(
    orders: DataFrame, name_col: str, keep: Callable[[DataFrame, str], DataFrame] = materialize
) -> DataFrame:
    """(raw, name): the distinct texts of the order lines, each normalised once, stored by `keep`.

    Not a lazy frame: Spark would move conditions on pieces of a name below the
    distinct and normalise every line once per condition. The empty name may be
    among the names; no step matches it.
    """
    raw = orders.select(F.col(name_col).alias("raw")).distinct()
    return keep(widen(raw, "raw").select("raw", normalize_text(F.col("raw")).alias("name")), "spellings")


def distinct_names(
    orders: DataFrame, name_col: str, keep: Callable[[DataFrame, str], DataFrame] = materialize
) -> DataFrame:
    """(name): the distinct normalised names of the order lines."""
    return spellings(orders, name_col, keep).select("name").distinct()


def match_exact(names: DataFrame, catalogue: DataFrame) -> DataFrame:
    """(name, code) of the names that are catalogue names."""
    return names.join(catalogue.select("name", "code"), "name")


def _pieces(text: Column, n: int) -> Column:
    """All substrings of length n, empty for shorter texts."""
    starts = F.sequence(F.lit(1), F.length(text) - n + 1)
    return F.when(
        F.length(text) >= n, F.transform(starts, lambda i: F.substr(text, i, F.lit(n)))
    ).otherwise(F.array().cast("array<string>"))


def _search_pieces(words: Column) -> Column:
    """Pieces by which a word set may be found: of the longest kinds its words allow."""

    def of(n: int) -> Column:
        return F.flatten(F.transform(words, lambda w: _pieces(w, n)))

    long_pieces = F.concat(*[of(n) for n in LONG_GRAMS])
    pick = of(SHORT_GRAMS[-1])
    for n in reversed(SHORT_GRAMS[:-1]):
        found = of(n)
        pick = F.when(F.size(found) > 0, found).otherwise(pick)
    return F.array_distinct(F.when(F.size(long_pieces) > 0, long_pieces).otherwise(pick))


def _signature(pieces: str) -> list[Column]:
    """Two 64-bit words (`_lo`, `_hi`) with one bit for each piece of an array column, by hash.

    If all pieces of A are among those of B, then so are A's bits among B's.
    """
    mask = (
        "aggregate({p}, 0L, (m, g) -> m | if(pmod(xxhash64(g), 2) = {half}, "
        "shiftleft(1L, cast(pmod(xxhash64(g) div 2, 64) as int)), 0L))"
    )
    return [F.expr(mask.format(p=pieces, half=h)).alias(n) for h, n in ((0, "_lo"), (1, "_hi"))]


def word_patterns(catalogue: DataFrame, n_words: int = FIRST_WORDS) -> DataFrame:
    """Distinct word sets to search for: (words, code, pos, gram).

    Entries sharing their first words collapse to the first of them. `gram` is the
    piece of a word that the fewest patterns share.
    """
    patterns = (
        catalogue.withColumn("words", F.array_sort(F.array_distinct(first_words(F.col("name"), n_words))))
        .groupBy("words")
        .agg(F.min_by("code", "pos").alias("code"), F.min("pos").alias("pos"))
    )
    spread = patterns.select("words", "code", "pos", F.explode(_search_pieces(F.col("words"))).alias("gram"))
    shared = spread.groupBy("gram").agg(F.count(F.lit(1)).alias("_shared"))
    rarest = F.struct(F.col("_shared"), -F.length("gram"), F.col("gram"))
    return (
        lookup(spread, shared, "gram")
        .groupBy("words", "code", "pos")
        .agg(F.min_by("gram", rarest).alias("gram"))
    )


def _bytes(catalogue: DataFrame) -> int:
    """Upper bound for the size of the catalogue's patterns."""
    return catalogue.agg(F.sum(4 * F.length("name") + 200)).first()[0] or 0


def match_partial(names: DataFrame, catalogue: DataFrame, n_words: int = FIRST_WORDS) -> DataFrame:
    """(name, code) where a name contains all of an entry's first words; first entry wins.

    Words count as substrings. Every pattern is filed under one gram that a matching
    name must contain. Tests run inside the join, so that only true matches leave it,
    and they shrink to one row per name and task before the shuffle: first bit
    signatures of all letter pairs, then containment itself.
    """
    grams = F.flatten(F.array(*[_pieces(F.col("name"), n) for n in (*LONG_GRAMS, *SHORT_GRAMS)]))
    # signatures come before the shuffle: after it they would be computed per piece
    signed = names.withColumn("_pairs", _pieces(F.col("name"), 2)).select("name", *_signature("_pairs"))
    spread = widen(signed, "name").withColumn("gram", F.explode(F.array_distinct(grams)))
    patterns = (
        word_patterns(catalogue, n_words)
        .withColumn("_pairs", F.flatten(F.transform("words", lambda w: _pieces(w, 2))))
        .select("words", "code", "pos", "gram", *_signature("_pairs"))
    )
    covered = F.lit(True)
    for c in ("_lo", "_hi"):
        covered = covered & (F.col(f"p.{c}").bitwiseAND(F.bitwise_not(F.col(f"s.{c}"))) == 0)
    hit = (F.col("s.gram") == F.col("p.gram")) & covered & contains_all(F.col("s.name"), F.col("p.words"))
    # A small catalogue spares the shuffle of all pieces of all names. Spark cannot
    # judge that itself: it does not see how much the pieces outgrow the names.
    how = "broadcast" if _bytes(catalogue) <= BROADCAST_BYTES else "merge"
    return (
        spread.alias("s")
        .join(patterns.hint(how).alias("p"), hit)
        .groupBy("name")
        .agg(F.min_by("code", "pos").alias("code"))
    )


def _letters(text: str) -> list[Column]:
    """Two 64-bit words (`_lo`, `_hi`) with a bit for each of the first occurrences of a letter.

    One insertion or deletion changes at most one bit.
    """
    out = []
    for at, name in ((0, "_lo"), (_PER_WORD, "_hi")):
        bits = [
            f"shiftleft(shiftleft(1L, least(length({text}) - length(translate({text}, '{ch}', '')), {_COUNTED})) - 1L,"
            f" {_COUNTED * i})"
            for i, ch in enumerate(ALPHABET[at: at + _PER_WORD])
        ]
        out.append(F.expr(" | ".join(bits)).alias(name))
    return out


def _pieces_of(text: str) -> list[str]:
    """The letters of a text, each with its number among the equal ones: `A1`, `B1`, `A2` ..."""
    seen: dict[str, int] = {}
    out = []
    for ch in text:
        seen[ch] = seen.get(ch, 0) + 1
        out.append(f"{ch}{seen[ch]}")
    return out


def piece_order(texts: DataFrame, col: str) -> dict[str, int]:
    """Rank of every letter piece among the texts, rare ones first.

    There are no more pieces than letters times the length of the longest text,
    whatever the number of texts; they are counted in Spark.
    """
    letters = texts.select(F.array_sort(F.split(col, "")).alias("s"))
    numbered = F.transform("s", lambda c, i: F.concat(c, (i - F.array_position("s", c) + 2).cast("string")))
    counts = letters.select(F.explode(numbered).alias("piece")).groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    return {r.piece: i for i, r in enumerate(counts.orderBy("n", "piece").collect())}


def partner_lengths(length: int, t: int) -> range:
    """Lengths of the texts that can be similar to one of this length."""
    return range((t * length + 199 - t) // (200 - t), ((200 - t) * length) // t + 1)


def prefix_keys(texts: pd.Series, order: dict[str, int], t: int, depth: int, left: bool) -> list[np.ndarray]:
    """Join keys of each text: for every length of a partner, hashes of sets of its rarest letter pieces.

    Texts of lengths a and b that reach the threshold share at least n =
    ceil(t * (a + b) / 200) letters, hence as many pieces. Of the pieces in their
    common order the first a - n + k of one text and b - n + k of the other have k in common
    (k <= n), as all pieces behind those are fewer than n - k + 1. So one set of k
    pieces out of these beginnings is a key of both. Lengths belong to the key;
    `left` tells which side comes first in it.
    """
    unknown = len(order)
    made: dict[str, np.ndarray] = {}
    groups: dict[int, list[tuple[str, np.ndarray]]] = {}
    for text in texts:
        if text not in made:
            made[text] = np.empty(0, np.int64)
            # pieces that no entry has come first: they match nothing, and their ranks tell them apart
            ranks = sorted(order.get(p, -1 - int.from_bytes(p.encode(), "little") % (1 << 40)) for p in _pieces_of(text))
            groups.setdefault(len(text), []).append((text, np.array(ranks, np.int64)))
    for length, held in groups.items():
        ranks = _mix(np.stack([r for _, r in held]).astype(np.uint64)) if length else np.empty((len(held), 0), np.uint64)
        parts = []
        for other in partner_lengths(length, t):
            need = -(-t * (length + other) // 200)
            k = min(depth, need)
            if need > min(length, other) or not k:
                continue
            sets = np.array(list(combinations(range(length - need + k), k)))
            a, b = (length, other) if left else (other, length)
            key = np.full((len(held), len(sets)), a * (unknown + 1_000_003) + b, np.uint64)
            for i in range(k):
                key = _mix(key ^ ranks[:, sets[:, i]])
            parts.append(key)
        joined = np.concatenate(parts, axis=1).view(np.int64) if parts else np.empty((len(held), 0), np.int64)
        for (text, _), row in zip(held, joined):
            made[text] = row
    return [made[text] for text in texts]


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _keyed(texts: DataFrame, order: dict[str, int], t: int, left: bool) -> DataFrame:
    """(key, id, n, bits) of distinct texts in column `text`."""
    depth = DEPTH if t >= DEEP_THRESHOLD else 1

    @F.pandas_udf("array<bigint>")
    def keys(series: pd.Series) -> pd.Series:
        return pd.Series(prefix_keys(series, order, t, depth, left))

    signed = widen(texts, "text").select(F.xxhash64("text").alias("id"), F.length("text").alias("n"), *_letters("text"), keys("text").alias("keys"))
    return signed.select(F.explode("keys").alias("key"), "id", "n", "_lo", "_hi")


def fuzzy_candidates(
    names: DataFrame, catalogue: DataFrame, threshold: int = THRESHOLD,
    keep: Callable[[DataFrame, str], DataFrame] = materialize,
) -> DataFrame:
    """Distinct (name, text, entry, code, pos) that may reach the threshold; loses no match.

    Word-sorted texts are joined on sets of their rarest letters (`prefix_keys`), by
    numbers alone. Letter counts discard most pairs inside the join, before anything
    is shuffled: letters that the request has in excess must be deleted, those it
    lacks inserted, and deletions and insertions are bounded by the lengths and the
    threshold. What is left gets its texts back. Ids are hashes of the texts: two
    texts that share one only make each other's candidates.
    """
    if not 1 <= threshold <= 100:
        raise ValueError(f"threshold must lie in 1..100, not {threshold}")
    requests = keep(names.select("name", sorted_words(F.col("name")).alias("text")), "requests")
    entries = keep(
        catalogue.withColumn("entry", sorted_words(F.col("name"))).groupBy("entry")
        .agg(F.min_by("code", "pos").alias("code"), F.min("pos").alias("pos")), "entries")
    order = piece_order(entries, "entry")
    left = _keyed(requests.select("text").distinct(), order, threshold, True).alias("r")
    # merge join: Spark would broadcast the entries by their size before their keys are made
    right = _keyed(entries.select(F.col("entry").alias("text")), order, threshold, False).hint("merge").alias("e")
    edits = f"((100 - {threshold}) * (e.n + r.n)) div 100"
    surplus, lacking = (
        f"bit_count({x}._lo & ~{y}._lo) + bit_count({x}._hi & ~{y}._hi)" for x, y in (("r", "e"), ("e", "r"))
    )
    near = F.expr(f"2 * ({surplus}) <= {edits} - e.n + r.n and 2 * ({lacking}) <= {edits} + e.n - r.n")
    pairs = left.join(right, (F.col("r.key") == F.col("e.key")) & near).select(F.col("r.id").alias("r"), F.col("e.id").alias("e")).distinct()
    return (
        pairs.join(requests.withColumn("r", F.xxhash64("text")), "r").join(entries.withColumn("e", F.xxhash64("entry")), "e")
        .select("name", "text", "entry", "code", "pos")
    )


def match_fuzzy(
    names: DataFrame, catalogue: DataFrame, threshold: int = THRESHOLD,
    keep: Callable[[DataFrame, str], DataFrame] = materialize,
) -> DataFrame:
    """(name, code, score) of the most similar entry with a score of at least the threshold.

    The score is token-sort similarity; among equal scores the first entry wins.
    """
    pairs = fuzzy_candidates(names, catalogue, threshold, keep).withColumn(
        "_lcs", lcs_length(F.col("text"), F.col("entry"))
    )
    total = F.length("text") + F.length("entry")
    score = ratio(F.col("_lcs"), F.col("text"), F.col("entry"))
    return (
        pairs.filter(200 * F.col("_lcs") >= threshold * total)
        .withColumn("score", score)
        .groupBy("name")
        .agg(F.min_by(F.struct("code", "score"), F.struct(-F.col("score"), "pos")).alias("_best"))
        .select("name", "_best.code", "_best.score")
    )


def match_names(
    names: DataFrame,
    catalogue: DataFrame,
    threshold: int = THRESHOLD,
    use_fuzzy: bool = True,
    keep: Callable[[DataFrame, str], DataFrame] = materialize,
) -> DataFrame:
    """(name, code, step) for the distinct non-empty names that any step can code.

    Each step sees what the ones before it left over. `keep` stores the result of a
    step, so that later ones do not repeat it; by default in the shared folder.
    """
    coded = keep(match_exact(names, catalogue).withColumn("step", F.lit("exact")), "exact")
    rest = names.join(coded.select("name"), "name", "left_anti")
    partial = keep(match_partial(rest, catalogue).withColumn("step", F.lit("partial")), "partial")
    out = coded.unionByName(partial)
    if use_fuzzy:
        rest = rest.join(partial.select("name"), "name", "left_anti")
        fuzzy = match_fuzzy(rest, catalogue, threshold, keep).select("name", "code", F.lit("fuzzy").alias("step"))
        out = out.unionByName(keep(fuzzy, "fuzzy"))
    return out


def code_orders(
    orders: DataFrame,
    catalogue: DataFrame,
    name_col: str,
    threshold: int = THRESHOLD,
    use_fuzzy: bool = True,
    keep: Callable[[DataFrame, str], DataFrame] = materialize,
) -> DataFrame:
    """Order lines with `code` and `step`; lines that no step can code have null and `none`."""
    spelled = spellings(orders, name_col, keep)
    codes = match_names(spelled.select("name").distinct(), keep(catalogue, "catalogue"), threshold, use_fuzzy, keep)
    coded = spelled.join(codes, "name").select(F.col("raw").alias("_raw"), "code", "step")
    return (
        lookup(orders.withColumn("_raw", F.col(name_col)), coded, "_raw")
        .withColumn("step", F.coalesce("step", F.lit("none")))
        .drop("_raw")
    )


def match_rates(coded: DataFrame) -> DataFrame:
    """Lines and their share per step."""
    counts = coded.groupBy("step").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / coded.agg(F.count(F.lit(1)).alias("n")).scalar())


# Executors get the functions themselves and need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
