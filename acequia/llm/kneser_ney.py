"""Quality by the perplexity of an interpolated modified Kneser-Ney model of characters.

The model of a language is trained on its trusted texts. Every n-gram of the corpus
is scored once: count tables of all orders, sharded by Spark on their own keys, are
joined to the distinct n-grams. The scores are then joined to the documents' n-gram
frequencies, which travel as one row per n-gram and batch of documents, and are
summed per document. Thresholds are quantiles of the trusted documents' perplexity,
language by language.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acequia.llm.common import broadcast_if_small, lean
from acequia.session import materialize

ORDER = 3
# Documents between these quantiles of their language's trusted perplexities are kept.
QUANTILES = (0.005, 0.995)
FLUSH_PAIRS = 2_000_000  # (document, n-gram) pairs held by a task before they are handed on
_MOST_ROWS = 1 << 16
_PART_BITS = 33
# A pair takes two bytes: the step from the last place above, the frequency below; codes of
# frequency 0 take longer steps, codes of step 0 add to the frequency.
_FREQ_BITS = 4
_MOST_FREQ = (1 << _FREQ_BITS) - 1
_MOST_STEP = (1 << (16 - _FREQ_BITS)) - 1
_CHAR_BITS = 21  # holds every code point, so that an n-gram of up to 3 is one long
_START = 2  # code point put before a text, order - 1 times

_HEAD = pa.list_(pa.struct([
    ("doc_id", pa.int64()), ("key", pa.int64()), ("trusted", pa.bool_()), ("n", pa.int64()), ("place", pa.int32()),
]))
_SEEN = pa.schema([
    ("lang", pa.string()), ("gram", pa.int64()), ("base", pa.int64()), ("pairs", pa.binary()),
    ("trusted", pa.int64()), ("heads", _HEAD),
])
_SEEN_DDL = ("lang string, gram bigint, base bigint, pairs binary, trusted bigint, "
             "heads array<struct<doc_id: bigint, key: bigint, trusted: boolean, n: bigint, place: int>>")


def grams(text: str, order: int) -> np.ndarray:
    """Code points packed into one number per n-gram; as many as characters."""
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    padded = np.concatenate([np.full(order - 1, _START), chars])
    out = np.zeros(len(chars), np.int64)
    for i in range(order):
        out = (out << _CHAR_BITS) | padded[i:i + len(chars)]
    return out


def encode(place: np.ndarray, n: np.ndarray, starts: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Two-byte codes of pairs in rows that begin at `starts` (places ascend in a row), and the byte ends of the rows and one empty row."""
    place, n = place.astype(np.int32, copy=False), n.astype(np.int32, copy=False)
    step = np.diff(place, prepend=np.int32(0))
    step[starts] = place[starts]
    skips = step // _MOST_STEP
    total = skips + (n + _MOST_FREQ - 1) // _MOST_FREQ
    upto = np.concatenate([[0], np.cumsum(total)]).astype(np.int32)
    own = np.repeat(np.arange(len(n), dtype=np.int32), total)
    at = np.arange(upto[-1], dtype=np.int32) - (upto[:-1] + skips)[own]
    codes = np.where(at < 0, _MOST_STEP, np.where(at == 0, (step % _MOST_STEP)[own], 0)) << _FREQ_BITS
    codes |= np.where(at < 0, 0, np.minimum(_MOST_FREQ, n[own] - _MOST_FREQ * at))
    ends = 2 * np.concatenate([upto[starts], [upto[-1], upto[-1]]]).astype(np.int32)
    return codes.astype(np.uint16).tobytes(), ends


def decode(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and frequencies of rows of so many codes."""
    upto = np.concatenate([[0], np.cumsum(codes >> _FREQ_BITS, dtype=np.int64)])
    starts = np.cumsum(sizes) - sizes
    return upto[1:] - np.repeat(upto[starts], sizes), codes & _MOST_FREQ


def _frequencies(order: int) -> Callable:
    """n-gram rows of batches of documents: which documents hold it how often, and its count in trusted ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << _PART_BITS
        held: dict[str, tuple[list, list, list, list]] = {}
        n_pairs = n_rows = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, (found, counts, places, heads) in held.items():
                # 32-bit arrays, dropped as soon as they are used: a task shares its executor's memory
                sizes = [len(f) for f in found]
                ids = np.concatenate(found)
                found.clear()
                order_ = np.argsort(ids, kind="stable")
                ids = ids[order_]
                starts = np.nonzero(np.diff(ids, prepend=-1))[0]
                found_grams = ids[starts].tolist()
                del ids
                n = np.concatenate(counts)[order_]
                counts.clear()
                place = np.repeat(np.array(places, np.int32), sizes)[order_]
                del order_
                trusted = np.zeros(n_rows, bool)
                trusted[places] = [h["trusted"] for h in heads]
                held_trusted = np.where(trusted[place], n, 0)
                sums = np.add.reduceat(held_trusted, starts, dtype=np.int64) if len(n) else n
                del held_trusted
                rows, (codes, ends) = len(starts), encode(place, n, starts)
                pairs = pa.Array.from_buffers(pa.binary(), rows + 1, [None, pa.py_buffer(ends), pa.py_buffer(codes)])
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * (rows + 1), pa.string()), pa.array([*found_grams, None], pa.int64()),
                    pa.array(np.full(rows + 1, base)), pairs, pa.array([*sums.tolist(), 0], pa.int64()),
                    pa.array([*[None] * rows, heads], _HEAD),
                ], schema=_SEEN)

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in (0, 1, 2, 3)]
            for doc_id, key, lang, trusted, text in zip(*columns, batch.column(4)):
                text = text.as_py() or ""
                found, counts, places, heads = held.setdefault(lang, ([], [], [], []))
                ids, n = np.unique(grams(text, order), return_counts=True)
                found.append(ids)
                counts.append(n.astype(np.int32))
                places.append(n_rows)
                heads.append({"doc_id": doc_id, "key": key, "trusted": trusted, "n": len(text), "place": n_rows})
                n_pairs += len(ids)
                n_rows += 1
                if n_pairs >= FLUSH_PAIRS or n_rows == _MOST_ROWS:
                    yield from flush()
                    base += n_rows
                    held, n_pairs, n_rows = {}, 0, 0
        yield from flush()

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Log-likelihood that a task's n-grams add to each document; rows come in the order of their batch."""
    sums, base, most = np.zeros(_MOST_ROWS), None, 0

    def flush() -> pa.RecordBatch:
        out = pa.array([base], pa.int64()), pa.array([sums[:most].tolist()], pa.list_(pa.float64()))
        sums[:most] = 0.0
        return pa.RecordBatch.from_arrays(list(out), ["base", "sums"])

    for batch in batches:
        bases, scores = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
        packed = batch.column(1)
        _, offsets, data = packed.buffers()
        ends = np.frombuffer(offsets, np.int32)[packed.offset:packed.offset + len(packed) + 1] // 2
        flat = np.frombuffer(data, np.uint16, ends[-1]) if len(packed) and ends[-1] else np.empty(0, np.uint16)
        cuts = [0, *np.nonzero(np.diff(bases))[0] + 1, len(bases)]
        for s, e in zip(cuts, cuts[1:]):
            if s == e:
                continue
            if bases[s] != base:
                if base is not None:
                    yield flush()
                base, most = bases[s], 0
            sizes = np.diff(ends[s:e + 1])
            place, freq = decode(flat[ends[s]:ends[e]], sizes)
            value = freq * np.repeat(scores[s:e], sizes)
            top = int(place.max()) + 1 if len(place) else 0
            sums[:top] += np.bincount(place, value, minlength=top)
            most = max(most, top)
    if base is not None:
        yield flush()


def _totalled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum over the tasks for each document; the partial sums of a batch of documents come one after the other."""
    sums, base, most = np.zeros(_MOST_ROWS), None, 0

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(np.full(most, base)), pa.array(np.arange(most, dtype=np.int32)), pa.array(sums[:most].copy())], ["base", "place", "total"])
        sums[:most] = 0.0
        return out

    for batch in batches:
        for own, part in zip(batch.column(0).to_pylist(), batch.column(1)):
            if own != base:
                if base is not None:
                    yield flush()
                base, most = own, 0
            values = part.values.to_numpy()
            sums[:len(values)] += values
            most = max(most, len(values))
    if base is not None:
        yield flush()


def _suffix(gram: str, k: int) -> Column:
    return F.col(gram).bitwiseAND((1 << (_CHAR_BITS * k)) - 1)


def _count_tables(trained: DataFrame, order: int) -> list[DataFrame]:
    """Counts by order 1 to `order`: raw for the highest, of distinct left neighbours for the lower ones."""
    tables = [trained]
    for k in range(order - 1, 0, -1):
        upper = tables[0]
        tables.insert(0, materialize(
            upper.select("lang", _suffix("gram", k).alias("gram")).groupBy("lang", "gram").agg(F.count("*").alias("c")), f"counts-{k}"
        ))
    return tables


def _discounts(table: DataFrame) -> DataFrame:
    """Per language the discounts of counts 1, 2 and more, from the counts of counts."""
    n = [F.sum(F.when(F.col("c") == i, 1).otherwise(0)) for i in range(1, 5)]
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
    raw = [i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}")) for i in (1, 2, 3)]
    # tiny corpora lack some counts: an absolute discount of one half takes their place
    safe = [F.when((d > 0) & (d < i), d).otherwise(F.lit(0.5)) for i, d in enumerate(raw, 1)]
    return table.groupBy("lang").agg(*[x.alias(f"n{i}") for i, x in enumerate(n, 1)]).select(
        "lang", *[d.alias(f"d{i}") for i, d in enumerate(safe, 1)]
    )


def _taken(c: Column) -> Column:
    return F.when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).when(c >= 3, F.col("d3"))


def score_grams(wanted: DataFrame, trained: DataFrame, order: int = ORDER) -> DataFrame:
    """Natural log of the probability of each wanted (lang, gram); null for languages without trained text."""
    tables = _count_tables(trained, order)
    symbols = tables[0].groupBy("lang").agg((F.count("*") + 1).alias("v"))  # one more for characters never seen
    scored = wanted.join(symbols, "lang", "left").select("lang", "gram", (1 / F.col("v")).alias("p"))
    for k, counts in enumerate(tables, 1):
        counts = counts.join(_discounts(counts), "lang").withColumn("less", _taken(F.col("c")))
        context = F.shiftright(F.col("gram"), _CHAR_BITS)
        mass = counts.groupBy("lang", context.alias("context")).agg(
            F.sum("c").alias("all"), F.sum("less").alias("freed")
        )
        own = counts.select("lang", F.col("gram").alias("part"), (F.col("c") - F.col("less")).alias("held"))
        scored = (
            scored.withColumn("part", _suffix("gram", k))
            .withColumn("context", F.shiftright(F.col("part"), _CHAR_BITS))
            .join(mass, ["lang", "context"], "left").join(own, ["lang", "part"], "left")
            .select("lang", "gram", F.when(F.col("all").isNull(), F.col("p")).otherwise(
                (F.coalesce("held", F.lit(0.0)) + F.col("freed") * F.col("p")) / F.col("all")).alias("p"))
        )
    return scored.select("lang", "gram", F.log("p").alias("score"))


def perplexities(docs: DataFrame, trusted: DataFrame, key: Column, order: int = ORDER) -> DataFrame:
    """Every row's perplexity by its language's model: (doc_id, key, lang, trusted, n_grams, perplexity)."""
    if not 1 <= order <= 3:
        raise ValueError("order must be 1 to 3")
    known = broadcast_if_small(materialize(trusted.select(F.col("doc_id").cast("long").alias("doc_id")).dropna().distinct(), "trusted"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"), F.coalesce("lang", F.lit("")).alias("lang"), "text")
    flagged = rows.join(known.withColumn("trusted", F.lit(True)), "doc_id", "left").select(
        "doc_id", "key", "lang", F.coalesce("trusted", F.lit(False)).alias("trusted"), "text"
    )
    seen = materialize(flagged.mapInArrow(lean(_frequencies(order)), _SEEN_DDL), "grams", compression="zstd")
    held = seen.filter("gram is not null")
    trained = materialize(held.filter("trusted > 0").groupBy("lang", "gram").agg(F.sum("trusted").alias("c")), "trained")
    scores = materialize(score_grams(held.select("lang", "gram").distinct(), trained, order).dropna(), "scores")
    joined = held.select("lang", "gram", "base", "pairs").join(scores, ["lang", "gram"]).select("base", "pairs", "score")
    parts = joined.sortWithinPartitions("base").mapInArrow(lean(_summed), "base bigint, sums array<double>")
    sums = parts.repartition("base").sortWithinPartitions("base").mapInArrow(lean(_totalled), "base bigint, place int, total double")
    heads = seen.filter("gram is null").select("lang", "base", F.explode("heads").alias("h")).select(
        "lang", "base", "h.place", "h.doc_id", "h.key", "h.trusted", F.col("h.n").alias("n_grams")
    )
    modelled = trained.select("lang").distinct().withColumn("modelled", F.lit(True))
    perplexity = F.when(F.col("modelled") & (F.col("n_grams") > 0), F.exp(-F.col("total") / F.col("n_grams")))
    return heads.join(sums, ["base", "place"], "left").join(modelled, "lang", "left").select(
        "doc_id", "key", "lang", "trusted", "n_grams", perplexity.alias("perplexity")
    )


def classify(docs: DataFrame, trusted: DataFrame, key: Column, order: int = ORDER,
             quantiles: tuple[float, float] = QUANTILES) -> DataFrame:
    """Keep or reject every row by its perplexity: (doc_id, key, lang, n_grams, perplexity, low, high, kept).

    `docs` has doc_id, text and lang; `trusted` has the doc_id of the trusted
    documents, from whose texts among `docs` the models are trained, one for each
    language, without any bound on their number. n-grams are of characters, a
    text's first ones reach back to a start mark. low and high are the given
    quantiles of the trusted rows' perplexity in the language; a row is kept
    when its perplexity lies between them, bounds included.

    Null and empty texts have no perplexity and are rejected. Null languages form
    one language of their own. Where a language has no trusted text, nothing can
    be judged and all its rows with text are kept. Repeated rows get equal
    verdicts; `key` is any column by which a caller tells rows apart; other
    columns are ignored. No rows give none.
    """
    scored = materialize(perplexities(docs, trusted, key, order), "perplexities")
    bounds = scored.filter("trusted").groupBy("lang").agg(
        F.percentile_approx("perplexity", list(quantiles), 10_000).alias("q")
    ).select("lang", F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))
    inside = F.col("perplexity").isNull() | F.col("low").isNull() | F.col("perplexity").between(F.col("low"), F.col("high"))
    return scored.join(bounds, "lang", "left").select(
        "doc_id", "key", "lang", "n_grams", "perplexity", "low", "high", ((F.col("n_grams") > 0) & inside).alias("kept")
    )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
