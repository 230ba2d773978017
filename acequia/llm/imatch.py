"""I-Match fingerprints with randomised lexicons.

A document's terms are mapped to slots; slots whose document frequency lies within a
band are the lexicon. The document's lexicon slots, distinct and sorted, are hashed
once for each of several random subsets of the lexicon, of densities 1, 1/2, 1/4 ...:
dense subsets tell near-equal texts apart, sparse ones survive larger edits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acequia.llm.ranges import sampled, splitters, with_range
from acequia.session import materialize

SLOTS = 1 << 19
# Share of documents that may hold a term of the lexicon, from rare to common.
BAND = (0.002, 0.25)
# Subsets by density: so many that keep one slot of 2 ** d. The sparser ones, which survive large
# edits, are met by few texts each, hence their number.
SUBSETS = {0: 1, 2: 2, 4: 3, 5: 4, 6: 6, 7: 8, 8: 8, 9: 8, 10: 8}
RANGE_BYTES = 16 << 20
MOST_RANGES = 1 << 16
SAMPLES_PER_RANGE = 16
_EMPTY = 42  # what xxhash64 gives for an empty array


def term_slots(text: Column, slots: int) -> Column:
    """Distinct slots of a text's terms: runs of letters and digits, lower-cased."""
    terms = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")
    return F.array_distinct(F.transform(terms, lambda t: F.pmod(F.xxhash64(t), F.lit(slots)).cast("int")))


def lexicon(texts: DataFrame, band: tuple[float, float] = BAND, slots: int = SLOTS) -> DataFrame:
    """One row with a bitmap of the slots within the band of document frequency (at least 2 documents)."""
    total = texts.count()
    low, high = max(2.0, band[0] * total), max(2.0, band[1] * total)
    df = texts.select(F.explode(term_slots(F.col("text"), slots)).alias("slot")).groupBy("slot").agg(F.count("*").alias("df"))
    words = df.filter(F.col("df").between(low, high)).groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, slot & 63)")).alias("bits")
    )
    every = texts.sparkSession.range(slots // 64).select(F.col("id").cast("int").alias("word")).join(words, "word", "left")
    rows = F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits"))))
    return every.agg(F.transform(rows, lambda x: x["bits"]).alias("lexicon"))


def with_memberships(lexicon: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The lexicon's row with `before`, the number of its slots before each word of the bitmap, and `members`.

    `members` holds for each slot of the lexicon, in order, the subsets that hold
    it, as bits in the order of `SUBSETS`. So no text hashes its slots for every
    subset. The work depends on the number of slots alone.
    """
    places = [(100 * d + i, (1 << d) - 1) for d, n in SUBSETS.items() for i in range(n)]

    def held(slot: Column) -> Column:
        out = F.lit(0).cast("long")
        for k, (seed, mask) in enumerate(places):
            hit = F.hash(slot, F.lit(seed)).bitwiseAND(F.lit(mask)) == 0
            out = out.bitwiseOR(F.when(hit, F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")))
        return out

    word = F.col("word")
    words = lexicon.select(F.posexplode("lexicon").alias("word", "bits"))
    known = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit("bits", b) == 1)
    words = words.select("word", "bits", F.transform(known, lambda b: held((word * 64 + b).cast("int"))).alias("held"))
    upto = Window.orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
    words = words.withColumn("before", F.coalesce(F.sum(F.size("held")).over(upto), F.lit(0)).cast("int"))
    rows = words.agg(F.sort_array(F.collect_list(F.struct("word", "bits", "before", "held"))).alias("rows"))
    return rows.select(
        F.transform("rows", lambda x: x["bits"]).alias("lexicon"), F.transform("rows", lambda x: x["before"]).alias("before"),
        F.flatten(F.transform("rows", lambda x: x["held"])).alias("members"))


def fingerprint(text: Column, bits: Column, before: Column, members: Column, slots: int = SLOTS) -> Column:
    """One hash per random lexicon subset, null where the text has no term of it.

    Takes the columns of `with_memberships`. A text's slots are first narrowed to
    those that any subset of a density holds, which are few for the many sparse
    subsets. A last place holds a hash of the whole text if it has no lexicon term
    at all, so that such texts are alike only when equal.
    """
    def word(slot: Column) -> Column:
        return F.element_at(bits, F.shiftright(slot, 6) + 1)

    def within(slot: Column) -> Column:
        return F.getbit(word(slot), slot.bitwiseAND(63)) == 1

    def held(slot: Column) -> Column:
        lower = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), slot.bitwiseAND(63)))
        rank = F.element_at(before, F.shiftright(slot, 6) + 1) + F.bit_count(word(slot).bitwiseAND(lower))
        return F.element_at(members, rank + 1)

    def one_of(first: int, n: int, pairs: Column) -> Column:
        subsets, any_of = F.array(*[F.lit(k) for k in range(first, first + n)]), F.lit(((1 << n) - 1) << first).cast("long")
        some = F.filter(pairs, lambda p: p["held"].bitwiseAND(any_of) != 0)
        found = F.transform(F.array(some), lambda few: F.transform(subsets, lambda k: F.xxhash64(
            F.transform(F.filter(few, lambda p: F.getbit(p["held"], k) == 1), lambda p: p["slot"]))))
        return F.transform(F.element_at(found, 1), lambda h: F.when(h != _EMPTY, h))

    def hashed(pairs: Column) -> Column:
        each, first = [], 0
        for n in SUBSETS.values():
            each.append(one_of(first, n, pairs))
            first += n
        return F.concat(*each, F.array(F.when(F.size(pairs) == 0, F.xxhash64(text))))

    # the one-element arrays bind a value once, or it would be worked out again for every use
    band = F.sort_array(F.filter(term_slots(text, slots), within))
    pairs = F.transform(band, lambda x: F.struct(x.alias("slot"), held(x).alias("held")))
    return F.element_at(F.transform(F.array(pairs), hashed), 1)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets of which either text has a term."""
    pairs = F.arrays_zip(a.alias("a"), b.alias("b"))
    some = F.size(F.filter(pairs, lambda p: p["a"].isNotNull() | p["b"].isNotNull()))
    equal = F.size(F.filter(pairs, lambda p: p["a"] == p["b"]))
    return equal / some


def spelled(fp: Column) -> Column:
    return F.concat_ws(".", F.transform(fp, lambda x: F.coalesce(F.lower(F.hex(x)), F.lit(""))))


def with_previous(rows: DataFrame, keys: list[str], size: str, carried: list[str]) -> DataFrame:
    """Every row's predecessor by the keys, the first row's being the last: adds prev_<column>.

    Rows are put in ranges of the key order; the last row of each range is also
    sent to the next range, marked `ghost`, so that one window per range suffices.
    Ghosts stay in the result for a further look-back; filter them in the end.
    """
    narrow = materialize(rows.select(*keys, size), "order")
    total = narrow.agg(F.sum(size)).first()[0] or 0
    ranges = max(1, min(MOST_RANGES, -(-total // RANGE_BYTES)))
    step = max(total / (ranges * SAMPLES_PER_RANGE), 1.0)
    cuts = splitters(sampled(narrow, keys, size, step, 3), keys, ranges, size, step) if ranges > 1 else []
    ends = with_range(narrow, keys, cuts).groupBy("range").agg(F.max(F.struct(*keys)).alias("end"))
    # one row per range: the range that its end precedes, from the last one to the first
    ahead = F.lead("range").over(Window.orderBy("range"))
    ghosts = ends.select("range", "end", F.coalesce(ahead, F.min("range").over(Window.partitionBy())).alias("target"))
    placed = with_range(rows, keys, cuts).join(F.broadcast(ghosts), "range", "left")
    here = F.array(F.struct(F.lit(False).alias("ghost"), F.col("range").alias("place")))
    there = F.array(F.struct(F.lit(True).alias("ghost"), F.col("target").alias("place")))
    both = placed.withColumn("to", F.explode(F.when(F.struct(*keys) == F.col("end"), F.concat(here, there)).otherwise(here)))
    both = both.select(*rows.columns, F.col("to.place").alias("place"), F.col("to.ghost").alias("ghost"))
    return both.select("*", *[F.lag(c).over(in_range(keys)).alias(f"prev_{c}") for c in carried])


def in_range(keys: list[str]) -> Window:
    return Window.partitionBy("place").orderBy(F.col("ghost").desc(), *keys)


def fingerprint_documents(docs: DataFrame, band: tuple[float, float] = BAND, slots: int = SLOTS) -> DataFrame:
    """Fingerprints of every whole text and of an edited text: see the columns below.

    The edited text's last floor(n_chars / 3) code points are replaced by the first
    as many (or all) of the next document's, in descending doc_id; after the last
    comes the first. Rows with equal ids follow each other by a hash of the text,
    rows without id come last. Null texts count as empty; equal texts have equal
    fingerprints; no rows give none.

    doc_id, n_chars (code points), edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next (likeness to the edited text's and the next
    document's fingerprint, 0 to 1).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    bits = F.broadcast(with_memberships(lexicon(rows, band, slots), slots))
    rows = rows.select(
        "*", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), F.xxhash64("text").alias("h"),
        (F.octet_length("text") + 8).cast("long").alias("size"),
    )
    keys = ["id", "h"]
    paired = with_previous(rows, keys, "size", ["text"])
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - int(floor(length(text) / 3)))"),
                      F.substring(F.coalesce("prev_text", F.lit("")), F.lit(1), cut))
    texts = paired.select("doc_id", *keys, "place", "ghost", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    printed = texts.crossJoin(bits).select(
        "doc_id", *keys, "place", "ghost", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        F.transform(F.array("text", "edited"), lambda t: fingerprint(t, F.col("lexicon"), F.col("before"), F.col("members"), slots)).alias("prints"),
    )
    own, changed = F.col("prints")[0], F.col("prints")[1]
    known = printed.select("*", F.lag(own).over(in_range(keys)).alias("next"))
    return known.filter(~F.col("ghost")).select(
        "doc_id", "n_chars", "edited_sha256", spelled(own).alias("fingerprint"), spelled(changed).alias("edited_fingerprint"),
        likeness(own, changed).alias("near_edited"), likeness(own, F.col("next")).alias("near_next"),
    )
