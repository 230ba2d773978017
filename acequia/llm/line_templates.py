"""Line dedup by a log-template tree.

Lines go down a tree of fixed depth: token count, then the leading tokens (tokens
with digits count as variable). Only leaves that several documents reach can hold
a recurring template. Inside a leaf a token is constant at its position if enough
documents have it there, compared with the line's other tokens: common values of a
field have many documents in a large leaf, but far fewer than the words around
the field; such tokens are variable fields. A line whose constants make
up enough of it gets the template with its variable fields masked; otherwise the
line itself (digits masked) is its template. Templates that enough documents
share recur, and their lines are dropped; a group of copies counts as one document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acequia.llm.common import broadcast_if_small
from acequia.session import discard, materialize

LEADING = 2  # tokens below the token count that choose the leaf
MIN_DOCUMENTS = 3
# Lines of more than LONG_WORDS words recur from LONG_DOCUMENTS on; short ones may be alike by chance.
LONG_WORDS = 50
LONG_DOCUMENTS = 2
CONSTANT_SHARE = 0.7
# A token is constant if it has at least this part of the documents that the line's other constants have.
NODE_SHARE = 0.5
# Copies: word shingles and likeness as in near dedup, and what limits the comparisons (see copy_classes).
SHINGLE_WORDS = 5
COPY_SHARE = 0.8
RISK_SHARE = 0.2
LED_SHARE = 0.05
PART = 4  # one of so many shingles is compared first; a power of two
MOST_JUMPS = 40
# Leaves of at most so many distinct lines and characters are compared line by line in one row, others by joins on nodes.
LEAF_LINES = 16
LEAF_CHARS = 1 << 20
VARIABLE = "<*>"


def _even(line: Column) -> Column:
    """The line's tokens with one space between them; most lines are so.

    The tests before the step are plain searches, which cost far less than the replacement.
    """
    uneven = F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" "))
    for white in ("  ", "\t", "\x0b", "\f", "\r"):
        uneven |= F.contains(line, F.lit(white))
    return F.when(uneven, F.btrim(F.regexp_replace(line, r"[ \t\x0b\f\r]+", " "))).otherwise(line)


def _spaces(line: Column) -> Column:
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit("")))


def masked(even: Column) -> Column:
    """The line with its tokens that have a digit masked; the test costs less than the replacement that most lines do not need."""
    return F.when(even.rlike("[0-9]"), F.regexp_replace(even, "(?<![^ ])[^ 0-9]*+[0-9][^ ]*", VARIABLE)).otherwise(even)


def _lines(docs: DataFrame, key: Column, leading: int) -> DataFrame:
    """Lines that hold anything but white space: (key, line_no, raw, long, leaf).

    Masking changes no token count, so that the leaf takes only the leading tokens masked.
    """
    # the key comes before the lines, or it would be worked out again for each
    each = docs.select(key.alias("key"), "text").select("key", F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
    each = each.filter(F.btrim("raw", F.lit(" \t\x0b\f\r")) != "").withColumn("even", _even(F.col("raw")))
    each = each.select("key", "line_no", "raw", _spaces(F.col("even")).alias("spaces"), F.substring_index("even", " ", leading).alias("head"))
    return each.select("key", "line_no", "raw", (F.col("spaces") >= LONG_WORDS).alias("long"), F.xxhash64("spaces", masked(F.col("head"))).alias("leaf"))


def _nodes_by_joins(distinct: DataFrame, enough: Column) -> DataFrame:
    """Constants of each line: (leaf, line, tokens, counts, nodes), by joins on all nodes; for leaves of any size.

    A node is a token at its place in a leaf, as one number; variable tokens are none. Lines without constants are left out.
    """
    split = distinct.select("leaf", "line", "long", "n", (_spaces(F.col("masked")) + 1).alias("tokens"), "masked")
    spread = split.select("leaf", "line", "long", "n", "tokens", F.posexplode(F.split("masked", " ")).alias("place", "token"))
    placed = spread.filter(F.col("token") != VARIABLE).select("leaf", "line", "long", "n", "tokens", F.xxhash64("leaf", "place", "token").alias("node"))
    constant = materialize(placed.groupBy("long", "node").agg(F.sum("n").alias("n")).filter(enough).select("node", "n"), "constants")
    return placed.select("leaf", "line", "tokens", "node").join(broadcast_if_small(constant), "node").groupBy("leaf", "line", "tokens").agg(
        F.collect_list("n").alias("counts"), F.collect_list("node").alias("nodes"))  # at most a line's tokens


def _nodes_by_lines(distinct: DataFrame, enough: Callable[[Column], Column]) -> DataFrame:
    """As `_nodes_by_joins` for leaves of few lines: each is compared with its leaf's others place by place. Counts that are no constants' are null."""
    leaves = distinct.groupBy("leaf", "long").agg(F.collect_list(F.struct("line", "n", "masked")).alias("lines"))  # at most LEAF_LINES

    def spelled(x: Column) -> Column:
        nodes = F.transform(F.split(x["masked"], " "), lambda token, place: F.when(token != VARIABLE, F.xxhash64("leaf", place, token)))
        return F.struct(x["line"].alias("line"), x["n"].alias("n"), nodes.alias("nodes"))

    def documents(node: Column, place: Column) -> Column:
        held = F.aggregate("lines", F.lit(0).cast("long"), lambda n, y: n + F.when(F.get(y["nodes"], place) == node, y["n"]).otherwise(0))
        return F.when(node.isNotNull(), held)

    def counted(x: Column) -> Column:
        counts = F.transform(F.transform(x["nodes"], documents), lambda n: F.when(enough(n), n))
        return F.struct(x["line"].alias("line"), counts.alias("counts"), x["nodes"].alias("nodes"))

    leaves = leaves.select("leaf", "long", F.transform("lines", spelled).alias("lines"))
    each = leaves.select("leaf", F.explode(F.transform("lines", counted)).alias("x"))
    return each.select("leaf", "x.line", F.size("x.nodes").alias("tokens"), "x.counts", "x.nodes")


def recurring_lines(docs: DataFrame, key: Column, min_documents: int = MIN_DOCUMENTS,
                    constant_share: float = CONSTANT_SHARE, leading: int = LEADING) -> DataFrame:
    """Lines whose template enough documents hold: (key, line_no, recurs), `recurs` if these are of enough groups of copies.

    `key` tells documents apart; equal keys count once.
    """
    lines = _lines(docs, key, leading)

    def frequent_enough(n: Column) -> Column:
        return n >= F.when(F.col("long"), F.least(F.lit(min_documents), F.lit(LONG_DOCUMENTS))).otherwise(F.lit(min_documents))

    enough = frequent_enough(F.col("n"))
    leaves = (
        lines.select("leaf", "long", "key").distinct().groupBy("leaf", "long").agg(F.count("*").alias("n"))
        .filter(enough).select("leaf")
    )
    leaves = materialize(leaves, "leaves")
    found = lines.join(broadcast_if_small(leaves), "leaf", "left_semi")
    found = found.select("key", "line_no", F.length("raw").alias("chars"), "long", "leaf", _even(F.col("raw")).alias("even"))
    found = found.select("key", "line_no", "chars", "long", "leaf", masked(F.col("even")).alias("masked")).withColumn("line", F.xxhash64("masked"))
    candidates = materialize(found, "lines", compression="zstd")
    # distinct lines with the number of documents that hold them
    held = candidates.select("leaf", "line", "key").distinct().groupBy("leaf", "line").agg(F.count("*").alias("n"))
    texts = candidates.select("leaf", "line", "long", "masked").dropDuplicates(["leaf", "line"])
    distinct = materialize(texts.join(held, ["leaf", "line"]), "distinct_lines", compression="zstd")
    # a leaf's only line has one template, general or its own, and stays out
    sizes = materialize(distinct.groupBy("leaf").agg(F.count("*").alias("lines"), F.sum(F.length("masked")).alias("chars")).filter("lines > 1").select(
        "leaf", ((F.col("lines") <= LEAF_LINES) & (F.col("chars") <= LEAF_CHARS)).alias("small")), "leaf_sizes")

    def in_leaves(which: Column) -> DataFrame:
        return distinct.join(broadcast_if_small(sizes.filter(which).select("leaf")), "leaf", "left_semi")

    met = _nodes_by_lines(in_leaves(F.col("small")), frequent_enough).unionByName(_nodes_by_joins(in_leaves(~F.col("small")), enough))
    # documents of the last constant that the line needs to be a template: all its constants have about as many or more
    needed = F.coalesce(F.get(F.sort_array("counts", asc=False), F.ceil(constant_share * F.col("tokens")).cast("int") - 1), F.lit(0))

    def spelled(least: Column) -> Column:
        constants = F.filter(F.arrays_zip("counts", "nodes"), lambda x: x["counts"] >= least)
        return F.sort_array(F.transform(constants, lambda x: x["nodes"]))

    def named(fixed: Column) -> Column:
        return F.when(F.size(fixed) >= constant_share * F.col("tokens"), F.xxhash64("leaf", fixed))

    # the one-element arrays bind a value once, or it would be worked out again for every constant
    fixed = F.transform(F.array(NODE_SHARE * needed), spelled)
    general = met.select("leaf", "line", F.element_at(F.transform(fixed, named), 1).alias("template"))
    # a line with too few constants is its own template
    owned = materialize(
        candidates.select("key", "line_no", "chars", "long", "leaf", "line").join(general, ["leaf", "line"], "left")
        .select("key", "line_no", "chars", "long", F.coalesce("template", F.xxhash64("leaf", "line")).alias("template")), "owned"
    )
    discard(leaves, candidates, distinct, sizes)
    held_by = owned.select("template", "long", "key").distinct().groupBy("template", "long").agg(F.count("*").alias("n"))
    frequent = held_by.filter(enough).select("template")
    # repeated rows give a line several times
    shared = materialize(owned.join(materialize(frequent, "frequent"), "template").dropDuplicates(["key", "line_no"]), "shared")
    discard(owned)
    classes = copy_classes(docs, shared, key)
    groups = shared.select("template", "long", "key").distinct().join(broadcast_if_small(classes), "key", "left")
    recurring = (
        groups.select("template", "long", F.coalesce("class", "key").alias("class")).distinct().groupBy("template", "long").agg(F.count("*").alias("n"))
        .filter(enough).select("template", F.lit(True).alias("recurs"))
    )
    recurring = materialize(recurring, "recurring")
    discard(classes)
    found = shared.select("key", "line_no", "template").join(recurring, "template", "left")
    return found.select("key", "line_no", F.coalesce("recurs", F.lit(False)).alias("recurs"))


def _shingles(text: Column) -> Column:
    """Distinct hashes of a text's runs of SHINGLE_WORDS words; shorter texts are one run."""
    words = F.transform(F.split(F.btrim(text, F.lit(" \t\n\x0b\f\r")), r"\s+"), lambda w: F.xxhash64(w))
    # the one-element array binds the words' hashes once, or they would be worked out again for every run; places beyond the end are null
    return F.element_at(F.transform(F.array(words), lambda w: F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(w) - SHINGLE_WORDS)), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(SHINGLE_WORDS)])))), 1)


def copy_classes(docs: DataFrame, shared: DataFrame, key: Column) -> DataFrame:
    """Groups of copies among the documents with shared lines: (key, class), only for documents that are not alone.

    `shared` has key, template, chars. Only texts that shared lines make up by
    RISK_SHARE or more can be copies of several others. Equal texts are one.
    Every text is compared, on its word shingles, with the least holder of each
    template that makes up LED_SHARE of it; texts alike by COPY_SHARE or more
    share a class. All steps are aggregates and equi-joins, linear in the lines.
    """
    held = materialize(shared.groupBy("key", "template").agg(F.sum("chars").alias("chars")), "held")
    lost = held.groupBy("key").agg(F.sum("chars").alias("lost"))
    texts = docs.select(key.alias("key"), "text").join(lost, "key").filter(F.col("lost") >= RISK_SHARE * F.length("text"))
    texts = materialize(texts.select("key", "text", F.length("text").alias("size")).dropDuplicates(["key"]), "at_risk", compression="zstd")
    first = materialize(
        texts.select("key", "size", F.xxhash64("text").alias("h"), F.xxhash64("text", F.lit(1)).alias("g")).withColumn("equal", F.struct("h", "g")), "equal"
    )
    least = first.groupBy("equal").agg(F.min("key").alias("first"))
    own = materialize(first.join(least, "equal").select("key", "first", "size"), "firsts")
    mine = materialize(held.join(own.filter("key = first").select("key", "size"), "key"), "templates_at_risk")
    leaders = mine.groupBy("template").agg(F.min("key").alias("leader"))
    pairs = (
        mine.join(leaders, "template").filter("leader < key").groupBy("key", "leader")
        .agg(F.sum("chars").alias("led"), F.max("size").alias("size")).filter(F.col("led") >= LED_SHARE * F.col("size")).select("key", "leader")
    )
    sets = materialize(texts.join(own.filter("key = first").select("key"), "key", "left_semi").select("key", _shingles(F.col("text")).alias("s")).withColumns(
        {"n": F.size("s"), "part": F.filter("s", lambda x: x.bitwiseAND(PART - 1) == 0)}), "shingles")
    # alike sets differ in at most this share of both sizes, and so do any parts of them: sizes and a part of
    # the hashes, the same for all, leave few pairs to which whole sets are sent, and lose none
    most = (1 - COPY_SHARE) / (1 + COPY_SHARE) + 1e-9

    def with_columns(*columns: str) -> DataFrame:
        """The pairs with columns of both sides; those of the leader end in 2."""
        other = sets.select(F.col("key").alias("leader"), *[F.col(c).alias(f"{c}2") for c in columns])
        return pairs.join(sets.select("key", *columns), "key").join(other, "leader")

    pairs = materialize(with_columns("n").filter(F.abs(F.col("n") - F.col("n2")) <= most * (F.col("n") + F.col("n2"))).select("key", "leader"), "pairs")
    differ = F.size("part") + F.size("part2") - 2 * F.size(F.array_intersect("part", "part2"))
    pairs = materialize(with_columns("n", "part").filter(differ <= most * (F.col("n") + F.col("n2"))).select("key", "leader"), "pairs")
    both = with_columns("s").withColumnRenamed("s2", "t")
    common = F.size(F.array_intersect("s", "t"))
    alike = common >= COPY_SHARE * (F.size("s") + F.size("t") - common)
    links = materialize(both.filter(alike).groupBy("key").agg(F.min("leader").alias("up")), "links")
    for _ in range(MOST_JUMPS):  # every link leads to a lesser key; the depth halves
        above = links.select(F.col("key").alias("up"), F.col("up").alias("top"))
        further = links.join(above, "up", "left")
        if further.filter("top is not null").isEmpty():
            break
        links = materialize(further.select("key", F.coalesce("top", "up").alias("up")), "links")
    else:
        raise RuntimeError("copies did not settle")
    roots = own.join(links.select(F.col("key").alias("first"), "up"), "first", "left").select("key", F.coalesce("up", "first").alias("class"))
    classes = materialize(roots.filter("key <> class"), "classes")
    discard(held, texts, first, own, mine, sets)
    return classes


def _marked(docs: DataFrame, found: DataFrame, key: Column) -> DataFrame:
    """The documents as `doc`, the text without its recurring lines, and the counts."""
    marks = found.groupBy("key").agg(  # a document's lines at most
        F.collect_set(F.when(F.col("recurs"), F.col("line_no"))).alias("drop"),
        F.collect_set(F.when(~F.col("recurs"), F.col("line_no"))).alias("copied"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("text").alias("text"), key.alias("key"))
    lines = F.split("text", "\n")
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    none = F.array().cast("array<int>")
    joined = rows.join(marks, "key", "left").withColumns({"drop": F.coalesce("drop", none), "copied": F.coalesce("copied", none)})
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("drop", i)), "\n")
    return joined.select(
        "doc", F.when(F.size("drop") > 0, kept).otherwise(F.col("text")).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(breaks + 1).alias("n_lines"), F.size("drop").alias("n_recurring"),
        ((F.size("copied") > 0) & (F.size("drop") == 0)).alias("whole"),
    )


def drop_recurring_lines(docs: DataFrame, key: Column, **options) -> DataFrame:
    """`docs` without recurring lines, and what was found: adds n_lines, n_recurring and whole.

    A line recurs when enough groups of copies hold its template: `min_documents`
    of them, or LONG_DOCUMENTS for lines of more than LONG_WORDS words. A group of
    copies (see `copy_classes`) counts once, so that it never loses all its members;
    a document without copies is a group of its own. Recurring lines go from every
    text, however much of it they are, with their line breaks; what remains keeps
    its order. `whole` tells texts that keep all lines although enough documents,
    all of one group, hold some of them. n_lines counts all lines, blank ones
    included, n_recurring those dropped.

    Blank lines are never dropped. Null and empty texts stay as they are with 0
    recurring lines (null texts: 0 lines). Repeated rows count as one document
    and get equal results. Other columns pass through, except that the added ones
    replace those of the same name. No rows give none.
    """
    marked = _marked(docs, recurring_lines(docs, key, **options), key)
    added = ["n_lines", "n_recurring", "whole"]
    others = [F.col("text") if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns if c not in added]
    return marked.select(*others, *added)


def without_recurring_lines(docs: DataFrame, key: Column, **options) -> DataFrame:
    """As `drop_recurring_lines`, with exactly the columns of `docs`, whatever their names."""
    marked = _marked(docs, recurring_lines(docs, key, **options), key)
    return marked.select(*[F.col("text") if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns])
