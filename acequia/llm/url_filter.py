"""URL filters by temporal lists.

Dated list entries (a pattern is added or removed) become validity intervals. Every
capture is looked up by all the patterns that could match its URL, and an as-of join
keeps the entries that were active when it was fetched; the most specific one decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acequia.llm.common import broadcast_if_small
from acequia.session import materialize

FOREVER = (1 << 63) - 1
# Intervals are filed under periods of this length, so that a pattern with a long history is no hot join key.
PERIOD_SECONDS = 90 * 86_400
# Intervals sent whole to every executor; more are joined by a shuffle.
BROADCAST_INTERVALS = 100_000


def host_of(url: Column) -> Column:
    """Lower-case host without user, port or final dot; empty if there is none."""
    return F.rtrim(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit("."))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def patterns_of(url: Column) -> Column:
    """Patterns that match a URL: its host and the parent domains, and the host with every leading run of path segments."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    steps = F.filter(F.split(path_of(url), "/"), lambda s: s != "")
    below = F.transform(
        F.filter(F.sequence(F.lit(0), F.size(steps)), lambda i: i > 0), lambda i: F.concat_ws("/", host, F.slice(steps, 1, i))
    )
    return F.when(host != "", F.array_distinct(F.concat(parents, below))).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """Validity intervals of list entries: (pattern, allow, since, until), until excluded.

    `entries` has pattern, allow (boolean), action (`add` or `remove`) and at
    (seconds). A pattern is valid from an add to the next remove; repeated adds
    change nothing, of several actions at one moment a removal wins. Entries with
    a null, an empty pattern or another action are ignored. Of a pattern the host
    is taken without regard to case, the path (from the first slash) as it stands.
    """
    host = F.substring_index("pattern", "/", 1)
    pattern = F.concat(F.lower(host), F.substring(F.col("pattern"), F.length(host) + 1, F.length("pattern")))
    clean = entries.filter("pattern <> '' and allow is not null and at is not null and action in ('add', 'remove')")
    moments = clean.groupBy(pattern.alias("pattern"), "allow", "at").agg(F.min(F.col("action") == "add").alias("on"))
    history = Window.partitionBy("pattern", "allow").orderBy("at")
    changes = moments.withColumn("was", F.coalesce(F.lag("on").over(history), F.lit(False))).filter("on <> was")
    ends = changes.withColumn("until", F.coalesce(F.lead("at").over(history), F.lit(FOREVER)))
    return ends.filter("on").select("pattern", "allow", F.col("at").alias("since"), "until")


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Adds to every capture n_active, pattern (the deciding one) and blocked.

    `captures` has capture_id, url and fetched_at (seconds). n_active counts the
    list entries that match the URL and were valid at fetch time. The longest
    matching pattern decides, of a block and an allowance with one pattern the
    block. Captures without an active entry, without a host, or with a null URL
    or time are not blocked (pattern null). Repeated captures are judged each;
    ids may be null. No captures give none.
    """
    valid = materialize(intervals(entries), "intervals")
    horizon = captures.agg(F.max("fetched_at")).first()[0] or 0
    first, last = F.floor(F.col("since") / PERIOD_SECONDS), F.floor(F.least(F.col("until") - 1, F.lit(horizon)) / PERIOD_SECONDS)
    filed = valid.filter(F.col("since") <= horizon).withColumn("period", F.explode(F.sequence(first, F.greatest(first, last))))
    filed = broadcast_if_small(materialize(filed, "filed"), BROADCAST_INTERVALS)
    rows = materialize(
        captures.select("capture_id", "url", "fetched_at", F.monotonically_increasing_id().alias("row")), "captures"
    )
    asked = rows.select(
        "row", "fetched_at", F.floor(F.col("fetched_at") / PERIOD_SECONDS).alias("period"), F.explode(patterns_of(F.col("url"))).alias("pattern")
    )
    active = asked.join(filed, ["pattern", "period"]).filter("since <= fetched_at and fetched_at < until")
    rank = F.struct(F.length("pattern").alias("n"), (~F.col("allow")).alias("block"), F.col("pattern").alias("pattern"))
    verdicts = active.groupBy("row").agg(F.count("*").alias("n_active"), F.max(rank).alias("best"))
    return rows.join(verdicts, "row", "left").select(
        "capture_id", "url", "fetched_at", F.coalesce("n_active", F.lit(0)).alias("n_active"),
        F.col("best.pattern").alias("pattern"), F.coalesce("best.block", F.lit(False)).alias("blocked"),
    )
