"""The corpus operators as queries on the shared tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acequia.llm.common import broadcast_if_small, content_key, table
from acequia.llm.cover_tree import vector_components
from acequia.llm.curve_packing import pack_along_curve
from acequia.llm.filter_audit import audit_filters
from acequia.llm.imatch import fingerprint_documents
from acequia.llm.kneser_ney import classify
from acequia.llm.line_templates import drop_recurring_lines
from acequia.llm.merkle import document_leaves, manifest
from acequia.llm.minhash import minhash_components
from acequia.llm.mixing import copies, mix
from acequia.llm.mixing import tokens_of as words_of
from acequia.llm.packing import CAPACITY, pack
from acequia.llm.sharding import shard_by_bytes
from acequia.llm.token_counts import count_tokens, public_file
from acequia.llm.url_filter import host_of, judge, path_of

TOKENIZER = "byte_bpe_50k.json"
PACKING_TOKENIZER = "word_bpe_49k.json"
TOKEN_LIMIT = 512
SHARDS = 24


def trusted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that `labels` calls good and not toxic."""
    return table(spark, sf_dir, "labels").filter("quality = 1 and toxic = 0").select("doc_id")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), trusted_documents(spark, sf_dir), content_key()).drop("key")


DAY = 86_400
EPOCH = 1_704_067_200  # 2024-01-01, when the lists begin


def _number(text, start: int):
    """A number from a text's md5, the same in Spark and SQL."""
    return F.conv(F.substring(F.md5(text), start, 6), 16, 10).cast("long")


def dated_lists(pages: DataFrame) -> DataFrame:
    """List entries on the sites and site sections of the pages: (pattern, allow, action, at).

    Each site (three last labels of a host) is blocked for a time and again later,
    each section (host and first path segment) is allowed for a time; the dates
    come from the names.
    """
    named = pages.select(host_of(F.col("url")).alias("host"), F.split(path_of(F.col("url")), "/")[1].alias("section"))
    sites = named.select(F.substring_index("host", ".", -3).alias("pattern")).filter("pattern <> ''").distinct()
    sections = named.filter("host <> '' and section <> ''").select(F.concat_ws("/", "host", "section").alias("pattern")).distinct()
    day = _number(F.col("pattern"), 1) % 200
    length = _number(F.col("pattern"), 7) % 120 + 10
    gap = _number(F.col("pattern"), 13) % 60 + 1

    def entry(action: str, at) :
        return F.struct(F.lit(action).alias("action"), (F.lit(EPOCH) + at * DAY).alias("at"))

    blocks = sites.select("pattern", F.lit(False).alias("allow"), F.explode(F.array(
        entry("add", day), entry("remove", day + length), entry("add", day + length + gap))).alias("e"))
    allows = sections.select("pattern", F.lit(True).alias("allow"), F.explode(F.array(
        entry("add", day), entry("remove", day + length))).alias("e"))
    return blocks.union(allows).select("pattern", "allow", "e.action", "e.at")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    # the table has no fetch times: they are spread over a year by id
    at = F.lit(EPOCH) + F.col("page_id") * 7919 % 366 * DAY
    captures = pages.select(F.col("page_id").alias("capture_id"), "url", at.alias("fetched_at"))
    return judge(captures, dated_lists(pages)).withColumnRenamed("capture_id", "page_id")


OP2_SQL = """
WITH named AS (
  SELECT page_id, url, 1704067200 + page_id * 7919 % 366 * 86400 AS fetched_at,
         rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '.') AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
patterns AS (
  SELECT DISTINCT array_to_string(string_split(host, '.')[-3:], '.') AS pattern, false AS allow FROM named WHERE host <> ''
  UNION ALL
  SELECT DISTINCT host || '/' || string_split(path, '/')[2], true FROM named WHERE host <> '' AND string_split(path, '/')[2] <> ''),
dates AS (
  SELECT pattern, allow,
         ('0x' || substr(md5(pattern), 1, 6))::BIGINT % 200 AS d,
         ('0x' || substr(md5(pattern), 7, 6))::BIGINT % 120 + 10 AS n,
         ('0x' || substr(md5(pattern), 13, 6))::BIGINT % 60 + 1 AS gap
  FROM patterns),
valid AS (
  SELECT pattern, allow, 1704067200 + d * 86400 AS since, 1704067200 + (d + n) * 86400 AS until FROM dates
  UNION ALL
  SELECT pattern, allow, 1704067200 + (d + n + gap) * 86400, 9223372036854775807 FROM dates WHERE NOT allow),
active AS (
  SELECT page_id, v.pattern, v.allow,
         row_number() OVER (PARTITION BY page_id ORDER BY length(v.pattern) DESC, v.allow, v.pattern DESC) AS r,
         count(*) OVER (PARTITION BY page_id) AS n_active
  FROM named JOIN valid v ON since <= fetched_at AND fetched_at < until AND (
       host = v.pattern OR ends_with(host, '.' || v.pattern) OR host || path = v.pattern OR starts_with(host || path, v.pattern || '/')))
SELECT n.page_id, n.url, n.fetched_at, coalesce(a.n_active, 0) AS n_active, a.pattern, coalesce(NOT a.allow, false) AS blocked
FROM named n LEFT JOIN active a ON a.page_id = n.page_id AND a.r = 1
"""


def op3_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), partial(public_file, TOKENIZER), TOKEN_LIMIT)


def packable(docs: DataFrame) -> DataFrame:
    """Documents as sequences to pack: words as tokens, equal texts (but for case and white space) as clusters."""
    text = F.coalesce("text", F.lit(""))
    folded = F.lower(F.btrim(F.regexp_replace(text, r"\s+", " ")))
    return docs.select(
        "doc_id", content_key().alias("key"), words_of(F.col("text")).alias("n_tokens"), "source", F.xxhash64(folded).alias("cluster")
    )


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(packable(table(spark, sf_dir, "documents")), CAPACITY).drop("key")


def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_components(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_components(table(spark, sf_dir, "documents"), shingle_words=4).drop("key")


def labelled_domains(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """Text and domain of the documents in `labels`; a document's domain is its language."""
    labels = broadcast_if_small(table(spark, sf_dir, "labels").select("doc_id").dropna().distinct())
    return docs.join(labels, "doc_id", "left_semi").select("text", F.col("lang").alias("domain"))


# Shares of the domains are those found, raised to this: small languages gain.
MIX_EXPONENT = 0.7


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixture = mix(docs, labelled_domains(spark, sf_dir, docs), MIX_EXPONENT, content_key())
    return mixture.rated().select("doc_id", "n_tokens", "posterior", "rate", copies(F.col("rate"), F.col("key")).alias("copies"))


def op9_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_recurring_lines(table(spark, sf_dir, "documents"), content_key())
    return found.select("doc_id", "n_lines", "n_recurring", "whole", F.md5("text").alias("text_md5"))


def op10_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = manifest(document_leaves(table(spark, sf_dir, "documents"))).fold()
    return folded.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


OP11_SQL = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, text,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
         list_reduce(
           list_prepend(4294967295, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
           lambda s, e: xor(xor(s, e) >> 1, CASE WHEN xor(s, e) & 1 = 1 THEN 3988292384 ELSE 0 END)) AS state
  FROM documents),
leaves AS (
  SELECT rid, doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN xor(state, 4294967295) % 3 = 0
              THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS other
  FROM d),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY lang) AS n
  FROM leaves),
tree(lang, lvl, idx, n, h) AS (
  SELECT lang, 0, rank, n, leaf FROM ranked
  UNION ALL
  SELECT lang, lvl + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM tree WHERE n > 1 GROUP BY lang, lvl, idx // 8, n),
subroots AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank, count(*) OVER () AS n FROM tree WHERE n = 1),
top(lvl, idx, n, h) AS (
  SELECT 0, rank, n, subroot FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY lvl, idx // 8, n),
walk(rid, lang, lvl, idx, n, h, proof) AS (
  SELECT rid, lang, 0, rank, n, coalesce(other, leaf), '' FROM ranked
  UNION ALL
  SELECT w.rid, w.lang, w.lvl + 1, w.idx // 8, (w.n + 7) // 8,
         sha256(string_agg(CASE WHEN t.idx = w.idx THEN w.h ELSE t.h END, '' ORDER BY t.idx)),
         w.proof || coalesce(string_agg(t.h, '' ORDER BY t.idx) FILTER (t.idx <> w.idx), '')
  FROM walk w JOIN tree t ON t.lang IS NOT DISTINCT FROM w.lang AND t.lvl = w.lvl AND t.idx // 8 = w.idx // 8
  WHERE w.n > 1 GROUP BY w.rid, w.lang, w.lvl, w.idx, w.n, w.proof),
upper(rid, subroot, lvl, idx, n, h, proof) AS (
  SELECT w.rid, s.subroot, 0, s.rank, s.n, w.h, w.proof FROM walk w JOIN subroots s ON s.lang IS NOT DISTINCT FROM w.lang WHERE w.n = 1
  UNION ALL
  SELECT w.rid, w.subroot, w.lvl + 1, w.idx // 8, (w.n + 7) // 8,
         sha256(string_agg(CASE WHEN t.idx = w.idx THEN w.h ELSE t.h END, '' ORDER BY t.idx)),
         w.proof || coalesce(string_agg(t.h, '' ORDER BY t.idx) FILTER (t.idx <> w.idx), '')
  FROM upper w JOIN top t ON t.lvl = w.lvl AND t.idx // 8 = w.idx // 8
  WHERE w.n > 1 GROUP BY w.rid, w.subroot, w.lvl, w.idx, w.n, w.proof)
SELECT l.doc_id, l.leaf, u.subroot, r.h AS root, sha256(u.proof) AS proof_sha256, u.h AS folded_root, u.h = r.h AS verified
FROM leaves l JOIN upper u ON u.rid = l.rid AND u.n = 1 JOIN top r ON r.n = 1
"""


def op12_curve_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_along_curve(table(spark, sf_dir, "documents"), partial(public_file, PACKING_TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = """
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
f AS (
  SELECT doc_id, part,
         CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END
         || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS failed
  FROM w),
known AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
counts AS (
  SELECT part, failed, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM f LEFT JOIN known USING (doc_id) GROUP BY part, failed),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
cells AS (SELECT filter_order, s.step, filter_order[s.step] AS letter, filter_order[1:s.step - 1] AS earlier
          FROM orders, (SELECT unnest(range(1, 6)) AS step) s),
raw AS (
  SELECT part, filter_order, step, letter, contains(failed, letter) AS fails, failed = letter AS alone,
         length(translate(failed, earlier, '')) < length(failed) AS before, n, good, toxic
  FROM cells, counts),
summed AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN NOT before AND NOT fails THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN NOT before AND fails THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN before AND fails THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN alone THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN NOT before AND fails THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN NOT before AND fails THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM raw GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM summed
"""


QUERIES = {
    f.__name__: f
    for f in (op1_quality, op2_url_filter, op3_shard, op4_token_counts, op5_pack, op6_vectors, op7_minhash, op8_mixing,
              op9_line_templates, op10_imatch, op11_merkle, op12_curve_pack, op13_filter_audit)
}
SQL = {"op2_url_filter": OP2_SQL, "op11_merkle": OP11_SQL, "op13_filter_audit": OP13_SQL}
