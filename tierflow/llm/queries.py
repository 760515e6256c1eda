"""Queries ``opN_<name>``: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.common import learned_from, table
from tierflow.llm.decontaminate import find_items
from tierflow.llm.languages import identify_languages
from tierflow.llm.mixing import mix
from tierflow.llm.neardup import near_duplicates
from tierflow.llm.quality import quality_rules
from tierflow.llm.registry import query
from tierflow.llm.sharding import shard_documents
from tierflow.llm.substrings import remove_repeats
from tierflow.llm.surrogates import replace_personal_data
from tierflow.llm.toxicity import score_toxicity
from tierflow.llm.urls import PATTERN_RULES, filter_urls

OP1_SQL = r"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda x: list_reduce(range(8), lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, x)) AS t
),
keyed AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT + 1 AS size, coalesce(text, '') AS text,
    CASE WHEN text IS NULL THEN 0 ELSE ('0x' || substr(md5(text), 1, 15))::BIGINT END AS h,
    CASE WHEN doc_id IS NULL THEN 0 ELSE ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT END AS d
  FROM documents
),
placed AS (
  SELECT *, coalesce(sum(size) OVER (ORDER BY h, d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(size) OVER () AS total FROM keyed
),
sharded AS (SELECT *, (before * 16 // total)::INT AS shard FROM placed)
SELECT doc_id, size,
  xor(list_reduce(list_transform(range(size - 1), lambda i: ('0x' || substr(hex(encode(text)), 2 * i::INT + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS text_crc32,
  'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY h, d, doc_id) - 1 AS slot, NULL::INT AS grown_shard
FROM sharded, crc_table
"""


@query("op1_histogram_sort", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


OP7_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    CASE WHEN coalesce(length(text), 0) = 0 THEN 1.0::DOUBLE
      ELSE greatest(1 - (length(text) - length(translate(text, '#*$%&|<>', '')))::DOUBLE / length(text), 0.05::DOUBLE) END AS quality,
    CASE WHEN doc_id IS NULL THEN -1 ELSE ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT END AS d
  FROM documents
),
keyed AS (SELECT *, -ln((greatest(d, 0) + 0.5::DOUBLE) / 1152921504606846976::DOUBLE) / quality AS k FROM sized),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rank, 3 * source_size AS cap FROM sources),
weighed AS (SELECT *, rank % 3 + 1 AS weight FROM ranked),
room AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, rank) AS place,
    sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
    sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM weighed
),
free AS (SELECT place AS first, remaining AS r, weights AS w FROM room WHERE remaining * weight <= cap * weights ORDER BY place LIMIT 1),
targets AS (
  SELECT source, source_size, CASE WHEN place < coalesce(first, 2147483647) THEN cap::DOUBLE ELSE (weight * r)::DOUBLE / w::DOUBLE END AS target
  FROM room LEFT JOIN free ON true
),
drawn AS (
  SELECT doc_id, size, source_size, target,
    coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY k, d, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs
  FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (size * (epochs + CASE WHEN epochs < 3 AND 2 * before + size <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM drawn
"""


@query("op7_weighted_mix", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH doc_words AS (
  SELECT rowid AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT row_number() OVER () AS rowid, * FROM documents)
),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
patterns AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS p
  FROM (SELECT *, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item_words WHERE len(w) > 0)
),
lengths AS (SELECT DISTINCT n FROM patterns),
windows AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, lengths WHERE len(w) >= n)
),
hits AS (SELECT r, i, h.n, item_id FROM windows h JOIN patterns q ON h.n = q.n AND h.p = q.p),
covered AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""


@query("op10_wu_manber", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


@query("op4_divergence_rules")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(3, len(w)) - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS i FROM w WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
),
comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN comp USING (doc_id)
"""


@query("op3_odd_sketch_dedup", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


OP6_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
windows AS (
  SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
),
twice AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS k FROM windows SEMI JOIN twice USING (h)),
words AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS k FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY k) AS t FROM words ANTI JOIN gone USING (r, k) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


@query("op6_fm_index_repeats", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_words", "UTF-8"), 256).alias("kept_sha256"))


def _url_pattern_sql() -> str:
    return " OR ".join(f"regexp_matches(lower(url), '{r.pattern}')" for r in PATTERN_RULES)


OP5_SQL = rf"""
WITH p AS (
  SELECT page_id, url, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
),
r(rule, h, p, v) AS (VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
best AS (
  SELECT p.*, (SELECT arg_max({{'rule': rule, 'v': v}}, length(rule)) FROM r
    WHERE (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.p)) AS b FROM p
)
SELECT page_id, host, path, b.rule AS rule,
  coalesce(b.v, CASE WHEN coalesce({_url_pattern_sql()}, false) THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce({_url_pattern_sql()}, false) AS matched
FROM best
"""


@query("op5_token_index", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


@query("op9_language_mixture")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"), learned_from("doc_id", 4, 2))


@query("op2_weak_supervision")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learned_from("doc_id", 5, 0))


@query("op8_surrogates")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_personal_data(table(spark, sf_dir, "documents"), F.lit("key of the published sample"))
