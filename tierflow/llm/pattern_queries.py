"""Queries ``opN_<name>`` of the operators that look for patterns: periodic runs, secrets, spelling variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.common import pinned, table
from tierflow.llm.credentials import BASE, KINDS, PLACEHOLDERS, WIDER, scan_secrets
from tierflow.llm.periodic import collapse_runs
from tierflow.llm.registry import query
from tierflow.llm.spelling import spelling_variants

# CRC-32 of a list of byte values ``bytes``, as a DuckDB macro needs no session: the table comes from ``crc_table``.
CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda x: list_reduce(range(8), lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, x)) AS t
)"""


def crc_sql(text: str) -> str:
    """SQL for the unsigned CRC-32 of the UTF-8 bytes of an expression; needs ``crc_table`` in the FROM clause."""
    values = f"list_transform(range(strlen({text})), lambda i: ('0x' || substr(hex(encode({text})), 2 * i::INT + 1, 2))::BIGINT)"
    return f"xor(list_reduce({values}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


OP11_SQL = rf"""
WITH {CRC_TABLE},
base AS (
  SELECT row_number() OVER () AS r, doc_id, {crc_sql("doc_id::VARCHAR")} AS h,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w0 FROM documents, crc_table
),
sized AS (SELECT *, len(w0) AS n, h // 10 AS g FROM base),
d AS (
  SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: w0[1 + CASE WHEN i < g % n THEN i ELSE g % n + (i - g % n) % (1 + (n - g % n) // (3 + g % 8)) END])
    ELSE w0 END AS w FROM sized
),
grams AS (
  SELECT r, n, i, array_to_string(w[i + 1:i + 6], ' ') AS x FROM (SELECT r, n, w, unnest(range(n - 5)) AS i FROM d WHERE n >= 12)
),
pairs AS (SELECT a.r, b.i - a.i AS p, a.i FROM grams a JOIN grams b ON a.r = b.r AND a.x = b.x AND b.i > a.i AND 2 * (b.i - a.i) <= a.n),
regions AS (
  SELECT r, p, min(i) AS start, count(*) + 5 AS m
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, p ORDER BY i) AS island FROM pairs) GROUP BY r, p, island
),
runs AS (SELECT r, start, m + p AS length, min(p) AS period FROM regions WHERE m >= p AND m + p >= 12 GROUP BY ALL),
told AS (
  SELECT r, count(*) AS n_runs, arg_min({{'s': start, 'l': length, 'p': period}}, {{'l': -length, 's': start, 'p': period}}) AS best,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed
  FROM runs GROUP BY r
),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT r, string_agg(x, ' ' ORDER BY i) AS words
  FROM (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM d) ANTI JOIN gone USING (r, i) GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.l::BIGINT AS length, best.p::BIGINT AS period,
  (1000 * best.l // best.p)::BIGINT AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
FROM d LEFT JOIN told USING (r) LEFT JOIN kept USING (r)
"""


def repeat_endings(docs: DataFrame) -> DataFrame:
    """(doc_id, text): where the CRC of the id ends in 0, the words from some place on repeat the first few of them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = pinned(docs.select("doc_id", "text"), w=F.when(h % 10 == 0, split), g=F.expr("crc32(cast(cast(doc_id as string) as binary)) div 10"))
    with_cut = chosen.withColumn("n", F.size("w")).withColumn("a", F.expr("cast(if(n > 0, g % n, 0) as int)"))
    with_period = with_cut.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    # The same words in longer blocks: before the cut, then the first p after it as often as there is room for.
    longer = F.expr("slice(concat(slice(w, 1, a), flatten(array_repeat(slice(w, a + 1, p), cast((n - a) div p + 1 as int)))), 1, n)")
    return with_period.select("doc_id", F.when(F.col("n") > 0, F.array_join(longer, " ")).otherwise(F.col("text")).alias("text"))


@query("op11_block_convolution", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse_runs(repeat_endings(table(spark, sf_dir, "documents")))
    order = F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    best = found.withColumn("best", F.array_min(order))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.s").alias("start"), (-F.col("best.l")).alias("length"),
        F.col("best.p").alias("period"), F.expr("-1000 * best.l div best.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.encode("kept_words", "UTF-8"), 256).alias("collapsed_sha256"),
    )


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _op12_sql() -> str:
    # Characters of a match behind its value.
    tails = {"login": 1, "quoted": 1}
    keyword = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
    steps = []

    def matches(name: str, number: int, pattern: str, least: int, tail: int) -> str:
        pattern = pattern.replace("'", "''")
        return f"""{name}_m AS (
  SELECT r, regexp_extract_all(text, '{pattern}', 0) AS m, regexp_extract_all(text, '{pattern}', 1) AS v, string_split_regex(text, '{pattern}') AS gaps
  FROM d WHERE regexp_matches(text, '{pattern}')
),
{name}_s AS (
  SELECT r, {number} AS kind, v[k] AS value, list_sum([length(x) FOR x IN gaps[1:k]])::BIGINT + coalesce(list_sum([length(x) FOR x IN m[1:k - 1]]), 0)::BIGINT AS begins, length(m[k]) AS n
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS k FROM {name}_m)
),
{name} AS (
  SELECT r, kind, value, {"begins" if number < len(BASE) else f"begins + n - {tail} - length(value)"} AS s, begins + n - {tail} AS e FROM {name}_s WHERE length(value) >= {least}
)"""

    taken = []
    for number, (kind, pattern, least) in enumerate(BASE):
        pattern = pattern.replace("(?i:password|passwd|secret|token|api_?key)", f"(?:{keyword})")
        steps.append(matches(kind, number, pattern, least, 0))
        taken.append(f"SELECT * FROM {kind}")
    for number, (kind, pattern) in enumerate(WIDER, len(BASE)):
        steps.append(matches(f"{kind}_all", number, pattern, 1, tails.get(kind, 0)))
        steps.append(f"""{kind} AS (
  SELECT * FROM {kind}_all a WHERE NOT EXISTS (SELECT 1 FROM ({" UNION ALL ".join(taken)}) t WHERE t.r = a.r AND t.s < a.e AND a.s < t.e)
)""")
        taken.append(f"SELECT * FROM {kind}")
    placeholder = " OR ".join(f"contains(lower(value), '{w}')" for w in PLACEHOLDERS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
{", ".join(steps)},
spans AS ({" UNION ALL ".join(taken)}),
held AS (
  SELECT value, count(DISTINCT coalesce(source, chr(0))) AS owners, count(DISTINCT {{'o': coalesce(source, chr(0)), 'd': coalesce(doc_id, -1)}}) AS repositories
  FROM spans JOIN d USING (r) GROUP BY value
),
judged AS (
  SELECT s.*, owners <= 2 AND repositories <= 20 AND len(list_distinct(string_split(value, ''))) >= 10 AND regexp_matches(value, '[A-Za-z]')
    AND regexp_matches(value, '[0-9].*[0-9]') AND NOT ({placeholder}) AS live FROM spans s JOIN held USING (value)
),
told AS (
  SELECT r, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS k, count(*) FILTER (kind = 2) AS h,
    string_agg(x, ',' ORDER BY s, kind) FILTER (kind < {len(BASE)}) AS base, string_agg(x, ',' ORDER BY s, kind) AS spans
  FROM (SELECT *, ({KINDS!r})[kind + 1] || ':' || s || ':' || e AS x FROM judged WHERE live OR kind < {len(BASE)}) GROUP BY r
)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(k, 0)::BIGINT AS n_access, coalesce(h, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN told USING (r)
"""


OP12_SQL = _op12_sql()


@query("op12_ownership_frequency", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[number(kind) for kind, *_ in BASE],
        F.sha2(listed(F.filter("spans", lambda s: s["base"])).cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans"),
    )


OP13_SQL = rf"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, x, count(*) AS c FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS x
    FROM documents) GROUP BY ALL
),
hashed AS (SELECT x, c, {crc_sql("(doc_id::VARCHAR || ':' || x)")} AS h FROM runs, crc_table),
edited AS (SELECT CASE WHEN h % 97 = 0 THEN substr(x, 1, h % length(x)) || substr(x, h % length(x) + 2) ELSE x END AS word, c FROM hashed),
words AS (SELECT word, sum(c)::BIGINT AS n FROM edited GROUP BY word HAVING sum(c) >= 3 AND length(word) >= 5),
cut AS (SELECT word, n, i, substr(word, 1, i) AS a, substr(word, i + 2) AS b FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
longer AS (SELECT DISTINCT c.word AS l, c.n AS ln, w.word AS s, w.n AS sn FROM cut c JOIN words w ON w.word = c.a || c.b),
near AS (
  SELECT x.word, y.word AS near, y.n AS near_n FROM cut x JOIN cut y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION ALL SELECT l, s, sn FROM longer UNION ALL SELECT s, l, ln FROM longer
),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS m, arg_min(near, {{'l': -near_n, 'w': near}}) AS near FROM near GROUP BY word),
told AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN m >= 2 * n THEN near END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n
  FROM words LEFT JOIN best USING (word)
),
walk(word, place) AS (SELECT word, word FROM told UNION ALL SELECT walk.word, told.form FROM walk JOIN told ON walk.place = told.word WHERE told.form IS NOT NULL)
SELECT told.word, form, place AS root, n, n_near, form_n FROM told JOIN walk USING (word) WHERE place IN (SELECT word FROM told WHERE form IS NULL)
"""


@query("op13_prefix_suffix_tiles", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), edit_every=97)
