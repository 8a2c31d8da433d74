"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import decontamination, deleted_interpolation, jaccard_join, line_dedup, mixing, quality_rules, secrets, suffix_dedup, token_store, warc
from docloom.llm.common import table


#: Words that a term of a benchmark phrase may stand from its place in near matches.
NEAR_SLOP = 2


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact phrases decide; words and items of near matches stand beside them."""
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    rows = decontamination.decontaminate(docs, bench, slop=NEAR_SLOP)
    return rows.selectExpr(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "n_hit > 0 AS contaminated", "n_near", "CAST(size(near_items) AS BIGINT) AS n_near_items"
    )


def near_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As op1_decontamination, with near matches: words covered and items."""
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    rows = decontamination.decontaminate(docs, bench, slop=NEAR_SLOP)
    return rows.select("doc_id", "n_words", "n_hit", "n_near", "n_items", F.array_join("near_items", ",").alias("near_items"))


def op2_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_documents(table(spark, sf_dir, "documents"))


def op3_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deleted_interpolation.score(table(spark, sf_dir, "documents"))


#: Weights (pair, word, uniform) of the query whose model SQL can follow: those that the paper's example would start from.
FIXED_WEIGHTS = (0.5, 0.4, 0.1)


def fixed_weight_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As op3_deleted_interpolation with given weights in place of learned ones, so that SQL can follow every score."""
    weights = np.tile(FIXED_WEIGHTS, (65, 1))
    rows = deleted_interpolation.score(table(spark, sf_dir, "documents"), weights=weights)
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 5).alias("base_score"), F.round("score", 5).alias("score"))


def op4_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.repeated_runs(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_removed", "removed", "n_runs", "longest_run", "runs")


def line_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As op4_line_runs, with short runs of long lines and copies of short documents."""
    rows = line_dedup.repeated_runs(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_repeats", "repeats")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op6_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_secret_ledger,
        op3_deleted_interpolation,
        op4_line_runs,
        op5_quality_rules,
        op6_water_filling,
        op7_token_files,
        op8_warc_zstd,
        op9_suffix_array,
        op10_jaccard_join,
        line_repeats,
        near_decontamination,
        fixed_weight_scores,
    )
}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
BLANK_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# The checksum of doc_id as text: its bytes and, after each, eight steps (-1) of the polynomial.
CRC32 = """xor(4294967295, list_reduce(flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: [CAST(ord(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, 4294967295))"""

ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS w FROM documents),
b AS (SELECT item_id, {WORDS} AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
phrases AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM phrases),
windows AS (
  SELECT rid, size, i, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT rid, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT rid, item_id, i, h.size FROM windows h JOIN phrases p ON h.size = p.size AND h.phrase = p.phrase),
words AS (SELECT rid, count(DISTINCT p) AS n FROM
  (SELECT rid, unnest(generate_series(i, i + size - 1)) AS p FROM hits) GROUP BY rid),
items AS (SELECT rid, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM hits) GROUP BY rid),
texts AS (SELECT phrase, size, string_split(phrase, ' ') AS w FROM (SELECT DISTINCT phrase, size FROM phrases)),
terms AS (SELECT phrase, size, j, w[j + 1] AS term FROM (SELECT phrase, size, w, unnest(generate_series(0, size - 1)) AS j FROM texts)),
tokens AS (SELECT rid, k, w[k + 1] AS term FROM (SELECT rid, w, unnest(generate_series(0, len(w) - 1)) AS k FROM d WHERE len(w) > 0)),
freq AS (SELECT term, count(*) AS n FROM tokens GROUP BY term),
rarest AS (SELECT phrase, size, arg_min(j, struct_pack(n := coalesce(n, 0), j := j)) AS j, min(coalesce(n, 0)) AS n
  FROM terms LEFT JOIN freq USING (term) GROUP BY phrase, size),
start AS (SELECT DISTINCT rid, phrase, size, k - j + delta AS s FROM rarest JOIN terms USING (phrase, size, j) JOIN tokens USING (term),
  (SELECT unnest(generate_series(-2, 2)) AS delta) WHERE n > 0),
near AS (SELECT start.rid, start.phrase, start.size, s FROM start JOIN terms USING (phrase)
  LEFT JOIN tokens ON tokens.rid = start.rid AND tokens.term = terms.term AND k BETWEEN s + j - 2 AND s + j + 2
  GROUP BY ALL HAVING count(DISTINCT j) FILTER (k IS NOT NULL) = start.size),
near_words AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT near.rid, unnest(generate_series(greatest(s, 0), least(s + size, len(w)) - 1)) AS p
  FROM near JOIN d ON d.rid = near.rid) GROUP BY rid),
near_items AS (SELECT rid, count(DISTINCT item_id) AS n FROM near JOIN phrases USING (phrase, size) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(words.n, 0) > 0 AS contaminated, CAST(coalesce(near_words.n, 0) AS BIGINT) AS n_near, CAST(coalesce(near_items.n, 0) AS BIGINT) AS n_near_items
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid) LEFT JOIN near_words USING (rid) LEFT JOIN near_items USING (rid)""",
    "op2_secret_ledger": rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
rules(kind, rank, pattern, grp, least) AS (VALUES
  ('assign', 0, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 12),
  ('access', 1, 'AKIA[A-Z0-9]+', 0, 18), ('hex', 2, '[0-9a-f]{{16,}}', 0, 16),
  ('github', 3, 'gh[opsur]_[A-Za-z0-9]{{36,}}', 0, 1), ('slack', 4, 'xox[abeprs]-[A-Za-z0-9-]{{10,}}', 0, 1),
  ('pem', 5, '-----BEGIN [A-Z ]*PRIVATE KEY-----', 0, 1)),
m AS (SELECT rid, kind, rank, least, regexp_extract_all(text, pattern) AS hits, regexp_split_to_array(text, pattern) AS gaps,
  CASE grp WHEN 2 THEN regexp_extract_all(text, pattern, 2) ELSE regexp_extract_all(text, pattern) END AS tested
  FROM d, rules WHERE regexp_matches(text, pattern)),
e AS (SELECT rid, kind, rank, least, generate_subscripts(hits, 1) AS n, unnest(hits) AS hit,
  unnest(gaps[:len(hits)]) AS gap, unnest(tested) AS t FROM m),
s AS (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY rid, kind ORDER BY n) AS stop FROM e),
f AS (SELECT rid, kind, rank, CAST(stop - length(hit) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop
  FROM s WHERE length(t) >= least),
g AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
  string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, rank) AS spans FROM f GROUP BY rid)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
  CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)""",
    "op5_quality_rules": rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {BLANK_WORDS} AS w FROM documents),
win AS (SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS k FROM
  (SELECT rid, w, unnest(generate_series(1, len(w) - 7)) AS i FROM d WHERE len(w) > 7)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS n FROM win) WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM
  (SELECT rid, unnest(generate_series(i, i + 7)) AS p FROM rep) GROUP BY rid),
l AS (SELECT rid, line, n, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
    length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS symbols,
    len(regexp_extract_all(line, '[|>»›•·]')) AS separators
  FROM (SELECT rid, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM
    (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)) WHERE n > 0),
v AS (SELECT rid, line, chars, 10 * symbols > chars OR (n >= 12 AND NOT regexp_matches(line, '[{quality_rules.SENTENCE_MARKS}]'))
    OR (separators >= 2 AND 3 * separators >= n)
    OR regexp_matches(line, '(?i){"|".join(quality_rules.BOILERPLATE)}') AS bad FROM l),
g AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup, count(*) FILTER (bad) AS removed,
    coalesce(sum(chars) FILTER (NOT bad), 0) AS kept_chars FROM v GROUP BY rid),
f AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(removed, 0) AS BIGINT) AS n_lines_removed,
    CAST(coalesce(kept_chars, 0) AS BIGINT) AS kept_chars
  FROM d LEFT JOIN cov USING (rid) LEFT JOIN g USING (rid))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 2 * kept_chars >= word_chars AS kept FROM f""",
    "op6_water_filling": r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM
  (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source)),
fill AS (
  SELECT 0 AS round, (SELECT sum(source_size) FROM s) AS words, (SELECT sum(weight) FROM s) AS weights
  UNION ALL
  SELECT round + 1,
    (SELECT sum(source_size) - 3 * coalesce(sum(source_size) FILTER (weight * words > 3 * source_size * weights), 0) FROM s),
    (SELECT sum(weight) FILTER (NOT (weight * words > 3 * source_size * weights)) FROM s)
  FROM fill WHERE round < 100),
level AS (SELECT words, weights FROM fill ORDER BY round DESC LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN weight * words > 3 * source_size * weights
    THEN CAST(3 * source_size AS DOUBLE) ELSE CAST(weight * words AS DOUBLE) / CAST(weights AS DOUBLE) END AS target
  FROM s, level),
u AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
r AS (SELECT d.*, source_size, target, whole, target - whole * source_size AS rest,
    coalesce(sum(size) OVER (PARTITION BY d.source
      ORDER BY substr(md5(concat('mix:', coalesce(CAST(doc_id AS VARCHAR), 'null'), ':', size)), 1, 13), doc_id, rid
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source),
m AS (SELECT *, greatest(0, least(size, CAST(floor(rest - before) AS BIGINT))) AS more FROM r)
SELECT doc_id, size, source_size, target,
  CAST(CASE WHEN size > 0 THEN whole + (more >= size)::INT ELSE 1 END AS BIGINT) AS copies,
  CAST(CASE WHEN more >= size THEN 0 ELSE more END AS BIGINT) AS part,
  CAST(size * whole + more AS BIGINT) AS taken FROM m""",
    "op10_jaccard_join": rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS w FROM documents),
sh AS (SELECT DISTINCT rid, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS s FROM
  (SELECT rid, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT rid, count(*) AS n FROM sh GROUP BY rid),
p AS (SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM sh a JOIN sh b USING (s) WHERE a.rid <> b.rid GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.rid = x JOIN n b ON b.rid = y WHERE 5 * c >= 4 * (a.n + b.n - c)),
reach AS (SELECT rid AS x, rid AS y FROM d UNION SELECT reach.x, l.y FROM reach JOIN l ON reach.y = l.x),
c AS (SELECT x, min(doc_id) AS class_id FROM reach JOIN d ON d.rid = y GROUP BY x),
k AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
SELECT doc_id, class_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles
FROM d JOIN c ON c.x = d.rid LEFT JOIN k ON k.x = d.rid LEFT JOIN n ON n.rid = d.rid""",
    "op9_suffix_array": rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS w FROM documents),
win AS (SELECT rid, doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS k FROM
  (SELECT rid, doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d WHERE len(w) >= 50)),
r AS (SELECT rid, i, n, c FROM (SELECT rid, i, count(*) OVER (PARTITION BY k) AS n,
  row_number() OVER (PARTITION BY k ORDER BY doc_id, rid, i) AS c FROM win) WHERE n > 1),
cov AS (SELECT rid, p, bool_or(c > 1) AS later FROM
  (SELECT rid, c, unnest(generate_series(i - 1, i + 48)) AS p FROM r) GROUP BY rid, p),
isl AS (SELECT rid, later, p, p - row_number() OVER (PARTITION BY rid ORDER BY p) AS g,
  p - row_number() OVER (PARTITION BY rid, later ORDER BY p) AS h FROM cov),
s AS (SELECT rid, string_agg(concat(a, ':', b), ',' ORDER BY a) AS spans FROM
  (SELECT rid, g, min(p) AS a, max(p) + 1 AS b FROM isl GROUP BY rid, g) GROUP BY rid),
t AS (SELECT rid, string_agg(concat(a, ':', b), ',' ORDER BY a) AS spans FROM
  (SELECT rid, h, min(p) AS a, max(p) + 1 AS b FROM isl WHERE later GROUP BY rid, h) GROUP BY rid),
n AS (SELECT rid, count(*) AS n, count(*) FILTER (later) AS c FROM cov GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n.n AS BIGINT) AS n_repeated, CAST(n.c AS BIGINT) AS n_copied,
  s.spans AS spans, coalesce(t.spans, '') AS copied_spans
FROM n JOIN d USING (rid) JOIN s USING (rid) LEFT JOIN t USING (rid)""",
    "fixed_weight_scores": rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_concat(regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+'), [chr(10)]) AS w,
  {CRC32} % 10 = 0 AS held_out FROM documents),
t AS (SELECT rid, held_out, i, w[i] AS word, CASE WHEN i > 1 THEN w[i - 1] END AS before FROM
  (SELECT rid, held_out, w, unnest(generate_series(1, len(w))) AS i FROM d)),
c AS (SELECT word, count(*) AS c FROM t WHERE NOT held_out GROUP BY word),
p AS (SELECT before, word, count(*) AS c FROM t WHERE NOT held_out GROUP BY before, word),
n AS (SELECT sum(c) AS n, count(*) AS v FROM c),
s AS (SELECT rid, count(*) AS n_tokens, count(c.c) AS n_known, sum(log10((coalesce(c.c, 0) + 0.1) / (n + 0.1 * (v + 1)))) AS base_score,
  sum(log10({FIXED_WEIGHTS[0]} * coalesce(p.c, 0) / greatest(1, coalesce(h.c, 0)) + {FIXED_WEIGHTS[1]} * coalesce(c.c, 0) / n + {FIXED_WEIGHTS[2]} / (v + 1))) AS score
  FROM t LEFT JOIN c USING (word) LEFT JOIN c h ON h.word = coalesce(t.before, chr(10))
  LEFT JOIN p ON p.word = t.word AND p.before IS NOT DISTINCT FROM t.before, n GROUP BY rid)
SELECT doc_id, held_out, n_tokens, n_known, CAST((SELECT n FROM n) AS BIGINT) AS train_tokens, round(base_score, 5) AS base_score, round(score, 5) AS score
FROM d JOIN s USING (rid)""",
    "op4_line_runs": r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT rid, doc_id, i, line, row_number() OVER (PARTITION BY rid ORDER BY i) AS p FROM
  (SELECT rid, doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
w AS (SELECT a.rid, a.doc_id, a.p, concat_ws(chr(10), a.line, b.line, c.line) AS k FROM l a
  JOIN l b ON b.rid = a.rid AND b.p = a.p + 1 JOIN l c ON c.rid = a.rid AND c.p = a.p + 2),
later AS (SELECT rid, p FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, rid, p) AS c FROM w) WHERE c > 1),
gone AS (SELECT DISTINCT l.rid, l.i FROM later JOIN l ON l.rid = later.rid AND l.p BETWEEN later.p AND later.p + 2),
s AS (SELECT rid, sum(n) AS n, string_agg(concat(a, ':', b), ',' ORDER BY a) AS removed FROM
  (SELECT rid, count(*) AS n, min(i) AS a, max(i) + 1 AS b FROM
    (SELECT rid, i, i - row_number() OVER (PARTITION BY rid ORDER BY i) AS g FROM gone) GROUP BY rid, g) GROUP BY rid),
n AS (SELECT rid, count(*) AS n FROM l GROUP BY rid),
grow AS (
  SELECT rid, p, k, 1 AS size, copies FROM (SELECT rid, p, md5(line) AS k, count(*) OVER (PARTITION BY line) AS copies FROM l) WHERE copies > 1
  UNION ALL
  SELECT rid, p, k, size, copies FROM (SELECT g.rid, g.p, md5(g.k || l.line) AS k, g.size + 1 AS size,
      count(*) OVER (PARTITION BY md5(g.k || l.line)) AS copies
    FROM grow g JOIN l ON l.rid = g.rid AND l.p = g.p + g.size) WHERE copies > 1),
best AS (SELECT rid, p, max(size) AS size, arg_max(copies, size) AS copies FROM grow GROUP BY rid, p),
maximal AS (SELECT b.rid, b.p, b.size, b.copies, x.i AS a, y.i + 1 AS b FROM best b
  LEFT JOIN best o ON o.rid = b.rid AND o.p = b.p - 1 AND o.size = b.size + 1
  JOIN l x ON x.rid = b.rid AND x.p = b.p JOIN l y ON y.rid = b.rid AND y.p = b.p + b.size - 1
  WHERE b.size >= 3 AND o.rid IS NULL),
m AS (SELECT rid, count(*) AS n, max(size) AS longest, string_agg(concat(a, ':', b, ':', copies), ',' ORDER BY a) AS runs FROM maximal GROUP BY rid)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(s.n, 0) AS BIGINT) AS n_removed,
  coalesce(removed, '') AS removed, CAST(coalesce(m.n, 0) AS BIGINT) AS n_runs,
  CAST(coalesce(longest, 0) AS BIGINT) AS longest_run, coalesce(runs, '') AS runs
FROM d LEFT JOIN n USING (rid) LEFT JOIN s USING (rid) LEFT JOIN m USING (rid)""",
    "line_repeats": r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT rid, doc_id, i, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
    row_number() OVER (PARTITION BY rid ORDER BY i) AS p FROM
  (SELECT rid, doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
w AS (SELECT rid, doc_id, p, 1 AS size, line AS k FROM l WHERE words >= 50
  UNION ALL SELECT a.rid, a.doc_id, a.p, 2, concat_ws(chr(10), a.line, b.line) FROM l a
    JOIN l b ON b.rid = a.rid AND b.p = a.p + 1 WHERE a.words + b.words >= 50
  UNION ALL SELECT a.rid, a.doc_id, a.p, 3, concat_ws(chr(10), a.line, b.line, c.line) FROM l a
    JOIN l b ON b.rid = a.rid AND b.p = a.p + 1 JOIN l c ON c.rid = a.rid AND c.p = a.p + 2),
whole AS (SELECT rid, doc_id, count(*) AS size, string_agg(line, chr(10) ORDER BY i) AS k FROM l GROUP BY rid, doc_id HAVING count(*) < 3),
later AS (SELECT rid, p, size FROM (SELECT *, row_number() OVER (PARTITION BY size, k ORDER BY doc_id, rid, p) AS c FROM w) WHERE c > 1
  UNION ALL SELECT rid, 1, size FROM (SELECT *, row_number() OVER (PARTITION BY size, k ORDER BY doc_id, rid) AS c FROM whole) WHERE c > 1),
gone AS (SELECT DISTINCT l.rid, l.i FROM later JOIN l ON l.rid = later.rid AND l.p BETWEEN later.p AND later.p + later.size - 1),
s AS (SELECT rid, sum(n) AS n, string_agg(concat(a, ':', b), ',' ORDER BY a) AS repeats FROM
  (SELECT rid, count(*) AS n, min(i) AS a, max(i) + 1 AS b FROM
    (SELECT rid, i, i - row_number() OVER (PARTITION BY rid ORDER BY i) AS g FROM gone) GROUP BY rid, g) GROUP BY rid),
n AS (SELECT rid, count(*) AS n FROM l GROUP BY rid)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(s.n, 0) AS BIGINT) AS n_repeats,
  coalesce(repeats, '') AS repeats
FROM d LEFT JOIN n USING (rid) LEFT JOIN s USING (rid)""",
    "op8_warc_zstd": """
WITH p AS (SELECT page_id, nullif(url, '') AS url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h),
x AS (SELECT *, list_transform(generate_series(0, 7), lambda i: CAST(concat('0x', substr(h, 5 * i + 1, 5)) AS BIGINT)) AS v FROM p JOIN f USING (h))
SELECT page_id, url, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(v, lambda n: array_to_string(list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((n >> s) & 31 AS BIGINT) + 1, 1)), '')), '') AS payload_digest,
  CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM x""",
}
