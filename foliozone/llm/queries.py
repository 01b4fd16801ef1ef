"""The queries of this folder and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foliozone.llm import decontamination, filter_audit, language, licenses, main_text, phrases, quality, secret_scan, sentence_pieces, simhash, substrings, suffixes, token_counts
from foliozone.llm.tables import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.digest(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(substrings.repeated_spans(table(spark, sf_dir, "documents")))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.digest(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(table(spark, sf_dir, "documents"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(table(spark, sf_dir, "documents")))


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.digest(decontamination.decontaminate(docs, items))


def op11_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(suffixes.repeated_spans(table(spark, sf_dir, "documents")))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_substring_dedup,
        op3_html_extraction,
        op4_secret_scans,
        op5_sentencepiece,
        op6_quality_rules,
        op7_token_counts,
        op8_simhash_near_dedup,
        op9_license_scans,
        op10_benchmark_decontamination,
        op11_suffix_array_dedup,
        op12_phrase_collocations,
        op13_filter_audit,
    )
}

#: DuckDB SQL over the same tables.
ORACLES: dict[str, str] = {
    "op2_substring_dedup": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
h AS (SELECT rid, i, md5(array_to_string(w[i : i + 34], ' ')) AS g FROM s),
r AS (SELECT g FROM h GROUP BY g HAVING count(*) > 1),
p AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS p FROM h SEMI JOIN r USING (g)),
x AS (SELECT rid, count(*) AS n_removed, list(p) AS gone FROM p GROUP BY rid),
k AS (SELECT doc_id, rid, w, coalesce(n_removed, 0) AS n_removed FROM d LEFT JOIN x USING (rid)),
u AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
t AS (SELECT rid, string_agg(word, ' ' ORDER BY p) AS kept FROM u ANTI JOIN p USING (rid, p) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM k LEFT JOIN t USING (rid)
""",
    "op6_quality_rules": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT rid, i, array_to_string(w[i : i + 2], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
r AS (SELECT rid, g FROM g GROUP BY rid, g HAVING count(*) > 1),
n AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest(range(i, i + 3)) AS p FROM g SEMI JOIN r USING (rid, g)) GROUP BY rid),
l AS (SELECT rid, source, line, length(line) AS chars, lower(trim(regexp_replace(line, '[0-9\x20\x09-\x0D]+', ' ', 'g'))) AS norm
  FROM (SELECT rid, source, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
h AS (SELECT source, count(*) AS docs FROM d GROUP BY source),
c AS (SELECT l.source, norm FROM l JOIN h ON l.source IS NOT DISTINCT FROM h.source GROUP BY l.source, norm, docs HAVING count(DISTINCT rid) > 10 AND count(DISTINCT rid) > 0.02 * docs),
a AS (SELECT rid, sum(chars) AS chars, count(*) - count(DISTINCT line) AS n_dup_lines, sum(CASE WHEN c.norm IS NULL THEN 0 ELSE chars END) AS lost
  FROM l LEFT JOIN c ON l.source IS NOT DISTINCT FROM c.source AND l.norm = c.norm GROUP BY rid),
b AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(chars, 0) AS chars, coalesce(lost, 0) AS lost
  FROM d LEFT JOIN n USING (rid) LEFT JOIN a USING (rid))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND chars - lost >= 0.5 * chars AS kept, CAST(lost AS BIGINT) AS n_chars_lost
FROM b
""",
    "op10_benchmark_decontamination": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (SELECT item_id, w, least(len(w), 13) AS k, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS g FROM bs),
ks AS (SELECT DISTINCT k FROM bw),
ds AS (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k),
dw AS (SELECT rid, k, i, array_to_string(w[i : i + k - 1], ' ') AS g FROM ds),
h AS (SELECT rid, dw.k, i, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.k = bw.k),
p AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM h) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN p USING (rid) LEFT JOIN t USING (rid)
""",
    "op11_suffix_array_dedup": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, b, substr(h, 2 * b + 1, 2 * 599) AS s FROM (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 99, 0), 500)) AS b FROM d)),
w AS (SELECT doc_id, b + i AS p, md5(substr(s, 2 * i + 1, 200)) AS g FROM (SELECT doc_id, b, s, unnest(range(0, length(s) // 2 - 99)) AS i FROM c)),
f AS (SELECT g, min(row(doc_id, p)) AS first FROM w GROUP BY g HAVING count(*) > 1),
x AS (SELECT doc_id, p FROM w JOIN f USING (g) WHERE row(doc_id, p) <> first),
y AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS new FROM x),
i AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS e FROM (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM y) GROUP BY doc_id, run),
k AS (SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS e FROM i UNION ALL SELECT doc_id, max(e) AS a, NULL AS e FROM i GROUP BY doc_id),
r AS (SELECT doc_id, sha256(unhex(string_agg(substr(h, 2 * a + 1, coalesce(2 * (e - a), length(h))), '' ORDER BY a))) AS kept FROM k JOIN d USING (doc_id) GROUP BY doc_id),
n AS (SELECT doc_id, sum(e - a) AS n_removed, count(*) AS n_spans FROM i GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, coalesce(kept, sha256(t)) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id)
""",
    "op12_phrase_collocations": r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM t)),
g AS (SELECT lang, k, w[i : i + k - 1] AS g FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, 5) r(k) WHERE len(w) >= k)),
f AS (SELECT lang, k AS size, g, count(*) AS f FROM g GROUP BY lang, k, g),
n AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
q AS (SELECT lang, size, g, f FROM f WHERE f >= 30),
c AS (SELECT lang, size, g, f AS a FROM q WHERE size > 1),
h AS (SELECT lang, s, max(a) AS longer FROM (SELECT lang, a, g[i : i + k - 1] AS s FROM (SELECT c.*, k, unnest(range(1, size - k + 2)) AS i FROM c, range(2, 4) r(k) WHERE k < size)) GROUP BY lang, s),
u AS (SELECT c.* FROM c LEFT JOIN h ON c.lang = h.lang AND c.g = h.s WHERE longer IS NULL OR longer::HUGEINT * 100 < a::HUGEINT * 80),
x AS (SELECT lang, g, a, k, g[1 : k] AS head, g[k + 1 : size] AS tail FROM u, range(1, 4) r(k) WHERE k < size),
y AS (SELECT x.lang, x.g, x.a, x.k, l.f AS l, r.f AS r, (2000000::HUGEINT * x.a) // (l.f::HUGEINT + r.f) AS score
  FROM x JOIN q l ON x.lang = l.lang AND x.head = l.g JOIN q r ON x.lang = r.lang AND x.tail = r.g),
z AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS cut FROM y),
o AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM z WHERE cut = 1),
v AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM v JOIN n USING (lang) WHERE rank <= 2000
""",
    "op13_filter_audit": r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT t, min(doc_id) AS first FROM t GROUP BY t),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(w) < 100 THEN ['A'] ELSE [] END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN ['B'] ELSE [] END ||
    CASE WHEN 100 * length(regexp_replace(t.t, '[^A-Z]', '', 'g')) > 10 * length(t.t) THEN ['C'] ELSE [] END ||
    CASE WHEN regexp_matches(t.t, '[#$%&*|]') THEN ['D'] ELSE [] END || CASE WHEN t.doc_id > first THEN ['E'] ELSE [] END AS f
  FROM t JOIN s USING (t) LEFT JOIN l USING (doc_id)),
c AS (SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM d GROUP BY part, f),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s2 AS (SELECT array_to_string(o, '') AS filter_order, i AS step, o[i] AS x, o[1 : i - 1] AS before FROM (SELECT o, unnest(range(1, 6)) AS i FROM o)),
r AS (SELECT part, filter_order, step, x,
    sum(CASE WHEN NOT list_has_any(f, before) AND NOT list_contains(f, x) THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN NOT list_has_any(f, before) AND list_contains(f, x) THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN list_has_any(f, before) AND list_contains(f, x) THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN f = [x] THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT list_has_any(f, before) AND list_contains(f, x) THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN NOT list_has_any(f, before) AND list_contains(f, x) THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s2 GROUP BY part, filter_order, step, x)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM r
""",
}
