"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import licences, line_rules, pigeonhole


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    t = f"regexp_replace(lower({text}), '\\r\\n?', chr(10), 'g')"
    for pattern in (licences.COPYRIGHT_LINE, licences.TITLE_LINE, licences.LIST_MARK):
        t = f"regexp_replace({t}, {_text(pattern)}, '', 'g')"
    t = f"concat(' ', trim(regexp_replace({t}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')"
    for a, b in licences.SPELLINGS:
        t = f"replace({t}, ' {a} ', ' {b} ')"
    return f"CASE WHEN {text} IS NOT NULL THEN md5(nullif(trim({t}), '')) END"


OP1 = f"""
WITH known AS (
  SELECT licence_digest, min(licence) AS licence
  FROM (SELECT licence, {_canonical("text")} AS licence_digest
        FROM (VALUES {", ".join(f"({_text(k)}, {_text(v)})" for k, v in licences.KNOWN.items())}) AS v(licence, text)
        UNION ALL SELECT * FROM (VALUES {", ".join(f"({_text(k)}, {_text(d)})" for k, ds in licences.DIGESTS.items() for d in ds)}) AS w(licence, licence_digest))
  WHERE licence_digest IS NOT NULL GROUP BY 1),
d AS (SELECT doc_id, {_canonical("text")} AS licence_digest FROM documents)
SELECT d.doc_id, d.licence_digest, k.licence, k.licence IS NOT NULL AS is_licence
FROM d LEFT JOIN known k ON d.licence_digest = k.licence_digest
"""

OP6 = f"""
WITH d AS (SELECT doc_id, text AS given, coalesce(text, '') AS text, source, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
k AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
win AS (
  SELECT doc_id, i, word AS a, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c FROM k WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM win WHERE c IS NOT NULL) WHERE n >= 2),
cover AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM rep, (VALUES (0), (1), (2)) AS o(j) GROUP BY 1),
ln AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM d),
lw AS (
  SELECT doc_id, source, line, place, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n,
         nullif(trim(regexp_replace(lower(line), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), '') AS norm
  FROM ln WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lw GROUP BY 1),
freq AS (
  SELECT f.source, f.norm FROM (SELECT source, norm, count(DISTINCT doc_id) AS n FROM lw WHERE norm IS NOT NULL GROUP BY 1, 2) f
  JOIN (SELECT source, count(*) AS m FROM d GROUP BY 1) h ON f.source IS NOT DISTINCT FROM h.source
  WHERE f.n > {line_rules.MIN_LINE_DOCUMENTS} AND f.n > CAST({line_rules.MAX_HOST_SHARE} AS DOUBLE) * h.m),
gone AS (
  SELECT doc_id, place, n FROM lw JOIN freq f ON lw.norm = f.norm AND lw.source IS NOT DISTINCT FROM f.source),
lost AS (SELECT doc_id, sum(n) AS lost, count(*) AS n_removed_lines FROM gone GROUP BY 1),
clean AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE gone.n IS NULL), '') AS clean FROM ln LEFT JOIN gone USING (doc_id, place) GROUP BY 1),
base AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         coalesce(lost > CAST({line_rules.MAX_REMOVED_SHARE} AS DOUBLE) * len(w), false) AS depleted, CAST(coalesce(n_removed_lines, 0) AS BIGINT) AS n_removed_lines,
         CASE WHEN given IS NOT NULL THEN md5(clean) END AS clean_md5
  FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN lost USING (doc_id) LEFT JOIN clean USING (doc_id))
SELECT doc_id, n_removed_lines, clean_md5, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {line_rules.MIN_WORDS} OR 100 * n_repeat_words > {line_rules.MAX_REPEATED_PERCENT} * n_words AS base_failed,
       NOT (n_words < {line_rules.MIN_WORDS} OR 100 * n_repeat_words > {line_rules.MAX_REPEATED_PERCENT} * n_words) AND NOT depleted AS kept
FROM base
"""

OP12 = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
u AS (
  SELECT * FROM v WHERE label IS NOT NULL AND x IS NOT NULL AND len(x) > 0
  AND list_bool_and([c IS NOT NULL AND isfinite(c) FOR c IN x]) AND list_bool_or([c <> 0 FOR c IN x])),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= CAST({pigeonhole.COSINE} AS DOUBLE)),
reached AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reached r JOIN link l ON r.b = l.a),
low AS (SELECT a, min(b) AS least FROM reached GROUP BY 1),
n AS (SELECT a, count(*) AS n FROM link GROUP BY 1)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(low.least, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(low.least, vec_id)) AS kept
FROM v LEFT JOIN n ON vec_id = n.a LEFT JOIN low ON vec_id = low.a
"""

ORACLES = {"op1_license_scan": OP1, "op6_quality_rules": OP6, "op12_embedding_dedup": OP12}
