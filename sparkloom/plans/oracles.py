"""DuckDB SQL for the queries of this package, written apart from the operators."""

from __future__ import annotations

from ..operators import clean, export, generate
from .queries import BOTH, CONFIG, COPIES, LATER, MIX, MUTATED, TARGET, registry_rows

WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def lit(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def lits(xs) -> str:
    return f"CAST([{', '.join(map(lit, xs))}] AS VARCHAR[])"


def num(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


REG = "reg AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, {lit(r['name'])}, {lit(r['domain'])}, {lit(r['description'])}, {lits(r['keywords'])}, {lits(r['confusable'])})" for i, r in enumerate(registry_rows())) + ") AS t(idx, name, domain, description, keywords, confusable))"


#: Suppliers as a registry.
REGS = """reg AS (SELECT CAST(s_suppkey AS INT) AS idx, s_name AS name, 'domain' || CAST(s_suppkey // 10 AS VARCHAR) AS domain, s_name || ' of nation ' || CAST(s_nationkey AS VARCHAR) AS description,
  ['nation' || CAST(s_nationkey AS VARCHAR) || '/' || CAST(s_suppkey // 100 AS VARCHAR), 'balance' || CAST(CAST(floor(s_acctbal / 1000) AS BIGINT) AS VARCHAR) || '/' || CAST(s_suppkey // 100 AS VARCHAR), 'block' || CAST(s_suppkey // 25 AS VARCHAR)] AS keywords,
  ['Supplier#' || lpad(CAST(s_suppkey + 7 AS VARCHAR), 9, '0'), 'Supplier#' || lpad(CAST(2 * s_suppkey + 1 AS VARCHAR), 9, '0')] AS confusable FROM supplier)"""


def smp(label: str = "source") -> str:
    return f"smp AS (SELECT doc_id AS seq, text AS question, {label} AS answer, 'stage' || CAST(doc_id % 3 + 1 AS VARCHAR) AS stage FROM documents)"


MUT = ["plain AS (SELECT doc_id AS seq, text AS question, source AS answer, 'stage' || CAST(doc_id % 3 + 1 AS VARCHAR) AS stage FROM documents)", f"changed AS ({MUTATED})", f"smp AS ({COPIES})"]


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def share(x: str, cls: str) -> str:
    return f"(CAST(length(regexp_replace({x}, '[^{cls}]', '', 'g')) AS DOUBLE) / length({x}))"


def judged(cfg: clean.CleanConfig = CONFIG) -> str:
    no_meaning = " OR ".join(f"regexp_matches(q, {lit('(?i)' + p)})" for p in clean.NO_MEANING)
    top = "(CAST(list_max(list_transform(list_distinct(string_split(q, '')), lambda c: length(q) - length(replace(q, c, '')))) AS DOUBLE) / length(q))"
    return f"""
j0 AS (SELECT seq, stage, question AS raw, coalesce({strip("question")}, '') AS q, coalesce({strip("answer")}, '') AS a, answer, coalesce(keywords, []) AS keywords, name IS NOT NULL AS legal
       FROM smp LEFT JOIN reg ON smp.answer = reg.name),
j1 AS (SELECT *, CASE WHEN q = '' THEN {lit(clean.EMPTY_QUESTION)} WHEN a = '' THEN {lit(clean.EMPTY_ANSWER)} WHEN NOT legal THEN {lit(clean.BAD_LABEL)}
         WHEN length(q) < {cfg.min_length} THEN {lit(clean.SHORT)} WHEN length(q) > {cfg.max_length} THEN {lit(clean.LONG)} WHEN contains(q, a) THEN {lit(clean.LEAK)}
         WHEN length(q) > 10 AND {share("q", cfg.script)} < {num(cfg.min_script_ratio)} AND NOT regexp_matches(q, {lit(clean.TECHNICAL)}) THEN {lit(clean.SCRIPT)}
         WHEN {top} > {num(cfg.max_repeat_ratio)} THEN {lit(clean.REPEATED)} WHEN {no_meaning} THEN {lit(clean.MEANINGLESS)} ELSE '' END AS reason FROM j0),
jd AS (SELECT *, {score("raw")} AS score FROM j1)"""


def score(q: str) -> str:
    count = lambda tests: "(" + " + ".join(f"CAST({t} AS INT)" for t in tests) + ")"
    n = f"length({q})"
    length = f"CASE WHEN {n} BETWEEN 15 AND 150 THEN {num(1.0)} WHEN {n} BETWEEN 8 AND 14 OR {n} BETWEEN 151 AND 300 THEN {num(0.7)} ELSE {num(0.4)} END"
    hits = f"len(list_filter(keywords, lambda k: contains({q}, k)))"
    relevance = f"CASE WHEN len(keywords) > 0 THEN least({num(1.0)}, {num(0.5)} + {hits} * {num(0.25)}) ELSE {num(0.5)} END"
    diversity = f"greatest({num(0.3)}, {num(1.0)} - {count(f'regexp_matches({q}, {lit(p)})' for p in clean.TEMPLATES)} * {num(0.3)})"
    density = f"least({num(1.0)}, CAST(len(list_distinct(string_split({q}, ''))) AS DOUBLE) / greatest({n} * {num(0.5)}, {num(1.0)}))"
    patterns = [f"regexp_matches({q}, {lit(p)})" for p in clean.NATURAL] + [f"NOT regexp_matches({q}, {lit(f'^{WS}*[A-Z]')})"]
    natural = f"({count(patterns)} / {num(4.0)})"
    out = num(0.0)
    for part, w in zip((length, relevance, diversity, density, natural), clean.WEIGHTS, strict=True):
        out = f"({out} + ({part}) * {num(w)})"
    return out


def seeded(seed: int, *key: str) -> str:
    return f"md5(concat('{seed}:', concat_ws(':', {', '.join(f'CAST({k} AS VARCHAR)' for k in key)})))"


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes)


def gram_ctes(source: str, t: float) -> list[str]:
    """From `source` (seq, label, question): grams, pairs at the threshold among all rows."""
    text = f"regexp_replace(lower(coalesce(question, '')), '{WS}+', '', 'g')"
    return [
        f"gt AS (SELECT seq, label, {text} AS t FROM {source})",
        "gs AS (SELECT seq, label, CASE WHEN length(t) < 3 THEN [t] ELSE list_distinct(list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3))) END AS g FROM gt)",
        "ge AS (SELECT label, seq, len(g) AS n, unnest(g) AS x FROM gs)",
        f"pr AS (SELECT a.label, a.seq AS seq_a, b.seq AS seq_b, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb FROM ge a JOIN ge b ON a.label = b.label AND a.x = b.x AND a.seq < b.seq AND a.n >= {t} * b.n - 0.001 AND b.n >= {t} * a.n - 0.001 GROUP BY ALL)",
        f"np AS MATERIALIZED (SELECT label, seq_a, seq_b, CAST(c AS DOUBLE) / (na + nb - c) AS jaccard FROM pr WHERE CAST(c AS DOUBLE) / (na + nb - c) >= {num(t)})",
    ]


#: Rows in order of seq; a row is dropped if a pair joins it to an earlier row not dropped.
GREEDY = [
    "ord AS MATERIALIZED (SELECT seq_b, list(seq_a) AS earlier, row_number() OVER (ORDER BY seq_b) AS i FROM np GROUP BY seq_b)",
    "fold AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS dropped UNION ALL SELECT ord.i, CASE WHEN len(list_filter(earlier, lambda e: NOT list_contains(dropped, e))) > 0 THEN list_append(dropped, seq_b) ELSE dropped END FROM fold JOIN ord ON ord.i = fold.i + 1)",
    "gone AS (SELECT unnest(dropped) AS seq FROM (SELECT dropped FROM fold ORDER BY i DESC LIMIT 1))",
]

QUOTA = f"""qs AS (SELECT seq, question, answer, stage, row_number() OVER (PARTITION BY answer, stage ORDER BY {seeded(42, "seq")}, seq) AS r FROM smp WHERE answer IN (SELECT name FROM reg)),
qk AS (SELECT * FROM qs WHERE r <= CASE stage WHEN 'stage1' THEN {int(TARGET * MIX[0])} WHEN 'stage2' THEN {int(TARGET * MIX[1])} ELSE {TARGET - int(TARGET * MIX[0]) - int(TARGET * MIX[1])} END)"""
EXACT = "SELECT seq, row_number() OVER (PARTITION BY md5(coalesce(question, '')) ORDER BY seq) AS r FROM smp"
MERGED = f"mg AS (SELECT seq, answer, stage, {seeded(42, lit('merge'), 'seq')} AS place FROM (SELECT *, row_number() OVER (PARTITION BY md5(coalesce(question, '')) ORDER BY seq) AS x FROM qk) WHERE x = 1)"
STRAT = f"""st AS (SELECT seq, row_number() OVER (PARTITION BY answer ORDER BY {seeded(42, "seq")}, seq) AS i, count(*) OVER (PARTITION BY answer) AS n FROM smp),
sp AS (SELECT seq, CASE WHEN i <= greatest(1, floor(n * {num(0.8)})) THEN 'train' WHEN i <= greatest(1, floor(n * {num(0.8)})) + greatest(1, floor(n * {num(0.1)})) THEN 'val' ELSE 'test' END AS split FROM st)"""
LABELS = "ld AS (SELECT coalesce(answer, '') AS answer, count(*) AS n FROM smp GROUP BY 1)"

PAIRS = [
    """rp AS (SELECT least(a.name, o) AS agent_a, greatest(a.name, o) AS agent_b, 'registry' AS source, CAST(0.8 AS DOUBLE) AS overlap_score, 0 AS p, CAST(a.idx AS BIGINT) AS i, CAST(a.k AS BIGINT) AS j, CAST(0 AS BIGINT) AS d
       FROM (SELECT idx, name, unnest(confusable) AS o, generate_subscripts(confusable, 1) AS k FROM reg) a WHERE o IN (SELECT name FROM reg))""",
    """kp AS (SELECT least(a.name, b.name) AS agent_a, greatest(a.name, b.name) AS agent_b, 'keyword_overlap' AS source, CAST(len(list_intersect(a.keywords, b.keywords)) AS DOUBLE) / len(list_distinct(list_concat(a.keywords, b.keywords))) AS overlap_score,
       1 AS p, CAST(a.idx AS BIGINT) AS i, CAST(b.idx AS BIGINT) AS j, CAST(0 AS BIGINT) AS d FROM reg a JOIN reg b ON a.idx < b.idx
       WHERE CAST(len(list_intersect(a.keywords, b.keywords)) AS DOUBLE) / len(list_distinct(list_concat(a.keywords, b.keywords))) >= CAST(0.3 AS DOUBLE) AND len(list_intersect(a.keywords, b.keywords)) > 0)""",
    """dp AS (SELECT least(a.name, b.name) AS agent_a, greatest(a.name, b.name) AS agent_b, 'domain' AS source, CAST(0.2 AS DOUBLE) AS overlap_score, 2 AS p,
       min(a.idx) OVER (PARTITION BY a.domain) AS i, CAST(a.idx AS BIGINT) AS j, CAST(b.idx AS BIGINT) AS d FROM reg a JOIN reg b ON a.domain = b.domain AND a.idx < b.idx)""",
]


def paired(*parts: str) -> str:
    union = " UNION ALL ".join(f"SELECT * FROM {p}" for p in parts)
    return f"""u AS (SELECT *, row_number() OVER (PARTITION BY agent_a, agent_b ORDER BY p, i, j, d) AS r FROM ({union})),
ap AS (SELECT u.*, array_to_string(list_sort(list_intersect(x.keywords, y.keywords)), ',') AS shared_keywords FROM u JOIN reg x ON x.name = agent_a JOIN reg y ON y.name = agent_b WHERE r = 1)"""


FLAT = "SELECT agent_a, agent_b, source, overlap_score, shared_keywords FROM ap"
CAPPED = """oe AS MATERIALIZED (SELECT agent_a, agent_b, row_number() OVER (ORDER BY overlap_score DESC, p, i, j, d) AS k FROM ap),
cf AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS used, CAST([] AS BIGINT[]) AS taken UNION ALL
  SELECT oe.k, CASE WHEN len(list_filter(used, lambda x: x = agent_a)) < 5 AND len(list_filter(used, lambda x: x = agent_b)) < 5 THEN list_concat(used, [agent_a, agent_b]) ELSE used END,
         CASE WHEN len(list_filter(used, lambda x: x = agent_a)) < 5 AND len(list_filter(used, lambda x: x = agent_b)) < 5 THEN list_append(taken, oe.k) ELSE taken END
  FROM cf JOIN oe ON oe.k = cf.k + 1),
tk AS (SELECT unnest(taken) AS k, generate_subscripts(taken, 1) - 1 AS place FROM (SELECT taken FROM cf ORDER BY k DESC LIMIT 1)),
cp AS (SELECT agent_a, agent_b, CAST(place AS BIGINT) AS place FROM tk JOIN oe USING (k))"""


def digested(record: str) -> str:
    return with_(smp()) + f" SELECT seq, CAST(length(record) AS BIGINT) AS n, md5(record) AS record_md5 FROM (SELECT seq, {record} AS record FROM smp)"


def js(x: str) -> str:
    return f"CAST(to_json({x}) AS VARCHAR)"


def csv_field(x: str) -> str:
    return f"""CASE WHEN regexp_matches({x}, '[",\\r\\n]') THEN concat('"', replace({x}, '"', '""'), '"') ELSE {x} END"""


def bank() -> str:
    rows = [(k, i, t, len(ts)) for k, ts in generate.TEMPLATES.items() for i, t in enumerate(ts)]
    return "bank AS (SELECT * FROM (VALUES " + ", ".join(f"({lit(k)}, {i}, {lit(t)}, {n})" for k, i, t, n in rows) + ") AS t(kind, i, text, n))"


def filled(text: str, name: str, other: str, count: int) -> str:
    out = text
    for slot, value in (("name", name), ("description", "description"), ("keywords", "array_to_string(keywords, '、')"), ("other", other), ("count", lit(str(count)))):
        out = f"replace({out}, '{{{slot}}}', {value})"
    return out


def tasks(kind: str, n: int, count: int, start: int = 0) -> str:
    return with_(REGS, bank(), f"t AS (SELECT reg.*, c, CASE (c + {start}) % 4 {' '.join(f'WHEN {k} THEN {lit(x)}' for k, x in enumerate(generate.COMPLEX))} END AS complex FROM reg, range({n}) AS r(c))") + f"""
SELECT {generate.KINDS.index(kind) << (generate.CALL_BITS + 31)} + CAST(idx AS BIGINT) * {1 << generate.CALL_BITS} + c AS task_idx, bank.kind, {lit(generate.SYSTEM)} AS system, {filled("text", "name", "''", count)} AS "user", name AS expected_answer
FROM t JOIN bank ON bank.kind = {"complex" if kind == "stage2_complex" else lit(kind)} AND (c + {start}) % bank.n = bank.i"""  # fmt: skip


CLEANED = [
    "p2 AS (SELECT seq, answer, raw AS question FROM jd WHERE reason = '' AND round(score, 4) >= CAST(0.55 AS DOUBLE))",
    "xk AS (SELECT seq, answer AS label, question FROM (SELECT *, row_number() OVER (PARTITION BY md5(question) ORDER BY seq) AS r FROM p2) WHERE r = 1)",
]

JUDGED = f"""
, r AS (SELECT seq, answer, stage, CASE WHEN reason <> '' THEN reason WHEN seq NOT IN (SELECT seq FROM p2) THEN {lit(clean.LOW_QUALITY)} WHEN seq NOT IN (SELECT seq FROM xk) THEN {lit(clean.EXACT_COPY)} WHEN seq IN (SELECT seq FROM gone) THEN {lit(clean.NEAR_COPY)} ELSE '' END AS reason FROM jd)
"""
MOCK = ("这个问题该怎么处理？", "请帮我看看当前的情况。", "我们需要尽快给出方案。")
CALLS = generate.stage1_calls(40)

ORACLES = {
    "hard_filter_mutated": with_(REG, *MUT, judged()) + f" SELECT reason, count(*) AS n FROM (SELECT reason FROM jd WHERE reason <> '' UNION ALL SELECT {lit(clean.EMPTY_ANSWER)} FROM jd WHERE q = '' AND a = '') GROUP BY 1",
    "clean_pipeline_mutated": with_(REG, *MUT, judged(BOTH), *CLEANED, *gram_ctes("xk", 0.85), *GREEDY) + JUDGED + " SELECT seq, reason, reason = '' AS kept, reason = '' AND row_number() OVER (PARTITION BY answer ORDER BY reason <> '', seq) <= 20 AS written FROM r",
    "exact_dedup_mutated": with_(*MUT) + f" SELECT seq FROM ({EXACT}) WHERE r = 1",
    "file_stats_mutated": with_(REG, *MUT, judged(BOTH), *CLEANED, *gram_ctes("xk", 0.85), *GREEDY) + JUDGED + " SELECT stage, count(*) AS n_input, count(*) FILTER (WHERE reason = '') AS n_passed, round(CAST(count(*) FILTER (WHERE reason = '') AS DOUBLE) / count(*), 6) AS pass_rate FROM r GROUP BY 1",
    "extract_json": f"SELECT conv_id, turn, q AS question, 'label' AS answer FROM (SELECT conv_id, turn, {strip('text')} AS q FROM conversations WHERE text IS NOT NULL) WHERE length(q) BETWEEN 5 AND 500 AND NOT contains(q, 'label')",
    "generated_offline": with_(REGS, f"m AS (SELECT name, c, k, t FROM reg, range({CALLS}) AS r(c), (VALUES {', '.join(f'({k}, {lit(t)})' for k, t in enumerate(MOCK))}) AS v(k, t))") + " SELECT '[MOCK] ' || t AS question, name AS answer FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY c, k) AS i FROM m) WHERE i <= 40",
    "response_stats": with_(REGS) + f" SELECT count(*) * {CALLS} AS calls, count(*) * {CALLS} AS succeeded, CAST(0 AS BIGINT) AS failed, count(*) * {3 * CALLS} AS items, count(*) * {100 * CALLS} AS prompt_tokens, count(*) * {50 * CALLS} AS completion_tokens, CAST(1 AS DOUBLE) AS success_rate FROM reg",
    "batch_prompts": with_(REGS) + f" SELECT name AS expected_answer, {lit(generate.SYSTEM)} AS system, concat('为智能体「', name, '」（', description, '）写3条用户问题，关键词：', array_to_string(keywords, '、'), '。各条依次：换一种语气；从新手的角度提问；从专家的角度提问。输出JSON数组，每项含question与answer。') AS \"user\" FROM reg",
    "registry_subset": with_(REGS) + " SELECT idx, name FROM reg WHERE name IN ('Supplier#000000003', 'Supplier#000000007')",
    "hard_negatives_offline": with_(REGS, *PAIRS, paired("rp", "kp", "dp"), CAPPED) + f" SELECT pair, answer, least(25, {3 * generate.spare_calls(25, 5)}) AS n FROM (SELECT agent_a || '_vs_' || agent_b || '_' || substr(md5(concat(agent_a, chr(31), agent_b)), 1, 8) AS pair, unnest([agent_a, agent_b]) AS answer FROM cp)",
    "hard_filter_reasons": with_(REG, smp(), judged()) + " SELECT reason, count(*) AS n FROM jd WHERE reason <> '' GROUP BY 1",
    "hard_filter_rows": with_(REG, smp(), judged()) + " SELECT seq, reason FROM jd",
    "quality_scores": with_(REG, smp(), judged()) + " SELECT seq, score FROM jd",
    "exact_dedup": with_(smp()) + f" SELECT seq FROM ({EXACT}) WHERE r = 1",
    "exact_dedup_by_stage": with_(smp()) + " SELECT seq, stage FROM (SELECT seq, stage, row_number() OVER (PARTITION BY md5(coalesce(question, '')), stage ORDER BY seq) AS r FROM smp) WHERE r = 1",
    "label_cap": with_(smp()) + " SELECT seq, stage, answer FROM (SELECT *, row_number() OVER (PARTITION BY stage, answer ORDER BY seq) AS r FROM smp) WHERE r <= 7",
    "normalised": with_(smp()) + f" SELECT seq, md5(q) AS question_md5, CAST(length(q) AS BIGINT) AS n FROM (SELECT seq, regexp_replace({strip('question')}, '{WS}+', ' ', 'g') AS q FROM smp)",
    "ngram_counts": with_(smp("lang"), "s AS (SELECT seq, answer AS label, question FROM smp)", *gram_ctes("s", 0.85)[:2]) + " SELECT seq, label, CAST(len(g) AS BIGINT) AS n_grams FROM gs",
    "ngram_near_dup_pairs": with_(smp("lang"), "s AS (SELECT seq, answer AS label, question FROM smp)", *gram_ctes("s", 0.85)[:2], "ns AS (SELECT seq, label, g FROM (SELECT *, row_number() OVER (PARTITION BY label, list_sort(g) ORDER BY seq) AS r FROM gs) WHERE r = 1)", "ge AS (SELECT label, seq, len(g) AS n, unnest(g) AS x FROM ns)", *gram_ctes("s", 0.85)[3:]) + " SELECT * FROM np",
    "ngram_greedy_dedup": with_(smp("lang"), "s AS (SELECT seq, answer AS label, question FROM smp)", *gram_ctes("s", 0.85), *GREEDY) + " SELECT seq FROM smp WHERE seq NOT IN (SELECT seq FROM gone)",
    "clean_pipeline": with_(REG, smp(), judged(BOTH), *CLEANED, *gram_ctes("xk", 0.85), *GREEDY) + f"""
, r AS (SELECT seq, answer, CASE WHEN reason <> '' THEN reason WHEN seq NOT IN (SELECT seq FROM p2) THEN {lit(clean.LOW_QUALITY)} WHEN seq NOT IN (SELECT seq FROM xk) THEN {lit(clean.EXACT_COPY)} WHEN seq IN (SELECT seq FROM gone) THEN {lit(clean.NEAR_COPY)} ELSE '' END AS reason FROM jd)
SELECT seq, reason, reason = '' AS kept, reason = '' AND row_number() OVER (PARTITION BY answer ORDER BY reason <> '', seq) <= 20 AS written FROM r""",
    "clean_stats": with_(REG, smp(), judged(), *CLEANED) + """
SELECT count(*) AS total, (SELECT count(*) FROM xk) AS passed, count(*) FILTER (WHERE reason <> '') AS rejected_hard, count(*) FILTER (WHERE reason = '' AND seq NOT IN (SELECT seq FROM p2)) AS rejected_quality,
  (SELECT count(*) FROM p2) - (SELECT count(*) FROM xk) AS rejected_dedup, CAST((SELECT count(*) FROM xk) AS DOUBLE) / count(*) AS pass_rate FROM jd""",
    "quota_merge": with_(REG, smp(), QUOTA, MERGED) + " SELECT * FROM mg",
    "merge_limited": with_(REG, smp(), QUOTA, MERGED) + " SELECT seq, place FROM mg ORDER BY place, seq LIMIT 100",
    "merge_stage_stats": with_(REG, smp(), QUOTA) + " SELECT name, count(*) FILTER (WHERE stage = 'stage1') AS stage1, count(*) FILTER (WHERE stage = 'stage2') AS stage2, count(*) FILTER (WHERE stage = 'stage3') AS stage3, count(stage) AS total FROM reg LEFT JOIN qk ON name = answer GROUP BY 1",
    "stratified_split": with_(smp(), STRAT) + " SELECT * FROM sp",
    "random_split": with_(smp(), f"o AS (SELECT seq, row_number() OVER (ORDER BY {seeded(42, 'seq')}, seq) AS i, count(*) OVER () AS n FROM smp)") + f" SELECT seq, CASE WHEN i <= floor(n * {num(0.8)}) THEN 'train' WHEN i <= floor(n * {num(0.8)}) + floor(n * {num(0.1)}) THEN 'val' ELSE 'test' END AS split FROM o",
    "split_sizes": with_(smp(), STRAT) + " SELECT split, count(*) AS n, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM smp) AS ratio FROM sp GROUP BY 1",
    "label_distribution": with_(smp(), LABELS) + " SELECT * FROM ld",
    "label_stats": with_(smp(), LABELS) + " SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS n_labels, min(n) AS min_n, max(n) AS max_n, avg(n) AS mean_n, stddev_pop(n) AS std_n FROM ld",
    "length_stats": with_(smp()) + " SELECT CAST(min(l) AS INT) AS min_len, CAST(max(l) AS INT) AS max_len, round(avg(l), 1) AS mean_len, round(stddev_pop(l), 1) AS std_len, avg(CAST(l <= 15 AS INT)) AS short_ratio, avg(CAST(l > 100 AS INT)) AS long_ratio FROM (SELECT length(question) AS l FROM smp)",
    "length_histogram": with_(smp()) + " SELECT count(*) FILTER (WHERE l <= 20) AS upto_20, count(*) FILTER (WHERE l BETWEEN 21 AND 80) AS from_21_to_80, count(*) FILTER (WHERE l BETWEEN 81 AND 200) AS from_81_to_200, count(*) FILTER (WHERE l > 200) AS over_200 FROM (SELECT length(question) AS l FROM smp)",
    "domain_distribution": with_(REG, smp()) + " SELECT coalesce(domain, '未知') AS domain, count(*) AS n FROM smp LEFT JOIN reg ON name = answer GROUP BY 1",
    "coverage": with_(REG, smp()) + " SELECT (SELECT count(DISTINCT answer) FROM smp) AS n_seen, (SELECT count(*) FROM reg) AS n_registered, CAST((SELECT count(DISTINCT answer) FROM smp) AS DOUBLE) / (SELECT count(*) FROM reg) AS coverage",
    "missing_labels": with_(REG, smp()) + " SELECT name FROM reg WHERE name NOT IN (SELECT answer FROM smp)",
    "balance_score": with_(smp(), f"x AS (SELECT answer, count(*) AS n FROM smp WHERE seq IN (SELECT seq FROM ({EXACT}) WHERE r = 1) GROUP BY 1)", "y AS (SELECT n, row_number() OVER (ORDER BY n, answer) AS i, count(*) OVER () AS k FROM x)") + " SELECT round(1 - abs(CAST(sum((2 * i - k - 1) * n) AS DOUBLE) / (any_value(k) * sum(n))), 4) AS balance_score FROM y",
    "dataset_report": with_(REG, smp(), LABELS, "ls AS (SELECT coalesce(answer, '') AS answer, length(coalesce(question, '')) AS l FROM smp)", "la AS (SELECT n, row_number() OVER (ORDER BY n, answer) AS i, count(*) OVER () AS k FROM ld)") + """,
whole(section, name, n) AS (
  SELECT 'labels', 'total', sum(n) FROM ld UNION ALL SELECT 'labels', 'n_labels', count(*) FROM ld UNION ALL SELECT 'labels', 'min_n', min(n) FROM ld UNION ALL SELECT 'labels', 'max_n', max(n) FROM ld
  UNION ALL SELECT 'lengths', 'min_len', min(l) FROM ls UNION ALL SELECT 'lengths', 'max_len', max(l) FROM ls
  UNION ALL SELECT 'length_histogram', 'upto_20', count(*) FILTER (WHERE l <= 20) FROM ls UNION ALL SELECT 'length_histogram', 'from_21_to_80', count(*) FILTER (WHERE l BETWEEN 21 AND 80) FROM ls
  UNION ALL SELECT 'length_histogram', 'from_81_to_200', count(*) FILTER (WHERE l BETWEEN 81 AND 200) FROM ls UNION ALL SELECT 'length_histogram', 'over_200', count(*) FILTER (WHERE l > 200) FROM ls
  UNION ALL SELECT 'coverage', 'n_seen', count(*) FROM ld UNION ALL SELECT 'coverage', 'n_registered', count(*) FROM reg
  UNION ALL SELECT 'label_distribution', answer, n FROM ld
  UNION ALL SELECT 'domain_distribution', coalesce(domain, '未知'), sum(n) FROM ld LEFT JOIN reg ON name = answer GROUP BY 2
  UNION ALL SELECT 'missing_labels', name, NULL FROM reg WHERE name NOT IN (SELECT answer FROM ld)),
parts(section, name, value) AS (
  SELECT 'labels', 'mean_n', avg(n) FROM ld UNION ALL SELECT 'labels', 'std_n', stddev_pop(n) FROM ld
  UNION ALL SELECT 'lengths', 'mean_len', round(avg(l), 1) FROM ls UNION ALL SELECT 'lengths', 'std_len', round(stddev_pop(l), 1) FROM ls
  UNION ALL SELECT 'lengths', 'short_ratio', avg(CAST(l <= 15 AS INT)) FROM ls UNION ALL SELECT 'lengths', 'long_ratio', avg(CAST(l > 100 AS INT)) FROM ls
  UNION ALL SELECT 'coverage', 'coverage', CAST((SELECT count(*) FROM ld) AS DOUBLE) / (SELECT count(*) FROM reg)
  UNION ALL SELECT 'balance', 'balance_score', round(1 - abs(CAST(sum((2 * i - k - 1) * n) AS DOUBLE) / (any_value(k) * sum(n))), 4) FROM la)
SELECT section, name, CAST(n AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS value FROM whole UNION ALL SELECT section, name, NULL, value FROM parts""",
    "progress_report": with_(smp()) + " SELECT CASE WHEN grouping(stage) = 1 THEN 'TOTAL' ELSE stage END AS stage, CASE WHEN grouping(answer) = 1 THEN 'TOTAL' ELSE answer END AS answer, count(*) AS n FROM smp GROUP BY ROLLUP (stage, answer)",
    "resume_remaining": with_(REG, smp()) + " SELECT name, count(answer) AS existing, 60 - count(answer) AS remaining FROM reg LEFT JOIN smp ON name = answer GROUP BY 1 HAVING count(answer) < 60",
    "registry_pairs": with_(REGS, PAIRS[0], paired("rp")) + FLAT,
    "keyword_overlap_pairs": with_(REGS, PAIRS[1], paired("kp")) + FLAT,
    "domain_pairs": with_(REGS, PAIRS[2], paired("dp")) + FLAT,
    "all_pairs": with_(REGS, *PAIRS, paired("rp", "kp", "dp")) + FLAT,
    "capped_pairs": with_(REGS, *PAIRS, paired("rp", "kp", "dp"), CAPPED) + " SELECT * FROM cp",
    "pair_source_counts": with_(REGS, *PAIRS, paired("rp", "kp", "dp")) + " SELECT source, count(*) AS n FROM ap GROUP BY 1",
    "confusion_matrix": with_(REGS, *PAIRS, paired("rp", "kp", "dp")) + " SELECT name, array_to_string(list_sort(list(DISTINCT o)), ',') AS neighbours FROM (SELECT agent_a AS name, agent_b AS o FROM ap UNION ALL SELECT agent_b, agent_a FROM ap) GROUP BY 1",
    "pairs_touching": with_(REGS, *PAIRS, paired("rp", "kp", "dp")) + FLAT + " WHERE agent_a IN ('Supplier#000000003', 'Supplier#000000004') OR agent_b IN ('Supplier#000000003', 'Supplier#000000004')",
    "export_jsonl": digested(js("{'question': question, 'answer': answer}")),
    "export_alpaca": digested(js(f"{{'instruction': {lit(export.INSTRUCTION)}, 'input': question, 'output': answer}}")),
    "export_sharegpt": digested(js(f"{{'system': {lit(export.INSTRUCTION)}, 'conversations': [{{'from': 'human', 'value': question}}, {{'from': 'gpt', 'value': answer}}]}}")),
    "export_openai": digested(js(f"{{'messages': [{{'role': 'system', 'content': {lit(export.INSTRUCTION)}}}, {{'role': 'user', 'content': question}}, {{'role': 'assistant', 'content': answer}}]}}")),
    "export_csv_rows": digested(f"concat({csv_field('question')}, ',', {csv_field('answer')})"),
    "cleaned_files": with_(REG, "fs AS (SELECT doc_id, text AS question, source AS answer, 'stage' || CAST(doc_id % 3 + 1 AS VARCHAR) AS stage, 'folder ' || CAST(doc_id % 7 AS VARCHAR) || '/ä.jsonl' AS src_file FROM documents)", "smp AS (SELECT row_number() OVER (ORDER BY stage, src_file, doc_id) - 1 AS seq, * FROM fs)", judged(), *CLEANED) + f"""
SELECT row_number() OVER (ORDER BY seq) - 1 AS seq, stage, src_file, md5(regexp_replace({strip('question')}, '{WS}+', ' ', 'g')) AS question_md5, {strip('answer')} AS answer FROM smp WHERE seq IN (SELECT seq FROM xk)""",
    "cleaned_in_two_runs": with_(REG, f"smp AS (SELECT doc_id % 2 * {LATER} + doc_id AS seq, text AS question, source AS answer, 'stage1' AS stage FROM documents)", judged(BOTH), *CLEANED, *gram_ctes("xk", 0.85), *GREEDY) + f"""
, r AS (SELECT seq, CASE WHEN reason <> '' THEN reason WHEN seq NOT IN (SELECT seq FROM p2) THEN {lit(clean.LOW_QUALITY)} WHEN seq NOT IN (SELECT seq FROM xk) THEN {lit(clean.EXACT_COPY)} WHEN seq IN (SELECT seq FROM gone) THEN {lit(clean.NEAR_COPY)} ELSE '' END AS reason FROM jd)
SELECT seq, reason, reason = '' AS kept FROM r""",
    "exported_array": with_(REG, smp(), QUOTA, MERGED) + f"""
, o AS (SELECT row_number() OVER (ORDER BY place, mg.seq) AS i, {js(f"{{'instruction': {lit(export.INSTRUCTION)}, 'input': question, 'output': smp.answer}}")} AS record FROM mg JOIN smp ON mg.seq = smp.seq)
SELECT CAST(0 AS BIGINT) AS seq, md5('[') AS line_md5 UNION ALL SELECT i, md5(CASE WHEN i = 1 THEN record ELSE ',' || record END) FROM o UNION ALL SELECT (SELECT count(*) + 1 FROM o), md5(']')""",
    "prompt_tasks": tasks("stage1", generate.stage1_calls(40), 5),
    "prompt_tasks_complex": tasks("stage2_complex", generate.stage2_calls(40)[1], 10, 3),
    "hard_negative_tasks": with_(REGS, *PAIRS, paired("rp", "kp", "dp"), CAPPED, bank(), "b2 AS (SELECT agent_a AS target, agent_b AS other FROM cp UNION ALL SELECT agent_b, agent_a FROM cp)") + f"""
SELECT md5(concat(least(target, other), chr(31), greatest(target, other))) AS pair_id, CAST(c AS INT) AS call, {lit(generate.SYSTEM)} AS system, {filled("text", "target", "other", 5)} AS "user", target AS expected_answer, other
FROM b2 JOIN reg ON target = name, range({generate.spare_calls(25, 5)}) AS r(c) JOIN bank ON bank.kind = 'hard_negative' AND c % bank.n = bank.i""",
    "stage3_tasks": with_(REGS, bank(), "rf AS (SELECT name, unnest(confusable) AS other FROM reg)", f"rt AS (SELECT name, other, c, CASE WHEN c % 2 = 0 THEN name ELSE other END AS target, CASE WHEN c % 2 = 0 THEN other ELSE name END AS against FROM rf, range({generate.spare_calls(25, 5)}) AS r(c) WHERE other IN (SELECT name FROM reg))") + f"""
SELECT rt.name, rt.other AS confusable, CAST(c AS INT) AS call, {lit(generate.SYSTEM)} AS system, {filled("text", "target", "against", 5)} AS "user", target AS expected_answer
FROM rt JOIN reg ON target = reg.name JOIN bank ON bank.kind = 'hard_negative' AND c % bank.n = bank.i""",
    "pairs_report": with_(REGS, *PAIRS, paired("rp", "kp", "dp")) + " SELECT count(*) AS total_pairs, (SELECT agent_a FROM ap ORDER BY overlap_score DESC, p, i, j, d LIMIT 1) AS first_a, (SELECT agent_b FROM ap ORDER BY overlap_score DESC, p, i, j, d LIMIT 1) AS first_b FROM ap",
    "length_summary": with_(smp()) + " SELECT count(*) AS n, min(length(question)) AS min_len, max(length(question)) AS max_len, CAST(floor(sum(length(question)) / count(*)) AS BIGINT) AS mean_len FROM smp",
    "labels_by_domain": with_(REGS) + " SELECT domain, string_agg(name, ',' ORDER BY idx) AS names FROM reg GROUP BY 1",
    "hard_negative_valid": with_(smp()) + f" SELECT seq FROM smp WHERE length({strip('question')}) >= 15 AND NOT contains(question, answer) AND NOT contains(question, 'src' || CAST(seq % 20 AS VARCHAR))",
    "simple_clean": with_(smp()) + f" SELECT seq FROM smp WHERE {strip('question')} <> '' AND answer = 'src3' AND length(question) BETWEEN 8 AND 5000 AND NOT contains(question, answer) AND {share('question', 'A-Za-zÀ-ÿ')} >= {num(0.7)}",
    "safe_names": "SELECT p_partkey, translate(p_name, '/\\ ', '___') AS file_name, substr(translate(p_name, '/\\ ', '___'), 1, 20) AS short_name FROM part",
}
