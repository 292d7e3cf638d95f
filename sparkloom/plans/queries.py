"""Queries of the curation operators over the driver's tables, whole tables each.

`documents` serves as samples: seq is doc_id, question the text, answer the source, stage by doc_id.
The registry is made by a rule, from which the SQL side is made as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import run
from ..functions import text as X
from ..operators import analyze, clean, export, generate, merge, near, pairs
from ..operators.seen import SeenSet
from ..sources import jsonl
from ..sources import registry as R

LABELS = 25
# Words that serve as keywords.
WORDS = ("the", "und", "que", "les", "tion", "ich", "ing", "ción", "eux", "zeichen")


def registry_rows() -> list[dict]:
    """Labels src0 to src24: five domains, three to five keywords, two confusable labels of which one may not exist."""
    rows = []
    for i in range(LABELS):
        words = list(dict.fromkeys(WORDS[(i * k + k) % len(WORDS)] for k in (1, 2, 3, 7)))
        rows.append({"name": f"src{i}", "domain": f"domain{i % 5}", "description": f"label {i}", "keywords": words, "confusable": [f"src{(3 * i + 1) % (LABELS + 1)}", f"src{(i + 7) % LABELS}"]})
    return rows


def registry(spark: SparkSession) -> DataFrame:
    return R.from_rows(spark, registry_rows())


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as a label registry that grows with the table: ten of a domain, keywords that a hundred share at most, names of two others, of which one may not exist."""
    t = spark.read.parquet(f"{sf_dir}/supplier.parquet").withColumn("k", F.col("s_suppkey"))
    text = lambda c: F.floor(c).cast("long").cast("string")
    block = text(F.col("k") / 100)
    name = lambda k: F.concat(F.lit("Supplier#"), F.lpad(k.cast("string"), 9, "0"))
    words = [F.concat(F.lit("nation"), F.col("s_nationkey").cast("string"), F.lit("/"), block), F.concat(F.lit("balance"), text(F.col("s_acctbal") / 1000), F.lit("/"), block), F.concat(F.lit("block"), text(F.col("k") / 25))]
    return t.select(
        F.col("k").cast("int").alias("idx"), F.col("s_name").alias("name"), F.concat(F.lit("domain"), text(F.col("k") / 10)).alias("domain"), F.concat(F.col("s_name"), F.lit(" of nation "), F.col("s_nationkey").cast("string")).alias("description"),
        F.array(*words).alias("keywords"), F.array(name(F.col("k") + 7), name(2 * F.col("k") + 1)).alias("confusable"),
    )


def samples(spark: SparkSession, sf_dir: str, label: str = "source") -> DataFrame:
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return d.select(F.col("doc_id").alias("seq"), F.col("text").alias("question"), F.col(label).alias("answer"), F.concat(F.lit("stage"), (F.col("doc_id") % 3 + 1).cast("string")).alias("stage"))


#: Samples that meet every check: fields that are null, blank, short, leak, mean nothing and so on, then near and exact copies.
#: One text for both engines; rows have seq, question, answer, stage.
MUTATED = """
SELECT seq, stage,
  CASE seq % 17 WHEN 1 THEN NULL WHEN 2 THEN '   ' WHEN 3 THEN 'abc' WHEN 4 THEN 'see ' || answer || ': ' || question WHEN 5 THEN '[MOCK] ' || question
    WHEN 6 THEN repeat('ab', 30) WHEN 7 THEN '1234567 890123 456' WHEN 8 THEN 'Test: ' || question ELSE question END AS question,
  CASE seq % 17 WHEN 10 THEN NULL WHEN 11 THEN '  ' WHEN 12 THEN 'nolabel' ELSE answer END AS answer
FROM plain
"""
COPIES = """
SELECT seq, stage, question, answer FROM changed
UNION ALL SELECT seq + 100000000, stage, question || ' end', answer FROM changed WHERE seq % 5 = 0
UNION ALL SELECT seq + 200000000, stage, question, answer FROM changed WHERE seq % 7 = 0
"""


def mutated(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = spark.sql(MUTATED.replace("FROM plain", "FROM {plain}"), plain=samples(spark, sf_dir))
    return spark.sql(COPIES.replace("FROM changed", "FROM {changed}"), changed=changed)


CONFIG = clean.CleanConfig(max_length=5000, script="A-Za-zÀ-ÿ", min_script_ratio=0.7, min_score=0.55)
BOTH = clean.CleanConfig(max_length=5000, script="A-Za-zÀ-ÿ", min_script_ratio=0.7, min_score=0.55, dedup="both", cap=20)
TARGET, MIX = 40, (0.15, 0.70, 0.15)

Q: dict = {}


def query(f):
    Q[f.__name__] = f
    return f


@query
def hard_filter_reasons(s, d):
    return clean.reason_histogram(clean.judge(samples(s, d), registry(s), CONFIG))


@query
def hard_filter_rows(s, d):
    j = clean.judge(samples(s, d), registry(s), CONFIG)
    return j.select("seq", F.coalesce(F.substring_index(F.get("reasons", F.lit(0)), ":", 1), F.lit("")).alias("reason"))


@query
def hard_filter_mutated(s, d):
    return clean.reason_histogram(clean.judge(mutated(s, d), registry(s), CONFIG))


@query
def clean_pipeline_mutated(s, d):
    c = clean.clean(mutated(s, d), registry(s), BOTH)
    return c.select("seq", F.coalesce("reason", F.lit("")).alias("reason"), "kept", "written")


@query
def exact_dedup_mutated(s, d):
    return clean.exact_dedup(mutated(s, d)).select("seq")


@query
def file_stats_mutated(s, d):
    return clean.file_stats(clean.clean(mutated(s, d), registry(s), BOTH), "stage").withColumn("pass_rate", F.round("pass_rate", 6))


@query
def quality_scores(s, d):
    j = clean.with_registry(samples(s, d), registry(s))
    return j.select("seq", clean.quality_score(F.coalesce("question", F.lit("")), F.coalesce("keywords", F.array().cast("array<string>"))).alias("score"))


@query
def exact_dedup(s, d):
    return clean.exact_dedup(samples(s, d)).select("seq")


@query
def exact_dedup_by_stage(s, d):
    return clean.exact_dedup(samples(s, d), "stage").select("seq", "stage")


@query
def label_cap(s, d):
    return clean.label_cap(samples(s, d), 7, "stage").select("seq", "stage", "answer")


@query
def normalised(s, d):
    n = clean.normalise(samples(s, d))
    return n.select("seq", F.md5(F.col("question").cast("binary")).alias("question_md5"), F.length("question").cast("long").alias("n"))


@query
def ngram_counts(s, d):
    g = near.gram_counts(samples(s, d, "lang"))
    return g.select("seq", "label", F.col("size").cast("long").alias("n_grams"))


@query
def ngram_near_dup_pairs(s, d):
    return near.near_pairs(samples(s, d, "lang"), 3, 0.85)


@query
def ngram_greedy_dedup(s, d):
    return near.greedy_kept(samples(s, d, "lang"), 3, 0.85).select("seq")


@query
def clean_pipeline(s, d):
    c = clean.clean(samples(s, d), registry(s), BOTH)
    return c.select("seq", F.coalesce("reason", F.lit("")).alias("reason"), "kept", "written")


@query
def clean_stats(s, d):
    return clean.clean_stats(clean.clean(samples(s, d), registry(s), CONFIG))


@query
def quota_merge(s, d):
    return merge.merge(samples(s, d), registry(s), TARGET, MIX).select("seq", "answer", "stage", "place")


@query
def merge_limited(s, d):
    return merge.merge(samples(s, d), registry(s), TARGET, MIX, max_total=100).select("seq", "place")


@query
def merge_stage_stats(s, d):
    return merge.stage_stats(merge.quota_sample(samples(s, d), registry(s), TARGET, MIX), registry(s))


@query
def stratified_split(s, d):
    return merge.stratified_split(samples(s, d)).select("seq", "split")


@query
def random_split(s, d):
    return merge.random_split(samples(s, d)).select("seq", "split")


@query
def split_sizes(s, d):
    return merge.split_sizes(merge.stratified_split(samples(s, d)))


@query
def label_distribution(s, d):
    return analyze.label_distribution(samples(s, d))


@query
def label_stats(s, d):
    return analyze.label_stats(samples(s, d))


@query
def length_stats(s, d):
    return analyze.length_stats(samples(s, d))


@query
def length_histogram(s, d):
    return analyze.length_histogram(samples(s, d))


@query
def domain_distribution(s, d):
    return analyze.domain_distribution(samples(s, d), registry(s))


@query
def coverage(s, d):
    return analyze.coverage(samples(s, d), registry(s))


@query
def missing_labels(s, d):
    return analyze.missing_labels(samples(s, d), registry(s))


@query
def balance_score(s, d):
    return analyze.balance_score(clean.exact_dedup(samples(s, d)))


@query
def dataset_report(s, d):
    """All figures of the report, from one scan of the documents."""
    return analyze.report_rows(samples(s, d), registry(s))


@query
def progress_report(s, d):
    return analyze.progress(samples(s, d))


@query
def resume_remaining(s, d):
    return analyze.remaining(samples(s, d), registry(s), 60)


def _flat(p: DataFrame) -> DataFrame:
    return p.select("agent_a", "agent_b", "source", "overlap_score", F.array_join("shared_keywords", ",").alias("shared_keywords"))


@query
def registry_pairs(s, d):
    return _flat(pairs.registry_pairs(suppliers(s, d)))


@query
def keyword_overlap_pairs(s, d):
    return _flat(pairs.keyword_pairs(suppliers(s, d), 0.3))


@query
def domain_pairs(s, d):
    return _flat(pairs.domain_pairs(suppliers(s, d)))


@query
def all_pairs(s, d):
    return _flat(pairs.all_pairs(suppliers(s, d), 0.3))


@query
def capped_pairs(s, d):
    return pairs.capped_pairs(pairs.all_pairs(suppliers(s, d), 0.3), 5).select("agent_a", "agent_b", "place")


@query
def pair_source_counts(s, d):
    return pairs.all_pairs(suppliers(s, d), 0.3).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query
def confusion_matrix(s, d):
    m = pairs.confusion_matrix(pairs.all_pairs(suppliers(s, d), 0.3))
    return m.select("name", F.array_join("neighbours", ",").alias("neighbours"))


@query
def pairs_touching(s, d):
    return _flat(pairs.touching(pairs.all_pairs(suppliers(s, d), 0.3), ["Supplier#000000003", "Supplier#000000004"]))


def _digested(df: DataFrame) -> DataFrame:
    return df.select("seq", F.length("record").cast("long").alias("n"), F.md5(F.col("record").cast("binary")).alias("record_md5"))


@query
def export_jsonl(s, d):
    return _digested(export.jsonl(samples(s, d)))


@query
def export_alpaca(s, d):
    return _digested(export.alpaca(samples(s, d)))


@query
def export_sharegpt(s, d):
    return _digested(export.sharegpt(samples(s, d)))


@query
def export_openai(s, d):
    return _digested(export.openai_chat(samples(s, d)))


@query
def export_csv_rows(s, d):
    return _digested(export.csv_rows(samples(s, d)))


@query
def cleaned_files(s, d):
    """Documents as files of JSON lines in three stages, seven files each under one name, cleaned into files and read back in order."""
    root = near.shared_path(s, "files")
    docs = samples(s, d).withColumn("src_file", F.concat(F.lit("folder "), (F.col("seq") % 7).cast("string"), F.lit("/ä.jsonl")))
    for k in run.STAGES:
        jsonl.write_jsonl(docs.filter(F.col("stage") == k), f"{root}/raw/{k}", by="src_file", order=["seq"])
    run.clean_folders(s, f"{root}/raw", f"{root}/clean", registry(s), CONFIG)
    c = run.read_clean(s, f"{root}/clean")
    return c.select("seq", "stage", "src_file", F.md5(F.col("question").cast("binary")).alias("question_md5"), "answer")


LATER = 1_000_000_000


@query
def cleaned_in_two_runs(s, d):
    """Documents of even ids in one run, the others in a later one that goes on from its state."""
    docs = samples(s, d).withColumn("seq", F.col("seq") % 2 * LATER + F.col("seq"))
    path, runs = near.shared_path(s, "seen"), []
    for part in (docs.filter(F.col("seq") < LATER), docs.filter(F.col("seq") >= LATER)):
        seen = SeenSet(s, path)
        runs.append(near.written(clean.clean(part, registry(s), BOTH, seen)))
        seen.add(runs[-1])
    return runs[0].unionByName(runs[1]).select("seq", F.coalesce("reason", F.lit("")).alias("reason"), "kept")


@query
def exported_array(s, d):
    """The lines of a JSON array of merged rows, in the order that its parts hold them."""
    path = f"{near.shared_path(s, 'files')}/array"
    export.write_array(merge.merge(samples(s, d), registry(s), TARGET, MIX), "alpaca", path)
    lines = s.read.text(path).withColumns({"_path": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start")}).withColumn("_row", F.monotonically_increasing_id())
    return jsonl.with_seq(lines).select("seq", F.md5(F.col("value").cast("binary")).alias("line_md5"))


@query
def prompt_tasks(s, d):
    return generate.prompt_tasks(suppliers(s, d), generate.templates(s), "stage1", generate.stage1_calls(40), 5)


@query
def prompt_tasks_complex(s, d):
    return generate.prompt_tasks(suppliers(s, d), generate.templates(s), "stage2_complex", generate.stage2_calls(40)[1], 10, start=3)


@query
def hard_negative_tasks(s, d):
    chosen = pairs.capped_pairs(pairs.all_pairs(suppliers(s, d), 0.3), 5)
    return generate.hard_negative_tasks(chosen, suppliers(s, d), generate.templates(s), generate.spare_calls(25, 5))


@query
def stage3_tasks(s, d):
    return generate.stage3_tasks(suppliers(s, d), generate.templates(s), 25)


@query
def pairs_report(s, d):
    return pairs.pairs_report(pairs.all_pairs(suppliers(s, d), 0.3)).select(F.get_json_object("report", "$.total_pairs").cast("long").alias("total_pairs"), F.get_json_object("report", "$.pairs[0].agent_a").alias("first_a"), F.get_json_object("report", "$.pairs[0].agent_b").alias("first_b"))


@query
def length_summary(s, d):
    return analyze.length_summary(samples(s, d))


@query
def labels_by_domain(s, d):
    return analyze.by_domain(suppliers(s, d)).select("domain", F.array_join("names", ",").alias("names"))


@query
def hard_negative_valid(s, d):
    r = samples(s, d).withColumn("other", F.concat(F.lit("src"), (F.col("seq") % 20).cast("string")))
    return r.filter(clean.valid_hard_negative(F.col("question"), F.col("answer"), F.col("answer"), F.col("other"))).select("seq")


@query
def simple_clean(s, d):
    return clean.simple_clean(samples(s, d).withColumn("expected", F.lit("src3")), 0.7, 8, 5000, "A-Za-zÀ-ÿ").select("seq")


@query
def extract_json(s, d):
    """Conversations as responses: each turn inside a fenced block, amid prose, or bare, by turn."""
    c = s.read.parquet(f"{d}/conversations.parquet").select("conv_id", F.lit("label").alias("expected_answer"), "turn", F.to_json(F.struct(F.col("text").alias("question"), F.lit("a label").alias("answer"))).alias("item"))
    fence = F.concat(F.lit("text\n```json\n["), "item", F.lit("]\n```"))
    raw = F.when(F.col("turn") % 3 == 0, fence).when(F.col("turn") % 3 == 1, F.concat(F.lit("so: ["), "item", F.lit("] done"))).otherwise(F.col("item"))
    return generate.extracted(c.select("conv_id", "turn", "expected_answer", raw.alias("raw_text"))).select("conv_id", "turn", "question", "answer")


@query
def generated_offline(s, d):
    tasks = generate.prompt_tasks(suppliers(s, d), generate.templates(s), "stage1", generate.stage1_calls(40), 5)
    return generate.generated(generate.respond(tasks), 40)


@query
def response_stats(s, d):
    tasks = generate.prompt_tasks(suppliers(s, d), generate.templates(s), "stage1", generate.stage1_calls(40), 5)
    return generate.response_stats(generate.respond(tasks))


@query
def batch_prompts(s, d):
    return generate.batch_prompts(suppliers(s, d), 3)


@query
def registry_subset(s, d):
    return R.subset(suppliers(s, d), ["Supplier#000000007", "Supplier#000000003", "none"]).select("idx", "name")


@query
def hard_negatives_offline(s, d):
    tasks = generate.pair_tasks(pairs.capped_pairs(pairs.all_pairs(suppliers(s, d), 0.3), 5), suppliers(s, d), generate.templates(s), generate.spare_calls(25, 5))
    made = generate.hard_negatives(generate.respond(tasks), tasks, 25)
    return made.groupBy("pair", "answer").agg(F.count(F.lit(1)).alias("n"))


@query
def safe_names(s, d):
    p = s.read.parquet(f"{d}/part.parquet")
    return p.select("p_partkey", X.safe_name(F.col("p_name")).alias("file_name"), X.safe_name(F.col("p_name"), 20).alias("short_name"))


def queries() -> dict:
    return dict(Q)
