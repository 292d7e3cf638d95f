"""Cleaning of labelled samples (seq, question, answer): hard filter, quality score, dedup, normalisation.

All three layers are columns on the same rows: `reasons`, `score`, `exact_rank` and `kept`.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X

if TYPE_CHECKING:
    from .seen import SeenSet

# Reason keys, in the order of the checks.
NOT_OBJECT = "非字典类型"
#: Of our own: a field of a line holds a number, a list or another kind than text.
NOT_TEXT = "字段不是文本"
EMPTY_QUESTION, EMPTY_ANSWER = "question字段为空", "answer字段为空"
BAD_LABEL, SHORT, LONG = "answer不是合法智能体名称", "question过短", "question过长"
LEAK, SCRIPT, REPEATED, MEANINGLESS = "标签泄露", "中文比例过低", "重复字符比例过高", "无意义内容"
LOW_QUALITY, EXACT_COPY, NEAR_COPY = "质量分数过低", "精确重复", "近似重复"

# Patterns of the checks.
TECHNICAL = r"[A-Z]{2,}|[a-z]+\.[a-z]+|\p{Nd}+\.\p{Nd}+"
NO_MEANING = (r"^[。，、！？…]+$", r"^\[MOCK\]", r"^(测试|test|demo|示例)")
TEMPLATES = (r"^请问.*怎么", r"^如何使用.*功能", r"^我想了解.*系统", r"^帮我.*处理", r"^\[.*\]")
NATURAL = (r"[？?]\n?\z", r"[怎如何能否可以帮请]", r"[我们公司系统]")
WEIGHTS = (0.20, 0.30, 0.20, 0.15, 0.15)


@dataclass(frozen=True)
class CleanConfig:
    min_length: int = 8
    max_length: int = 500
    check_leak: bool = True
    script: str = X.CJK
    min_script_ratio: float = 0.3
    max_repeat_ratio: float = 0.3
    min_score: float = 0.6
    dedup: str = "exact"
    #: A column that exact dedup and the cap stay within; all rows if none.
    scope: str | None = None
    ngram: int = 3
    jaccard: float = 0.85
    cap: int | None = None


def hard_reasons(q: Column, a: Column, legal: Column, cfg: CleanConfig) -> Column:
    """Array of reasons; empty if the row passes. The first failing check decides."""
    n = F.length(q)
    empty = F.array_compact(F.array(F.when(q == "", EMPTY_QUESTION), F.when(a == "", EMPTY_ANSWER)))
    no_meaning = F.lit(False)
    for p in NO_MEANING:
        no_meaning = no_meaning | q.rlike(f"(?iud){p}")
    one = lambda *parts: F.array(F.concat(*parts))
    percent = lambda x: F.concat(F.format_number(100 * x, 1), F.lit("%"))
    out = F.when(F.size(empty) > 0, empty).when(~legal, one(F.lit(f"{BAD_LABEL}: "), F.substring(a, 1, 30)))
    out = out.when(n < cfg.min_length, one(F.lit(f"{SHORT}: "), n.cast("string"), F.lit(f"字符 < {cfg.min_length}")))
    out = out.when(n > cfg.max_length, one(F.lit(f"{LONG}: "), n.cast("string"), F.lit(f"字符 > {cfg.max_length}")))
    if cfg.check_leak:
        out = out.when(F.contains(q, a), one(F.lit(f"{LEAK}: "), a))
    share = X.ratio_of(q, cfg.script)
    out = out.when((n > 10) & (share < cfg.min_script_ratio) & ~q.rlike(TECHNICAL), one(F.lit(f"{SCRIPT}: "), percent(share)))
    top = X.char_ratio_over(q, cfg.max_repeat_ratio)
    out = out.when(top > cfg.max_repeat_ratio, one(F.lit(f"{REPEATED}: "), percent(top)))
    return out.when(no_meaning, F.array(F.lit(MEANINGLESS))).otherwise(F.array().cast("array<string>"))


def quality_score(q: Column, keywords: Column) -> Column:
    """The weighted score, unrounded; sums run from left to right."""
    n = F.length(q)
    length = F.when(n.between(15, 150), 1.0).when(n.between(8, 14) | n.between(151, 300), 0.7).otherwise(0.4)
    hits = F.size(F.filter(keywords, lambda k: F.contains(q, k)))
    relevance = F.when(F.size(keywords) > 0, F.least(F.lit(1.0), 0.5 + hits * F.lit(0.25))).otherwise(0.5)
    count = lambda tests: sum((F.when(t, 1).otherwise(0) for t in tests), F.lit(0))
    diversity = F.greatest(F.lit(0.3), 1.0 - count([q.rlike(f"(?d){p}") for p in TEMPLATES]) * F.lit(0.3))
    density = F.least(F.lit(1.0), F.size(F.array_distinct(X.chars(q))) / F.greatest(n * F.lit(0.5), F.lit(1.0)))
    natural = count([F.substring(q, -2, 2).rlike(NATURAL[0]), *[X.has_any(q, p[1:-1]) for p in NATURAL[1:]], ~q.rlike(f"^{X.WS}*[A-Z]")]) / F.lit(4.0)
    total = F.lit(0.0)
    for part, weight in zip((length, relevance, diversity, density, natural), WEIGHTS, strict=True):
        total = total + part * F.lit(weight)
    return total


def with_registry(samples: DataFrame, registry: DataFrame) -> DataFrame:
    """samples with keywords, domain and legal (the label is registered); a name registered twice counts once, its first row. Unhinted, Spark broadcasts a small registry."""
    r = registry.groupBy(F.col("name").alias("_name")).agg(F.min_by(F.struct("keywords", "domain"), "idx").alias("_r")).select("_name", "_r.keywords", "_r.domain")
    return samples.join(r, X.strip(F.coalesce("answer", F.lit(""))) == r["_name"], "left").withColumn("legal", F.col("_name").isNotNull()).drop("_name")


def judge(samples: DataFrame, registry: DataFrame, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """Layers 1 and 2, both narrow: reasons, score (null if layer 1 rejects) and passed2."""
    s = with_registry(samples, registry)
    q, a = F.coalesce("question", F.lit("")), F.coalesce("answer", F.lit(""))
    # columns of their own: read more than once, they are not inlined into the lambdas that use them; and a
    # fence, always true but not deterministic, that keeps filters from being pushed below with all they read
    s = s.withColumn("_q", X.strip(q)).withColumn("_a", X.strip(a))
    reasons = hard_reasons(F.col("_q"), F.col("_a"), F.col("legal"), cfg)
    if "not_text" in s.columns:
        reasons = F.when(F.col("not_text").isNotNull(), F.array(F.concat(F.lit(f"{NOT_TEXT}: "), "not_text"))).otherwise(reasons)
    if "corrupt" in s.columns:  # lines of files that hold no object
        reasons = F.when(F.col("corrupt").isNotNull(), F.array(F.lit(NOT_OBJECT))).otherwise(reasons)
    s = s.withColumn("reasons", F.when(F.monotonically_increasing_id() >= 0, reasons)).drop("_q", "_a")
    s = s.withColumn("score", F.when(F.size("reasons") == 0, quality_score(q, F.coalesce("keywords", F.array().cast("array<string>")))))
    return s.withColumn("passed2", (F.size("reasons") == 0) & (F.round("score", 4) >= cfg.min_score))


def first_of(df: DataFrame, by, order) -> DataFrame:
    """Rows that are first by `order` among those equal in `by`; the limit reaches tasks before the shuffle."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(by).orderBy(order))).filter("_r = 1").drop("_r")


def exact_dedup(samples: DataFrame, scope: str | None = None) -> DataFrame:
    """First of each question by seq, by the md5 of the raw text; scope names a column to stay within."""
    keys = [F.md5(F.coalesce("question", F.lit("")).cast("binary"))] + ([F.col(scope)] if scope else [])
    return first_of(samples, keys, "seq")


def label_cap(samples: DataFrame, most: int, *scope: str) -> DataFrame:
    """The first `most` rows of each label, by seq."""
    w = Window.partitionBy(*scope, "answer").orderBy("seq")
    return samples.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= most).drop("_r")


def normalise(samples: DataFrame) -> DataFrame:
    return samples.withColumn("question", X.collapse(F.col("question"))).withColumn("answer", X.strip(F.col("answer")))


def clean(samples: DataFrame, registry: DataFrame, cfg: CleanConfig = CleanConfig(), seen: SeenSet | None = None) -> DataFrame:
    """All rows with reason (a key, null if the row passes every layer), score and kept.

    With `seen`, rows of earlier runs count as before these: their questions are copies, and what
    resembles their accepted rows is a near copy. `seen.add` takes the result into the state.
    """
    from .near import greedy_kept, written

    # dedup and the verdicts read these rows several times; the checks are what costs
    judged = written(judge(samples, registry, cfg))
    kept = judged.filter("passed2").select("seq", "question", "answer", *[cfg.scope] * (cfg.scope is not None))
    if cfg.dedup in ("exact", "both"):
        kept = exact_dedup(kept if seen is None else seen.fresh(kept, cfg.scope), cfg.scope)
    after_exact = kept.select("seq").withColumn("_exact", F.lit(True))
    if cfg.dedup in ("ngram", "both"):
        # accepted rows of earlier runs resemble none before them, so they stay accepted, whatever their order
        before = [] if seen is None else [seen.accepted()]
        kept = written(functools.reduce(lambda a, b: a.unionByName(b), before, kept.select("seq", "question", "answer")))
        kept = greedy_kept(kept, cfg.ngram, cfg.jaccard)
        kept = kept.filter(F.col("seq") >= 0) if before else kept
    final = kept.select("seq").withColumn("_kept", F.lit(True))
    out = judged.join(after_exact, "seq", "left").join(final, "seq", "left")
    key = F.when(F.size("reasons") > 0, F.substring_index(F.get("reasons", F.lit(0)), ":", 1)).when(~F.col("passed2"), LOW_QUALITY)
    key = key.when(F.col("_exact").isNull(), EXACT_COPY).when(F.col("_kept").isNull(), NEAR_COPY)
    out = out.withColumn("reason", key).withColumn("kept", F.col("_kept").isNotNull()).drop("_exact", "_kept", "passed2", "legal")
    if cfg.cap is not None:
        w = Window.partitionBy("answer", *[cfg.scope] * (cfg.scope is not None)).orderBy(~F.col("kept"), "seq")
        out = out.withColumn("written", F.col("kept") & (F.row_number().over(w) <= cfg.cap))
    return out


def reason_histogram(judged: DataFrame) -> DataFrame:
    return judged.select(F.explode("reasons").alias("r")).groupBy(F.substring_index("r", ":", 1).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def clean_stats(cleaned: DataFrame) -> DataFrame:
    """One row: total, passed, rejected by layer, pass rate."""
    is_ = lambda *keys: F.count_if(F.coalesce(F.col("reason").isin(*keys), F.lit(False)))
    s = cleaned.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("kept").alias("passed"), F.count_if(F.size("reasons") > 0).alias("rejected_hard"),
        is_(LOW_QUALITY).alias("rejected_quality"), is_(EXACT_COPY, NEAR_COPY).alias("rejected_dedup"),
    )
    return s.withColumn("pass_rate", F.when(F.col("total") > 0, F.col("passed") / F.col("total")).otherwise(0.0))


def file_stats(cleaned: DataFrame, *by: str) -> DataFrame:
    """(input, passed, pass_rate) of each file, by the columns given."""
    n = cleaned.groupBy(*by).agg(F.count(F.lit(1)).alias("n_input"), F.count_if("kept").alias("n_passed"))
    return n.withColumn("pass_rate", F.col("n_passed") / F.col("n_input"))


def simple_clean(samples: DataFrame, min_ratio: float = 0.2, low: int = 8, high: int = 500, script: str = X.CJK) -> DataFrame:
    """The short form of the cleaner for rows of one expected label (a column `expected`)."""
    q, a = F.col("question"), F.col("answer")
    return samples.filter((X.strip(q) != "") & (a == F.col("expected")) & F.length(q).between(low, high) & ~F.contains(q, a) & (X.ratio_of(q, script) >= min_ratio))


def valid_hard_negative(q: Column, a: Column, target: Column, confusable: Column, low: int = 15) -> Column:
    return (X.strip(a) == target) & (F.length(X.strip(q)) >= low) & ~F.contains(q, target) & ~F.contains(q, confusable)
