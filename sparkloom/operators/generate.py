"""Generation of samples: prompt tasks, a provider, JSON extraction, hard negatives.

Tasks are rows; a provider turns them into responses inside mapInPandas, so the partition count
bounds how many calls run at once. The default provider is offline and deterministic.
"""

from __future__ import annotations

import json
import math
import re
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from ..functions import text as X
from .clean import valid_hard_negative
from .order import shuffled

RESPONSE = "task_idx long, expected_answer string, raw_text string, parsed_items array<struct<question:string,answer:string>>, prompt_tokens int, completion_tokens int, latency_ms double, model string, error string"
COLUMNS = ["expected_answer", "raw_text", "parsed_items", "prompt_tokens", "completion_tokens", "latency_ms", "model", "error"]

# Templates of our own; callers bring theirs as rows (kind, idx, text). Slots: {name} {description} {keywords} {other} {count}.
TEMPLATES = {
    "stage1": [
        "为智能体「{name}」（{description}）写{count}条用户问题，关键词：{keywords}。输出JSON数组，每项含question与answer，answer为{name}。",
        "假设用户需要「{name}」。{description}。请给出{count}个不出现该名称的提问，可用词：{keywords}。以JSON数组输出question与answer。",
        "围绕{keywords}提出{count}个应由「{name}」回答的问题，JSON数组，字段question、answer。",
    ],
    "simple": ["写{count}条简短问题，应由「{name}」处理。关键词：{keywords}。JSON数组输出。", "「{name}」的用户会怎样简单提问？给{count}条，JSON数组输出。"],
    "colloquial": ["用口语写{count}条找「{name}」办事的话，JSON数组输出。", "像聊天那样给{count}条需要「{name}」的请求，JSON数组输出。"],
    "complex": ["写{count}条背景较长的问题，最终应由「{name}」处理。{description}。JSON数组输出。", "给{count}条含多个条件的需求，答案为「{name}」。JSON数组输出。"],
    "multiturn": ["写{count}条多轮对话的最后一问，省略前文，仍应由「{name}」回答。JSON数组输出。"],
    "implicit": ["写{count}条只暗示需要「{name}」而不点明的话，线索：{keywords}。JSON数组输出。"],
    "hard_negative": [
        "写{count}条容易误判为「{other}」、实际应由「{name}」处理的问题，两个名称都不出现。JSON数组输出。",
        "「{name}」与「{other}」词汇相近。给{count}条只有「{name}」能处理的问题。JSON数组输出。",
        "从「{other}」的场景出发，写{count}条其实属于「{name}」的需求。JSON数组输出。",
        "写{count}条同时提到两者关键词、意图在「{name}」的问题，关键词：{keywords}。JSON数组输出。",
        "写{count}条边界上的问题，仔细想后应选「{name}」而非「{other}」。JSON数组输出。",
    ],
}
#: Ways to ask for other wordings, for batch prompts.
DIVERSITY = (
    "换一种语气", "从新手的角度提问", "从专家的角度提问", "加入时间或地点", "只描述现象而不提需求",
    "写得更短", "写得更长", "用反问句", "包含一个数字或单位", "带上紧急程度",
)
COMPLEX = ("colloquial", "complex", "multiturn", "implicit")
SYSTEM = "你为智能体路由构造训练数据，只输出JSON。"


def templates(spark: SparkSession, bank: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    return spark.createDataFrame([(k, i, t, len(ts)) for k, ts in bank.items() for i, t in enumerate(ts)], "kind string, idx int, text string, n int")


def stage1_calls(target: int, batch: int = 5) -> int:
    """A fifth more calls than the target needs, and one."""
    needed = math.ceil(target / batch)
    return max(needed, int(needed * 1.2) + 1)


def spare_calls(target: int, batch: int) -> int:
    """Three tenths more calls than the target needs, and one: stages 2 and 3."""
    return math.ceil(target / batch * 1.3) + 1


def stage2_calls(target: int, batch: int = 10, simple: float = 0.4) -> tuple[int, int]:
    """Calls for simple and for complex prompts."""
    plain = int(target * simple)
    return spare_calls(plain, batch), spare_calls(target - plain, batch)


def filled(template, name, description, keywords, other, count):
    out = template
    for slot, value in (("name", name), ("description", description), ("keywords", F.array_join(keywords, "、")), ("other", other), ("count", count.cast("string"))):
        out = F.replace(out, F.lit("{" + slot + "}"), F.coalesce(value, F.lit("")))
    return out


#: Bits of a task's number for its call, and the place of each kind of task beyond the label's.
CALL_BITS, KINDS = 20, ("stage1", "simple", "stage2_complex")


def prompt_tasks(registry: DataFrame, bank: DataFrame, kind: str, n_calls: int, count: int = 5, start: int = 0) -> DataFrame:
    """n_calls tasks a label: (task_idx, kind, system, user, expected_answer); templates rotate with the call.

    Kind `stage2_complex` rotates through the four complex kinds. task_idx is one number for each
    (kind, label, call), in this order, so tasks of several kinds can be put together.
    """
    t = registry.select("idx", "name", "description", "keywords", F.explode(F.sequence(F.lit(0), F.lit(n_calls - 1))).alias("i")) if n_calls > 0 else registry.select("idx", "name", "description", "keywords", F.lit(0).alias("i")).limit(0)
    at = F.col("i") + start
    which = F.element_at(F.array(*map(F.lit, COMPLEX)), (at % len(COMPLEX) + 1).cast("int")) if kind == "stage2_complex" else F.lit(kind)
    t = t.withColumn("kind", which).withColumn("_at", at)
    b = bank.select(F.col("kind").alias("_kind"), F.col("idx").alias("_i"), "text", "n")
    t = t.join(b, (F.col("kind") == F.col("_kind")) & (F.col("_at") % F.col("n") == F.col("_i")))
    user = filled(F.col("text"), F.col("name"), F.col("description"), F.col("keywords"), F.lit(""), F.lit(count))
    first = (KINDS.index(kind) if kind in KINDS else len(KINDS)) << (CALL_BITS + 31)
    return t.select((F.lit(first) + F.col("idx").cast("long") * (1 << CALL_BITS) + F.col("i")).alias("task_idx"), "kind", F.lit(SYSTEM).alias("system"), user.alias("user"), F.col("name").alias("expected_answer"))


def batch_prompts(registry: DataFrame, count: int, style: str = "", extra: str = "") -> DataFrame:
    """(expected_answer, system, user): one prompt a label that asks for `count` items at once, each with another of the DIVERSITY hints."""
    hints = "；".join(DIVERSITY[:count])
    template = f"为智能体「{{name}}」（{{description}}）写{{count}}条用户问题，关键词：{{keywords}}。{style}{extra}各条依次：{hints}。输出JSON数组，每项含question与answer。"
    user = filled(F.lit(template), F.col("name"), F.col("description"), F.col("keywords"), F.lit(""), F.lit(count))
    return registry.select(F.col("name").alias("expected_answer"), F.lit(SYSTEM).alias("system"), user.alias("user"))


def hard_negative_tasks(pairs: DataFrame, registry: DataFrame, bank: DataFrame, n_calls: int, count: int = 5) -> DataFrame:
    """Tasks of both directions of each pair; the five strategies rotate with the call. Calls are bounded by n_calls."""
    both = pairs.select(F.col("agent_a").alias("target"), F.col("agent_b").alias("other")).unionByName(pairs.select(F.col("agent_b").alias("target"), F.col("agent_a").alias("other")))
    t = both.join(shuffled(registry.select(F.col("name").alias("target"), "description", "keywords")), "target").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n_calls - 1))))
    b = bank.filter("kind = 'hard_negative'").select(F.col("idx").alias("_i"), "text", "n")
    t = t.join(b, F.col("i") % F.col("n") == F.col("_i"))
    user = filled(F.col("text"), F.col("target"), F.col("description"), F.col("keywords"), F.col("other"), F.lit(count))
    pair = F.md5(F.concat_ws("\x1f", F.least("target", "other"), F.greatest("target", "other")).cast("binary"))
    return t.select(pair.alias("pair_id"), F.col("i").alias("call"), F.lit(SYSTEM).alias("system"), user.alias("user"), F.col("target").alias("expected_answer"), "other")


def stage3_tasks(registry: DataFrame, bank: DataFrame, per_pair: int, batch: int = 5) -> DataFrame:
    """Tasks of each label with each confusable name that is a label; calls alternate between aiming at it and at the other."""
    n = spare_calls(per_pair, batch)
    refs = registry.select("idx", "name", F.posexplode("confusable").alias("k", "other"))
    both = refs.join(shuffled(registry.select(F.col("name").alias("other"))), "other").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    aims = F.col("i") % 2 == 0
    both = both.withColumn("target", F.when(aims, F.col("name")).otherwise(F.col("other"))).withColumn("against", F.when(aims, F.col("other")).otherwise(F.col("name")))
    t = both.join(shuffled(registry.select(F.col("name").alias("target"), "description", "keywords")), "target")
    b = bank.filter("kind = 'hard_negative'").select(F.col("idx").alias("_i"), "text", F.col("n").alias("_n"))
    t = t.join(b, F.col("i") % F.col("_n") == F.col("_i"))
    user = filled(F.col("text"), F.col("target"), F.col("description"), F.col("keywords"), F.col("against"), F.lit(batch))
    return t.select("name", F.col("other").alias("confusable"), F.col("i").alias("call"), F.lit(SYSTEM).alias("system"), user.alias("user"), F.col("target").alias("expected_answer"))


# Where JSON may hide in a response.
FENCE = re.compile(r"```(?:json)?\s*(.*?)\s*```", re.DOTALL)
ARRAY = re.compile(r"\[\s*\{.*?\}\s*(?:,\s*\{.*?\}\s*)*\]", re.DOTALL)
OBJECT = re.compile(r'\{[^{}]*"question"\s*:\s*"[^"]*"[^{}]*"answer"\s*:\s*"[^"]*"[^{}]*\}', re.DOTALL)
SHORTEST, LONGEST = 5, 500


def valid_item(item, expected: str) -> tuple[str, str] | None:
    """The stripped (question, answer) of a usable item. An answer that holds the expected one is cut down to it."""
    if not isinstance(item, dict):
        return None
    q, a = item.get("question"), item.get("answer")
    if not (isinstance(q, str) and isinstance(a, str)):
        return None
    q, a = q.strip(), a.strip()
    if expected and expected in a:
        a = expected
    usable = q and a and (not expected or a == expected) and a not in q and SHORTEST <= len(q) <= LONGEST
    return (q, a) if usable else None


def _items(text: str, expected: str) -> list[tuple[str, str]]:
    try:
        data = json.loads(text)
    except ValueError:
        return []
    return [v for x in (data if isinstance(data, list) else [data]) if (v := valid_item(x, expected))]


def extract(text: str | None, expected: str = "") -> list[tuple[str, str]]:
    """Items of the first place that yields any: fenced blocks, all of it, arrays, objects, lines."""
    text = text or ""
    lines = (line.strip().rstrip(",") for line in text.split("\n"))
    places = (
        FENCE.findall(text),
        [text.strip()],
        (m.group() for m in ARRAY.finditer(text)),
        (m.group() for m in OBJECT.finditer(text)),
        (x for x in lines if x.startswith("{") and x.endswith("}")),
    )
    for parts in places:
        if found := [item for p in parts for item in _items(p, expected)]:
            return found
    return []


def extract_loose(text: str | None) -> list[dict]:
    """Items of the first array in a response, or the objects in it one by one, as they are: nothing is validated."""
    text = text or ""
    decoder, out, at = json.JSONDecoder(), [], 0
    while at < len(text):
        starts = [k for k in (text.find("[", at), text.find("{", at)) if k >= 0]
        if not starts:
            break
        try:
            value, at = decoder.raw_decode(text, min(starts))
        except ValueError:
            at = min(starts) + 1
            continue
        if isinstance(value, list) and any(isinstance(x, dict) for x in value):
            return [x for x in value if isinstance(x, dict)]
        if isinstance(value, dict):
            out.append(value)
    return out


@udtf(returnType="question string, answer string")
class ExtractItems:
    """SELECT ... FROM t, LATERAL extract_items(raw_text, expected_answer)."""

    def eval(self, text: str, expected: str):
        yield from extract(text, expected or "")


def extracted(responses: DataFrame, text: str = "raw_text", expected: str = "expected_answer") -> DataFrame:
    """responses with question and answer, one row an item."""
    found = ExtractItems(F.col(text).outer(), F.col(expected).outer())
    return responses.lateralJoin(found)


@dataclass(frozen=True)
class Reply:
    text: str
    prompt_tokens: int = 0
    completion_tokens: int = 0
    model: str = ""


def offline(system: str, user: str, expected: str) -> Reply:
    """A stand-in for a model: three fixed questions about the label."""
    items = [{"question": f"[MOCK] {q}", "answer": expected} for q in ("这个问题该怎么处理？", "请帮我看看当前的情况。", "我们需要尽快给出方案。")]
    return Reply(json.dumps(items, ensure_ascii=False), 100, 50, "offline")


def respond(tasks: DataFrame, provider: Callable[[str, str, str], Reply] = offline, retries: int = 3, delay: float = 2.0, parts: int | None = None, key: str = "task_idx", at_once: int = 1) -> DataFrame:
    """Responses of tasks; a call is tried up to `retries` times, waiting delay, 2 delay, ... in between.

    Each of `parts` partitions makes `at_once` calls at a time; responses carry their task's key.
    """

    def call(system, user, expected):
        began, error = time.time(), None
        for attempt in range(retries):
            try:
                r = provider(system, user, expected)
                items = [{"question": q, "answer": a} for q, a in extract(r.text, expected)]
                return r.text, items, r.prompt_tokens, r.completion_tokens, (time.time() - began) * 1000, r.model, None
            except Exception as e:  # noqa: BLE001  a provider's failure is a row's error, not the job's
                error = str(e)
                if attempt + 1 < retries:
                    time.sleep(delay * (attempt + 1))
        return None, [], 0, 0, (time.time() - began) * 1000, None, error

    def run(batches):
        from concurrent.futures import ThreadPoolExecutor

        import pandas as pd

        with ThreadPoolExecutor(at_once) as pool:
            for pdf in batches:
                got = pool.map(call, pdf["system"], pdf["user"], pdf["expected_answer"])
                rows = [(k, e, *r) for k, e, r in zip(pdf[key], pdf["expected_answer"], got, strict=True)]
                yield pd.DataFrame(rows, columns=[key, *COLUMNS])

    t = tasks.repartition(parts) if parts else tasks
    return t.select(key, "system", "user", "expected_answer").mapInPandas(run, RESPONSE.replace("task_idx", key, 1))


def generated(responses: DataFrame, target: int, key: str = "task_idx", existing: DataFrame | None = None) -> DataFrame:
    """(question, answer): items of successful responses in order of call, the first `target` a label.

    existing, (answer, n), has what labels hold already: they get what is missing.
    """
    rows = responses.filter(F.col("error").isNull()).select(key, F.posexplode("parsed_items").alias("k", "item")).select(key, "k", "item.question", "item.answer")
    return _missing(rows, target, existing, ["answer"], key).select("question", "answer")


def _missing(rows: DataFrame, target: int, existing: DataFrame | None, by: list[str], key: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(key, "k")
    rows = rows.withColumn("_r", F.row_number().over(w))
    if existing is not None:
        rows = rows.join(existing.select(*by, F.col("n").alias("_n")), by, "left")
        return rows.filter(F.col("_r") <= target - F.coalesce("_n", F.lit(0)))
    return rows.filter(F.col("_r") <= target)


def pair_tasks(pairs: DataFrame, registry: DataFrame, bank: DataFrame, n_calls: int, count: int = 5) -> DataFrame:
    """hard_negative_tasks with task_idx and `pair`, the name of the pair's file."""
    t = hard_negative_tasks(pairs, registry, bank, n_calls, count)
    short = lambda c: X.safe_name(c, 20)
    name = F.concat(short(F.least("expected_answer", "other")), F.lit("_vs_"), short(F.greatest("expected_answer", "other")), F.lit("_"), F.substring("pair_id", 1, 8))
    return t.withColumn("task_idx", F.xxhash64("pair_id", "expected_answer", "call")).withColumn("pair", name)


def hard_negatives(responses: DataFrame, tasks: DataFrame, target: int, existing: DataFrame | None = None) -> DataFrame:
    """(question, answer, pair): valid items of each pair and direction, the first `target` by call.

    An item is valid if its answer is the task's, and its question long enough and without either
    name. existing, (pair, answer, n), has what pairs hold already.
    """
    of = tasks.select("task_idx", "pair", "call", "other", F.col("expected_answer").alias("target"))
    rows = responses.filter(F.col("error").isNull()).select("task_idx", F.posexplode("parsed_items").alias("k", "item")).join(shuffled(of), "task_idx")
    rows = rows.filter(valid_hard_negative(F.col("item.question"), F.col("item.answer"), F.col("target"), F.col("other")))
    rows = rows.select("call", "k", "item.question", F.col("target").alias("answer"), "pair")
    return _missing(rows, target, existing, ["pair", "answer"], "call").select("question", "answer", "pair")


def response_stats(responses: DataFrame) -> DataFrame:
    """One row: calls, successes, failures, items, tokens and success rate."""
    ok = F.col("error").isNull() & (F.size("parsed_items") > 0)
    return responses.agg(
        F.count(F.lit(1)).alias("calls"), F.count_if(ok).alias("succeeded"), F.count_if(F.col("error").isNotNull()).alias("failed"),
        F.coalesce(F.sum(F.size("parsed_items")), F.lit(0)).alias("items"), F.coalesce(F.sum("prompt_tokens"), F.lit(0)).alias("prompt_tokens"),
        F.coalesce(F.sum("completion_tokens"), F.lit(0)).alias("completion_tokens"), F.coalesce(F.avg(ok.cast("int")), F.lit(0.0)).alias("success_rate"),
    )
