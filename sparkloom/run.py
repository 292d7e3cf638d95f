"""A whole run: generate, clean, merge, analyse, split, export, each step on what the one before wrote."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import analyze, clean, export, generate, merge, pairs
from .operators.seen import SeenSet
from .functions.text import seeded
from .sources import files, jsonl
from .state import save_state

STAGES = ("stage1", "stage2", "stage3")


def chosen_pairs(labels: DataFrame, cfg: dict, names: list[str] | None = None, max_pairs: int | None = None) -> DataFrame:
    """The capped pairs; those that touch one of the names, and of these the first max_pairs by place, if given."""
    p = pairs.capped_pairs(pairs.all_pairs(labels, cfg["pairs"]["threshold"]), cfg["pairs"]["per_label"])
    p = pairs.touching(p, names) if names else p
    return p.orderBy("place").limit(max_pairs) if max_pairs else p


def _counts(spark: SparkSession, folder: str, *by: str) -> DataFrame | None:
    """Rows that a stage's folder holds already, by the columns; none if it has no rows."""
    rows = jsonl.read_stage(spark, folder, "")
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")) if set(by) <= set(rows.columns) else None


def generate_stage(spark: SparkSession, labels: DataFrame, stage: str, cfg: dict, folder: str, provider=generate.offline, names: list[str] | None = None, max_pairs: int | None = None) -> None:
    """Appends to a stage's folder what its labels, or pairs and directions, lack; without `resume`, replaces it.

    Calls are bounded: a label or direction that its calls don't fill stays short, and a later run goes on.
    """
    from .sources.registry import subset

    g, bank = cfg["generation"], generate.templates(spark)
    s, resume = g[stage], g["resume"]
    ask = lambda tasks: generate.respond(tasks, provider, g["retries"], g["delay"], g["max_workers"], at_once=g["at_once"])
    if stage == "stage3":
        target = s["samples_per_pair"]
        existing = _counts(spark, folder, "pair", "answer") if resume else None
        tasks = generate.pair_tasks(chosen_pairs(labels, cfg, names, max_pairs), labels, bank, generate.spare_calls(target, s["batch"]), s["batch"])
        if existing is not None:
            full = existing.filter(F.col("n") >= target).select("pair", F.col("answer").alias("expected_answer"))
            tasks = tasks.join(full, ["pair", "expected_answer"], "left_anti")
        made = generate.hard_negatives(ask(tasks), tasks, target, existing)
    else:
        target = s["samples_per_label"]
        existing = _counts(spark, folder, "answer") if resume else None
        todo = subset(labels, names)
        if existing is not None:
            todo = todo.join(existing.filter(F.col("n") >= target).select(F.col("answer").alias("name")), "name", "left_anti")
        if stage == "stage1":
            tasks = generate.prompt_tasks(todo, bank, "stage1", generate.stage1_calls(target, s["batch"]), s["batch"])
        else:
            simple, hard = generate.stage2_calls(target, s["batch"], s["simple_ratio"])
            tasks = generate.prompt_tasks(todo, bank, "simple", simple, s["batch"]).unionByName(generate.prompt_tasks(todo, bank, "stage2_complex", hard, s["batch"]))
        made = generate.generated(ask(tasks), target, existing=existing)
    jsonl.write_jsonl(made, folder, append=resume, by="pair" if stage == "stage3" else None)


def _in_order(spark: SparkSession, read: Callable[[str], DataFrame]) -> DataFrame:
    """The rows of all stages with seq; written once, so that every later step sees one numbering."""
    from .operators.near import written

    parts = [read(k) for k in STAGES]
    return jsonl.with_seq(written(parts[0].unionByName(parts[1]).unionByName(parts[2])))


def read_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of all stages, numbered by stage, file (its path below the stage's folder) and line; `corrupt` where a line holds no object, `not_text` where a field holds no text."""
    columns = ("question", "answer", "corrupt", "not_text", "src_file", "stage", *jsonl.PLACE)
    return _in_order(spark, lambda k: jsonl.read_stage(spark, f"{folder}/{k}", k, keep_corrupt=True, placed=True).select(*columns))


def clean_folders(spark: SparkSession, raw: str, out: str, labels: DataFrame, cfg: clean.CleanConfig, state: str | None = None) -> dict:
    """Cleans all files of all stages into <out>/<stage>/src_file=<path below the stage's folder>, rows in order; dedup spans them, unless cfg.scope names a column.

    Each stage's files appear together, when their job is done. Returns files, total_input, total_passed,
    overall_pass_rate, and the same by file; <out>/files.json has them too, written last. `state` is a path
    of what earlier runs have seen: dedup goes on from there, and this run is added at its end.
    """
    seen = None if state is None else SeenSet(spark, state)
    cleaned = clean.clean(read_raw(spark, raw), labels, cfg, seen).persist()
    try:
        good = cleaned.filter("written" if cfg.cap is not None else "kept").select("seq", "question", "answer", "stage", "src_file")
        for k in STAGES:
            part = clean.normalise(good.filter(F.col("stage") == k))
            jsonl.write_jsonl(part, f"{out}/{k}", by="src_file", order=["seq"])
        if seen is not None:
            seen.add(cleaned, cfg.scope)
        by_file = [r.asDict() for r in clean.file_stats(cleaned, "stage", "src_file").orderBy("stage", "src_file").collect()]  # one row a file
    finally:
        cleaned.unpersist()
    total, passed = sum(f["n_input"] for f in by_file), sum(f["n_passed"] for f in by_file)
    stats = {"files": len(by_file), "total_input": total, "total_passed": passed, "overall_pass_rate": passed / total if total else 0.0, "by_file": by_file}
    files.write_text(spark, f"{out}/files.json", json.dumps(stats, ensure_ascii=False, indent=2))
    return stats


def read_clean(spark: SparkSession, folder: str) -> DataFrame:
    """What clean_folders wrote, numbered anew in the same order, under the files' first names."""
    columns = ("question", "answer", "src_file", "stage", *jsonl.PLACE)
    return _in_order(spark, lambda k: jsonl.read_stage(spark, f"{folder}/{k}", k, placed=True).select(*columns))


def merge_and_export(spark: SparkSession, samples: DataFrame, labels: DataFrame, cfg: dict, root: str, split: bool = True) -> None:
    """<root>/merged, the splits, the report, and all formats; rows of each file in a seeded order of its own."""
    m, s = cfg["merge"], cfg["split"]
    merged = merge.merge(samples, labels, m["per_label"], tuple(m["weights"]), m["seed"], max_total=m["max_total"]).persist()
    try:
        jsonl.write_jsonl(merged, f"{root}/merged", order=["place", "seq"])
        if split:
            files.write_text(spark, f"{root}/report.json", json.dumps(analyze.report(merged, labels), ensure_ascii=False, indent=2))
            parts = (merge.stratified_split if s["stratified"] else merge.random_split)(merged, tuple(s["ratios"]), s["seed"])
            export.write_splits(parts.withColumn("place", seeded(s["seed"], F.col("split"), F.col("seq"))), f"{root}/split")
        export.export_all(merged, f"{root}/export")
    finally:
        merged.unpersist()


def full_run(spark: SparkSession, labels: DataFrame, cfg: dict, root: str, raw: str | None = None, provider=generate.offline, names: list[str] | None = None, max_pairs: int | None = None) -> dict:
    """All steps, with their state in <root>/state.json; rows in `raw` stand in for generation, if given."""
    state = lambda **x: save_state(spark, f"{root}/state.json", **x)
    if raw is None:
        raw = f"{root}/raw"
        for k in STAGES:
            generate_stage(spark, labels, k, cfg, f"{raw}/{k}", provider, names, max_pairs)
            state(**{k: "generated"})
    stats = clean_folders(spark, raw, f"{root}/clean", labels, clean.CleanConfig(**cfg["clean"]), cfg["output"].get("seen"))
    state(clean=stats)
    merge_and_export(spark, read_clean(spark, f"{root}/clean"), labels, cfg, root)
    return state(done=True)
