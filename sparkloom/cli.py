"""python -m sparkloom.cli: a whole run, one stage, merging alone, or a report, from a label registry and folders of JSON lines."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from . import config, run
from .operators import analyze
from .session import ship
from .sources import endpoint, registry


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="sparkloom")
    p.add_argument("--config")
    p.add_argument("--registry", required=True, help="JSON array of labels")
    p.add_argument("--raw", help="folder with stage1, stage2 and stage3; a whole run then generates nothing")
    p.add_argument("--output")
    p.add_argument("--labels", help="only these labels are generated for, by commas")
    p.add_argument("--max-pairs", type=int)
    p.add_argument("--dry-run", action="store_true")
    mode = p.add_mutually_exclusive_group()
    mode.add_argument("--stage", type=int, choices=(1, 2, 3), help="generate one stage")
    for name in ("merge-only", "progress", "analyze-pairs", "analyze-dataset"):
        mode.add_argument(f"--{name}", action="store_true")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = arguments(argv)
    cfg = config.load(args.config)
    cfg["generation"]["dry_run"] |= args.dry_run
    root = args.output or cfg["output"]["root"]
    spark = SparkSession.builder.appName("sparkloom").getOrCreate()
    ship(spark)
    labels = registry.from_json(spark, args.registry)
    names = args.labels.split(",") if args.labels else None
    provider = endpoint.from_config(cfg["generation"])
    raw = args.raw or f"{root}/raw"
    if args.stage:
        run.generate_stage(spark, labels, f"stage{args.stage}", cfg, f"{raw}/stage{args.stage}", provider, names, args.max_pairs)
    elif args.analyze_pairs:
        for r in run.chosen_pairs(labels, cfg, names, args.max_pairs).orderBy("place").toLocalIterator():
            print(json.dumps({"agent_a": r.agent_a, "agent_b": r.agent_b, "source": r.source, "overlap_score": round(r.overlap_score, 3), "shared_keywords": r.shared_keywords}, ensure_ascii=False))
    elif args.progress:
        for r in analyze.progress(run.read_raw(spark, raw)).orderBy("stage", "answer").toLocalIterator():
            print(f"{r.stage}\t{r.answer}\t{r.n}")
    elif args.analyze_dataset:
        print(analyze.console_report(run.read_raw(spark, raw), labels))
    elif args.merge_only:
        run.merge_and_export(spark, run.read_clean(spark, f"{root}/clean") if not args.raw else run.read_raw(spark, raw), labels, cfg, root, split=False)
    else:
        run.full_run(spark, labels, cfg, root, args.raw, provider, names, args.max_pairs)
    return 0


if __name__ == "__main__":
    try:
        sys.exit(main())
    except KeyboardInterrupt:
        sys.exit(130)
