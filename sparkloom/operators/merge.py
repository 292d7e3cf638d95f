"""Merging stages under per-label quotas, and splitting; random orders are md5 orders of seed and key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import seeded
from .clean import exact_dedup
from .order import placed_in_groups


def quotas(target: int, weights: tuple[float, float, float]) -> dict[str, int]:
    """Rows a label gets from each stage; what a stage leaves unused is not passed on."""
    one, two = int(target * weights[0]), int(target * weights[1])
    return {"stage1": one, "stage2": two, "stage3": target - one - two}


def quota_sample(samples: DataFrame, registry: DataFrame, target: int, weights: tuple[float, float, float], seed: int = 42) -> DataFrame:
    """Rows of registered labels, at most the quota of each (label, stage), in seeded order."""
    known = samples.join(registry.select(F.col("name").alias("answer")), "answer", "left_semi")
    limit = F.lit(0)
    for stage, n in quotas(target, weights).items():
        limit = F.when(F.col("stage") == stage, n).otherwise(limit)
    return placed_in_groups(known, ["answer", "stage"], seed).filter(F.col("_i") <= limit).drop("_i", "_n")


def merge(samples: DataFrame, registry: DataFrame, target: int, weights: tuple[float, float, float], seed: int = 42, dedup: bool = True, max_total: int | None = None) -> DataFrame:
    """Quota sample, then exact dedup over all labels, then seeded shuffle (a column `place`), then the limit if there is one."""
    out = quota_sample(samples, registry, target, weights, seed)
    if dedup:
        out = exact_dedup(out)
    out = out.withColumn("place", seeded(seed, F.lit("merge"), F.col("seq")))
    return out.orderBy("place", "seq").limit(max_total) if max_total else out


def stage_stats(sampled: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows of each label by stage and in all, labels without rows included; taken before dedup."""
    n = sampled.groupBy("answer").pivot("stage", ["stage1", "stage2", "stage3"]).agg(F.count(F.lit(1)))
    out = registry.select("name").join(n, F.col("name") == F.col("answer"), "left").drop("answer").fillna(0, ["stage1", "stage2", "stage3"])
    return out.withColumn("total", F.col("stage1") + F.col("stage2") + F.col("stage3"))


def check_ratios(train: float, val: float, test: float) -> None:
    if abs(train + val + test - 1) >= 1e-6:
        raise ValueError("ratios must sum to 1")


def stratified_split(samples: DataFrame, ratios: tuple[float, float, float] = (0.8, 0.1, 0.1), seed: int = 42) -> DataFrame:
    """samples with `split`; each label is cut at its own places, at least one row to train and one to val."""
    check_ratios(*ratios)
    s = placed_in_groups(samples, ["answer"], seed)
    train = F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(ratios[0])))
    val = F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(ratios[1])))
    split = F.when(F.col("_i") <= train, "train").when(F.col("_i") <= train + val, "val").otherwise("test")
    return s.withColumn("split", split).drop("_i", "_n")


def random_split(samples: DataFrame, ratios: tuple[float, float, float] = (0.8, 0.1, 0.1), seed: int = 42) -> DataFrame:
    """samples with `split`, by place in one seeded order."""
    check_ratios(*ratios)
    s = placed_in_groups(samples, [], seed)
    train, val = F.floor(F.col("_n") * F.lit(ratios[0])), F.floor(F.col("_n") * F.lit(ratios[1]))
    split = F.when(F.col("_i") <= train, "train").when(F.col("_i") <= train + val, "val").otherwise("test")
    return s.withColumn("split", split).select(*samples.columns, "split")


def split_sizes(split: DataFrame) -> DataFrame:
    """(split, n, ratio), one row for each of the three."""
    n = split.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    names = split.sparkSession.createDataFrame([("train",), ("val",), ("test",)], "split string")
    out = names.join(n, "split", "left").fillna(0, ["n"]).withColumn("_t", F.sum("n").over(Window.partitionBy()))
    return out.withColumn("ratio", F.when(F.col("_t") > 0, F.col("n") / F.col("_t")).otherwise(0.0)).drop("_t")
