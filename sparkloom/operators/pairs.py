"""Confusable label pairs from a registry (idx, name, domain, keywords, confusable)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .near import written
from .order import numbered, shuffled

REGISTRY, KEYWORD, DOMAIN = "registry", "keyword_overlap", "domain"
REGISTRY_SCORE, DOMAIN_SCORE = 0.8, 0.2


def _names(registry: DataFrame, k: str) -> DataFrame:
    return registry.select(F.col("idx").alias(f"i_{k}"), F.col("name").alias(f"name_{k}"), F.col("keywords").alias(f"keywords_{k}"), F.col("domain").alias(f"domain_{k}"))


def _finish(df: DataFrame, source: str, score, rank) -> DataFrame:
    shared = F.array_sort(F.array_intersect("keywords_a", "keywords_b"))
    return df.select(
        F.least("name_a", "name_b").alias("agent_a"), F.greatest("name_a", "name_b").alias("agent_b"), F.lit(source).alias("source"),
        score.alias("overlap_score"), shared.alias("shared_keywords"), rank.alias("rank"),
    )


def registry_pairs(registry: DataFrame) -> DataFrame:
    """Pairs that labels name themselves; names that no label has are left out."""
    refs = registry.select("idx", "name", "keywords", "domain", F.posexplode("confusable").alias("k", "other"))
    a = refs.select(F.col("idx").alias("i_a"), F.col("name").alias("name_a"), F.col("keywords").alias("keywords_a"), "k", "other")
    both = a.join(shuffled(_names(registry, "b")), F.col("other") == F.col("name_b"))
    rank = F.struct(F.lit(0).alias("pass"), F.col("i_a").cast("long").alias("i"), F.col("k").cast("long").alias("j"), F.lit(0).cast("long").alias("d"))
    return _first(_finish(both, REGISTRY, F.lit(REGISTRY_SCORE), rank))


def keyword_pairs(registry: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Pairs whose keyword sets have at least the threshold as Jaccard similarity, by an inverted index."""
    words = registry.select("idx", "name", F.explode(F.array_distinct("keywords")).alias("word"), F.size(F.array_distinct("keywords")).alias("n"))
    a = words.select(F.col("idx").alias("i_a"), F.col("n").alias("n_a"), "word")
    b = words.select(F.col("idx").alias("i_b"), F.col("n").alias("n_b"), "word")
    common = a.join(shuffled(b), "word").filter("i_a < i_b").groupBy("i_a", "i_b", "n_a", "n_b").agg(F.count(F.lit(1)).alias("c"))
    near = common.withColumn("score", F.col("c") / (F.col("n_a") + F.col("n_b") - F.col("c"))).filter(F.col("score") >= threshold)
    both = near.join(shuffled(_names(registry, "a")), "i_a").join(shuffled(_names(registry, "b")), "i_b")
    rank = F.struct(F.lit(1).alias("pass"), F.col("i_a").cast("long").alias("i"), F.col("i_b").cast("long").alias("j"), F.lit(0).cast("long").alias("d"))
    return _first(_finish(both, KEYWORD, F.col("score"), rank))


def domain_pairs(registry: DataFrame) -> DataFrame:
    """All pairs of one domain; domains come in the order of their first label."""
    r = registry.withColumn("first", F.min("idx").over(Window.partitionBy("domain")))
    a = r.select(F.col("idx").alias("i_a"), F.col("name").alias("name_a"), F.col("keywords").alias("keywords_a"), "domain", "first")
    b = _names(registry, "b").withColumnRenamed("domain_b", "domain")
    both = a.join(shuffled(b), "domain").filter("i_a < i_b")
    rank = F.struct(F.lit(2).alias("pass"), F.col("first").cast("long").alias("i"), F.col("i_a").cast("long").alias("j"), F.col("i_b").cast("long").alias("d"))
    return _first(_finish(both, DOMAIN, F.lit(DOMAIN_SCORE), rank))


def _first(pairs: DataFrame) -> DataFrame:
    w = Window.partitionBy("agent_a", "agent_b").orderBy("rank")
    return pairs.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def all_pairs(registry: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The union of the three, each pair once, by the first that has it."""
    return _first(registry_pairs(registry).unionByName(keyword_pairs(registry, threshold)).unionByName(domain_pairs(registry)))


def capped_pairs(pairs: DataFrame, most: int = 5) -> DataFrame:
    """Greedy selection by falling score: an edge is taken while both its labels have fewer than `most`; with `place`, its number among those taken.

    In rounds: an edge that stands, at both its labels, among as many first edges as the label has room
    for is taken by any greedy course, so all such edges are taken at once; edges of full labels go. The
    first edge left is always among them. Edges are in no place together; a label's are, and those that
    are left of a hot one's are its first `most` at once.
    """
    order = [F.struct((-F.col("overlap_score")).alias("less"), "rank").alias("order")]
    left = written(pairs.select("agent_a", "agent_b", *order))
    room = taken = None
    while not left.isEmpty():
        ends = left.select(F.col("agent_a").alias("name"), "order", F.lit(0).alias("end")).unionByName(left.select(F.col("agent_b").alias("name"), "order", F.lit(1).alias("end")))
        first = ends.withColumn("_r", F.row_number().over(Window.partitionBy("name").orderBy("order"))).filter(F.col("_r") <= most)
        if room is not None:
            first = first.join(shuffled(room), "name", "left").filter(F.col("_r") <= most - F.coalesce("used", F.lit(0)))
        now = written(first.groupBy("order").agg(F.count(F.lit(1)).alias("_e")).filter("_e = 2").select("order"))
        now = written(left.join(shuffled(now), "order", "left_semi"))
        taken = now if taken is None else taken.unionByName(now)
        used = taken.select(F.col("agent_a").alias("name")).unionByName(taken.select(F.col("agent_b").alias("name"))).groupBy("name").agg(F.count(F.lit(1)).alias("used"))
        room = written(used)
        full = room.filter(F.col("used") >= most)
        left = left.join(shuffled(now.select("order")), "order", "left_anti")
        for k in ("agent_a", "agent_b"):
            left = left.join(shuffled(full.select(F.col("name").alias(k))), k, "left_anti")
        left = written(left.select("agent_a", "agent_b", "order"))
    if taken is None:
        return pairs.withColumn("place", F.lit(0).cast("long")).limit(0)
    return numbered(taken, "order").drop("order").join(shuffled(pairs), ["agent_a", "agent_b"])


def confusion_matrix(pairs: DataFrame) -> DataFrame:
    """(name, neighbours): sorted adjacency lists."""
    both = pairs.select(F.col("agent_a").alias("name"), F.col("agent_b").alias("other")).unionByName(pairs.select(F.col("agent_b").alias("name"), F.col("agent_a").alias("other")))
    return both.groupBy("name").agg(F.array_sort(F.collect_set("other")).alias("neighbours"))


def touching(pairs: DataFrame, names: list[str]) -> DataFrame:
    """Pairs with at least one endpoint among the names."""
    return pairs.filter(F.col("agent_a").isin(names) | F.col("agent_b").isin(names))


def pairs_report(pairs: DataFrame) -> DataFrame:
    """One row of JSON text: total_pairs, and the pairs in order of falling score, then of discovery; scores to three decimals."""
    one = F.struct((-F.col("overlap_score")).alias("o"), "rank", F.struct("agent_a", "agent_b", "source", F.round("overlap_score", 3).alias("overlap_score"), "shared_keywords").alias("pair"))
    every = F.transform(F.sort_array(F.collect_list(one)), lambda x: x["pair"])
    return pairs.agg(F.to_json(F.struct(F.count(F.lit(1)).alias("total_pairs"), every.alias("pairs"))).alias("report"))
