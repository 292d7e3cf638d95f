"""Mixing sources to target weights by entropy balancing.

Among all rates r in [0, cap] of the documents, those that deviate least in relative entropy from
taking each document once, under one token constraint a source, are exponential tilts of its size:
r = min(cap, exp(lambda * size / mean size)), with one dual variable lambda a source. Newton steps on
the convex dual find it; each iteration is one distributed aggregation over (source, size) counts,
kept inside a bracket that every step narrows, so that it converges from any start.

Rates are rounded into copies: the whole part always, and the fraction by order sampling. Within a
source documents are ordered by a Pareto rank, made of the fraction and a hash of the row, and take
one more copy until the source's words are met. The cut is found from sums over equal-width bins of the rank,
and exact order only inside the one bin that holds the cut, so no task sees a whole hot source. One
document, and at most TURNS in all, then changes sides where its size is nearest to what is still short or over.

Defined results: a null text has size 0 and is taken 0 times; the null source is a source of its own,
last in order; a source of size 0 has target 0; rows that repeat a doc_id are documents of their
own, and rows alike in id and text take the same number of copies; an empty table gives an empty result. Columns named like a result are replaced, others pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fields, name_of, row_of, stored, words

CAP = 3.0
WEIGHTS = (1.0, 2.0, 3.0)
ITERATIONS = 60
TOLERANCE = 1e-9
BINS = 4096
#: Documents of a source that may change sides after the cut.
TURNS = 3
#: exp(LIMIT) bounds the tilt of a mean-sized document.
LIMIT = 60.0

RESULTS = ("size", "source_size", "target", "rate", "copies", "taken")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """sizes (source, source_size) with target: shares by weight of the sum of all, no target above cap times its size.

    Sources are filled in order of cap * size / weight: those below the water level stop at their
    cap, the others share what is left by weight. One row a source, so its windows are over sources.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    s = sizes.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1))
    by_level = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").isNull(), "source")
    every = Window.partitionBy()
    s = s.withColumn("_cap", cap * F.col("source_size"))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("_rest", F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
    s = s.withColumn("_free", F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
    s = s.withColumn("_level", F.col("_rest") / F.col("_free"))
    level = F.min(F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.struct(F.col("_cap") / F.col("_w"), F.col("_level")))).over(every)
    s = s.withColumn("_water", level["_level"])
    target = F.when(F.col("_water").isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), F.col("_water") * F.col("_w")))
    return s.select("source", "source_size", target.cast("double").alias("target"))


def rate(tilt: Column, size: Column, mean: Column, cap: float) -> Column:
    return F.least(F.lit(cap), F.exp(F.least(F.lit(700.0), tilt * size / mean)))


def solve_tilts(counts: DataFrame, targets: DataFrame, cap: float = CAP) -> DataFrame:
    """(source, tilt, mean): counts has (source, size, n); targets has (source, source_size, target).

    A tilt of null means every document at the cap, where the constraint has no finite dual.
    """
    key = F.col("source").eqNullSafe(F.col("_source"))
    c = stored(counts.filter("size > 0"))
    state = targets.filter("target > 0").select("source", "target", "source_size").join(
        c.groupBy(F.col("source").alias("_source")).agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean")), key
    ).drop("_source")
    full = F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)
    state = stored(state.withColumn("full", full).withColumn("tilt", F.lit(0.0)).withColumn("low", F.lit(-LIMIT)).withColumn("high", F.lit(LIMIT)).withColumn("done", full))
    for _ in range(ITERATIONS):
        if state.filter("NOT done").isEmpty():
            break
        st = state.filter("NOT done").select(F.col("source").alias("_source"), F.col("tilt").alias("_tilt"), F.col("mean").alias("_mean"))
        r = rate(F.col("_tilt"), F.col("size"), F.col("_mean"), cap)
        tokens = F.col("n") * F.col("size") * r
        slope = F.when(r < cap, tokens * F.col("size") / F.col("_mean")).otherwise(0.0)
        sums = c.join(st, key).groupBy("_source").agg(F.sum(tokens).alias("g"), F.sum(slope).alias("h"))
        s = state.join(sums, key, "left")
        over = F.col("g") > F.col("target")
        s = s.withColumn("high", F.when(over, F.col("tilt")).otherwise(F.col("high"))).withColumn("low", F.when(over, F.col("low")).otherwise(F.col("tilt")))
        step = F.col("tilt") + (F.col("target") - F.col("g")) / F.col("h")
        inside = (F.col("h") > 0) & (step > F.col("low")) & (step < F.col("high"))
        met = F.abs(F.col("g") - F.col("target")) <= TOLERANCE * F.col("target")
        moved = F.when(F.col("done") | met, F.col("tilt")).when(inside, step).otherwise((F.col("low") + F.col("high")) / 2)
        state = stored(s.select("source", "target", "source_size", "mean", "full", moved.alias("tilt"), "low", "high", (F.col("done") | F.coalesce(met, F.lit(True))).alias("done")))
    return state.select("source", F.when(~F.col("full"), F.col("tilt")).alias("tilt"), "mean")


def mix(docs: DataFrame, text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, ident: str = "doc_id") -> DataFrame:
    """docs with size, source_size, target, rate, copies and taken (copies times size); `source` is matched as it is."""
    others = [c for c in docs.columns if c not in RESULTS or c in (text, source, ident)]
    results = [c for c in RESULTS if c not in others]
    u = F.xxhash64(name_of(ident).cast("string"), F.xxhash64(name_of(text)), F.lit(7))
    sized = docs.select(row_of(others).alias("_row"), name_of(source).alias("source"), F.size(words(name_of(text))).cast("long").alias("size"), u.alias("_u"))
    light = stored(sized.select("source", "size", "_u"))
    counts = light.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).cast("long").alias("source_size"))
    targets = stored(source_targets(sizes, weights, cap))
    plan = stored(targets.join(solve_tilts(counts, targets, cap).withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source"))
    cuts = stored(_cuts(light, plan, cap))
    one = F.col("source").eqNullSafe(F.col("_source"))
    chosen = sized.join(cuts.withColumnRenamed("source", "_source"), one, "left")
    chosen = _with_rates(chosen, cap)
    copies = F.col("_whole") + F.when((F.col("_part") > 0) & _extra(), 1).otherwise(0)
    out = chosen.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0).cast("long"))
    out = out.withColumn("taken", F.col("copies") * F.col("size")).withColumn("rate", F.coalesce("rate", F.lit(0.0)))
    return out.select(*fields("_row", others), *results)


def _with_rates(df: DataFrame, cap: float) -> DataFrame:
    """Adds rate, its whole part and fraction, and the Pareto rank, squeezed into [0, 1]."""
    r = F.when(F.col("target") == 0, 0.0).when(F.col("tilt").isNull(), cap).otherwise(rate(F.col("tilt"), F.col("size"), F.col("mean"), cap))
    df = df.withColumn("rate", r).withColumn("_whole", F.floor("rate")).withColumn("_part", F.col("rate") - F.col("_whole"))
    u = (F.pmod(F.col("_u"), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    odds = u / (1 - u) * (1 - F.col("_part")) / F.col("_part")
    return df.withColumn("_rank", F.when(F.col("_part") > 0, odds / (1 + odds)))


def _cuts(light: DataFrame, plan: DataFrame, cap: float) -> DataFrame:
    """plan with cut, cut_u and turned, which `_extra` reads."""
    key = F.col("source").eqNullSafe(F.col("_source"))
    d = _with_rates(light.filter("size > 0").withColumnRenamed("source", "_source").join(plan, key).drop("source"), cap)
    d = d.withColumn("_bin", F.floor(F.least(F.coalesce("_rank", F.lit(0.0)), F.lit(1 - 1e-12)) * BINS))
    binned = d.groupBy("_source", "_bin").agg(F.sum(F.col("_whole") * F.col("size")).alias("base"), F.sum(F.when(F.col("_part") > 0, F.col("size")).otherwise(0)).alias("more"))
    w = Window.partitionBy("_source")
    before = w.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    binned = binned.withColumn("all_base", F.sum("base").over(w)).withColumn("ahead", F.coalesce(F.sum("more").over(before), F.lit(0)))
    at = binned.join(plan.select("source", "target"), key).withColumn("need", F.col("target") - F.col("all_base"))
    at = stored(at.filter((F.col("ahead") < F.col("need")) & (F.col("need") <= F.col("ahead") + F.col("more"))).select(F.col("_source").alias("source"), F.col("_bin").alias("bin"), "ahead", "need"))
    inside = d.filter("_part > 0").select("_source", "_bin", "_rank", "_u", "size").join(at, key & (F.col("_bin") == F.col("bin")))
    run = Window.partitionBy("_source").orderBy("_rank", "_u").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("sum", F.col("ahead") + F.sum("size").over(run)).filter(F.col("sum") <= F.col("need"))
    last = inside.groupBy("_source").agg(F.max(F.struct("_rank", "_u", "sum")).alias("last"))
    last = stored(at.join(last, key, "left").drop("_source"))
    rank = F.coalesce(F.col("last")["_rank"], F.col("bin") / BINS - 1e-15)
    short = F.col("need") - F.coalesce(F.col("last")["sum"], F.col("ahead"))
    none = F.array().cast("array<struct<_rank:double,_u:bigint>>")
    ends = stored(last.select("source", rank.alias("cut"), F.coalesce(F.col("last")["_u"], F.lit(0).cast("long")).alias("cut_u"), short.alias("short"), none.alias("turned")))
    live = d.filter("_part > 0")
    for _ in range(TURNS):
        # one document whose size is nearest to what is short, or over, changes sides
        j = live.join(ends, key)
        j = j.filter((F.col("short") > 0) & ~_extra() | (F.col("short") < 0) & _extra())
        pick = j.groupBy("_source").agg(F.min(F.struct(F.abs(F.col("size") - F.abs("short")).alias("off"), "_rank", "_u", "size")).alias("pick"))
        e = ends.join(pick, key, "left")
        better = F.coalesce(F.col("pick")["off"] < F.abs("short"), F.lit(False))
        turned = F.when(better, F.concat("turned", F.array(F.struct(F.col("pick")["_rank"].alias("_rank"), F.col("pick")["_u"].alias("_u"))))).otherwise(F.col("turned"))
        left = F.when(better, F.col("short") - F.signum("short") * F.col("pick")["size"]).otherwise(F.col("short"))
        ends = stored(e.select("source", "cut", "cut_u", left.alias("short"), turned.alias("turned")))
    ends = ends.select(F.col("source").alias("_s"), "cut", "cut_u", "turned")
    over = binned.join(plan.select("source", "target"), key).groupBy(F.col("_source").alias("_o")).agg((F.first("target") - F.first("all_base") > F.sum("more")).alias("every"))
    out = plan.join(ends, F.col("source").eqNullSafe(F.col("_s")), "left").join(over, F.col("source").eqNullSafe(F.col("_o")), "left")
    cut = F.when(F.col("every"), 2.0).otherwise(F.coalesce("cut", F.lit(-1.0)))
    return out.select("source", "source_size", "target", "tilt", "mean", cut.alias("cut"), F.coalesce("cut_u", F.lit(0).cast("long")).alias("cut_u"), F.coalesce("turned", none).alias("turned"))


def _extra() -> Column:
    """Whether a document takes one more copy: up to the cut, but for those that changed sides."""
    upto = (F.col("_rank") < F.col("cut")) | ((F.col("_rank") == F.col("cut")) & (F.col("_u") <= F.col("cut_u")))
    return upto != F.array_contains("turned", F.struct(F.col("_rank").alias("_rank"), F.col("_u").alias("_u")))
