"""Statistics of a labelled dataset, as aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .near import written
from .order import prefix_sums

#: Fixed value: the domain of labels that no registry row has.
UNKNOWN = "未知"


def label_distribution(samples: DataFrame) -> DataFrame:
    return samples.groupBy(F.coalesce("answer", F.lit("")).alias("answer")).agg(F.count(F.lit(1)).alias("n"))


def label_stats(samples: DataFrame) -> DataFrame:
    """One row: total, labels, and least, most, mean and population deviation of the labels' counts."""
    d = label_distribution(samples)
    return d.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("n_labels"), F.coalesce(F.min("n"), F.lit(0)).alias("min_n"),
        F.coalesce(F.max("n"), F.lit(0)).alias("max_n"), F.coalesce(F.avg("n"), F.lit(0.0)).alias("mean_n"), F.coalesce(F.stddev_pop("n"), F.lit(0.0)).alias("std_n"),
    )


def length_stats(samples: DataFrame) -> DataFrame:
    """One row: least, most, mean and deviation of question lengths to one decimal, and shares of short and long ones."""
    n = F.length(F.coalesce("question", F.lit("")))
    return samples.agg(
        F.min(n).alias("min_len"), F.max(n).alias("max_len"), F.round(F.avg(n), 1).alias("mean_len"), F.round(F.stddev_pop(n), 1).alias("std_len"),
        F.avg((n <= 15).cast("int")).alias("short_ratio"), F.avg((n > 100).cast("int")).alias("long_ratio"),
    )


def length_histogram(samples: DataFrame) -> DataFrame:
    n = F.length(F.coalesce("question", F.lit("")))
    return samples.agg(
        F.count_if(n <= 20).alias("upto_20"), F.count_if(n.between(21, 80)).alias("from_21_to_80"),
        F.count_if(n.between(81, 200)).alias("from_81_to_200"), F.count_if(n > 200).alias("over_200"),
    )


def length_summary(samples: DataFrame) -> DataFrame:
    """One row: rows, and least, most and whole mean of question lengths."""
    n = F.length(F.coalesce("question", F.lit("")))
    return samples.agg(F.count(F.lit(1)).alias("n"), F.min(n).alias("min_len"), F.max(n).alias("max_len"), F.floor(F.sum(n) / F.count(F.lit(1))).alias("mean_len"))


def domain_distribution(samples: DataFrame, registry: DataFrame) -> DataFrame:
    """Counted by label first, so that the join sees labels, not samples."""
    named = registry.groupBy(F.col("name").alias("answer")).agg(F.min_by("domain", "idx").alias("domain"))  # a name's first row counts
    d = label_distribution(samples).join(named, "answer", "left")
    return d.groupBy(F.coalesce("domain", F.lit(UNKNOWN)).alias("domain")).agg(F.sum("n").alias("n"))


def coverage(samples: DataFrame, registry: DataFrame) -> DataFrame:
    """Distinct observed labels over registered ones; labels that aren't registered count too, so it can exceed 1."""
    seen = samples.agg(F.countDistinct(F.coalesce("answer", F.lit(""))).alias("n_seen"))
    all_ = registry.agg(F.count(F.lit(1)).alias("n_registered"))
    out = seen.join(F.broadcast(all_))  # one row each
    return out.withColumn("coverage", F.when(F.col("n_registered") > 0, F.col("n_seen") / F.col("n_registered")).otherwise(0.0))


def missing_labels(samples: DataFrame, registry: DataFrame) -> DataFrame:
    return registry.select("name").join(samples.select(F.col("answer").alias("name")).distinct(), "name", "left_anti")


def balance_score(samples: DataFrame) -> DataFrame:
    """One row: 1 less the absolute Gini coefficient of the labels' counts, to four decimals; 1 for one label, 0 for none."""
    return _balance(label_distribution(samples))


def _balance(counts: DataFrame) -> DataFrame:
    # labels of one count n, c of them with `ahead` before: their ranks from 1 add up to c * ahead + c * (c + 1) / 2
    d = counts.groupBy("n").agg(F.count(F.lit(1)).alias("c"))
    d = prefix_sums(d, "n", "c").withColumn("ranks", F.col("c") * F.col("ahead") + F.col("c") * (F.col("c") + 1) / 2)
    k = d.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("k"), F.sum(F.col("c") * F.col("n")).alias("t"), F.sum(F.col("ranks") * F.col("n")).alias("s"))
    gini = (2 * F.col("s") - (F.col("k") + 1) * F.col("t")) / (F.col("k") * F.col("t"))
    score = F.when(F.col("k") == 0, 0.0).when(F.col("k") == 1, 1.0).otherwise(F.round(1 - F.abs(gini), 4))
    return k.select(score.alias("balance_score"))


def by_domain(registry: DataFrame) -> DataFrame:
    """(domain, names): each domain's labels in order of the registry."""
    names = F.transform(F.sort_array(F.collect_list(F.struct("idx", "name"))), lambda x: x["name"])
    return registry.groupBy("domain").agg(names.alias("names"))


def progress(rows: DataFrame) -> DataFrame:
    """(stage, answer, n) for each label file, with totals of stages and of all."""
    out = rows.rollup("stage", "answer").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"))
    total = F.lit("TOTAL")
    return out.select(F.when(F.col("g") >= 3, total).otherwise(F.col("stage")).alias("stage"), F.when(F.col("g") >= 1, total).otherwise(F.col("answer")).alias("answer"), "n")


def remaining(existing: DataFrame, registry: DataFrame, target: int) -> DataFrame:
    """(name, existing, remaining) of labels that have fewer rows than the target: what a resumed run still makes."""
    n = label_distribution(existing)
    out = registry.select("name").join(n, F.col("name") == F.col("answer"), "left").select("name", F.coalesce("n", F.lit(0)).alias("existing"))
    return out.filter(F.col("existing") < target).withColumn("remaining", target - F.col("existing"))


def by_label(samples: DataFrame) -> DataFrame:
    """One row a label (a null one is empty): its rows, and of its question lengths the least, most, sum, sum of squares and counts by class."""
    s = samples.select(F.coalesce("answer", F.lit("")).alias("answer"), F.length(F.coalesce("question", F.lit(""))).alias("l"))
    long = F.col("l").cast("long")
    return s.groupBy("answer").agg(
        F.count(F.lit(1)).alias("n"), F.min("l").alias("low"), F.max("l").alias("high"), F.sum("l").cast("decimal(20,0)").alias("chars"), F.sum((long * long).cast("decimal(19,0)")).alias("squares"),
        F.count_if(F.col("l") <= 15).alias("short"), F.count_if(F.col("l") > 100).alias("long"),
        *[F.count_if(F.col("l").between(a, b)).alias(name) for name, a, b in LENGTHS],
    )


#: Classes of question lengths: name, least and most.
LENGTHS = (("upto_20", 0, 20), ("from_21_to_80", 21, 80), ("from_81_to_200", 81, 200), ("over_200", 201, 2**31 - 1))


def report_rows(samples: DataFrame, registry: DataFrame) -> DataFrame:
    """Every figure of the report as (section, name, n, value): n if it is whole, else value; samples are read once.

    Samples are counted by label, one row each, and these rows are stored; grouping sets over labels, domains
    and all of them, joined with the registry, give the rest. A label of the registry without samples is a
    row of `missing_labels`. Without samples, lengths are null and all else is 0; without labels too, only
    the balance is left.
    """
    per = written(by_label(samples))
    named = registry.groupBy(F.col("name").alias("answer")).agg(F.min_by("domain", "idx").alias("domain"), F.count(F.lit(1)).alias("registered"))
    d = per.join(named, "answer", "full").withColumn("domain", F.coalesce("domain", F.lit(UNKNOWN)))
    sums = [F.sum(c).alias(c) for c in ("n", "registered", "chars", "squares", "short", "long", *[name for name, _, _ in LENGTHS])]
    g = d.groupingSets([[F.col("answer")], [F.col("domain")], []], "answer", "domain").agg(
        F.grouping_id().alias("g"), F.count("n").alias("labels"), F.min("n").alias("min_n"), F.max("n").alias("max_n"), F.avg("n").alias("mean_n"), F.stddev_pop("n").alias("std_n"),
        F.min("low").alias("low"), F.max("high").alias("high"), *sums,
    )
    entry = lambda section, name, n=None, value=None: F.struct(F.lit(section).alias("section"), (F.lit(name) if isinstance(name, str) else name).alias("name"), F.lit(n).cast("long").alias("n"), F.lit(value).cast("double").alias("value"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    n, chars = F.col("n"), F.col("chars").cast("double")
    deviation = F.sqrt((n.cast("decimal(19,0)") * F.col("squares") - F.col("chars") * F.col("chars")).cast("double")) / n
    whole = [
        entry("labels", "total", zero("n")), entry("labels", "n_labels", F.col("labels")), entry("labels", "min_n", zero("min_n")), entry("labels", "max_n", zero("max_n")),
        entry("labels", "mean_n", value=zero("mean_n")), entry("labels", "std_n", value=zero("std_n")),
        entry("lengths", "min_len", F.col("low")), entry("lengths", "max_len", F.col("high")), entry("lengths", "mean_len", value=F.round(chars / n, 1)), entry("lengths", "std_len", value=F.round(deviation, 1)),
        entry("lengths", "short_ratio", value=F.col("short") / n), entry("lengths", "long_ratio", value=F.col("long") / n),
        *[entry("length_histogram", name, zero(name)) for name, _, _ in LENGTHS],
        entry("coverage", "n_seen", F.col("labels")), entry("coverage", "n_registered", zero("registered")),
        entry("coverage", "coverage", value=F.when(F.col("registered") > 0, F.col("labels") / F.col("registered")).otherwise(0.0)),
    ]
    label = F.when(n.isNull(), entry("missing_labels", F.col("answer"))).otherwise(entry("label_distribution", F.col("answer"), n))
    domain = F.when(n.isNotNull(), F.array(entry("domain_distribution", F.col("domain"), n)))
    rows = g.select(F.explode(F.when(F.col("g") == 3, F.array(*whole)).when(F.col("g") == 2, domain).otherwise(F.array(label))).alias("x")).select("x.*")
    return rows.unionByName(_balance(per).select(F.lit("balance").alias("section"), F.lit("balance_score").alias("name"), F.lit(None).cast("long").alias("n"), F.col("balance_score").alias("value")))


SECTIONS = ("labels", "lengths", "length_histogram", "coverage", "balance", "label_distribution", "domain_distribution")


def report(samples: DataFrame, registry: DataFrame) -> dict:
    """The report by section and name, and the missing labels by name: one row a label is the most that is gathered."""
    out = {k: {} for k in SECTIONS} | {"missing_labels": []}
    for r in report_rows(samples, registry).orderBy("section", "name").collect():
        if r.section == "missing_labels":
            out[r.section].append(r.name)
        else:
            out[r.section][r.name] = r.value if r.n is None else r.n
    return out


def console_report(samples: DataFrame, registry: DataFrame, missing: int = 10) -> str:
    """The report as lines of text: domains by falling count, and the first missing labels by name."""
    r = report(samples, registry)
    labels, lengths, seen = ({"total": 0, "n_labels": 0, "min_n": 0, "max_n": 0, "mean_n": 0.0, "std_n": 0.0} | r["labels"], r["lengths"], {"n_registered": 0, "coverage": 0.0} | r["coverage"])
    domains = sorted(r["domain_distribution"].items(), key=lambda x: (-x[1], x[0]))
    lines = [
        f"rows {labels['total']}, labels {labels['n_labels']} of {seen['n_registered']}, coverage {seen['coverage']:.1%}",
        f"rows a label: {labels['min_n']} to {labels['max_n']}, mean {labels['mean_n']:.1f}, deviation {labels['std_n']:.1f}, balance {r['balance']['balance_score']:.4f}",
        f"question length: {lengths.get('min_len')} to {lengths.get('max_len')}, mean {lengths.get('mean_len')}, deviation {lengths.get('std_len')}",
        *(f"{name}: {n}" for name, n in r["length_histogram"].items()),
        "domains:", *(f"  {name}: {n}" for name, n in domains),
    ]
    absent = r["missing_labels"]
    return "\n".join([*lines, *([f"missing labels {len(absent)}: {', '.join(absent[:missing])}"] if absent else [])])
