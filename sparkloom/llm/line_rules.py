"""Quality rules: base counts of a text, and cross-document line frequency per host.

Native: DataFrame functions only. Lines are normalised and hashed, the distinct documents that hold
a line are counted per host, lines above the limit are removed from the text, and a document that
loses too much of itself is rejected. A page that is copied often so loses its lines; a caller that
removes copies later can count equal texts once (`count="texts"`), and then it keeps them. Lines and
documents are known by 64-bit hashes.

Defined results: a null or blank text has no words and fails the base rules; null hosts form one
host of their own; rows that repeat a doc_id are judged one by one by their own text; an empty table
gives an empty result. Input columns of any other name pass through `quality_rules` untouched, and a
column named like one of the results is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fields, join_known, lookup, name_of, row_of, stored, words

SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MIN_LINE_DOCUMENTS = 10
MAX_HOST_SHARE = 0.02
MAX_REMOVED_SHARE = 0.5

RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
#: The text without its removed lines, and their number; results that `quality_rules` returns beside the others.
CLEAN_TEXT = "clean_text"
CLEAN = ("n_removed_lines", CLEAN_TEXT)


def normalised_line(line: Column) -> Column:
    """Lower case, with each run of anything but letters and digits as one space."""
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def with_base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the five counts and base_failed.

    Repeated words: each three-word window is hashed; hash and place are packed into one long, so
    that a primitive sort brings equal windows together; neighbours are compared on the full hash.
    Arrays that a lambda indexes are read twice or more, which keeps Catalyst from inlining them
    into the lambda.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.expr("filter(split(_t, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')")
    d = docs.withColumn("_t", body).withColumn("_w", words("_t")).withColumn("_l", lines)
    d = d.withColumn("n_words", F.size("_w").cast("long"))
    d = d.withColumn("word_chars", F.length(F.array_join("_w", "")).cast("long"))
    d = d.withColumn("n_symbols", (F.size(F.split("_t", SYMBOLS, -1)) - 1).cast("long"))
    d = d.withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
    d = d.withColumn("_h", F.expr("CASE WHEN size(_w) >= 3 THEN transform(sequence(0, size(_w) - 3), i -> xxhash64(_w[i], _w[i + 1], _w[i + 2])) ELSE array() END"))
    d = d.withColumn("_b", F.expr("CAST(ceil(log2(size(_h) + 2)) AS int)"))
    d = d.withColumn("_m", F.expr("shiftleft(1L, _b) - 1L"))
    d = d.withColumn("_s", F.expr("sort_array(transform(_h, (h, i) -> shiftleft(h, _b) | CAST(i AS bigint)))"))
    same = "(shiftright(x, _b) = shiftright(get(_s, k {0} 1), _b) AND _h[CAST(x & _m AS int)] = _h[CAST(get(_s, k {0} 1) & _m AS int)])"
    d = d.withColumn("_p", F.expr(f"sort_array(filter(transform(_s, (x, k) -> CASE WHEN {same.format('+')} OR {same.format('-')} THEN x & _m END), x -> x IS NOT NULL))"))
    d = d.withColumn("n_repeat_words", F.expr("aggregate(transform(_p, (x, k) -> least(3L, coalesce(get(_p, k + 1) - x, 3L))), 0L, (a, x) -> a + x)"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    # an expression that isn't deterministic, always true: a filter on base_failed must not be pushed below
    # these projections, or it would inline the arrays into the lambdas that index them
    fence = F.monotonically_increasing_id() >= 0
    return d.withColumn("base_failed", failed & fence).drop("_t", "_w", "_l", "_h", "_b", "_m", "_s", "_p")


def line_hashes(docs: DataFrame) -> DataFrame:
    """(_row, _host, n, h), arrays with a place for each line: its words, and the hash of host and normalised line, null if nothing is left of it."""
    host = F.col("_host.h")
    lines = docs.select("_row", "_host", F.split(F.coalesce(F.col("text"), F.lit("")), "\n").alias("_l"))
    hashed = F.transform("_l", lambda x: F.when(x.rlike(r"[\p{L}\p{N}]"), F.xxhash64(normalised_line(x), host, host.isNull())))
    return lines.select("_row", "_host", F.transform("_l", lambda x: F.size(words(x))).alias("n"), hashed.alias("h"))


def removed_lines(lines: DataFrame, count: str = "documents", min_documents: int = MIN_LINE_DOCUMENTS, max_share: float = MAX_HOST_SHARE) -> DataFrame:
    """(_row, _at, n_line) of each line that is removed: its document's hash, its place and its words; lines as `line_hashes` makes them.

    A line is removed if over max(min_documents, max_share of the host's documents) documents of its
    host hold it. `count`: "documents" counts every row, "texts" rows of equal text once.
    """
    if count not in ("documents", "texts"):
        raise ValueError("count is documents or texts")
    counted = lines if count == "documents" else lines.groupBy("_row", "_host").agg(F.first("h").alias("h"))
    # a document holds a line once, however often; so what leaves a task is one number for each line it met
    held = counted.select("_host", F.explode(F.array_compact(F.array_distinct("h"))).alias("_line"))
    per_line = held.groupBy("_host", "_line").agg(F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") > min_documents)
    hosts = counted.groupBy("_host").agg(F.count(F.lit(1)).alias("host_docs"))
    frequent = stored(per_line.join(hosts, "_host").filter(F.col("n_docs") > max_share * F.col("host_docs")).select("_line", F.col("n_docs").alias("weight")))
    each = lines.select("_row", F.posexplode(F.arrays_zip("n", "h")).alias("_at", "_x")).select("_row", "_at", F.col("_x.n").alias("n_line"), F.col("_x.h").alias("_line"))
    each = each.filter("n_line > 0 AND _line IS NOT NULL").withColumn("_spread", F.monotonically_increasing_id())
    return join_known(each, frequent, "_line", "weight", "_spread").filter("known").select("_row", "_at", "n_line")


def quality_rules(docs: DataFrame, text: str = "text", host: str = "source", max_removed_share: float = MAX_REMOVED_SHARE, **limits) -> DataFrame:
    """docs with the counts, base_failed, kept, n_removed_lines and clean_text; see the module for edge cases.

    clean_text is the text without its removed lines; counts and base rules are of the text as it came.
    A document is depleted if clean_text lacks over max_removed_share of its words. Equal rows lose the
    same places, so they share one list of them.
    """
    results = (*RESULTS, *CLEAN)
    columns = [c for c in docs.columns if c not in results or c in (text, host)]
    others = [c for c in columns if c != text]
    docs = docs.select(row_of(others).alias("_doc"), name_of(text).alias("text"), F.struct(name_of(host).alias("h")).alias("_host"))
    docs = docs.withColumn("_row", F.xxhash64(F.xxhash64("text"), "_host.h", F.col("_host.h").isNull()))
    gone = removed_lines(stored(line_hashes(docs)), **limits).groupBy("_row").agg(F.collect_set(F.struct("_at", "n_line")).alias("_gone"))
    gone = gone.select(F.col("_row").alias("_r"), F.struct(F.expr("aggregate(_gone, 0L, (a, x) -> a + x.n_line)").alias("lost"), F.col("_gone._at").alias("places")).alias("_lost"))
    base = with_base_counts(docs.select("_doc", "text", "_row"), "text").withColumn("_spread", F.monotonically_increasing_id())
    judged = lookup(base, "_row", gone, "_r", "_lost", "_spread")
    depleted = F.coalesce(F.col("_lost.lost") > max_removed_share * F.col("n_words"), F.lit(False))
    judged = judged.withColumn("_lines", F.when(F.col("_lost").isNotNull(), F.split("text", "\n")))
    left = F.expr("array_join(transform(array_except(sequence(0, size(_lines) - 1), _lost.places), i -> _lines[i]), '\n')")
    judged = judged.withColumn(CLEAN_TEXT, F.when(F.col("_lost").isNotNull(), left).otherwise(F.col("text")))
    judged = judged.withColumn("n_removed_lines", F.coalesce(F.size("_lost.places"), F.lit(0)).cast("long"))
    judged = judged.withColumn("kept", ~F.col("base_failed") & ~depleted)
    back = {c: f for c, f in zip(others, fields("_doc", others), strict=True)} | {text: F.col("text").alias(text)}
    return judged.select(*(back[c] for c in columns), *(c for c in results if c not in columns))
