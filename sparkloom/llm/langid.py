"""Language ID: word-first backoff.

A known word scores by its log frequency in each language; a word never learned falls back to its
character n-grams, the longest length of which any gram is known, and to the next shorter one
otherwise. Word and gram counts come from DataFrame aggregations over the labelled rows.

The only bound is a parameter: the fit uses about `sample_rows` labelled rows (all, if fewer), chosen
by a hash of the row. Every count of those rows is kept, whatever its language. That model is what is
collected, as Arrow columns, and broadcast; nothing else is.

Defined results: a text that is null or has no letter gets `und` with score 0; so does every text if
no row is labelled; ties between languages go to the smaller code; very long texts are counted whole;
rows are scored one by one, so repeated rows agree; an empty table gives an empty result. Input
columns named like a result are replaced, all others pass through.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WARM, empty_caches, fields, given_back, name_of, row_of

SAMPLE_ROWS = 20_000
GRAM_LENGTHS = (5, 4, 3, 2, 1)
UNKNOWN = "und"
NEARLY_LETTERS = re.compile(r"[^\W\d_]+").findall
#: Added to each count.
SMOOTHING = 0.5


class Scorer:
    """Log frequencies by language, as rows of one matrix of words and one of grams."""

    def __init__(self, languages: list[str], words: pa.Table, grams: pa.Table):
        self.languages = languages
        self.words, self.word_logs = self.indexed(words)
        self.grams, self.gram_logs = self.indexed(grams)

    def count(self, text: str) -> Counter:
        """Runs of letters in lower case, and how often each occurs."""
        counts = Counter(NEARLY_LETTERS(text.lower()))
        for w in [w for w in counts if not w.isalpha()]:  # has numerals that are no decimal digits
            n = counts.pop(w)
            for part in "".join(c if c.isalpha() else " " for c in w).split():
                counts[part] += n
        return counts

    def indexed(self, counts: pa.Table) -> tuple[dict[str, int], np.ndarray]:
        tokens = counts.column("token").combine_chunks().dictionary_encode()
        m = np.full((len(tokens.dictionary), len(self.languages)), SMOOTHING)
        if counts.num_rows:
            of = np.searchsorted(np.array(self.languages, object), counts.column("lang").to_numpy())
            m[tokens.indices.to_numpy(), of] += counts.column("n").to_numpy()
        return {w: i for i, w in enumerate(tokens.dictionary.to_pylist())}, np.log(m / m.sum(axis=0))

    def backoff(self, word: str) -> list[int]:
        """Rows of the word's grams of the longest length of which any is known."""
        marked, get = f"<{word}>", self.grams.get
        for n in GRAM_LENGTHS:
            found = [g for i in range(len(marked) - n + 1) if (g := get(marked[i : i + n])) is not None]
            if found:
                return found
        return []

    def predict(self, text: str | None) -> tuple[str, float]:
        words = self.count(text) if text else None
        if not words or not self.languages:
            return UNKNOWN, 0.0
        at = list(map(self.words.get, words))
        n = np.fromiter(words.values(), float, len(words))
        known = np.array([i is not None for i in at])
        total = n[known] @ self.word_logs[[i for i in at if i is not None]] if known.any() else np.zeros(len(self.languages))
        parts, times = [], []
        for w, i, k in zip(words, at, words.values(), strict=True):
            if i is None and (found := self.backoff(w)):
                parts += found
                times += [k / len(found)] * len(found)
        if parts:
            total = total + np.array(times) @ self.gram_logs[parts]
        p = np.exp(total - total.max())
        best = int(total.argmax())
        return self.languages[best], float(p[best] / p.sum())


def _counts(tokens: DataFrame) -> pa.Table:
    """(token, lang, n), one row for each that occurs, in a fixed order."""
    return tokens.groupBy("token", "lang").agg(F.sum("n").alias("n")).toArrow().sort_by([("token", "ascending"), ("lang", "ascending")])


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS):
    """(languages, word counts, gram counts), every count of at most about sample_rows labelled rows."""
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    share = sample_rows / max(1, rows.select("lang").count())
    if share < 1:
        rows = rows.filter(F.pmod(F.xxhash64("text", "lang"), F.lit(1 << 30)) < int(share * (1 << 30)))
    words = rows.select("lang", F.explode(F.expr(r"regexp_extract_all(lower(text), '[\\p{L}]+', 0)")).alias("token")).groupBy("lang", "token").agg(F.count(F.lit(1)).alias("n"))
    words = words.persist()
    try:
        known = _counts(words)
        marked = words.withColumn("token", F.concat(F.lit("<"), "token", F.lit(">")))
        lengths = F.array(*map(F.lit, GRAM_LENGTHS))
        grams = marked.withColumn("k", F.explode(lengths)).filter("length(token) >= k")
        grams = grams.withColumn("token", F.explode(F.expr("transform(sequence(1, length(token) - k + 1), i -> substring(token, i, k))")))
        parts = _counts(grams)
        languages = sorted({r.lang for r in words.select("lang").distinct().collect()})
    finally:
        words.unpersist()
    return languages, known, parts


#: The scorer of the query a worker was last at, by the query's key.
SCORERS: dict = {}
WARM.append(SCORERS)


def _scorer(key: str, shared) -> Scorer:
    if key not in SCORERS:
        empty_caches()
        SCORERS[key] = Scorer(*shared.value)
    return SCORERS[key]


def identify(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """docs with lang_pred and score, the share of the best language among all."""
    results = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    passed = [c for c in docs.columns if c not in ("lang_pred", "score") or c == text]
    docs = docs.select(name_of(text).alias("_text"), row_of(passed).alias("_row"))
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches):
        scorer = _scorer(key, shared)
        for batch in batches:
            got = [scorer.predict(x.as_py()) for x in batch.column(0)]
            arrays = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(1), *arrays], names=["_row", "lang_pred", "score"])

    out = docs.mapInArrow(given_back(run, keep=True), T.StructType([docs.schema["_row"], *results]))
    return out.select(*fields("_row", passed), "lang_pred", "score")


def is_held_out(doc_id) -> F.Column:
    """Of four parts by the CRC-32 of the id as text, number 2; a null id isn't held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
