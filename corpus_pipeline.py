"""Five stages from documents to token ids; each is one operator, written as Parquet and read again by the next.

Every stage but the last returns the columns of its documents, in their order, whatever they are called:
columns that an operator doesn't need travel as one struct, so its results take no name of theirs. n_chars,
where there is one, follows the text. The last stage returns all columns but the text, with n_tokens,
token_ids and round_trip in place of columns of these names.

Defined results: null and blank texts fail the base rules and go in the first stage, so none comes later
unless substring dedup leaves a document empty: then its text is empty, it has size zero and mixing drops
it. Rows that repeat an id and a text are one group of near duplicates, of which one stays; rows with
a null id stay if their group has no other id. Null sources are a source of their own. An empty table gives an
empty result with the same columns. The line rules count equal texts once here, since the next stage keeps
one of each group: a page is not to be lost altogether for having been copied.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import bpe, line_rules, mixing, recompress, simhash
from sparkloom.llm.common import fields, name_of, row_of, stored

RANKS = "byte_bpe_50k.tiktoken"
RESULTS = ("n_tokens", "token_ids", "round_trip")


def packed(docs: DataFrame, *needed: str) -> DataFrame:
    """The needed columns, and all others as one struct."""
    return docs.select(*needed, row_of([c for c in docs.columns if c not in needed]).alias("_row"))


def unpacked(df: DataFrame, docs: DataFrame, needed: tuple[str, ...], text: Column | None = None) -> DataFrame:
    """The columns of docs again; with the new text, if one is given, and its length."""
    others = [c for c in docs.columns if c not in needed]
    back = dict(zip(others, fields("_row", others), strict=True)) | {c: name_of(c) for c in needed}
    if text is not None:
        back["text"] = text.alias("text")
        if "n_chars" in docs.columns:
            back["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return df.select(*(back[c] for c in docs.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go, and from the others the lines above the limits."""
    needed = ("text", "source")
    out = line_rules.quality_rules(packed(docs, *needed), count="texts").filter("kept")
    return unpacked(out, docs, needed, F.col(line_rules.CLEAN_TEXT))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays."""
    return simhash.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows that an earlier document has go; a document may be left empty."""
    needed = ("doc_id", "text")
    return unpacked(recompress.remove_repeats(packed(docs, *needed), as_words=False), docs, needed, F.decode("kept", "UTF-8"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target wants it: rows go or repeat."""
    needed = ("doc_id", "text", "source")
    mixed = mixing.mix(packed(docs, *needed)).filter("copies > 0")
    each = mixed.select(*needed, "_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"))
    return unpacked(each, docs, needed)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, packed, of each row, and whether decoding them gives the text back."""
    path = public_tokenizers.path(RANKS)
    original = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("_sha256")
    back = bpe.encode_and_decode(packed(docs, "text").select("*", original), path, public_tokenizers.PATTERN)
    same = F.sha2("decoded", 256) == F.col("_sha256")
    others = [c for c in docs.columns if c != "text" and c not in RESULTS]
    return back.select(*fields("_row", others), "n_tokens", "token_ids", same.alias("round_trip"))


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("source mixing", source_mixing),
    ("byte bpe", byte_bpe),
]

#: SQL has no byte-pair merges; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
