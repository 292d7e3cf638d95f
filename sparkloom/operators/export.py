"""Records of the usual fine-tuning formats, as JSON text or rows, and their writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a default instruction; callers pass their own.
INSTRUCTION = "Choose the agent that should answer the question and reply with its name only."


def jsonl(df: DataFrame, keep: Sequence[str] = ("seq",)) -> DataFrame:
    return df.select(*keep, F.to_json(F.struct("question", "answer")).alias("record"))


def alpaca(df: DataFrame, instruction: str = INSTRUCTION, keep: Sequence[str] = ("seq",)) -> DataFrame:
    return df.select(*keep, F.to_json(F.struct(F.lit(instruction).alias("instruction"), F.col("question").alias("input"), F.col("answer").alias("output"))).alias("record"))


def sharegpt(df: DataFrame, system: str = INSTRUCTION, keep: Sequence[str] = ("seq",)) -> DataFrame:
    said = lambda who, what: F.struct(F.lit(who).alias("from"), F.col(what).alias("value"))
    return df.select(*keep, F.to_json(F.struct(F.lit(system).alias("system"), F.array(said("human", "question"), said("gpt", "answer")).alias("conversations"))).alias("record"))


def openai_chat(df: DataFrame, system: str = INSTRUCTION, keep: Sequence[str] = ("seq",)) -> DataFrame:
    said = lambda who, what: F.struct(F.lit(who).alias("role"), what.alias("content"))
    turns = F.array(said("system", F.lit(system)), said("user", F.col("question")), said("assistant", F.col("answer")))
    return df.select(*keep, F.to_json(F.struct(turns.alias("messages"))).alias("record"))


def csv_field(c: Column) -> Column:
    """Quoted where it holds a comma, quote or line break, with quotes doubled."""
    return F.when(c.rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)


def csv_rows(df: DataFrame, keep: Sequence[str] = ("seq",)) -> DataFrame:
    return df.select(*keep, F.concat(csv_field(F.coalesce("question", F.lit(""))), F.lit(","), csv_field(F.coalesce("answer", F.lit("")))).alias("record"))


FORMATS = {"jsonl": jsonl, "alpaca": alpaca, "sharegpt": sharegpt, "openai": openai_chat, "csv": csv_rows}


#: What opens a file of records, stands before all but the first, and closes it; records of a JSON array stand a line each.
ARRAY, CSV = ("[", ",", "]"), ("\ufeffquestion,answer\r", "", None)


def order_of(df: DataFrame) -> list[str]:
    """The columns that files are sorted by: the seeded `place`, if rows have one, then seq."""
    return [c for c in ("place", "seq") if c in df.columns]


def write_records(df: DataFrame, fmt: str, path: str, around: tuple[str, str, str | None] | None = None) -> None:
    """Records as text files in a folder, in order, by all tasks; its parts, one after the other by name, are the file.

    One record a line but for CSV's quoted line breaks. `around` makes them a JSON array or a CSV with its header.
    """
    keys = order_of(df)
    rows = FORMATS[fmt](df, keep=keys)
    if fmt == "csv":
        rows = rows.withColumn("record", F.concat("record", F.lit("\r")))
    if around is None:
        rows.sort(*keys).select("record").write.mode("overwrite").text(path)
        return
    opening, between, closing = around
    least = rows.agg(F.min(F.struct(*keys)).alias("_least"))  # one row, without a value if there are no records
    rows = rows.join(F.broadcast(least)).withColumn("record", F.when(F.struct(*keys) == F.col("_least"), F.col("record")).otherwise(F.concat(F.lit(between), "record")))
    ends = [(k, text) for k, text in ((0, opening), (2, closing)) if text is not None]
    edge = df.sparkSession.createDataFrame(ends, "_part int, record string")
    out = rows.withColumn("_part", F.lit(1)).select("_part", *keys, "record").unionByName(edge, allowMissingColumns=True)
    out.sort("_part", *keys).select("record").write.mode("overwrite").text(path)


def write_array(df: DataFrame, fmt: str, path: str) -> None:
    """One JSON array over the folder's parts."""
    write_records(df, fmt, path, ARRAY)


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV with byte order mark and header over the folder's parts."""
    write_records(df, "csv", path, CSV)


def export_all(df: DataFrame, folder: str, prefix: str = "dataset") -> dict[str, str]:
    """All six formats from one cached input; format to folder."""
    df = df.persist()
    try:
        out = {f: f"{folder}/{prefix}_{f}.{e}" for f, e in (("jsonl", "jsonl"), ("json", "json"), ("csv", "csv"), ("alpaca", "json"), ("sharegpt", "json"), ("openai", "jsonl"))}
        for f in ("jsonl", "openai"):
            write_records(df, f, out[f])
        write_array(df, "jsonl", out["json"])
        write_array(df, "alpaca", out["alpaca"])
        write_array(df, "sharegpt", out["sharegpt"])
        write_csv(df, out["csv"])
        return out
    finally:
        df.unpersist()


def write_splits(split: DataFrame, folder: str) -> dict[str, dict[str, str]]:
    """For each split JSONL, Alpaca and ShareGPT records; OpenAI chat for train alone."""
    out: dict[str, dict[str, str]] = {}
    for name in ("train", "val", "test"):
        part = split.filter(F.col("split") == name)
        out[name] = {f: f"{folder}/{name}/{name}_{f}" for f in ("jsonl", "alpaca", "sharegpt", *["openai"] * (name == "train"))}
        for f, path in out[name].items():
            write_records(part, f, path)
    return out
