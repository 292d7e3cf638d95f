"""JSON-lines sources and sinks, with an order of rows that doesn't depend on partitions.

A row's place is its file, the split of the file that holds it, and its number there. `with_seq` turns
places into consecutive numbers: rows are counted by split, counts are summed in order of stage, file
and split, first within a file, then over files. Only the counts are ordered, never the rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from . import files

SAMPLE = "question string, answer string"
#: Files of a folder that are read: what others write, and what Spark's own writer does.
FILES = "*.{jsonl,json}"
#: Columns of a row's place: its file, its split and its number among the rows that a task has read.
PLACE = ("_path", "_block", "_row")


def _decoded(c: Column) -> Column:
    """Percent escapes as the characters they stand for."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def relative_name(spark: SparkSession, root: str) -> Column:
    """The file's path below root, by its metadata; its name alone if it isn't below."""
    base = files.qualified(spark, root).rstrip("/") + "/"
    # Hadoop and Spark write one or three slashes after a scheme without authority
    plain = lambda c: F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")
    path, base = plain(_decoded(F.col("_metadata.file_path"))), plain(F.lit(base))
    return F.when(F.startswith(path, base), F.substr(path, F.length(base) + 1)).otherwise(F.element_at(F.split(path, "/"), -1))


def folder_value(column: str) -> Column:
    """What a folder `column=value` of the relative name says, as Spark's writer escapes it; null if there is none."""
    value = F.regexp_extract("_name", f"(?:^|/){column}=([^/]*)/", 1)
    return F.when(~value.isin("", "__HIVE_DEFAULT_PARTITION__"), _decoded(value))


def _lines(spark: SparkSession, path: str, stream: dict | None = None) -> DataFrame:
    """(value, src_file, pair, _path, _block) of lines that aren't blank, of all files below the path; of a stream of them with the options in `stream`."""
    reader = spark.read if stream is None else spark.readStream.options(**stream)
    lines = reader.text(path, pathGlobFilter=FILES, recursiveFileLookup=True).withColumn("_name", relative_name(spark, path))
    named = {"src_file": F.coalesce(folder_value("src_file"), "_name"), "pair": folder_value("pair"), "_path": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start")}
    return lines.withColumns(named).drop("_name").filter(F.trim("value") != "")


def _not_text(fields: list[str]) -> Column:
    """The fields of a JSON object that hold another kind than text or null, by commas; null if none do."""
    kinds = [(f, F.schema_of_variant(F.try_variant_get(F.try_parse_json("value"), f"$.{f}", "variant"))) for f in fields]
    odd = F.array_compact(F.array(*[F.when(~kind.isin("STRING", "VOID"), F.lit(f)) for f, kind in kinds]))
    return F.when(F.size(odd) > 0, F.array_join(odd, ", "))


def read_jsonl(spark: SparkSession, path: str, schema: str = SAMPLE, keep_corrupt: bool = False, placed: bool = False, stream: dict | None = None) -> DataFrame:
    """Rows of a file, or of all files below a folder, of JSON lines, with `src_file` and `pair`.

    src_file is the file's path below the folder, or what a folder `src_file=value` says, and pair what a
    folder `pair=value` says. Blank lines are skipped, and so are lines that are no JSON object; if kept,
    those that are JSON of another kind stay, with the line in `corrupt`, and `not_text` names the fields
    of an object that hold a number, a list or another kind than text. `placed` adds the columns that
    with_seq numbers rows by. `stream`, options of a stream source, makes a stream of the files; its rows
    come without `_row`, which each batch adds.
    """
    lines = _lines(spark, path, stream)
    parsed = F.from_json("value", f"{schema}, corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"})
    named = [f.name for f in _parse_datatype_string(schema).fields if f.dataType.simpleString() == "string"]
    odd = [_not_text(named).alias("not_text")] if keep_corrupt else []
    other = F.try_parse_json("value").isNotNull() & ~F.startswith(F.ltrim("value"), F.lit("{"))
    df = lines.select(parsed.alias("x"), "src_file", "pair", "_path", "_block", *odd, other.alias("other"))
    df = df.select("x.*", "src_file", "pair", "_path", "_block", *["not_text"] * keep_corrupt, "other")
    if keep_corrupt:
        df = df.filter(F.col("other") | F.col("corrupt").isNull()).withColumn("corrupt", F.when(F.col("other"), F.coalesce("corrupt", F.lit("")))).drop("other")
    else:
        df = df.filter(F.col("corrupt").isNull()).drop("corrupt", "other")
    if stream is not None:
        return df
    # numbered last: the rows of a split have consecutive numbers
    return df.withColumn("_row", F.monotonically_increasing_id()) if placed else df.drop("_path", "_block")


def read_stage(spark: SparkSession, folder: str, stage: str, keep_corrupt: bool = False, placed: bool = False) -> DataFrame:
    """Rows of a stage's folder, tagged; a missing folder gives no rows."""
    try:
        return read_jsonl(spark, folder, keep_corrupt=keep_corrupt, placed=placed).withColumn("stage", F.lit(stage))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        more = ", _path string, _block long, _row long" * placed
        return spark.createDataFrame([], f"{SAMPLE}, {'corrupt string, not_text string, ' * keep_corrupt}src_file string, pair string, stage string{more}")


def with_seq(df: DataFrame) -> DataFrame:
    """df with seq, consecutive from 0 in order of (stage, src_file, path, split, line); df has the columns of PLACE, and is read twice."""
    of = [c for c in ("stage", "src_file") if c in df.columns] + ["_path"]
    split = [*of, "_block"]
    counts = df.groupBy(*split).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = lambda *by: Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = counts.withColumn("_inside", F.coalesce(F.sum("_n").over(before(*of)), F.lit(0)))
    whole = counts.groupBy(*of).agg(F.sum("_n").alias("_n"))  # one row a file
    ahead = Window.orderBy(*of).rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.withColumn("_ahead", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n")
    base = inside.join(whole, of).select(*split, "_first", (F.col("_ahead") + F.col("_inside")).alias("_base"))
    rows = df.join(base, split)
    return rows.select((F.col("_base") + F.col("_row") - F.col("_first")).alias("seq"), *[c for c in df.columns if c not in PLACE])


def write_jsonl(df: DataFrame, path: str, append: bool = False, by: str | None = None, order: list[str] | None = None) -> None:
    """question and answer as JSON lines; `by` names a column to make a folder for each value of, `order` the columns to sort the lines by.

    Ordered rows are cut by ranges of (by, order), so the parts of a folder, by name, hold its rows in order.
    """
    keys = [*[by] * (by is not None), *(order or [])]
    if order:
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    w = df.select("question", "answer", *[by] * (by is not None and by not in ("question", "answer"))).write.mode("append" if append else "overwrite")
    (w.partitionBy(by) if by else w).json(path)


def count_rows(spark: SparkSession, path: str) -> DataFrame:
    """(src_file, parsed, lines): rows that parse, and lines that aren't blank."""
    return _lines(spark, path).groupBy("src_file").agg(F.count_if(F.try_parse_json("value").isNotNull()).alias("parsed"), F.count(F.lit(1)).alias("lines"))
