"""Dedup over a stream of sample files.

`first_seen` is exact dedup alone, with the seen set as Structured Streaming state. `clean_stream` is the
whole cleaning, exact and near dedup included: each batch of files is cleaned after what all batches
before it have seen and kept, which a SeenSet holds, and is added to it. A batch writes its rows first
and its state last, under its number: if it is run again after a failure, it is done over, or skipped if
its state is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import clean as C
from ..operators.near import written
from ..operators.seen import SeenSet
from ..sources import jsonl


def read_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema("question string, answer string").option("maxFilesPerTrigger", files_per_trigger).json(folder)


def first_seen(stream: DataFrame) -> DataFrame:
    """Rows whose question was never seen; state grows by one hash a distinct question, as the batch set does."""
    return stream.withColumn("q_md5", F.md5(F.coalesce("question", F.lit("")).cast("binary"))).dropDuplicates(["q_md5"])


def write_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return stream.writeStream.format("json").option("checkpointLocation", checkpoint).option("path", path).outputMode("append").trigger(availableNow=True).start()


def clean_stream(spark: SparkSession, folder: str, registry: DataFrame, cfg: C.CleanConfig, state: str, path: str, checkpoint: str, files_per_trigger: int = 100) -> StreamingQuery:
    """Cleans the files that are there and haven't been cleaned yet, batch after batch, into <path>/batch=<number>.

    Files come in the order of their times, a batch's rows in that of file and line; so first wins over
    the stream as it does over one table of all its batches.
    """

    def batch(rows: DataFrame, number: int) -> None:
        seen, tag = SeenSet(spark, state), f"batch {number}"
        if tag in seen.tags:
            return
        placed = written(rows.withColumn("_row", F.monotonically_increasing_id()))
        cleaned = written(C.clean(jsonl.with_seq(placed), registry, cfg, seen))
        kept = C.normalise(cleaned.filter("written" if cfg.cap is not None else "kept"))
        jsonl.write_jsonl(kept, f"{path}/batch={number}", order=["seq"])
        seen.add(cleaned, cfg.scope, tag)

    rows = jsonl.read_jsonl(spark, folder, keep_corrupt=True, stream={"maxFilesPerTrigger": files_per_trigger})
    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
