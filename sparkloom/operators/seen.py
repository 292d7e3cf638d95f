"""Dedup state that outlives a run: what earlier runs have seen and accepted, in versions.

<path>/versions/<number>.json names the folder of a version's rows; it is written last, so a run that
breaks off adds nothing, and its rows are never read. A version holds what one run added: `keys`, the
digests of the questions that reached exact dedup, and `accepted`, label and question of the rows kept.
Versions are never changed, so readers may go on while a run adds one; of two runs that add the same
number the second fails.

Keys are joined, not collected: the new rows' keys against all stored ones. The new keys are the small
side, from which Spark makes a Bloom filter for the scan of the stored ones where that pays
(spark.sql.optimizer.runtime.bloomFilter).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files

#: Part of the sequence numbers that rows of earlier runs get in near dedup: all before those of this run.
BEFORE = -(1 << 62)


def question_key(scope: str | None = None) -> Column:
    """What exact dedup tells questions apart by, within the scope column if there is one."""
    key = F.md5(F.coalesce("question", F.lit("")).cast("binary"))
    return key if scope is None else F.md5(F.concat(key, F.lit(":"), F.coalesce(F.col(scope).cast("string"), F.lit("\u0001"))).cast("binary"))


class SeenSet:
    """The state at a path, as of the versions that were complete when it was opened."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.folders: list[str] = []
        self.tags: set[str | None] = set()
        while (text := files.read_text(spark, self._marker(len(self.folders) + 1))) is not None:
            version = json.loads(text)
            self.folders.append(version["folder"])
            self.tags.add(version.get("tag"))

    def _marker(self, number: int) -> str:
        return f"{self.path}/versions/{number:06d}.json"

    def _rows(self, kind: str, schema: str) -> DataFrame:
        if not self.folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}/{kind}" for f in self.folders])

    def fresh(self, samples: DataFrame, scope: str | None = None) -> DataFrame:
        """samples whose question no earlier run has seen."""
        if not self.folders:
            return samples
        keyed = samples.withColumn("_key", question_key(scope))
        met = self._rows("keys", "key string").join(keyed.select(F.col("_key").alias("key")).distinct(), "key").distinct()
        return keyed.join(met.withColumnRenamed("key", "_key"), "_key", "left_anti").drop("_key")

    def accepted(self) -> DataFrame:
        """(seq, question, answer) of the rows that earlier runs kept; numbers before any of this run, in no order of their own."""
        rows = self._rows("accepted", "question string, answer string")
        return rows.select((F.monotonically_increasing_id() + F.lit(BEFORE)).alias("seq"), "question", "answer")

    def add(self, cleaned: DataFrame, scope: str | None = None, tag: str | None = None) -> int:
        """Adds what a cleaning has seen and kept, as the next version; its number. cleaned is what `clean` returns, tag a name that `tags` then has."""
        from .clean import NEAR_COPY

        number, folder = len(self.folders) + 1, f"rows-{uuid.uuid4().hex}"
        met = cleaned.filter(F.col("kept") | (F.coalesce(F.col("reason"), F.lit("")) == NEAR_COPY))
        met.select(question_key(scope).alias("key")).distinct().sortWithinPartitions("key").write.parquet(f"{self.path}/{folder}/keys")
        cleaned.filter("kept").select("question", "answer").write.parquet(f"{self.path}/{folder}/accepted")
        if files.read_text(self.spark, self._marker(number)) is not None:
            raise RuntimeError(f"another run has added version {number}; clean again with the state as it is now")
        files.write_text(self.spark, self._marker(number), json.dumps({"folder": folder, "tag": tag}))
        self.folders.append(folder)
        self.tags.add(tag)
        return number
