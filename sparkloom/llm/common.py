"""Pieces that several corpus operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import time
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space between words: space and U+0009 to U+000D.
BLANKS = " \t\n\u000b\f\r"
BLANK_CLASS = r"[\x20\x09-\x0D]+"

#: Keys taken out of a shuffle join into a broadcast one; no other key can hold more than 1/HOT_KEYS of the rows.
HOT_KEYS = 1000

LAST_ID = (1 << 63) - 1


def words(text) -> F.Column:
    """Maximal runs of characters other than BLANKS; null and blank texts give an empty array."""
    text = F.col(text) if isinstance(text, str) else text
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK_CLASS))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir; set here only where a local session has none."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "/tmp/checkpoints"
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def kept(df: DataFrame, *partition_by: str):
    """(df written to the shared folder and read back, a function that deletes what was written or a part of it).

    The lineage ends there, and lost executors cost nothing.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)

    def drop(part: str = "") -> None:
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{part}".rstrip("/"))
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

    return spark.read.schema(df.schema).parquet(path), drop


def stored(df: DataFrame, *partition_by: str) -> DataFrame:
    """df written to the shared folder and read back."""
    return kept(df, *partition_by)[0]


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of queries that are over; results don't depend on it.

    They go when the driver has collected the queries' objects: first Python's, that hold the JVM's,
    and once no event names them. The second collection takes what the first one only made known.
    """
    gc.collect()
    with contextlib.suppress(Exception):  # a busy bus, or none
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(5_000)
    for _ in range(2):
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def name_of(column: str) -> F.Column:
    """The column of just that name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def row_of(columns: list[str]) -> F.Column:
    """The columns as one struct, so that no column made on the way has the name of one of them; `fields` takes them out."""
    spare = "_" * (1 + max([0, *map(len, columns)]))
    return F.struct(F.lit(0).alias(spare), *(name_of(c).alias(c) for c in columns))


def fields(row: str, columns: list[str]) -> list[F.Column]:
    return [F.col(row).getField(c).alias(c) for c in columns]


#: Caches that Python workers keep between tasks of one query; a task of another query empties them.
WARM: list = []


def given_back(run, keep: bool = False):
    """run, an iterator over batches, with the memory it no longer needs returned to the system at the task's end.

    Workers go on to other tasks, and what their allocators hold counts as an executor's memory.
    """

    def wrapped(batches):
        if not keep:
            empty_caches()
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


# Module-level functions, so that workers run them on their own module's state, not on a copy sent along.
def empty_caches() -> None:
    for cache in WARM:
        cache.clear()


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def whole_groups(batches, keys: int):
    """(table, starts) of whole groups, of batches sorted by their first columns; a group is never cut, so the largest bounds the memory."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        starts = group_starts(held, keys)
        if len(starts) > 1:
            yield held.slice(0, starts[-1]), starts[:-1]
            held = held.slice(starts[-1])
    if held is not None and held.num_rows:
        yield held, group_starts(held, keys)


def group_starts(t: pa.Table, keys: int) -> np.ndarray:
    new = np.zeros(t.num_rows, bool)
    new[:1] = True
    for k in range(keys):
        x = t.column(k).to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def join_known(rows: DataFrame, known: DataFrame, key: str, weight: str, spread: str) -> DataFrame:
    """rows left-joined with known, which has one row per key and the rows' number per key in `weight`.

    The HOT_KEYS heaviest keys go by broadcast (their number is fixed), the others by shuffle, where
    each holds under 1/HOT_KEYS of the rows. `spread` is a column that deals the hot rows evenly.
    Adds a boolean `known`; null keys match nothing.
    """
    hot = known.orderBy(F.desc(weight), key).limit(HOT_KEYS).select(F.col(key).alias("_hot"))
    marked = rows.join(F.broadcast(hot), rows[key] == hot["_hot"], "left")
    dealt = marked.withColumn("_cold", F.when(F.col("_hot").isNull() & F.col(key).isNotNull(), F.col(key)).otherwise(F.xxhash64(spread)))
    cold = known.select(F.col(key).alias("_cold"), F.lit(True).alias("_found"))
    found = F.coalesce(F.col("_found"), F.lit(False)) & F.col(key).isNotNull()
    return dealt.join(cold, "_cold", "left").withColumn("known", F.col("_hot").isNotNull() | found).drop("_hot", "_cold", "_found")


def lookup(rows: DataFrame, key: str, table: DataFrame, table_key: str, value: str, spread: str) -> DataFrame:
    """rows with `value` of the row of table that has their key, a long or a string, null if none; table has one row a key.

    Hot keys are dealt with as in join_known: the HOT_KEYS most frequent ones go by broadcast.
    """
    filler = F.xxhash64(spread)  # rows that need no join; a string's filler holds a control character that no key of ours has
    if isinstance(rows.schema[key].dataType, T.StringType):
        filler = F.concat(F.lit("\u0001"), filler.cast("string"))
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").orderBy(F.desc("_n"), key).limit(HOT_KEYS)
    t = table.select(F.col(table_key).alias("_key"), F.col(value).alias("_value"))
    hot = counts.select(F.col(key).alias("_hot")).join(t, F.col("_hot") == F.col("_key"), "left").select("_hot", F.col("_value").alias("_hot_value"))
    marked = rows.join(F.broadcast(hot), rows[key] == hot["_hot"], "left")
    cold_key = F.when(F.col("_hot").isNull() & F.col(key).isNotNull(), F.col(key)).otherwise(filler)
    out = marked.withColumn("_cold", cold_key).join(t, F.col("_cold") == F.col("_key"), "left")
    got = F.when(F.col("_hot").isNotNull(), F.col("_hot_value")).when(F.col(key).isNotNull(), F.col("_value"))
    return out.select(*rows.columns, got.alias(value))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node of an edge that isn't the least of its component; root is the least.

    Rounds of hooking each node onto its least neighbour, flattening the trees by pointer jumping and
    contracting the edges. Every node but local minima vanishes in a round, so there are O(log n)
    rounds. State is written to the shared folder after each step; nothing is collected.
    """
    e = stored(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a > b").distinct())
    labels = None
    while not e.isEmpty():
        p = stored(e.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node"))
        while True:
            up = stored(lookup(p, "root", p.withColumnRenamed("root", "next"), "node", "next", "node"))
            p = up.select("node", F.coalesce("next", "root").alias("root"))
            if up.filter("next IS NOT NULL").isEmpty():
                break
        p = stored(p)
        if labels is not None:
            old = lookup(labels, "root", p.withColumnRenamed("root", "next"), "node", "next", "node")
            labels = stored(old.select("node", F.coalesce("next", "root").alias("root")).unionByName(p))
        else:
            labels = p
        e = lookup(e, "a", p.withColumnRenamed("root", "ra"), "node", "ra", "b")
        e = lookup(e, "b", p.withColumnRenamed("root", "rb"), "node", "rb", "a")
        x, y = F.coalesce("ra", "a"), F.coalesce("rb", "b")
        e = stored(e.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).filter("a > b").distinct())
    return labels if labels is not None else e.select(F.col("a").alias("node"), F.col("b").alias("root"))
