"""Places in an order, without a task that sorts all rows or all of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import seeded
from .near import written

#: Hexadecimal digits of a seeded hash that make a bin.
DIGITS = 3


def shuffled(df: DataFrame) -> DataFrame:
    """df as a side of joins that grows with its table: shuffled, so that no round of an iteration sends it to the driver to be broadcast."""
    return df.hint("merge")


def prefix_sums(df: DataFrame, key: str | Column, value: str | Column, name: str = "ahead") -> DataFrame:
    """df with the sum of the values of all rows before it in the order of the key, which tells rows apart.

    Rows are sorted by ranges and summed within them; what is ordered in one place is one row for each range.
    """
    keys, value = [key] if isinstance(key, (str, Column)) else list(key), F.col(value) if isinstance(value, str) else value
    ranged = written(df.repartitionByRange(*keys).withColumn("_p", F.spark_partition_id()).withColumn("_v", value))
    own = Window.partitionBy("_p").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy().orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_p").agg(F.sum("_v").alias("_s"))
    sums = sums.select("_p", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_before"))
    out = ranged.join(F.broadcast(sums), "_p")  # one row a range
    return out.select(*df.columns, (F.col("_before") + F.coalesce(F.sum("_v").over(own), F.lit(0))).alias(name))


def numbered(df: DataFrame, *keys: str | Column, name: str = "place") -> DataFrame:
    """df with each row's place from 0 in the order of the keys, which tell rows apart."""
    return prefix_sums(df, keys, F.lit(1), name)


def placed_in_groups(df: DataFrame, by: list[str], seed: int) -> DataFrame:
    """df with _i, a row's place from 1 in its group in the seeded order of seq, and _n, the group's rows.

    Places are counted in two steps: rows ahead of a bin of the hash, from one row for each group and
    bin, and places within the bin. So a task orders 1 / 16**DIGITS of a group, however large that is.
    """
    s = df.withColumn("_h", seeded(seed, F.col("seq"))).withColumn("_b", F.conv(F.substring("_h", 1, DIGITS), 16, 10).cast("int"))
    per = s.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_c"))
    group = Window.partitionBy(*by)
    ahead = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_ahead", F.coalesce(F.sum("_c").over(ahead), F.lit(0))).withColumn("_n", F.sum("_c").over(group))
    per = per.select(*[F.col(c).alias(f"_by{k}") for k, c in enumerate(by)], F.col("_b").alias("_bin"), "_ahead", "_n")
    s = s.join(per, _same(by))
    place = F.col("_ahead") + F.row_number().over(Window.partitionBy(*by, "_b").orderBy("_h", "seq"))
    return s.withColumn("_i", place).select(*df.columns, "_i", "_n")


def _same(by: list[str]) -> Column:
    out = F.col("_b") == F.col("_bin")
    for i, c in enumerate(by):
        out &= F.col(c).eqNullSafe(F.col(f"_by{i}"))
    return out
