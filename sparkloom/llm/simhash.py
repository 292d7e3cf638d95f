"""SimHash near-dedup with a Gray-order hierarchical index.

Distinct fingerprints are searched, each with the smallest doc_id that has it, so exact and near-exact
copies cost one entry. Top of the hierarchy: masks of whole bit blocks. Of B blocks, B - 4 are equal in
two fingerprints that differ in at most 4 bits, so every choice of B - 4 blocks is a mask, and
fingerprints that share a masked pattern meet under one node. Below, a node's fingerprints are sorted
by Gray rank and grouped; a group stores the bits all its members share (mask and pattern), groups of
groups the bits these share. A search goes down with the number of differing bits so far, adds what
each child's further shared bits differ in, and drops the child with all below it beyond 4.

A node of more than CHUNK fingerprints is split into chunks, each pair of which is a task's worth. Each
node hands on only a spanning forest of its links; forests join in distributed connected components.

Defined results: words, shingles and bits as the functions say; null and blank texts have fingerprint
zero and link like any other; a null doc_id never is the smallest unless its component has no other,
and then component_id is null; rows that repeat a doc_id each get its component; an empty table gives
an empty result; input columns named like a result are replaced, all others pass through.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, fields, given_back, lookup, name_of, row_of, stored

SHINGLE = 4
SEED = 42
DISTANCE = 4
BITS = 64
#: Fingerprints of one node that one search takes; larger nodes are split.
CHUNK = 16_384
#: Members of a group at each level.
FANOUT = 16
#: Pairs of fingerprint and group looked at in one step.
STEP = 1 << 20
#: Up to so many distinct fingerprints, that many blocks.
BLOCKS = ((1 << 22, 5), (1 << 30, 6), (1 << 62, 7))
#: Rows of the search a partition gets, about.
ROWS = 200_000


def fingerprint(raw: bytes | None) -> int:
    """The SimHash of a text's UTF-8 bytes, as a signed 64-bit integer."""
    from xxhash import xxh64_intdigest

    words = raw.lower().split() if raw else []  # of bytes, both know ASCII only: A-Z; space and U+0009 to U+000D
    if not words:
        return 0
    if len(words) <= SHINGLE:
        h = [xxh64_intdigest(b" ".join(words), SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        line = b" ".join(words)
        starts = np.concatenate(([0], ends[:-SHINGLE] + 1)).tolist()
        h = [xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :].tolist(), strict=True)]
    bits = np.unpackbits(np.array(h, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
    ones = np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h)).view(">i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs with `fp`, a signed long, in place of the first column."""
    rest = docs.schema.fields[1:]

    def run(batches):
        for batch in batches:
            fp = pa.array([fingerprint(x.as_py()) for x in batch.column(0)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], fp], names=[*(f.name for f in rest), "fp"])

    return docs.mapInArrow(given_back(run), T.StructType([*rest, T.StructField("fp", T.LongType())]))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray sequence."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


def masks(n: int, distance: int = DISTANCE) -> list[int]:
    """Masks of whole blocks, one of which is equal in any two of n fingerprints within the distance."""
    blocks = next(b for most, b in BLOCKS if n <= most)
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(parts, blocks - distance)]


def _levels(fp: np.ndarray, node: np.ndarray):
    """Groups of FANOUT neighbours within each node, then groups of those, up to one per node.

    Each level: first child, number of children, shared-bit mask, pattern. `node` is sorted.
    """
    mask, pattern, of = np.full(len(fp), ~np.uint64(0)), fp, node
    out = []
    while True:
        heads = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        size = np.diff(np.concatenate((heads, [len(of)])))
        place = np.arange(len(of)) - np.repeat(heads, size)
        first = np.flatnonzero(place % FANOUT == 0)
        n = np.diff(np.concatenate((first, [len(of)])))
        shared = ~np.bitwise_or.reduceat(pattern ^ np.repeat(pattern[first], n), first) & np.bitwise_and.reduceat(mask, first)
        mask, pattern, of = shared, pattern[first] & shared, of[first]
        out.append((first, n, mask, pattern))
        if len(of) == len(heads):
            return out


def _expand(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... of n[i] numbers each, one after the other."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n - first, n)


def search(fp: np.ndarray, node: np.ndarray, distance: int = DISTANCE):
    """Arrays i, j of the links found, a slice at a time: fp[i] and fp[j] within the distance, of one node.

    fp is sorted by node and Gray rank. A search starts at the root of its own node.
    """
    levels = _levels(fp, node)
    top = levels[-1]
    root = np.repeat(np.arange(len(top[0])), np.diff(np.concatenate((np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1]))), [len(node)]))))
    at = 0
    while at < len(fp):
        until = min(len(fp), at + max(1, STEP // 64))
        q, g = np.arange(at, until), root[at:until]
        off = np.bitwise_count((fp[q] ^ top[3][g]) & top[2][g]).astype(np.int16)
        above = top[2]
        for k in range(len(levels) - 1, -1, -1):
            keep = off <= distance
            q, g, off = q[keep], g[keep], off[keep]
            first, n = levels[k][0][g], levels[k][1][g]
            child = _expand(first, n)
            q, parent_mask, off = np.repeat(q, n), np.repeat(above[g], n), np.repeat(off, n)
            if k:
                mask, pattern = levels[k - 1][2], levels[k - 1][3]
                off = off + np.bitwise_count((fp[q] ^ pattern[child]) & mask[child] & ~parent_mask)
                above = mask
            else:
                off = off + np.bitwise_count((fp[q] ^ fp[child]) & ~parent_mask)
            g = child
        keep = (off <= distance) & (q < g)
        yield q[keep], g[keep]
        at = until


def forest(n: int, links) -> np.ndarray:
    """root[i] for n things under links, given a slice at a time."""
    root = np.arange(n)
    for a, b in links:
        while len(a):
            x, y = root[a], root[b]
            low, high = np.minimum(x, y), np.maximum(x, y)
            apart = low < high
            a, b, low, high = a[apart], b[apart], low[apart], high[apart]
            np.minimum.at(root, high, low)
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root = up
    return root


def _links(batches):
    """Rows (group, fp) of whole groups in, edges (a, b) of a spanning forest of each group out."""
    tables = [pa.Table.from_batches([b]) for b in batches]
    if not tables:
        return
    t = pa.concat_tables(tables)
    group, fp = t.column("group").to_numpy(), t.column("fp").to_numpy().view(np.uint64)
    order = np.lexsort((gray_rank(fp), group))
    group, fp = group[order], fp[order]
    if len(fp):
        root = forest(len(fp), search(fp, group))
        apart = np.flatnonzero(root != np.arange(len(fp)))
        signed = fp.view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(signed[apart]), pa.array(signed[root[apart]])], names=["a", "b"])


def links(distinct: DataFrame) -> DataFrame:
    """(a, b): a forest of links among distinct fingerprints (a column fp, one row each)."""
    spark = distinct.sparkSession
    n = distinct.count()
    chosen = masks(n)
    ms = F.array(*[F.lit(m - (1 << BITS) if m >> (BITS - 1) else m) for m in chosen])
    rows = distinct.select("fp", F.posexplode(ms).alias("_m", "_mask")).select("fp", F.xxhash64("_m", F.col("fp").bitwiseAND(F.col("_mask"))).alias("group"))
    large = rows.groupBy("group").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > CHUNK).withColumnRenamed("group", "_g")
    rows = rows.join(large, rows["group"] == large["_g"], "left").withColumn("_k", F.coalesce(F.ceil(F.col("_n") / CHUNK), F.lit(1)).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("_k")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_k") - 1))
    rows = rows.withColumn("_c", own).withColumn("_o", other)
    group = F.when(F.col("_k") > 1, F.xxhash64("group", F.least("_c", "_o"), F.greatest("_c", "_o"))).otherwise(F.col("group"))
    rows = rows.select("fp", group.alias("group"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n * len(chosen) // ROWS)
    return rows.repartition(parts, "group").mapInArrow(given_back(_links), "a long, b long")


def components_of(fps: DataFrame) -> DataFrame:
    """(fp, root), one row a distinct fingerprint; root is the least of its component."""
    distinct = stored(fps.select("fp").distinct())
    roots = components(links(distinct))
    return lookup(distinct, "fp", roots.withColumnRenamed("root", "up"), "node", "up", "fp").select("fp", F.coalesce("up", "fp").alias("root"))


def near_duplicates(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """docs without the text, with fingerprint (16 hex digits) and component_id."""
    others = [c for c in docs.columns if c != text and (c not in ("fingerprint", "component_id") or c == ident)]
    fps = stored(fingerprints(docs.select(name_of(text).cast("binary"), name_of(ident).alias("_id"), row_of(others).alias("_row"))))
    placed = stored(lookup(fps.groupBy("fp").agg(F.min("_id").alias("low")), "fp", components_of(fps).withColumnRenamed("fp", "f"), "f", "root", "fp"))
    lows = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    named = stored(lookup(placed.select("fp", "root"), "root", lows.withColumnRenamed("root", "r"), "r", "component_id", "fp"))
    out = lookup(fps.withColumn("_spread", F.monotonically_increasing_id()), "fp", named.select(F.col("fp").alias("f"), "component_id"), "f", "component_id", "_spread")
    return out.select(*fields("_row", others), "component_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"))


def one_of_each(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """One row of each component: that with the smallest id, null ids last; of those with one id, that of the least hash of id and text.

    Of rows alike in id and text one stays, as of any other component.
    """
    key = F.xxhash64(name_of(ident), name_of(text))
    fps = stored(fingerprints(docs.select(name_of(text).cast("binary"), name_of(ident).alias("_id"), key.alias("_mark"))))
    each = fps.groupBy("_mark", "fp").agg(F.first("_id").alias("_id"), F.count(F.lit(1)).alias("n"))
    placed = stored(lookup(each, "fp", components_of(fps).withColumnRenamed("fp", "f"), "f", "root", "_mark"))
    first = placed.groupBy("root").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_mark")).alias("least")).select(F.col("root").alias("r"), F.col("least._mark").alias("stays"))
    judged = stored(lookup(placed, "root", first, "r", "stays", "_mark"))
    gone = judged.filter("_mark != stays").select("_mark").distinct()
    left = docs.select(row_of(docs.columns).alias("_row"), key.alias("_mark")).join(gone, "_mark", "left_anti")
    again = judged.filter("_mark = stays AND n > 1").select("_mark")
    if not again.isEmpty():  # rows alike in id and text: the first of each by the hash of all its columns
        order = Window.partitionBy("_mark").orderBy(F.xxhash64("_row"))
        alike = left.join(again, "_mark", "left_semi").withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")
        left = left.join(again, "_mark", "left_anti").unionByName(alike)
    return left.select(*fields("_row", docs.columns))
