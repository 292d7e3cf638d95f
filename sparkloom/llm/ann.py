"""Approximate nearest neighbours by largest inner product: an inverted file with product-quantised residuals.

Equal vectors are one entry, with the smallest ids that have it: a search for k neighbours can return
no other of them, since ties go to the smaller id. Coarse centroids and codebooks are fitted on a
sample of at most `sample_rows` entries (a parameter); every entry is indexed: its list, and the codes
of its residual. A query's inner product with an entry is that with the list's centroid plus the sum
of table entries, one table row for each subspace, built from the exact query. An entry's sum is off
by at most the query's norm times the norm of what the codes leave of its residual, which is stored
with it. Every entry of the probed lists whose sum and that bound reach the k-th best is reranked on
the original vectors in double precision, however many they are; that is done beside the lists, so
only the k + 1 best of a task leave it. Of the probed lists no true neighbour is lost.

How many lists a search probes is calibrated on the sample: as many as hold TARGET of the true
neighbours there. A search goes on through further lists while those probed hold fewer entries than
it must return. Lists are split by a hash, so a large one is many tasks' work.

Defined results: vectors that are null, zero, empty or hold null or non-finite components take no
part, nor do rows with a null id, nor vectors of another length than the most frequent one (the
smaller, in a tie); with fewer candidates than k all are returned; ties go to the smaller id; repeated
ids may be returned once for each of their vectors; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import given_back, stored
from .repeats import heads_of

NEIGHBOURS = 20
#: Entries the fit may use.
SAMPLE_ROWS = 65_536
#: Share of true neighbours whose lists a search must probe, on the sample.
TARGET = 0.99
#: Components of a subspace, and codes of one.
SUB, CODES = 2, 256
#: Sample entries for each list, at least: lists grow with the root of the table, up to SAMPLE_ROWS / LIST_SAMPLE.
LIST_SAMPLE = 16
#: Components are clipped there for the index alone, since single precision ends not far beyond; the error bounds tell.
HUGE = 1e15
ROUNDS = 8
#: Entries of one list that one task takes, about.
PIECE = 65_536
#: Queries whose lists are chosen at once, so that queries times lists stay small.
PROBED = 256


def usable(vector: str) -> F.Column:
    """Not null, finite throughout and not zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Centroids (k, d) by Lloyd's rounds from a random start; an empty one moves to a random point."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        near = nearest(x, c)
        n = np.bincount(near, minlength=k)
        order = np.argsort(near, kind="stable")
        full = np.flatnonzero(n)
        heads = np.cumsum(n)[full] - n[full]
        c[full] = np.add.reduceat(x[order], heads, axis=0) / n[full, None]
        empty = np.flatnonzero(n == 0)
        c[empty] = x[rng.choice(len(x), len(empty))]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The nearest centroid of each row, by Euclidean distance."""
    half = (c * c).sum(axis=1) / 2
    out = np.empty(len(x), np.int64)
    for a in range(0, len(x), 4096):
        out[a : a + 4096] = (x[a : a + 4096] @ c.T - half).argmax(axis=1)
    return out


class Index:
    """Centroids, codebooks and the number of lists to probe."""

    def __init__(self, sample: np.ndarray, n: int, neighbours: int):
        d = sample.shape[1]
        sample = single(sample)
        self.lists = max(1, min(round(n**0.5 / 2), len(sample) // LIST_SAMPLE))
        self.centroids = kmeans(sample, self.lists, ROUNDS, 1)
        self.cuts = list(range(0, d, SUB)) + [d]
        residual = sample - self.centroids[nearest(sample, self.centroids)]
        self.books = [kmeans(np.ascontiguousarray(residual[:, a:b]), CODES, ROUNDS, 2 + a) for a, b in zip(self.cuts, self.cuts[1:], strict=False)]
        self.probes = self._calibrated(sample, neighbours)

    def _calibrated(self, sample: np.ndarray, neighbours: int) -> int:
        q = sample[:: max(1, len(sample) // 256)]
        scores = q @ sample.T
        k = min(neighbours + 1, len(sample))
        top = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        place = np.empty((len(q), self.lists), np.int64)
        np.put_along_axis(place, np.argsort(-(q @ self.centroids.T), axis=1, kind="stable"), np.arange(self.lists)[None, :], axis=1)
        needed = np.sort(np.take_along_axis(place, nearest(sample, self.centroids)[top], axis=1).ravel())
        return int(needed[min(len(needed) - 1, int(TARGET * len(needed)))]) + 1

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lists, codes, and by how much a table sum can be off for a query of norm 1, single precision included."""
        s = single(x)
        of = nearest(s, self.centroids)
        residual = s - self.centroids[of]
        codes = [nearest(np.ascontiguousarray(residual[:, a:b]), c).astype(np.uint8) for a, b, c in zip(self.cuts, self.cuts[1:], self.books, strict=False)]
        coded = self.centroids[of].astype(float) + np.concatenate([c[k] for c, k in zip(self.books, codes, strict=True)], axis=1)
        norm = lambda v: np.sqrt((v.astype(float) ** 2).sum(axis=1))
        terms = 2 * norm(self.centroids[of]) + norm(x) + norm(x - coded)
        return of, np.stack(codes, axis=1), norm(x - coded) + (x.shape[1] + 64) * 2e-7 * terms

    def table(self, q: np.ndarray) -> np.ndarray:
        """(queries, subspaces, codes): inner products of the queries' parts with each code."""
        return np.stack([q[:, a:b] @ c.T for a, b, c in zip(self.cuts, self.cuts[1:], self.books, strict=False)], axis=1)


def single(x: np.ndarray) -> np.ndarray:
    return np.clip(x, -HUGE, HUGE).astype(np.float32)


def scaled(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Queries with a largest component of 1, in single precision, and what they were divided by: their neighbours are the same."""
    by = np.abs(q.astype(float)).max(axis=1)
    return (q / by[:, None]).astype(np.float32), by


def vectors_of(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _bare(kind: T.DataType) -> T.DataType:
    return T.ArrayType(kind.elementType) if isinstance(kind, T.ArrayType) else kind


def _entries(vectors: DataFrame, ident: str, vector: str, copies: int, kind: str) -> DataFrame:
    """(entry, ids, vector): one row for each distinct vector, with its smallest ids."""
    v = vectors.filter(F.col(ident).isNotNull() & usable(vector)).select(F.col(ident).cast("long").alias("id"), F.col(vector).cast(kind).alias("vector"))
    length = v.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).select("d")
    v = v.join(F.broadcast(length), F.size("vector") == F.col("d")).drop("d")
    # the limit on the row number reaches the tasks before the shuffle, so a hot vector sends few rows
    first = v.withColumn("_r", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).filter(F.col("_r") <= copies)
    return first.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("entry"), "ids", "vector")


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, ident: str = "vec_id", vector: str = "embedding", k: int = NEIGHBOURS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of vectors found for each row of queries, its own id left out."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    # single precision stays as it is; all else is taken as double, and so are queries of a finer kind
    plain = T.ArrayType(T.FloatType())
    kind = "array<float>" if all(_bare(df.schema[vector].dataType) == plain for df in (vectors, queries)) else "array<double>"
    entries = stored(_entries(vectors, ident, vector, k + 1, kind))
    n = entries.count()
    if not n:
        return spark.createDataFrame([], schema)
    share = sample_rows / n
    sample = entries if share >= 1 else entries.filter(F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) < int(share * (1 << 30)))
    d = entries.select(F.size("vector")).first()[0]
    rows = sample.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(2 * sample_rows).toArrow().column(0).combine_chunks()
    index = Index(vectors_of(rows, d) if len(rows) else np.array([entries.first().vector]), n, k)
    shared = spark.sparkContext.broadcast(index)

    def place(batches):
        for b in batches:
            of, codes, off = shared.value.encode(vectors_of(b.column(1), d))
            packed = pa.array([c.tobytes() for c in codes], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(of, pa.int32()), packed, pa.array(off), b.column(1)], names=["entry", "list", "codes", "off", "vector"])

    coded = stored(entries.select("entry", "vector").mapInArrow(given_back(place), f"entry long, list int, codes binary, off double, vector {kind}"))
    sizes = np.zeros(index.lists, np.int64)
    for r in coded.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect():  # one row a list, at most sample_rows / LIST_SAMPLE
        sizes[r.list] = r.n
    q = queries.filter(F.col(ident).isNotNull() & usable(vector) & (F.size(vector) == d)).select(F.col(ident).cast("long").alias("query_id"), F.col(vector).cast(kind).alias("q"))
    q = stored(q.withColumn("query", F.monotonically_increasing_id()))
    pieces = np.maximum(1, -(-sizes // PIECE))

    def probe(batches):
        for batch in batches:
            for b in (batch.slice(a, PROBED) for a in range(0, batch.num_rows, PROBED)):
                x = vectors_of(b.column(1), d)
                order = np.argsort(-(scaled(x)[0] @ shared.value.centroids.T), axis=1, kind="stable")
                seen = np.cumsum(sizes[order], axis=1) - sizes[order]
                take = (np.arange(index.lists)[None, :] < index.probes) | (seen < k + 1)
                row, at = np.nonzero(take)
                lists = order[row, at]
                times = pieces[lists]
                row, lists = np.repeat(row, times), np.repeat(lists, times)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), pa.array(lists, pa.int32()), pa.array(piece, pa.int32()), b.column(1).take(pa.array(row))], names=["query", "list", "piece", "q"])

    asked = q.select("query", "q").mapInArrow(given_back(probe), f"query long, list int, piece int, q {kind}")
    size_of = F.array(*map(F.lit, pieces.tolist()))
    filed = coded.withColumn("piece", F.pmod(F.xxhash64("entry"), size_of[F.col("list")]).cast("int"))
    both = filed.select("list", "piece", F.lit(None).cast("long").alias("query"), F.col("vector").alias("q"), "entry", "codes", "off")
    both = both.unionByName(asked.select("list", "piece", "query", "q", F.lit(None).cast("long").alias("entry"), F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("off")))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // PIECE)

    def scan(batches):
        yield from _scan(batches, shared.value, d, k + 1)

    best = both.repartition(parts, "list", "piece").mapInArrow(given_back(scan), "query long, entry long, score double")
    near = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    best = best.withColumn("_r", F.row_number().over(near)).filter(F.col("_r") <= k + 1).select("query", "entry", "score")
    found = best.join(entries.select("entry", "ids"), "entry").join(q.select("query", "query_id"), "query")
    found = found.select("query", "query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id != query_id")
    exact = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(exact)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _scan(batches, index: Index, d: int, most: int):
    """Rows of entries and of queries by list and piece in; the `most` best entries of each query here out, with exact scores."""
    of_entry, of_query, entry, codes, off, x, query, q = [], [], [], [], [], [], [], []
    for b in batches:
        is_query = b.column(2).is_valid().to_numpy(zero_copy_only=False)
        key = b.column(0).to_numpy().astype(np.int64) << 32 | b.column(1).to_numpy().astype(np.int64)
        ask, file = b.filter(pa.array(is_query)), b.filter(pa.array(~is_query))
        of_query.append(key[is_query])
        of_entry.append(key[~is_query])
        query.append(ask.column(2).to_numpy(zero_copy_only=False).astype(np.int64))
        q.append(vectors_of(ask.column(3), d))
        entry.append(file.column(4).to_numpy(zero_copy_only=False).astype(np.int64))
        codes.append(np.frombuffer(b"".join(file.column(5).to_pylist()), np.uint8).reshape(-1, len(index.books)))
        off.append(file.column(6).to_numpy(zero_copy_only=False).astype(float))
        x.append(vectors_of(file.column(3), d))
    if not query or not sum(map(len, query)) or not sum(map(len, entry)):
        return
    of_entry, of_query, entry, codes, off, x, query, q = map(np.concatenate, (of_entry, of_query, entry, codes, off, x, query, q))
    order = np.argsort(of_entry, kind="stable")
    of_entry, entry, codes, off, x = of_entry[order], entry[order], codes[order], off[order], x[order]
    names, at = np.unique(query, return_index=True)
    for a in range(0, len(names), 128):  # so many queries' tables at once
        some = names[a : a + 128]
        exact = q[at[a : a + 128]]
        asked, scale = scaled(exact)
        table, norms = index.table(asked), np.sqrt((asked.astype(float) ** 2).sum(axis=1)) * (1 + 1e-6)
        bar = np.full(len(some), -np.inf)  # `most` entries of the query score so much at least
        held = [(np.empty(0), np.empty(0, np.int64)) for _ in some]
        mine = np.flatnonzero(np.isin(query, some))
        mine = mine[np.argsort(of_query[mine], kind="stable")]
        cuts = np.flatnonzero(heads_of(of_query[mine]))
        for u, v in zip(cuts, [*cuts[1:], len(mine)], strict=True):
            key = of_query[mine[u]]
            lo, hi = np.searchsorted(of_entry, [key, key + 1])
            if lo == hi:
                continue
            who = np.searchsorted(some, query[mine[u:v]])
            base = asked[who] @ index.centroids[key >> 32]
            for c in range(lo, hi, 1 << 13):
                block = slice(c, min(hi, c + (1 << 13)))
                near = np.repeat(base[:, None], block.stop - c, axis=1)
                for m in range(codes.shape[1]):
                    near += table[who, m][:, codes[block, m]]
                slack = norms[who, None] * off[None, block]
                bar[who] = np.maximum(bar[who], _least_of_best(near - slack, most))
                row, column = np.nonzero(~(near + slack < bar[who, None]))
                score = np.empty(len(row))
                for e in range(0, len(row), 1 << 16):
                    score[e : e + (1 << 16)] = _exact(exact, x, who[row[e : e + (1 << 16)]], c + column[e : e + (1 << 16)])
                ends = np.searchsorted(row, np.arange(len(who) + 1))
                for r, w in enumerate(who.tolist()):
                    some_of = slice(ends[r], ends[r + 1])
                    got, ids = np.concatenate([held[w][0], score[some_of]]), np.concatenate([held[w][1], entry[c + column[some_of]]])
                    keep = np.lexsort((ids, -got))[:most]
                    held[w] = got[keep], ids[keep]
                    if len(keep) == most:
                        bar[w] = max(bar[w], got[keep[-1]] / scale[w])
        out = [(np.full(len(ids), some[w]), ids, got) for w, (got, ids) in enumerate(held) if len(ids)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query", "entry", "score"])


def _least_of_best(low: np.ndarray, most: int) -> np.ndarray:
    """The `most`-th largest of each row; minus infinity if a row has fewer, or one that is no number."""
    if low.shape[1] < most:
        return np.full(len(low), -np.inf)
    return np.partition(np.where(np.isfinite(low), low, -np.inf), low.shape[1] - most, axis=1)[:, low.shape[1] - most]


def _exact(q: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of q[i] and x[j] in double precision, added from the first component to the last."""
    left, right = q[i], x[j]
    total = np.zeros(len(i))
    for m in range(q.shape[1]):
        total += left[:, m].astype(float) * right[:, m]
    return total
