"""Embedding near-dedup by a subspace pigeonhole join.

Vectors of one label are compared as unit vectors, where a cosine is a squared distance: |u - v|^2 =
2 - 2 cos. They are rotated by a fixed random rotation, which spreads any difference evenly over the
coordinates, and cut into blocks of BLOCK coordinates. If a squared distance is within the limit, that
of some block is within the block's share of the limit (its share of the coordinates). So each block is
range-joined on its own under its budget, and what any of them finds is verified on whole vectors in
double precision. A pair that several blocks find belongs to the first of them; block distances are
integers (coordinates are rounded to 1/UNIT, the budget is widened by that), so all tasks agree on
which that is, and links are counted where they are found: no list of pairs is shuffled.

The range join: a label of more than CELL vectors is cut into cells along a block's coordinates. A
vector goes to its own cell and, as a guest, to those before it that its budget reaches. Inside a
cell vectors are ordered by median cuts, and tiles of TILE are compared where their boxes come near.
Cells of more than CHUNK are split into chunks, each pair of which is a task's worth. Each task hands
on its vectors' link counts and a spanning forest, which join in distributed connected components.

Equal vectors of a label are one entry with their number. Vectors and labels are known by 128-bit
BLAKE2b digests.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and those
with a null label, link with nothing and are their own component; vectors of different lengths never
link; null ids link like any other, but are never the smallest unless the component has no other, and
then component_id and kept are null; rows that repeat an id each get their links, and each counts;
an empty table gives an empty result; input columns named like a result are replaced, all others but
the vector pass through.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ann import _bare, usable
from .common import components, fields, given_back, lookup, name_of, row_of, stored, whole_groups
from .simhash import forest

COSINE = 0.93
BLOCK = 8
#: Rotated coordinates are rounded to 1/UNIT.
UNIT = 1 << 14
#: A label's vectors in one cell, about; more are cut in 2, 4 and so on along the block's coordinates.
CELL = 16_384
#: At most so many halvings of a block's coordinates, each up to thrice.
LEVELS = 3
#: Vectors of one cell that one task takes; larger cells are split.
CHUNK = 16_384
TILE = 512
#: Pairs verified at once.
STEP = 1 << 15
#: What single precision may miss of a squared distance in a block.
SLACK = 2e-5
#: Vectors that cuts are chosen by, at most; they decide how the work is cut, not its result.
SAMPLE = 8192
#: Rows a partition of the join gets, about.
ROWS = 50_000
RESULTS = ("n_links", "component_id", "kept")
GROUP = ("ha", "hb", "block", "cell", "ci", "cj")


def edges(d: int) -> list[int]:
    return [*range(0, d, BLOCK), d]


@functools.lru_cache(maxsize=4)
def rotation(d: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))[0]


def budgets(d: int, cosine: float) -> list[int]:
    """Each block's most squared distance, in units of 1/UNIT^2, with room for the rounding of coordinates."""
    share = lambda a, b: (2 - 2 * cosine) * (b - a) / d
    return [int(((share(a, b) + 1e-12) ** 0.5 * UNIT + (b - a) ** 0.5 + 1) ** 2) for a, b in zip(edges(d), edges(d)[1:], strict=False)]


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(float)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def rounded(u: np.ndarray) -> np.ndarray:
    return np.rint(u @ rotation(u.shape[1]) * UNIT).astype(np.int16)


def _digest(*parts: bytes) -> bytes:
    h = hashlib.blake2b(digest_size=16)
    for p in parts:
        h.update(p)
    return h.digest()


def _keyed(batches):
    """(row, id, label text, vector) in; (row, id, key, ha, hb, vector's bytes) out: key of label and vector, ha and hb of label and length."""
    for b in batches:
        label, v = b.column(2).to_pylist(), b.column(3)
        ends, parts = v.offsets.to_numpy(), v.values.to_numpy(zero_copy_only=False)
        parts = parts + parts.dtype.type(0)  # no negative zeros
        key, group, raw = [], [], []
        for i, x in enumerate(v.is_valid().to_pylist()):
            if not x or label[i] is None:
                key.append(None), group.append((None, None)), raw.append(None)
                continue
            raw.append(parts[ends[i] : ends[i + 1]].tobytes())
            name = label[i].encode("utf-8", "surrogatepass")
            key.append(_digest(len(name).to_bytes(8, "little"), name, raw[-1]).hex())
            group.append(np.frombuffer(_digest((ends[i + 1] - ends[i]).tobytes(), name), np.int64).tolist())
        out = [b.column(0), b.column(1), pa.array(key, pa.string()), pa.array([g[0] for g in group], pa.int64()), pa.array([g[1] for g in group], pa.int64()), pa.array(raw, pa.binary())]
        yield pa.RecordBatch.from_arrays(out, names=["_row", "_id", "key", "ha", "hb", "vector"])


def halvings(s: int, width: int) -> list[int]:
    """How often each coordinate of a block is halved, of s halvings in all."""
    return [min(LEVELS, s // width + (i < s % width)) for i in range(width)]


def cells(x: np.ndarray, s: int, cuts: np.ndarray, reach: float):
    """(row, cell, whether it is the row's own): each row's cell and those before it within `reach`, a squared distance."""
    row, code, off, own = np.arange(len(x)), np.zeros(len(x), np.int64), np.zeros(len(x)), np.zeros(len(x), np.int64)
    for i, times in enumerate(halvings(s, x.shape[1])):
        if times:
            c = cuts[i][(1 << (LEVELS - times)) - 1 :: 1 << (LEVELS - times)]
            low, high = np.concatenate(([-np.inf], c)), np.concatenate((c, [np.inf]))
            v = x[row, i, None]
            gap = off[:, None] + np.maximum(0, np.maximum(low - v, v - high)) ** 2
            at, j = np.nonzero(gap <= reach)
            row, code, off = row[at], (code[at] << times) + j, gap[at, j]
            own = (own << times) + np.searchsorted(c, x[:, i], side="right")
    keep = code <= own[row]
    row, code = row[keep], code[keep]
    return row, code, code == own[row]


def _placed(cosine: float, cuts: dict, size: int):
    """(node, n, ha, hb, halvings, vector's bytes) in; a row for each block and cell out."""

    def run(batches):
        for b in batches:
            node, n, s = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 4))
            length = np.array([len(x) for x in b.column(5).to_pylist()], np.int64) // size
            for d in np.unique(length).tolist():
                at = np.flatnonzero(length == d)
                raw = b.column(5).take(pa.array(at))
                q = rounded(unit(_vectors(raw, d, size)))
                codes = pa.array([x.tobytes() for x in q], pa.binary())
                limit = budgets(d, cosine)
                for k, (lo, hi) in enumerate(zip(edges(d), edges(d)[1:], strict=False)):
                    for times in np.unique(s[at]).tolist():
                        mine = np.flatnonzero(s[at] == times)
                        if times and d in cuts:
                            row, cell, own = cells(q[mine, lo:hi].astype(float), times, cuts[d][lo:hi], limit[k] + 1)
                        else:
                            row, cell, own = np.arange(len(mine)), np.zeros(len(mine), np.int64), np.ones(len(mine), bool)
                        inner = pa.array(mine[row])
                        there = pa.array(at[mine[row]])
                        m = len(row)
                        for a in range(0, m, 10_000):
                            z = slice(a, min(m, a + 10_000))
                            take = lambda c, z=z, there=there: c.take(there[z])
                            yield pa.RecordBatch.from_arrays(
                                [take(b.column(2)), take(b.column(3)), pa.array(np.full(z.stop - a, k, np.int32)), pa.array(cell[z]), pa.array(own[z]), take(b.column(0)), take(b.column(1)), raw.take(inner[z]), codes.take(inner[z])],
                                names=["ha", "hb", "block", "cell", "own", "node", "n", "vector", "codes"],
                            )

    return run


def _vectors(raw: pa.Array, d: int, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw.to_pylist()), np.float32 if size == 4 else np.float64).reshape(-1, d)


def tiles(x: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """rows in sets of at most TILE near each other: halved at the median of the widest coordinate."""
    todo, out = [rows], []
    while todo:
        r = todo.pop()
        if len(r) <= TILE:
            out += [r] if len(r) else []
            continue
        y = x[r]
        by = y[:, (y.max(axis=0) - y.min(axis=0)).argmax()]
        order = np.argpartition(by, len(r) // 2)
        todo += [r[order[: len(r) // 2]], r[order[len(r) // 2 :]]]
    return out


class Cell:
    """Vectors of one group, and the links that its block owns."""

    def __init__(self, u: np.ndarray, q: np.ndarray, k: int, cosine: float):
        self.u, self.q, self.k, self.cosine = u, q, k, cosine
        self.cuts, self.limit = edges(q.shape[1]), budgets(q.shape[1], cosine)
        self.r = q.astype(np.float32) / np.float32(UNIT)
        self.budget = [x / UNIT**2 for x in self.limit]
        self.x = self.r[:, self.cuts[k] : self.cuts[k + 1]]

    def block(self, j: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Squared distances of rows a and b in block j, but for SLACK."""
        x, y = self.r[a, self.cuts[j] : self.cuts[j + 1]], self.r[b, self.cuts[j] : self.cuts[j + 1]]
        return (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)

    def between(self, a: np.ndarray, b: np.ndarray, same: bool):
        """Arrays i, j of links of rows a and rows b, a slice at a time; same: a is b, and each pair counts once."""
        near = self.block(self.k, a, b) <= self.budget[self.k] + SLACK
        if same:
            near &= np.tri(len(a), k=-1, dtype=bool)
        n = int(near.sum())
        if n > STEP:  # a dense part: first leave out what earlier blocks surely own and what is surely too far
            for j in range(self.k):
                near &= self.block(j, a, b) > self.budget[j] - SLACK
            near &= self.u[a] @ self.u[b].T >= self.cosine - 1e-9
        i, j = np.nonzero(near)
        i, j = a[i], b[j]
        for at in range(0, len(i), STEP):
            x, y = i[at : at + STEP], j[at : at + STEP]
            linked = np.einsum("ij,ij->i", self.u[x], self.u[y]) >= self.cosine
            x, y = x[linked], y[linked]
            gap = self.q[x].astype(np.int64) - self.q[y]
            within = np.add.reduceat(gap * gap, self.cuts[:-1], axis=1) <= np.array(self.limit)
            mine = within[:, self.k] & ~within[:, : self.k].any(axis=1)
            yield x[mine], y[mine]

    def join(self, a: np.ndarray, b: np.ndarray | None = None):
        """Links among rows a, or between rows a and rows b."""
        left = tiles(self.x, a)
        right = left if b is None else tiles(self.x, b)
        if not left or not right:
            return
        low, high = (np.stack([f(self.x[r], axis=0) for r in right]) for f in (np.min, np.max))
        for s, r in enumerate(left):
            gap = np.maximum(0, np.maximum(low - self.x[r].max(axis=0), self.x[r].min(axis=0) - high))
            close = np.flatnonzero((gap * gap).sum(axis=1) <= self.budget[self.k] + SLACK)
            for t in close.tolist():
                if b is not None or t <= s:
                    yield from self.between(r, right[t], b is None and t == s)


def _links(cosine: float, size: int):
    """Rows of whole groups in; (node, links, root) of the nodes that have links out: root of a spanning forest of the group's links."""

    def run(batches):
        for t, starts in whole_groups(batches, len(GROUP)):
            ends = [*starts[1:].tolist(), t.num_rows]
            block, ci, cj = (t.column(c).to_numpy() for c in ("block", "ci", "cj"))
            own, chunk, node, n = (t.column(c).to_numpy() for c in ("own", "chunk", "node", "n"))
            for a, z in zip(starts.tolist(), ends, strict=True):
                if z - a < 2 or not own[a:z].any():
                    continue
                raw = t.column("codes").slice(a, z - a).to_pylist()
                d = len(raw[0]) // 2
                q = np.frombuffer(b"".join(raw), np.int16).reshape(-1, d)
                cell = Cell(unit(_vectors(t.column("vector").slice(a, z - a), d, size)), q, int(block[a]), cosine)
                own_, chunk_, node_, n_ = own[a:z], chunk[a:z], node[a:z], n[a:z]
                links = np.zeros(z - a, np.int64)
                some = lambda o, c: np.flatnonzero((own_ == o) & (chunk_ == c))
                i, j = int(ci[a]), int(cj[a])
                if i == j:
                    parts = [(some(True, i), None), (some(True, i), some(False, i))]
                else:
                    parts = [(some(True, i), some(True, j)), (some(True, i), some(False, j)), (some(False, i), some(True, j))]

                def found(cell=cell, parts=parts, links=links, n_=n_):
                    for p, q in parts:
                        for x, y in cell.join(p, q):
                            np.add.at(links, x, n_[y])
                            np.add.at(links, y, n_[x])
                            yield x, y

                root = forest(z - a, found())
                has = np.flatnonzero(links)
                if len(has):
                    yield pa.RecordBatch.from_arrays([pa.array(node_[has]), pa.array(links[has]), pa.array(node_[root[has]])], names=["node", "links", "root"])

    return run


def _cuts(entries: DataFrame, size: int) -> dict:
    """{length: cuts of each rotated coordinate at its eighths}, of a sample of the most frequent length among large labels."""
    d = entries.groupBy(F.length("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first().d
    raw = [r.vector for r in entries.filter(F.length("vector") == d).select("vector").orderBy(F.xxhash64("vector")).limit(SAMPLE).collect()]
    q = rounded(unit(_vectors(pa.array(raw), d // size, size)))
    return {d // size: np.quantile(q, np.arange(1, 1 << LEVELS) / (1 << LEVELS), axis=0).T}


def near_duplicates(vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE) -> DataFrame:
    """vectors without the vector, with n_links (rows linked directly), component_id and kept."""
    spark = vectors.sparkSession
    others = [c for c in vectors.columns if c != vector and (c not in RESULTS or c == ident)]
    single = _bare(vectors.schema[vector].dataType) == T.ArrayType(T.FloatType())
    kind, size = ("array<float>", 4) if single else ("array<double>", 8)
    text = name_of(label) + F.lit(0.0) if isinstance(vectors.schema[label].dataType, (T.FloatType, T.DoubleType)) else name_of(label)
    asked = vectors.select(row_of(others).alias("_row"), name_of(ident).cast("long").alias("_id"), text.cast("string").alias("_label"), name_of(vector).alias("_v")).withColumn("_v", F.when(usable("_v"), F.col("_v").cast(kind)))
    schema = T.StructType([asked.schema["_row"], *T._parse_datatype_string("_id long, key string, ha long, hb long, vector binary").fields])
    rows = stored(asked.mapInArrow(given_back(_keyed), schema).withColumn("_spread", F.monotonically_increasing_id()))
    entries = rows.filter("key IS NOT NULL").groupBy("key").agg(F.min("_id").alias("low"), F.count(F.lit(1)).alias("n"), *(F.first(c).alias(c) for c in ("ha", "hb", "vector")))
    entries = stored(entries.withColumn("node", F.monotonically_increasing_id()))
    # labels of more than CELL entries: entries / CELL at most
    large = entries.groupBy("ha", "hb").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > CELL).select("ha", "hb", F.least(F.ceil(F.log2(F.col("_n") / CELL)), F.lit(BLOCK * LEVELS)).cast("int").alias("halvings"))
    marked = entries.join(F.broadcast(large), ["ha", "hb"], "left").select("node", "n", "ha", "hb", F.coalesce("halvings", F.lit(0)).alias("halvings"), "vector")
    big = marked.filter("halvings > 0")
    cuts = {} if big.isEmpty() else _cuts(big, size)
    place = lambda df: df.mapInArrow(given_back(_placed(cosine, cuts, size)), "ha long, hb long, block int, cell long, own boolean, node long, n long, vector binary, codes binary")
    placed = place(marked).withColumn("_k", F.lit(1))
    if cuts:
        crowded = stored(place(big).groupBy("ha", "hb", "block", "cell").agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > CHUNK))  # rows / CHUNK at most
        chunks = F.coalesce(F.ceil(F.col("_c") / CHUNK), F.lit(1)).cast("int")
        placed = place(marked).join(F.broadcast(crowded), ["ha", "hb", "block", "cell"], "left").withColumn("_k", chunks).drop("_c")
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("_k")).cast("int"))
    placed = placed.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_k") - 1))).withColumn("ci", F.least("chunk", "_o")).withColumn("cj", F.greatest("chunk", "_o"))
    placed = placed.select(*GROUP, "own", "chunk", "node", "n", "vector", "codes")
    each = entries.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.length("vector")), F.lit(0)).alias("most")).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), each.n * -(-each.most // (size * BLOCK)) // ROWS)
    found = stored(placed.repartition(parts, *GROUP).sortWithinPartitions(*GROUP).mapInArrow(given_back(_links(cosine, size)), "node long, links long, root long"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = entries.select("key", "node", "low", "n").join(links, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = stored(named.withColumn("links", F.coalesce("links", F.lit(0)) + F.col("n") - 1))
    lows = named.groupBy("root").agg(F.min("low").alias("least")).withColumnRenamed("root", "r")
    known = lookup(named, "root", lows, "r", "least", "node").select("key", F.struct("links", "least").alias("_known"))
    out = lookup(rows.drop("vector", "ha", "hb"), "key", known.withColumnRenamed("key", "k"), "k", "_known", "_spread")
    alone = F.col("key").isNull()
    component = F.when(alone, F.col("_id")).otherwise(F.col("_known.least"))
    return out.select(*fields("_row", others), F.when(alone, F.lit(0)).otherwise(F.col("_known.links")).cast("long").alias("n_links"), component.alias("component_id"), (F.col("_id") == component).alias("kept"))
