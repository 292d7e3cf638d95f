"""The distributed course that finding repeated substrings takes, whatever the units.

1. announce: each task marks its documents. A mark is a hash that equal windows share; most marks
   occur once and prove their windows unique. A task sends a mark once, however many of its own
   documents have it (these learn at once that it is shared), so a hot mark makes one row a task.
   The digest of a whole document goes the same way, and finds exact copies.
2. answer: by mark, whether it is shared; by whole document, all but the first are copies.
3. probe: documents meet the marks they share with others. Windows under shared marks are compared
   within the task first; only the first of equals is sent on.
4. resolve: what is equal is settled exactly, in the scheme's own way.
5. settle: documents meet the removed ranges.

Rows travel packed, many marks in one binary, and partitions are as many as the input's bytes ask
for. A row is known by a hash of its id and text, so rows that repeat both get the same result, and
rows that repeat an id alone, or have none, are told apart. State between steps is written to the
shared folder. Nothing is collected.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LAST_ID, fields, given_back, kept, name_of, release, row_of

U = np.uint64
#: Bytes of (compressed) input for each partition of marks.
PARTITION_BYTES = 16 << 20
#: No input is larger; larger estimates are Spark's stand-in for none.
UNKNOWN_BYTES = 1 << 52
#: Marks a task holds before it sends them.
HELD = 1 << 20
#: Bytes of text worked on at once; longer documents are worked on alone.
SLICE = 1 << 18

ROW = "bucket int, kind int, a binary, b binary, c binary, d binary, e binary, f binary"
ROW_NAMES = ["bucket", "kind", "a", "b", "c", "d", "e", "f"]


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def packed_rows(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of ROW: bucket, kind and up to six arrays or binaries."""
    full = [(int(r[0]), int(r[1]), *(x.tobytes() if isinstance(x, np.ndarray) else x for x in r[2:]), *[None] * (8 - len(r))) for r in rows]
    return _batch(full, ROW_NAMES, [pa.int32(), pa.int32(), *[pa.binary()] * 6])


def by_bucket(bucket: np.ndarray):
    """(bucket, places) for each bucket that occurs."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    heads = np.flatnonzero(heads_of(bucket[order]))
    for a, b in zip(heads, [*heads[1:], len(order)], strict=True):
        yield int(bucket[order[a]]), order[a:b]


def heads_of(*keys: np.ndarray) -> np.ndarray:
    """True where sorted keys differ from the row before."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def covered(doc: np.ndarray, starts: np.ndarray, width: int):
    """(document, begin, end) of the disjoint ranges that windows at the starts cover."""
    order = np.lexsort((starts, doc))
    doc, starts = doc[order], starts[order]
    new = heads_of(doc)
    new[1:] |= starts[1:] > starts[:-1] + width
    last = np.append(np.flatnonzero(new)[1:] - 1, len(doc) - 1) if len(doc) else np.zeros(0, int)
    return doc[new], starts[new], starts[last] + width


def merged(ranges: np.ndarray) -> np.ndarray:
    """Flat [begin, end) ranges in any order, as disjoint ones that don't touch."""
    r = ranges.reshape(-1, 2)
    r = r[np.argsort(r[:, 0], kind="stable")]
    reach = np.maximum.accumulate(r[:, 1])
    new = np.concatenate(([True], r[1:, 0] > reach[:-1])) if len(r) else np.zeros(0, bool)
    last = np.concatenate((new[1:], [True])) if len(r) else new
    return np.stack((r[new, 0], reach[last]), axis=1)


def roots_of(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), U).reshape(-1, 2)


def slices(raws: list[bytes], most: int = SLICE):
    """(first, end) of runs of documents of about `most` bytes."""
    at = held = 0
    for i, r in enumerate(raws):
        held += len(r)
        if held >= most:
            yield at, i + 1
            at, held = i + 1, 0
    if at < len(raws):
        yield at, len(raws)


class Announcer:
    """Step 1 for one task."""

    def __init__(self, scheme, parts: int):
        self.scheme, self.parts = scheme, parts
        self.clear()

    def clear(self):
        self.keys, self.ids, self.roots, self.marks, self.owners, self.alone, self.n, self.held = [], [], [], [], [], [], 0, 0

    def add(self, keys: np.ndarray, ids: np.ndarray, raws: list[bytes]):
        for a, b in slices(raws):
            marks, owner, again = self.scheme.marks(raws[a:b])
            self.marks.append(marks)
            self.owners.append(owner + self.n)
            self.alone.append(~again)
            self.keys.append(keys[a:b])
            self.ids.append(ids[a:b])
            self.roots += [self.scheme.root(r) for r in raws[a:b]]
            self.n += b - a
            self.held += len(marks) + b - a

    def rows(self) -> list[tuple]:
        out: list[tuple] = []
        if not self.n:
            return out
        keys, ids, roots = np.concatenate(self.keys), np.concatenate(self.ids), roots_of(self.roots)
        marks, owner, alone = map(np.concatenate, (self.marks, self.owners, self.alone))
        full = np.flatnonzero(roots.any(axis=1))
        order = full[np.lexsort((ids[full], roots[full, 1], roots[full, 0]))]
        new = heads_of(roots[order, 0], roots[order, 1])
        first = ids[order[new]][np.cumsum(new) - 1] if len(order) else ids[:0]
        copy = np.zeros(self.n, bool)
        copy[order[ids[order] > first]] = True
        at, gone = order[new], np.flatnonzero(copy)
        self._send(out, 2, roots[at, 0], keys[at], ids[at], roots[at, 0], roots[at, 1])
        self._send(out, 3, keys[gone].astype(U), keys[gone], roots[gone, 0], roots[gone, 1])
        live = ~copy[owner]  # a copy's windows are settled by its first
        marks, owner, alone = marks[live], owner[live], alone[live]
        order = np.argsort(marks, kind="stable")
        marks, owner, alone = marks[order], owner[order], alone[order]
        new = heads_of(marks)
        heads = np.flatnonzero(new)
        size = np.diff(np.concatenate((heads, [len(marks)])))
        single = (size == 1) & np.bitwise_and.reduceat(alone, heads) if len(heads) else new
        told = np.where(single, keys[owner[heads]], -1) if len(heads) else keys[:0]
        self._send(out, 0, marks[heads], told, marks[heads])
        shared = np.flatnonzero(~np.repeat(single, size))
        self._send(out, 1, keys[owner[shared]].astype(U), keys[owner[shared]], marks[shared])
        return out

    def _send(self, out: list, kind: int, by: np.ndarray, *columns: np.ndarray):
        out += [(b, kind, *(c[i] for c in columns)) for b, i in by_bucket(by % U(self.parts))]


def announce(scheme, parts: int):
    def run(batches):
        task = Announcer(scheme, parts)
        for batch in batches:
            keys, ids = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            task.add(keys, ids, [x.as_py() for x in batch.column(2)])
            if task.held > HELD:
                yield packed_rows(task.rows())
                task.clear()
        yield packed_rows(task.rows())

    return run


def gathered(batches) -> dict[int, list[list[bytes]]]:
    """ROW batches by kind, as columns a to f."""
    kinds: dict[int, list[list[bytes]]] = defaultdict(lambda: [[] for _ in range(6)])
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(1, 8)]
        for kind, *values in zip(*columns, strict=True):
            for held, v in zip(kinds[kind], values, strict=True):
                held.append(v)
    return kinds


def joined(parts: list[bytes], dtype) -> np.ndarray:
    return np.frombuffer(b"".join(parts), dtype)


def answer(parts: int):
    """Step 2. Rows of kind 0: a keys, b marks of theirs that are shared; of kind 1: a keys, b roots of copies."""

    def run(batches):
        kinds = gathered(batches)
        keys, marks = joined(kinds[0][0], np.int64), joined(kinds[0][1], U)
        order = np.argsort(marks, kind="stable")
        keys, marks = keys[order], marks[order]
        heads = np.flatnonzero(heads_of(marks))
        if len(heads):
            size = np.diff(np.concatenate((heads, [len(marks)])))
            shared = np.repeat((size > 1) | (np.minimum.reduceat(keys, heads) < 0), size) & (keys >= 0)
            keys, marks = keys[shared], marks[shared]
        keys, marks = np.concatenate((keys, joined(kinds[1][0], np.int64))), np.concatenate((marks, joined(kinds[1][1], U)))
        out = [(k, 0, keys[i], marks[i]) for k, i in by_bucket(keys.astype(U) % U(parts))]
        keys, ids, high, low = joined(kinds[2][0], np.int64), joined(kinds[2][1], np.int64), joined(kinds[2][2], U), joined(kinds[2][3], U)
        order = np.lexsort((ids, low, high))
        keys, ids, high, low = keys[order], ids[order], high[order], low[order]
        new = heads_of(high, low)
        later = ids > ids[new][np.cumsum(new) - 1] if len(ids) else new
        keys = np.concatenate((keys[later], joined(kinds[3][0], np.int64)))
        roots = np.stack((np.concatenate((high[later], joined(kinds[3][1], U))), np.concatenate((low[later], joined(kinds[3][2], U)))), axis=1)
        out += [(k, 1, keys[i], roots[i]) for k, i in by_bucket(keys.astype(U) % U(parts))]
        yield packed_rows(out)

    return run


def told(batches):
    """Rows (key, marks, copies), one a key."""
    kinds = gathered(batches)
    got: dict[int, list[bytes]] = {}
    for kind, width in ((0, 1), (1, 2)):
        keys, values = joined(kinds[kind][0], np.int64), joined(kinds[kind][1], U).reshape(-1, width)
        for _, i in by_bucket(keys):
            got.setdefault(int(keys[i[0]]), [b"", b""])[kind] = values[i].tobytes()
    yield _batch([(k, *v) for k, v in got.items()], ["_heard", "marks", "copies"], [pa.int64(), pa.binary(), pa.binary()])


def compressed(docs: DataFrame) -> DataFrame:
    """docs with `_z`, the compressed bytes of the first column, in its place: texts are shuffled twice, at under half the size."""
    others = docs.schema.fields[1:]

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3, write_content_size=True).compress
        for batch in batches:
            z = pa.array([pack(x.as_py() or b"") for x in batch.column(0)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], z], names=[*(f.name for f in others), "_z"])

    return docs.mapInArrow(given_back(run), T.StructType([*others, T.StructField("_z", T.BinaryType())]))


def probe(scheme, parts: int, owners: int):
    """Step 3. Rows of kind 0 are outcomes, by key; those of other kinds are the scheme's, for resolve."""

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            keys, ids, raws, marks, copies = (batch.column(k) for k in range(5))
            docs, settled = [], []
            for k, raw in enumerate(raws):
                raw = unpack(raw.as_py())
                root = scheme.root(raw)
                copied, found = copies[k].as_py(), marks[k].as_py()
                if root in (copied[i : i + 16] for i in range(0, len(copied), 16)):
                    settled.append((keys[k].as_py(), root, np.array([0, scheme.units(raw)], np.int64)))
                elif found:
                    docs.append((keys[k].as_py(), ids[k].as_py(), root, raw, np.frombuffer(found, U)))
            for a, b in slices([d[3] for d in docs], scheme.compared):
                at_once, sent = scheme.probe(docs[a:b], parts, owners)
                yield packed_rows(outcomes([(docs[a + k][0], docs[a + k][2], r) for k, r in at_once], parts) + sent)
            yield packed_rows(outcomes(settled, parts))

    return run


DOC = np.dtype([("key", np.int64), ("id", np.int64), ("root", "V16")])


def doc_table(docs: list[tuple], used: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(places of `used` in the table, the table): 32 bytes a document, key, id and root."""
    slots, at = np.unique(used, return_inverse=True)
    return at.astype(np.uint32), b"".join(np.array(docs[s][:2], np.int64).tobytes() + docs[s][2] for s in slots.tolist())


def read_tables(tables: list[bytes], slots: list[bytes]):
    """(document of each row, keys, ids, roots) with documents numbered through all tables."""
    table = np.frombuffer(b"".join(tables), DOC)
    offset = np.cumsum([0, *(len(t) // DOC.itemsize for t in tables)])
    parts = [np.frombuffer(s, np.uint32).astype(np.int64) + o for s, o in zip(slots, offset[:-1], strict=True)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64), table["key"], table["id"], table["root"]


def outcomes(settled: list[tuple], parts: int) -> list[tuple]:
    """ROW tuples of kind 0 from (key, root, flat ranges): a keys, b roots, c ranges, one of each a range."""
    if not settled:
        return []
    n = np.array([len(r) // 2 for _, _, r in settled])
    keys = np.repeat(np.array([k for k, _, _ in settled], np.int64), n)
    roots = np.repeat(roots_of([bytes(r) for _, r, _ in settled]), n, axis=0)
    return range_rows(keys, roots, np.concatenate([r for _, _, r in settled]).reshape(-1, 2), parts)


def range_rows(keys: np.ndarray, roots: np.ndarray, ranges: np.ndarray, parts: int) -> list[tuple]:
    """ROW tuples of kind 0, from a row a range."""
    return [(b, 0, keys[i], roots[i], ranges[i]) for b, i in by_bucket(keys.astype(U) % U(parts))]


def collated(batches):
    """Rows (key, found), one a key: records of root and range."""
    a, b, c = gathered(batches)[0][:3]
    keys, rows = joined(a, np.int64), np.concatenate((joined(b, U).reshape(-1, 2), joined(c, U).reshape(-1, 2)), axis=1)
    yield _batch([(int(keys[i[0]]), rows[i].tobytes()) for _, i in by_bucket(keys)], ["_found_key", "_found"], [pa.int64(), pa.binary()])


def dealt(rows: DataFrame, parts: int, run, schema: str = ROW) -> DataFrame:
    """run over rows dealt by their buckets, a partition each."""
    return rows.repartitionById(parts, F.col("bucket")).mapInArrow(given_back(run), schema)


def removed_ranges(docs: DataFrame, scheme) -> DataFrame:
    """(_found_key, _found), one row a key: records of root and range, in the scheme's units, that go from the rows with that key and root.

    docs has _text, _key and _id.
    """
    spark = docs.sparkSession
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size > UNKNOWN_BYTES:  # Spark has no figure, as for rows from Python
        size = docs.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    # tasks there are as many as the session wants at least; what all tasks send to all is split by size alone
    owners = max(1, size // PARTITION_BYTES)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), owners)
    marks = docs.select("_key", "_id", "_text").mapInArrow(given_back(announce(scheme, parts)), ROW)
    heard = dealt(dealt(marks, parts, answer(parts)), parts, told, "_heard long, marks binary, copies binary")
    texts = compressed(docs.select("_text", "_key", "_id"))
    probes, drop = kept(texts.join(heard, F.col("_key") == F.col("_heard")).select("_key", "_id", "_z", "marks", "copies").mapInArrow(given_back(probe(scheme, parts, owners)), ROW), "kind")
    release(spark)
    every = scheme.resolve(probes.select(*ROW_NAMES), parts, owners, drop)
    return dealt(every, parts, collated, "_found_key long, _found binary")


def settle(docs: DataFrame, scheme, text: str, ident: str, results: list[T.StructField]) -> DataFrame:
    """Step 5: docs with the scheme's results, long or binary, in place of the text."""
    names = [f.name for f in results]
    others = [c for c in docs.columns if c != text and (c not in names or c == ident)]
    key = F.xxhash64(name_of(ident), name_of(text)).bitwiseAND(F.lit(LAST_ID)).alias("_key")
    order = F.coalesce(name_of(ident).cast("long"), F.lit(LAST_ID)).alias("_id")
    body = F.coalesce(name_of(text).cast("binary"), F.lit(b"")).alias("_text")
    found = removed_ranges(docs.select(body, key, order), scheme)
    d = compressed(docs.select(body, key, row_of(others).alias("_row")))
    d = d.join(found, F.col("_key") == F.col("_found_key"), "left").select("_row", "_z", "_found")
    kinds = [pa.int64() if isinstance(f.dataType, T.LongType) else pa.binary() for f in results]

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for raw, found in zip(batch.column(1), batch.column(2), strict=True):
                raw, all_found = unpack(raw.as_py()), found.as_py()
                ranges = np.zeros((0, 2), np.int64)
                if all_found:
                    records = np.frombuffer(all_found, U).reshape(-1, 4)
                    mine = (records[:, :2] == roots_of([scheme.root(raw)])).all(axis=1)
                    ranges = merged(records[mine, 2:].astype(np.int64).ravel())
                rows.append(scheme.result(raw, ranges))
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["_row", *names])

    out = d.mapInArrow(given_back(run), T.StructType([d.schema["_row"], *results]))
    return out.select(*fields("_row", others), *names)
