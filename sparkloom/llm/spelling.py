"""Spelling variants grouped by letter-parity bitmask bands.

A word's mask has a bit for each letter (accented ones share a few): set if the letter occurs an odd
number of times. Inserting or deleting a letter flips one bit, replacing one flips two or, within a
bit, none. Masks are cut into three bands, so words one edit apart have an equal band. Words meet in
buckets of a band, its value and a length: those of that length at home, and those one longer as
guests (one flip leaves one of the first two bands equal, so guests need only these). A bucket's pairs
within two flips are verified letter by letter, and belong to the first band they are equal in. A large
bucket looks up the masks one or two flips away instead of comparing all; beyond CHUNK words it is
split into chunks, each pair of which is a task's worth. Each task hands on, per word, its number of
near words and the best of them, not the pairs.

Occurrences are counted per document, then per task, before they are shuffled. Forms are followed to
the last by pointer jumping; a form is at least RATIO times as frequent, so chains are short and never
circle.

Defined results: null and empty texts have no words; a null id is an empty text in the hash; runs are
taken from whole texts and may be of any length; ties of frequency go to the smaller word in
code-point order; rows that repeat an id count each; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import given_back, lookup, name_of, stored, whole_groups

RUN = re.compile("[a-zÀ-ÿ]+")
#: A run loses a letter where this divides its hash.
LOSES = 31
SHORTEST, LEAST, RATIO = 7, 2, 10
#: Letters by falling frequency, dealt to the three bands in turn.
LETTERS = "etaoinsrhldcumfpgwybvkxjqz"
BANDS, BAND_BITS = 3, 11
BITS = BANDS * BAND_BITS
#: Words of one bucket that one task takes; larger buckets are split.
CHUNK = 1 << 17
#: Buckets of more pairs than this look masks up.
COMPARED = 1 << 18
#: Letters compared at once.
STEP = 1 << 22
#: Words a task counts before it hands them on.
COUNTED = 200_000


def bit_of() -> np.ndarray:
    """The mask's bit of each letter below U+0100: letters in turn over the bands, then accented ones over what is left."""
    place = [(i % BANDS) * BAND_BITS + i // BANDS for i in range(BITS)]
    out = np.zeros(256, np.int64)
    for i, c in enumerate(LETTERS):
        out[ord(c)] = place[i]
    left = place[len(LETTERS) :]
    for c in range(0xC0, 0x100):
        out[c] = left[c % len(left)]
    return out


BIT = bit_of()
BAND = [((1 << BAND_BITS) - 1) << (BAND_BITS * k) for k in range(BANDS)]


def mask_of(word: bytes) -> int:
    """The parity mask of a word in Latin-1."""
    odd = np.bincount(BIT[np.frombuffer(word, np.uint8)], minlength=BITS) & 1
    return int((odd << np.arange(BITS)).sum())


def altered(doc_id: str, run: str) -> str:
    """The run, less a letter where the hash says so."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    return run if h % LOSES else run[: h % len(run)] + run[h % len(run) + 1 :]


def _counted(batches):
    """(id as text, text's bytes) in; (word, n) out, words of SHORTEST letters or more."""
    counts: Counter = Counter()

    def taken():
        out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
        counts.clear()
        return out

    for b in batches:
        for ident, raw in zip(b.column(0), b.column(1), strict=True):
            raw = raw.as_py()
            if not raw:
                continue
            start = zlib.crc32(f"{ident.as_py()}:".encode())
            for run, k in Counter(RUN.findall(raw.lower().decode("utf-8", "replace"))).items():  # lower() of bytes: A-Z only
                if len(run) >= SHORTEST:
                    h = zlib.crc32(run.encode(), start)
                    if h % LOSES:
                        counts[run] += k
                    elif len(run) > SHORTEST:
                        at = h % len(run)
                        counts[run[:at] + run[at + 1 :]] += k
            if len(counts) >= COUNTED:
                yield taken()
    yield taken()


def _masked(batches):
    for b in batches:
        raw = [w.encode("latin-1") for w in b.column(0).to_pylist()]
        sizes = pa.array([len(w) for w in raw], pa.int64())
        yield pa.RecordBatch.from_arrays([*b.columns, sizes, pa.array([mask_of(w) for w in raw], pa.int64())], names=["word", "n", "size", "mask"])


def vocabulary(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """(word, n, size, mask): distinct words of SHORTEST letters and LEAST occurrences or more."""
    asked = docs.select(F.coalesce(name_of(ident).cast("string"), F.lit("")).alias("_id"), name_of(text).cast("binary").alias("_text"))
    counts = asked.mapInArrow(given_back(_counted), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST)
    return counts.mapInArrow(given_back(_masked), "word string, n long, size long, mask long")


def bucketed(words: DataFrame) -> DataFrame:
    """(bucket, ci, cj, guest, chunk, word, n, mask), a row for each bucket, and pair of chunks, of a word."""
    value = lambda k: F.shiftright("mask", BAND_BITS * k).bitwiseAND(F.lit((1 << BAND_BITS) - 1))
    code = lambda k, size: size * (1 << 16) + k * (1 << 14) + value(k)
    size = F.col("size")
    home = [F.struct(code(k, size).alias("bucket"), F.lit(False).alias("guest")) for k in range(BANDS)]
    guest = [F.struct(code(k, size - 1).alias("bucket"), F.lit(True).alias("guest")) for k in range(BANDS - 1)]
    rows = words.select("word", "n", "mask", F.explode(F.array(*home, *guest)).alias("_b")).select("word", "n", "mask", "_b.*")
    crowded = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > CHUNK)  # 5 words / CHUNK at most
    rows = rows.join(F.broadcast(crowded), "bucket", "left").withColumn("_k", F.coalesce(F.ceil(F.col("_c") / CHUNK), F.lit(1)).cast("int"))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("word"), F.col("_k")).cast("int")).withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    return rows.select("bucket", F.least("chunk", "_o").alias("ci"), F.greatest("chunk", "_o").alias("cj"), "guest", "chunk", "word", "n", "mask")


def flips(band: int, longer: bool) -> list[int]:
    """What masks of a pair may differ by that belongs to the band: it is equal there, and in no band before."""
    bits = [1 << i for i in range(BITS)]
    some = bits if longer else [0, *bits, *(x | y for i, x in enumerate(bits) for y in bits[:i])]
    return [x for x in some if not x & BAND[band] and all(x & b for b in BAND[:band])]


FLIPS = {(band, longer): np.array(flips(band, longer), np.int64) for band in range(BANDS) for longer in (False, True) if flips(band, longer)}


def within(x: np.ndarray, band: int, longer: bool) -> np.ndarray:
    """The same as a test of differences of masks."""
    n = np.bitwise_count(x)
    out = (n == 1) if longer else (n <= 2)
    out &= (x & BAND[band]) == 0
    for b in BAND[:band]:
        out &= (x & b) != 0
    return out


def met(a: np.ndarray, b: np.ndarray, band: int, longer: bool, same: bool):
    """Arrays i, j, a slice at a time: masks a[i], b[j] that a link of the band may have; same: a is b, and each pair counts once."""
    if len(a) * len(b) <= COMPARED:
        close = within(a[:, None] ^ b[None, :], band, longer)
        if same:
            close &= np.tri(len(a), k=-1, dtype=bool)
        yield np.nonzero(close)
        return
    order = np.argsort(b, kind="stable")
    ordered = b[order]
    for at in range(0, len(a), 4096):
        part = a[at : at + 4096]
        for flip in FLIPS[band, longer].tolist():
            low, high = np.searchsorted(ordered, part ^ flip, "left"), np.searchsorted(ordered, part ^ flip, "right")
            n = high - low
            ends = np.cumsum(n)
            for lo, hi in _slices(ends):
                i = np.repeat(np.arange(lo, hi), n[lo:hi])
                j = order[np.arange(len(i)) - np.repeat(ends[lo:hi] - n[lo:hi] - (ends[lo - 1] if lo else 0) - low[lo:hi], n[lo:hi])]
                i = i + at
                if same:
                    i, j = i[i > j], j[i > j]
                yield i, j


def _slices(ends: np.ndarray):
    """(lo, hi) that cut rows with these cumulated numbers of pairs into parts of about STEP / 8 pairs."""
    lo = 0
    while lo < len(ends):
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + STEP // 8, "right")))
        if ends[hi - 1] > base:
            yield lo, hi
        lo = hi


def one_edit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether words x (m, L) or (m, L + 1) and y (m, L) differ by exactly one replaced or further letter of x."""
    size = y.shape[1]
    if x.shape[1] == size:
        return (x != y).sum(axis=1) == 1
    ahead = _run(x[:, :size] == y)
    behind = _run((x[:, 1:] == y)[:, ::-1])
    return ahead + behind >= size


def _run(same: np.ndarray) -> np.ndarray:
    """Length of the run of True that each row begins with."""
    return np.where(same.all(axis=1), same.shape[1], same.argmin(axis=1))


def _near(batches):
    """Rows of whole buckets in; (word, n_near, best_n, best) out, once for each word and bucket that has near words."""
    for t, starts in whole_groups(batches, 3):
        ends = [*starts[1:].tolist(), t.num_rows]
        bucket, ci, cj, guest, chunk, n, mask = (t.column(c).to_numpy() for c in ("bucket", "ci", "cj", "guest", "chunk", "n", "mask"))
        words = t.column("word").combine_chunks()
        out: list = []
        for a, z in zip(starts.tolist(), ends, strict=True):
            if z - a < 2 or guest[a:z].all():
                continue
            size, band = int(bucket[a]) >> 16, int(bucket[a]) >> 14 & 3
            at = np.arange(a, z)
            some = lambda g, c, at=at, a=a, z=z: at[(guest[a:z] == g) & (chunk[a:z] == c)]
            i, j = int(ci[a]), int(cj[a])
            parts = [(some(False, i), some(False, j), False), (some(True, i), some(False, j), True)]
            if i != j:
                parts.append((some(True, j), some(False, i), True))
            pairs = [p for x, y, longer in parts if len(x) and len(y) for p in _pairs(words, mask, x, y, size, band, longer, i == j and not longer)]
            if pairs:
                x, y = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
                out.append((np.concatenate((x, y)), np.concatenate((y, x))))
        if out:
            word, other = (np.concatenate([p[k] for p in out]) for k in (0, 1))
            # by row, then by falling n, then by word: the first of each row is its best
            name = np.argsort(np.argsort(np.array(words.take(pa.array(other)).to_pylist(), object), kind="stable"), kind="stable")
            order = np.lexsort((name, -n[other], word))
            word, other = word[order], other[order]
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            number = np.diff(np.concatenate((first, [len(word)])))
            yield pa.RecordBatch.from_arrays([words.take(pa.array(word[first])), pa.array(number), pa.array(n[other[first]]), words.take(pa.array(other[first]))], names=["word", "n_near", "best_n", "best"])


def _pairs(words: pa.Array, mask: np.ndarray, x: np.ndarray, y: np.ndarray, size: int, band: int, longer: bool, same: bool):
    if longer and (band, True) not in FLIPS:
        return
    left, right = _letters(words, x, size + longer), _letters(words, y, size)
    for i, j in met(mask[x], mask[y], band, longer, same):
        for at in range(0, len(i), max(1, STEP // (size + 1))):
            p, q = i[at : at + max(1, STEP // (size + 1))], j[at : at + max(1, STEP // (size + 1))]
            near = one_edit(left[p], right[q])
            if near.any():
                yield x[p[near]], y[q[near]]


def _letters(words: pa.Array, rows: np.ndarray, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(w.encode("latin-1") for w in words.take(pa.array(rows)).to_pylist()), np.uint8).reshape(-1, size)


def variants(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """(word, form, root, n, n_near, form_n): each word, its most frequent near word where that is RATIO times as frequent, and the last of the forms."""
    words = stored(vocabulary(docs, text, ident))
    spark = docs.sparkSession
    placed = bucketed(words)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 5 * words.count() // 100_000)
    near = placed.repartition(parts, "bucket", "ci", "cj").sortWithinPartitions("bucket", "ci", "cj").mapInArrow(given_back(_near), "word string, n_near long, best_n long, best string")
    best = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best"))).alias("_best"))
    is_form = -F.col("_best.less") >= RATIO * F.col("n")
    judged = words.select("word", "n").join(best, "word", "left")
    judged = stored(judged.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("_best.best")).alias("form"), F.when(is_form, -F.col("_best.less")).alias("form_n")))
    step = judged.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        up = stored(lookup(step, "root", step.select(F.col("word").alias("w"), F.col("root").alias("next")), "w", "next", "word"))
        step = up.select("word", F.coalesce("next", "root").alias("root"))
        if up.filter("next IS NOT NULL").isEmpty():
            break
    return judged.join(step, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
