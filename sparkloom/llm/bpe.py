"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a doubly linked list of byte tokens. For each merge rank there is a bucket of the list
places whose pair has that rank. A bitmap in words of 256 ranks marks the ranks with a bucket, a root
word, as long as the vocabulary asks for, marks the words that aren't zero, and find-first-set on the
root, then on that word, gives the lowest rank. Entries are never removed when their pair changes: an
entry is stale if the pair now at its place has another rank, and is skipped.

Pre-tokens that a worker hasn't met lately go through one queue together (`merge_many`): find-first-set
on the root gives a word of ranks, and in its buckets the lowest rank of each pre-token is merged, in
all places at once, so that arrays do the work. `merge` is the queue of one pre-token alone; it also
does those whose ranks no merging could have built. Either takes O(n log n) for a pre-token of any
length.

Ids are packed as little-endian unsigned 32-bit integers. The rank file is read on the driver and
broadcast; its size is that of one vocabulary, whatever the corpus.

Defined results: a null or empty text has no tokens; texts are encoded whole, special tokens' strings
as ordinary text; rows are independent, so repeated rows and ids change nothing; an empty table gives
an empty result; input columns named like a result are replaced, all others pass through. Decoding a
null gives empty bytes; an id outside the vocabulary raises, and so does encoding a text with a byte
that the vocabulary has no token for.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import WARM, fields, given_back, name_of, row_of
from .hashing import mix

#: Distinct pre-tokens of one generation of what a worker remembers, and pairs of ids; results don't depend on it.
GENERATION, PAIRS = 150_000, 200_000
#: Pre-tokens looked up, and ids decoded, at once.
PIECES, DECODED = 1 << 17, 1 << 18
#: Bytes of values that make one batch of results; a longer value makes a batch alone.
BATCH_BYTES = 1 << 21
#: Longer pre-tokens are not remembered.
CACHE_BYTES = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: a line for each token, base64 and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}


class PairRanks(dict):
    """(id, id) to the rank of the token that both make, or -1; remembers what was asked."""

    def __init__(self, ranks: dict[bytes, int], tokens: dict[int, bytes]):
        super().__init__()
        self.ranks, self.tokens = ranks, tokens

    def __missing__(self, pair: tuple[int, int]) -> int:
        if len(self) >= PAIRS:
            self.clear()
        rank = self[pair] = self.ranks.get(self.tokens[pair[0]] + self.tokens[pair[1]], -1)
        return rank


class Encoder(dict):
    """Encodes pre-tokens; as a dict it maps pre-tokens met lately to their packed ids.

    What is remembered has two generations: when one is full it becomes the older, and what is asked
    for again moves to the newer, so that frequent pre-tokens are never forgotten.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        super().__init__()
        self.older: dict[str, bytes] = {}
        self.ranks, found = ranks, regex.compile(pattern)
        self.find, self.find_each = found.findall, found.finditer
        self.tokens = {i: t for t, i in ranks.items()}
        most = max(ranks.values(), default=0)
        self.words = [0] * ((most >> 8) + 1)
        self.bit = [1 << i for i in range(max(256, len(self.words)))]
        self.bytes = [ranks.get(bytes([b])) for b in range(256)]
        self.byte_ids = np.array([-1 if i is None else i for i in self.bytes], np.int64)
        self._fill_pairs()
        self.pairs = PairRanks(ranks, self.tokens)
        # for decoding: where each id's bytes stand in one string of all tokens, and how many they are
        self.blob = np.frombuffer(b"".join(ranks), np.uint8)
        size = np.fromiter(map(len, ranks), np.int64, len(ranks))
        self.start, self.size = np.zeros(most + 1, np.int64), np.full(most + 1, -1, np.int64)
        ids = np.fromiter(ranks.values(), np.int64, len(ranks))
        self.start[ids], self.size[ids] = np.cumsum(size) - size, size

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token. The queue's push and pop stand in line, since they are most of the work."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        ids = list(map(self.bytes.__getitem__, piece))
        if None in ids:
            raise ValueError(f"the vocabulary has no token for byte {piece[ids.index(None)]}")
        n, pair, one = len(ids), self.pairs.__getitem__, self.bit
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        at = list(map(pair, zip(ids, ids[1:], strict=False)))
        words, buckets, root, live = self.words, {}, 0, 0
        for i, r in enumerate(at):
            if r >= 0:
                live += 1
                bucket = buckets.get(r)
                if bucket is None:
                    buckets[r] = i
                    w = r >> 8
                    root |= one[w]
                    words[w] |= one[r & 255]
                elif bucket.__class__ is int:
                    buckets[r] = [bucket, i]
                else:
                    bucket.append(i)  # places come in order
        at.append(-1)
        while live:
            w = (root & -root).bit_length() - 1
            x = words[w]
            low = x & -x
            rank = w << 8 | low.bit_length() - 1
            bucket = buckets[rank]
            if bucket.__class__ is int:
                i = bucket
                bucket = None
            else:
                i = heapq.heappop(bucket)
            if not bucket:
                del buckets[rank]
                words[w] = x = x ^ low
                if not x:
                    root ^= one[w]
            if at[i] != rank:  # stale: the pair at this place has changed or gone
                continue
            j = after[i]
            after[i] = k = after[j]
            ids[i] = rank
            live -= 1 if at[j] < 0 else 2
            at[j] = -1
            h = before[i]
            r = at[i] = -1 if k == n else pair((rank, ids[k]))
            if k < n:
                before[k] = i
            place = i
            while True:  # the new pair at i, then that at h
                if r >= 0:
                    live += 1
                    bucket = buckets.get(r)
                    if bucket is None:
                        buckets[r] = place
                        w = r >> 8
                        root |= one[w]
                        words[w] |= one[r & 255]
                    elif bucket.__class__ is int:
                        buckets[r] = [bucket, place] if bucket < place else [place, bucket]
                    else:
                        heapq.heappush(bucket, place)
                if h < 0:
                    break
                if at[h] >= 0:
                    live -= 1
                r = at[h] = pair((ids[h], rank))
                place, h = h, -1
        while root:  # what is left is stale
            w = root.bit_length() - 1
            words[w] = 0
            root ^= one[w]
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out

    def merge_many(self, raws: list[bytes]) -> list[bytes]:
        """The packed ids of each of some pre-tokens, by one queue for all of them.

        The list places of all pre-tokens stand in one array, with no pair across two of them. A step
        takes the lowest word of ranks that has places, of each pre-token the places of its lowest
        rank there, and merges them all: pre-tokens don't touch, and places of one rank that overlap
        are taken from left to right, every other one of a run. Merging a rank gives higher ranks in
        any vocabulary that merging itself could build; a pre-token where it doesn't is done by `merge`.
        """
        if not raws:
            return []
        size = np.fromiter(map(len, raws), np.int64, len(raws))
        ends = np.cumsum(size)
        n, of = int(ends[-1]), np.repeat(np.arange(len(raws)), size)
        ids = np.append(self.byte_ids[np.frombuffer(b"".join(raws), np.uint8)], -1)
        if (ids[:n] < 0).any():
            raise ValueError(f"the vocabulary has no token for byte {b''.join(raws)[int((ids[:n] < 0).argmax())]}")
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1], after[n], before[ends - size] = n, n, n  # n: no place
        at = np.append(self.pair_ranks(ids[:n], ids[after[:n]]), -1)
        fresh, gone, odd = np.zeros(n + 1, bool), np.zeros(n, bool), np.zeros(len(raws), bool)
        buckets: dict[int, list[np.ndarray]] = {}
        root = self._put(buckets, np.flatnonzero(at >= 0), at)
        while root:
            w = (root & -root).bit_length() - 1
            some = np.concatenate(buckets.pop(w))
            some = some[at[some] >> 8 == w]  # the others are stale: their pairs have changed or gone
            if not len(some):
                root ^= 1 << w
                continue
            some.sort()
            some = some[np.concatenate(([True], some[1:] != some[:-1]))]
            rank, piece = at[some], of[some]
            heads = np.flatnonzero(np.concatenate(([True], piece[1:] != piece[:-1])))
            lowest = rank == np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.append(heads, len(some))))
            buckets[w] = [some[~lowest]]
            some, rank = some[lowest], rank[lowest]
            beside = after[some]
            new_run = np.concatenate(([True], beside[:-1] != some[1:]))
            if not new_run.all():
                number = np.arange(len(some))
                taken = (number - np.maximum.accumulate(np.where(new_run, number, 0))) % 2 == 0
                some, rank, beside = some[taken], rank[taken], beside[taken]
            far = after[beside]
            fresh[some] = True
            then = fresh[far]  # one by one, such a place would meet its neighbour before that is merged
            if then.any():
                met = self.pair_ranks(rank[then], ids[far[then]])
                odd[of[some[then][(met >= 0) & (met < rank[then])]]] = True
            ids[some], after[some], before[far], at[beside], gone[beside] = rank, far, some, -1, True
            left = before[some]
            known = (left < n) & ~fresh[left]  # a merged one to the left has this pair as its right one
            fresh[some] = False
            changed, under = np.concatenate((some, left[known])), np.concatenate((rank, rank[known]))
            at[changed] = new = self.pair_ranks(ids[changed], ids[after[changed]])
            live = new >= 0
            odd[of[changed[live & (new < under)]]] = True
            root |= self._put(buckets, changed[live], at)
        packed = ids[:n][~gone].astype("<u4").tobytes()
        stops = (4 * np.cumsum(np.bincount(of[~gone], minlength=len(raws)))).tolist()
        out = [packed[a:b] for a, b in itertools.pairwise([0, *stops])]
        for k in np.flatnonzero(odd).tolist():
            out[k] = struct.pack(f"<{len(x := self.merge(raws[k]))}I", *x)
        return out

    @staticmethod
    def _put(buckets: dict, places: np.ndarray, at: np.ndarray) -> int:
        """Files the places under the words of their ranks; the words, as bits."""
        if not len(places):
            return 0
        word = at[places] >> 8
        order = np.argsort(word, kind="stable")
        word, places = word[order], places[order]
        heads = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1]))).tolist()
        bits = 0
        for w, a, b in zip(word[heads].tolist(), heads, [*heads[1:], len(places)], strict=True):
            buckets.setdefault(w, []).append(places[a:b])
            bits |= 1 << w
        return bits

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the token that both ids make, or -1; so it is too if either is -1."""
        key = (a << 32) | b
        slot = mix(key.view(np.uint64)).view(np.int64) & (len(self.pair_keys) - 1)
        got = self.pair_keys[slot]
        out = np.where(got == key, self.pair_values[slot], -1)
        todo = np.flatnonzero((got != key) & (got != -1))
        while len(todo):  # the next slot, until the key or an empty one
            slot[todo] = (slot[todo] + 1) & (len(self.pair_keys) - 1)
            got = self.pair_keys[slot[todo]]
            hit = got == key[todo]
            out[todo[hit]] = self.pair_values[slot[todo[hit]]]
            todo = todo[~hit & (got != -1)]
        out[(a < 0) | (b < 0)] = -1
        return out

    def _fill_pairs(self):
        """A hash table of all pairs of ids that make a token: each token's splits into two tokens."""
        rows = [(a, b, r) for t, r in self.ranks.items() for i in range(1, len(t)) if (a := self.ranks.get(t[:i])) is not None and (b := self.ranks.get(t[i:])) is not None]
        a, b, r = (np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else [np.zeros(0, np.int64)] * 3
        size = 1 << max(4, (4 * len(r)).bit_length())
        self.pair_keys, self.pair_values = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        key = (a << 32) | b
        slot = mix(key.view(np.uint64)).view(np.int64) & (size - 1)
        while len(key):
            free = self.pair_keys[slot] == -1
            self.pair_keys[slot[free]] = key[free]  # of several, one stays
            placed = self.pair_keys[slot] == key
            self.pair_values[slot[placed]] = r[placed]
            key, r, slot = key[~placed], r[~placed], (slot[~placed] + 1) & (size - 1)

    def encode(self, texts) -> list[bytes]:
        """The packed ids of each text, some pre-tokens at once."""
        parts: list[list[bytes]] = []
        some, held = [], 0
        for text in texts:
            parts.append([])
            for pieces in self._pieces(text):
                some.append((parts[-1], pieces))
                held += len(pieces)
                if held >= PIECES:
                    self._encode(some)
                    some, held = [], 0
        self._encode(some)
        return [x[0] if len(x) == 1 else b"".join(x) for x in parts]

    def _pieces(self, text: str | None):
        """The pre-tokens of a text; of a very long one in lists of PIECES."""
        if not text:
            return
        if len(text) < PIECES:
            yield self.find(text)
            return
        found = self.find_each(text)
        while pieces := [m[0] for m in itertools.islice(found, PIECES)]:
            yield pieces

    def _encode(self, some: list[tuple[list[bytes], list[str]]]):
        if len(self) >= GENERATION:
            self.older = dict(self)
            self.clear()
        missing = set().union(*(pieces for _, pieces in some)).difference(self)
        for piece in missing.intersection(self.older):
            self[piece] = self.older.pop(piece)
        missing = list(missing.difference(self))
        whole = list(map(self.ranks.get, raws := [x.encode() for x in missing]))
        asked = [k for k, r in enumerate(whole) if r is None]
        merged = dict(zip(asked, self.merge_many([raws[k] for k in asked]), strict=True))
        self.update((x, merged[k] if r is None else struct.pack("<I", r)) for k, (x, r) in enumerate(zip(missing, whole, strict=True)))
        for out, pieces in some:
            out.append(b"".join(map(self.__getitem__, pieces)))
        for x, raw in zip(missing, raws, strict=True):
            if len(raw) > CACHE_BYTES:
                del self[x]

    def forget(self):
        """Leaves the newer generation alone, for the next task; workers that wait hold no more than that."""
        self.older = {}
        self.pairs.clear()

    def decode(self, packed: list[bytes | None]) -> list[bytes]:
        """The bytes of each value, some values at once."""
        out, some, held = [], [], 0
        for x in packed:
            some.append(x or b"")
            held += len(some[-1])
            if held > 4 * DECODED:
                out += self._decoded(some)
                some, held = [], 0
        return out + self._decoded(some)

    def _decoded(self, some: list[bytes]) -> list[bytes]:
        ids = np.frombuffer(b"".join(some), "<u4")
        if len(ids) and (ids.max() >= len(self.size) or self.size[ids].min() < 0):
            raise ValueError("an id outside the vocabulary")
        parts, reach = [], [0]
        for a in range(0, len(ids), DECODED):  # one value may have any number
            start, size = self.start[ids[a : a + DECODED]], self.size[ids[a : a + DECODED]]
            ends = np.cumsum(size)
            parts.append(self.blob[np.arange(ends[-1]) + np.repeat(start - ends + size, size)].tobytes())
            reach.append(ends + reach[-1][-1] if a else ends)
        ends = np.concatenate(([0], *reach[1:]))[np.cumsum([0, *(len(x) // 4 for x in some)])].tolist()
        whole = b"".join(parts)
        return [whole[a:b] for a, b in itertools.pairwise(ends)]


#: The encoder a Python worker last used; the next task of the same query finds it warm.
_last: dict[str, Encoder] = {}
WARM.append(_last)


def _encoder(key: str, shared, pattern: str) -> Encoder:
    if key not in _last:
        _last.clear()
        _last[key] = Encoder(shared.value, pattern)
    return _last[key]


def _stretches(values: pa.Array):
    """Start and number of rows of each stretch of values that BATCH_BYTES hold, of one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(values.cast(pa.large_binary())), 0).to_numpy())
    start = 0
    while start < len(values):
        most = BATCH_BYTES + (ends[start - 1] if start else 0)
        stop = max(start + 1, int(np.searchsorted(ends, most, "right")))
        yield start, stop - start
        start = stop


def _mapped(docs: DataFrame, ranks_path: str, pattern: str, source: str, results: list[T.StructField], work, keep_source: bool = True) -> DataFrame:
    """docs with the results of work, which makes columns of a column of values."""
    names = [f.name for f in results]
    passed = [c for c in docs.columns if (c not in names or c == source) and (keep_source or c != source)]
    docs = docs.select(name_of(source).alias("_source"), row_of(passed).alias("_row"))
    ranks = read_ranks(ranks_path)
    key = hashlib.sha256(repr((pattern, sorted(ranks.items()))).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    schema = T.StructType([docs.schema["_row"], *results])
    kinds = [pa.int64() if isinstance(f.dataType, T.LongType) else pa.binary() for f in results]

    def run(batches):
        encoder = _encoder(key, shared, pattern)
        try:
            for batch in batches:
                for start, n in _stretches(batch.column(0)):
                    part = batch.slice(start, n)
                    columns = work(encoder, (x.as_py() for x in part.column(0)))
                    arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                    del columns
                    yield pa.RecordBatch.from_arrays([part.column(1), *arrays], names=["_row", *names])
        finally:
            encoder.forget()

    return docs.mapInArrow(given_back(run, keep=True), schema).select(*fields("_row", passed), *names)


IDS, N, DECODED_BYTES = T.StructField("token_ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()), T.StructField("decoded", T.BinaryType())


def _encode(encoder: Encoder, texts):
    packed = encoder.encode(texts)
    return packed, [len(x) // 4 for x in packed]


def _decode(encoder: Encoder, packed):
    return (encoder.decode(list(packed)),)


def _both(encoder: Encoder, texts):
    packed, n = _encode(encoder, texts)
    return packed, n, encoder.decode(packed)


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """docs with token_ids (packed) and n_tokens."""
    return _mapped(docs, ranks_path, pattern, text, [IDS, N], _encode)


def decode(docs: DataFrame, ranks_path: str, pattern: str, token_ids: str = "token_ids") -> DataFrame:
    """docs with decoded, the bytes that the packed ids stand for."""
    return _mapped(docs, ranks_path, pattern, token_ids, [DECODED_BYTES], _decode)


def encode_and_decode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """docs with token_ids, n_tokens and decoded, what the ids stand for, in place of the text; in one pass."""
    return _mapped(docs, ranks_path, pattern, text, [IDS, N, DECODED_BYTES], _both, keep_source=False)
