"""Suffix-array dedup: repeated byte strings by a distributed difference-cover suffix sort.

Windows of `width` bytes are first told apart by content: the least hash among a window's K-byte
strings marks it, and a mark that occurs once proves its windows unique. The stretches under shared
marks go to the task of their mark, so that equal windows meet, and each task sorts the suffixes of
its stretches by the difference cover of 3: sampled triples are sorted and named, the names are
sorted recursively, the remaining suffixes are merged in. Names of level k cover 3**k bytes, so the
recursion ends as soon as names cover a window. Neighbours in the suffix order whose first `width`
bytes agree are repeats; all but the first in the corpus go. Whole copies of an earlier document, and
stretches wholly equal to an earlier one, are settled on their content before any sorting.

Defined results: null and empty texts have no bytes and lose none; a text shorter than `width` has no
window; order is (doc_id, place), a null doc_id being the largest; rows that share a doc_id are
compared by place alone, so that two rows alike in all keep their bytes; very long texts are taken
whole; an empty table gives an empty result; input columns named like a result are replaced, all
others pass through.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .hashing import BYTE_VALUES, U, between, mix, prefix_sums
from .repeats import by_bucket, dealt, doc_table, gathered, heads_of, joined, merged, outcomes, packed_rows, read_tables, roots_of, settle, slices

#: Bytes of a window, and of the strings whose hashes mark it.
WIDTH = 100
K = 32
#: Bytes that one suffix sort takes; stretches under one mark stay together.
SORTED = 1 << 20
#: Bits for a place among the bytes worked on at once; a text has under 2**31.
PLACE = 31


def dense_ranks(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, ranks) by the keys, the first one foremost; equal ones share a rank."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = heads_of(*(k[order] for k in keys))
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new) - 1
    return order, ranks


def suffix_order(s: np.ndarray, need: int, reach: int = 1) -> np.ndarray:
    """Places of s (integers over 0) in the order of their suffixes, exact for the first `need` units.

    A symbol of s stands for `reach` units. Suffixes that agree in as many as `need` units stand next
    to each other in any order.
    """
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    p = np.concatenate((s, np.zeros(3, np.int64)))
    base = int(p.max()) + 1
    one, two = np.arange(1, n, 3), np.arange(2, n, 3)
    sample = np.concatenate((one, two))
    if base < 1 << 21:
        order, names = dense_ranks((p[sample] * base + p[sample + 1]) * base + p[sample + 2])
    else:
        order, names = dense_ranks(p[sample] * base + p[sample + 1], p[sample + 2])
    if names[order[-1]] + 1 < len(sample) and 3 * reach < need:
        deeper = suffix_order(np.concatenate((names[: len(one)] + 1, [0], names[len(one) :] + 1)), need, 3 * reach)
        deeper = deeper[deeper != len(one)]
        order = np.where(deeper > len(one), deeper - 1, deeper)
    rank = np.zeros(n + 3, np.int64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    rest, m = np.arange(0, n, 3), len(sample) + 1
    key = p[rest] * m + rank[rest + 1]
    by = np.argsort(key, kind="stable")
    rest, key = rest[by], key[by]
    sorted_sample = sample[order]
    is_one = sorted_sample % 3 == 1
    ones, twos = sorted_sample[is_one], sorted_sample[~is_one]
    ahead = np.searchsorted(p[ones] * m + rank[ones + 1], key)
    both = np.concatenate((rest, twos))
    _, pair = dense_ranks(p[both] * base + p[both + 1])
    ahead += np.searchsorted(pair[len(rest) :] * m + rank[twos + 2], pair[: len(rest)] * m + rank[rest + 2])
    out = np.empty(n, np.int64)
    at = np.maximum.accumulate(ahead) + np.arange(len(rest))
    taken = np.zeros(n, bool)
    taken[at] = True
    out[at] = rest
    out[~taken] = sorted_sample
    return out


def equal_neighbours(text: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """For each two neighbours of places, whether width bytes from there on agree."""
    word = np.zeros(len(text), U)
    padded = np.concatenate((text, np.zeros(8, np.uint8))).astype(U)
    for j in range(8):
        word |= padded[j : j + len(text)] << U(8 * j)
    same = np.arange(len(places) - 1)
    for off in [*range(0, width - 7, 8), width - 8]:
        same = same[word[places[same] + off] == word[places[same + 1] + off]]
    out = np.zeros(max(0, len(places) - 1), bool)
    out[same] = True
    return out


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of x[i : i + width], for each i that has so many."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[: len(x) - step], x[step:])
        have += step
    return x


class ByteRepeats:
    """Bytes as units: strings of `width` bytes that also start earlier in the corpus."""

    #: Bytes of text whose stretches are compared at once, before they are sent.
    compared = 4 << 20

    def __init__(self, width: int):
        self.width = width

    def root(self, raw: bytes) -> bytes:
        return blake2b(raw, digest_size=16).digest() if len(raw) >= self.width else bytes(16)

    def units(self, raw: bytes) -> int:
        return len(raw)

    def runs(self, raws: list[bytes]):
        """Maximal runs of windows with one marking string: (mark, document, first window, number of windows)."""
        text = np.frombuffer(b"".join(raws), np.uint8)
        begins = np.cumsum([0, *map(len, raws)])
        if len(text) < self.width:
            return np.zeros(0, U), *[np.zeros(0, np.int64)] * 3
        sums = prefix_sums(BYTE_VALUES[text])
        at = np.arange(len(text) - K + 1)
        h = between(sums, at, at + K)
        # the same bits of the hash count in every task, whatever else it holds; the first place wins ties
        least = sliding_least(h >> U(PLACE) << U(PLACE) | at.astype(U), self.width - K + 1)
        doc = np.repeat(np.arange(len(raws)), np.diff(begins))[: len(least)]
        inside = np.arange(len(least)) + self.width <= begins[1:][doc]
        new = heads_of(least, doc)
        new[1:] |= ~inside[:-1]
        new &= inside
        start = np.flatnonzero(new)
        # a run ends where the next begins or where windows no longer fit
        edges = np.concatenate((np.flatnonzero(new | ~inside), [len(least)]))
        n = edges[np.searchsorted(edges, start, "right")] - start
        mark = h[(least[start] & U((1 << PLACE) - 1)).astype(np.int64)]
        return mark, doc[start], start - begins[doc[start]], n

    def marks(self, raws: list[bytes]):
        mark, owner, _, _ = self.runs(raws)
        order = np.lexsort((owner, mark))
        mark, owner = mark[order], owner[order]
        new = heads_of(mark, owner)
        heads = np.flatnonzero(new)
        again = np.diff(np.concatenate((heads, [len(mark)]))) > 1
        return mark[new], owner[new], again

    def probe(self, docs: list[tuple], parts: int, owners: int):
        """Stretches under shared marks: mark, first window, number of windows, and their bytes."""
        found = []
        for a, b in slices([d[3] for d in docs]):
            mark, doc, start, n = self.runs([d[3] for d in docs[a:b]])
            salt = mix(np.arange(b - a, dtype=U) + U(1))
            shared = np.concatenate([mix(d[4]) ^ s for d, s in zip(docs[a:b], salt, strict=True)])
            keep = np.isin(mix(mark) ^ salt[doc], shared)
            found.append((mark[keep], doc[keep] + a, start[keep], n[keep]))
        mark, owner, start, n = map(np.concatenate, zip(*found, strict=True))
        if not len(mark):
            return [], []
        texts = [docs[k][3][s : s + e] for k, s, e in zip(owner.tolist(), start.tolist(), (n + self.width - 1).tolist(), strict=True)]
        ids = np.array([d[1] for d in docs], np.int64)
        settled, live = self._equal(texts, ids[owner], start, owner, n)
        sent = []
        for bucket, i in by_bucket(mark[live] % U(parts)):
            i = live[i]
            slot, table = doc_table(docs, owner[i])
            sent.append((bucket, 1, mark[i], start[i], n[i].astype(np.uint32), slot, table, b"".join([texts[k] for k in i.tolist()])))
        return settled, sent

    def _equal(self, texts: list[bytes], ids, start, owner, n):
        """Of stretches wholly equal, ([(owner, ranges that go)], the places of those that stay)."""
        digest = roots_of([blake2b(t, digest_size=16).digest() for t in texts])
        order = np.lexsort((start, ids, digest[:, 1], digest[:, 0]))
        new = heads_of(digest[order, 0], digest[order, 1])
        first = order[new][np.cumsum(new) - 1]
        late = (ids[order] > ids[first]) | ((ids[order] == ids[first]) & (start[order] > start[first]))
        gone = order[late]
        return self._ranges(owner[gone], start[gone], n[gone]), order[~late]

    def _ranges(self, owner, start, n):
        """(owner, disjoint ranges) of the bytes under n windows from each start on."""
        return [(k, merged(np.stack((start[i], start[i] + n[i] + self.width - 1), axis=1).ravel().astype(np.int64)).ravel()) for k, i in by_bucket(owner)]

    def resolve(self, rows: DataFrame, parts: int, owners: int, drop) -> DataFrame:
        return rows.filter("kind = 0").unionByName(dealt(rows.filter("kind = 1"), parts, lambda batches: self.verify(batches, parts)))

    def verify(self, batches, parts: int):
        mark, start, n, slots, tables, blobs = gathered(batches)[1]
        mark, start, n = joined(mark, U), joined(start, np.int64), joined(n, np.uint32).astype(np.int64)
        doc, keys, ids, roots = read_tables(tables, slots)
        text = b"".join(blobs)
        ends = np.cumsum(n + self.width - 1)
        begin = ends - (n + self.width - 1)
        if not len(mark):
            return
        texts = [text[a:b] for a, b in zip(begin.tolist(), ends.tolist(), strict=True)]
        settled, live = self._equal(texts, ids[doc], start, doc, n)
        # a mark with one stretch left has no equal windows: two in one stretch would have two marking strings
        order = live[np.argsort(mark[live], kind="stable")]
        heads = np.flatnonzero(heads_of(mark[order]))
        size = np.diff(np.concatenate((heads, [len(order)])))
        order = order[np.repeat(size > 1, size)]
        gone = []
        for part in self._parts(order, mark, n):
            gone.append(self._sorted(part, texts, ids[doc], doc, start, n))
        if gone:
            owner, place = map(np.concatenate, zip(*gone, strict=True))
            settled += self._ranges(owner, place, np.ones(len(place), np.int64))
        yield packed_rows(outcomes([(keys[k], roots[k].tobytes(), r) for k, r in settled], parts))

    def _parts(self, order, mark, n):
        """Runs of whole marks of about SORTED bytes; a larger mark is a part of its own."""
        if not len(order):
            return
        heads = np.flatnonzero(heads_of(mark[order]))
        volume = np.add.reduceat(n[order] + self.width, heads)
        group = np.cumsum(volume) // SORTED
        cut = np.flatnonzero(heads_of(group))
        for a, b in zip(heads[cut], [*heads[cut[1:]], len(order)], strict=True):
            yield order[a:b]

    def _sorted(self, part, texts, ids, doc, start, n):
        """(document, place) of the windows that also start earlier, by the suffix order of the part."""
        text = np.frombuffer(b"\0".join([texts[k] for k in part.tolist()]) + b"\0", np.uint8)
        length = n[part] + self.width
        begin = np.cumsum(length) - length
        s = text.astype(np.int64) + 1
        s[begin + length - 1] = 0
        window = np.zeros(len(text), bool)
        stretch = np.repeat(np.arange(len(part)), length)
        window[np.arange(len(text)) - begin[stretch] < n[part][stretch]] = True
        places = suffix_order(s, self.width)
        places = places[window[places]]
        same = equal_neighbours(text, places, self.width)
        of = part[stretch[places]]
        place = start[of] + places - begin[stretch[places]]
        _, rank = dense_ranks(ids[of], place)
        heads = np.flatnonzero(np.concatenate(([True], ~same)))
        least = np.minimum.reduceat(rank, heads)
        late = rank > np.repeat(least, np.diff(np.concatenate((heads, [len(places)]))))
        return doc[of[late]], place[late]

    def result(self, raw: bytes, ranges: np.ndarray):
        """n_bytes, n_removed, n_spans, kept."""
        parts, at = [], 0
        for a, b in ranges.tolist():
            parts.append(raw[at:a])
            at = b
        kept = b"".join([*parts, raw[at:]]) if parts else raw
        return len(raw), len(raw) - len(kept), len(ranges), kept


RESULTS = [T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType())]


def remove_repeats(docs: DataFrame, text: str = "text", ident: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """docs with n_bytes, n_removed, n_spans (maximal removed runs) and kept, the remaining bytes, in place of the text."""
    return settle(docs, ByteRepeats(width), text, ident, RESULTS)
