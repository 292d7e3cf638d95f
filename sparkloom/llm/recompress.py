"""Substring dedup by recompression.

Words become symbols of higher and higher levels, by rounds that name runs and pairs: a run of one
symbol, then pairs of a left and a right symbol, the side being a bit of the symbol's name and the
round. What a symbol is follows from a few words around it, its context, so equal substrings have the
same symbols inside, wherever they stand.

1. Marks. Provisional names are hashes of what they stand for. The highest symbol whose context lies
   inside a window marks it, and a mark that one document alone has proves its windows unique
   (`repeats`, steps 1 to 3). This spares most of the text the rounds that follow; it decides nothing else.
2. Rounds. What is left is named globally and exactly, by LEVELS + 1 Spark rounds: each part of the
   text asks for the names of its distinct words, then of its distinct pairs; the owner of a word or
   pair gives it a number, or says that no other document has it, and a window around such a symbol
   is unique. A run is its symbol and its length, which needs no owner.
3. Windows. A window is its highest symbol and the words beside it, all by their numbers. As a number
   stands for one word or pair only, windows are equal if these agree, and are compared by a
   128-bit cryptographic digest of them. All but those of the smallest doc_id go.

Words of up to 15 bytes are known by these bytes, longer ones and whole documents by digests of that kind.

Defined results: null and blank texts have no words and lose none; a document of fewer than `width`
words has no window; a window counts as repeated only if a strictly smaller doc_id has it, a null
doc_id being the largest, so repeats within a document and between rows of one doc_id stay; very long
texts are taken whole; an empty table gives an empty result; input columns named like a result are
replaced, all others pass through.
"""

from __future__ import annotations

import pickle
import uuid
from hashlib import blake2b

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import given_back, kept, release
from .hashing import BYTE_VALUES, U, between, mix, prefix_sums
from .repeats import ROW, ROW_NAMES, by_bucket, dealt, doc_table, gathered, heads_of, joined, covered, packed_rows, range_rows, read_tables, roots_of, settle, slices

#: Words of a window.
WIDTH = 13

BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LEVELS = 2
#: Bytes of text whose stretches make one part.
PART_BYTES = 8 << 20
#: Kinds of the rows between the rounds: outcomes, questions to owners, parts of the text, answers, windows.
OUTCOME, ASK, PART, ANSWER, WINDOW = range(5)
#: A name is a number of the owner's with its level in the two lowest bits, a run has its length above these.
RUN = 48


def split_words(raws: list[bytes]):
    """(buffer, starts, ends, document of each word, first word of each document and the end)."""
    buf = np.frombuffer(b" ".join(raws) + b" ", np.uint8)
    blank = BLANK[buf]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], blank))))
    starts, ends = edges[::2], edges[1::2]
    begins = np.cumsum([0, *(len(r) + 1 for r in raws)])
    first = np.searchsorted(starts, begins)
    return buf, starts, ends, np.repeat(np.arange(len(raws)), np.diff(first)), first


def parsed(raws: list[bytes]):
    """(hash of each word, its document, first word of each document and the end); hashes that two words share cost time, no more."""
    buf, starts, ends, doc, first = split_words(raws)
    return between(prefix_sums(BYTE_VALUES[buf]), starts, ends), doc, first


def key_of(word: bytes) -> bytes:
    """16 bytes, another for each word: itself, or a digest."""
    return word.ljust(15, b"\0") + bytes((len(word),)) if len(word) < 16 else blake2b(word, digest_size=15).digest() + b"\xff"


class Symbols:
    """The symbols of one level, in order of place.

    name; begin, end: the words it stands for; low, high: its context, the range of words that the
    symbol, its extent and its being a symbol at all follow from, one word beyond the sequence where it
    leans on its edge; of: its sequence. A negative name is that of an unknown symbol: it joins nothing.
    """

    def __init__(self, name, begin, end, low, high, of, bounds):
        self.name, self.begin, self.end, self.low, self.high, self.of, self.bounds = name, begin, end, low, high, of, bounds

    @classmethod
    def of_words(cls, names: np.ndarray, of: np.ndarray, first: np.ndarray) -> Symbols:
        at = np.arange(len(names))
        return cls(names, at, at + 1, at, at + 1, of, (first[:-1] - 1, first[1:] + 1))

    def same_sequence(self) -> np.ndarray:
        return self.of[1:] == self.of[:-1]

    def _widened(self, to_left, to_right):
        """Contexts joined with that of the left, the right neighbour, where asked for."""
        if not len(self.low):
            return self.low, self.high
        (before, beyond), same = self.bounds, self.same_sequence()
        a = np.concatenate((before[self.of[:1]], np.where(same, self.low[:-1], before[self.of[1:]])))
        b = np.concatenate((np.where(same, self.high[1:], beyond[self.of[:-1]]), beyond[self.of[-1:]]))
        return np.where(to_left, np.minimum(a, self.low), self.low), np.where(to_right, np.maximum(b, self.high), self.high)

    def runs(self, run_name) -> Symbols:
        """Runs of one symbol as one; run_name names those of two or more."""
        n = self.name
        join = self.same_sequence() & (n[1:] == n[:-1])
        if n.dtype == np.int64:
            join &= n[1:] >= 0
        head = np.flatnonzero(np.concatenate(([True], ~join))) if len(n) else np.zeros(0, int)
        size = np.diff(np.concatenate((head, [len(n)])))
        tail = head + size - 1
        # that a run ends follows from the one symbol beyond, not from the run that this belongs to
        low, high = self._widened(True, True)
        names = np.where(size > 1, run_name(n[head], size), n[head])
        return Symbols(names, self.begin[head], self.end[tail], low[head], high[tail], self.of[head], self.bounds)

    def pairs(self, r: int):
        """(places of the left ones of pairs, a function that makes the next level of their names)."""
        n = self.name
        left = (mix(n.view(U) + U(r * 0x632BE59BD9B4E019 % (1 << 64))) & U(1)) == 0
        meet = self.same_sequence() & left[:-1] & ~left[1:]
        if n.dtype == np.int64:
            meet &= (n[:-1] >= 0) & (n[1:] >= 0)
        pair = np.concatenate((meet, [False]))[: len(n)]
        at = np.flatnonzero(pair)

        def named(names: np.ndarray) -> Symbols:
            low, high = self._widened(~left, left)
            name, end = n.copy(), self.end.copy()
            name[at], end[at], low[at], high[at] = names, self.end[at + 1], self.low[at], self.high[at + 1]
            stay = np.ones(len(n), bool)
            stay[at + 1] = False
            return Symbols(name[stay], self.begin[stay], end[stay], low[stay], high[stay], self.of[stay], self.bounds)

        return at, named

    def inside(self, width: int, length: int):
        """The symbols whose context fits in a window."""
        return np.flatnonzero((self.high - self.low <= width) & (self.low >= 0) & (self.high <= length))


def provisional(words: np.ndarray, of: np.ndarray, first: np.ndarray, rounds: int = LEVELS) -> list[Symbols]:
    """All levels, with hashes for names."""
    levels = [Symbols.of_words(words, of, first)]
    for r in range(1, rounds + 1):
        s = levels[-1].runs(lambda name, size: mix(name ^ mix(size.astype(U) + U(r << 32))))  # noqa: B023
        at, named = s.pairs(r)
        levels.append(named(mix(s.name[at] * U(3) + mix(s.name[at + 1] + U(r)))))
    return levels


def highest(levels: list[Symbols], values: list[np.ndarray], at: np.ndarray, width: int, length: int):
    """For each window from `at` on, (level, place, value) of a symbol of the highest level whose context lies inside: that of the least value."""
    level, place, best_of = np.full(len(at), -1), np.zeros(len(at), np.int64), np.zeros(len(at), U)
    for k in reversed(range(len(levels))):
        todo = np.flatnonzero(level < 0)
        if not len(todo):
            break
        s = levels[k]
        ok = s.inside(width, length)
        value = values[k][ok]
        a = np.searchsorted(s.low[ok], at[todo])
        b = np.searchsorted(s.high[ok], at[todo] + width, "right")
        best, where = np.full(len(todo), ~U(0)), np.zeros(len(todo), np.int64)
        for t in range(int((b - a).max(initial=0))):
            i = np.flatnonzero(a + t < b)
            less = (value[a[i] + t] < best[i]) | (t == 0)
            best[i[less]], where[i[less]] = value[a[i[less]] + t], ok[a[i[less]] + t]
        has = a < b
        level[todo[has]], place[todo[has]], best_of[todo[has]] = k, where[has], best[has]
    return level, place, best_of


def window_marks(words: np.ndarray, doc: np.ndarray, first: np.ndarray, width: int, rounds: int = LEVELS):
    """(window starts, a mark of each): equal windows have equal marks. A mark is a hash of a symbol and its context."""
    at = np.arange(max(0, len(words) - width + 1))
    at = at[doc[at] == doc[at + width - 1]] if len(at) else at
    levels, sums = provisional(words, doc, first, rounds), prefix_sums(words)
    values = []
    for k, s in enumerate(levels):
        low, high = np.clip(s.low, 0, len(words)), np.clip(s.high, 0, len(words))
        values.append(mix(between(sums, low, high) + mix(s.name + U(k))))
    return at, highest(levels, values, at, width, len(words))[2]


class Part:
    """Stretches of words of some documents, on their way through the rounds.

    words: the place of each word among the keys until it has its name; first: where each stretch
    begins, and the end; slot, place: its document, and where it begins there; alive: whether a window
    that may be a repeat starts at a word; table: the documents.
    """

    def __init__(self, table: bytes, words: list[bytes], length: np.ndarray, slot: np.ndarray, place: np.ndarray, alive: np.ndarray, width: int):
        self.table, self.slot, self.place, self.alive, self.width = table, slot, place, alive, width
        self.first = np.cumsum(np.concatenate(([0], length)))
        self.levels: list[Symbols] = []
        found = {w: k for k, w in enumerate(dict.fromkeys(words))}
        self.keys = np.frombuffer(b"".join(map(key_of, found)), U).reshape(-1, 2)
        self.words = np.fromiter(map(found.__getitem__, words), np.int64, len(words))

    @property
    def sequence(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.slot)), np.diff(self.first))

    def kill(self, low: np.ndarray, high: np.ndarray):
        """Windows that hold a whole range [low, high) are unique."""
        fits = (low >= 0) & (high <= len(self.words)) & (high - low <= self.width)
        change = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(change, np.maximum(high[fits] - self.width, 0), 1)
        np.add.at(change, low[fits] + 1, -1)
        self.alive &= np.cumsum(change)[:-1] == 0

    def in_alive(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether some window that is alive holds the range."""
        sums = np.concatenate(([0], np.cumsum(self.alive)))
        a, b = np.clip(high - self.width, 0, len(self.words)), np.clip(low + 1, 0, len(self.words))
        return (low >= 0) & (high <= len(self.words)) & (sums[np.maximum(a, b)] > sums[a])

    def ask(self, level: int):
        """(keys, whether two documents here have it): distinct words, or distinct pairs of the next level."""
        if level == 0:
            keys, self.which, slot = self.keys, self.words, self.slot[self.sequence]
            del self.keys
        else:
            # a run longer than a window joins nothing: no window holds its context
            self.below = s = self.levels[-1].runs(lambda name, size: np.where(size <= self.width, name | size << RUN, -1))
            at, _ = s.pairs(level)
            self.useful = np.flatnonzero(self.in_alive(s.low[at], s.high[at + 1]))
            at = at[self.useful]
            pair, slot = np.stack((s.name[at], s.name[at + 1]), axis=1).view(U), self.slot[s.of[at]]
            order = np.lexsort((pair[:, 1], pair[:, 0]))
            new = heads_of(pair[order, 0], pair[order, 1])
            keys, self.which = pair[order[new]], np.empty(len(order), np.int64)
            self.which[order] = np.cumsum(new) - 1
        low, high = np.full(len(keys), len(self.slot) + 1), np.full(len(keys), -1)
        np.minimum.at(low, self.which, slot)
        np.maximum.at(high, self.which, slot)
        self.n_keys = len(keys)
        return keys, low < high

    def hear(self, level: int, places: np.ndarray, names: np.ndarray):
        """Takes the names of the keys that more than one document has."""
        got = np.full(self.n_keys, -1, np.int64)
        got[places] = names
        mine = got[self.which]
        if level == 0:
            self.words = mine
            lone = np.flatnonzero(mine < 0)
            self.kill(lone, lone + 1)
            self._cut()
            self.levels = [Symbols.of_words(self.words, self.sequence, self.first)]
            return
        s = self.below
        at, named = s.pairs(level)
        asked = at[self.useful]
        lone = mine < 0
        self.kill(s.low[asked[lone]], s.high[asked[lone] + 1])
        new = np.full(len(at), -1, np.int64)
        new[self.useful] = mine
        self.levels.append(named(new))
        del self.below, self.useful

    def _cut(self):
        """Leaves the words of windows that are alive."""
        starts, of = np.flatnonzero(self.alive), self.sequence
        begin, length = stretches(starts, of[starts], self.width)
        at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length - begin, length)
        of = of[begin]
        self.place, self.slot = self.place[of] + begin - self.first[of], self.slot[of]
        self.words, self.alive, self.first = self.words[at], self.alive[at], np.cumsum(np.concatenate(([0], length)))

    def windows(self):
        """(slots, places, digests) of the windows that are alive."""
        at = np.flatnonzero(self.alive)
        values = [mix(s.name.view(U) + U(k)) for k, s in enumerate(self.levels)]
        level, symbol, _ = highest(self.levels, values, at, self.width, len(self.words))
        begin, end, name = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for k, s in enumerate(self.levels):
            i = np.flatnonzero(level == k)
            begin[i], end[i], name[i] = s.begin[symbol[i]], s.end[symbol[i]], s.name[symbol[i]]
        words, names, w = self.words.tobytes(), name.tobytes(), 8 * self.width
        spans = zip((8 * at).tolist(), (8 * begin).tolist(), (8 * end).tolist(), range(0, 8 * len(at), 8), strict=True)
        digests = [blake2b(words[a:b] + names[i : i + 8] + words[e : a + w], digest_size=16, salt=(b - a).to_bytes(2)).digest() for a, b, e, i in spans]
        of = self.sequence[at]
        return self.slot[of], self.place[of] + at - self.first[of], roots_of(digests)


def stretches(starts: np.ndarray, of: np.ndarray, width: int):
    """(begin, length) of the ranges that windows at the starts, in order, cover; windows that overlap share one."""
    if not len(starts):
        return starts, starts
    new = np.concatenate(([True], (starts[1:] >= starts[:-1] + width) | (of[1:] != of[:-1])))
    begin, last = starts[new], starts[np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)]
    return begin, last + width - begin


def sent_part(part: Part, ident: bytes, level: int, parts: int, names: int) -> list[tuple]:
    """Rows of a part that waits for the names of a level: its questions, and itself."""
    keys, again = part.ask(level)
    out = [(b, ASK, ident, keys[i], i.astype(np.uint32), again[i]) for b, i in by_bucket(mix(keys[:, 0] ^ mix(keys[:, 1])) % U(names))]
    blob = zstandard.ZstdCompressor(level=1).compress(pickle.dumps(part, 5))
    return [*out, (int.from_bytes(ident[:8]) % parts, PART, ident, blob)]


def owners(level: int, parts: int, names: int):
    """Questions in, answers out: a number for each key that more than one document has. There are `names` owners."""

    def run(batches):
        by: dict[int, list[tuple]] = {}
        for batch in batches:
            for bucket, ident, keys, places, again in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4, 5)), strict=True):
                by.setdefault(bucket, []).append((ident, keys, places, again))
        for bucket, rows in by.items():
            idents, keys, places, again = zip(*rows, strict=True)
            asked = [len(p) // 4 for p in places]
            key, twice = joined(keys, U).reshape(-1, 2), joined(again, bool)
            order = np.lexsort((key[:, 1], key[:, 0]))
            heads = np.flatnonzero(heads_of(key[order, 0], key[order, 1]))
            size = np.diff(np.append(heads, len(order)))
            number = np.repeat(np.arange(len(heads)), size)
            shared = np.repeat((size > 1) | np.maximum.reduceat(twice[order], heads), size)
            if (len(heads) * names) << 2 >> RUN:
                raise OverflowError("more names than a run leaves bits for")
            name = np.full(len(order), -1, np.int64)
            name[order[shared]] = (number[shared] * names + bucket) << 2 | level
            ends = np.cumsum(asked).tolist()
            for ident, place, a, b in zip(idents, places, [0, *ends], ends, strict=False):
                known = name[a:b] >= 0
                if known.any():
                    yield packed_rows([(int.from_bytes(ident[:8]) % parts, ANSWER, ident, np.frombuffer(place, np.uint32)[known], name[a:b][known])])

    return run


class WordRepeats:
    """Words as units: windows of `width` words that also start in a document with a smaller doc_id."""

    def __init__(self, width: int, rounds: int = LEVELS, as_words: bool = True):
        self.width, self.rounds, self.as_words, self.compared = width, rounds, as_words, PART_BYTES

    def root(self, raw: bytes) -> bytes:
        words = raw.split()
        return blake2b(b" ".join(words), digest_size=16).digest() if len(words) >= self.width else bytes(16)

    def units(self, raw: bytes) -> int:
        return len(raw.split())

    def marks(self, raws: list[bytes]):
        words, doc, first = parsed(raws)
        at, mark = window_marks(words, doc, first, self.width, self.rounds)
        owner = doc[at]
        keep = heads_of(mark, owner)
        mark, owner = mark[keep], owner[keep]
        order = np.lexsort((owner, mark))
        mark, owner = mark[order], owner[order]
        keep = heads_of(mark, owner)
        return mark[keep], owner[keep], np.zeros(int(keep.sum()), bool)

    def probe(self, docs: list[tuple], parts: int, names: int):
        """A part of the windows under shared marks, with its first questions."""
        owners, places = [], []
        for a, b in slices([d[3] for d in docs]):
            words, doc, first = parsed([d[3] for d in docs[a:b]])
            at, mark = window_marks(words, doc, first, self.width, self.rounds)
            salt = mix(np.arange(b - a, dtype=U) + U(1))
            shared = np.concatenate([mix(d[4]) ^ s for d, s in zip(docs[a:b], salt, strict=True)])
            at = at[np.isin(mix(mark) ^ salt[doc[at]], shared)]
            owners.append(doc[at] + a)
            places.append(at - first[doc[at]])
        owner, place = map(np.concatenate, (owners, places))
        if not len(owner):
            return [], []
        begin, length = stretches(place + owner * (1 << 40), owner, self.width)
        of, begin = begin >> 40, begin & ((1 << 40) - 1)
        words: list[bytes] = []
        split, last = [], -1
        for k, b, n in zip(of.tolist(), begin.tolist(), length.tolist(), strict=True):
            if k != last:
                split, last = docs[k][3].split(), k
            words += split[b : b + n]
        first = np.cumsum(length) - length
        alive = np.zeros(len(words), bool)
        stretch = np.searchsorted(begin + of * (1 << 40), place + owner * (1 << 40), "right") - 1
        alive[first[stretch] + place - begin[stretch]] = True
        slot, table = doc_table(docs, of)
        return [], sent_part(Part(table, words, length, slot.astype(np.int64), begin, alive, self.width), uuid.uuid4().bytes, 0, parts, names)

    def advance(self, level: int, parts: int, owned: int):
        """Parts and their answers, in order, in; the parts with their next questions out, or after the last round their windows."""

        def done(ident, part, places, names):
            part.hear(level, joined(places, np.uint32), joined(names, np.int64))
            if not part.alive.any():
                return []
            return sent_part(part, ident, level + 1, parts, owned) if level < self.rounds else self.first_windows(part, parts)

        def run(batches):
            unpack, at, part, places, names = zstandard.ZstdDecompressor().decompress, None, None, [], []
            for batch in batches:
                for kind, ident, b, c in zip(*(batch.column(k) for k in (1, 2, 3, 4)), strict=True):
                    ident = ident.as_py()
                    if ident != at:
                        if part is not None:
                            yield packed_rows(done(at, part, places, names))
                        at, part, places, names = ident, None, [], []
                    if kind.as_py() == PART:
                        part = pickle.loads(unpack(b.as_py()))
                    else:
                        places.append(b.as_py())
                        names.append(c.as_py())
            if part is not None:
                yield packed_rows(done(at, part, places, names))

        return run

    def first_windows(self, part: Part, parts: int) -> list[tuple]:
        """Of equal windows of the part, those beyond the smallest doc_id go; the others meet those of other parts."""
        slot, place, key = part.windows()
        _, keys, ids, roots = read_tables([part.table], [b""])
        late, order = later(key, ids[slot])
        docs = list(zip(keys.tolist(), ids.tolist(), (bytes(r) for r in roots), strict=True))
        out = self.gone(slot[late], place[late], keys, roots, parts)
        for b, i in by_bucket(key[order, 0] % U(parts)):
            i = order[i]
            i = i[np.lexsort((place[i], slot[i]))]
            at, table = doc_table(docs, slot[i])
            out.append((b, WINDOW, key[i], place[i].astype(np.uint32), at, table))
        return out

    def verify(self, parts: int):
        """Of equal windows, those beyond the smallest doc_id go."""

        def run(batches):
            key, place, slots, tables, _, _ = gathered(batches)[WINDOW]
            key, place = joined(key, U).reshape(-1, 2), joined(place, np.uint32).astype(np.int64)
            doc, keys, ids, roots = read_tables(tables, slots)
            late, _ = later(key, ids[doc])
            yield packed_rows(self.gone(doc[late], place[late], keys, roots, parts))

        return run

    def gone(self, doc, place, keys, roots, parts: int) -> list[tuple]:
        """Rows of outcomes: the windows at these places of the documents go."""
        doc, begin, end = covered(doc, place.astype(np.int64), self.width)
        return range_rows(keys[doc], np.ascontiguousarray(roots[doc]).view(U).reshape(-1, 2), np.stack((begin, end), axis=1), parts)

    def resolve(self, rows: DataFrame, parts: int, names: int, drop) -> DataFrame:
        """The rounds, one Spark job each."""
        out = rows.filter(f"kind = {OUTCOME}")
        for level in range(self.rounds + 1):
            answers = dealt(rows.filter(f"kind = {ASK}"), names, owners(level, parts, names))
            both = rows.filter(f"kind = {PART}").unionByName(answers).repartitionById(parts, F.col("bucket")).sortWithinPartitions("a", "kind")
            after, drop_after = kept(both.mapInArrow(given_back(self.advance(level, parts, names)), ROW), "kind")
            for kind in (ASK, PART):
                drop(f"kind={kind}")
            release(rows.sparkSession)
            rows, drop = after.select(*ROW_NAMES), drop_after
        return out.unionByName(rows.filter(f"kind = {OUTCOME}")).unionByName(dealt(rows.filter(f"kind = {WINDOW}"), parts, self.verify(parts)))

    def result(self, raw: bytes, ranges: np.ndarray):
        """n_words, n_removed, kept."""
        if not len(ranges) and not self.as_words:
            return self.units(raw), 0, raw
        if not self.as_words:
            _, starts, ends, _, _ = split_words([raw])
            parts, at = [], 0
            for a, b in ranges.tolist():
                parts.append(raw[at : starts[a]])
                at = starts[b] if b < len(starts) else ends[-1]
            return len(starts), int((ranges[:, 1] - ranges[:, 0]).sum()), b"".join([*parts, raw[at:]])
        words = raw.split()
        if not len(ranges):
            return len(words), 0, b" ".join(words)
        kept, at = [], 0
        for a, b in ranges.tolist():
            kept += words[at:a]
            at = b
        kept += words[at:]
        return len(words), len(words) - len(kept), b" ".join(kept)


def later(key: np.ndarray, ids: np.ndarray):
    """(places whose key a smaller id has, the others in order of key)."""
    order = np.lexsort((ids, key[:, 1], key[:, 0]))
    new = heads_of(key[order, 0], key[order, 1])
    late = ids[order] > ids[order[new]][np.cumsum(new) - 1] if len(order) else new
    return order[late], order[~late]


RESULTS = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.BinaryType())]


def remove_repeats(docs: DataFrame, text: str = "text", ident: str = "doc_id", width: int = WIDTH, as_words: bool = True, rounds: int = LEVELS) -> DataFrame:
    """docs with n_words, n_removed and kept in place of the text: UTF-8 bytes of the kept words joined by one space.

    With as_words false, `kept` is the text itself without the removed words and the white space
    after them, and a document that loses none keeps it untouched.
    """
    return settle(docs, WordRepeats(width, rounds, as_words), text, ident, RESULTS)
