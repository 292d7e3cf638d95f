"""The corpus operators against brute force, round trips and held-out accuracy, with edge rows in every table."""

import hashlib
import itertools
import json
import os
import random
import re
import struct
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from sparkloom.llm import ann, bpe, chat, langid, licences, line_rules, mixing, recompress, simhash, suffixes
from sparkloom.llm.common import components
from sparkloom.llm.repeats import packed_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string, fp string, fingerprint string, mark long"


def sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def corpus(n: int = 70, seed: int = 1) -> list[tuple]:
    """Copies, near copies, shared passages, runs of one word or character, empty, null and long texts, clashing columns."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    text = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    passage, texts = text(60), []
    for i in range(n):
        t = text(rng.randint(0, 150))
        if i % 4 == 1:
            t = t + "\n" + passage + "\n" + text(20)
        if i % 7 == 3:
            t = texts[rng.randrange(len(texts))] or ""
        if i % 9 == 5:
            words = (texts[rng.randrange(len(texts))] or "x").split(" ")
            words[rng.randrange(len(words))] = "changed"
            t = " ".join(words)
        texts.append(t)
    texts += [None, "", " \t\n", "a " * 200, "b " * 13 + "a " * 13, "ab" * 400, "abc" * 200, "aaaa" * 200, text(6000), texts[0], texts[1], "one two three", passage, "…" * 300]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(k, t, "en", None if k % 11 == 0 else f"s{k % 3}", 1, "k", "s", "f", "g", 5) for k, t in zip(order, texts, strict=True)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(docs):
    return sorted(docs.select("doc_id", "text").collect(), key=lambda r: r.doc_id)


def test_substring_dedup_equals_brute_force(docs):
    got = {r.doc_id: r for r in recompress.remove_repeats(docs).collect()}
    seen, removed = set(), 0
    for r in rows_of(docs):
        w = WORD.findall(r.text or "")
        gone, windows = set(), [tuple(w[i : i + 13]) for i in range(len(w) - 12)]
        for i, x in enumerate(windows):
            if x in seen:
                gone |= set(range(i, i + 13))
        seen |= set(windows)
        removed += len(gone)
        g = got[r.doc_id]
        assert (g.n_words, g.n_removed, bytes(g.kept).decode()) == (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)), r.doc_id
        assert g.size == "s" and g.mark == 5
    assert removed > 1000


def test_substring_dedup_can_keep_the_layout(docs):
    got = {r.doc_id: bytes(r.kept).decode() for r in recompress.remove_repeats(docs, as_words=False).collect()}
    words = {r.doc_id: bytes(r.kept).decode() for r in recompress.remove_repeats(docs).collect()}
    assert all(WORD.findall(got[k]) == WORD.findall(words[k]) for k in got)
    assert any(got[r.doc_id] == r.text and "\n" in r.text for r in rows_of(docs) if r.text)


def test_suffix_dedup_equals_brute_force(docs):
    got = {r.doc_id: r for r in suffixes.remove_repeats(docs).collect()}
    seen, removed = set(), 0
    for r in rows_of(docs):
        b = (r.text or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 99):
            if b[i : i + 100] in seen:
                gone[i : i + 100] = True
            seen.add(b[i : i + 100])
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        g = got[r.doc_id]
        assert (g.n_bytes, g.n_removed, g.n_spans, bytes(g.kept)) == (len(b), gone.sum(), spans, np.frombuffer(b, np.uint8)[~gone].tobytes()), r.doc_id
        removed += gone.sum()
    assert removed > 3000


def test_repeats_of_null_and_repeated_ids(spark):
    t, u = (" ".join(f"{c}{i}" for i in range(40)) for c in "wv")
    d = spark.createDataFrame([(None, t), (None, u), (7, t), (7, t), (7, u), (3, "x"), (9, t + " more")], "doc_id long, text string")
    want = {(None, t): 1, (None, u): 1, (7, t): 0, (7, u): 0, (3, "x"): 0, (9, t + " more"): 1}
    rows = Counter((r.doc_id, r.text) for r in d.collect())
    for module, size in ((recompress, 40), (suffixes, len(t))):
        got = Counter((r.doc_id, r.text, r.n_removed) for r in module.remove_repeats(d.withColumn("copy", F.col("text")), "copy").collect())
        assert got == {(k, x, (size if gone else 0)): rows[k, x] for (k, x), gone in want.items()}


def test_substring_dedup_tells_words_apart_that_weak_hashes_mix_up(spark):
    """The Thue-Morse word over two letters and its complement have equal polynomial hashes modulo 2 ** 64."""
    thue = "".join("ab"[i.bit_count() % 2] for i in range(4096))
    rest = " ".join(f"w{i}" for i in range(12))
    rows = [(k, f"{w} {rest}") for k, w in enumerate((thue, thue.translate({97: 98, 98: 97}), thue[:1024], thue[:1024].translate({97: 98, 98: 97}), "ab" * 8, "ab" * 7 + "a", thue))]
    got = {r.doc_id: r.n_removed for r in recompress.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 13}


@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_substring_dedup_at_any_number_of_rounds(spark, monkeypatch, rounds):
    """Small parts, so that names must agree between them, and few words, so that runs and pairs abound."""
    rng = random.Random(rounds)
    passages = [" ".join(rng.choice("ab" if k % 2 else "abcdefgh") for _ in range(rng.randint(10, 60))) for k in range(12)]
    rows = []
    for k in range(150):
        own = " ".join(rng.choice("abcdefghijklmnop") + rng.choice(("", "", str(k))) for _ in range(rng.randrange(40)))
        rows.append((k, f"{own} {rng.choice(passages)} {rng.choice('abc ') * 2} {rng.choice(passages) if k % 3 else ''} {'z ' * rng.randrange(30)}"))
    monkeypatch.setattr(recompress, "PART_BYTES", 600)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r.doc_id: (r.n_removed, bytes(r.kept).decode()) for r in recompress.remove_repeats(df, rounds=rounds).collect()}
    assert got == brute_windows(rows)


def brute_windows(rows) -> dict:
    seen, out = set(), {}
    for k, text in sorted(rows):
        w = WORD.findall(text)
        windows = [tuple(w[i : i + 13]) for i in range(len(w) - 12)]
        gone = {i + j for i, x in enumerate(windows) if x in seen for j in range(13)}
        seen |= set(windows)
        out[k] = (len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def rounds_in_process(rows, muddle=lambda level, names: names):
    """n_removed by document, by the rounds alone: no mark spares them anything."""
    scheme, parts, names = recompress.WordRepeats(13), 3, 2
    read = lambda batches: [tuple(r.values()) for b in batches for r in b.to_pylist()]
    docs = [(k, k, scheme.root(t.encode()), t.encode(), scheme.marks([t.encode()])[0]) for k, t in rows]
    half = len(docs) // 2
    held = read(packed_rows(scheme.probe(some, parts, names)[1]) for some in (docs[:half], docs[half:]))
    for level in range(scheme.rounds + 1):
        answers = read(recompress.owners(level, parts, names)([packed_rows([r for r in held if r[1] == recompress.ASK])]))
        answers = [(*r[:4], muddle(level, np.frombuffer(r[4], np.int64)).tobytes(), *r[5:]) for r in answers]
        both = sorted([r for r in held if r[1] == recompress.PART] + answers, key=lambda r: (r[2], r[1]))
        held = [r for r in held if r[1] == recompress.OUTCOME] + read(scheme.advance(level, parts, names)([packed_rows(both)]))
    held += read(scheme.verify(parts)([packed_rows([r for r in held if r[1] == recompress.WINDOW])]))
    gone = {k: set() for k, _ in rows}
    for r in held:
        if r[1] == recompress.OUTCOME:
            for k, (a, b) in zip(np.frombuffer(r[2], np.int64).tolist(), np.frombuffer(r[4], np.int64).reshape(-1, 2).tolist(), strict=True):
                gone[k] |= set(range(a, b))
    return {k: len(x) for k, x in gone.items()}


def test_substring_dedup_rests_on_the_names_of_its_rounds():
    """Windows are told apart by the numbers that the rounds give: with those of pairs muddled the result is wrong."""
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice("abcdefghijkl") for _ in range(300))) for k in range(40)]
    rows += [(40 + k, rows[k][1].translate({97: 98, 98: 97})) for k in range(40)] + [(80 + k, rows[k][1][200:500]) for k in range(20)]
    want = {k: n for k, (n, _) in brute_windows(rows).items()}
    assert sum(want.values()) > 1000
    assert rounds_in_process(rows) == want
    assert rounds_in_process(rows, lambda level, names: names if level == 0 else names * 0 + level) != want


def test_suffix_order_is_exact():
    rng = random.Random(2)
    for _ in range(200):
        x = [rng.randint(1, rng.choice((1, 2, 4))) for _ in range(rng.randrange(1, 150))]
        assert suffixes.suffix_order(np.array(x, np.int64), 10**9).tolist() == sorted(range(len(x)), key=lambda i: x[i:])


def test_equal_windows_have_equal_marks():
    rng = random.Random(3)
    for _ in range(40):
        w = [rng.choice("ab") if rng.random() < 0.5 else rng.choice("abcdefgh") for _ in range(80)]
        raws = [" ".join(rng.choices("abc", k=rng.randrange(9)) + w + rng.choices("abc", k=rng.randrange(9))).encode() for _ in range(4)]
        words, doc, first = recompress.parsed(raws)
        every = [x for raw in raws for x in raw.split()]
        at, mark = recompress.window_marks(words, doc, first, 13)
        assert len(at) == sum(len(raw.split()) - 12 for raw in raws)
        seen = {}
        for p, m in zip(at.tolist(), mark.tolist(), strict=True):
            assert seen.setdefault(tuple(every[p : p + 13]), m) == m


def brute_simhash(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    h = [xxhash.xxh64_intdigest(" ".join(x).encode(), 42) for x in ([w[i : i + 4] for i in range(len(w) - 3)] or [w])] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_simhash_equals_brute_force(docs):
    rows = rows_of(docs)
    fp = {r.doc_id: brute_simhash(r.text) for r in rows}
    root = {k: k for k in fp}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(sorted(fp), 2):
        if (fp[a] ^ fp[b]).bit_count() <= 4 and find(a) != find(b):
            root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {k: (f"{fp[k]:016x}", find(k)) for k in fp}
    kept = sorted(r.doc_id for r in simhash.one_of_each(docs).collect())
    assert kept == sorted(k for k in fp if find(k) == k) and len(kept) < len(fp)


@pytest.mark.parametrize("chunk", [16_384, 8])
def test_simhash_links_of_dense_groups(spark, monkeypatch, chunk):
    """Nodes over CHUNK are split; links within and across chunks must still be found."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rng = random.Random(4)
    fps = {rng.getrandbits(64) for _ in range(100)}
    for c in [rng.getrandbits(64) for _ in range(4)]:
        fps |= {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for _ in range(40)}
    fps = sorted(fps)
    signed = {f: f - (1 << 64) if f >> 63 else f for f in fps}
    got = simhash.links(spark.createDataFrame([(signed[f],) for f in fps], "fp long"))
    roots = {r.node: r.root for r in components(got).collect()}
    label = {f: f for f in fps}
    for _ in range(len(fps)):
        before = dict(label)
        for a, b in itertools.combinations(fps, 2):
            if (a ^ b).bit_count() <= 4:
                label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    groups = lambda of: {frozenset(g) for g in _grouped(fps, of)}
    assert groups(lambda f: label[f]) == groups(lambda f: roots.get(signed[f], signed[f]))


def _grouped(items, of):
    out = {}
    for x in items:
        out.setdefault(of(x), set()).add(x)
    return out.values()


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 160)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_bpe_equals_tiktoken(docs):
    ids = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    back = bpe.decode(ids, RANKS, public_tokenizers.PATTERN).collect()
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    for r in back:
        want = own.encode_ordinary(r.text or "")
        assert bytes(r.token_ids) == struct.pack(f"<{len(want)}I", *want) and r.n_tokens == len(want) and bytes(r.decoded) == (r.text or "").encode()


def test_bpe_of_long_pre_tokens(monkeypatch):
    monkeypatch.setattr(bpe, "PIECES", 50)  # long texts come in parts
    e = bpe.Encoder(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=e.ranks, special_tokens={})
    rng = random.Random(6)
    for alphabet in ("a", "ab", "aé漢", "abc <|endoftext|>", "\n\t 　", "0123456789!?"):
        texts = ["".join(rng.choice(alphabet) for _ in range(n)) for n in (1, 7, 300, 20_000)]
        for text, got in zip(texts, e.encode(texts), strict=True):
            want = own.encode_ordinary(text)
            assert got == struct.pack(f"<{len(want)}I", *want)
        assert [x.decode() for x in e.decode(e.encode(texts))] == texts


def bpe_batches(spark, monkeypatch, texts):
    """What encode_and_decode makes of one Arrow batch of texts, batch by batch; in this process."""
    tasks, rows = [], spark.createDataFrame([], "k long, text string")
    mapped = type(rows).mapInArrow
    monkeypatch.setattr(type(rows), "mapInArrow", lambda self, f, schema: tasks.append(f) or mapped(self, f, schema))
    bpe.encode_and_decode(rows, RANKS, public_tokenizers.PATTERN)
    number = pa.StructArray.from_arrays([pa.array(range(len(texts)), pa.int64())], names=["k"])
    return tasks[0](iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), number], names=["_source", "_row"])]))


def test_bpe_needs_memory_for_a_part_of_a_batch(spark, monkeypatch):
    rng = random.Random(12)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(3000)]
    texts = [" ".join(rng.choices(vocab, k=1000)) for _ in range(2400)]
    assert sum(map(len, texts)) > 11e6
    list(bpe_batches(spark, monkeypatch, texts[:1]))  # the tables of a worker
    monkeypatch.undo()
    batches, n = bpe_batches(spark, monkeypatch, texts), 0
    tracemalloc.start()
    try:
        for b in batches:
            n += b.num_rows
            assert b.nbytes < 8e6
            del b
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == len(texts) and most < 30e6


def test_bpe_by_parts_of_batches(spark, monkeypatch):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    texts = [None, "", "é漢 " * 40, "a", None, "b c", "", "x y z " * 20, "end", None]
    for size in (1, 9, 121, 10_000):
        monkeypatch.setattr(bpe, "BATCH_BYTES", size)
        got = [r for b in bpe_batches(spark, monkeypatch, texts) for r in b.to_pylist()]
        assert [r["_row"]["k"] for r in got] == list(range(len(texts)))
        for text, r in zip(texts, got, strict=True):
            want = own.encode_ordinary(text or "")
            assert r["token_ids"] == struct.pack(f"<{len(want)}I", *want) and r["n_tokens"] == len(want) and r["decoded"] == (text or "").encode()
        monkeypatch.undo()


@pytest.mark.parametrize("first", [0, 70_000, 20_000_000])
def test_bpe_of_any_ranks(first):
    """Ranks that merging could not have built, and ranks of any height."""
    rng = random.Random(first)
    for _ in range(20):
        tokens = list({bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 6))) for _ in range(rng.randrange(1, 25))})
        rng.shuffle(tokens)
        ranks = {bytes([k]): k for k in range(256)} | {t: 256 + first + k for k, t in enumerate(tokens)}
        e = bpe.Encoder(ranks, r"[a-z]+| ")
        own = tiktoken.Encoding("own", pat_str=r"[a-z]+| ", mergeable_ranks=ranks, special_tokens={}) if not first else None
        texts = ["".join(rng.choice("aabc ") for _ in range(rng.randrange(60))) for _ in range(30)]
        for text, got in zip(texts, e.encode(texts), strict=True):
            want = own.encode_ordinary(text) if own else [i for x in e.find(text) for i in e.merge(x.encode())]
            assert got == struct.pack(f"<{len(want)}I", *want)
        assert [x.decode() for x in e.decode(e.encode(texts))] == texts
    with pytest.raises(ValueError, match="vocabulary"):
        e.decode([struct.pack("<I", 256 + first + len(tokens))])


def test_a_vocabulary_without_a_byte_raises(spark, tmp_path):
    import base64

    path = f"{tmp_path}/few.tiktoken"
    with open(path, "wb") as f:
        f.write(b"".join(base64.b64encode(bytes([b])) + b" %d\n" % i for i, b in enumerate(range(97, 105))))
    few = spark.createDataFrame([("abc abcd",)], "text string")
    with pytest.raises(Exception, match="no token for byte 32"):
        bpe.encode(few, path, "[a-z]+| ").collect()
    assert [r.n_tokens for r in bpe.encode(few.select(F.lit("abch").alias("text")), path, "[a-z]+| ").collect()] == [4]
    alone = bpe.Encoder(bpe.read_ranks(path), "[a-z]+")
    with pytest.raises(ValueError, match="no token for byte 122"):
        alone.merge(b"abz")


def test_quality_rules_equal_brute_force(spark, docs):
    got = {r.doc_id: r for r in line_rules.quality_rules(docs).collect()}
    for r in rows_of(docs):
        text = r.text or ""
        w = WORD.findall(text)
        windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        repeated = {i + j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        g = got[r.doc_id]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == want
        assert g.base_failed == (len(w) < 50 or 100 * len(repeated) > 50 * len(w))


def test_quality_rules_reject_depleted_documents_only(spark):
    menu = "Home, about and contact us " * 5
    own = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(k, menu.upper() if k % 2 else menu, "h") for k in range(30)]
    rows = [(k, f"{t}\n" * 3 + own(k)[:60] + "\n" + " ".join(f"v{k}x{i}" for i in range(12)), h) for k, t, h in rows]
    rows += [(100 + k, own(k) + "\n" + menu, "h") for k in range(5)] + [(200 + k, menu + "\n" + own(k), "other") for k in range(5)] + [(300 + k, own(77), "h") for k in range(40)]
    judged = lambda **x: {r.doc_id: r.kept for r in line_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string"), **x).collect()}
    got = judged(count="texts")
    assert not any(got[k] for k in range(30)) and all(got[k] for k in got if k >= 100)
    got = judged()  # the page copied 40 times loses its lines as well
    assert not any(got[k] for k in range(30)) and {k for k in got if k >= 100 and not got[k]} == {300 + k for k in range(40)}
    with pytest.raises(ValueError, match="documents or texts"):
        judged(count="lines")


def brute_lines(rows, limit=10, share=0.02):
    """{id: text without the lines that too many documents of its host hold}."""
    norm = lambda x: " ".join(re.findall(r"[^\W_]+", x.lower()))
    held, hosts = Counter(), Counter(h for _, _, h in rows)
    for _, text, h in rows:
        held.update({(h, norm(x)) for x in (text or "").split("\n") if norm(x)})
    often = {k for k, n in held.items() if n > limit and n > share * hosts[k[0]]}
    stays = lambda x, h: (h, norm(x)) not in often
    return {i: (text and "\n".join(x for x in text.split("\n") if stays(x, h)), sum(not stays(x, h) for x in (text or "").split("\n"))) for i, text, h in rows}


def test_removed_lines_equal_brute_force(spark):
    rng = random.Random(6)
    common = ["Subscribe now!", "menu | home", "ÉCOLE 12", "***", "", "read MORE"]
    line = lambda: rng.choice(common) if rng.random() < 0.4 else " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 12)))
    rows = [(i, None if i % 50 == 7 else "\n".join(line() for _ in range(rng.randrange(0, 9))), rng.choice(["a", "a", "b", None])) for i in range(300)]
    rows += [(300 + i, rows[3][1], "b") for i in range(15)]
    got = {r.doc_id: (r.clean_text, r.n_removed_lines) for r in line_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)).collect()}
    assert got == brute_lines(rows) and sum(n for _, n in got.values()) > 100


def test_quality_rules_remove_lines_above_the_limits(spark):
    own = lambda i, k: " ".join(f"w{i}x{j}" for j in range(k))
    rows = [(i, f"Read  more!\n{own(i, 60)}\n\n read more\nlast {i}", "a") for i in range(30)]
    rows += [(30, rows[0][1], "a"), (31, f"read more\n{own(31, 60)}", "b"), (32, None, "a"), (33, f"{own(33, 60)}\n", "a")]
    got = {r.doc_id: r for r in line_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    for i, text, _ in rows:
        assert got[i].text == text and got[i].n_removed_lines == (2 if i <= 30 else 0)
        assert got[i].clean_text == (f"{own(i % 30, 60)}\n\nlast {i % 30}" if i <= 30 else text)
        assert got[i].kept == (i != 32)


def test_mixing_meets_targets(spark):
    rng = random.Random(8)
    rows = [(k, " ".join("w" for _ in range(int(rng.paretovariate(1.2) * 20) % 4000)), f"s{min(9, k % 25)}" if k % 17 else None) for k in range(1500)]
    rows += [(9999, None, "empty"), (9998, "  ", "empty")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    again = mixing.mix(spark.createDataFrame(rows[::-1], "doc_id long, text string, source string").repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)
    size, taken = Counter(), Counter()
    for r in got:
        size[r.source] += r.size
        taken[r.source] += r.taken
        assert r.taken <= 3 * r.size and r.source_size is not None
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    target, capped = {}, set()
    while True:
        left = sum(size.values()) - sum(3 * size[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        target = {s: 3 * size[s] if s in capped else left * weight[s] / free for s in order}
        more = {s for s in order if s not in capped and target[s] > 3 * size[s]}
        if not more:
            break
        capped |= more
    for r in got:
        assert abs(r.target - target[r.source]) <= 1e-6 * max(1, target[r.source])
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] + 50 for s in order)


CHAT = [
    ({"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "</s>[INST] ok [/INST]"}, {"role": "assistant", "content": "a \\ b <s>"}]}, "messages"),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "id": 3}, "conversations"),
    ({"instruction": "do", "input": "this", "output": "done", "system": None}, "instruction"),
    ({"prompt": "p", "completion": "c"}, "prompt_completion"),
    ({"question": "q", "answer": "a", "source": "x"}, "question_answer"),
    ({"weird": 1}, "unmapped"),
]


def test_chat_layouts_and_round_trip(spark):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, (d, _) in enumerate(CHAT)] + [(90, "not json"), (91, None)], "n long, record string")
    got = {r.n: r for r in chat.format_chat(df).collect()}
    assert [got[i].layout for i in range(len(CHAT))] == [x for _, x in CHAT] and got[90].formatted is None and got[91].layout == "unmapped"
    turns, loss = chat.read_back(got[0].formatted, got[0].loss_spans)
    assert turns == [("system", "s"), ("user", "</s>[INST] ok [/INST]"), ("assistant", "a \\ b <s>")] and loss == ["a \\ b <s>"]
    assert chat.read_back(got[2].formatted, got[2].loss_spans)[0] == [("user", "do\n\nthis"), ("assistant", "done")]


def test_chat_escapes_reverse():
    rng = random.Random(9)
    for _ in range(3000):
        text = "".join(rng.choice(["<", "s", ">", "/", "[", "]", "INST", "\\", " ", "a", "\n", "<s>", "</s>", "[INST]", "[/INST]"]) for _ in range(rng.randrange(12)))
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text and not re.search(r"</?s>|\[/?INST\]", escaped)


def test_chat_digests(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (2, 0, None, "x"), (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in chat.digests(chat.format_chat(chat.records(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))).collect()}
    assert got[1].turns_sha256 == sha(b"user\n\nassistant\nb\n") and (got[1].n_turns, got[1].loss_chars) == (2, 1)
    assert got[2].turns_sha256 == sha(b"\nx\n") and got[2].loss_chars == 0
    assert got[-1].loss_sha256 == sha(b"</s>[INST] ok [/INST]")


def test_neighbours_recall_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(1)
    v = rng.standard_normal((1500, 16)).astype(np.float32)
    v[200:700] = v[200]
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] * 16), (2060, [None] * 16), (2080, [1.0]), (None, v[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in ann.nearest_neighbours(df, df.filter("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    x, hits = v.astype(float), 0
    for q in range(0, 1500, 20):
        s = x @ x[q]
        s[q] = -np.inf
        want = np.lexsort((np.arange(1500), -s))[:20]
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, 21)) and q not in {i for _, i, _ in mine}
        assert all(abs(score - s[i]) < 1e-9 for _, i, score in mine)
        hits += len({i for _, i, _ in mine} & set(want.tolist()))
    assert hits >= 0.9 * 75 * 20 and set(got) == set(range(0, 1500, 20))


def test_neighbours_within_a_large_group_of_near_copies(spark, monkeypatch):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(5000, 32)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    noise = rng.normal(size=(3000, 32)).astype(np.float32)
    x[2000:] = x[2000] + 0.01 * noise / np.linalg.norm(noise, axis=1)[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").cache()
    index = ann.Index(x[:2015], len(x), ann.NEIGHBOURS)  # 15 of the group in the sample
    monkeypatch.setattr(ann.Index, "__init__", lambda self, *_: vars(self).update(vars(index)))
    asked = list(range(2000, 5000, 100))
    got = {}
    for r in ann.nearest_neighbours(df, df.filter("vec_id >= 2000 AND vec_id % 100 = 0")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    scores = x[asked].astype(float) @ x.T.astype(float)
    scores[np.arange(len(asked)), asked] = -np.inf
    found = sum(len(got[i] & set(np.argsort(-s)[: ann.NEIGHBOURS].tolist())) for i, s in zip(asked, scores, strict=True))
    assert found >= 0.95 * ann.NEIGHBOURS * len(asked)


def test_neighbours_of_few(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.0, 1.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = {(r.query_id, r.rank): r.vec_id for r in ann.nearest_neighbours(df, df.filter("vec_id % 20 = 0")).collect()}
    assert got == {(0, 1): 3, (0, 2): 20, (20, 1): 3, (20, 2): 0}
    assert ann.nearest_neighbours(df.limit(0), df).count() == 0


def test_language_of_held_out_rows(spark):
    rng = random.Random(10)
    alphabets = {"aa": "abcde", "bb": "cdefg", "cc": "efghé"}
    rows = [(i, " ".join("".join(rng.choice(alphabets[x]) for _ in range(rng.randint(2, 7))) for _ in range(30)), x) for i, x in enumerate(["aa", "bb", "cc"] * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("held_out", langid.is_held_out(F.col("doc_id")))
    model = langid.fit(df.filter("NOT held_out"))
    got = langid.identify(df.filter("held_out"), model).collect()
    assert len(got) > 20 and sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got) and all(0 <= r.score <= 1 for r in got)
    odd = spark.createDataFrame([(None,), ("",), ("123 ½ !?",)], "text string")
    assert {(r.lang_pred, r.score) for r in langid.identify(odd, model).collect()} == {("und", 0.0)}
    none = langid.fit(df.limit(0))
    assert langid.identify(df.limit(2), none).first().lang_pred == "und"


def test_language_model_keeps_every_count(spark):
    names = ["".join("abcdefghij"[int(c)] for c in f"{i:06d}") for i in range(120_000)]
    common, rare = names[:110_000], names[110_000:]
    rows = [(" ".join(common[i::50] * 2), "aa") for i in range(50)] + [(" ".join(rare[i::100]), "bb") for i in range(100)]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    asked = spark.createDataFrame([(" ".join(rare[i : i + 30]), "bb") for i in range(0, 10_000, 500)] + [(" ".join(common[i : i + 30]), "aa") for i in range(0, 110_000, 5_000)], "text string, lang string")
    assert all(r.lang_pred == r.lang for r in langid.identify(asked, model).collect())
    scorer = langid.Scorer(*model)
    assert set(scorer.words) == set(names)


def test_licences(spark):
    mit = licences.KNOWN["MIT"]
    rows = [(1, "MIT License\n\nCopyright (c) 2020 Someone\n\n" + mit), (2, mit.upper().replace('"', "'")), (3, mit.replace("sublicense", "sub-license")), (4, mit + " but not for you"), (5, None), (6, " ... "), (7, "released under the mit licence")]
    got = {r.doc_id: r.licence for r in licences.licence_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "MIT", 2: "MIT", 3: "MIT", 4: None, 5: None, 6: None, 7: "MIT-notice"}


def test_whole_licences(spark):
    head, tail = licences.KNOWN["BSD-2-Clause"].split("THIS SOFTWARE IS", 1)
    third = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
    rows = [("BSD-3-Clause", f"BSD 3-Clause License\n\nCopyright (c) 2020, Someone\n\n{head}{third}THIS SOFTWARE IS{tail}")]
    for file, name in (("Apache-2.0", "Apache-2.0"), ("GPL-2", "GPL-2.0"), ("GPL-3", "GPL-3.0"), ("LGPL-2.1", "LGPL-2.1"), ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0"), ("BSD", "BSD-3-Clause")):
        path = f"/usr/share/common-licenses/{file}"
        if os.path.exists(path):
            with open(path, encoding="utf-8") as f:
                rows.append((name, f.read()))
    rows += [(None, text + " but not for you") for _, text in rows]
    got = licences.licence_scan(spark.createDataFrame(rows, "want string, text string")).collect()
    assert len(got) == len(rows) and all(r.licence == r.want and r.is_licence == (r.want is not None) for r in got)


def test_empty_tables(nothing):
    assert recompress.remove_repeats(nothing).count() == 0 and suffixes.remove_repeats(nothing).count() == 0
    assert simhash.near_duplicates(nothing).count() == 0 and line_rules.quality_rules(nothing).count() == 0
    assert mixing.mix(nothing).count() == 0 and licences.licence_scan(nothing).count() == 0
    assert bpe.decode(bpe.encode(nothing, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN).count() == 0
    assert langid.identify(nothing, langid.fit(nothing)).count() == 0
    rows = nothing.selectExpr("doc_id AS conv_id", "doc_id AS turn", "lang AS role", "text")
    assert chat.digests(chat.format_chat(chat.records(rows))).count() == 0


CLASHING = ("mean", "tilt", "cut", "cut_u", "turned", "fp", "root", "up", "low", "n", "host", "text2", "a.b", "_row", "_doc", "_id", "_key", "_z", "_text", "_t", "_w", "_h", "_hot", "_cold", "_value", "_spread", "_r", "_raw", "_found", "_source", "_mark", "marks", "bucket", "kind", "key", "known", "entry", "token", "_lines", "_gone")


def _operators(ranks=RANKS, pattern=public_tokenizers.PATTERN):
    identify = lambda d: langid.identify(d, (["en"], *[__import__("pyarrow").table({"token": ["a"], "lang": ["en"], "n": [1]})] * 2))
    return {
        "licences": licences.licence_scan, "recompress": recompress.remove_repeats, "suffixes": suffixes.remove_repeats, "simhash": simhash.near_duplicates,
        "one_of_each": simhash.one_of_each, "line_rules": line_rules.quality_rules, "mixing": mixing.mix, "langid": identify,
        "encode": lambda d: bpe.encode(d, ranks, pattern), "encode_and_decode": lambda d: bpe.encode_and_decode(d, ranks, pattern),
        "decode": lambda d: bpe.decode(d.withColumn("token_ids", F.lit(b"\1\0\0\0")), ranks, pattern),
        "chat": lambda d: chat.format_chat(d.withColumn("record", F.to_json(F.struct("text")))),
    }


@pytest.mark.parametrize("name", sorted(_operators()))
def test_other_columns_pass_with_their_values(spark, name):
    """Whatever they are called; repeated rows stay apart, nulls anywhere, and an empty table gives an empty result with the same columns."""
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (2, None, None), (None, "one two", "s"), (3, "", "t"), (4, "x " * 70, None), (None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    df = df.select("*", *(F.concat_ws("-", F.lit(c), F.col("doc_id").cast("string"), "text").alias(c) for c in CLASHING))
    run = _operators()[name]
    out = run(df)
    assert len(set(out.columns)) == len(out.columns) and set(CLASHING) <= set(out.columns)
    quoted = [F.col(f"`{c}`") for c in ("doc_id", *CLASHING)]
    want, got = (Counter(tuple(r) for r in d.select(*quoted).collect()) for d in (df, out))
    if name == "one_of_each":
        assert not got - want and got[next(k for k in got if k[0] == 1)] == 1
    else:
        assert got == want
    none = run(df.limit(0))
    assert none.columns == out.columns and none.count() == 0


def test_one_row_of_each_component_whatever_its_id(spark):
    t, u = (" ".join(f"{c}{i}" for i in range(60)) for c in "tu")
    rows = [(1, t), (2, t), (2, u), (None, u + " end"), (3, t), (3, t), (None, "alone and short"), (5, "twice alike"), (5, "twice alike"), (None, "null twice"), (None, "null twice")]
    got = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted([(1, t), (2, u), (0, "alone and short"), (5, "twice alike"), (0, "null twice")])


def test_clauses_are_no_copyright_lines(spark):
    head = "You may do the following.\n"
    rows = [(1, head + "(c) You must not sell the work."), (2, head + "(c) You may sell the work freely."), (3, head), (4, head + "(c) 2020 Someone\nAll rights reserved.\nCopyright (c) Other"), (5, head + "All rights reserved but one.")]
    got = {r.doc_id: r.licence_digest for r in licences.licence_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len({got[k] for k in (1, 2, 3, 5)}) == 4 and got[4] == got[3]


def dot(x, y) -> float:
    total = 0.0  # sum() would compensate
    for a, b in zip(x.tolist(), y.tolist(), strict=True):
        total += a * b
    return total


def test_neighbours_in_double_precision(spark):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((300, 8)) * np.array([1, 1, 1, 1, 1, 1, 1, 1e-3])
    v[5], v[45] = v[5] * 1e30, v[45] * 1e-50
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest_neighbours(df, df.filter("vec_id % 5 = 0"), k=7).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in range(0, 300, 5):
        s = np.array([dot(x, v[q]) for x in v])
        s[q] = -np.inf
        best = np.lexsort((np.arange(300), -s))[:7]
        assert all(score == s[i] for _, i, score in got[q])
        if q in (5, 45):
            assert [i for _, i, _ in sorted(got[q])] == best.tolist()


def test_chat_side_data_does_not_unmap(spark):
    rows = [({"messages": [{"role": "user", "content": "q", "name": "x", "weight": {"a": [1]}}], "metadata": {"deep": {"er": 1}}, "id": [1, 2]}, "messages"), ({"messages": [{"role": "user", "content": ["parts"]}]}, "unmapped"), ({"prompt": "p", "completion": "c", "source": {"url": "u"}}, "prompt_completion")]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, (d, _) in enumerate(rows)], "n int, record string")
    assert [r.layout for r in chat.format_chat(df).orderBy("n").collect()] == [x for _, x in rows]
