"""The registered queries, with their digests, against plain versions over small tables."""

import itertools
import math
import os
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

import __spark_entry__
from sparkloom.llm import bpe, mixing

from .test_llm import RANKS, WORD, brute_simhash, brute_windows, corpus, dot, sha

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(21)
    path = str(tmp_path_factory.mktemp("tables"))
    docs = [(r[0], r[1], r[2], r[3], r[4]) for r in corpus(60, 3)] + [(900 + k, "le chat ½ Ⅰ est là " * 8 + str(k), "fr", "s1", 1) for k in range(12)] + [(950, "words without a label", None, None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    said = lambda: rng.choice(["", "</s>[INST] \\ [/INST]", "plain\nlines", "<s>\\<s>", None, "[INST", "\\", "é漢😀 [/INST] x </s>"])
    talk = [(c, t, rng.choice(["user", "assistant", "system", None]), said()) for c in range(40) for t in range(rng.randrange(1, 6))]
    rng.shuffle(talk)
    spark.createDataFrame(talk, "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    v = np.random.default_rng(4).standard_normal((400, 12)).astype(np.float32)
    v[100:140] = v[100]
    vectors = [(i, x.tolist()) for i, x in enumerate(v)] + [(400, None), (420, [0.0] * 12), (440, [float("inf")] * 12)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{path}/embeddings.parquet")
    return path


def run(spark, name, path):
    names = [n for n in __spark_entry__.queries() if n.startswith(f"{name}_")]
    return __spark_entry__.queries()[names[0]](spark, path).collect()


def documents(spark, path):
    return sorted(spark.read.parquet(f"{path}/documents.parquet").collect(), key=lambda r: r.doc_id)


def test_op2(spark, tables):
    want = brute_windows([(r.doc_id, r.text or "") for r in documents(spark, tables)])
    size = {r.doc_id: len(WORD.findall(r.text or "")) for r in documents(spark, tables)}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in run(spark, "op2", tables)} == {k: (size[k], n, sha(t.encode())) for k, (n, t) in want.items()}


def test_op3(spark, tables):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in run(spark, "op3", tables)}
    for r in documents(spark, tables):
        ids = own.encode_ordinary(r.text or "")
        assert got[r.doc_id] == (len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha((r.text or "").encode()))


def test_op4(spark, tables):
    fp = {r.doc_id: brute_simhash(r.text) for r in documents(spark, tables)}
    low = {k: k for k in fp}
    for _ in fp:
        before = dict(low)
        for a, b in itertools.combinations(fp, 2):
            if (fp[a] ^ fp[b]).bit_count() <= 4:
                low[a] = low[b] = min(low[a], low[b])
        if low == before:
            break
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in run(spark, "op4", tables)} == {k: (f"{fp[k]:016x}", low[k]) for k in fp}


def test_op5(spark, tables):
    got, seen = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in run(spark, "op5", tables)}, set()
    for r in documents(spark, tables):
        b = (r.text or "").encode()
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - 99):
            if b[i : i + 100] in seen:
                gone[i + 1 : i + 101] = True
            seen.add(b[i : i + 100])
        spans = int((gone[1:] & ~gone[:-1]).sum())
        assert got[r.doc_id] == (len(b), gone.sum(), spans, sha(np.frombuffer(b, np.uint8)[~gone[1:-1]].tobytes()))


def test_op7_and_its_tilts(spark, tables):
    got = run(spark, "op7", tables)
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size
    order = sorted(s for s in by if s is not None) + [None]
    size = {s: sum(r.size for r in by[s]) for s in order}
    weight, capped = {s: 1 + i % 3 for i, s in enumerate(order)}, set()
    while True:
        left, free = sum(size.values()) - sum(3 * size[s] for s in capped), sum(weight[s] for s in order if s not in capped)
        target = {s: 3.0 * size[s] if s in capped else left * weight[s] / free for s in order}
        more = {s for s in order if s not in capped and target[s] > 3 * size[s]}
        if not more:
            break
        capped |= more
    for s in order:
        rows = [r for r in by[s] if r.size]
        assert all(r.source_size == size[s] and abs(r.target - target[s]) <= 1e-6 * target[s] for r in by[s])
        if s not in capped:
            # the one solution: rates are exponential in size up to the cap, and their words meet the target
            slope = {round(math.log(r.rate) / r.size, 9) for r in rows if 0 < r.rate < mixing.CAP - 1e-9}
            assert len(slope) == 1 and abs(sum(r.rate * r.size for r in rows) - target[s]) <= 1e-6 * target[s]
            assert all(abs(r.rate - min(3.0, math.exp(next(iter(slope)) * r.size))) < 1e-5 * r.rate for r in rows)
        assert abs(sum(r.taken for r in rows) - target[s]) <= max(max(r.size for r in rows), 0.01 * target[s])
        assert all(math.floor(r.rate) <= r.copies <= math.floor(r.rate) + 1 for r in rows)


def parse(formatted, spans):
    """A reader of its own: one character at a time, a backslash takes back the one before it."""
    turns, at = [], 0
    while at < len(formatted):
        assert formatted.startswith("<s>[INST] ", at)
        parts, here = [], at + 10
        for stop in (" [/INST] ", " </s>"):
            out = []
            while not formatted.startswith(stop, here):
                out.append(formatted[here])
                here += 2 if formatted[here] in "\\<[" and formatted[here + 1 : here + 2] == "\\" else 1
            parts.append("".join(out))
            here += len(stop)
        turns.append((tuple(parts), (here - len(stop))))
        at = here
    return turns


def test_op8(spark, tables):
    from sparkloom.llm import chat
    from sparkloom.llm.queries import table

    rows = defaultdict(list)
    for r in spark.read.parquet(f"{tables}/conversations.parquet").collect():
        rows[r.conv_id].append((r.turn, r.role or "", r.text or ""))
    rows[-1] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in run(spark, "op8", tables)}
    assert got.keys() == rows.keys()
    for k, turns in rows.items():
        turns = sorted(turns)
        loss = "".join(t for _, role, t in turns if role == "assistant")
        said = "".join(f"{role}\n{t}\n" for _, role, t in turns)
        assert (got[k].n_turns, got[k].turns_sha256, got[k].loss_chars, got[k].loss_sha256) == (len(turns), sha(said.encode()), len(loss), sha(loss.encode()))
    for r in chat.format_chat(chat.records(table(spark, tables, "conversations").select("conv_id", "turn", "role", "text"))).collect():
        assert [p for p, _ in parse(r.formatted, r.loss_spans)] == [(role, t) for _, role, t in sorted(rows[r.conv_id])]
        assert len(r.formatted) == got[r.conv_id].formatted_chars


def test_op9(spark, tables):
    v = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{tables}/embeddings.parquet").collect() if r.vec_id < 400}
    got, hits = defaultdict(list), 0
    for r in run(spark, "op9", tables):
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, 400, 20))
    for q, rows in got.items():
        score = {k: dot(x, v[q]) for k, x in v.items() if k != q}
        want = sorted(score, key=lambda k: (-score[k], k))[:20]
        rows.sort()
        assert [k for k, _, _ in rows] == list(range(1, 21)) and all(s == score[k] for _, k, s in rows)
        assert [(s, -k) for _, k, s in rows] == sorted(((s, -k) for _, k, s in rows), reverse=True)
        hits += len({k for _, k, _ in rows} & set(want))
    assert hits >= 0.95 * 400


def backoff(rows):
    """Word-first backoff, written plainly: (text) to (language, score)."""
    words, grams = defaultdict(Counter), defaultdict(Counter)
    for text, lang in rows:
        for w, n in Counter(regex.findall(r"\p{L}+", text.lower())).items():
            words[lang][w] += n
    for lang, counts in words.items():
        for w, n in counts.items():
            for k in range(1, 6):
                for i in range(len(w) + 3 - k):
                    grams[lang][f"<{w}>"[i : i + k]] += n
    every = {kind: set().union(*of.values()) for kind, of in (("w", words), ("g", grams))}
    total = {(kind, lang): sum(of[lang].values()) + 0.5 * len(every[kind]) for kind, of in (("w", words), ("g", grams)) for lang in words}
    log = lambda kind, of, lang, x: math.log((of[lang][x] + 0.5) / total[kind, lang])

    def predict(text):
        sums = dict.fromkeys(words, 0.0)
        found = Counter(regex.findall(r"\p{L}+", (text or "").lower()))
        if not found:
            return "und", 0.0
        for w, n in found.items():
            if w in every["w"]:
                parts, kind, of = [w], "w", words
            else:
                marked, kind, of = f"<{w}>", "g", grams
                parts = next((p for k in range(5, 0, -1) if (p := [marked[i : i + k] for i in range(len(marked) - k + 1) if marked[i : i + k] in every["g"]])), [])
            for lang in sums:
                sums[lang] += n * sum(log(kind, of, lang, x) for x in parts) / max(1, len(parts))
        best = max(sorted(sums), key=sums.get)
        return best, 1 / sum(math.exp(s - sums[best]) for s in sums.values())

    return predict


def test_op10_equals_a_plain_backoff(spark, tables):
    held = lambda k: zlib.crc32(str(k).encode()) % 4 == 2
    docs = documents(spark, tables)
    predict = backoff([(r.text, r.lang) for r in docs if not held(r.doc_id) and r.lang is not None and r.text is not None])
    got = {r.doc_id: r for r in run(spark, "op10", tables)}
    for r in docs:
        lang, score = predict(r.text)
        assert got[r.doc_id].held_out == held(r.doc_id) and got[r.doc_id].lang_pred == lang and abs(got[r.doc_id].score - score) < 1e-6


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_op10_is_right_on_held_out_documents(spark):
    lang = {r.doc_id: r.lang for r in documents(spark, SF)}
    got = [r for r in run(spark, "op10", SF) if r.held_out and lang[r.doc_id] is not None and r.lang_pred != "und"]
    assert len(got) > 200 and sum(r.lang_pred == lang[r.doc_id] for r in got) >= 0.98 * len(got)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_op9_recall_on_the_tables(spark):
    rows = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect() if r.embedding is not None and np.isfinite(r.embedding).all() and any(r.embedding)}
    ids = np.array(sorted(rows))
    x, found, hits, n = np.stack([rows[k] for k in ids]), defaultdict(set), 0, 0
    for r in run(spark, "op9", SF):
        found[r.query_id].add(r.vec_id)
    for q in ids[ids % 20 == 0].tolist():
        s = x @ rows[q]
        s[ids == q] = -np.inf
        best = set(ids[np.lexsort((ids, -s))[:20]].tolist())
        hits, n = hits + len(best & found[q]), n + len(best)
    assert hits >= 0.95 * n
