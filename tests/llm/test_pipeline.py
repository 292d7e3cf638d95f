"""The pipeline's stages, one after the other, against brute force; and the queries' registration."""

import random
import re
import struct

import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import __spark_entry__

pipeline = pytest.importorskip("corpus_pipeline")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(500)]
    text = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    passage, rows = text(70), []
    for i in range(120):
        t = text(rng.randint(30, 200))
        if i % 5 == 1:
            t = text(80) + "\n" + passage + "\n" + text(80)
        if i % 6 == 2:
            t = rows[rng.randrange(len(rows))][1]
        if i % 6 == 4:
            t = rows[rng.randrange(len(rows))][1] + " end"
        rows.append((i, t, "en", f"s{i % 4}", len(t)))
    rows += [(200, None, "en", "s1", 0), (201, "", None, None, 0), (202, "a b " * 100, "en", "s2", 400), (203, text(3000), "en", None, 1)]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return str(path)


def simhash(text):
    w = words(text.translate({c: c + 32 for c in range(65, 91)}))
    h = [xxhash.xxh64_intdigest(" ".join(x).encode(), 42) for x in ([w[i : i + 4] for i in range(len(w) - 3)] or [w])]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_stages_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    text = {r.doc_id: r.text for r in docs.collect()}
    seen = []
    for k, (_, stage) in enumerate(pipeline.STAGES):
        docs = pipeline.stored(stage(spark, docs, folder))
        assert k == 4 or docs.columns == columns
        seen.append(docs.collect())

    def passes(t):
        w = words(t)
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        again = {i + j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(3)}
        return len(w) >= 50 and 100 * len(again) <= 50 * len(w)

    kept = sorted(k for k, t in text.items() if passes(t))
    assert sorted(r.doc_id for r in seen[0]) == kept and len(kept) < len(text)
    fp = {k: simhash(text[k]) for k in kept}
    least = {k: k for k in kept}
    for _ in kept:
        for a in kept:
            least[a] = min(least[b] for b in kept if (fp[a] ^ fp[b]).bit_count() <= 4)
    alone = [k for k in kept if least[k] == k]
    assert sorted(r.doc_id for r in seen[1]) == alone and len(alone) < len(kept)
    earlier, left = set(), {}
    for k in alone:
        w = words(text[k])
        windows = [tuple(w[i : i + 13]) for i in range(len(w) - 12)]
        gone = {i + j for i, x in enumerate(windows) if x in earlier for j in range(13)}
        earlier |= set(windows)
        left[k] = [x for i, x in enumerate(w) if i not in gone]
    assert {r.doc_id: words(r.text) for r in seen[2]} == left and all(r.n_chars == len(r.text) for r in seen[2])
    assert any(len(left[k]) < len(words(text[k])) for k in alone)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=pipeline.bpe.read_ranks(public_tokenizers.path(pipeline.RANKS)), special_tokens={})
    after = {r.doc_id: r.text for r in seen[2]}
    copies = [r.doc_id for r in seen[3]]
    assert all(copies.count(k) <= 3 for k in copies) and set(copies) <= set(after)
    assert sorted(r.doc_id for r in seen[4]) == sorted(copies)
    for r in seen[4]:
        want = own.encode_ordinary(after[r.doc_id])
        assert r.round_trip and bytes(r.token_ids) == struct.pack(f"<{len(want)}I", *want)
    again = pipeline.run(spark, folder).collect()
    assert sorted((r.doc_id, bytes(r.token_ids)) for r in again) == sorted((r.doc_id, bytes(r.token_ids)) for r in seen[4])


def test_quality_stage_returns_texts_without_frequent_lines(spark):
    rows = [(i, "en", "s", "subscribe to our letter\n" + " ".join(f"w{i}x{j}" for j in range(60)), 7) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string, n_chars long")
    got = pipeline.quality_rules(spark, docs, "").collect()
    assert len(got) == 20 and all("subscribe" not in r.text and r.n_chars == len(r.text) for r in got)


CLASHING = ("kept", "n_words", "clean_text", "n_removed", "size", "rate", "copies", "taken", "target", "_copy", "_row", "_sha256", "fp", "component_id", "decoded", "a.b")


def through(spark, docs):
    out = [docs]
    for _, stage in pipeline.STAGES:
        out.append(pipeline.stored(stage(spark, out[-1], "")))
    return out[1:]


def test_stages_keep_every_column_and_its_values(spark):
    rows = [(i, " ".join(f"v{(i // 2 * 7 + j) % 90}w{j}" for j in range(70 + i)), "en", f"s{i % 3}") for i in range(12)]
    rows += [rows[0], rows[0], (None, rows[5][1], None, None), (None, None, None, None), (20, "", "en", "s1"), (21, "y " * 5, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    df = df.select("*", *(F.concat_ws("-", F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in CLASHING))
    after = through(spark, df)
    want = {r.doc_id: tuple(r)[4:] for r in df.collect()}
    for out in after[:4]:
        assert out.columns == df.columns and out.count()
        assert all(tuple(r)[4:] == want[r.doc_id] for r in out.collect())
    assert [r.doc_id for r in after[1].collect()].count(0) == 1
    last = after[4]
    assert last.columns == [c for c in df.columns if c != "text"] + ["n_tokens", "token_ids", "round_trip"]
    assert all(tuple(r)[3:-3] == want[r.doc_id] and r.round_trip for r in last.collect())


def test_stages_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars int")
    after = through(spark, df)
    assert all(x.columns == df.columns and x.count() == 0 for x in after[:4]) and after[4].count() == 0
    assert after[3].schema["n_chars"].dataType == df.schema["n_chars"].dataType


def test_every_operator_has_its_query():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))
    assert set(__spark_entry__.oracle_sql()) <= set(names)
