"""Whitening, the pigeonhole join and spelling variants against plain versions, through the registered queries."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__
from sparkloom.llm import pigeonhole, spelling, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(v):
    return v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v)


def brute_links(rows, cosine=0.93):
    """{row number: (links, component)} of rows (id, vector, label)."""
    good = [usable(v) and any(v) and label is not None for _, v, label in rows]
    unit = [np.array(v, float) / np.abs(np.array(v, float)).max() if g else None for (_, v, _), g in zip(rows, good)]
    unit = [u / np.sqrt(u @ u) if u is not None else None for u in unit]
    near = defaultdict(set)
    for i, j in itertools.combinations(range(len(rows)), 2):
        if good[i] and good[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine:
            near[i].add(j), near[j].add(i)
    out = {}
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for k in near[todo.pop()] - seen:
                seen.add(k), todo.append(k)
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        out[i] = (len(near[i]), min(ids) if ids else None)
    return out


def vectors(rng, n=700, d=20):
    """Clusters of near copies around and within the limit, copies, and vectors that take no part."""
    g = np.random.default_rng(rng)
    centres = g.standard_normal((12, d))
    rows = []
    for i in range(n):
        noise = g.choice([0.0, 0.05, 0.2, 0.3, 1.5])
        v = (centres[g.integers(12)] + noise * g.standard_normal(d)) * g.choice([0.01, 1, 50])
        rows.append((i, [float(c) for c in v.astype(np.float32)], int(g.choice([0, 0, 0, 1, 2]))))
    rows += [(n, rows[0][1], rows[0][2]), (n + 1, rows[0][1], 7), (n + 2, rows[0][1], None), (n + 3, None, 0), (n + 4, [0.0] * d, 0), (n + 5, [], 0)]
    rows += [(n + 6, [None, *rows[0][1][1:]], rows[0][2]), (n + 7, [float("nan"), *rows[0][1][1:]], rows[0][2]), (n + 8, rows[0][1][:7], rows[0][2]), (n + 9, rows[0][1][:7], rows[0][2])]
    rows += [(5, rows[9][1], rows[9][2]), (5, rows[9][1], rows[9][2]), (None, rows[11][1], rows[11][2]), (None, [1.0] * d, 9), (n + 10, [3e38] * d, 1), (n + 11, [-0.0] + [3e38] * (d - 1), 1), (n + 12, [0.0] + [3e38] * (d - 1), 1)]
    return rows


def table_of(spark, tmp_path, name, rows, schema, parts=5):
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def run(spark, name, path):
    return __spark_entry__.queries()[name](spark, path)


@pytest.mark.parametrize("small", [False, True])
def test_op12(spark, tmp_path, monkeypatch, small):
    if small:  # many cells, chunks and tiles
        for name, value in (("CELL", 20), ("CHUNK", 60), ("TILE", 8), ("STEP", 50), ("SAMPLE", 100)):
            monkeypatch.setattr(pigeonhole, name, value)
    rows = vectors(3)
    want = brute_links(rows)
    path = table_of(spark, tmp_path, "embeddings", rows, SCHEMA)
    if small:  # workers have modules of their own: here the join runs in this process
        got = in_process(pigeonhole, rows)
        assert got == {i: want[i][0] for i in got}
        return
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in run(spark, "op12_embedding_dedup", path).collect())
    assert got == Counter((r[0], *want[i], None if None in (r[0], want[i][1]) else r[0] == want[i][1]) for i, r in enumerate(rows))
    assert sum(n > 0 for n, _ in want.values()) > 200 and any(0 < n < 5 for n, _ in want.values())


def in_process(module, rows):
    """Links of distinct usable vectors, by the join's own functions, with cells and chunks as Spark deals them."""
    good = [i for i, (_, v, label) in enumerate(rows) if usable(v) and any(v) and label == 0 and len(v) == 20]
    first = {tuple(rows[i][1]): i for i in reversed(good)}
    n = Counter(tuple(rows[i][1]) for i in good)
    nodes = sorted(first.values())
    x = np.array([rows[i][1] for i in nodes], np.float32)
    q = module.rounded(module.unit(x))
    limit, links = module.budgets(20, module.COSINE), Counter()
    cuts = np.quantile(q, np.arange(1, 8) / 8, axis=0).T
    many = 0
    for k, (lo, hi) in enumerate(zip(module.edges(20), module.edges(20)[1:])):
        row, cell, own = module.cells(q[:, lo:hi].astype(float), 5, cuts[lo:hi], limit[k] + 1)
        many += len(row)
        for c in np.unique(cell):
            at = np.flatnonzero(cell == c)
            chunk = row[at] % 3
            for i, j in itertools.combinations_with_replacement(range(3), 2):
                some = lambda o, h, at=at, chunk=chunk: np.flatnonzero((own[at] == o) & (chunk == h))
                group = module.Cell(module.unit(x[row[at]]), q[row[at]], k, module.COSINE)
                parts = [(some(True, i), None), (some(True, i), some(False, i))] if i == j else [(some(True, i), some(True, j)), (some(True, i), some(False, j)), (some(False, i), some(True, j))]
                for a, b in parts:
                    for s, t in group.join(a, b):
                        for y, z in zip(row[at][s].tolist(), row[at][t].tolist()):
                            links[y] += n[tuple(rows[nodes[z]][1])]
                            links[z] += n[tuple(rows[nodes[y]][1])]
    assert many > 3 * len(nodes)  # guests there are
    return {i: links[k] + n[tuple(rows[i][1])] - 1 for k, i in enumerate(nodes)}


def test_op12_cells_and_chunks_on_spark(spark, monkeypatch):
    """Driver-side limits lowered: labels are cut into cells, and cells into chunks."""
    monkeypatch.setattr(pigeonhole, "CELL", 30)
    monkeypatch.setattr(pigeonhole, "CHUNK", 25)
    rows = vectors(8, 400)
    want = brute_links(rows)
    got = pigeonhole.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == Counter((r[0], *want[i]) for i, r in enumerate(rows))


def test_op12_other_kinds(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "a", 5, "x"), (2, [2.0, 4.0], "a", 6, "y"), (3, [1.0, 2.0], "b", 7, "z")], "vec_id int, embedding array<double>, label string, n_links int, key string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept, r.key) for r in pigeonhole.near_duplicates(df).collect()}
    assert got == {1: (1, 1, True, "x"), 2: (1, 1, False, "y"), 3: (0, 3, True, "z")}
    empty = pigeonhole.near_duplicates(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and set(empty.columns) == {"vec_id", "label", "n_links", "component_id", "kept"}


def brute_whitening(rows):
    good = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v, *_ in rows if usable(v) and len(v) == 20]
    fit = sorted({tuple(x) for _, x in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    m = np.array(fit, float)
    m = m - np.array(sums) / n
    e, axes = np.linalg.eigh(m.T @ m / n)
    out = []
    for i, x in good:
        for k in range(4):
            w = (np.array(x) - np.array(sums) / n) @ axes[:, -1 - k] / np.sqrt(e[-1 - k])
            out.append((i, k + 1, n, sum((n * a - s) ** 2 for a, s in zip(x, sums)), abs(float(w)), float(e[-1 - k] / e.sum())))
    return out


def test_op11(spark, tmp_path):
    rows = [(i, [c / 40 for c in v], label) if v and all(c is not None and abs(c) < 1e6 for c in v) else (i, v, label) for i, v, label in vectors(5) if v is None or len(v) != 20 or max(abs(c or 0) for c in v) < 1e6]
    got = run(spark, "op11_embedding_whitening", table_of(spark, tmp_path, "embeddings", rows, SCHEMA)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    have = sorted(((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got), key=key)
    want = sorted(brute_whitening([r for r in rows if r[1] is None or len(r[1]) == 20 or not r[1]]), key=key)
    assert [r[:4] for r in have] == [r[:4] for r in want]
    assert np.allclose([r[4:] for r in have], [r[4:] for r in want], rtol=1e-8, atol=1e-9)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_op11_odd_tables(spark):
    white = lambda rows, schema=SCHEMA: whitening.whiten(spark.createDataFrame(rows, schema))
    assert white([]).collect() == [] and white([(1, None, 1)]).collect() == []
    assert white([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)]).collect() == []  # one distinct vector: no variance
    line = white([(k, [float(k), 2.0 * k, 0.0], 1) for k in range(-3, 4)]).collect()
    assert {r.component for r in line} == {1} and all(abs(r.explained - 1) < 1e-12 for r in line)
    named = white([(k, [float(k), float(k * k)], k, "t") for k in range(5)], "vec_id long, embedding array<double>, n int, x string")
    assert named.columns == ["vec_id", "x", *whitening.RESULTS] and {r.n for r in named.collect()} == {5}
    with pytest.raises(Exception, match="too large"):
        white([(1, [1e20, 1.0], 1), (2, [1.0, 1.0], 1)]).collect()
    assert whitening.deviations(np.array([[1 << 40, 0]]), 1 << 20, [5, 5]) == [((1 << 60) - 5) ** 2 + 25]


def test_chan_merging_is_the_moments_of_all():
    x = np.random.default_rng(1).standard_normal((100, 5)) + 1e4
    parts = [whitening.moments(x[:7]), (0, np.zeros(5), np.zeros((5, 5))), whitening.moments(x[7:8]), whitening.moments(x[8:])]
    n, mean, scatter = whitening.merged(whitening.merged(parts[0], parts[1]), whitening.merged(parts[2], parts[3]))
    y = x - x.mean(axis=0)
    assert n == 100 and np.allclose(mean, x.mean(axis=0), rtol=1e-14) and np.allclose(scatter, y.T @ y, rtol=1e-9)


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(docs):
    counts = Counter()
    lower = {c: c + 32 for c in range(65, 91)}
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 7 and k >= 2}
    by = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, vs in by.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(by[w]), n.get(form[w])))
    return out


def spelled(seed, n=60):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeéÀ") for _ in range(rng.randrange(6, 12))) for _ in range(40)] + ["aaaaaaaaaaa", "Éüaaaaaaa", "straße×s"]
    docs = []
    for i in range(n):
        out = []
        for _ in range(rng.randrange(0, 400)):
            w = rng.choice(base[: 1 + int(40 * rng.random() ** 3)]) if rng.random() < 0.9 else rng.choice(base)
            if rng.random() < 0.2:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abzÿ") + w[k + 1 :], w[:k] + rng.choice("abz") + w[k:], w.upper()])
            out.append(w)
        docs.append((i, rng.choice([" ", ", ", "\n", "7"]).join(out)))
    return docs + [(n, None), (n, ""), (None, "wordwithoutid wordwithoutid"), (3, "x" * 5000 + " " + "x" * 5000 + " " + "x" * 4999 + "y x" + "x" * 4998 + "y"), (3, docs[3][1]), (n + 1, "абракадабра ﬁnance٣ naïvely naïvely naïvety naïvety")]


@pytest.mark.parametrize("seed", [1, 2])
def test_op13(spark, tmp_path, seed):
    docs = spelled(seed)
    rows = run(spark, "op13_spelling_variants", table_of(spark, tmp_path, "documents", docs, "doc_id long, text string")).collect()
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows) and got == brute_variants(docs)
    assert any(r.form and r.root != r.form for r in rows) and any(r.n_near > 1 for r in rows)


def test_op13_chunks(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CHUNK", 7)
    docs = spelled(5, 30)
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute_variants(docs)
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_masks_looked_up_are_those_compared():
    g = np.random.default_rng(2)
    a = np.array([spelling.mask_of(bytes(g.choice(list(b"abcdefgh\xe9"), 8))) for _ in range(900)], np.int64)
    b = np.array([spelling.mask_of(bytes(g.choice(list(b"abcdefgh\xe9"), 7))) for _ in range(700)], np.int64)
    for band, longer, same in [(0, False, True), (1, False, True), (2, False, True), (0, False, False), (2, False, False), (0, True, False), (1, True, False)]:
        y = a if same else b
        close = spelling.within(a[:, None] ^ y[None, :], band, longer)
        want = {(i, j) for i, j in zip(*np.nonzero(close)) if not same or i > j}
        got = [(i, j) for x in spelling.met(a, y, band, longer, same) for i, j in zip(*x)]
        assert len(a) * len(y) > spelling.COMPARED and len(got) == len(set(got)) and set(got) == want
