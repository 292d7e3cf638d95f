"""Hand-derived cases of the curation operators."""

import json
import os
import pathlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom import config
from sparkloom.operators import analyze, clean, export, generate, merge, near, pairs
from sparkloom.plans import queries
from sparkloom.sources import jsonl, registry

A, B = "民航绕偏航处置", "飞行计划审核"
ROWS = [
    ("飞机偏航了怎么处理？", A), ("民航绕偏航处置能帮我处理偏航问题吗？", A), ("哈", A), ("飞机偏航了怎么处理？", A),
    ("我们公司的航班在飞行过程中遭遇了强对流天气，需要立即重新规划航路，请问如何处理？", A), ("这是一个无效答案", "不存在的智能体"),
    ("[MOCK] 测试问题", B), ("航班备降需要哪些审批流程？", B), ("我想了解一下飞行计划审核的功能", B),
]


def labels(spark):
    words = ["偏航", "绕飞", "航路", "改航", "备降", "天气", "管制", "间隔", "机组"]
    return registry.from_rows(spark, [{"name": A, "domain": "d", "keywords": words}, {"name": B, "domain": "d"}])


def samples(spark, rows, start=0):
    return spark.createDataFrame([(i + start, *r) for i, r in enumerate(rows)], "seq long, question string, answer string")


def test_hard_reasons_in_order(spark):
    rows = clean.judge(samples(spark, ROWS), labels(spark)).orderBy("seq").collect()
    keys = [r.reasons[0].split(":")[0] if r.reasons else None for r in rows]
    assert keys[1] == clean.LEAK and keys[2] == clean.SHORT and keys[5] == clean.BAD_LABEL and keys[6] == clean.MEANINGLESS and keys[8] == clean.LEAK
    assert keys[0] is None and keys[4] is None and keys[7] is None


def test_score_of_a_plain_question(spark):
    rows = clean.judge(samples(spark, ROWS), labels(spark)).orderBy("seq").collect()
    assert round(rows[7].score, 4) == 0.715


def test_empty_fields_and_nulls_give_reasons(spark):
    rows = clean.judge(samples(spark, [(None, None), ("  ", A), ("　", "")]), labels(spark)).orderBy("seq").collect()
    assert [len(r.reasons) for r in rows] == [2, 1, 2]


def test_clean_counts_layers(spark):
    got = clean.clean_stats(clean.clean(samples(spark, ROWS), labels(spark))).first()
    assert (got.total, got.passed, got.rejected_hard, got.rejected_dedup) == (9, 3, 5, 1)
    assert clean.clean_stats(clean.clean(samples(spark, []), labels(spark))).first().pass_rate == 0.0


BASE = "".join(chr(0x4E00 + i) for i in range(60))
NEXT = BASE[:10] + "X" + BASE[11:]
LAST = NEXT[:40] + "Y" + NEXT[41:]


@pytest.mark.parametrize("order, kept", [((BASE, NEXT, LAST), [0, 2]), ((NEXT, BASE, LAST), [0])])
def test_a_dropped_row_suppresses_nothing(spark, order, kept):
    got = near.greedy_kept(samples(spark, [(q, "x") for q in order])).orderBy("seq").collect()
    assert [r.seq for r in got] == kept


def test_near_copies_stay_across_labels_and_fall_within(spark):
    rows = [(BASE, "x"), (BASE, "y"), (BASE + "\n", "x"), ("ab", "x"), ("AB", "x"), ("ab", "y")]
    assert sorted(r.seq for r in near.greedy_kept(samples(spark, rows)).collect()) == [0, 1, 3, 5]
    assert sorted(r.seq for r in clean.exact_dedup(samples(spark, rows)).collect()) == [0, 2, 3, 4]


def test_near_pairs_equal_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(60):
        base = "".join(rng.choice("abcdef ") for _ in range(40))
        rows += [(base, rng.choice("xy")), (base[:-1] + rng.choice("xyz"), rng.choice("xy"))]
    got = {(r.seq_a, r.seq_b): r.jaccard for r in near.near_pairs(samples(spark, rows), 3, 0.8).collect()}

    def grams(q):
        t = "".join(q.lower().split())
        return frozenset([t]) if len(t) < 3 else frozenset(t[i : i + 3] for i in range(len(t) - 2))

    seen, want = set(), {}
    nodes = []
    for i, (q, a) in enumerate(rows):
        if (a, grams(q)) not in seen:
            seen.add((a, grams(q)))
            nodes.append((i, a, grams(q)))
    for x, (i, a, g) in enumerate(nodes):
        for j, b, h in nodes[x + 1 :]:
            s = len(g & h) / len(g | h)
            if a == b and s >= 0.8:
                want[i, j] = s
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)


@pytest.mark.parametrize("n, want", [(1, (1, 0, 0)), (2, (1, 1, 0)), (3, (2, 1, 0)), (5, (4, 1, 0)), (9, (7, 1, 1)), (10, (8, 1, 1)), (20, (16, 2, 2))])
def test_split_sizes(spark, n, want):
    rows = samples(spark, [(f"q{i}", "x") for i in range(n)])
    got = {r.split: r.n for r in merge.split_sizes(merge.stratified_split(rows)).collect()}
    assert (got["train"], got["val"], got["test"]) == want


def test_random_split_is_a_partition(spark):
    got = merge.random_split(samples(spark, [(f"q{i}", "x") for i in range(101)]))
    assert {r.split: r.n for r in merge.split_sizes(got).collect()} == {"train": 80, "val": 10, "test": 11}


def test_quotas_and_calls():
    assert merge.quotas(1000, (0.15, 0.70, 0.15)) == {"stage1": 150, "stage2": 700, "stage3": 150}
    assert merge.quotas(10, (0.15, 0.70, 0.15)) == {"stage1": 1, "stage2": 7, "stage3": 2}
    assert generate.stage1_calls(150, 5) == 37 and generate.stage2_calls(700, 10, 0.4) == (38, 56) and generate.spare_calls(25, 5) == 8


def test_balance(spark):
    score = lambda counts: analyze.balance_score(samples(spark, [("q", f"a{i}") for i, n in enumerate(counts) for _ in range(n)])).first()[0]
    assert score([10, 10, 10]) == 1.0 and score([1, 3]) == 0.75 and score([4]) == 1.0 and score([]) == 0.0


def test_pairs_and_cap(spark):
    rows = [{"name": n, "domain": d, "keywords": k, "confusable": c} for n, d, k, c in (("a", "x", ["1", "2"], ["b", "gone"]), ("b", "x", ["1", "2"], ["a"]), ("c", "y", ["2", "3", "1"], []), ("d", "y", [], []))]
    every = pairs.all_pairs(registry.from_rows(spark, rows), 0.3)
    got = {(r.agent_a, r.agent_b): (r.source, round(r.overlap_score, 3)) for r in every.collect()}
    assert got == {("a", "b"): ("registry", 0.8), ("a", "c"): ("keyword_overlap", 0.667), ("b", "c"): ("keyword_overlap", 0.667), ("c", "d"): ("domain", 0.2)}
    assert [(r.agent_a, r.agent_b) for r in pairs.capped_pairs(every, 1).orderBy("place").collect()] == [("a", "b"), ("c", "d")]
    near_third = [{"name": str(i), "keywords": k} for i, k in enumerate((["1", "2", "3"], ["1", "4", "5", "6"], ["1", "2", "7"]))]
    assert [(r.agent_a, r.agent_b) for r in pairs.keyword_pairs(registry.from_rows(spark, near_third), 0.3).collect()] == [("0", "2")]


@pytest.mark.parametrize(
    "text, want",
    [
        ('```json\n[{"question": "天气怎么样呀", "answer": "x"}]\n```', 1),
        ('[{"question": "long enough", "answer": "x"}]', 1),
        ('{"question": "long enough", "answer": "the x label"}', 1),
        ('so [{"question": "long enough", "answer": "x"}] done', 1),
        ('{"question": "long enough", "answer": "x"},\n{"question": "and another", "answer": "x"},', 2),
        ('{"question": "holds the x", "answer": "x"}', 0),
        ('{"question": "four", "answer": "x"}', 0),
        ('{"question": 5, "answer": "x"}', 0),
        ("nothing", 0),
        (None, 0),
    ],
)
def test_extraction(text, want):
    assert len(generate.extract(text, "x")) == want


def test_extraction_as_a_table_function(spark):
    r = spark.createDataFrame([(1, '[{"question": "long enough", "answer": "x"}]', "x"), (2, "none", "x")], "task_idx long, raw_text string, expected_answer string")
    assert [(x.task_idx, x.question) for x in generate.extracted(r).collect()] == [(1, "long enough")]


def test_a_failing_provider_is_a_row(spark):
    def broken(system, user, expected):
        raise RuntimeError("down")

    tasks = generate.prompt_tasks(labels(spark), generate.templates(spark), "stage1", 2)
    got = generate.response_stats(generate.respond(tasks, broken, retries=2, delay=0.0)).first()
    assert (got.calls, got.failed, got.success_rate) == (4, 4, 0.0)
    assert generate.response_stats(generate.respond(tasks)).first().succeeded == 4


def joined(folder) -> bytes:
    """A folder's parts, one after the other by name."""
    return b"".join(p.read_bytes() for p in sorted(pathlib.Path(folder).glob("part-*")))


def files_of(root, text=lambda k, i: f"我们公司系统第{k}个文件的第{i}行应该怎么处理，可以帮忙看看吗？"):
    """Two stages of files: names that occur twice, blanks and lines of every kind."""
    for k, name in enumerate(("stage1/b.jsonl", "stage1/pair=x/a.jsonl", "stage1/pair=y z+1%/a.jsonl", "stage2/b.jsonl", "stage2/c.json")):
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        lines = [json.dumps({"question": text(k, i) if i % 5 else text(0, i), "answer": B}, ensure_ascii=False) for i in range(40)]
        path.write_text("\n".join([*lines[:20], "", "not json", "[1]", '{"question": 5, "answer": {"a": 1}}', *lines[20:]]), encoding="utf-8")


def whole_run_in_order(spark, tmp_path, split):
    """First wins by stage, file and line, names stay, and outputs are in their seeded order; the outputs."""
    from sparkloom import run

    files_of(tmp_path / "raw")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        raw = run.read_raw(spark, str(tmp_path / "raw")).orderBy("seq").collect()
        assert [r.seq for r in raw] == list(range(5 * 42))
        names = ["b.jsonl", "pair=x/a.jsonl", "pair=y z+1%/a.jsonl", "b.jsonl", "c.json"]
        assert [r.src_file for r in raw[::42]] == names and [r.stage for r in raw[::42]] == ["stage1"] * 3 + ["stage2"] * 2
        assert [r.question for r in raw[:3]] == [f"我们公司系统第0个文件的第{i}行应该怎么处理，可以帮忙看看吗？" for i in range(3)]
        assert {r.not_text for r in raw} == {None, "question, answer"}
        labels_ = labels(spark)
        stats = run.clean_folders(spark, str(tmp_path / "raw"), str(tmp_path / "clean"), labels_, clean.CleanConfig(min_score=0.1))
        assert [(f["stage"], f["src_file"], f["n_input"], f["n_passed"]) for f in stats["by_file"]] == [(r.stage, n, 42, 40 if k == 0 else 32) for k, (n, r) in enumerate(zip(names, raw[::42]))]
        assert json.loads((tmp_path / "clean" / "files.json").read_text()) == stats
        again = run.read_clean(spark, str(tmp_path / "clean"))
        got = again.orderBy("seq").collect()
        first, want = set(), []
        for r in raw:
            if r.corrupt is None and r.not_text is None and r.question not in first:
                first.add(r.question)
                want.append((r.stage, r.src_file, r.question))
        assert [(r.stage, r.src_file, r.question) for r in got] == want and [r.seq for r in got] == list(range(len(want)))
        cfg = config.load(None, {})
        cfg["merge"]["per_label"], cfg["merge"]["weights"] = 100, [0.5, 0.5, 0.0]
        run.merge_and_export(spark, again, labels_, cfg, str(tmp_path / "out"))
        merged = merge.merge(again, labels_, 100, (0.5, 0.5, 0.0)).orderBy("place", "seq").collect()
        questions = [r.question for r in merged]
        assert [json.loads(x)["question"] for x in joined(tmp_path / "out" / "merged").decode().splitlines()] == questions
        assert [x["input"] for x in json.loads(joined(tmp_path / "out" / "export" / "dataset_alpaca.json"))] == questions
        parts = [[json.loads(x)["question"] for x in joined(tmp_path / "out" / "split" / s / f"{s}_jsonl").decode().splitlines()] for s in ("train", "val", "test")]
        assert sorted(sum(parts, [])) == sorted(questions) and all(len(p) > 3 and p != [q for q in questions if q in p] for p in parts)
        return questions, parts
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_run_keeps_files_and_order_however_files_are_cut(spark, tmp_path):
    assert whole_run_in_order(spark, tmp_path / "a", "128m") == whole_run_in_order(spark, tmp_path / "b", "700")


def test_a_label_registered_twice_counts_once(spark):
    rows = [{"name": "a", "domain": "first", "keywords": ["x"]}, {"name": "a", "domain": "second"}]
    twice = registry.from_rows(spark, rows)
    df = samples(spark, [("q", "a"), ("r", "a")])
    assert clean.judge(df, twice).count() == 2 and [tuple(r) for r in analyze.domain_distribution(df, twice).collect()] == [("first", 2)]


def test_jsonl_source_and_sinks(spark, tmp_path):
    (tmp_path / "stage1").mkdir()
    (tmp_path / "stage1" / "b.jsonl").write_text('{"question": "q2", "answer": "a"}\n\n{"question": "q3", "answer": "a"}\n', encoding="utf-8")
    (tmp_path / "stage1" / "a.jsonl").write_text('{"question": "q1,\\"x\\"", "answer": "a"}\nnot json\n', encoding="utf-8")
    rows = jsonl.with_seq(jsonl.read_stage(spark, str(tmp_path / "stage1"), "stage1", placed=True).unionByName(jsonl.read_stage(spark, str(tmp_path / "none"), "stage2", placed=True)))
    got = rows.orderBy("seq").collect()
    assert [r.question for r in got] == ['q1,"x"', "q2", "q3"]
    assert {r.src_file: (r.parsed, r.lines) for r in jsonl.count_rows(spark, str(tmp_path / "stage1")).collect()} == {"a.jsonl": (1, 2), "b.jsonl": (2, 2)}
    out = export.export_all(rows.select("seq", "question", "answer"), str(tmp_path / "out"))
    assert joined(out["csv"]) == b"\xef\xbb\xbfquestion,answer\r\n\"q1,\"\"x\"\"\",a\r\nq2,a\r\nq3,a\r\n"
    assert [x["input"] for x in json.loads(joined(out["alpaca"]))] == ['q1,"x"', "q2", "q3"]
    export.write_array(rows.limit(0), "jsonl", str(tmp_path / "nothing"))
    assert json.loads(joined(tmp_path / "nothing")) == []
    assert set(export.write_splits(merge.stratified_split(rows), str(tmp_path / "split"))["train"]) == {"jsonl", "alpaca", "sharegpt", "openai"}


def test_stream_dedup(spark, tmp_path):
    from sparkloom.streaming import dedup

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{"question": "q", "answer": "a"}\n{"question": "q", "answer": "b"}\n{"question": "r", "answer": "b"}\n')
    dedup.write_stream(dedup.first_seen(dedup.read_stream(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.json(str(tmp_path / "out")).count() == 2


@pytest.mark.parametrize("files_per_trigger", [1, 2])
def test_a_stream_is_cleaned_as_one_table(spark, tmp_path, files_per_trigger):
    import os
    import shutil

    from sparkloom.operators.seen import SeenSet
    from sparkloom.streaming import dedup

    rng = random.Random(4)
    base = ["".join(chr(0x4E00 + rng.randrange(300)) for _ in range(40)) for _ in range(6)]
    rows = []
    for _ in range(40):
        q, k = rng.choice(base), rng.randrange(40)
        rows.append((rng.choice([q, q, q[:k] + "新" + q[k + 1 :]]), rng.choice([A, B])))
    (tmp_path / "in").mkdir()
    lines = [json.dumps({"question": q, "answer": a}, ensure_ascii=False) for q, a in rows]
    cfg = clean.CleanConfig(min_score=0.0, dedup="both", min_script_ratio=0.0)
    go = lambda: dedup.clean_stream(spark, str(tmp_path / "in"), labels(spark), cfg, str(tmp_path / "seen"), str(tmp_path / "out"), str(tmp_path / "state"), files_per_trigger).awaitTermination()
    for k in range(4):
        path = tmp_path / "in" / f"{k}.jsonl"
        path.write_text("\n".join(lines[10 * k : 10 * k + 10]), encoding="utf-8")
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
        if k == 1:
            go()  # the rest comes when the stream is started again
    go()
    parts = sorted((tmp_path / "out").glob("batch=*"), key=lambda p: int(p.name[6:]))
    got = [json.loads(x) for p in parts for x in joined(p).decode().splitlines()]
    want = clean.clean(samples(spark, rows), labels(spark), cfg).filter("kept").orderBy("seq").collect()
    assert [(r["question"], r["answer"]) for r in got] == [(r.question, r.answer) for r in want] and 6 <= len(got) < 40
    # a batch whose state is there is skipped when the stream runs it again
    versions = len(SeenSet(spark, str(tmp_path / "seen")).folders)
    shutil.rmtree(tmp_path / "state")
    go()
    assert len(SeenSet(spark, str(tmp_path / "seen")).folders) == versions == len(parts)


def test_config_precedence(tmp_path):
    (tmp_path / "c.json").write_text('{"merge": {"per_label": 7}, "output": {"root": "x"}}')
    cfg = config.load(str(tmp_path / "c.json"), {"OUTPUT_DIR": "y", "DRY_RUN": "yes", "MAX_WORKERS": "3"})
    assert (cfg["merge"]["per_label"], cfg["output"]["root"], cfg["generation"]["dry_run"], cfg["generation"]["max_workers"]) == (7, "y", True, 3)
    (tmp_path / "d.json").write_text('{"split": {"ratios": [0.8, 0.1, 0.2]}}')
    with pytest.raises(ValueError):
        config.load(str(tmp_path / "d.json"), {})


def test_progress_has_totals(spark):
    assert analyze.progress(samples(spark, ROWS).withColumn("stage", F.lit("stage1"))).filter("stage = 'TOTAL'").first().n == 9


def test_state_file(spark, tmp_path):
    from sparkloom.state import load_state, save_state

    path = str(tmp_path / "state.json")
    assert load_state(spark, path) == {}
    save_state(spark, path, stage1="done")
    assert save_state(spark, path, stage2=3)["stage1"] == "done" and load_state(spark, path)["stage2"] == 3
    (tmp_path / "state.json").write_text("broken")
    (tmp_path / ".state.json.crc").unlink(missing_ok=True)
    assert load_state(spark, path) == {}


def test_a_whole_run_resumes_and_exports(spark, tmp_path):
    """Offline answers as a model's: stages append what is missing, hard negatives are validated, every file is written."""
    from sparkloom import run

    def provider(system, user, expected):
        other = "乙" if expected == "甲" else "甲"
        seed = sum(map(ord, user)) + len(expected)
        items = [{"question": f"我们公司第{seed}号现场出现了异常情况，请问{k}小时内应该怎么处理？", "answer": expected} for k in range(6)]
        items += [{"question": f"这个问题提到了{other}，请问应该怎么处理才对呢？", "answer": expected}, {"question": "太短了吗", "answer": expected}]
        return generate.Reply(json.dumps(items, ensure_ascii=False), 3, 4, "m")

    rows = [{"name": n, "domain": "d", "description": n, "keywords": ["现场" if c or n == "乙" else "别处"], "confusable": c} for n, c in (("甲", ["乙"]), ("乙", []), ("丙", []))]
    names = registry.from_rows(spark, rows)
    cfg = config.load(None, {})
    cfg["generation"] |= {"delay": 0.0, "at_once": 3, "stage1": {"samples_per_label": 10, "batch": 5}, "stage2": {"samples_per_label": 12, "batch": 6, "simple_ratio": 0.5}, "stage3": {"samples_per_pair": 5, "batch": 5}}
    cfg["clean"] |= {"check_leak": True, "min_script_ratio": 0.3, "min_score": 0.3}
    root = str(tmp_path / "out")
    first = {**cfg, "generation": {**cfg["generation"], "stage1": {"samples_per_label": 4, "batch": 5}}}
    run.generate_stage(spark, names, "stage1", first, f"{root}/raw/stage1", provider, ["甲", "乙"])
    assert {r.answer: r.n for r in analyze.label_distribution(jsonl.read_stage(spark, f"{root}/raw/stage1", "s")).collect()} == {"甲": 4, "乙": 4}
    state = run.full_run(spark, names, cfg, root, provider=provider, max_pairs=2)
    assert {r.answer: r.n for r in analyze.label_distribution(jsonl.read_stage(spark, f"{root}/raw/stage1", "s")).collect()} == {"甲": 10, "乙": 10, "丙": 10}
    hard = jsonl.read_stage(spark, f"{root}/raw/stage3", "s").collect()
    assert {(r.pair.rsplit("_", 1)[0], r.answer) for r in hard} >= {("乙_vs_甲", "甲"), ("乙_vs_甲", "乙")} and not any("甲" in r.question or "乙" in r.question for r in hard)
    assert all(sum((r.pair, r.answer) == k for r in hard) == 5 for k in {(r.pair, r.answer) for r in hard})
    assert len({r.pair for r in hard}) == 2
    before = len(hard)
    run.generate_stage(spark, names, "stage3", cfg, f"{root}/raw/stage3", provider, max_pairs=2)
    assert jsonl.read_stage(spark, f"{root}/raw/stage3", "s").count() == before
    assert state["done"] and state["clean"]["total_passed"] == sum(f["n_passed"] for f in state["clean"]["by_file"]) > 0
    for path in ("merged", "split/train/train_openai", "export/dataset_csv.csv", "report.json", "state.json"):
        assert (tmp_path / "out" / path).exists()
    text = analyze.console_report(run.read_clean(spark, f"{root}/clean"), registry.from_rows(spark, [*rows, {"name": "丁"}]))
    assert "missing labels 1: 丁" in text and "d: " in text


def test_endpoint_provider(spark):
    import json
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    from sparkloom.sources import endpoint

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            good = self.headers["Authorization"] == "Bearer key" and asked["messages"][0]["role"] == "system"
            said = json.dumps([{"question": "long enough to pass", "answer": "x"}])
            body = json.dumps({"model": "served", "choices": [{"message": {"content": said}}], "usage": {"prompt_tokens": 5, "completion_tokens": 7}}).encode()
            self.send_response(200 if good else 401)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        tasks = spark.createDataFrame([(k, "s", "u", "x") for k in range(6)], "task_idx long, system string, user string, expected_answer string")
        url = f"http://127.0.0.1:{server.server_port}/v1"
        got = generate.response_stats(generate.respond(tasks, endpoint.from_config({"base_url": url, "api_key": "key"}), parts=2, at_once=3)).first()
        assert (got.calls, got.succeeded, got.prompt_tokens, got.completion_tokens) == (6, 6, 30, 42)
        bad = generate.respond(tasks, endpoint.Endpoint(url, "wrong"), retries=1).collect()
        assert all("401" in r.error for r in bad)
    finally:
        server.shutdown()
    assert endpoint.from_config({"dry_run": True, "api_key": "key"}) is generate.offline and endpoint.from_config({}) is generate.offline


def test_lines_without_an_object_are_rejected_with_a_reason(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"question": "航班备降需要哪些审批流程？", "answer": "' + B + '"}\n[1, 2]\n"text"\n5\nnot json\n{"question": null}\n', encoding="utf-8")
    rows = jsonl.with_seq(jsonl.read_jsonl(spark, str(tmp_path), keep_corrupt=True, placed=True))
    got = [r.reason for r in clean.clean(rows, labels(spark)).orderBy("seq").collect()]
    assert got == [None, clean.NOT_OBJECT, clean.NOT_OBJECT, clean.NOT_OBJECT, clean.EMPTY_QUESTION]
    assert jsonl.read_jsonl(spark, str(tmp_path)).count() == 2


def test_dedup_within_a_scope(spark):
    rows = samples(spark, [("航班备降需要哪些审批流程？", B)] * 4).withColumn("src_file", F.concat(F.lit("f"), (F.col("seq") % 2).cast("string")))
    assert clean.clean(rows, labels(spark)).filter("kept").count() == 1
    assert clean.clean(rows, labels(spark), clean.CleanConfig(scope="src_file")).filter("kept").count() == 2
    assert {r.src_file: r.n_passed for r in clean.file_stats(clean.clean(rows, labels(spark)), "src_file").collect()} == {"f0": 1, "f1": 0}


def test_batch_prompts_and_loose_extraction(spark):
    got = generate.batch_prompts(labels(spark), 3, "口语化").collect()
    assert len(got) == 2 and all("口语化" in r.user and generate.DIVERSITY[2] in r.user and generate.DIVERSITY[3] not in r.user for r in got)
    assert generate.extract_loose('a [x] then [{"question": 5}, 3] b') == [{"question": 5}]
    assert generate.extract_loose('{"a": 1} and {"b": {"c": 2}} [') == [{"a": 1}, {"b": {"c": 2}}] and generate.extract_loose(None) == []


def test_near_pairs_with_pieces(spark, monkeypatch):
    monkeypatch.setattr(near, "PIECE", 3)
    test_near_pairs_equal_brute_force(spark)


def brute_greedy(rows, t=0.85):
    """Places of rows (question, label) that first-wins keeps; rows without a label stay."""
    kept, out = {}, []
    for i, (q, a) in enumerate(rows):
        s = "".join((q or "").lower().split())
        g = frozenset([s]) if len(s) < 3 else frozenset(s[k : k + 3] for k in range(len(s) - 2))
        if a is None or all(len(g & h) / len(g | h) < t for h in kept.setdefault(a, [])):
            out.append(i)
            if a is not None:
                kept[a].append(g)
    return out


@pytest.mark.parametrize("full, leaders, seed", [(0, 1, 1), (0, 3, 2), (2, 2, 3), (2000, 16, 4)])
def test_rounds_of_leaders_equal_the_fold(spark, monkeypatch, full, leaders, seed):
    for name, value in (("FULL", full), ("LEADERS", leaders), ("GROWTH", 2), ("PIECE", 7), ("COMMON", 40)):
        monkeypatch.setattr(near, name, value)
    rng = random.Random(seed)
    rows = []
    for _ in range(30):
        text = [rng.choice("abcdefg é漢") for _ in range(rng.randrange(20, 70))]
        for _ in range(rng.randrange(1, 14)):  # chains: each differs a little from the last
            text[rng.randrange(len(text))] = rng.choice("abcdefgh")
            rows.append(("".join(text), rng.choice(["x", "x", "x", "y", None])))
    rng.shuffle(rows)
    rows += [("", "x"), (None, "x"), ("a", "x"), ("ab", "x"), (" A B ", "x"), rows[0], rows[1]]
    df = spark.createDataFrame([(i, q, a) for i, (q, a) in enumerate(rows)], "seq long, question string, answer string").repartition(3)
    assert sorted(r.seq for r in near.greedy_kept(df).collect()) == brute_greedy(rows)


def test_long_grams(spark):
    rows = [("abcdefghij", "x"), ("ABCDEF ghij", "x"), ("abcde", "x"), ("zz", "x"), ("z z", "x")]
    assert sorted(r.seq for r in near.greedy_kept(samples(spark, rows), n=5).collect()) == [0, 2, 3]


def test_many_near_copies_cost_no_square(spark, monkeypatch):
    rng = random.Random(1)
    base = "".join(rng.choice("abcdefghijklmnop") for _ in range(400))
    rows = [(i, base[: i % 400] + "qrstuvwxyz"[i // 400 % 10] + "qrstuvwxyz"[i // 4000] + base[i % 400 :], "x") for i in range(20_000)]
    pairs = []
    verified = near.verified
    monkeypatch.setattr(near, "verified", lambda p, *a: pairs.append(near.written(p)) or verified(pairs[-1], *a))
    kept = near.greedy_kept(spark.createDataFrame(rows, "seq long, question string, answer string"))
    assert [r.seq for r in kept.collect()] == [0]
    assert sum(p.count() for p in pairs) < 80 * len(rows)  # all pairs would be 10,000 times the rows


@pytest.mark.parametrize("dedup", ["exact", "ngram", "both"])
def test_two_runs_equal_one(spark, tmp_path, dedup):
    from sparkloom.operators.seen import SeenSet

    rng = random.Random(9)
    base = ["".join(chr(0x4E00 + rng.randrange(300)) for _ in range(40)) for _ in range(12)]
    texts = []
    for _ in range(90):
        q = rng.choice(base)
        k = rng.randrange(40)
        texts.append(rng.choice([q, q, q[:k] + "新" + q[k + 1 :], q[:20] + " " + q[20:]]))
    rows = [(q, rng.choice([A, B])) for q in texts] + [("短", A), (None, B)]
    cfg = clean.CleanConfig(min_score=0.0, dedup=dedup, min_script_ratio=0.0)
    verdicts = lambda df: {r.seq: r.reason for r in df.collect()}
    want = verdicts(clean.clean(samples(spark, rows), labels(spark), cfg))
    path, got = str(tmp_path / "seen"), {}
    for a, b in ((0, 30), (30, 31), (31, len(rows))):
        seen = SeenSet(spark, path)
        done = near.written(clean.clean(samples(spark, rows[a:b], a), labels(spark), cfg, seen))
        got |= verdicts(done)
        assert seen.add(done) == len(SeenSet(spark, path).folders)
    assert got == want and len(set(want.values())) >= 3


def test_a_run_that_breaks_off_adds_nothing(spark, tmp_path, monkeypatch):
    from sparkloom.operators.seen import SeenSet
    from sparkloom.sources import files

    path, rows = str(tmp_path / "seen"), samples(spark, [("航班备降需要哪些审批流程？", B)])
    done = clean.clean(rows, labels(spark), clean.CleanConfig(min_score=0.0))
    with monkeypatch.context() as m:
        m.setattr(files, "write_text", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError, match="gone"):
            SeenSet(spark, path).add(done)
    assert SeenSet(spark, path).folders == [] and SeenSet(spark, path).fresh(rows).count() == 1
    one, two = SeenSet(spark, path), SeenSet(spark, path)
    assert one.add(done) == 1 and SeenSet(spark, path).fresh(rows).count() == 0
    with pytest.raises(RuntimeError, match="another run"):
        two.add(done)


@pytest.mark.parametrize("rows", [ROWS, [*ROWS, (None, None), ("", ""), ("x" * 3000, "不存在的智能体"), ("x" * 90, None)], [("only", B)], []])
def test_report_agrees_with_each_figure(spark, rows):
    s, reg = samples(spark, rows), registry.from_rows(spark, [{"name": A, "domain": "d"}, {"name": B, "domain": "e"}, {"name": A, "domain": "late"}, {"name": "丁", "domain": "d"}])
    got = analyze.report(s, reg)
    one = lambda df: df.first().asDict()
    assert got["labels"] == pytest.approx(one(analyze.label_stats(s)))
    assert got["lengths"] == pytest.approx(one(analyze.length_stats(s)))
    assert got["length_histogram"] == one(analyze.length_histogram(s))
    assert got["coverage"] == one(analyze.coverage(s, reg))
    assert got["balance"] == one(analyze.balance_score(s))
    assert got["label_distribution"] == {r.answer: r.n for r in analyze.label_distribution(s).collect()}
    assert got["domain_distribution"] == {r.domain: r.n for r in analyze.domain_distribution(s, reg).collect()}
    assert got["missing_labels"] == sorted({r.name for r in analyze.missing_labels(s, reg).collect()})


def test_report_reads_samples_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    s = samples(spark, ROWS * 50).mapInArrow(counted, "seq long, question string, answer string")
    assert analyze.report(s, labels(spark))["labels"]["total"] == read.value == 450


def test_report_of_nothing(spark):
    none = registry.from_rows(spark, [])
    assert analyze.report(samples(spark, []), none)["balance"] == {"balance_score": 0.0}
    assert "rows 0, labels 0 of 0" in analyze.console_report(samples(spark, []), none)


@pytest.mark.parametrize("tile, block", [(-1, (1024, 32768)), (1 << 40, (2, 3)), (1 << 40, (5, 40))])
def test_buckets_and_tiles_agree_with_brute_force(spark, monkeypatch, tile, block):
    for name, value in (("TILE", tile), ("BLOCK", block), ("SKETCHES", 64)):
        monkeypatch.setattr(near, name, value)
    test_near_pairs_equal_brute_force(spark)
    test_rounds_of_leaders_equal_the_fold(spark, monkeypatch, 2, 2, 3)


def test_long_texts_leave_less_in_the_shared_folder_than_they_have_characters(spark, tmp_path):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    rows = [(" ".join(rng.choice(words) for _ in range(rng.randrange(200, 500))), "x") for _ in range(200)]
    rows += [(q + " end", a) for q, a in rows[:20]]
    root = os.path.dirname(near.shared_path(spark, "rows"))
    held = lambda: sum(os.path.getsize(os.path.join(f, n)) for f, _, names in os.walk(root) for n in names if n.endswith(".parquet"))
    before = held()
    assert sorted(r.seq for r in near.greedy_kept(samples(spark, rows)).collect()) == list(range(200))
    assert held() - before < sum(len(q) for q, _ in rows)


def test_joins_of_pairs_and_tasks_broadcast_no_registry(spark):
    r = registry.from_rows(spark, [{"name": f"l{i}", "domain": f"d{i % 2}", "keywords": ["k", f"k{i}"], "confusable": [f"l{i + 1}"]} for i in range(6)])
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for df in (pairs.all_pairs(r), pairs.capped_pairs(pairs.all_pairs(r), 2).drop("place")):
        assert "name_a" not in " ".join(x for x in plan(df).splitlines() if "BroadcastHashJoin" in x) and "i_a" not in " ".join(x for x in plan(df).splitlines() if "BroadcastHashJoin" in x)
    tasks = plan(generate.hard_negative_tasks(pairs.all_pairs(r), r, generate.templates(spark), 3))
    assert not [x for x in tasks.splitlines() if "BroadcastHashJoin" in x and "target" in x]


def test_gram_sets_are_made_by_slices_of_text(spark):
    import pyarrow as pa

    texts = ["ä" * k for k in (10, near.TEXT, 3, 0, near.TEXT // 8)] + ["x" * (near.TEXT // 4)] * 9
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])
    cut = list(near.text_slices([batch], 0))
    assert [t for b in cut for t in b.column(0).to_pylist()] == texts
    assert all(b.num_rows == 1 or sum(len(t.encode()) for t in b.column(0).to_pylist()) <= near.TEXT for b in cut)


def test_ngram_counts_send_no_sets(spark, tmp_path):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzäß ") for _ in range(k)) for k in (20000, 30000, 3, 2, 0)] + [None, "  ", "Ab aB"]
    documents = spark.createDataFrame([(i, q, "x", "y") for i, q in enumerate(texts)], "doc_id long, text string, lang string, source string")
    documents.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    df = queries.Q["ngram_counts"](spark, str(tmp_path))
    assert {r.seq: r.n_grams for r in df.collect()} == {i: len(near.gram_numbers(q or "", 3)) for i, q in enumerate(texts)}

    def received(node):
        """Bytes that Python sent back, of a plan's nodes."""
        m = node.metrics().get("pythonDataReceived")
        return (m.get().value() if m.isDefined() else 0) + sum(received(node.children().apply(k)) for k in range(node.children().size()))

    assert 0 < received(df._jdf.queryExecution().executedPlan()) < 5000


def test_sets_travel_by_tile_and_not_by_pair(spark, monkeypatch):
    monkeypatch.setattr(near, "PAIRS", 600, raising=False)
    monkeypatch.setattr(near, "SETS", 40, raising=False)
    rng = random.Random(4)
    base = "".join(rng.choice("abcdefghijklmnop") for _ in range(1500))
    rows = [(base[: 7 * i] + "xyz" + base[7 * i :], "xy"[i % 5 == 0]) for i in range(150)] + [(base[:700], "x"), ("zz", None)]
    sc = spark.sparkContext._jsc.sc()

    def shuffled():
        sc.listenerBus().waitUntilEmpty()
        return sc.statusStore().executorSummary("driver").totalShuffleWrite()

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = shuffled()
        got = {(r.label, r.seq_a, r.seq_b): r.jaccard for r in near.near_pairs(samples(spark, rows), 3, 0.85).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    sets = [set(near.gram_numbers(q, 3).tolist()) for q, _ in rows]
    want = {(a, i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i, (_, a) in enumerate(rows) for j in range(i + 1, len(rows)) if a is not None and a == rows[j][1]}
    assert got == {k: v for k, v in want.items() if v >= 0.85} and len(got) > 7000
    # sets are 12 kB each; one sent for each pair makes 15 MB, compressed
    assert shuffled() - before < 6e6


def test_a_block_meets_itself_once_and_in_steps(monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(150, 300))) for _ in range(300)]
    texts += [q[: i % 90] + "z" + q[i % 90 :] for i, q in enumerate(texts)]
    sets = [near.gram_numbers(q, 3) for q in texts]
    size, seq = np.array(list(map(len, sets)), np.int32), np.array(rng.sample(range(10_000), len(sets)))
    met, within = [], near._within
    monkeypatch.setattr(near, "SKETCHES", 5000)
    monkeypatch.setattr(near, "_within", lambda a, b, most: met.append(len(a) * b.shape[1]) or within(a, b, most))
    tile = near._tile(np.full(len(sets), near.BOTH, np.int8), seq, size, [near.wide_sketch(g) for g in sets], 0.85, 1)
    got = [tuple(sorted(p)) for i, j in tile for p in zip(i.tolist(), j.tolist(), strict=True)]
    similar = {(i, j) for j in range(len(sets)) for i in range(j) if (n := len(np.intersect1d(sets[i], sets[j]))) >= 0.85 * (len(sets[i]) + len(sets[j]) - n)}
    assert len(got) == len(set(got)) and similar <= set(got) and len(similar) > 250
    # all pairs of similar size, each twice, are 0.52
    assert max(met) <= 5000 and sum(met) < 0.5 * len(sets) ** 2


def test_cleaning_checks_each_row_once(spark):
    met = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            met.add(b.num_rows)
            yield b

    rows = samples(spark, [(f"我们公司系统第{i}个问题应该怎么处理，可以帮忙看看吗？", A) for i in range(20)]).coalesce(1)
    done = clean.clean(rows.mapInArrow(seen, rows.schema), labels(spark), clean.CleanConfig(min_score=0.0, dedup="both"))
    assert done.count() == 20 and done.filter("kept").count() > 0
    assert met.value == 20
