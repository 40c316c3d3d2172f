"""Operators by small fixtures and against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.operators import analytics, dedup, gates, order, overlap, retrieve, rounds, targets
from sievework.plans import gate_queries, report_queries
from sievework.sources import documents, sinks
from sievework.streaming import streams


def test_running_and_tiles(spark):
    random.seed(1)
    rows = [(i, random.randint(0, 9)) for i in range(500)]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "k long, v long").repartition(7)
    got = {r["k"]: r["s"] for r in order.running(df, ["k"], {"s": F.col("v")}).collect()}
    total = 0
    for k, v in sorted(rows):
        total += v
        assert got[k] == total
    n = order.numbered(df, ["k"], "rn")
    tiles = {r["k"]: r["t"] for r in n.select("k", order.tile(F.col("rn"), F.lit(500), 7).alias("t")).collect()}
    want = {r["k"]: r["t"] for r in df.selectExpr("k", "ntile(7) over (order by k) as t").collect()}
    assert tiles == want


def test_running_empty(spark):
    assert order.numbered(spark.createDataFrame([], "k long"), ["k"]).count() == 0


@pytest.mark.parametrize("flags,drifted", [([1, 1, 1, 0], False), ([1] * 7 + [0] * 3, True), ([1] * 8 + [0] * 2, True)])
def test_split_bounds_are_strict(spark, flags, drifted):
    df = spark.createDataFrame(list(enumerate(flags)), "k int, f int")
    assert order.split_ratio(df, ["k"], F.col("f") == 1).orderBy(F.desc("k")).first()["drifted"] is drifted


def test_keep_first_with_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "k long, h string")
    assert {r["k"]: r["is_duplicate"] for r in dedup.keep_first(df, "h", "k").collect()} == {1: False, 2: True, 3: False, 4: True, 5: False}


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_nearest_in_blocks(spark, monkeypatch, metric):
    monkeypatch.setattr(retrieve, "ROWS", 40)
    monkeypatch.setattr(retrieve, "QUERIES", 3)
    rng = np.random.default_rng(3)
    v = rng.normal(size=(150, 6))
    v[7] = v[3]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in retrieve.nearest(df, df.where("vec_id % 20 = 0 or vec_id = 3"), 4, metric).collect()}
    for q in [*range(0, 150, 20), 3]:
        d = np.sqrt(((v - v[q]) ** 2).sum(1)) if metric == "l2" else 1 - v @ v[q] / (np.linalg.norm(v, axis=1) * np.linalg.norm(v[q]))
        want = sorted(range(150), key=lambda i: (round(d[i], 9), i))[:4]
        assert [got[q, k] for k in range(1, 5)] == want


@pytest.mark.parametrize("n", [0, 21])
def test_nearest_bounds(n):
    with pytest.raises(ValueError):
        retrieve.check_n(n)


def test_overlap(spark):
    words = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, "x y " + words), (2, "a b c"), (3, None)], "doc_id long, text string")
    pages = spark.createDataFrame([(9, words.upper()), (8, words)], "page_id long, text string")
    assert [tuple(r) for r in overlap.reproduced(docs, pages, 15).collect()] == [(1, 16)]


def test_expand(spark):
    t = spark.createDataFrame([(2, 3, [5, None]), (1, 2, [7]), (3, 0, [4])], "target_id int, target_count int, grade_targets array<int>")
    assert [(r["idx"], r["target_id"], r["grade"]) for r in targets.expand(t).orderBy("idx").collect()] == [(0, 1, 7), (1, 1, 7), (2, 2, 5), (3, 2, None), (4, 2, 5)]


def test_rounds_are_repeatable(spark):
    t = spark.createDataFrame([(i, "c", "reasoning" if i % 2 else "direct", "behaviour", None) for i in range(60)], "idx long, category string, type string, layer string, grade int")
    a, b = rounds.run(t), rounds.run(t)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(a.accepted) == rows(b.accepted) and rows(a.rejected) == rows(b.rejected)
    assert a.accepted.count() + a.rejected.count() == 60 and a.accepted.select("idx").distinct().count() == a.accepted.count()


def test_retry_waits_and_gives_up():
    waits, calls = [], []

    def model(idx, turn, prompt):
        calls.append(1)
        raise rounds.TransientError("503")

    with pytest.raises(rounds.TransientError):
        rounds.with_retry(model, 2, 2.0, waits.append)(0, 1, "")
    assert waits == [1.0, 2.0] and len(calls) == 3


def test_config_document():
    text = "# T\n" + "\n".join(f"## {n}\nbody of {n}\n### sub\n## Not a section\nmore" for n in documents.SECTIONS)
    assert "Not a section" in documents.sections(text)["Goal"]
    with pytest.raises(documents.ConfigError):
        documents.sections("## Goal\nx")
    rows = documents.table("x\n| File Pattern | Mode | Other |\n|---|:-:|---|\n| *.pdf | vlm | z |\n| a.pdf |\n\n| b | c |", {"File Pattern": "pattern", "Mode": "mode"})
    assert rows == [{"pattern": "*.pdf", "mode": "vlm"}, {"pattern": "a.pdf", "mode": ""}, {"pattern": "b", "mode": "c"}]
    assert documents.table("| file pattern |\n|---|\n| x |", {"File Pattern": "pattern"}) == []
    assert documents.key_values("| Layer | Path |\n|---|---|\n| a | x |\ntext\n| | y |\n| a | z |", "Layer", "Path") == {"a": "z"}
    assert documents.fenced_json('```json\n{"messages": [], "metadata": {}}\n```') == {"messages": [], "metadata": {}}
    assert len(documents.config_problems({})) == 8


def test_files(tmp_path):
    (tmp_path / "a.pdf").write_text("x")
    (tmp_path / "b.txt").write_text("x")
    assert [(p.rsplit("/", 1)[1], m) for p, m in documents.resolve_files(tmp_path, [("a.*", "vlm"), ("*", "standard")])] == [("a.pdf", "vlm"), ("b.txt", "standard")]
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c.pdf").write_text("x")
    name = lambda found: [p.rsplit("/", 1)[1] for p, _ in found]
    assert name(documents.resolve_files(tmp_path, [("../x", "standard"), ("/etc/*", "standard"), ("*.pdf", "standard")])) == ["a.pdf"]
    assert name(documents.resolve_files(tmp_path, [("**/*.pdf", "standard")])) == ["a.pdf", "c.pdf"]
    with pytest.raises(FileNotFoundError):
        documents.resolve_files(tmp_path, [("*.zip", "standard")])


def test_extract_pages(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\n\n two \fthree")
    (tmp_path / "b.txt").write_text("")
    pages, errors = documents.extract_pages(spark, str(tmp_path))
    assert sorted(map(tuple, pages.collect())) == [("a.txt", 1, "one\ntwo"), ("a.txt", 2, "three")]
    assert [r["source_file"] for r in errors.collect()] == ["b.txt"]


def test_json_lines_and_share_gpt(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"conversations": [{" from": "human", "value": "q"}, {"from": "gpt", "value": ""}]}\n\nnot json\n{"messages": [], "conversation": [{"role": "bot", "content": "a"}]}\n{"x": 1}\n')
    lines = documents.json_lines(spark, str(tmp_path), strict=False)
    got = [[tuple(m) for m in r["messages"]] for r in documents.share_gpt(lines).collect()]
    assert sorted(got) == [[("assistant", "a")], [("user", "q")]]
    with pytest.raises(Exception):
        documents.json_lines(spark, str(tmp_path)).collect()


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "t1"), ("b", "t2")], "domain string, text string")
    path = str(tmp_path / "c")
    with pytest.raises(sinks.CollectionMissingError):
        sinks.open_collection(spark, path)
    sinks.index_chunks(df, path)
    with pytest.raises(sinks.CollectionExistsError):
        sinks.index_chunks(df, path)
    sinks.index_chunks(df.where("domain = 'a'"), path, force=True)
    assert sinks.open_collection(spark, path, "a").count() == 1
    with pytest.raises(sinks.CollectionMissingError):
        sinks.open_collection(spark, path, "b")
    good, bad = sinks.split_rejected(df.withColumn("reason", F.when(F.col("domain") == "b", "x")), "reason")
    assert good.columns == ["domain", "text"] and bad.count() == 1


def test_checkpoint_and_lock(tmp_path):
    c = sinks.Checkpoint(tmp_path)
    with pytest.raises(FileNotFoundError):
        c.load()
    c.save(4)
    assert c.load() == 4
    c.path.write_text("{}")
    with pytest.raises(ValueError):
        c.load()
    c.clear()
    with sinks.Lock(tmp_path), pytest.raises(RuntimeError), sinks.Lock(tmp_path):
        pass
    (tmp_path / "old").write_text("x")
    sinks.prepare_output(tmp_path, resume=True)
    assert (tmp_path / "old").exists()
    sinks.prepare_output(tmp_path, resume=False)
    assert not (tmp_path / "old").exists() and (tmp_path / ".lock").exists()


def test_stream_keeps_state_over_restarts(spark, tmp_path):
    schema = "k string, f int"
    src = tmp_path / "in"
    spark.createDataFrame([("a", 1), ("a", 0)], schema).write.parquet(str(src))
    seen = []
    for step in range(2):
        df = streams.running_ratio(streams.read_stream(spark, str(src), spark.read.parquet(str(src)).schema), "k", "f")
        streams.each_batch(df, str(tmp_path / "state"), lambda b, e: seen.extend(map(tuple, b.collect()))).awaitTermination()
        spark.createDataFrame([("a", 1)], schema).write.mode("append").parquet(str(src))
    assert seen[-1] == ("a", 3, 2)


def test_logs(spark):
    from sievework.operators import logs

    lines = [
        '{"timestamp": "2026-01-02 03:04:05", "level": "INFO", "message": "LLM usage: prompt_tokens=12, completion_tokens=3"}',
        '{"timestamp": "x", "level": "INFO", "message": "target_rejected index=4, reason=timeout, turns=2"}',
        "not json",
        '{"message": "other"}',
        '{"message": "LLM usage: prompt_tokens=8, completion_tokens=1"}',
    ]
    parsed = logs.events(spark.createDataFrame([(x,) for x in lines], "value string"))
    rows = {r["event"]: r for r in parsed.collect()}
    assert rows["target_rejected"]["reason"] == "timeout" and rows["target_rejected"]["index"] == 4 and rows["target_rejected"]["ts"] is None
    assert {(r["event"], r["n"], r["prompt"], r["completion"]) for r in logs.totals(parsed).collect()} == {("LLM usage", 2, 20, 4), ("target_rejected", 1, None, None)}
    reply = '{"response_metadata": {"usage": {"input_tokens": 5}}, "usage_metadata": {"output_tokens": 7}}'
    u = spark.createDataFrame([(reply,), ("{}",)], "r string").select(logs.usage_of(F.col("r")).alias("u")).collect()
    assert [tuple(r["u"]) for r in u] == [(5, 7), (0, 0)]


def test_plan_and_content_rules():
    plan = [{"type": "reasoning", "count": 7}, {"type": "direct", "count": 3}]
    assert len(documents.plan_problems(plan, 11)) == 2 and documents.plan_problems(plan, 10, 0.7) == []
    assert len(documents.content_problems("Goal", "short", 10, ["Short", "long"])) == 2


def test_yaml_plan(spark, tmp_path):
    (tmp_path / "p.yaml").write_text("generation_targets:\n- {text: macbeth, topic: t, layer: behaviour, type: reasoning, ao: [AO1]}\n- {text: x, topic: y, grade_target: 7, layer: knowledge, type: direct, turns: 2}\n")
    pytest.importorskip("yaml")
    rows = documents.plan_rows(spark, documents.load_yaml(tmp_path / "p.yaml")).orderBy("idx").collect()
    assert [(r["text"], r["grade_target"], r["ao"], r["turns"]) for r in rows] == [("macbeth", None, ["AO1"], 1), ("x", 7, [], 2)]
    (tmp_path / "q.yaml").write_text("- 1\n")
    with pytest.raises(documents.ConfigError):
        documents.load_yaml(tmp_path / "q.yaml")


def test_ratio_over_accepted_examples_only(spark, tmp_path):
    """Rejected and duplicate examples don't move the running ratio of validation."""
    block = "<think>t</think> "
    given = [(1, "reasoning", block + "a"), (2, "direct", "b"), (3, "direct", block + "c"), (4, "reasoning", block + "d"), (5, "reasoning", "e"), (6, "reasoning", block + "a"), (7, "reasoning", block + "f")]
    messages = [(i, p, 1, r, c) for i, _, answer in given for p, r, c in ((0, "user", "q"), (1, "assistant", answer))]
    spark.createDataFrame(messages, "ex_id long, pos int, run_id long, role string, content string").write.parquet(str(tmp_path / "messages.parquet"))
    metadata = "struct<layer:string,type:string,ao:array<string>,text:string,topic:string,grade_target:int,source:string,turns:int>"
    rows = [(i, 1, i, None, ("behaviour" if i % 2 else "knowledge", t, [], None, None, None, "synthetic", 1)) for i, t, _ in given]
    spark.createDataFrame(rows, f"ex_id long, run_id long, target_id long, created_at timestamp, metadata {metadata}").write.parquet(str(tmp_path / "examples.parquet"))
    got = {r["ex_id"]: tuple(r)[1:] for r in gate_queries.validation_results(spark, str(tmp_path)).collect()}
    train, rag, bad, copy = "train.jsonl", "rag_index/knowledge.jsonl", "think block", "duplicate content detected"
    assert got == {1: ("accepted", 1, 1.0, True, train), 2: ("accepted", 2, 0.5, True, rag), 3: (bad, *[None] * 4), 4: ("accepted", 3, round(2 / 3, 9), True, rag), 5: (bad, *[None] * 4), 6: (copy, *[None] * 4), 7: ("accepted", 4, 0.75, False, train)}
    assert tuple(gate_queries.accepted_split_warning(spark, str(tmp_path)).first()) == (3, 4, 0.5, 1.0)


def test_five_reasons(spark, tmp_path):
    reasons = [r for n, r in enumerate(["F", "e", "d", "C", "b", "a"], 1) for _ in range(n)] + ["E"] * 2
    spark.createDataFrame([(i, r) for i, r in enumerate(reasons)], "reject_id long, reason string").write.parquet(str(tmp_path / "rejections.parquet"))
    assert [tuple(r) for r in report_queries.top_five_reasons(spark, str(tmp_path)).collect()] == [("a", 6), ("b", 5), ("c", 4), ("e", 4), ("d", 3)]


@pytest.mark.parametrize("bare,planned,made,released", [(None, "reasoning", 2, True), ("reasoning", "reasoning", 2, False), ("direct", "reasoning", 2, False), ("direct", "direct", 2, True), (None, "reasoning", 1, False)])
def test_release_needs_blocks_and_every_part_of_the_plan(spark, tmp_path, bare, planned, made, released):
    d, metadata = str(tmp_path), "struct<layer:string,type:string,ao:array<string>,text:string,topic:string,grade_target:int,source:string,turns:int>"
    kinds = [("reasoning", "<think>t</think> a")] * 500 + ([(bare, "a")] if bare else [])
    ex = [(i, 1, 1 + i % made, None, ("behaviour", t, [], None, "t", None, "synthetic", 1)) for i, (t, _) in enumerate(kinds)]
    spark.createDataFrame(ex, f"ex_id long, run_id long, target_id long, created_at timestamp, metadata {metadata}").write.parquet(d + "/examples.parquet")
    spark.createDataFrame([(i, 0, 1, "assistant", c) for i, (_, c) in enumerate(kinds)], "ex_id long, pos int, run_id long, role string, content string").write.parquet(d + "/messages.parquet")
    spark.createDataFrame([], "reject_id long, run_id long, target_id long, reason string, rejected_at timestamp").write.parquet(d + "/rejections.parquet")
    spark.createDataFrame([(1, "x", "reasoning", "behaviour"), (2, "y", planned, "behaviour")], "target_id long, category string, type string, layer string").write.parquet(d + "/generation_targets.parquet")
    row = report_queries.dataset_release(spark, d).first()
    assert row["released"] is released and report_queries.release_gate(spark, d).first()["released"]
    assert (row["missing"], row["no_think"], row["direct_no_think"]) == (2 - made, int(bare == "reasoning"), int(bare == "direct"))


def test_evaluation_set_and_delta(spark, tmp_path):
    lines = ['{"messages": [{"role": "user", "content": "q"}], "expected_behaviours": ["asks", "cites"], "red_flags": ["tells all"], "metadata": {"text": "macbeth", "grade_target": 7}}', "", '{"messages": [{"role": "user", "content": "r"}], "expected_behaviours": [], "metadata": {}}']
    (tmp_path / "golden.jsonl").write_text("\n".join(lines))
    golden = sinks.golden_set(spark, str(tmp_path / "golden.jsonl"))
    assert golden.select("example").distinct().count() == 2 and golden.where("metadata['grade_target'] = '7'").count() == 1
    assert sorted(tuple(r)[1:] for r in sinks.golden_checks(golden).collect()) == [("expected_behaviour", 0, "asks"), ("expected_behaviour", 1, "cites"), ("red_flag", 0, "tells all")]
    judged = spark.createDataFrame([("a", True, []), ("a", False, ["x"]), ("b", True, []), ("b", None, []), ("c", False, ["x"])], "run string, socratic boolean, flags array<string>")
    m = analytics.evaluation(judged, "run", {"socratic": F.col("socratic"), "red_flag": F.size("flags") > 0})
    assert {tuple(r) for r in analytics.run_delta(m, "run", "a", "b").collect()} == {("socratic", 0.5, 1.0, 0.5), ("red_flag", 0.5, 0.0, -0.5)}


def test_document_gate_reaches_every_step(spark):
    msg = '{"role": "%s", "content": "%s"}'
    good = ", ".join((msg % ("system", "s"), msg % ("user", "q"), msg % ("assistant", "<think>x</think> a")))
    doc = '{"messages": [%s], "metadata": {"layer": "behaviour", "type": "reasoning", "ao": ["AO1"], "grade": 7}}'
    cases = {
        doc % good: None,
        "not json": "Error: Invalid JSON",
        "[1]": "Error: Missing required field 'messages'",
        '{"messages": []}': "Error: Missing required field 'messages'",
        '{"messages": [5]}': "Error: messages[0] is not an object",
        '{"messages": [{" role": "user", "content": "x"}]}': "Error: messages[0] has invalid keys (unexpected=[' role'], missing=['role'])",
        doc % (good + ", " + msg % ("gpt", "x")): "Error: messages[3].role invalid value 'gpt' (expected: system, user, assistant)",
        doc % (msg % ("user", "x")): "Error: messages[0].role must be 'system'",
        '{"messages": [%s]}' % good: "Error: Missing required field 'metadata'",
        (doc % good).replace("behaviour", "x"): "Error: Invalid metadata.layer value 'x' (expected: behaviour, knowledge)",
        (doc % good).replace("reasoning", "x"): "Error: Invalid metadata.type value 'x' (expected: reasoning, direct)",
        (doc % good).replace("<think>x</think> a", "a"): "Error: metadata.type is 'reasoning' but assistant content has no <think> block",
        (doc % good).replace("reasoning", "direct"): "Error: metadata.type is 'direct' but assistant content contains <think> block",
        (doc % good).replace('"AO1"', '"AO1", "AO9"'): "Error: metadata.ao contains invalid values: ['AO9']",
        (doc % good).replace('"grade": 7', '"grade": 12'): "Error: metadata.grade value '12' not in valid values",
    }
    df = spark.createDataFrame(list(enumerate(cases)), "i int, line string")
    got = {r["i"]: r["e"] for r in df.select("i", gates.document_gate(F.col("line"), {"ao": ["AO1"], "grade": ["7"]}).alias("e")).collect()}
    assert got == dict(enumerate(cases.values()))
