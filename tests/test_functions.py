"""Text functions, gates and chunkers by cases and by property."""

import json

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sievework.functions import chunking, json_scan, text as T
from sievework.operators import gates


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r["y"] for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_strip_is_unicode(spark):
    assert column(spark, ["  a b　\n", "", None], T.strip) == ["a b", "", None]


def test_close_blocks(spark):
    cases = {"<think>a<think>b": "<think>a</think>b", "<think>a": "<think>a</think>", "<THINK>a<think>b": "<THINK>a</think>b", "x": "x", "<think>a</think><think>b": "<think>a</think><think>b"}
    assert column(spark, list(cases), T.close_blocks) == list(cases.values())


def test_append_closer(spark):
    assert column(spark, ["<think>a", "<think>a</think>", "<think><think>a"], T.append_closer) == ["<think>a</think>", "<think>a</think>", "<think><think>a</think>"]


@pytest.mark.parametrize(
    "role,content,reason",
    [
        ("assistant", "<think>a</think> \n", "validation_failed: empty_assistant"),
        ("user", " ... ", "validation_failed: degenerate_placeholder (user)"),
        ("assistant", "<think>a</think>b<think>", "validation_failed: unclosed_think_block (opens=2, closes=1)"),
        ("assistant", "a</think>", "validation_failed: unclosed_think_block (opens=0, closes=1)"),
        ("assistant", None, None),
        ("user", "<think>", None),
    ],
)
def test_defect_of(spark, role, content, reason):
    df = spark.createDataFrame([(role, content)], "role string, content string")
    assert df.select(gates.defect_of(F.col("role"), F.col("content")).alias("r")).first()["r"] == reason


def test_clean_action_order(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, 0, "system", "..."), (2, 1, "assistant", "<think>x"), (3, 0, "assistant", "<think>x</think>"), (4, 0, "assistant", "<think>a</think>b<think>"), (5, 0, "assistant", "<think>x</think>y")]
    df = spark.createDataFrame(rows, "ex_id long, pos int, role string, content string")
    assert {r["ex_id"]: r["action"] for r in gates.clean_action(df).collect()} == {1: "unchanged", 2: "removed_degenerate", 3: "removed_empty", 4: "repaired_think", 5: "unchanged"}


def test_coercions(spark):
    assert column(spark, ["25%", "0.5", " 5 %"], T.weight_of) == [0.25, 0.5, 0.05]
    assert column(spark, ["Yes", "n", "maybe"], T.flag_of) == [True, False, None]
    assert column(spark, ["[5, null]", " ", "7"], T.grades_of) == [[5, None], [7], [7]]
    assert column(spark, ["a, b,", "1+", ""], T.values_of) == [["a", "b"], [], []]
    assert column(spark, ["<!-- a\nb\nc -->"], T.drop_comment_lines) == ["b"]


def test_fill_and_first_text(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    assert df.select(T.fill("{a}-{b}!", a=F.col("a"), b=F.col("b")).alias("x")).first()["x"] == "a-null!"
    assert df.select(T.first_text(F.lit(" "), F.col("b"), F.col("a")).alias("x")).first()["x"] == "a"


def test_json_scan():
    assert json_scan.first_object('x {"a": "}"} y') == '{"a": "}"}'
    assert json_scan.first_object('```json\n{"a": 1}\n``` {"b": 2}') == '{"a": 1}'
    assert json.loads(json_scan.first_object('{"a": "l1\nl2\t"}'))["a"] == "l1\nl2\t"
    assert json_scan.first_object("[1]") is None and json_scan.first_object(None) is None
    assert json_scan.escape_control('"a\r\n"') == '"a\r\\n"'
    assert json_scan.is_strict_json("{}") and not json_scan.is_strict_json("{} x") and not json_scan.is_strict_json(None)


@given(st.dictionaries(st.text(max_size=8), st.text(max_size=20), max_size=4), st.text(alphabet="ab {}\"\n", max_size=10))
@settings(max_examples=60, deadline=None)
def test_first_object_finds_a_clean_object(obj, before):
    found = json_scan.first_object(before.replace("{", "").replace('"', "") + json.dumps(obj))
    assert json.loads(found) == obj


@given(st.text(alphabet="ab .\n", max_size=400), st.integers(2, 60), st.data())
@settings(max_examples=100, deadline=None)
def test_recursive_chunks(text, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    chunks = chunking.recursive(text, size, overlap)
    assert all(0 < len(c) <= size and c == c.strip() for c in chunks)
    assert set("".join(chunks)) >= set(text) - set(" \n")


def test_fixed_chunks(spark):
    text = "abcdefghij" * 100
    df = spark.createDataFrame([(text,), (" \n",), ("ab",)], "x string")
    got = [r["c"] for r in df.select(chunking.fixed_chunks(F.col("x"), 64, 8).alias("c")).collect()]
    assert [c["text"] for c in got[0]] == [text[i : i + 64] for i in range(0, len(text) - 8, 56)]
    assert got[1] == [] and [c["text"] for c in got[2]] == ["ab"]


@pytest.mark.parametrize("size,overlap", [(0, 0), (5, 5), (5, -1)])
def test_chunk_arguments(size, overlap):
    with pytest.raises(ValueError):
        chunking.check(size, overlap)


def test_prompts(spark):
    from sievework.functions import prompts

    rows = [{"field": "layer", "values": ["a", "b"]}, {"field": "x", "values": []}]
    assert prompts.markdown_table(rows, ["field", "values"]).splitlines()[2:] == ["| layer | a, b |", "| x | any |"]
    assert [c["n"] for c in prompts.criteria_for([{"n": 1, "layer": "all"}, {"n": 2, "layer": "knowledge"}, {"n": 3}], "behaviour")] == [1, 3]
    assert prompts.system_prompt({"Goal": "g"}, {"Table": "t"}, ["Goal", "Table"]) == "## Goal\n\ng\n\n## Table\n\nt"
    with pytest.raises(ValueError):
        prompts.system_prompt({"Goal": " "}, {}, ["Goal"])
    df = spark.createDataFrame([("a", 1), ("z", 2)], "r string, x int")
    assert [r["p"] for r in df.select(prompts.choose({"a": "n={x}"}, F.col("r"), x=F.col("x")).alias("p")).collect()] == ["n=1", None]


def test_render_chat(spark):
    df = spark.createDataFrame([([("user", "q"), ("assistant", None)],)], "m array<struct<role:string,content:string>>")
    assert df.select(T.render_chat(F.col("m")).alias("t")).first()["t"] == "<user>\nq</user>\n<assistant>\n</assistant>\n"
