"""Nulls in every column, also in keys: nothing crashes, and rows without a key are left out."""

import pytest
from pyspark.sql import functions as F

from sievework.llm import bpe, confusables, neardup, packing, pairs, sampling, scans, splitting


def rows(n, *extra):
    return [tuple(None if i == j else v for j, v in enumerate(extra)) for i in range(len(extra) + 1)] * n


def test_pairs(spark):
    df = spark.createDataFrame(rows(2, 1, 1, "assistant", "...") + [(1, 0, "user", "q")], "ex_id long, pos int, role string, content string")
    assert [tuple(r) for r in pairs.broken_pairs(df).collect()] == [(1, 0, "empty")]


def test_scans(spark):
    df = spark.createDataFrame(rows(2, 1, "f", 1, "Some text re-"), "page_id long, source_file string, page_number int, text string")
    noise = scans.find_noise(df)
    assert {r["page_id"] for r in scans.noise_lines(noise).collect()} <= {1}
    assert {r["page_id"] for r in scans.repaired_pages(noise).collect()} == {1}


def test_neardup(spark):
    text = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame(rows(1, 1, 0, text) + [(2, 0, text), (2, None, "more")], "ex_id long, pos int, content string")
    found = neardup.links(df, "ex_id", "pos", "content", neardup.Params(k=3, threshold=0.5))
    assert {tuple(r) for r in neardup.all_pairs(found, "ex_id").collect()} == {(1, 2)}


def test_sampling(spark):
    df = spark.createDataFrame(rows(1, 1, "x") + [(2, "x"), (3, None)], "ex_id long, a string")
    t = spark.createDataFrame([("a", "x", 1000, 1)], "field string, value string, share_permille int, min_rows int")
    s = sampling.draw(df, "ex_id", {"a": sampling.label("a")}, t, 0.5)
    assert s.rows.where("ex_id is null").count() == 0 and s.rows.count() == s.size


def test_documents(spark):
    df = spark.createDataFrame([(None, "a b"), (1, None), (2, "a b"), (3, "a b"), (None, "a b")], "doc_id long, text string")
    assert [tuple(r) for r in confusables.same_look_pairs(df).collect()] == [(2, 3)]
    assert splitting.split_items(df, "document", 2, 0, "doc_id").where("item_key is null").count() == 0
    sizes = df.withColumn("n_tokens", F.when(F.col("doc_id") != 1, F.lit(3)))
    assert {r["doc_id"] for r in packing.pack(sizes, 4).collect()} == {2, 3}


@pytest.mark.skipif(not __import__("os").path.isdir(bpe.TOKENIZER_DIR), reason="no vocabularies")
def test_ids(spark):
    df = spark.createDataFrame([(None, "a"), (1, None)], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["ids"]) for r in bpe.encode_documents(df).collect()) == [(0, [64]), (1, [])]
