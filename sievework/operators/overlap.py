"""Verbatim reproduction: runs of words that two collections share."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def runs(df: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """key, run: the hash of each run of n words (lower case, parted by white space)."""
    words = F.filter(F.split(F.lower(F.col(text)), r"\s+"), lambda w: w != "")
    w = df.select(F.col(key).alias("key"), words.alias("w")).where(F.size("w") >= n)
    made = F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.xxhash64(F.array_join(F.slice(F.col("w"), i, n), " ")))
    return w.select("key", F.explode(F.array_distinct(made)).alias("run"))


def reproduced(candidates: DataFrame, sources: DataFrame, n: int = 15, key: str = "doc_id", source_key: str = "page_id", text: str = "text") -> DataFrame:
    """key, shared: candidates with at least one run of n words of a source, and the number of distinct runs they share.

    Runs of the sources are made distinct before the join, so a passage that many sources have is one row."""
    seen = runs(sources, source_key, text, n).select("run").distinct()
    return runs(candidates, key, text, n).join(seen, "run", "left_semi").groupBy("key").agg(F.count("*").alias("shared")).withColumnRenamed("key", key)
