"""Exact duplicates by digest, and the validation pipeline they are part of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sievework.functions.text import digest


def answers_digest(messages: DataFrame) -> DataFrame:
    """ex_id, digest of the answers of an example joined without a mark in between. One aggregate; a message delivered again is one element of the set."""
    parts = F.transform(F.array_sort(F.collect_set(F.when(F.col("role") == "assistant", F.struct("pos", F.coalesce("content", F.lit("")).alias("c"))))), lambda x: x["c"])
    return messages.groupBy("ex_id").agg(digest(F.array_join(parts, "")).alias("digest"))


def keep_first(df: DataFrame, key: str, order: Column | str, name: str = "is_duplicate") -> DataFrame:
    """``df`` with a flag on all rows of a key but the first in ``order``.

    The first of each key comes from an aggregate with a partial step, so a key that a third of all rows have meets
    no single sort; a join brings it back, which adaptive execution splits where the key is hot."""
    o = F.col(order) if isinstance(order, str) else order
    first = df.groupBy(F.col(key).alias("_k")).agg(F.min(o).alias("_first"))
    return df.join(first, F.col(key).eqNullSafe(F.col("_k"))).withColumn(name, o != F.col("_first")).drop("_k", "_first")
