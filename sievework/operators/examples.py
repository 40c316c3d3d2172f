"""The tables as relations: each key once, roles and labels in one spelling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sievework.functions.text import strip
from sievework.runtime import read_table

#: Role names of chat exports, by the role they mean. Fixed values.
ROLE_ALIASES = {"system": "system", "user": "user", "human": "user", "assistant": "assistant", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def role_of(role: Column) -> Column:
    """system, user or assistant in any spelling; null for anything else."""
    spelled = F.lower(strip(role))
    out = F.lit(None).cast("string")
    for name, means in ROLE_ALIASES.items():
        out = F.when(spelled == name, F.lit(means)).otherwise(out)
    return out


def label(value: Column) -> Column:
    return F.lower(strip(value))


def delivered(spark: SparkSession, d: str) -> DataFrame:
    """ex_id, pos, run_id, role, content as delivered: a key may repeat with equal content. For aggregates that repeats don't change, and
    for ``once`` over narrow columns; the content itself then never goes through a shuffle."""
    return read_table(spark, d, "messages").select("ex_id", "pos", "run_id", role_of(F.col("role")).alias("role"), "content")


def once(df: DataFrame, *columns: Column | str) -> DataFrame:
    """ex_id, pos and ``columns``, one row for each key: what is computed of a message is narrow, so it is computed first."""
    return df.select("ex_id", "pos", *columns).dropDuplicates(["ex_id", "pos"])


def messages(spark: SparkSession, d: str) -> DataFrame:
    """ex_id, pos, run_id, role, content; one row for each key. The content goes through the shuffle; see ``delivered``."""
    return delivered(spark, d).dropDuplicates(["ex_id", "pos"])


def examples(spark: SparkSession, d: str) -> DataFrame:
    """One row for each ex_id, metadata flattened, layer and type in lower case."""
    raw = read_table(spark, d, "examples").dropDuplicates(["ex_id"])
    m = F.col("metadata")
    return raw.select(
        "ex_id", "run_id", "target_id", "created_at", label(m["layer"]).alias("layer"), label(m["type"]).alias("type"), m["ao"].alias("ao"), label(m["text"]).alias("text"),
        label(m["topic"]).alias("topic"), m["grade_target"].alias("grade_target"), m["source"].alias("source"), m["turns"].alias("turns"),
    )


def rejections(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "rejections").dropDuplicates(["reject_id"]).withColumn("reason", F.lower(F.col("reason")))


def nested(msgs: DataFrame) -> DataFrame:
    """ex_id, messages: the conversation of each example as an array in order. A message delivered again is one element of the set."""
    return msgs.groupBy("ex_id").agg(F.transform(F.array_sort(F.collect_set(F.struct("pos", "role", "content"))), lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))
