"""Generation targets: expansion, round robin, shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def expand(targets: DataFrame) -> DataFrame:
    """idx (from 0), target_id, k (from 1), grade: each target ``target_count`` times, numbered over all targets in order of target_id.

    The first index of a target is the running sum of the counts before it (one row a target); the grade goes round the
    target's grades by the index over all."""
    before = F.coalesce(F.sum("target_count").over(Window.orderBy("target_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    t = targets.withColumn("first", before).where("target_count > 0").select("target_id", "first", "grade_targets", F.explode(F.sequence(F.lit(1), F.col("target_count"))).alias("k"))
    idx = (F.col("first") + F.col("k") - 1).cast("long")
    return t.select(idx.alias("idx"), "target_id", "k", F.get("grade_targets", (idx % F.size("grade_targets")).cast("int")).alias("grade"))


def shares(targets: DataFrame) -> DataFrame:
    """type, targets, count, share of the count."""
    g = targets.groupBy("type").agg(F.count("*").alias("targets"), F.sum("target_count").alias("total"))
    return g.withColumn("share", F.col("total").cast("double") / F.sum("total").over(Window.partitionBy(F.lit(0))))  # one row a type
