"""Operators over a total order that don't put the whole table into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sievework.runtime import cut_lineage


def running(df: DataFrame, order: list[str], sums: dict[str, Column]) -> DataFrame:
    """``df`` with running sums over the whole table in ``order`` (a total order), the current row included.

    Rows are range-partitioned; each partition is summed by itself, and the totals of the partitions before it (one row
    each) are added. The range partitions are written once, so both passes see the same ones."""
    parts = cut_lineage(df.repartitionByRange(*order).select("*", F.spark_partition_id().alias("_part"), *[c.alias(f"_v_{n}") for n, c in sums.items()]))
    totals = parts.groupBy("_part").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    offsets = totals.select("_part", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums])
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = parts.join(F.broadcast(offsets), "_part")
    for n in sums:
        out = out.withColumn(n, F.sum(f"_v_{n}").over(inside) + F.col(f"_o_{n}"))
    return out.drop("_part", *[f"{p}{n}" for n in sums for p in ("_v_", "_o_")])


def numbered(df: DataFrame, order: list[str], name: str = "rn") -> DataFrame:
    """Row numbers from 1 over the whole table."""
    return running(df, order, {name: F.lit(1)})


def tile(rank: Column, total: Column, tiles: int) -> Column:
    """The number of the tile (from 1) of a row of this rank, the first tiles one longer where the rows don't divide."""
    small, longer = F.floor(total / tiles), total % tiles
    edge = longer * (small + 1)
    return F.when(rank <= edge, F.ceil(rank / (small + 1))).otherwise(longer + F.ceil((rank - edge) / F.greatest(small, F.lit(1)))).cast("int")


def split_ratio(df: DataFrame, order: list[str], reasoning: Column, target: float = 0.75, tolerance: float = 0.05) -> DataFrame:
    """Running share of reasoning rows, and whether it is off the target by the tolerance or more (in doubles)."""
    r = running(df, order, {"n": F.lit(1), "n_reasoning": reasoning.cast("int")})
    ratio = F.col("n_reasoning").cast("double") / F.col("n")
    return r.withColumn("ratio", ratio).withColumn("drifted", ~(F.abs(ratio - F.lit(target)) < F.lit(tolerance)))


def split_warning(ratio: Column) -> Column:
    return F.format_string("Split ratio drifted: %.1f%% reasoning / %.1f%% direct (target 75/25, tolerance ±5%%)", ratio * 100, (1 - ratio) * 100)
