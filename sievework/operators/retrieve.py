"""Nearest neighbours of a stated query set against all rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Rows and queries of one block, in the mean; a task holds one block of each.
ROWS, QUERIES = 20_000, 512
LEAST, MOST = 1, 20


def check_n(n: int) -> None:
    if not isinstance(n, int) or not LEAST <= n <= MOST:
        raise ValueError(f"n_results must be between {LEAST} and {MOST} inclusive, got {n}")


def nearest(rows: DataFrame, queries: DataFrame, n: int = 5, metric: str = "l2", key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, vec_id, distance, rank: the n nearest rows of each query, ties by key; the query itself is a row like any other.

    Both sides are hashed into blocks of a fixed mean size, and each pair of blocks is one matrix product in one task. Of each
    pair the n best rows of each query go on, not all pairs. Nothing is collected or broadcast."""
    check_n(n)
    if metric not in ("l2", "cosine"):
        raise ValueError("metric is l2 or cosine")

    def best(_key: tuple, x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(q):
            return pd.DataFrame({"query_id": [], "vec_id": [], "distance": []})
        v, w = np.array(x["v"].tolist(), dtype=np.float64), np.array(q["v"].tolist(), dtype=np.float64)
        k, dot = x["k"].to_numpy(dtype=np.int64), w @ v.T
        if metric == "l2":
            d = np.sqrt(np.maximum((w * w).sum(1)[:, None] + (v * v).sum(1)[None, :] - 2 * dot, 0))
            d[q["k"].to_numpy()[:, None] == k[None, :]] = 0.0  # a row and itself, without the rounding of the product
        else:
            d = 1 - dot / np.maximum(np.sqrt((w * w).sum(1))[:, None] * np.sqrt((v * v).sum(1))[None, :], 1e-300)
        rounded = np.round(d, 9)
        m = min(n, d.shape[1])
        worst = np.partition(rounded, m - 1, axis=1)[:, m - 1 : m]
        order = np.empty((len(d), m), dtype=np.int64)
        for i, row in enumerate(rounded):  # only the rows that may be among the best are sorted, ties of the last one included
            near = np.flatnonzero(row <= worst[i])
            order[i] = near[np.lexsort((k[near], row[near]))][:m]
        return pd.DataFrame({"query_id": np.repeat(q["k"].to_numpy(), order.shape[1]), "vec_id": k[order].ravel(), "distance": np.take_along_axis(d, order, 1).ravel()})

    pick = lambda df: df.select(F.col(key).cast("long").alias("k"), F.col(vector).alias("v")).where("v is not null")
    x, q = pick(rows), pick(queries)
    nx, nq = max(1, -(-rows.count() // ROWS)), max(1, -(-queries.count() // QUERIES))
    block = lambda m: F.pmod(F.xxhash64("k"), F.lit(m)).cast("int")
    x = x.withColumn("xb", block(nx)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))
    q = q.withColumn("qb", block(nq)).withColumn("xb", F.explode(F.sequence(F.lit(0), F.lit(nx - 1))))
    parts = x.groupBy("xb", "qb").cogroup(q.groupBy("xb", "qb")).applyInPandas(best, "query_id long, vec_id long, distance double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.round("distance", 9), "vec_id"))
    return parts.withColumn("rank", rank).where(F.col("rank") <= n)


def context_of(hits: DataFrame, group: str, rank: Column, source: Column, page: Column, text: Column) -> DataFrame:
    """``group``, context: the hits of a group as numbered blocks with their source, in order. At most ``MOST`` a group."""
    block = F.concat(F.lit("--- Chunk "), rank.cast("string"), F.lit(" (source: "), F.coalesce(source, F.lit("unknown")), F.lit(", p."), F.coalesce(page.cast("string"), F.lit("?")), F.lit(") ---\n"), text, F.lit("\n"))
    parts = hits.select(group, F.struct(rank.alias("rank"), block.alias("block")).alias("b"))
    return parts.groupBy(group).agg(F.array_join(F.transform(F.array_sort(F.collect_list("b")), lambda x: x["block"]), "\n").alias("context"))
