"""Structured Streaming forms: files as they arrive, deduplication, windows with late data, routed output, stateful ratio."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sievework.runtime import scratch_path


def read_stream(spark: SparkSession, path: str, schema: StructType, kind: str = "parquet", files_per_trigger: int | None = None) -> DataFrame:
    """New files of a folder as a stream. ``path`` may be one file's folder with a glob."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", os.path.basename(path)) if os.path.splitext(path)[1] and not os.path.isdir(path) else spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(kind).load(os.path.dirname(path) if os.path.splitext(path)[1] and not os.path.isdir(path) else path)


def run_once(df: DataFrame, checkpoint: str, out: str, mode: str = "append") -> None:
    """All that is there now, through the streaming engine, into Parquet."""
    df.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", out).outputMode(mode).trigger(availableNow=True).start().awaitTermination()


def each_batch(df: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "update") -> StreamingQuery:
    """``write(batch, epoch)`` for each micro-batch; with an idempotent write by epoch, a retried batch counts once."""
    return df.writeStream.option("checkpointLocation", checkpoint).outputMode(mode).foreachBatch(write).trigger(availableNow=True).start()


def unique(df: DataFrame, key: list[str], ts: str, late: str = "1 hour") -> DataFrame:
    """Rows whose key is new within the watermark. State is kept only as long as late rows may come."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).dropDuplicatesWithinWatermark(key)


def windowed(df: DataFrame, ts: str, keys: list[str], width: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Counts by window and keys; rows later than ``late`` are left out."""
    t = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return t.groupBy(F.window(ts, width, slide or width).alias("w"), *keys).agg(F.count("*").alias("n"))


def running_ratio(df: DataFrame, key: str, flag: str) -> DataFrame:
    """key, n, hits after each micro-batch; the state outlives a restart, by the checkpoint."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def update(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, hits = state.get if state.exists else (0, 0)
        for batch in batches:
            n, hits = n + len(batch), hits + int(batch["flag"].sum())
        state.update((n, hits))
        yield pd.DataFrame({"key": [k[0]], "n": [n], "hits": [hits]})

    rows = df.select(F.col(key).cast("string").alias("key"), F.col(flag).cast("int").alias("flag"))
    return rows.groupBy("key").applyInPandasWithState(update, "key string, n long, hits long", "n long, hits long", "update", GroupStateTimeout.NoTimeout)


def collect_stream(spark: SparkSession, df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """The rows of a stream that ran over what is there, read back from the shared folder."""
    out = scratch_path(spark, name)
    run_once(df, f"{out}-state", f"{out}-rows", mode)
    return spark.read.parquet(f"{out}-rows")


def last_update(spark: SparkSession, df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """The last row of each key of a stream in update mode. Each epoch has a folder of its own, so a retry overwrites itself."""
    out = scratch_path(spark, name)

    def write(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{out}-rows/batch={epoch}")

    each_batch(df, f"{out}-state", write).awaitTermination()
    rows = spark.read.parquet(f"{out}-rows").drop("batch")
    others = [c for c in rows.columns if c not in (*keys, "epoch")]
    return rows.groupBy(*keys).agg(*[F.max_by(c, "epoch").alias(c) for c in others])


def routed(df: DataFrame, by: str, name: str) -> str:
    """Rows of a stream into one folder for each value of ``by``; the path. An epoch that is repeated overwrites its own files."""
    out = scratch_path(df.sparkSession, name)

    def write(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch", by).json(f"{out}-rows")

    each_batch(df, f"{out}-state", write, "append").awaitTermination()
    return f"{out}-rows"
