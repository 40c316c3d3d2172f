"""Streaming queries over files, driven to their end, so that they compare with batch SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievework.functions import text as T
from sievework.operators import examples as X, gates
from sievework.runtime import read_table
from sievework.streaming import streams
from sievework.plans import base as B

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _stream(spark: SparkSession, d: str, table: str) -> DataFrame:
    return streams.read_stream(spark, f"{d}/{table}.parquet", read_table(spark, d, table).schema)


@query("SELECT event_id, user_id, event_type FROM events")
def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Events whose id is new. The table has each id once, so all come out."""
    s = streams.unique(_stream(spark, d, "events"), ["event_id"], "ts", "30 days")
    return streams.collect_stream(spark, s.select("event_id", "user_id", "event_type"), "stream-dedup")


@query("SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_window_counts(spark: SparkSession, d: str) -> DataFrame:
    s = streams.windowed(_stream(spark, d, "events"), "ts", ["event_type"], "1 hour", late="2 days").select(F.col("w.start").alias("hour"), "event_type", "n")
    return streams.last_update(spark, s, "stream-windows", ["hour", "event_type"]).select(F.col("hour").cast("timestamp_ntz").alias("hour"), "event_type", "n")


@query(
    f"""WITH r AS (SELECT lower({B.strip("role")}) AS r, content FROM messages), m AS (SELECT CASE WHEN r IN ('user', 'human') THEN 'user' WHEN r IN ('assistant', 'gpt', 'bot', 'model') THEN 'assistant' WHEN r = 'system' THEN 'system' END AS role, content FROM r)
SELECT role, coalesce({B.DEFECT}, 'ok') AS reason, count(*) AS n FROM m GROUP BY 1, 2"""
)
def stream_defects(spark: SparkSession, d: str) -> DataFrame:
    """Defects of messages as they arrive (deliveries counted, not keys)."""
    role = X.role_of(F.col("role"))
    s = _stream(spark, d, "messages").select(role.alias("role"), "content").withColumn("reason", F.coalesce(gates.defect_of(F.col("role"), F.col("content")), F.lit("ok")))
    return streams.last_update(spark, s.groupBy("role", "reason").agg(F.count("*").alias("n")), "stream-defects", ["role", "reason"])


@query("SELECT event_type AS key, count(*) AS n, count(*) FILTER (WHERE value >= 10) AS hits FROM events GROUP BY event_type")
def stream_ratio(spark: SparkSession, d: str) -> DataFrame:
    """A running ratio with state of its own."""
    s = streams.running_ratio(_stream(spark, d, "events").withColumn("hit", F.col("value") >= 10), "event_type", "hit")
    return streams.last_update(spark, s, "stream-ratio", ["key"])


@query(f"SELECT ex_id, pos, sha256(CASE WHEN {B.opens('content')} > {B.closes('content')} THEN content || '</think>' ELSE content END) AS digest FROM messages WHERE lower({B.strip('role')}) IN ('assistant', 'gpt', 'bot', 'model') AND content IS NOT NULL")
def stream_repair(spark: SparkSession, d: str) -> DataFrame:
    """Answers repaired on the way through."""
    s = _stream(spark, d, "messages").where((X.role_of(F.col("role")) == "assistant") & F.col("content").isNotNull())
    return streams.collect_stream(spark, s.select("ex_id", "pos", T.digest(T.append_closer(F.col("content"))).alias("digest")), "stream-repair")


@query(f"SELECT coalesce(lower({B.strip('metadata.layer')}), 'none') AS layer, count(*) AS rows, sum(ex_id)::bigint AS checksum FROM examples GROUP BY 1")
def stream_route(spark: SparkSession, d: str) -> DataFrame:
    """Examples routed by layer as they arrive, counted from the routed files (deliveries, not keys)."""
    layer = F.coalesce(X.label(F.col("metadata.layer")), F.lit("none"))
    path = streams.routed(_stream(spark, d, "examples").select("ex_id", layer.alias("layer")), "layer", "stream-route")
    back = spark.read.schema("ex_id long, layer string, epoch long").json(path)
    return back.groupBy("layer").agg(F.count("*").alias("rows"), F.sum("ex_id").alias("checksum"))
