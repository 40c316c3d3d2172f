"""Reports over examples, rejections, verdicts and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sievework.operators import order

VERDICTS = "array<struct<turn:int,decision:string,score:int,issues:array<struct<criterion:string,severity:string,description:string>>>>"


def share(df: DataFrame, keys: list[str], within: list[str] | None = None, name: str = "n") -> DataFrame:
    """Rows by keys with their share of all, or of the rows with the same ``within``. The totals are aggregates of the counts."""
    counts = df.groupBy(*keys).agg(F.count("*").alias(name))
    over = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))  # one row a group
    return counts.withColumn("share", F.col(name).cast("double") / F.sum(name).over(over))


def distribution(df: DataFrame, fields: list[str]) -> DataFrame:
    """field, value, n: the distribution of each field at once (grouping sets), null as "null"."""
    one = df.select(*fields).groupingSets([[F.col(f)] for f in fields], *[F.col(f) for f in fields])
    counted = one.agg(F.count("*").alias("n"), *[F.grouping(f).alias(f"_g{k}") for k, f in enumerate(fields)])
    of, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, f in enumerate(fields):
        mine = F.col(f"_g{k}") == 0
        of, value = F.when(mine, F.lit(f)).otherwise(of), F.when(mine, F.coalesce(F.col(f).cast("string"), F.lit("null"))).otherwise(value)
    return counted.select(of.alias("field"), value.alias("value"), "n")


def completeness(df: DataFrame, fields: list[str]) -> DataFrame:
    """field, filled, total: one pass over the table, unpivoted afterwards."""
    one = df.agg(F.count("*").alias("total"), *[F.count(f).alias(f) for f in fields])
    return one.select("total", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("filled")) for f in fields])).alias("x")).select("x.field", "x.filled", "total")


def verdicts(rejections: DataFrame) -> DataFrame:
    """reject_id, turn, decision, score, issues: the verdicts in the rejection history."""
    return rejections.select("reject_id", F.explode(F.from_json("rejection_history", VERDICTS)).alias("v")).select("reject_id", "v.*")


def gaps(events: DataFrame, key: str, ts: str, least_seconds: float) -> DataFrame:
    """Idle stretches of a key: key, start, end, seconds. A window by key: bounded by the events of one key."""
    t = events.select(key, "event_id", F.col(ts).cast("timestamp").alias("ts"))
    g = t.withColumn("start", F.lag("ts").over(Window.partitionBy(key).orderBy("ts", "event_id")))
    seconds = (F.unix_micros("ts") - F.unix_micros("start")) / 1e6
    return g.where("start is not null").withColumn("seconds", seconds).where(F.col("seconds") >= least_seconds).select(key, "event_id", "seconds")


def tiles(df: DataFrame, by: list[str], n: int) -> DataFrame:
    """``df`` with ``tile`` 1..n over the whole table, without one task holding it."""
    numbered = order.numbered(df, by, "_rank")
    return numbered.withColumn("tile", order.tile(F.col("_rank"), F.lit(df.count()), n)).drop("_rank")


def rate(accepted: Column, rejected: Column) -> Column:
    return accepted.cast("double") / F.greatest(accepted + rejected, F.lit(1))


def evaluation(judged: DataFrame, run: str, rates: dict[str, Column]) -> DataFrame:
    """run, metric, value: the share of the judged responses of each run for which a metric's condition holds; null isn't counted."""
    one = judged.groupBy(run).agg(*[F.avg(c.cast("double")).alias(n) for n, c in rates.items()])
    return one.select(run, F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in rates])).alias("x")).select(run, "x.metric", "x.value")


def run_delta(metrics: DataFrame, run: str, first: str, second: str) -> DataFrame:
    """metric, first, second, delta of two runs (a pivot); a metric that one run lacks has null there and as its delta."""
    p = metrics.groupBy("metric").pivot(run, [first, second]).agg(F.first("value"))
    p = p.select("metric", F.col(f"`{first}`").alias("first"), F.col(f"`{second}`").alias("second"))
    return p.where("first is not null or second is not null").withColumn("delta", F.col("second") - F.col("first"))
