"""Log lines as data: JSON records with a message of key=value pairs, parsed into a typed event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Events of a run's log and how their message begins. Fixed values.
EVENTS = ("turn_complete", "target_accepted", "target_rejected", "target_tokens", "progress", "complete", "pipeline_tokens", "LLM usage")
NUMBERS = ("index", "turn", "turns", "score", "prompt_tokens", "completion_tokens", "total_tokens", "accepted", "rejected")


def number_of(message: Column, name: str) -> Column:
    """The whole number after ``name=`` or ``name:`` of a message, null if there is none."""
    found = F.regexp_extract(message, rf"(?:^|[\s,(]){name}\s*[=:]\s*(\d+)", 1)
    return F.when(found != "", found.cast("bigint"))


def events(lines: DataFrame, column: str = "value") -> DataFrame:
    """ts, level, event, reason and the numbers of each log line; lines that aren't JSON or have no known event are left out."""
    raw = F.col(column)
    message = F.get_json_object(raw, "$.message")
    kind = F.lit(None).cast("string")
    for e in reversed(EVENTS):
        kind = F.when(message.startswith(e), F.lit(e)).otherwise(kind)
    reason = F.regexp_extract(message, r"reason\s*[=:]\s*([^,]+)", 1)
    stamp = F.try_to_timestamp(F.coalesce(F.get_json_object(raw, "$.timestamp"), F.get_json_object(raw, "$.time")))
    return lines.select(stamp.alias("ts"), F.get_json_object(raw, "$.level").alias("level"), kind.alias("event"), F.when(reason != "", F.trim(reason)).alias("reason"), *[number_of(message, n).alias(n) for n in NUMBERS]).where("event is not null")


def totals(parsed: DataFrame) -> DataFrame:
    """event, n, prompt, completion: counts and token sums by event."""
    return parsed.groupBy("event").agg(F.count("*").alias("n"), F.sum("prompt_tokens").alias("prompt"), F.sum("completion_tokens").alias("completion"))


def usage_of(reply: Column) -> Column:
    """Prompt and completion tokens of a reply's JSON under any of the names in use; 0 without."""
    def first(*paths: str) -> Column:
        return F.coalesce(*[F.get_json_object(reply, p).cast("bigint") for p in paths], F.lit(0))

    meta = "$.response_metadata"
    return F.struct(
        first(f"{meta}.token_usage.prompt_tokens", f"{meta}.usage.prompt_tokens", f"{meta}.usage.input_tokens", "$.usage_metadata.input_tokens").alias("prompt"),
        first(f"{meta}.token_usage.completion_tokens", f"{meta}.usage.completion_tokens", f"{meta}.usage.output_tokens", "$.usage_metadata.output_tokens").alias("completion"),
    )
