"""Generation in rounds: all targets of a round at once, with a pluggable model.

A round asks the model for each open target, checks the form of the reply, asks the critic, and applies the gates. Accepted and
given-up targets leave; the rest go into the next round with feedback. The state between rounds is a table in the shared
folder, so a lost executor or a failed round repeats only that round, and the model's replies are stored before anything reads them twice.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from sievework.functions import json_scan, text as T
from sievework.operators import gates
from sievework.runtime import cut_lineage, scratch_path

#: (idx, turn, prompt) -> reply; may raise.
Model = Callable[[int, int, str], str]

PROMPT = "Generate a training example for:\n  Category: {category}\n  Type: {type}\n  Layer: {layer}\n  Grade Target: {grade}\n"
REPLY = "messages array<struct<role:string,content:string>>, metadata struct<layer:string,type:string>"
VERDICT = "decision string, score int, layer_correct boolean, type_correct boolean, issues array<struct<criterion:string,severity:string,description:string,suggestion:string>>, quality_assessment string"


class TransientError(RuntimeError):
    """An error worth a retry."""


def with_retry(model: Model, retries: int = 2, base: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> Model:
    """Transient errors are retried after 1, base, base^2 ... seconds; others pass through."""

    def call(idx: int, turn: int, prompt: str) -> str:
        for attempt in range(retries + 1):
            try:
                return model(idx, turn, prompt)
            except TransientError:
                if attempt == retries:
                    raise
                sleep(base**attempt)
        raise AssertionError

    return call


def _unit(*parts: object) -> float:
    return int.from_bytes(hashlib.sha256("|".join(map(str, parts)).encode()).digest()[:6], "big") / (1 << 48)


def stub_generator(idx: int, turn: int, prompt: str) -> str:
    """A deterministic stand-in: sound replies, broken forms, placeholders and unclosed blocks by the hash of index and turn."""
    u = _unit("g", idx, turn)
    if u < 0.05:
        return "no object here"
    kind = "reasoning" if "Type: reasoning" in prompt else "direct"
    layer = "knowledge" if "Layer: knowledge" in prompt else "behaviour"
    block = "<think>plan</think>\n\n" if kind == "reasoning" else ""
    answer = "..." if u < 0.10 else f"{block.replace('</think>', '') if u < 0.14 else block}Answer {idx}.{turn}"
    body = {"messages": [{"role": "system", "content": "Be kind."}, {"role": "user", "content": f"Question {idx}"}, {"role": "assistant", "content": answer}], "metadata": {"layer": layer, "type": kind}}
    return f"Here it is:\n```json\n{json.dumps(body)}\n```"


def stub_critic(idx: int, turn: int, prompt: str) -> str:
    u = _unit("c", idx, turn)
    issues = [] if u > 0.4 else [{"criterion": "ao_accuracy", "severity": "blocking" if u < 0.2 else "minor", "description": "weak evidence", "suggestion": "quote more"}]
    return json.dumps({"decision": "accept" if u > 0.25 else "revise", "score": 1 + int(u * 5), "layer_correct": True, "type_correct": u > 0.02, "criteria_met": {}, "issues": issues, "quality_assessment": "fine" if u > 0.4 else "thin"})


def _asked(df: DataFrame, model: Model, prompt: str, out: str, turn: int) -> DataFrame:
    """``df`` with the model's replies; an error is a null reply and its text in ``out``_error."""
    names = df.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            replies, errors = [], []
            for idx, text in zip(batch["idx"], batch[prompt]):
                try:
                    replies.append(model(int(idx), turn, text))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001
                    replies.append(None)
                    errors.append(f"llm_failure: {e}")
            yield batch.assign(**{out: replies, f"{out}_error": errors})[[*names, out, f"{out}_error"]]

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInPandas(run, f"{fields}, {out} string, {out}_error string")


@dataclass
class Outcome:
    accepted: DataFrame  # idx, turn, example (JSON), layer
    rejected: DataFrame  # idx, reason, turns
    rounds: int


def run(targets: DataFrame, generator: Model = stub_generator, critic: Model = stub_critic, max_turns: int = 3, slots: int | None = None) -> Outcome:
    """``targets``: idx, category, type, layer, grade. ``slots`` caps how many requests run at once."""
    path = scratch_path(targets.sparkSession, "rounds")
    state = cut_lineage(targets.select("idx", "category", "type", "layer", F.col("grade").cast("string").alias("grade"), F.lit("").alias("feedback")))
    turn = 0
    while turn < max_turns:
        turn += 1
        ask = T.generator_message(F.col("category"), F.col("type"), F.col("layer"), F.col("grade"), F.lit(None).cast("string"), F.col("feedback"))
        todo = state.withColumn("prompt", ask)
        if slots:
            todo = todo.coalesce(slots)
        replied = _asked(todo, generator, "prompt", "reply", turn).withColumn("example", json_scan.first_object_in(T.close_blocks(F.col("reply"))))
        parsed = replied.withColumn("p", F.from_json("example", REPLY))
        formed = F.col("p.messages").isNotNull() & F.col("p.metadata").isNotNull()
        judged = _asked(parsed.withColumn("formed", F.coalesce(formed, F.lit(False))).withColumn("judge", F.coalesce("example", F.lit(""))), critic, "judge", "verdict", turn)
        v = F.from_json("verdict", VERDICT)
        defect = F.filter(F.transform(F.col("p.messages"), lambda m: gates.defect_of(m["role"], m["content"])), lambda x: x.isNotNull())
        done = judged.withColumn("v", v).withColumn("defect", F.get(defect, F.lit(0)))
        ok = F.col("formed") & F.coalesce(gates.accepted(F.col("v")), F.lit(False)) & F.col("defect").isNull()
        why = (
            F.when(F.coalesce("reply_error", "verdict_error").isNotNull(), F.coalesce("reply_error", "verdict_error"))
            .when(~F.col("formed"), F.lit("FORMAT ERROR: no object with messages and metadata"))
            .when(F.col("defect").isNotNull(), F.col("defect"))
            .otherwise(T.feedback(F.col("v.quality_assessment"), F.col("v.issues")))
        )
        kept = done.select("idx", "category", "type", "layer", "grade", F.lit(turn).alias("turn"), "example", ok.alias("ok"), why.alias("feedback"), F.coalesce("reply_error", "verdict_error").alias("error"))
        kept.write.mode("overwrite").parquet(f"{path}/turn={turn}-rows")
        kept = targets.sparkSession.read.parquet(f"{path}/turn={turn}-rows")
        state = kept.where("not ok and error is null").select("idx", "category", "type", "layer", "grade", "feedback")
        if not state.limit(1).count():
            break
    every = targets.sparkSession.read.parquet(*[f"{path}/turn={t}-rows" for t in range(1, turn + 1)])
    accepted = every.where("ok").select("idx", "turn", "example", "layer")
    last = every.groupBy("idx").agg(F.max("turn").alias("turns"), F.bool_or("ok").alias("ok"), F.max("error").alias("error"))
    return Outcome(accepted, last.where("not ok").select("idx", F.coalesce("error", F.lit("max_turns_exhausted")).alias("reason"), "turns"), turn)
