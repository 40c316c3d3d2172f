"""JSON in free text: scans that need state, as Arrow-batched UDFs."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, functions as F

_FENCE = re.compile(r"```(?:json)?[ \t]*\n?(.*?)```", re.S | re.I)


def escape_control(text: str) -> str:
    """Raw line feeds and tabs inside quoted strings, escaped; carriage returns and everything outside strings stay."""
    out, quoted, escaped = [], False, False
    for ch in text:
        if quoted and not escaped and ch in "\n\t":
            out.append("\\n" if ch == "\n" else "\\t")
            continue
        out.append(ch)
        if escaped:
            escaped = False
        elif ch == "\\":
            escaped = quoted
        elif ch == '"':
            quoted = not quoted
    return "".join(out)


def _as_object(text: str) -> str | None:
    for candidate in (text, escape_control(text)):
        try:
            return candidate if isinstance(json.loads(candidate), dict) else None
        except ValueError:
            continue
    return None


def _balanced(text: str) -> Iterator[str]:
    """Stretches from an opening brace to the brace that closes it, quotes respected."""
    at = text.find("{")
    while at >= 0:
        depth, quoted, escaped = 0, False, False
        for i in range(at, len(text)):
            ch = text[i]
            if escaped:
                escaped = False
            elif quoted:
                escaped, quoted = ch == "\\", ch != '"'
            elif ch == '"':
                quoted = True
            elif ch in "{}":
                depth += 1 if ch == "{" else -1
                if not depth:
                    yield text[at : i + 1]
                    at = i
                    break
        at = text.find("{", at + 1)


def first_object(text: str | None) -> str | None:
    """The first JSON object of a text: the whole text, else a fenced block, else a stretch between braces that match."""
    if not text:
        return None
    if found := _as_object(text.strip()):
        return found
    for block in _FENCE.findall(text):
        if found := _as_object(block.strip()):
            return found
    return next((x for stretch in _balanced(text) if (x := _as_object(stretch))), None)


def is_strict_json(text: str | None) -> bool:
    """Whether a text as a whole is JSON."""
    try:
        json.loads(text)
    except (TypeError, ValueError):
        return False
    return True


def _mapped(function, kind: str):
    @F.pandas_udf(kind)
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(function)

    return udf


def escape_control_in(text: Column) -> Column:
    return _mapped(lambda t: None if t is None else escape_control(t), "string")(text)


def first_object_in(text: Column) -> Column:
    """``first_object`` of a column; null where there is none."""
    return _mapped(first_object, "string")(text)


def strict_json(text: Column) -> Column:
    return _mapped(is_strict_json, "boolean")(text)


def greedy_object(text: Column) -> Column:
    """From the first brace to the last, fences dropped; null if there is none. Built-in functions only."""
    stretch = F.regexp_extract(F.regexp_replace(text, r"```(?:json)?", ""), r"(?s)\{.*\}", 0)
    return F.when(stretch != "", stretch)
