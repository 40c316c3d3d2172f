"""Overlapping chunks of a text."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, functions as F

#: Boundaries from the strongest to the weakest; the last cuts anywhere.
SEPARATORS = ("\n\n", "\n", " ", "")
_CHUNKS = "array<struct<chunk_index:int,text:string>>"


def check(size: int, overlap: int) -> None:
    if size <= 0:
        raise ValueError("size must be positive")
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than size")


def fixed_chunks(text: Column, size: int = 512, overlap: int = 64) -> Column:
    """Chunks at a fixed stride: array of (chunk_index, text). Built-in functions only; a blank text has none."""
    check(size, overlap)
    stride = size - overlap
    last = F.greatest(F.lit(0), F.ceil((F.length(text) - size) / stride)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(i.alias("chunk_index"), F.substring(text, i * stride + 1, F.lit(size)).alias("text")))
    return F.when(F.regexp_replace(text, r"(?U)\s+", "") != "", cut).otherwise(F.array().cast(_CHUNKS))


def _pieces(text: str, size: int, level: int) -> list[str]:
    if len(text) <= size:
        return [text]
    mark = SEPARATORS[level]
    if not mark:
        return [text[i : i + size] for i in range(0, len(text), size)]
    parts = text.split(mark)
    parts = [p + mark for p in parts[:-1]] + parts[-1:]
    return [x for p in parts if p for x in (_pieces(p, size, level + 1) if len(p) > size else [p])]


def recursive(text: str, size: int = 512, overlap: int = 64) -> list[str]:
    """Pieces at the strongest boundary that keeps them within ``size``, merged greedily; each chunk starts with up to
    ``overlap`` characters of the one before, from a piece boundary. Chunks are trimmed, empty ones dropped."""
    check(size, overlap)
    out: list[str] = []
    held: list[str] = []
    length = 0
    for p in _pieces(text, size, 0):
        if length + len(p) > size and held:
            out.append("".join(held))
            while held and (length > overlap or length + len(p) > size):
                length -= len(held.pop(0))
        held.append(p)
        length += len(p)
    if held:
        out.append("".join(held))
    return [x for x in (c.strip() for c in out) if x]


def recursive_chunks(text: Column, size: int = 512, overlap: int = 64) -> Column:
    """``recursive`` of a column: array of (chunk_index, text)."""
    check(size, overlap)

    @F.pandas_udf(_CHUNKS)
    def chunks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda t: [{"chunk_index": i, "text": c} for i, c in enumerate(recursive(t, size, overlap))] if t and t.strip() else [])

    return chunks(text)
