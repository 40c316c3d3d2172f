"""Prompt text from tables: small, on the driver; the templates themselves are parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from sievework.functions.text import fill


def markdown_table(rows: Sequence[dict], columns: Sequence[str], empty: str = "any") -> str:
    """Rows as a pipe table; a list is joined by commas, an empty cell is ``empty``."""
    cell = lambda v: (", ".join(map(str, v)) if isinstance(v, (list, tuple)) else "" if v is None else str(v)) or empty
    lines = ["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
    return "\n".join(lines + ["| " + " | ".join(cell(r.get(c)) for c in columns) + " |" for r in rows])


def criteria_for(criteria: Sequence[dict], layer: str) -> list[dict]:
    """The criteria of a layer and those of all."""
    return [c for c in criteria if c.get("layer", "all") in (layer, "all")]


def system_prompt(sections: dict[str, str], tables: dict[str, str], order: Sequence[str]) -> str:
    """Sections and tables under second-level headings in ``order``; a missing or blank one is an error."""
    parts = {**sections, **tables}
    if missing := [n for n in order if not parts.get(n, "").strip()]:
        raise ValueError(f"missing: {', '.join(missing)}")
    return "\n\n".join(f"## {n}\n\n{parts[n].strip()}" for n in order)


def choose(templates: dict[str, str], route: Column, **columns: Column) -> Column:
    """The template named by ``route``, filled from the columns; null for a name without template."""
    out = F.lit(None).cast("string")
    for name, template in templates.items():
        out = F.when(route == name, fill(template, **columns)).otherwise(out)
    return out
