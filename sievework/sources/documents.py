"""Reading sources: JSON lines, plans, configuration documents, files by pattern, pages of documents."""

from __future__ import annotations

import json
import keyword
import logging
import os
import re
from collections.abc import Callable, Iterator
from pathlib import Path
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from sievework.functions import json_scan, text as T

#: The sections of a configuration document, in the order in which missing ones are reported. Fixed values.
SECTIONS = ("Goal", "Source Documents", "System Prompt", "Generation Targets", "Generation Guidelines", "Evaluation Criteria", "Output Schema", "Metadata Schema", "Layer Routing")


class ConfigError(ValueError):
    """A configuration that can't be used; ``problems`` has (section, text) pairs."""

    def __init__(self, problems: list[tuple[str, str]]):
        self.problems = problems
        super().__init__("; ".join(f"{s}: {t}" for s, t in problems))


def json_lines(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """line (text of each line that isn't blank) and valid. ``strict``: a line that isn't JSON fails the read when it is reached."""
    lines = spark.read.text(path).where(T.strip(F.col("value")) != "").select(F.col("value").alias("line"), json_scan.strict_json(F.col("value")).alias("valid"))
    if strict:
        return lines.withColumn("valid", F.when(F.col("valid"), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("not JSON: "), F.left(F.col("line"), F.lit(200))))))
    return lines.where("valid")


def share_gpt(lines: DataFrame) -> DataFrame:
    """line, messages: role and content of each message under any of the names that exports use.

    messages, conversations or conversation; role or from; content or value; keys may have blanks around. Empty
    messages go, a record stays even if all of its messages go; a record without messages is left out."""
    raw = "array<map<string,string>>"
    found = F.coalesce(*[F.when(F.get_json_object("line", f"$.{k}").startswith("[") & (F.get_json_object("line", f"$.{k}") != "[]"), F.from_json(F.get_json_object("line", f"$.{k}"), raw)) for k in ("messages", "conversations", "conversation")])
    clean = F.transform(found, lambda m: F.map_from_entries(F.transform(F.map_entries(m), lambda e: F.struct(T.strip(e["key"]), e["value"]))))
    role = lambda m: F.lower(F.coalesce(F.element_at(m, "role"), F.element_at(m, "from"), F.lit("")))
    known = lambda r: F.when(r.isin("gpt", "bot", "model"), "assistant").when(r == "human", "user").otherwise(r)
    shaped = F.transform(clean, lambda m: F.struct(known(role(m)).alias("role"), F.coalesce(F.element_at(m, "content"), F.element_at(m, "value"), F.lit("")).alias("content")))
    return lines.select("line", F.filter(shaped, lambda m: m["content"] != "").alias("messages")).where("messages is not null")


def load_yaml(path: str | Path) -> dict:
    """A YAML mapping. FileNotFoundError without the file, ConfigError if it is no mapping."""
    import yaml

    data = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    if not isinstance(data, dict):
        raise ConfigError([("file", "must be a mapping")])
    return data


def plan_rows(spark: SparkSession, plan: dict) -> DataFrame:
    """idx, text, topic, grade_target, layer, type, ao, turns of the targets of a plan."""
    rows = [
        (i, t.get("text"), t.get("topic"), t.get("grade_target"), t.get("layer"), t.get("type"), list(t.get("ao") or []), int(t.get("turns", 1)))
        for i, t in enumerate(plan.get("generation_targets") or plan.get("targets") or [])
    ]
    return spark.createDataFrame(rows, "idx long, text string, topic string, grade_target int, layer string, type string, ao array<string>, turns int")


# --- configuration documents


def sections(markdown: str, names: tuple[str, ...] | None = SECTIONS) -> dict[str, str]:
    """Text below each second-level heading. With ``names`` only these headings part the text and all must be there;
    without, every such heading does. Of a heading that is there twice the last counts."""
    out: dict[str, list[str]] = {}
    current: list[str] | None = None
    for line in markdown.splitlines():
        m = re.match(r"^##[ \t]+(.+?)\s*$", line)
        if m and (names is None or m[1] in names):
            current = out[m[1]] = []
        elif current is not None:
            current.append(line)
    found = {k: "\n".join(v).strip() for k, v in out.items()}
    if names is not None and (missing := [n for n in names if n not in found]):
        raise ConfigError([(n, "section is missing") for n in missing])
    if names is None and not found:
        raise ConfigError([("document", "has no sections")])
    return found


def section(markdown: str, name: str) -> str:
    m = re.search(rf"^##[ \t]+{re.escape(name)}[ \t]*\n(.*?)(?=^##[ \t]|\Z)", markdown, re.M | re.S)
    if not m:
        raise ConfigError([(name, "section is missing")])
    return m[1].strip()


def _cells(line: str) -> list[str]:
    return [c.strip() for c in line.strip().strip("|").split("|")]


def table(body: str, columns: dict[str, str], drop_empty: bool = False) -> list[dict[str, str]]:
    """Rows of the pipe table whose header has one of ``columns`` (header -> field), by its spelling. Lines without a pipe are passed over,
    unknown columns left out, short rows filled with "". ``drop_empty``: empty cells are dropped before columns are counted, as
    an older form of the documents has it."""
    header: list[str] | None = None
    rows = []
    for line in body.splitlines():
        if "|" not in line:
            continue
        cells = _cells(line)
        if drop_empty:
            cells = [c for c in cells if c]
        if not cells or all(re.fullmatch(r":?-+:?", c) for c in cells):
            continue
        if header is None:
            header = cells if any(c in columns for c in cells) else None
            continue
        cells += [""] * (len(header) - len(cells))
        rows.append({columns[h]: c for h, c in zip(header, cells) if h in columns})
    return rows


def key_values(body: str, key: str, value: str) -> dict[str, str]:
    """A table of two columns as a mapping; rows without a key are left out, and of a key that is there twice the last counts."""
    return {r.get("key", ""): r.get("value", "") for r in table(body, {key: "key", value: "value"}) if r.get("key")}


def table_frame(spark: SparkSession, rows: list[dict[str, str]], fields: list[str]) -> DataFrame:
    """Table rows as text columns; the coercions of ``functions.text`` type them."""
    return spark.createDataFrame([tuple(r.get(f, "") for f in fields) for r in rows], ", ".join(f"{f} string" for f in fields))


def fenced_json(body: str) -> dict:
    """The object of the first JSON fence; it must have messages and metadata."""
    m = re.search(r"```json[ \t]*\n(.*?)```", body, re.S)
    if not m:
        raise ConfigError([("Output Schema", "no JSON block")])
    try:
        data = json.loads(m[1])
    except ValueError as e:
        raise ConfigError([("Output Schema", f"not JSON: {e}")]) from None
    missing = sorted({"messages", "metadata"} - set(data)) if isinstance(data, dict) else ["messages", "metadata"]
    if missing:
        raise ConfigError([("Output Schema", f"missing keys: {', '.join(missing)}")])
    return data


def config_problems(c: dict, least: dict[str, int] | None = None, reasoning: float = 0.7) -> list[tuple[str, str]]:
    """All rules of a parsed configuration that fail, none left out after the first.

    ``c``: goal, system_prompt, guidelines (text), sources, criteria, metadata (row lists), targets (type, count), schema (dict), routing (dict)."""
    out: list[tuple[str, str]] = []
    for name, chars in (least or {"goal": 50, "system_prompt": 100, "guidelines": 100}).items():
        if len(c.get(name, "")) < chars:
            out.append((name, f"at least {chars} characters, {len(c.get(name, ''))} found"))
    if not c.get("sources"):
        out.append(("sources", "at least 1 entry"))
    if len(c.get("criteria", [])) < 3:
        out.append(("criteria", f"at least 3, {len(c.get('criteria', []))} found"))
    out += [("criteria", f"not an identifier: {r['name']}") for r in c.get("criteria", []) if not r["name"].isidentifier() or keyword.iskeyword(r["name"])]
    if missing := sorted({"messages", "metadata"} - set(c.get("schema", {}))):
        out.append(("schema", f"missing keys: {', '.join(missing)}"))
    out += [("metadata", f"must be required: {r['field']}") for r in c.get("metadata", []) if not r.get("required")]
    if missing := sorted({"behaviour", "knowledge"} - set(c.get("routing", {}))):
        out.append(("routing", f"missing layers: {', '.join(missing)}"))
    total = sum(t["count"] for t in c.get("targets", []))
    share = sum(t["count"] for t in c.get("targets", []) if t["type"] == "reasoning") / total if total else 0.0
    if share < reasoning:
        out.append(("targets", f"reasoning share {share:.1%}, at least {reasoning:.0%}"))
    return out


def plan_problems(targets: list[dict], total: int | None = None, reasoning: float = 0.75) -> list[tuple[str, str]]:
    """Rules of a list of targets (type, count): their total, if one is set, and the share of reasoning."""
    have = sum(t["count"] for t in targets)
    out = [] if total is None or have == total else [("Generation Targets", f"total {have}, expected {total}")]
    share = sum(t["count"] for t in targets if t["type"] == "reasoning") / have if have else 1.0
    return out + ([("Generation Targets", f"reasoning share {share:.1%}, at least {reasoning:.0%}")] if share < reasoning else [])


def content_problems(name: str, content: str, least: int = 100, terms: list[str] | None = None) -> list[tuple[str, str]]:
    """Rules of one section: its length, and terms that must be in it in any case."""
    out = [] if len(content) >= least else [(name, f"{len(content)} characters, at least {least}")]
    return out + [(name, f"term missing: {t}") for t in terms or [] if t.lower() not in content.lower()]


_COLLECTION = re.compile(r"[A-Za-z0-9][A-Za-z0-9_-]*")


def collection_name(name: str) -> str:
    """The name if it can name a collection; ValueError if not."""
    if not _COLLECTION.fullmatch(name or ""):
        raise ValueError(f"not a collection name: {name!r}")
    return name


# --- files and pages


def safe_pattern(pattern: str) -> bool:
    """No way up, no absolute path."""
    return bool(pattern) and ".." not in pattern.split("/") and ".." not in pattern and not pattern.startswith("/")


_LOG = logging.getLogger(__name__)


def resolve_files(folder: str | Path, patterns: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """(path, mode) of the files that match, each once, in the mode of its first pattern, sorted within a pattern; nothing outside the
    folder. ``*`` stays within one folder, ``**`` doesn't. Unsafe patterns and files are logged and passed over."""
    root = Path(folder).resolve()
    found: dict[Path, str] = {}
    for pattern, mode in patterns:
        if not safe_pattern(pattern):
            _LOG.error("unsafe pattern: %s", pattern)
            continue
        for path in sorted(root.glob(pattern)):
            if not path.is_file():
                continue
            if (real := path.resolve()).is_relative_to(root):
                found.setdefault(real, mode)
            else:
                _LOG.error("outside the folder: %s", path)
    if not found:
        raise FileNotFoundError(f"no file in {folder} matches")
    return [(str(p), m) for p, m in found.items()]


def plain_pages(content: bytes) -> list[tuple[int, int, str]]:
    """The default extractor: (page, item, text), pages parted by form feeds, items by lines."""
    out = []
    for page, text in enumerate(content.decode("utf-8", "replace").split("\f"), 1):
        out += [(page, i, line.strip()) for i, line in enumerate(text.splitlines()) if line.strip()]
    return out


def extract_pages(spark: SparkSession, path: str, extractor: Callable[[bytes], list[tuple[int, int, str]]] = plain_pages, glob: str = "*") -> tuple[DataFrame, DataFrame]:
    """(source_file, page_number, text) and (source_file, error) of the documents below ``path``.

    A document that can't be read gives an error row and no page; the others go on. The items of a page are joined in order; pages
    are the groups, so no document is in one task after the extraction."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for file, content in zip(batch["path"], batch["content"]):
                name = os.path.basename(file)
                try:
                    if not content:
                        raise ValueError("empty file")
                    out += [(name, page, item, text, None) for page, item, text in extractor(bytes(content))]
                except Exception as e:  # noqa: BLE001
                    out.append((name, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["source_file", "page_number", "item", "text", "error"]).astype({"page_number": "Int32", "item": "Int32"})

    items = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("path", "content")
    rows = items.mapInPandas(run, "source_file string, page_number int, item int, text string, error string")
    good = rows.where("error is null").groupBy("source_file", "page_number")
    pages = good.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item", "text"))), lambda x: x["text"]), "\n").alias("text"))
    # the reader leaves files of no bytes out; its own listing still has them
    listed = spark.createDataFrame([(os.path.basename(unquote(f)),) for f in items.inputFiles()], "source_file string")
    empty = listed.join(rows.select("source_file").distinct(), "source_file", "left_anti").withColumn("error", F.lit("ValueError: empty file"))
    return pages, rows.where("error is not null").select("source_file", "error").unionByName(empty)
