"""Text functions as Column builders; all of them stay in whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: The tags of a reasoning block and the placeholder of a missing answer. Fixed values.
OPEN, CLOSE, PLACEHOLDER = "<think>", "</think>", "..."
#: Control tokens of chat templates that must not be in stored text. Fixed values.
TEMPLATE_TOKENS = ("<|im_start|>", "<|im_end|>", "<start_of_turn>", "<end_of_turn>")


def strip(text: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def opens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?i)<think>"))


def closes(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?i)</think>"))


def without_blocks(text: Column) -> Column:
    """Without closed reasoning blocks."""
    return F.regexp_replace(text, r"(?is)<think>.*?</think>", "")


def visible(text: Column) -> Column:
    """Without closed reasoning blocks and without one that is open to the end."""
    return F.regexp_replace(without_blocks(text), r"(?is)<think>.*", "")


def close_blocks(text: Column) -> Column:
    """A second opener that stands for a closer becomes one; an opener without any closer is closed at the end.

    Text that has a closer anywhere is left alone."""
    paired = F.regexp_replace(text, r"(?is)(<think>.*?)<think>", "$1</think>")
    ended = F.when(F.lower(paired).contains(OPEN) & ~F.lower(paired).contains(CLOSE), F.concat(paired, F.lit(CLOSE))).otherwise(paired)
    return F.when(F.lower(text).contains(CLOSE), text).otherwise(ended)


def append_closer(text: Column) -> Column:
    """One closer at the end where there are more openers than closers."""
    return F.when(opens(text) > closes(text), F.concat(text, F.lit(CLOSE))).otherwise(text)


def is_placeholder(text: Column) -> Column:
    return strip(text) == PLACEHOLDER


def leaks_template(text: Column) -> Column:
    out = F.lit(False)
    for token in TEMPLATE_TOKENS:
        out = out | text.contains(token)
    return out


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def hash_bucket(key: Column, buckets: int = 100) -> Column:
    """A bucket from the first 8 hexadecimal digits of SHA-256, alike in every engine."""
    return F.pmod(F.conv(F.substring(F.sha2(key.cast("string"), 256), 1, 8), 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def chunk_id(domain: Column, file: Column, page: Column, index: Column) -> Column:
    return F.concat(domain, F.lit("_"), file, F.lit("_p"), page.cast("string"), F.lit("_c"), index.cast("string"))


def drop_comment_lines(text: Column) -> Column:
    """Without lines that begin an HTML comment or end one."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~(F.ltrim(x).startswith("<!--") | F.rtrim(x).endswith("-->"))), "\n")


def weight_of(cell: Column) -> Column:
    """25% as 0.25; a plain number as it is."""
    c = strip(cell)
    return F.when(c.endswith("%"), strip(F.regexp_replace(c, "%$", "")).cast("double") / 100).otherwise(c.cast("double"))


def flag_of(cell: Column) -> Column:
    """yes, y, true, 1 and no, n, false, 0 in any case; null for anything else."""
    c = F.lower(strip(cell))
    return F.when(c.isin("yes", "y", "true", "1"), F.lit(True)).when(c.isin("no", "n", "false", "0"), F.lit(False))


def grades_of(cell: Column) -> Column:
    """[5, 6, null] as an array of int; a blank cell as [7]."""
    parts = F.filter(F.transform(F.split(F.regexp_replace(strip(cell), r"^\[+|\]+$", ""), ","), strip), lambda x: x != "")
    values = F.transform(parts, lambda x: F.when(F.lower(x) == "null", F.lit(None).cast("int")).otherwise(x.cast("int")))
    return F.when(F.size(parts) < 1, F.array(F.lit(7))).otherwise(values)


def values_of(cell: Column) -> Column:
    """A comma list as an array; a range like 1+ or a blank cell as an empty one."""
    none = F.array().cast("array<string>")
    listed = F.filter(F.transform(F.split(cell, ","), strip), lambda x: x != "")
    return F.when((strip(cell) == "") | strip(cell).rlike(r"^\d+\+"), none).otherwise(listed)


def think_coverage(text: Column) -> Column:
    return text.contains(OPEN)


def backoff_seconds(attempt: Column, base: float = 2.0) -> Column:
    """Seconds to wait before a retry."""
    return F.pow(F.lit(base), attempt)


def feedback(assessment: Column, issues: Column) -> Column:
    """The assessment and, if there are issues (struct with severity, criterion, description, suggestion), a line for each under a heading."""
    lines = F.transform(issues, lambda i: F.concat(F.lit("- ["), i["severity"], F.lit("] "), i["criterion"], F.lit(": "), i["description"], F.lit(" (suggestion: "), F.coalesce(i["suggestion"], F.lit("")), F.lit(")")))
    return F.when(F.size(issues) > 0, F.concat(assessment, F.lit("\n\nIssues:\n"), F.array_join(lines, "\n"))).otherwise(assessment)


def generator_message(category: Column, kind: Column, layer: Column, grade: Column, context: Column, feedback_: Column) -> Column:
    """What the generator is asked: the target, the retrieved context if there is one, and what was wrong with the last reply."""
    head = fill("Generate a training example for:\n  Category: {category}\n  Type: {kind}\n  Layer: {layer}\n  Grade Target: {grade}\n", category=category, kind=kind, layer=layer, grade=F.coalesce(grade.cast("string"), F.lit("null (grade-agnostic)")))
    has = lambda c: F.coalesce(c, F.lit("")) != ""
    label = F.when(feedback_.startswith("FORMAT ERROR:"), "Format Error").otherwise("Coach Feedback")
    return F.concat(
        head,
        F.when(has(context), F.concat(F.lit("\n--- Curriculum Context (use this to ground your example) ---\n"), context, F.lit("\n--- End Curriculum Context ---\n"))).otherwise(""),
        F.when(has(feedback_), F.concat(F.lit("\n--- "), label, F.lit(" (revise based on this) ---\n"), feedback_, F.lit("\n--- End Feedback ---\n"))).otherwise(""),
    )


def first_text(*columns: Column) -> Column:
    """The first of the texts that isn't blank; null if none is."""
    return F.coalesce(*[F.when(strip(c) != "", c) for c in columns])


def fill(template: str, **columns: Column) -> Column:
    """``template`` with {name} replaced by columns, null as "null"."""
    import re

    parts, last = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        parts += [F.lit(template[last : m.start()]), F.coalesce(columns[m[1]].cast("string"), F.lit("null"))]
        last = m.end()
    return F.concat(*parts, F.lit(template[last:]))


def render_chat(messages: Column, begin: str = "<{role}>\n", end: str = "</{role}>\n") -> Column:
    """A conversation (array of role, content) as one string, each message between marks of its role."""
    mark = lambda m, t: fill(t, role=m["role"])
    return F.array_join(F.transform(messages, lambda m: F.concat(mark(m, begin), F.coalesce(m["content"], F.lit("")), mark(m, end))), "")
