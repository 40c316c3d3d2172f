"""Row gates: what makes an example unfit, as predicates and ordered reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sievework.functions import text as T
from sievework.operators.examples import once

LAYERS = ("behaviour", "knowledge")
TYPES = ("reasoning", "direct")
SOURCES = ("synthetic", "aqa_derived", "exam_board_adapted")


def defect_of(role: Column, content: Column) -> Column:
    """The first defect of one message, or null: nothing visible, a placeholder, blocks that don't match."""
    answer = role == "assistant"
    o, c = T.opens(content), T.closes(content)
    return (
        F.when(content.isNull(), F.lit(None).cast("string"))
        .when(answer & (T.strip(T.without_blocks(content)) == ""), F.lit("validation_failed: empty_assistant"))
        .when(T.is_placeholder(content), F.concat(F.lit("validation_failed: degenerate_placeholder ("), role, F.lit(")")))
        .when(answer & (o != c), F.concat(F.lit("validation_failed: unclosed_think_block (opens="), o.cast("string"), F.lit(", closes="), c.cast("string"), F.lit(")")))
    )


def defect_gate(messages: DataFrame) -> DataFrame:
    """ex_id, reason: the defect of the first message that has one, else "ok". One aggregate with a partial step, which repeats don't change."""
    marked = messages.select("ex_id", "pos", defect_of(F.col("role"), F.col("content")).alias("reason"))
    first = F.min(F.when(F.col("reason").isNotNull(), F.struct("pos", "reason")))["reason"]
    return marked.groupBy("ex_id").agg(F.coalesce(first, F.lit("ok")).alias("reason"))


def think_gate(messages: DataFrame, examples: DataFrame) -> DataFrame:
    """ex_id, reason: each answer of a reasoning example has a closed block, none of a direct one has an opener."""
    m = messages.where("role = 'assistant'").select("ex_id", F.col("content").rlike(r"(?is)<think>.*?</think>").alias("closed"), F.col("content").rlike(r"(?i)<think>").alias("opened"))
    per = m.groupBy("ex_id").agg(F.coalesce(F.bool_and("closed"), F.lit(True)).alias("closed"), F.coalesce(F.bool_or("opened"), F.lit(False)).alias("opened"))
    joined = examples.select("ex_id", "type").join(per, "ex_id", "left")
    reason = F.when((F.col("type") == "reasoning") & ~F.coalesce("closed", F.lit(True)), F.lit("reasoning example missing <think>...</think> block")).when(
        (F.col("type") != "reasoning") & F.coalesce("opened", F.lit(False)), F.lit("direct example contains unexpected <think> block")
    )
    return joined.select("ex_id", F.coalesce(reason, F.lit("ok")).alias("reason"))


def order_gate(messages: DataFrame) -> DataFrame:
    """ex_id, system_first, alternates, long_enough; the place of a message is its rank, so gaps in pos don't matter."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("ex_id").orderBy("pos"))
    m = once(messages, "role").withColumn("rank", rank)
    fits = F.when(F.col("rank") == 1, F.col("role") == "system").otherwise(F.col("role") == F.when(F.col("rank") % 2 == 0, "user").otherwise("assistant"))
    return m.groupBy("ex_id").agg(
        F.bool_or((F.col("rank") == 1) & (F.coalesce("role", F.lit("")) == "system")).alias("system_first"),
        F.coalesce(F.bool_and(F.when(F.col("rank") > 1, F.coalesce(fits, F.lit(False)))), F.lit(True)).alias("alternates"),
        (F.count("*") >= 2).alias("long_enough"),
    )


def schema_errors(examples: DataFrame) -> DataFrame:
    """ex_id, errors: all rules of the metadata that fail, in fixed order, joined by "; "."""
    checks = [
        F.when(~F.coalesce(F.col("layer").isin(*LAYERS), F.lit(False)), "layer"),
        F.when(~F.coalesce(F.col("type").isin(*TYPES), F.lit(False)), "type"),
        F.when(F.exists(F.coalesce("ao", F.array().cast("array<string>")), lambda x: ~F.coalesce(x.rlike(r"^AO[1-6]\n?\z"), F.lit(False))), "ao"),
        F.when(~F.coalesce(F.col("grade_target").between(4, 9), F.lit(True)), "grade_target"),
        F.when(~F.coalesce(F.col("turns") >= 1, F.lit(False)), "turns"),
        F.when(~F.coalesce(F.col("source").isin(*SOURCES), F.lit(False)), "source"),
    ]
    return examples.select("ex_id", F.concat_ws("; ", *checks).alias("errors"))


def write_gate(messages: DataFrame, examples: DataFrame, allowed: dict[str, list[str]]) -> DataFrame:
    """ex_id, error: the first failing check before an example is written, or null.

    Order: no messages, first message isn't the system's, layer, type, the last answer's block against the type, values
    outside ``allowed`` (field -> values)."""
    answer = F.col("role") == "assistant"
    per = messages.groupBy("ex_id").agg(
        F.min_by("role", "pos").alias("first_role"), F.count("*").alias("n"), F.count_if(answer).alias("answers"),
        F.max_by(F.coalesce(T.close_blocks(F.col("content")).contains("<think>"), F.lit(False)), F.when(answer, F.col("pos"))).alias("last_has"),
    )
    e = examples.join(per, "ex_id", "left")
    has = F.coalesce("last_has", F.lit(False))
    steps = [
        F.when(F.coalesce("n", F.lit(0)) == 0, F.lit("Error: Missing required field 'messages'")),
        F.when(F.coalesce("first_role", F.lit("")) != "system", F.lit("Error: messages[0].role must be 'system'")),
        F.when(~F.coalesce(F.col("layer").isin(*LAYERS), F.lit(False)), F.concat(F.lit("Error: Invalid metadata.layer value '"), F.coalesce("layer", F.lit("None")), F.lit("' (expected: behaviour, knowledge)"))),
        F.when(~F.coalesce(F.col("type").isin(*TYPES), F.lit(False)), F.concat(F.lit("Error: Invalid metadata.type value '"), F.coalesce("type", F.lit("None")), F.lit("' (expected: reasoning, direct)"))),
        F.when((F.col("type") == "reasoning") & (F.col("answers") > 0) & ~has, F.lit("Error: metadata.type is 'reasoning' but assistant content has no <think> block")),
        F.when((F.col("type") == "direct") & (F.col("answers") > 0) & has, F.lit("Error: metadata.type is 'direct' but assistant content contains <think> block")),
    ]
    for field, values in allowed.items():
        v = F.col(field).cast("string")
        steps.append(F.when(v.isNotNull() & ~v.isin(*values), F.concat(F.lit(f"Error: metadata.{field} value '"), v, F.lit("' not in valid values"))))
    return e.select("ex_id", F.coalesce(*steps).alias("error"))


def _listed(values: Column) -> Column:
    """An array of texts as a bracketed list of quoted ones."""
    return F.concat(F.lit("["), F.array_join(F.transform(values, lambda v: F.concat(F.lit("'"), v, F.lit("'"))), ", "), F.lit("]"))


def document_gate(line: Column, allowed: dict[str, list[str]]) -> Column:
    """The first failing check of an example as a JSON document, or null: JSON, messages, each message's keys and role, the system's
    first, metadata, layer, type, the last answer's block against the type, and values outside ``allowed`` (field -> values), element by
    element where the value is a list. Built-in functions only."""
    get = F.get_json_object
    messages, metadata = get(line, "$.messages"), get(line, "$.metadata")
    each = F.from_json(messages, "array<string>")
    names = F.array(F.lit("content"), F.lit("role"))
    empty = F.array().cast("array<string>")

    def of_message(m: Column, i: Column) -> Column:
        at = F.concat(F.lit("Error: messages["), i.cast("string"), F.lit("]"))
        keys = F.coalesce(F.json_object_keys(m), empty)
        unexpected, missing, role = F.array_sort(F.array_except(keys, names)), F.array_except(names, keys), get(m, "$.role")
        return (
            F.when(~F.coalesce(m.startswith("{"), F.lit(False)), F.concat(at, F.lit(" is not an object")))
            .when((F.size(unexpected) > 0) | (F.size(missing) > 0), F.concat(at, F.lit(" has invalid keys (unexpected="), _listed(unexpected), F.lit(", missing="), _listed(missing), F.lit(")")))
            .when(~F.coalesce(role.isin("system", "user", "assistant"), F.lit(False)), F.concat(at, F.lit(".role invalid value "), F.coalesce(F.concat(F.lit("'"), role, F.lit("'")), F.lit("None")), F.lit(" (expected: system, user, assistant)")))
        )

    first = F.get(F.filter(F.transform(each, of_message), lambda e: e.isNotNull()), F.lit(0))
    answers = F.filter(each, lambda m: (get(m, "$.role") == "assistant") & get(m, "$.content").isNotNull())
    last = T.close_blocks(get(F.element_at(answers, -1), "$.content"))
    layer, kind = get(line, "$.metadata.layer"), get(line, "$.metadata.type")
    has = F.coalesce(last.contains("<think>"), F.lit(False))
    any_answer = F.size(answers) > 0
    steps = [
        F.when(~F.coalesce(F.is_valid_utf8(line) & get(line, "$").isNotNull(), F.lit(False)), F.lit("Error: Invalid JSON")),
        F.when(~F.coalesce(messages.startswith("["), F.lit(False)) | (F.coalesce(F.size(each), F.lit(0)) < 1), F.lit("Error: Missing required field 'messages'")),
        first,
        F.when(get(F.get(each, F.lit(0)), "$.role") != "system", F.lit("Error: messages[0].role must be 'system'")),
        F.when(~F.coalesce(metadata.startswith("{"), F.lit(False)), F.lit("Error: Missing required field 'metadata'")),
        F.when(~F.coalesce(layer.isin(*LAYERS), F.lit(False)), F.concat(F.lit("Error: Invalid metadata.layer value '"), F.coalesce(layer, F.lit("None")), F.lit("' (expected: behaviour, knowledge)"))),
        F.when(~F.coalesce(kind.isin(*TYPES), F.lit(False)), F.concat(F.lit("Error: Invalid metadata.type value '"), F.coalesce(kind, F.lit("None")), F.lit("' (expected: reasoning, direct)"))),
        F.when((kind == "reasoning") & any_answer & ~has, F.lit("Error: metadata.type is 'reasoning' but assistant content has no <think> block")),
        F.when((kind == "direct") & any_answer & has, F.lit("Error: metadata.type is 'direct' but assistant content contains <think> block")),
    ]
    for field, values in allowed.items():
        value = get(line, f"$.metadata.{field}")
        wrong = F.filter(F.from_json(value, "array<string>"), lambda v: ~F.coalesce(v.isin(*values), F.lit(False)))
        listed = F.coalesce(value.startswith("["), F.lit(False))
        steps.append(F.when(listed & (F.size(wrong) > 0), F.concat(F.lit(f"Error: metadata.{field} contains invalid values: "), _listed(F.transform(wrong, lambda v: F.coalesce(v, F.lit("None")))))))
        steps.append(F.when(~listed & value.isNotNull() & ~value.isin(*values), F.concat(F.lit(f"Error: metadata.{field} value '"), value, F.lit("' not in valid values"))))
    return F.coalesce(*steps)


def accepted(verdict: Column) -> Column:
    """Acceptance of a verdict (struct of decision, score, layer_correct, type_correct, issues)."""
    return (verdict["decision"] == "accept") & (verdict["score"] >= 3) & verdict["layer_correct"] & verdict["type_correct"] & ~F.exists(verdict["issues"], lambda i: i["severity"] == "blocking")


def turn_mismatch(messages: DataFrame, examples: DataFrame) -> DataFrame:
    """ex_id, turns, counted: examples whose turns are not the user messages that an answer follows."""
    counted = once(messages, "role").groupBy("ex_id").agg(F.count_if(F.col("role") == "user").alias("counted"))
    return examples.select("ex_id", "turns").join(counted, "ex_id").where("turns is distinct from counted")


def clean_action(messages: DataFrame) -> DataFrame:
    """ex_id, action: placeholder, then empty, then repaired, then unchanged; they exclude each other in this order."""
    c, answer = F.col("content"), F.col("role") == "assistant"
    flags = messages.groupBy("ex_id").agg(
        F.coalesce(F.bool_or(T.is_placeholder(c)), F.lit(False)).alias("placeholder"),
        F.coalesce(F.bool_or(answer & (T.strip(T.visible(F.coalesce(c, F.lit("")))) == "")), F.lit(False)).alias("empty"),
        F.coalesce(F.bool_or(answer & (T.opens(c) > T.closes(c))), F.lit(False)).alias("open"),
    )
    action = F.when(F.col("placeholder"), "removed_degenerate").when(F.col("empty"), "removed_empty").when(F.col("open"), "repaired_think").otherwise("unchanged")
    return flags.select("ex_id", action.alias("action"))


def cleaned(messages: DataFrame) -> DataFrame:
    """The messages of the examples that stay, blocks closed."""
    kept = clean_action(messages).where("not startswith(action, 'removed')").select("ex_id")
    closed = F.when(F.col("role") == "assistant", T.append_closer(F.col("content"))).otherwise(F.col("content"))
    return messages.join(kept, "ex_id", "left_semi").withColumn("content", closed)


def loader_rows(messages: DataFrame) -> DataFrame:
    """What a trainer reads: roles by their aliases, empty messages dropped, a record kept even if all of its messages are."""
    keep = F.col("filled")
    return once(messages, (F.coalesce("content", F.lit("")) != "").alias("filled")).groupBy("ex_id").agg(F.count_if(keep).alias("kept"), F.count_if(~keep).alias("dropped"))
