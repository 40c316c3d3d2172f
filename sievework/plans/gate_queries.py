"""Queries of gates, cleaning, routing and deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievework.functions import json_scan, text as T
from sievework.operators import dedup, examples as X, gates, order
from sievework.plans import base as B
from sievework.runtime import cut_lineage

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


GATE = f"WITH {B.MSG}, d AS (SELECT ex_id, pos, {B.DEFECT} AS reason FROM msg), g AS (SELECT ex_id, coalesce(arg_min(reason, pos) FILTER (WHERE reason IS NOT NULL), 'ok') AS reason FROM d GROUP BY ex_id)"


@query(GATE + " SELECT ex_id, reason FROM g")
def defect_gate_rows(spark: SparkSession, d: str) -> DataFrame:
    return gates.defect_gate(X.delivered(spark, d))


@query(GATE + " SELECT reason, count(*) AS examples FROM g GROUP BY reason")
def defect_gate_summary(spark: SparkSession, d: str) -> DataFrame:
    return gates.defect_gate(X.delivered(spark, d)).groupBy("reason").agg(F.count("*").alias("examples"))


CLEAN = f"""WITH {B.MSG}, f AS (SELECT ex_id,
 coalesce(bool_or({B.strip("content")} = '...'), false) AS placeholder,
 coalesce(bool_or(role = 'assistant' AND {B.strip("regexp_replace(" + B.without_blocks("coalesce(content, '')") + ", '(?is)<think>.*', '', 'g')")} = ''), false) AS empty,
 coalesce(bool_or(role = 'assistant' AND {B.opens("content")} > {B.closes("content")}), false) AS open FROM msg GROUP BY ex_id),
a AS (SELECT ex_id, CASE WHEN placeholder THEN 'removed_degenerate' WHEN empty THEN 'removed_empty' WHEN open THEN 'repaired_think' ELSE 'unchanged' END AS action FROM f)"""


@query(CLEAN + " SELECT ex_id, action FROM a")
def clean_actions(spark: SparkSession, d: str) -> DataFrame:
    return gates.clean_action(X.delivered(spark, d))


@query(
    CLEAN
    + """ SELECT count(*) AS total, count(*) FILTER (WHERE action = 'removed_degenerate') AS removed_degenerate, count(*) FILTER (WHERE action = 'removed_empty') AS removed_empty,
 count(*) FILTER (WHERE action = 'repaired_think') AS repaired_think, count(*) FILTER (WHERE action = 'unchanged') AS unchanged, count(*) FILTER (WHERE action NOT LIKE 'removed%') AS kept FROM a"""
)
def clean_stats(spark: SparkSession, d: str) -> DataFrame:
    a, n = gates.clean_action(X.delivered(spark, d)), lambda v: F.count_if(F.col("action") == v).alias(v)
    return a.agg(F.count("*").alias("total"), n("removed_degenerate"), n("removed_empty"), n("repaired_think"), n("unchanged"), F.count_if(~F.col("action").startswith("removed")).alias("kept"))


@query(
    CLEAN
    + f" SELECT m.ex_id, m.pos, sha256(CASE WHEN role = 'assistant' AND {B.opens('content')} > {B.closes('content')} THEN content || '</think>' ELSE content END) AS digest FROM msg m JOIN a USING (ex_id) WHERE action NOT LIKE 'removed%'"
)
def cleaned_messages(spark: SparkSession, d: str) -> DataFrame:
    m = X.delivered(spark, d)
    kept = gates.clean_action(m).where("not startswith(action, 'removed')").select("ex_id")
    closed = F.when(F.col("role") == "assistant", T.append_closer(F.col("content"))).otherwise(F.col("content"))
    return X.once(m, T.digest(closed).alias("digest")).join(kept, "ex_id", "left_semi")


PAIRED = r"regexp_replace(content, '(?is)(<think>.*?)<think>', '\1</think>', 'g')"


@query(
    f"WITH {B.MSG}, n AS (SELECT ex_id, pos, content, {PAIRED} AS p FROM msg WHERE role = 'assistant' AND content IS NOT NULL), o AS (SELECT ex_id, pos, content, CASE WHEN contains(lower(content), '</think>') THEN content WHEN contains(lower(p), '<think>') AND NOT contains(lower(p), '</think>') THEN p || '</think>' ELSE p END AS fixed FROM n) SELECT ex_id, pos, sha256(fixed) AS digest, fixed <> content AS changed FROM o"
)
def normalise_think(spark: SparkSession, d: str) -> DataFrame:
    m = X.delivered(spark, d).where("role = 'assistant' and content is not null").withColumn("fixed", T.close_blocks(F.col("content")))
    return X.once(m, T.digest(F.col("fixed")).alias("digest"), (F.col("fixed") != F.col("content")).alias("changed"))


@query(
    f"""WITH {B.MSG}, {B.EX}, p AS (SELECT ex_id, bool_and(regexp_matches(content, '(?is)<think>.*?</think>')) AS closed, bool_or(regexp_matches(content, '(?i)<think>')) AS opened FROM msg WHERE role = 'assistant' GROUP BY ex_id)
SELECT ex_id, CASE WHEN type = 'reasoning' AND NOT coalesce(closed, true) THEN 'reasoning example missing <think>...</think> block' WHEN type <> 'reasoning' AND coalesce(opened, false) THEN 'direct example contains unexpected <think> block' ELSE 'ok' END AS reason FROM ex LEFT JOIN p USING (ex_id)"""
)
def think_type_gate(spark: SparkSession, d: str) -> DataFrame:
    return gates.think_gate(X.delivered(spark, d), X.examples(spark, d))


@query(
    f"""WITH {B.MSG}, k AS (SELECT ex_id, role, row_number() OVER (PARTITION BY ex_id ORDER BY pos) AS rk FROM msg)
SELECT ex_id, bool_or(rk = 1 AND coalesce(role, '') = 'system') AS system_first, coalesce(bool_and(CASE WHEN rk > 1 THEN coalesce(role = CASE WHEN rk % 2 = 0 THEN 'user' ELSE 'assistant' END, false) END), true) AS alternates, count(*) >= 2 AS long_enough FROM k GROUP BY ex_id"""
)
def message_order_gate(spark: SparkSession, d: str) -> DataFrame:
    return gates.order_gate(X.delivered(spark, d))


@query(
    f"""WITH {B.EX} SELECT ex_id, concat_ws('; ', CASE WHEN NOT coalesce(layer IN ('behaviour', 'knowledge'), false) THEN 'layer' END, CASE WHEN NOT coalesce(type IN ('reasoning', 'direct'), false) THEN 'type' END,
 CASE WHEN len(list_filter(coalesce(ao, []), lambda x: NOT coalesce(regexp_full_match(x, 'AO[1-6]'), false))) > 0 THEN 'ao' END, CASE WHEN NOT coalesce(grade_target BETWEEN 4 AND 9, true) THEN 'grade_target' END,
 CASE WHEN NOT coalesce(turns >= 1, false) THEN 'turns' END, CASE WHEN NOT coalesce(source IN ('synthetic', 'aqa_derived', 'exam_board_adapted'), false) THEN 'source' END) AS errors FROM ex"""
)
def schema_gate_errors(spark: SparkSession, d: str) -> DataFrame:
    return gates.schema_errors(X.examples(spark, d))


@query(
    f"""WITH {B.MSG}, {B.EX}, allowed AS (SELECT list(value) AS v FROM sample_targets WHERE field = 'topic'),
p AS (SELECT ex_id, arg_min(coalesce(role, ''), pos) AS first_role, count(*) AS n FROM msg GROUP BY ex_id),
a AS (SELECT ex_id, arg_max(coalesce(content, chr(0)), pos) AS c, count(*) AS answers FROM msg WHERE role = 'assistant' GROUP BY ex_id),
j AS (SELECT ex_id, layer, type, topic, coalesce(n, 0) AS n, coalesce(first_role, '') AS first_role, coalesce(answers, 0) AS answers, contains(coalesce(c, ''), '<think>') AS has FROM ex LEFT JOIN p USING (ex_id) LEFT JOIN a USING (ex_id))
SELECT ex_id, CASE WHEN n = 0 THEN 'Error: Missing required field ''messages''' WHEN first_role <> 'system' THEN 'Error: messages[0].role must be ''system'''
 WHEN NOT coalesce(layer IN ('behaviour', 'knowledge'), false) THEN 'Error: Invalid metadata.layer value ''' || coalesce(layer, 'None') || ''' (expected: behaviour, knowledge)'
 WHEN NOT coalesce(type IN ('reasoning', 'direct'), false) THEN 'Error: Invalid metadata.type value ''' || coalesce(type, 'None') || ''' (expected: reasoning, direct)'
 WHEN type = 'reasoning' AND answers > 0 AND NOT has THEN 'Error: metadata.type is ''reasoning'' but assistant content has no <think> block'
 WHEN type = 'direct' AND answers > 0 AND has THEN 'Error: metadata.type is ''direct'' but assistant content contains <think> block'
 WHEN topic IS NOT NULL AND NOT list_contains((SELECT v FROM allowed), topic) THEN 'Error: metadata.topic value ''' || topic || ''' not in valid values' END AS error FROM j"""
)
def write_gate_errors(spark: SparkSession, d: str) -> DataFrame:
    values = [r["value"] for r in X.read_table(spark, d, "sample_targets").where("field = 'topic'").collect()]  # the schema table: a few rows
    return gates.write_gate(X.delivered(spark, d), X.examples(spark, d), {"topic": values})


AO = [f"AO{i}" for i in range(1, 7)]


@query(
    f"""WITH raw2 AS (SELECT ex_id, pos, any_value(role) AS role, any_value(content) AS content FROM messages GROUP BY ex_id, pos),
m AS (SELECT ex_id, row_number() OVER (PARTITION BY ex_id ORDER BY pos) - 1 AS i, role, content FROM raw2), allowed AS (SELECT list(value) AS v FROM sample_targets WHERE field = 'topic'),
e AS (SELECT ex_id, any_value(metadata) AS md FROM examples GROUP BY ex_id),
b AS (SELECT ex_id, arg_min('Error: messages[' || i || '].role invalid value ' || coalesce('''' || role || '''', 'None') || ' (expected: system, user, assistant)', i) AS bad FROM m WHERE role IS NULL OR role NOT IN ('system', 'user', 'assistant') GROUP BY ex_id),
f AS (SELECT ex_id, arg_min(role, i) AS first_role FROM m WHERE role IS NOT NULL GROUP BY ex_id),
a AS (SELECT ex_id, arg_max(content, i) AS c FROM m WHERE role = 'assistant' AND content IS NOT NULL GROUP BY ex_id),
j AS (SELECT e.ex_id, md, bad, first_role, c, list_filter(coalesce(md.ao, []), lambda x: x IS NULL OR NOT list_contains(['AO1','AO2','AO3','AO4','AO5','AO6'], x)) AS wrong FROM e LEFT JOIN b USING (ex_id) LEFT JOIN f USING (ex_id) LEFT JOIN a USING (ex_id))
SELECT ex_id, CASE WHEN bad IS NOT NULL THEN bad WHEN first_role <> 'system' THEN 'Error: messages[0].role must be ''system'''
 WHEN NOT coalesce(md.layer IN ('behaviour', 'knowledge'), false) THEN 'Error: Invalid metadata.layer value ''' || coalesce(md.layer, 'None') || ''' (expected: behaviour, knowledge)'
 WHEN NOT coalesce(md.type IN ('reasoning', 'direct'), false) THEN 'Error: Invalid metadata.type value ''' || coalesce(md.type, 'None') || ''' (expected: reasoning, direct)'
 WHEN md.type = 'reasoning' AND c IS NOT NULL AND NOT contains(c, '<think>') THEN 'Error: metadata.type is ''reasoning'' but assistant content has no <think> block'
 WHEN md.type = 'direct' AND c IS NOT NULL AND contains(c, '<think>') THEN 'Error: metadata.type is ''direct'' but assistant content contains <think> block'
 WHEN len(wrong) > 0 THEN 'Error: metadata.ao contains invalid values: [' || array_to_string(list_transform(wrong, lambda x: '''' || coalesce(x, 'None') || ''''), ', ') || ']'
 WHEN md.topic IS NOT NULL AND NOT list_contains((SELECT v FROM allowed), md.topic) THEN 'Error: metadata.topic value ''' || md.topic || ''' not in valid values'
 WHEN md.grade_target IS NOT NULL AND md.grade_target NOT BETWEEN 4 AND 9 THEN 'Error: metadata.grade_target value ''' || md.grade_target::int || ''' not in valid values' END AS error FROM j"""
)
def document_gate_errors(spark: SparkSession, d: str) -> DataFrame:
    """The write gate over each example as one JSON document, with roles and labels as they are stored."""
    m = X.read_table(spark, d, "messages").select("ex_id", "pos", "role", "content").dropDuplicates(["ex_id", "pos"])
    parts = F.transform(F.array_sort(F.collect_list(F.struct("pos", "role", "content"))), lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    e = X.read_table(spark, d, "examples").dropDuplicates(["ex_id"]).select("ex_id", "metadata").join(m.groupBy("ex_id").agg(parts.alias("messages")), "ex_id", "left")
    line = F.to_json(F.struct("messages", "metadata"), {"ignoreNullFields": "false"})
    topics = [r["value"] for r in X.read_table(spark, d, "sample_targets").where("field = 'topic'").collect()]  # the schema table: a few rows
    return e.select("ex_id", gates.document_gate(line, {"ao": AO, "topic": topics, "grade_target": [str(g) for g in range(4, 10)]}).alias("error"))


ROUTE = f"WITH {B.EX}, r AS (SELECT ex_id, coalesce(layer, 'none') AS layer, CASE WHEN layer = 'behaviour' THEN 'train.jsonl' ELSE 'rag_index/knowledge.jsonl' END AS path FROM ex)"


def routed(spark: SparkSession, d: str) -> DataFrame:
    return X.examples(spark, d).select("ex_id", F.coalesce("layer", F.lit("none")).alias("layer"), F.when(F.col("layer") == "behaviour", "train.jsonl").otherwise("rag_index/knowledge.jsonl").alias("path"))


@query(ROUTE + " SELECT path, count(*) AS examples FROM r GROUP BY path")
def route_counts(spark: SparkSession, d: str) -> DataFrame:
    return routed(spark, d).groupBy("path").agg(F.count("*").alias("examples"))


@query(ROUTE + " SELECT ex_id, path, row_number() OVER (PARTITION BY path ORDER BY ex_id) AS n FROM r")
def route_numbering(spark: SparkSession, d: str) -> DataFrame:
    """Example numbers within each output. Two outputs hold everything, so the numbers are running sums, not windows by path."""
    r = order.running(routed(spark, d), ["ex_id"], {"a": (F.col("path") == "train.jsonl").cast("long"), "b": (F.col("path") != "train.jsonl").cast("long")})
    return r.select("ex_id", "path", F.when(F.col("path") == "train.jsonl", F.col("a")).otherwise(F.col("b")).alias("n"))


DIGEST = f"WITH {B.MSG}, h AS (SELECT ex_id, sha256(coalesce(string_agg(coalesce(content, ''), '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS digest FROM msg GROUP BY ex_id)"


@query(DIGEST + " SELECT ex_id, digest, ex_id <> min(ex_id) OVER (PARTITION BY digest) AS is_duplicate FROM h")
def dedup_keep_first(spark: SparkSession, d: str) -> DataFrame:
    return dedup.keep_first(dedup.answers_digest(X.delivered(spark, d)), "digest", "ex_id")


@query("WITH x AS (SELECT doc_id, sha256(text) AS digest FROM documents WHERE text IS NOT NULL) SELECT count(*) AS documents, count(DISTINCT digest) AS texts, count(*) - count(DISTINCT digest) AS duplicates FROM x")
def dedup_stats(spark: SparkSession, d: str) -> DataFrame:
    h = X.read_table(spark, d, "documents").where("text is not null").groupBy(T.digest(F.col("text")).alias("digest")).agg(F.count("*").alias("n"))
    return h.agg(F.sum("n").alias("documents"), F.count("*").alias("texts"), (F.sum("n") - F.count("*")).alias("duplicates"))


RATIO = f"""WITH {B.EX}, w AS (SELECT ex_id, type, count(*) OVER o AS n, sum(CASE WHEN type = 'reasoning' THEN 1 ELSE 0 END) OVER o AS nr FROM ex WINDOW o AS (ORDER BY ex_id ROWS UNBOUNDED PRECEDING)),
s AS (SELECT ex_id, n, round(nr::double / n, 9) AS ratio, NOT (abs(nr::double / n - 0.75) < 0.05) AS drifted FROM w)"""


@query(RATIO + " SELECT ex_id, n, ratio, drifted FROM s")
def running_split_ratio(spark: SparkSession, d: str) -> DataFrame:
    r = order.split_ratio(X.examples(spark, d).select("ex_id", "type"), ["ex_id"], F.col("type") == "reasoning")
    return r.select("ex_id", "n", F.round("ratio", 9).alias("ratio"), "drifted")


@query(RATIO + " SELECT count(*) FILTER (WHERE drifted) AS warned, count(*) AS examples, min(ratio) AS least, max(ratio) AS most FROM s")
def split_warning(spark: SparkSession, d: str) -> DataFrame:
    r = running_split_ratio(spark, d)
    return r.agg(F.count_if("drifted").alias("warned"), F.count("*").alias("examples"), F.min("ratio").alias("least"), F.max("ratio").alias("most"))


VALIDATED = (
    DIGEST
    + f""", {B.EX}, p AS (SELECT ex_id, bool_and(regexp_matches(content, '(?is)<think>.*?</think>')) AS closed, bool_or(regexp_matches(content, '(?i)<think>')) AS opened FROM msg WHERE role = 'assistant' GROUP BY ex_id),
v AS (SELECT ex_id, type, layer, digest, CASE WHEN type = 'reasoning' AND NOT coalesce(closed, true) THEN 'think' WHEN type <> 'reasoning' AND coalesce(opened, false) THEN 'think' END AS t FROM ex JOIN h USING (ex_id) LEFT JOIN p USING (ex_id)),
k AS (SELECT ex_id, min(ex_id) OVER (PARTITION BY digest) AS f FROM v WHERE t IS NULL),
s AS (SELECT v.ex_id, v.type, v.layer, CASE WHEN t IS NOT NULL THEN 'think block' WHEN k.f <> v.ex_id THEN 'duplicate content detected' ELSE 'accepted' END AS outcome FROM v LEFT JOIN k USING (ex_id))"""
)


def validated(spark: SparkSession, d: str) -> DataFrame:
    """ex_id, type, layer, outcome: block gate, then duplicates among what passed."""
    m, e = X.delivered(spark, d), X.examples(spark, d)
    g = gates.think_gate(m, e).join(dedup.answers_digest(m), "ex_id").join(e.select("ex_id", "type", "layer"), "ex_id")
    passed = dedup.keep_first(g.where("reason = 'ok'").select("ex_id", "digest"), "digest", "ex_id").select("ex_id", "is_duplicate")
    outcome = F.when(F.col("reason") != "ok", "think block").when(F.col("is_duplicate"), "duplicate content detected").otherwise("accepted")
    return g.join(passed, "ex_id", "left").select("ex_id", "type", "layer", outcome.alias("outcome"))


@query(
    VALIDATED
    + """
SELECT outcome, coalesce(layer, 'none') AS layer, count(*) AS examples, sum(CASE WHEN type = 'reasoning' THEN 1 ELSE 0 END) AS reasoning FROM s GROUP BY 1, 2"""
)
def validation_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """The outcomes of validation, counted by layer."""
    s = validated(spark, d)
    return s.groupBy("outcome", F.coalesce("layer", F.lit("none")).alias("layer")).agg(F.count("*").alias("examples"), F.sum((F.col("type") == "reasoning").cast("int")).alias("reasoning"))


TRACKED = (
    VALIDATED
    + """, w AS (SELECT ex_id, count(*) OVER o AS n, sum(CASE WHEN type = 'reasoning' THEN 1 ELSE 0 END) OVER o AS nr FROM s WHERE outcome = 'accepted' WINDOW o AS (ORDER BY ex_id ROWS UNBOUNDED PRECEDING)),
q AS (SELECT ex_id, n, round(nr::double / n, 9) AS ratio, NOT (abs(nr::double / n - 0.75) < 0.05) AS drifted FROM w)"""
)


def tracked(s: DataFrame) -> DataFrame:
    """ex_id, n, ratio, drifted: the running ratio over the accepted rows of ``s`` alone."""
    r = order.split_ratio(s.where("outcome = 'accepted'").select("ex_id", "type"), ["ex_id"], F.coalesce(F.col("type") == "reasoning", F.lit(False)))
    return r.select("ex_id", "n", F.round("ratio", 9).alias("ratio"), "drifted")


@query(
    TRACKED
    + """
SELECT s.ex_id AS ex_id, outcome, n, ratio, drifted, CASE WHEN outcome <> 'accepted' THEN NULL WHEN layer = 'behaviour' THEN 'train.jsonl' ELSE 'rag_index/knowledge.jsonl' END AS path FROM s LEFT JOIN q USING (ex_id)"""
)
def validation_results(spark: SparkSession, d: str) -> DataFrame:
    """The ordered pipeline of validation by example: block gate, duplicates among what passed, the running ratio of what was accepted, routing."""
    s = cut_lineage(validated(spark, d))
    path = F.when(F.col("outcome") == "accepted", F.when(F.col("layer") == "behaviour", "train.jsonl").otherwise("rag_index/knowledge.jsonl"))
    return s.join(tracked(s), "ex_id", "left").select("ex_id", "outcome", "n", "ratio", "drifted", path.alias("path"))


@query(TRACKED + " SELECT count(*) FILTER (WHERE drifted) AS warned, count(*) AS examples, min(ratio) AS least, max(ratio) AS most FROM q")
def accepted_split_warning(spark: SparkSession, d: str) -> DataFrame:
    """How often the running ratio of the accepted examples warns."""
    return tracked(validated(spark, d)).agg(F.count_if("drifted").alias("warned"), F.count("*").alias("examples"), F.min("ratio").alias("least"), F.max("ratio").alias("most"))


@query(
    f"WITH {B.MSG}, {B.EX}, c AS (SELECT ex_id, count(*) FILTER (WHERE role = 'user') AS counted FROM msg GROUP BY ex_id) SELECT ex_id, turns, counted FROM ex JOIN c USING (ex_id) WHERE turns IS DISTINCT FROM counted"
)
def turn_count_mismatch(spark: SparkSession, d: str) -> DataFrame:
    return gates.turn_mismatch(X.delivered(spark, d), X.examples(spark, d))


@query(f"WITH {B.MSG} SELECT ex_id, count(*) FILTER (WHERE coalesce(content, '') <> '') AS kept, count(*) FILTER (WHERE coalesce(content, '') = '') AS dropped FROM msg GROUP BY ex_id")
def loader_normalise(spark: SparkSession, d: str) -> DataFrame:
    return gates.loader_rows(X.delivered(spark, d))


@query(f"WITH {B.MSG} SELECT coalesce(role, 'none') AS role, count(*) AS messages, count(*) FILTER (WHERE " + " OR ".join(f"contains(content, '{t}')" for t in T.TEMPLATE_TOKENS) + ") AS leaks FROM msg GROUP BY 1")
def template_leak(spark: SparkSession, d: str) -> DataFrame:
    m = X.once(X.delivered(spark, d), "role", T.leaks_template(F.col("content")).alias("leak"))
    return m.groupBy(F.coalesce("role", F.lit("none")).alias("role")).agg(F.count("*").alias("messages"), F.count_if("leak").alias("leaks"))


@query(
    f"WITH {B.MSG}, {B.EX}, c AS (SELECT ex_id, bool_or(coalesce(contains(content, '<think>'), false)) AS t FROM msg GROUP BY ex_id) SELECT type, count(*) AS examples, count(*) FILTER (WHERE t) AS with_block FROM ex JOIN c USING (ex_id) GROUP BY type"
)
def think_coverage(spark: SparkSession, d: str) -> DataFrame:
    c = X.delivered(spark, d).groupBy("ex_id").agg(F.bool_or(F.coalesce(T.think_coverage(F.col("content")), F.lit(False))).alias("t"))
    return X.examples(spark, d).select("ex_id", "type").join(c, "ex_id").groupBy("type").agg(F.count("*").alias("examples"), F.count_if("t").alias("with_block"))


@query(
    f"WITH {B.MSG}, l AS (SELECT ex_id, arg_max(sha256(coalesce(content, '')), pos) AS digest, max(pos) AS pos FROM msg WHERE role = 'assistant' GROUP BY ex_id) SELECT ex_id, pos, digest FROM l"
)
def last_answer(spark: SparkSession, d: str) -> DataFrame:
    m = X.delivered(spark, d).where("role = 'assistant'")
    return m.groupBy("ex_id").agg(F.max("pos").alias("pos"), F.max_by(T.digest(F.coalesce("content", F.lit(""))), F.col("pos")).alias("digest"))


@query()
def first_json_object(spark: SparkSession, d: str) -> DataFrame:
    """The first JSON object of each document's text, and whether the text as a whole is JSON."""
    t = X.read_table(spark, d, "documents").where("text like '%{%'")
    return t.select("doc_id", json_scan.first_object_in(F.col("text")).alias("object"), json_scan.strict_json(F.col("text")).alias("whole")).where("object is not null")




@query(
    f"WITH {B.MSG} SELECT ex_id, count(*) AS messages, sha256(string_agg('<' || coalesce(role, 'null') || '>' || chr(10) || coalesce(content, '') || '</' || coalesce(role, 'null') || '>' || chr(10), '' ORDER BY pos)) AS digest FROM msg GROUP BY ex_id"
)
def chat_render(spark: SparkSession, d: str) -> DataFrame:
    """Each conversation rendered with marks of the roles."""
    n = X.nested(X.delivered(spark, d))
    return n.select("ex_id", F.size("messages").cast("long").alias("messages"), T.digest(T.render_chat(F.col("messages"))).alias("digest"))


@query(f"WITH {B.REJ} SELECT reject_id, target_id, category FROM rej WHERE reason = 'refusal'")
def refused_targets(spark: SparkSession, d: str) -> DataFrame:
    return X.rejections(spark, d).where("reason = 'refusal'").select("reject_id", "target_id", "category")


@query(f"WITH {B.MSG}, {B.EX} SELECT ex.ex_id, ex.type FROM ex WHERE NOT EXISTS (SELECT 1 FROM msg WHERE msg.ex_id = ex.ex_id AND msg.role = 'system')")
def missing_system(spark: SparkSession, d: str) -> DataFrame:
    """Examples without a system message."""
    has = X.delivered(spark, d).where("role = 'system'").select("ex_id").distinct()
    return X.examples(spark, d).select("ex_id", "type").join(has, "ex_id", "left_anti")


@query(f"WITH {B.MSG}, s AS (SELECT role, content, count(*) AS n FROM msg WHERE content IS NOT NULL GROUP BY role, content HAVING count(*) > 1) SELECT coalesce(role, 'none') AS role, count(*) AS texts, sum(n)::bigint AS messages FROM s GROUP BY 1")
def repeated_messages(spark: SparkSession, d: str) -> DataFrame:
    """Texts that several messages of a role have."""
    m = X.once(X.delivered(spark, d).where("content is not null"), "role", T.digest(F.col("content")).alias("h"))
    g = m.groupBy("role", "h").agg(F.count("*").alias("n")).where("n > 1")
    return g.groupBy(F.coalesce("role", F.lit("none")).alias("role")).agg(F.count("*").alias("texts"), F.sum("n").alias("messages"))
