"""Queries of reports over examples, rejections, verdicts and events; batch and streaming windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sievework.functions import text as T
from sievework.operators import analytics as A, examples as X
from sievework.plans import base as B
from sievework.runtime import read_table

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


OUTCOMES = f"{B.EX}, {B.REJ}, o AS (SELECT run_id, target_id, true AS ok, created_at AS done_at FROM ex UNION ALL SELECT run_id, target_id, false, rejected_at FROM rej)"


def outcomes(spark: SparkSession, d: str) -> DataFrame:
    """run_id, target_id, ok, done_at: accepted and rejected targets as one relation."""
    ok = X.examples(spark, d).select("run_id", "target_id", F.lit(True).alias("ok"), F.col("created_at").alias("done_at"))
    return ok.unionByName(X.rejections(spark, d).select("run_id", "target_id", F.lit(False).alias("ok"), F.col("rejected_at").alias("done_at")))


@query(f"WITH {OUTCOMES} SELECT run_id, count(*) FILTER (WHERE ok) AS accepted, count(*) FILTER (WHERE NOT ok) AS rejected, (count(*) FILTER (WHERE ok))::double / greatest(count(*), 1) AS rate FROM o GROUP BY run_id")
def accept_rate(spark: SparkSession, d: str) -> DataFrame:
    g = outcomes(spark, d).groupBy("run_id").agg(F.count_if("ok").alias("accepted"), F.count_if(~F.col("ok")).alias("rejected"))
    return g.withColumn("rate", A.rate(F.col("accepted"), F.col("rejected")))


@query(f"WITH {B.REJ} SELECT left(reason, 80) AS reason, count(*) AS n FROM rej GROUP BY 1")
def reason_histogram(spark: SparkSession, d: str) -> DataFrame:
    return X.rejections(spark, d).groupBy(F.left(F.col("reason"), F.lit(80)).alias("reason")).agg(F.count("*").alias("n"))


@query(f"WITH {B.REJ} SELECT left(reason, 80) AS reason, count(*) AS n FROM rej GROUP BY 1 ORDER BY n DESC, reason LIMIT 3")
def top_reasons(spark: SparkSession, d: str) -> DataFrame:
    """The three most frequent reasons (a top-k report)."""
    return reason_histogram(spark, d).orderBy(F.desc("n"), "reason").limit(3)


@query(f"WITH {B.REJ} SELECT left(reason, 80) AS reason, count(*) AS n FROM rej GROUP BY 1 ORDER BY n DESC, reason LIMIT 5")
def top_five_reasons(spark: SparkSession, d: str) -> DataFrame:
    """The five most frequent reasons, as the report of rejections has them."""
    return reason_histogram(spark, d).orderBy(F.desc("n"), "reason").limit(5)


@query(f"WITH {B.REJ} SELECT category, type, grouping(category)::int AS all_categories, grouping(type)::int AS all_types, count(*) AS n FROM rej GROUP BY ROLLUP (type, category)")
def reject_rollup(spark: SparkSession, d: str) -> DataFrame:
    r = X.rejections(spark, d).rollup("type", "category")
    return r.agg(F.grouping("category").cast("int").alias("all_categories"), F.grouping("type").cast("int").alias("all_types"), F.count("*").alias("n")).select("category", "type", "all_categories", "all_types", "n")


@query(
    f"WITH {OUTCOMES} SELECT g.category, g.type, count(*) FILTER (WHERE NOT ok) AS rejected, (count(*) FILTER (WHERE NOT ok))::double / count(*) AS rate FROM o JOIN generation_targets g USING (target_id) GROUP BY g.category, g.type"
)
def reject_rate_by_category(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "generation_targets").select("target_id", "category", "type")
    # counted by target before the join: the join then has one row a target
    o = outcomes(spark, d).groupBy("target_id").agg(F.count_if(~F.col("ok")).alias("r"), F.count("*").alias("n"))
    return o.join(t, "target_id").groupBy("category", "type").agg(F.sum("r").alias("rejected"), (F.sum("r").cast("double") / F.sum("n")).alias("rate"))


@query(f"WITH {OUTCOMES}, t AS (SELECT ok, ntile(4) OVER (ORDER BY done_at, run_id, target_id, ok) AS quarter FROM o) SELECT quarter, count(*) AS n, count(*) FILTER (WHERE NOT ok) AS rejected FROM t GROUP BY quarter")
def phase_reject_rate(spark: SparkSession, d: str) -> DataFrame:
    t = A.tiles(outcomes(spark, d), ["done_at", "run_id", "target_id", "ok"], 4)
    return t.groupBy(F.col("tile").alias("quarter")).agg(F.count("*").alias("n"), F.count_if(~F.col("ok")).alias("rejected"))


@query(f"WITH {OUTCOMES} SELECT run_id, target_id // 5 AS bucket, count(*) AS n, count(*) FILTER (WHERE NOT ok) AS rejected FROM o GROUP BY 1, 2")
def bucket_reject_rate(spark: SparkSession, d: str) -> DataFrame:
    return outcomes(spark, d).groupBy("run_id", F.floor(F.col("target_id") / 5).alias("bucket")).agg(F.count("*").alias("n"), F.count_if(~F.col("ok")).alias("rejected"))


@query(f"WITH {B.MSG}, t AS (SELECT ex_id, count(*) FILTER (WHERE role = 'assistant') AS turns FROM msg GROUP BY ex_id) SELECT turns, count(*) AS examples FROM t GROUP BY turns")
def turn_histogram(spark: SparkSession, d: str) -> DataFrame:
    t = X.once(X.delivered(spark, d), "role").groupBy("ex_id").agg(F.count_if(F.col("role") == "assistant").alias("turns"))
    return t.groupBy("turns").agg(F.count("*").alias("examples"))


@query(
    f"""WITH {B.EX} SELECT 'type' AS field, coalesce(type, 'null') AS value, count(*) AS n FROM ex GROUP BY 2 UNION ALL SELECT 'text', coalesce(text, 'null'), count(*) FROM ex GROUP BY 2
UNION ALL SELECT 'topic', coalesce(topic, 'null'), count(*) FROM ex GROUP BY 2 UNION ALL SELECT 'grade_target', coalesce(grade_target::int::varchar, 'null'), count(*) FROM ex GROUP BY 2"""
)
def distribution_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    return A.distribution(X.examples(spark, d), ["type", "text", "topic", "grade_target"])


@query(f"WITH {B.EX}, g AS (SELECT layer, topic, count(*) AS n FROM ex GROUP BY 1, 2) SELECT layer, topic, n, n::double / sum(n) OVER (PARTITION BY layer) AS share FROM g")
def layer_topic_share(spark: SparkSession, d: str) -> DataFrame:
    return A.share(X.examples(spark, d), ["layer", "topic"], ["layer"])


FIELDS = ("layer", "type", "text", "topic", "grade_target", "source", "turns", "ao")


@query(f"WITH {B.EX} " + " UNION ALL ".join(f"SELECT '{f}' AS field, count({f}) AS filled, count(*) AS total FROM ex" for f in FIELDS))
def field_completeness(spark: SparkSession, d: str) -> DataFrame:
    return A.completeness(X.examples(spark, d), list(FIELDS))


VERDICT = f"""{B.REJ}, v AS (SELECT reject_id, unnest(from_json(rejection_history, '[{{"turn":"INTEGER","decision":"VARCHAR","score":"INTEGER","issues":[{{"criterion":"VARCHAR","severity":"VARCHAR","description":"VARCHAR"}}]}}]')) AS v FROM rej WHERE rejection_history IS NOT NULL AND rejection_history <> '')"""


@query(f"WITH {VERDICT}, i AS (SELECT unnest(v.issues) AS i FROM v) SELECT i.criterion AS criterion, i.severity AS severity, count(*) AS n FROM i GROUP BY 1, 2")
def criterion_frequency(spark: SparkSession, d: str) -> DataFrame:
    i = A.verdicts(X.rejections(spark, d)).select(F.explode("issues").alias("i"))
    return i.groupBy("i.criterion", "i.severity").agg(F.count("*").alias("n"))


@query(f"WITH {VERDICT} SELECT v.decision AS decision, v.score AS score, count(*) AS n FROM v GROUP BY 1, 2")
def verdict_crosstab(spark: SparkSession, d: str) -> DataFrame:
    return A.verdicts(X.rejections(spark, d)).groupBy("decision", "score").agg(F.count("*").alias("n"))


@query(
    f"""WITH {VERDICT} SELECT v.score AS score, count(*) AS verdicts, count(*) FILTER (WHERE v.score >= 3 AND len(list_filter(v.issues, lambda x: x.severity = 'blocking')) = 0) AS passing FROM v GROUP BY 1"""
)
def acceptance_predicate(spark: SparkSession, d: str) -> DataFrame:
    passing = (F.col("score") >= 3) & ~F.exists("issues", lambda i: i["severity"] == "blocking")
    return A.verdicts(X.rejections(spark, d)).groupBy("score").agg(F.count("*").alias("verdicts"), F.count_if(passing).alias("passing"))


@query(f"WITH {B.EX}, a AS (SELECT unnest(ao) AS ao FROM ex) SELECT ao, count(*) AS n FROM a GROUP BY ao")
def ao_coverage(spark: SparkSession, d: str) -> DataFrame:
    return X.examples(spark, d).select(F.explode("ao").alias("ao")).groupBy("ao").agg(F.count("*").alias("n"))


@query(
    f"""WITH {B.MSG}, {OUTCOMES}, c AS (SELECT count(*) FILTER (WHERE {" OR ".join(f"contains(content, '{t}')" for t in T.TEMPLATE_TOKENS)}) AS leaks FROM msg),
r AS (SELECT (count(*) FILTER (WHERE ok))::double / greatest(count(*), 1) AS rate FROM o), b AS (SELECT count(*) FILTER (WHERE layer = 'behaviour') AS behaviour, count(*) FILTER (WHERE topic IS NULL) AS no_topic FROM ex)
SELECT leaks, rate, behaviour, no_topic, leaks = 0 AND rate >= 0.8 AND no_topic = 0 AND behaviour >= 500 AS released FROM c, r, b"""
)
def release_gate(spark: SparkSession, d: str) -> DataFrame:
    """One row of figures and the gate over them; each part is an aggregate of one row."""
    leaks = X.once(X.delivered(spark, d), T.leaks_template(F.col("content")).alias("leak")).agg(F.count_if("leak").alias("leaks"))
    r = outcomes(spark, d).agg((F.count_if("ok").cast("double") / F.greatest(F.count("*"), F.lit(1))).alias("rate"))
    b = X.examples(spark, d).agg(F.count_if(F.col("layer") == "behaviour").alias("behaviour"), F.count_if(F.col("topic").isNull()).alias("no_topic"))
    one = leaks.unionByName(r, allowMissingColumns=True).unionByName(b, allowMissingColumns=True)
    one = one.agg(*[F.max(c).alias(c) for c in ("leaks", "rate", "behaviour", "no_topic")])  # three rows
    return one.withColumn("released", (F.col("leaks") == 0) & (F.col("rate") >= 0.8) & (F.col("no_topic") == 0) & (F.col("behaviour") >= 500))


@query(
    f"""WITH {B.MSG}, {OUTCOMES}, c AS (SELECT count(*) FILTER (WHERE {" OR ".join(f"contains(content, '{t}')" for t in T.TEMPLATE_TOKENS)}) AS leaks FROM msg),
r AS (SELECT (count(*) FILTER (WHERE ok))::double / greatest(count(*), 1) AS rate FROM o), b AS (SELECT count(*) FILTER (WHERE layer = 'behaviour') AS behaviour, count(*) FILTER (WHERE topic IS NULL) AS no_topic FROM ex),
h AS (SELECT ex_id, bool_or(coalesce(contains(content, '<think>'), false)) AS has FROM msg GROUP BY ex_id),
k AS (SELECT count(*) FILTER (WHERE type IS DISTINCT FROM 'direct') AS no_think, count(*) FILTER (WHERE type = 'direct') AS direct_no_think FROM ex LEFT JOIN h USING (ex_id) WHERE NOT coalesce(has, false)),
p AS (SELECT DISTINCT layer, category FROM generation_targets), u AS (SELECT DISTINCT g.layer AS layer, g.category AS category FROM generation_targets g JOIN ex USING (target_id)),
m AS (SELECT count(*) AS missing FROM p WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.layer IS NOT DISTINCT FROM p.layer AND u.category IS NOT DISTINCT FROM p.category)),
d AS (SELECT count(*) FILTER (WHERE type = 'direct') AS planned_direct FROM generation_targets)
SELECT leaks, rate, behaviour, no_topic, missing, no_think, direct_no_think, planned_direct,
 leaks = 0 AND rate >= 0.8 AND no_topic = 0 AND missing = 0 AND no_think = 0 AND (direct_no_think = 0 OR planned_direct > 0) AND behaviour >= 500 AS released FROM c, r, b, k, m, d"""
)
def dataset_release(spark: SparkSession, d: str) -> DataFrame:
    """The release gate with all of its conditions: also no part of the plan (layer and category) without an example, and a
    <think> block in every example; those of type direct may be without one if the plan has direct targets."""
    t = read_table(spark, d, "generation_targets")
    has = X.delivered(spark, d).groupBy("ex_id").agg(F.bool_or(F.coalesce(T.think_coverage(F.col("content")), F.lit(False))).alias("has"))
    bare = X.examples(spark, d).select("ex_id", "type").join(has, "ex_id", "left").where(~F.coalesce("has", F.lit(False)))
    direct = F.coalesce(F.col("type") == "direct", F.lit(False))
    k = bare.agg(F.count_if(~direct).alias("no_think"), F.count_if(direct).alias("direct_no_think"))
    # examples are counted by target before the join, as in the rates
    made = t.join(X.examples(spark, d).groupBy("target_id").agg(F.count("*").alias("n")), "target_id", "left").groupBy("layer", "category").agg(F.sum("n").alias("n"))
    parts = [release_gate(spark, d).drop("released"), k, made.agg(F.count_if(F.col("n").isNull()).alias("missing")), t.agg(F.count_if(F.col("type") == "direct").alias("planned_direct"))]
    one = parts[0]
    for part in parts[1:]:
        one = one.unionByName(part, allowMissingColumns=True)
    one = one.agg(*[F.max(c).alias(c) for c in ("leaks", "rate", "behaviour", "no_topic", "missing", "no_think", "direct_no_think", "planned_direct")])  # four rows
    whole = (F.col("missing") == 0) & (F.col("no_topic") == 0) & (F.col("no_think") == 0) & ((F.col("direct_no_think") == 0) | (F.col("planned_direct") > 0))
    return one.withColumn("released", (F.col("leaks") == 0) & (F.col("rate") >= 0.8) & whole & (F.col("behaviour") >= 500))


@query(
    f"""WITH {B.EX}, n AS (SELECT count(*) AS n FROM ex), a AS (SELECT topic AS value, count(*) AS c FROM ex GROUP BY topic)
SELECT t.value AS value, coalesce(a.c, 0)::double / n.n AS actual, t.share_permille / 1000.0::double AS target, round(coalesce(a.c, 0)::double / n.n - t.share_permille / 1000.0::double, 9) AS delta FROM sample_targets t CROSS JOIN n LEFT JOIN a ON a.value = t.value WHERE t.field = 'topic'"""
)
def composition_delta(spark: SparkSession, d: str) -> DataFrame:
    e = X.examples(spark, d)
    a = A.share(e, ["topic"], name="c").select(F.col("topic").alias("value"), F.col("share"))
    t = read_table(spark, d, "sample_targets").where("field = 'topic'").select("value", (F.col("share_permille").cast("double") / 1000).alias("target"))
    actual = F.coalesce("share", F.lit(0.0))
    return t.join(a, "value", "left").select("value", actual.alias("actual"), "target", F.round(actual - F.col("target"), 9).alias("delta"))


@query("SELECT count(DISTINCT category) AS categories, count(DISTINCT layer) AS layers, count(*) AS targets FROM generation_targets")
def category_count(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "generation_targets").agg(F.count_distinct("category").alias("categories"), F.count_distinct("layer").alias("layers"), F.count("*").alias("targets"))


@query(
    f"""WITH {B.EX}, t AS (SELECT run_id, min(created_at) AS a, max(created_at) AS b, count(*) AS n FROM ex GROUP BY run_id), h AS (SELECT run_id, n, greatest(date_diff('microsecond', a, b) / 3600e6, 0.01) AS h FROM t)
SELECT run_id, n, round(n / h, 6) AS per_hour, round(greatest(0, (2200 - n) / greatest(n / h, 0.1)), 6) AS hours_left FROM h"""
)
def rate_eta(spark: SparkSession, d: str) -> DataFrame:
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    t = X.examples(spark, d).groupBy("run_id").agg(F.min("created_at").alias("a"), F.max("created_at").alias("b"), F.count("*").alias("n"))
    h = F.greatest((micros(F.col("b")) - micros(F.col("a"))) / 3600e6, F.lit(0.01))
    rate = F.col("n") / h
    return t.select("run_id", "n", F.round(rate, 6).alias("per_hour"), F.round(F.greatest(F.lit(0.0), (2200 - F.col("n")) / F.greatest(rate, F.lit(0.1))), 6).alias("hours_left"))


@query("SELECT event_type, count(*) AS n, sum(try_cast(json_extract_string(props, '$.k') AS INT))::bigint AS tokens, round(sum(value), 4) AS value FROM events GROUP BY event_type")
def token_totals(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("k").alias("tokens"), F.round(F.sum("value"), 4).alias("value"))


@query(
    """WITH g AS (SELECT user_id, event_id, date_diff('microsecond', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) / 1e6 AS seconds FROM events) SELECT user_id, event_id, seconds FROM g WHERE seconds >= 36000"""
)
def stall_gaps(spark: SparkSession, d: str) -> DataFrame:
    return A.gaps(read_table(spark, d, "events"), "user_id", "ts", 36000)


@query("SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY 1, 2")
def tumbling_counts(spark: SparkSession, d: str) -> DataFrame:
    """Events by day."""
    e = read_table(spark, d, "events")
    return e.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value")).select(F.col("w.start").alias("day"), "event_type", "n", "value")


@query(
    """WITH l AS (SELECT user_id, ts, value, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 2 HOUR THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM l) SELECT user_id, min(ts) AS first_ts, count(*) AS n FROM s GROUP BY user_id, s"""
)
def session_counts(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "events")
    return e.groupBy("user_id", F.session_window("ts", "2 hours").alias("w")).agg(F.min("ts").alias("first_ts"), F.count("*").alias("n")).select("user_id", "first_ts", "n")


@query(
    f"""WITH {B.EX}, r AS (SELECT run_id, domain, model FROM runs) SELECT coalesce(r.model, 'none') AS model, round(avg(CASE WHEN type = 'reasoning' THEN 1.0 ELSE 0.0 END), 9) AS reasoning_rate, round(avg(CASE WHEN len(coalesce(ao, [])) > 0 THEN 1.0 ELSE 0.0 END), 9) AS ao_rate, count(*) AS examples FROM ex JOIN r USING (run_id) GROUP BY 1"""
)
def evaluation_metrics(spark: SparkSession, d: str) -> DataFrame:
    runs = read_table(spark, d, "runs").select("run_id", "model")
    # counted by run before the join
    per = X.examples(spark, d).groupBy("run_id").agg(F.count_if(F.col("type") == "reasoning").alias("r"), F.count_if(F.size(F.coalesce("ao", F.array())) > 0).alias("a"), F.count("*").alias("n"))
    g = per.join(runs, "run_id").groupBy(F.coalesce("model", F.lit("none")).alias("model")).agg(F.sum("r").alias("r"), F.sum("a").alias("a"), F.sum("n").alias("examples"))
    return g.select("model", F.round(F.col("r") / F.col("examples"), 9).alias("reasoning_rate"), F.round(F.col("a") / F.col("examples"), 9).alias("ao_rate"), "examples")


@query(
    """WITH c AS (SELECT chunk_id, any_value(source_file) AS f, any_value(page_number) AS p, any_value(docling_mode) AS mode, any_value(domain) AS domain, any_value(text) AS t FROM chunks GROUP BY chunk_id)
SELECT domain, mode, count(DISTINCT f) AS documents, count(*) AS chunks, count(*) FILTER (WHERE coalesce(t, '') = '') AS empty_chunks, coalesce(sum(length(t)), 0)::bigint AS chars FROM c GROUP BY domain, mode"""
)
def ingest_summary(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "chunks").dropDuplicates(["chunk_id"])
    return c.groupBy("domain", F.col("docling_mode").alias("mode")).agg(
        F.count_distinct("source_file").alias("documents"), F.count("*").alias("chunks"), F.count_if(F.coalesce("text", F.lit("")) == "").alias("empty_chunks"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")
    )


@query(
    f"""WITH {B.REJ} SELECT reject_id, target_id AS target_index, category, type, reason, coalesce(json_array_length(nullif(rejection_history, '')), 0)::int AS turns FROM rej"""
)
def rejected_records(spark: SparkSession, d: str) -> DataFrame:
    """Rejection records with the number of verdicts in their history."""
    turns = F.coalesce(F.json_array_length(F.nullif(F.col("rejection_history"), F.lit(""))), F.lit(0))
    return X.rejections(spark, d).select("reject_id", F.col("target_id").alias("target_index"), "category", "type", "reason", turns.alias("turns"))


@query(f"WITH {VERDICT}, l AS (SELECT reject_id, v.turn AS turn, v.score AS score, lag(v.score) OVER (PARTITION BY reject_id ORDER BY v.turn) AS before FROM v) SELECT CASE WHEN score > before THEN 'up' WHEN score < before THEN 'down' ELSE 'same' END AS move, count(*) AS n FROM l WHERE before IS NOT NULL GROUP BY 1")
def score_moves(spark: SparkSession, d: str) -> DataFrame:
    """How the score moves from one verdict of a target to the next."""
    v = A.verdicts(X.rejections(spark, d))
    w = Window.partitionBy("reject_id").orderBy("turn")
    m = v.withColumn("before", F.lag("score").over(w)).where("before is not null")
    return m.groupBy(F.when(F.col("score") > F.col("before"), "up").when(F.col("score") < F.col("before"), "down").otherwise("same").alias("move")).agg(F.count("*").alias("n"))
