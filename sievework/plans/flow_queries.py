"""Queries of targets, chunking, retrieval, joins, set operations, sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sievework.functions import chunking, text as T
from sievework.operators import examples as X, order, overlap, retrieve, rounds, targets
from sievework.plans import base as B
from sievework.runtime import read_table, scratch_path
from sievework.sources import sinks

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


EXPAND = """t AS (SELECT target_id, target_count, grade_targets, coalesce(sum(target_count) OVER (ORDER BY target_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS first FROM generation_targets),
x AS (SELECT target_id, first, grade_targets, unnest(range(1, target_count + 1)) AS k FROM t),
e AS (SELECT (first + k - 1)::bigint AS idx, target_id, k, grade_targets[((first + k - 1) % len(grade_targets) + 1)::bigint] AS grade FROM x)"""


@query(f"WITH {EXPAND} SELECT idx, target_id, k, grade FROM e")
def target_expand(spark: SparkSession, d: str) -> DataFrame:
    return targets.expand(read_table(spark, d, "generation_targets"))


@query(f"WITH {EXPAND} SELECT target_id, coalesce(grade::varchar, 'null') AS grade, count(*) AS n FROM e GROUP BY 1, 2")
def grade_round_robin(spark: SparkSession, d: str) -> DataFrame:
    return target_expand(spark, d).groupBy("target_id", F.coalesce(F.col("grade").cast("string"), F.lit("null")).alias("grade")).agg(F.count("*").alias("n"))


@query("SELECT type, count(*) AS targets, sum(target_count)::bigint AS total, sum(target_count)::double / (SELECT sum(target_count) FROM generation_targets) AS share FROM generation_targets GROUP BY type")
def target_shares(spark: SparkSession, d: str) -> DataFrame:
    return targets.shares(read_table(spark, d, "generation_targets"))


@query(
    f"WITH {EXPAND}, {B.EX}, c AS (SELECT target_id, count(*) AS n FROM ex GROUP BY target_id), done AS (SELECT idx FROM e JOIN c USING (target_id) WHERE k <= n) SELECT idx, target_id FROM e ANTI JOIN done USING (idx)"
)
def resume_anti_join(spark: SparkSession, d: str) -> DataFrame:
    """Expanded targets that are still open: of each target, as many are done as it has examples."""
    e = target_expand(spark, d)
    counts = X.examples(spark, d).groupBy("target_id").agg(F.count("*").alias("n"))
    done = e.join(counts, "target_id").where("k <= n").select("idx")
    return e.join(done, "idx", "left_anti").select("idx", "target_id")


CHUNKS = """c AS (SELECT doc_id, text, unnest(range(0, greatest(0, ceil((length(text) - 512) / 448.0)::int) + 1)) AS i FROM documents WHERE text IS NOT NULL AND regexp_replace(text, '[\\s\\x{0B}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+', '', 'g') <> '')"""


@query(f"WITH {CHUNKS} SELECT doc_id, i AS chunk_index, sha256(substring(text, i * 448 + 1, 512)) AS digest, length(substring(text, i * 448 + 1, 512)) AS chars FROM c")
def chunk_fixed(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "documents").where("text is not null")
    c = t.select("doc_id", F.explode(chunking.fixed_chunks(F.col("text"))).alias("c"))
    return c.select("doc_id", "c.chunk_index", T.digest(F.col("c.text")).alias("digest"), F.length("c.text").alias("chars"))


@query()
def chunk_recursive(spark: SparkSession, d: str) -> DataFrame:
    p = read_table(spark, d, "extracted_pages").dropDuplicates(["page_id"])
    c = p.select("source_file", "page_number", "mode", F.explode(chunking.recursive_chunks(F.col("text"))).alias("c"))
    ident = T.chunk_id(F.lit("pages"), F.col("source_file"), F.col("page_number"), F.col("c.chunk_index"))
    return c.select(ident.alias("chunk_id"), "source_file", "page_number", "mode", "c.chunk_index", "c.text")


@query(
    """WITH c AS (SELECT chunk_id, any_value(source_file) AS source_file, any_value(page_number) AS page_number, any_value(chunk_index) AS chunk_index, any_value(domain) AS domain FROM chunks GROUP BY chunk_id)
SELECT chunk_id, domain || '_' || source_file || '_p' || page_number || '_c' || chunk_index AS made, chunk_id = domain || '_' || source_file || '_p' || page_number || '_c' || chunk_index AS same FROM c"""
)
def chunk_ids(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "chunks").dropDuplicates(["chunk_id"])
    made = T.chunk_id(F.col("domain"), F.col("source_file"), F.col("page_number"), F.col("chunk_index"))
    return c.select("chunk_id", made.alias("made"), (F.col("chunk_id") == made).alias("same"))


@query(
    """WITH c AS (SELECT chunk_id, any_value(source_file) AS f, any_value(page_number) AS p, any_value(chunk_index) AS i, any_value(text) AS t FROM chunks GROUP BY chunk_id)
SELECT f AS source_file, p AS page_number, count(*) AS chunks, sha256(coalesce(string_agg(t, chr(10) ORDER BY i) FILTER (WHERE t IS NOT NULL), '')) AS digest FROM c GROUP BY f, p"""
)
def page_text(spark: SparkSession, d: str) -> DataFrame:
    """The texts of a page joined in order, null ones left out. A page bounds the group."""
    c = read_table(spark, d, "chunks").dropDuplicates(["chunk_id"])
    parts = F.transform(F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("chunk_index", "text")))), lambda x: x["text"])
    return c.groupBy("source_file", "page_number").agg(F.count("*").alias("chunks"), T.digest(F.array_join(parts, "\n")).alias("digest"))


KNN = """q AS (SELECT vec_id AS query_id, embedding::double[] AS v FROM embeddings WHERE vec_id % 20 = 0),
p AS (SELECT query_id, vec_id, round({m}(v, embedding::double[]), 9) AS distance FROM q CROSS JOIN embeddings),
r AS (SELECT query_id, vec_id, distance, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM p)"""


def _nearest(spark: SparkSession, d: str, metric: str) -> DataFrame:
    rows = read_table(spark, d, "embeddings")
    hits = retrieve.nearest(rows, rows.where("vec_id % 20 = 0"), 5, metric)  # the stated query set, against all rows
    return hits.select("query_id", "rank", "vec_id", F.round("distance", 5).alias("distance"))


@query(f"WITH {KNN.format(m='list_distance')} SELECT query_id, rank, vec_id, round(distance, 5) AS distance FROM r WHERE rank <= 5")
def knn_topk(spark: SparkSession, d: str) -> DataFrame:
    return _nearest(spark, d, "l2")


@query(f"WITH {KNN.format(m='list_cosine_distance')} SELECT query_id, rank, vec_id, round(distance, 5) AS distance FROM r WHERE rank <= 5")
def knn_cosine(spark: SparkSession, d: str) -> DataFrame:
    return _nearest(spark, d, "cosine")


@query(
    f"""WITH {KNN.format(m='list_distance')}, g AS (SELECT DISTINCT category, type FROM generation_targets), n AS (SELECT category, type, (row_number() OVER (ORDER BY category, type) - 1) * 20 AS query_id FROM g),
b AS (SELECT query_id, string_agg('--- Chunk ' || rank || ' (source: label ' || label || ', p.' || r.vec_id || ') ---' || chr(10) || 'vector ' || r.vec_id || chr(10), chr(10) ORDER BY rank) AS context FROM r JOIN embeddings e ON e.vec_id = r.vec_id WHERE rank <= 3 GROUP BY query_id)
SELECT t.target_id, n.query_id, b.context FROM generation_targets t JOIN n USING (category, type) LEFT JOIN b ON b.query_id = n.query_id"""
)
def retrieve_context(spark: SparkSession, d: str) -> DataFrame:
    """Targets with their context. Each distinct (category, type) is one query, however many targets share it."""
    t, rows = read_table(spark, d, "generation_targets"), read_table(spark, d, "embeddings")
    # one row a query; the targets are a plan of a few rows
    asked = t.select("category", "type").distinct().withColumn("query_id", ((F.row_number().over(Window.orderBy("category", "type")) - 1) * 20).cast("long"))
    hits = retrieve.nearest(rows, rows.join(F.broadcast(asked.select(F.col("query_id").alias("vec_id"))), "vec_id", "left_semi"), 3)
    named = hits.join(rows.select("vec_id", "label"), "vec_id")
    source, body = F.concat(F.lit("label "), F.col("label").cast("string")), F.concat(F.lit("vector "), F.col("vec_id").cast("string"))
    context = retrieve.context_of(named, "query_id", F.col("rank"), source, F.col("vec_id"), body)
    return t.join(asked, ["category", "type"]).join(context, "query_id", "left").select("target_id", "query_id", "context")


@query(
    """WITH dw AS (SELECT doc_id AS k, list_filter(regexp_split_to_array(lower(text), '[\\s\\x{0B}]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
pw AS (SELECT page_id AS k, list_filter(regexp_split_to_array(lower(any_value(text)), '[\\s\\x{0B}]+'), lambda x: x <> '') AS w FROM extracted_pages WHERE text IS NOT NULL GROUP BY page_id),
dr AS (SELECT DISTINCT k, array_to_string(w[i + 1 : i + 15], ' ') AS run FROM (SELECT k, w, unnest(range(0, len(w) - 14)) AS i FROM dw WHERE len(w) >= 15)),
pr AS (SELECT DISTINCT array_to_string(w[i + 1 : i + 15], ' ') AS run FROM (SELECT w, unnest(range(0, len(w) - 14)) AS i FROM pw WHERE len(w) >= 15))
SELECT k AS doc_id, count(*) AS shared FROM dr SEMI JOIN pr USING (run) GROUP BY k"""
)
def verbatim_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Documents that give back 15 words in a row of a page."""
    return overlap.reproduced(read_table(spark, d, "documents"), read_table(spark, d, "extracted_pages").dropDuplicates(["page_id"]), 15)


BUCKET = "(('0x' || substr(sha256({k}::varchar), 1, 8))::bigint % 100)"


@query(f"SELECT doc_id, CASE WHEN {BUCKET.format(k='doc_id')} < 80 THEN 'train' ELSE 'validation' END AS part FROM documents")
def train_valid_split(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents").select("doc_id", F.when(T.hash_bucket(F.col("doc_id")) < 80, "train").otherwise("validation").alias("part"))


@query(
    """SELECT t.target_id, coalesce(c.critic, 'default') AS critic FROM generation_targets t LEFT JOIN (VALUES ('knowledge', 'strict')) c(layer, critic) USING (layer)"""
)
def critic_by_layer(spark: SparkSession, d: str) -> DataFrame:
    table = F.broadcast(spark.createDataFrame([("knowledge", "strict")], "layer string, critic string"))  # a literal table
    return read_table(spark, d, "generation_targets").join(table, "layer", "left").select("target_id", F.coalesce("critic", F.lit("default")).alias("critic"))


CRITERIA = "(VALUES ('guiding_questions', 'behaviour'), ('ao_accuracy', 'all'), ('factual_accuracy', 'knowledge'), ('age_appropriate', 'all'))"


@query(f"SELECT t.target_id, c.name AS criterion FROM generation_targets t JOIN {CRITERIA} c(name, layer) ON c.layer = t.layer OR c.layer = 'all'")
def criteria_for_layer(spark: SparkSession, d: str) -> DataFrame:
    rows = [("guiding_questions", "behaviour"), ("ao_accuracy", "all"), ("factual_accuracy", "knowledge"), ("age_appropriate", "all")]
    # "all" is spelled out for each layer, which turns the theta join into an equi-join
    spelled = [(n, y) for n, x in rows for y in (("behaviour", "knowledge") if x == "all" else (x,))]
    table = F.broadcast(spark.createDataFrame(spelled, "criterion string, layer string"))
    return read_table(spark, d, "generation_targets").join(table, "layer").select("target_id", "criterion")


@query(
    """WITH f AS (SELECT DISTINCT source_file FROM extracted_pages), p(ord, pattern, mode) AS (VALUES (1, 'winter_*.pdf', 'vlm'), (2, '*_notes_*.pdf', 'standard'), (3, '*.pdf', 'standard')),
m AS (SELECT source_file, ord, pattern, mode, row_number() OVER (PARTITION BY source_file ORDER BY ord) AS rn FROM f JOIN p ON source_file GLOB pattern) SELECT source_file, pattern, mode FROM m WHERE rn = 1"""
)
def glob_match(spark: SparkSession, d: str) -> DataFrame:
    """Files with the first pattern that matches them."""
    patterns = [(1, "winter_*.pdf", "vlm"), (2, "*_notes_*.pdf", "standard"), (3, "*.pdf", "standard")]
    files = read_table(spark, d, "extracted_pages").select("source_file").distinct()
    found, mode = F.lit(None).cast("string"), F.lit(None).cast("string")
    for _, pattern, m in reversed(patterns):
        hit = F.col("source_file").like(pattern.replace("_", "\\_").replace("*", "%"))
        found, mode = F.when(hit, F.lit(pattern)).otherwise(found), F.when(hit, F.lit(m)).otherwise(mode)
    return files.select("source_file", found.alias("pattern"), mode.alias("mode")).where("pattern is not null")


@query(
    f"""WITH {B.EX}, a AS (SELECT DISTINCT target_id, topic FROM ex WHERE layer = 'behaviour'), b AS (SELECT DISTINCT target_id, topic FROM ex WHERE layer = 'knowledge')
SELECT 'only_behaviour' AS part, count(*) AS n FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'only_knowledge', count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a) UNION ALL SELECT 'both', count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'all', count(*) FROM (SELECT target_id FROM ex WHERE layer = 'behaviour' UNION ALL SELECT target_id FROM ex WHERE layer = 'knowledge')"""
)
def set_operations(spark: SparkSession, d: str) -> DataFrame:
    """Except, intersect and union all of two outputs, by one aggregate over the pairs instead of three shuffles."""
    e = X.examples(spark, d).where("layer in ('behaviour', 'knowledge')")
    g = e.groupBy("target_id", "topic").agg(F.bool_or(F.col("layer") == "behaviour").alias("a"), F.bool_or(F.col("layer") == "knowledge").alias("b"), F.count("*").alias("n"))
    one = g.agg(F.count_if(F.col("a") & ~F.col("b")).alias("only_behaviour"), F.count_if(F.col("b") & ~F.col("a")).alias("only_knowledge"), F.count_if(F.col("a") & F.col("b")).alias("both"), F.coalesce(F.sum("n"), F.lit(0)).alias("all"))
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("part"), F.col(c).alias("n")) for c in ("only_behaviour", "only_knowledge", "both", "all")])).alias("x")).select("x.*")


@query(f"WITH {B.EX}, r AS (SELECT run_id, ex_id, row_number() OVER (ORDER BY ex_id) AS rn FROM ex) SELECT rn, ex_id, run_id FROM r WHERE rn % 50 = 0")
def progress_every(spark: SparkSession, d: str) -> DataFrame:
    """Every fiftieth example in order."""
    return order.numbered(X.examples(spark, d).select("ex_id", "run_id"), ["ex_id"]).where("rn % 50 = 0").select("rn", "ex_id", "run_id")


@query(
    f"""WITH {B.EX}, r AS (SELECT coalesce(layer, 'none') AS layer, ex_id FROM ex) SELECT layer, count(*) AS lines, sum(ex_id)::bigint AS checksum FROM r GROUP BY layer"""
)
def jsonl_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Examples written as JSON lines by layer and read again."""
    path = scratch_path(spark, "jsonl")
    e = X.examples(spark, d).select(F.coalesce("layer", F.lit("none")).alias("layer"), "ex_id", "type", "topic")
    sinks.write_jsonl(e, path, by=["layer"])
    back = sinks.read_jsonl(spark, path, "ex_id long, type string, topic string, layer string")
    return back.groupBy("layer").agg(F.count("*").alias("lines"), F.sum("ex_id").alias("checksum"))


@query("WITH c AS (SELECT chunk_id, any_value(domain) AS domain FROM chunks WHERE text IS NOT NULL GROUP BY chunk_id) SELECT domain, count(*) AS chunks FROM c GROUP BY domain")
def collection_index(spark: SparkSession, d: str) -> DataFrame:
    """Chunks indexed into a collection partitioned by domain, and counted from there."""
    path = scratch_path(spark, "collection")
    sinks.index_chunks(read_table(spark, d, "chunks").where("text is not null").dropDuplicates(["chunk_id"]), path)
    return sinks.open_collection(spark, path).groupBy("domain").agg(F.count("*").alias("chunks"))


@query()
def generation_rounds(spark: SparkSession, d: str) -> DataFrame:
    """All expanded targets through the rounds with the deterministic stand-ins: outcomes by turn."""
    e = target_expand(spark, d).join(F.broadcast(read_table(spark, d, "generation_targets").select("target_id", "category", "type", "layer")), "target_id")  # a plan of a few rows
    out = rounds.run(e.select("idx", "category", "type", "layer", "grade"))
    good = out.accepted.groupBy(F.lit("accepted").alias("outcome"), "turn").agg(F.count("*").alias("targets"))
    return good.unionByName(out.rejected.groupBy(F.col("reason").alias("outcome"), F.col("turns").alias("turn")).agg(F.count("*").alias("targets")))


@query(
    "SELECT target_id, 'Generate a training example for:' || chr(10) || '  Category: ' || category || chr(10) || '  Type: ' || type || chr(10) || '  Layer: ' || layer || chr(10) || '  Grade Target: ' || coalesce(grade_targets[1]::int::varchar, 'null') || chr(10) AS prompt FROM generation_targets"
)
def target_prompts(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "generation_targets")
    return t.select("target_id", T.fill(rounds.PROMPT, category=F.col("category"), type=F.col("type"), layer=F.col("layer"), grade=F.get("grade_targets", F.lit(0))).alias("prompt"))


@query("SELECT target_id, category, CASE WHEN type = 'reasoning' AND category LIKE 'Feedback%' THEN 'multi_turn' WHEN type = 'reasoning' THEN 'reasoning' ELSE 'direct' END AS template FROM generation_targets")
def template_route(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "generation_targets")
    many = (F.col("type") == "reasoning") & F.col("category").startswith("Feedback")
    return t.select("target_id", "category", F.when(many, "multi_turn").when(F.col("type") == "reasoning", "reasoning").otherwise("direct").alias("template"))


MESSAGE = """'Generate a training example for:' || chr(10) || '  Category: ' || category || chr(10) || '  Type: ' || type || chr(10) || '  Layer: ' || layer || chr(10) || '  Grade Target: ' || coalesce(grade_targets[1]::int::varchar, 'null (grade-agnostic)') || chr(10)"""


@query(
    f"""SELECT target_id, {MESSAGE} AS plain, {MESSAGE} || chr(10) || '--- Curriculum Context (use this to ground your example) ---' || chr(10) || category || chr(10) || '--- End Curriculum Context ---' || chr(10) AS grounded,
 {MESSAGE} || chr(10) || '--- ' || CASE WHEN type = 'direct' THEN 'Format Error' ELSE 'Coach Feedback' END || ' (revise based on this) ---' || chr(10) || CASE WHEN type = 'direct' THEN 'FORMAT ERROR: none' ELSE 'weak' || chr(10) || chr(10) || 'Issues:' || chr(10) || '- [minor] ' || category || ': short (suggestion: quote)' END || chr(10) || '--- End Feedback ---' || chr(10) AS revised FROM generation_targets"""
)
def generator_messages(spark: SparkSession, d: str) -> DataFrame:
    """What the generator is asked for each target: plain, with context, and after a reply that failed."""
    t = read_table(spark, d, "generation_targets")
    issue = F.array(F.struct(F.lit("minor").alias("severity"), F.col("category").alias("criterion"), F.lit("short").alias("description"), F.lit("quote").alias("suggestion")))
    said = F.when(F.col("type") == "direct", F.lit("FORMAT ERROR: none")).otherwise(T.feedback(F.lit("weak"), issue))
    none, grade = F.lit(None).cast("string"), F.get("grade_targets", F.lit(0))
    ask = lambda context, feedback: T.generator_message(F.col("category"), F.col("type"), F.col("layer"), grade, context, feedback)
    return t.select("target_id", ask(none, none).alias("plain"), ask(F.col("category"), none).alias("grounded"), ask(none, said).alias("revised"))
