"""The queries of the training-data operators over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievework.llm import bpe, common, confusables, neardup, packing, pairs, sampling, scans, splitting
from sievework.runtime import cut_lineage, read_table


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return common.once(_stored(spark, d), "doc_id")


def _stored(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents").select("doc_id", "text")


def _limit(spark: SparkSession, d: str, kind: str) -> tuple[int, int]:
    """Size limit and overlap of one kind of item; the table has one row for each kind."""
    row = read_table(spark, d, "size_limits").where(F.col("item_kind") == kind).first()
    return int(row["max_size"]), int(row["overlap"])


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return pairs.broken_pairs(read_table(spark, d, "messages"))


def p1_summary(spark: SparkSession, d: str) -> DataFrame:
    return p1_found(spark, d).groupBy("defect").agg(F.count("*").alias("pairs"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return scans.noise_lines(scans.find_noise(read_table(spark, d, "extracted_pages")))


def p2_pages(spark: SparkSession, d: str) -> DataFrame:
    return scans.repaired_pages(scans.find_noise(read_table(spark, d, "extracted_pages")))


P3 = neardup.Params(k=3, threshold=0.5, least=100)


def _links(spark: SparkSession, d: str) -> neardup.Links:
    messages = read_table(spark, d, "messages").select("ex_id", "pos", "content", common.role_of("role").alias("role"))
    return neardup.links(messages.where("role in ('user', 'assistant')").drop("role"), "ex_id", "pos", "content", P3)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.all_pairs(_links(spark, d), "ex_id")


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.groups(_links(spark, d), "ex_id")


def _sample(spark: SparkSession, d: str) -> sampling.Sample:
    examples = read_table(spark, d, "examples").select("ex_id", "metadata.text", "metadata.topic", "metadata.grade_target", "metadata.layer")
    fields = {"text": sampling.label("text"), "topic": sampling.label("topic"), "grade_target": sampling.number_label("grade_target"), "layer": sampling.label("layer")}
    return sampling.draw(examples, "ex_id", fields, read_table(spark, d, "sample_targets"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return sampling.unmet(_sample(spark, d))


def p4_sample(spark: SparkSession, d: str) -> DataFrame:
    return _sample(spark, d).rows


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return _sample(spark, d).report


def p5_pieces(spark: SparkSession, d: str) -> DataFrame:
    parts = []
    for kind, table, key in (("chunk", "chunks", "chunk_id"), ("page", "extracted_pages", "page_id")):
        items = common.once(read_table(spark, d, table).select(key, "text"), key)
        parts.append(splitting.split_items(items, kind, *_limit(spark, d, kind), key))
    return parts[0].unionByName(parts[1])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return splitting.oversized_items(p5_pieces(spark, d))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_documents(_documents(spark, d))


def p6_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose ids don't decode to the text again; none, as lone surrogates can't be stored."""
    documents = _documents(spark, d)
    back = bpe.decode_documents(bpe.encode_documents(documents)).withColumnRenamed("text", "decoded")
    differing = documents.join(back, "doc_id").where(F.coalesce("text", F.lit("")) != F.col("decoded"))
    return differing.select("doc_id")


def _places(spark: SparkSession, d: str) -> tuple[DataFrame, int]:
    capacity, _ = _limit(spark, d, "document")
    return packing.pack(cut_lineage(common.once(bpe.token_counts(_stored(spark, d)), "doc_id")), capacity), capacity


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return packing.split_items(_places(spark, d)[0])


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    return _places(spark, d)[0]


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.packing_report(*_places(spark, d))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return confusables.same_look_pairs(_stored(spark, d))  # counts a key once itself, by digest


def p8_forms(spark: SparkSession, d: str) -> DataFrame:
    return confusables.with_normal_form(_documents(spark, d)).select("doc_id", "form")


#: SQL of what SQL can express over whole tables.
P4_FOUND_SQL = r"""
WITH ex AS (SELECT ex_id, any_value(metadata) AS m FROM examples GROUP BY ex_id),
n AS (SELECT count(*) // 2 AS n FROM ex),
lab AS (
  SELECT 'text' AS field, m.text AS v FROM ex UNION ALL SELECT 'topic', m.topic FROM ex
  UNION ALL SELECT 'layer', m.layer FROM ex
  UNION ALL SELECT 'grade_target', coalesce(m.grade_target::bigint::varchar, 'none') FROM ex),
norm AS (SELECT field, regexp_replace(lower(regexp_replace(v, '^\s+|\s+$', '', 'g')), '[\s\-_]+', '_', 'g') AS value, count(*) AS c FROM lab GROUP BY 1, 2)
SELECT t.field, t.value FROM sample_targets t CROSS JOIN n
LEFT JOIN norm USING (field, value)
WHERE coalesce(norm.c, 0) < greatest(t.min_rows, (t.share_permille * n.n + 999) // 1000)
"""
P5_FOUND_SQL = """
WITH items AS (
  SELECT 'chunk' AS item_kind, chunk_id AS item_key, any_value(text) AS text FROM chunks GROUP BY chunk_id
  UNION ALL SELECT 'page', page_id::varchar, any_value(text) FROM extracted_pages GROUP BY page_id),
big AS (SELECT item_kind, item_key, text, max_size FROM items JOIN size_limits USING (item_kind) WHERE length(text) > max_size)
SELECT item_kind, item_key,
  CASE WHEN coalesce(list_max(list_transform(regexp_extract_all(text, '[A-Za-z0-9]+'), lambda x: length(x))), 0) > max_size THEN 'forced' ELSE 'natural' END AS cut
FROM big
"""


def queries() -> dict:
    run = (p1_found, p1_summary, p2_found, p2_pages, p3_found, p3_groups, p4_found, p4_sample, p4_report, p5_found, p5_pieces, p6_ids, p6_round_trip, p7_found, p7_containers, p7_report, p8_found, p8_forms)
    return {f.__name__: f for f in run}


def oracle_sql() -> dict[str, str]:
    return {"p4_found": P4_FOUND_SQL, "p5_found": P5_FOUND_SQL}
