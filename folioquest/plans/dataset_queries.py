"""Datasets, segments and generated pairs over the driver's tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioquest.functions import fixed
from folioquest.functions.providers import HashingEmbedder, OfflineChat, Request
from folioquest.operators import embedding, generation, quota, slicing
from folioquest.plans.tables import documents, table
from folioquest.plans.text_queries import _TYPES, quote
from folioquest.sources import sinks


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as entries: the text answers, the language and source are its path."""
    dealt = quota.deal_types(table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id"), "doc_id")
    kind = F.when(F.col("doc_id") % 11 == 0, None).otherwise(F.col("type"))
    meta = F.struct(kind.alias("type"), "difficulty", F.array("lang", "source").alias("topic_path"), F.concat("source", F.lit(".txt")).alias("source"))
    return dealt.select("doc_id", F.concat(F.lit("Question "), F.col("doc_id").cast("string")).alias("question"), F.array("text").alias("contexts"), F.col("text").alias("ground_truth"), meta.alias("metadata"))


def dataset_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = generation.entries(_pairs(spark, sf_dir))
    return e.select("question", "answer", "ground_truth", "source", F.col("metadata.type").alias("type"), F.array_join("metadata.topic_path", " > ").alias("topic_path"))


def dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.stats(_pairs(spark, sf_dir).withColumn("source", F.col("metadata.source")), "doc_id").select("field", "value", "n", "first_row")


def _assignment(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents as segments, and topics that list some of them twice, some never and some that don't exist."""
    segments = documents(spark, sf_dir).select(F.col("doc_id").alias("seg_id"), "source", "content")
    labels = table(spark, sf_dir, "labels")
    ids = F.array("doc_id", F.when(F.col("doc_id") % 4 == 0, F.col("doc_id") + 1), F.when(F.col("doc_id") % 9 == 0, -F.col("doc_id") - 1))
    return segments, labels.select(F.col("doc_id").alias("topic"), F.posexplode(F.filter(ids, lambda x: x.isNotNull())).alias("pos", "seg_id"))


def segment_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments, listed = _assignment(spark, sf_dir)
    return slicing.contents_of(listed, segments).select("topic", "n_segments", F.length("content").cast("long").alias("chars"))


def unassigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments, listed = _assignment(spark, sf_dir)
    return slicing.left_over(listed, segments).select("seg_id")


def sliced_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents sliced by the offline provider; no SQL for what a model returns."""
    segments = slicing.slice_documents(documents(spark, sf_dir), OfflineChat())
    return segments.select("doc_id", F.col("seg_no").cast("long").alias("seg_no"), "seg_id", "title", F.length("content").cast("long").alias("chars"))


def topic_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = slicing.topic_nodes(slicing.slice_documents(documents(spark, sf_dir), OfflineChat()), OfflineChat())
    return nodes.select("doc_id", F.col("idx").cast("long").alias("idx"), F.coalesce("parent_idx", F.lit(-1)).cast("long").alias("parent_idx"), "name", F.col("level").cast("long").alias("level"), F.coalesce(F.length("content"), F.lit(0)).cast("long").alias("chars"))


class ByLanguage:
    """Answers with a topic for each title, of the segments whose number isn't divisible by three, one of them twice and one that doesn't exist; leftovers go where their number is even. No model: its trees have an SQL twin."""

    def complete(self, request: Request) -> str:
        number = lambda s: int(s["id"].removeprefix("seg_"))
        if request.kind == "assign":
            return json.dumps({"assignments": [{"segment_id": s["id"], "topic": s["title"]} for s in request.data["segments"] if number(s) % 2 == 0]})
        topics: dict[str, list[str]] = {}
        for s in request.data["segments"]:
            own = topics.setdefault(s["title"], ["seg_none"])
            own += [s["id"]] * (number(s) % 3 > 0)
        return json.dumps({"document_title": "By language", "topics": [{"topic": t, "segment_ids": ids} for t, ids in topics.items()]})


def fixed_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source as a document, its texts as segments titled by their language; topics by a fixed rule."""
    numbered = F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1
    docs = table(spark, sf_dir, "documents").where("text is not null").select(F.regexp_extract("source", "([0-9]+)$", 1).cast("long").alias("doc_id"), "source", numbered.alias("seg_no"), F.col("lang").alias("title"), F.col("text").alias("content"))
    segments = docs.withColumn("seg_id", F.format_string("seg_%03d", "seg_no"))
    nodes = slicing.topic_nodes(segments, ByLanguage())
    return nodes.select("source", "name", F.col("level").cast("long").alias("level"), F.coalesce(F.length("content"), F.lit(0)).cast("long").alias("chars"), "is_leaf")


def embedded_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The signs of every question's vector."""
    asked = table(spark, sf_dir, "conversations").where("role = 'user'").select((F.col("conv_id") * 100 + F.col("turn")).alias("q_id"), "text")
    vectors = embedding.embed(asked, "text", HashingEmbedder())
    sign = F.transform("embedding", lambda x: F.when(x > 0, "+").when(x < 0, "-").otherwise("0"))
    return vectors.select("q_id", F.array_join(sign, "").alias("signs"), F.round(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x), 3).alias("norm"))


def target_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each source, how many leaves to ask a model for, with its documents as segments."""
    docs = documents(spark, sf_dir)
    n_docs = docs.select("source").distinct().count()
    per = docs.groupBy("source").agg(F.count("*").alias("segments"))
    return per.select("source", quota.target_leaves(100, n_docs, F.col("segments")).alias("target"))


QUERIES = {
    "dataset_entries": dataset_entries,
    "dataset_stats": dataset_stats,
    "segment_assign": segment_assign,
    "unassigned": unassigned,
    "sliced_documents": sliced_documents,
    "topic_nodes": topic_nodes,
    "fixed_topics": fixed_topics,
    "embedded_questions": embedded_questions,
    "target_leaves": target_leaves,
}

_ENTRIES = f"e AS (SELECT doc_id, text, lang, source AS src, source || '.txt' AS source, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE {_TYPES}[doc_id % 5 + 1] END AS type, [{', '.join(map(quote, fixed.DIFFICULTIES))}][doc_id % 3 + 1] AS difficulty FROM labels JOIN documents USING (doc_id))"
SPACES = r"[\s]+"
_LISTED = "li AS (SELECT doc_id AS topic, 0 AS pos, doc_id AS seg_id FROM labels UNION ALL SELECT doc_id, 1, doc_id + 1 FROM labels WHERE doc_id % 4 = 0 UNION ALL SELECT doc_id, 2, -doc_id - 1 FROM labels WHERE doc_id % 9 = 0)"

ORACLES = {
    "dataset_entries": f"WITH {_ENTRIES} SELECT 'Question ' || doc_id AS question, text AS answer, text AS ground_truth, source, type, lang || ' > ' || src AS topic_path FROM e",
    "dataset_stats": f"""
WITH {_ENTRIES}, p AS (SELECT doc_id, 'source' AS field, src AS value FROM e UNION ALL SELECT doc_id, 'type', coalesce(type, '-') FROM e UNION ALL SELECT doc_id, 'difficulty', difficulty FROM e)
SELECT field, value, count(*) AS n, min(doc_id) AS first_row FROM p GROUP BY field, value""",
    "segment_assign": f"WITH {_LISTED} SELECT topic, count(*) AS n_segments, length(string_agg(text, chr(10) || chr(10) ORDER BY pos)) AS chars FROM li JOIN documents ON doc_id = seg_id GROUP BY topic",
    "unassigned": f"WITH {_LISTED} SELECT doc_id AS seg_id FROM documents WHERE doc_id NOT IN (SELECT seg_id FROM li)",
    "fixed_topics": f"""
WITH s AS (SELECT source, lang, text, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS n FROM documents WHERE text IS NOT NULL),
t AS (SELECT source, lang, string_agg(text, chr(10) || chr(10) ORDER BY n) FILTER (n % 3 > 0) AS own, string_agg(text, chr(10) || chr(10) ORDER BY n) FILTER (n % 3 = 0 AND n % 2 = 0) AS given FROM s GROUP BY source, lang),
o AS (SELECT source, string_agg(text, chr(10) || chr(10) ORDER BY n) AS rest FROM s WHERE n % 3 = 0 AND (n % 2 > 0 OR (source, lang) IN (SELECT (source, lang) FROM t WHERE own IS NULL)) GROUP BY source)
SELECT source, 'By language' AS name, CAST(1 AS BIGINT) AS level, CAST(0 AS BIGINT) AS chars, false AS is_leaf FROM s GROUP BY source
UNION ALL SELECT source, lang, 2, length(own) + coalesce(2 + length(given), 0), true FROM t WHERE own IS NOT NULL
UNION ALL SELECT source, {quote(fixed.OTHER_CONTENT)}, 2, length(rest), true FROM o""",
    "embedded_questions": f"""
WITH q AS (SELECT conv_id * 100 + turn AS q_id, list_filter(regexp_split_to_array(lower(text), '{SPACES}'), lambda x: x <> '') AS ws FROM conversations WHERE role = 'user'),
w AS (SELECT q_id, unnest(ws) AS w FROM q),
g AS (SELECT q_id, w AS gram FROM w UNION ALL SELECT q_id, substr(w, CAST(k AS BIGINT), 3) FROM (SELECT q_id, w, unnest(range(1, length(w) - 1)) AS k FROM w)),
h AS (SELECT q_id, sha256(gram) AS h FROM g),
d AS (SELECT q_id, CAST('0x' || substr(h, 15, 2) AS INT) % 64 AS dim, CAST('0x' || substr(h, 6, 1) AS INT) % 2 * 2 - 1 AS one FROM h),
v AS (SELECT q_id, dim, sum(one) AS s FROM d GROUP BY q_id, dim),
c AS (SELECT q_id, unnest(range(0, 64)) AS dim FROM q)
SELECT c.q_id, string_agg(CASE WHEN s > 0 THEN '+' WHEN s < 0 THEN '-' ELSE '0' END, '' ORDER BY c.dim) AS signs, CASE WHEN max(abs(coalesce(s, 0))) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS norm
FROM c LEFT JOIN v ON v.q_id = c.q_id AND v.dim = c.dim GROUP BY c.q_id""",
    "target_leaves": "WITH s AS (SELECT source, count(*) AS segments, greatest(100 // count(*) OVER (), 1) AS t FROM documents GROUP BY source) SELECT source, CAST(least(greatest(t, floor(1.5 * t)), 3 * segments) AS BIGINT) AS target FROM s",
}
