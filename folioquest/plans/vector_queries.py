"""Vector search, related leaves and near-duplicate segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioquest.functions import text
from folioquest.operators import similarity
from folioquest.plans.tables import table

K = 5


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("idx"), "embedding", "label")


def _queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every twentieth vector asks; all answer."""
    return _vectors(spark, sf_dir).where("idx % 20 = 0").select(F.col("idx").alias("q_idx"), "embedding")


def _out(found: DataFrame) -> DataFrame:
    return found.select("q_idx", "idx", F.round("score", 4).alias("score"), F.col("rank").cast("long").alias("rank"))


def knn_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(similarity.top_matches(_queries(spark, sf_dir), _vectors(spark, sf_dir), K, "l2"))


def knn_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(similarity.top_matches(_queries(spark, sf_dir), _vectors(spark, sf_dir), K, "ip"))


def knn_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The K nearest besides the query itself and the one with the next id."""
    queries = _queries(spark, sf_dir)
    left_out = queries.select("q_idx", F.explode(F.array("q_idx", F.col("q_idx") + 1)).alias("idx"))
    return _out(similarity.top_matches(queries, _vectors(spark, sf_dir), K, "l2", excluded=left_out))


def knn_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every twentieth vector's K nearest by an index over all; near, not exact."""
    rows = _vectors(spark, sf_dir)
    return _out(similarity.near_matches(_queries(spark, sf_dir), rows, K, similarity.Lists.fit(rows)))


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("idx"), F.col("text").alias("content"), "source")
    return _vectors(spark, sf_dir).join(docs, "idx")


def knn_diverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similarity.search(_queries(spark, sf_dir), _chunks(spark, sf_dir).select("idx", "embedding", "content"), K, "l2")
    return found.select("q_idx", "idx", F.round("score", 4).alias("score"), F.col("place").cast("long").alias("place"))


def _related(spark: SparkSession, sf_dir: str, cut: float) -> DataFrame:
    """Every seventh leaf has no content."""
    leaves = _vectors(spark, sf_dir).select(F.col("idx").alias("leaf_idx"), "embedding", F.col("label").cast("string").alias("source"), F.when(F.col("idx") % 7 == 0, F.when(F.col("idx") % 2 == 0, "")).otherwise("x").alias("content"))
    return similarity.related_leaves(leaves, cut).select("leaf_idx", "related_idx", F.round("score", 4).alias("score"), F.col("rank").cast("long").alias("rank"))


def related_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _related(spark, sf_dir, 0.5)


def related_leaves_low_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _related(spark, sf_dir, 0.3)


def unit_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = similarity.VectorStore("ip")
    v = _vectors(spark, sf_dir)
    store.add(v.select("idx", "label"), v.select("idx", "embedding"))
    return store.unit().select("idx", F.round(F.aggregate("unit", F.lit(0.0), lambda s, x: s + x), 4).alias("sum_of_unit"))


def segment_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of a conversation as segments of a document."""
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("seg_no"), F.col("text").alias("content"))
    return similarity.dedup_segments(turns).select("doc_id", "seg_no")


def word_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares of words that every document has in common with one item of the benchmark, dealt by its number."""
    items = table(spark, sf_dir, "benchmark")
    a = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), (F.col("doc_id") % max(1, items.count())).alias("item_id"), text.word_set("text").alias("a"))
    share = lambda by: F.round(text.overlap(F.col("a"), F.col("b"), by), 6)
    return a.join(items.select("item_id", text.word_set("text").alias("b")), "item_id").select("id", share("candidate").alias("of_candidate"), share("larger").alias("of_larger"))


_DOT = "list_sum(list_transform(range(1, 65), lambda i: {a}.embedding[i]::DOUBLE * {b}.embedding[i]::DOUBLE))"
_L2 = "list_sum(list_transform(range(1, 65), lambda i: ({a}.embedding[i]::DOUBLE - {b}.embedding[i]::DOUBLE) * ({a}.embedding[i]::DOUBLE - {b}.embedding[i]::DOUBLE)))"
_COS = f"{_DOT.format(a='a', b='b')} / (sqrt({_DOT.format(a='a', b='a')}) * sqrt({_DOT.format(a='b', b='b')}))"
_SETS = "regexp_split_to_array(trim(lower({})), '\\s+')"


def _knn(score: str, order: str, k: int, rows: str = "embeddings", more: str = "") -> str:
    return f"""
s AS (SELECT a.vec_id AS q_idx, b.vec_id AS idx, {score} AS score FROM embeddings a, {rows} b WHERE a.vec_id % 20 = 0 {more}),
r AS (SELECT *, row_number() OVER (PARTITION BY q_idx ORDER BY score {order}, idx) AS rank FROM s QUALIFY rank <= {k})"""


def _related_sql(cut: float) -> str:
    return f"""
WITH s AS (SELECT a.vec_id AS leaf_idx, b.vec_id AS related_idx, {_COS} AS score FROM embeddings a, embeddings b WHERE a.label <> b.label AND b.vec_id % 7 <> 0)
SELECT leaf_idx, related_idx, round(score, 4) AS score, row_number() OVER (PARTITION BY leaf_idx ORDER BY score DESC, related_idx) AS rank FROM s WHERE score >= {cut} QUALIFY rank <= 3"""


QUERIES = {
    "knn_l2": knn_l2,
    "knn_ip": knn_ip,
    "knn_exclude": knn_exclude,
    "knn_index": knn_index,
    "knn_diverse": knn_diverse,
    "related_leaves": related_leaves,
    "related_leaves_low_cut": related_leaves_low_cut,
    "unit_vectors": unit_vectors,
    "segment_dedup": segment_dedup,
    "word_overlaps": word_overlaps,
}

ORACLES = {
    "knn_l2": f"WITH {_knn(_L2.format(a='a', b='b'), 'ASC', K)} SELECT q_idx, idx, round(score, 4) AS score, rank FROM r",
    "knn_ip": f"WITH {_knn(_COS, 'DESC', K)} SELECT q_idx, idx, round(score, 4) AS score, rank FROM r",
    "knn_exclude": f"WITH {_knn(_L2.format(a='a', b='b'), 'ASC', K, more='AND b.vec_id <> a.vec_id AND b.vec_id <> a.vec_id + 1')} SELECT q_idx, idx, round(score, 4) AS score, rank FROM r",
    "knn_diverse": f"""
WITH RECURSIVE {_knn(_L2.format(a='a', b='b'), 'ASC', 3 * K, '(SELECT e.* FROM embeddings e JOIN documents ON doc_id = vec_id)')},
c AS (SELECT q_idx, idx, score, rank, list_distinct({_SETS.format('text')}) AS w FROM r JOIN documents ON doc_id = idx),
f AS (SELECT q_idx, CAST(0 AS BIGINT) AS rank, CAST([] AS BIGINT[]) AS kept, CAST([] AS VARCHAR[][]) AS words FROM c GROUP BY q_idx
  UNION ALL SELECT f.q_idx, c.rank, CASE WHEN ok THEN list_append(kept, c.rank) ELSE kept END, CASE WHEN ok THEN list_append(words, c.w) ELSE words END
  FROM f JOIN c ON c.q_idx = f.q_idx AND c.rank = f.rank + 1, LATERAL (SELECT len(kept) < {K} AND len(list_filter(words, lambda x: len(list_intersect(c.w, x))::DOUBLE / len(c.w) > 0.6)) = 0 AS ok)),
l AS (SELECT q_idx, arg_max(kept, rank) AS kept FROM f GROUP BY q_idx)
SELECT c.q_idx, idx, round(score, 4) AS score, CAST(list_position(kept, rank) AS BIGINT) AS place FROM c JOIN l ON l.q_idx = c.q_idx AND list_contains(kept, rank)""",
    "related_leaves": _related_sql(0.5),
    "related_leaves_low_cut": _related_sql(0.3),
    "unit_vectors": f"SELECT vec_id AS idx, round(list_sum(list_transform(a.embedding, lambda x: x::DOUBLE)) / sqrt({_DOT.format(a='a', b='a')}), 4) AS sum_of_unit FROM embeddings a",
    "segment_dedup": f"""
WITH RECURSIVE c AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, list_distinct({_SETS.format('text')}) AS w FROM conversations),
f AS (SELECT conv_id, CAST(0 AS BIGINT) AS k, CAST(-1 AS BIGINT) AS turn, false AS ok, CAST([] AS VARCHAR[][]) AS words FROM c GROUP BY conv_id
  UNION ALL SELECT f.conv_id, c.k, c.turn, n.ok, CASE WHEN n.ok THEN list_append(words, c.w) ELSE words END
  FROM f JOIN c ON c.conv_id = f.conv_id AND c.k = f.k + 1, LATERAL (SELECT len(list_filter(words, lambda x: len(list_intersect(c.w, x))::DOUBLE / greatest(len(c.w), len(x)) > 0.7)) = 0 AS ok) n)
SELECT conv_id AS doc_id, turn AS seg_no FROM f WHERE ok""",
    "word_overlaps": f"""
WITH p AS (SELECT doc_id AS id, list_distinct({_SETS.format('d.text')}) AS a, list_distinct({_SETS.format('b.text')}) AS b FROM documents d JOIN benchmark b ON doc_id % (SELECT count(*) FROM benchmark) = item_id)
SELECT id, round(len(list_intersect(a, b))::DOUBLE / len(a), 6) AS of_candidate, round(len(list_intersect(a, b))::DOUBLE / greatest(len(a), len(b)), 6) AS of_larger FROM p""",
}
