"""Pieces, chunk quality, question filters and quotas over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioquest.functions import fixed, text
from folioquest.operators import filters, quota, splitting
from folioquest.plans.tables import documents, table

QUOTA_TARGET = 137


def quote(s: str) -> str:
    return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def any_hits(column: str, terms: tuple[str, ...]) -> str:
    return "(" + " + ".join(f"CAST(contains({column}, {quote(t)}) AS INT)" for t in terms) + ")"


def _leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of 50 characters and more, as leaves numbered by their id."""
    return documents(spark, sf_dir).where(F.length(text.strip("content")) >= 50).select("doc_id", F.col("doc_id").alias("leaf_idx"), text.strip("content").alias("content"), "source")


def leaf_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.leaf_chunks(documents(spark, sf_dir)).select("doc_id", F.col("piece_no").cast("long").alias("piece_no"), "piece")


def leaf_chunk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.leaf_chunks(documents(spark, sf_dir)).groupBy("doc_id").agg(F.count("*").alias("n_pieces"), F.sum(F.length("piece")).alias("n_chars"))


def document_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces that pass the quality rules, numbered densely over all documents."""
    return splitting.numbered_chunks(documents(spark, sf_dir)).select("chunk_id", "doc_id", F.col("start_pos").cast("long").alias("start_pos"), F.col("end_pos").cast("long").alias("end_pos"), "piece")


def slice_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.slices(documents(spark, sf_dir)).select("doc_id", F.col("piece_no").cast("long").alias("piece_no"), F.col("start_pos").cast("long").alias("start_pos"), F.col("end_pos").cast("long").alias("end_pos"))


def quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("terms", filters.terms_in(F.col("content")))
    return docs.select("doc_id", F.coalesce(filters.quality_reasons(F.col("content"), terms=F.col("terms")), F.lit("good")).alias("reason"))


def front_matter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", filters.is_front_matter(F.col("content")).alias("front_matter"))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "conversations").where("role = 'user'").select((F.col("conv_id") * 100 + F.col("turn")).alias("q_id"), F.col("text").alias("question"))
    quoted = table(spark, sf_dir, "benchmark").select((-F.col("item_id") - 1).alias("q_id"), F.concat(F.lit("What is "), "text").alias("question"))
    return asked.unionByName(quoted)


QUESTIONS_SQL = "q AS (SELECT conv_id * 100 + turn AS q_id, text AS question FROM conversations WHERE role = 'user' UNION ALL SELECT -item_id - 1, 'What is ' || text FROM benchmark)"


def generic_question(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions(spark, sf_dir).select("q_id", filters.is_generic_question(F.col("question")).alias("is_generic"), filters.is_grounded(F.col("question")).alias("is_grounded"))


def question_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.first_of_each_question(questions(spark, sf_dir), "question", "q_id").select("q_id", "norm")


def question_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions folded in order within 16 groups; in every other group the texts' first 60 characters, so that many are alike."""
    asked = questions(spark, sf_dir).withColumn("part", F.pmod("q_id", F.lit(16)).cast("long"))
    asked = asked.withColumn("question", F.when(F.col("part") % 2 == 0, F.substring("question", 1, 60)).otherwise(F.col("question")))
    return filters.accepted_questions(asked, "question", "q_id", "part").select("part", "q_id", "norm")


def round_robin_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quota.round_robin(_leaves(spark, sf_dir), QUOTA_TARGET).select("leaf_idx", "quota")


def balanced_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quota.balanced(_leaves(spark, sf_dir), QUOTA_TARGET).select("leaf_idx", "source", "quota")


def source_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to leaves, pieces and quotas, summed up for each source."""
    leaves = _leaves(spark, sf_dir)
    shares = quota.balanced(leaves, QUOTA_TARGET).groupBy("source").agg(F.count("*").alias("n_leaves"), F.sum("quota").alias("quota"))
    pieces = splitting.leaf_chunks(leaves).groupBy("source").agg(F.count("*").alias("n_pieces"), F.sum(F.length("piece")).alias("n_chars"))
    return shares.join(pieces, "source").select("source", "n_leaves", "n_pieces", "n_chars", "quota")


def leaf_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quota.deal_types(table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "type", "difficulty")


def polarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = quota.deal_types(documents(spark, sf_dir), "doc_id")
    answer = F.concat(F.when(F.col("doc_id") % 7 < 3, " Falso. ").otherwise("Verdadeiro: "), "content")
    return dealt.select("doc_id", filters.wrong_polarity(F.col("type"), F.col("doc_id") % 2 == 0, answer).alias("wrong"))


def html_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.escape_html("html").alias("escaped"))


def _walk_sql(size: int, overlap: int, cut: str, tail: bool, source: str) -> str:
    """Pieces p (doc_id, n, s, e, piece) of the texts in ``source`` (doc_id, content) that are longer than a piece."""
    more = f"e - {overlap} < len AND s + 1 < len" if tail else "e < len"
    return f"""
w AS (SELECT doc_id, content, length(content) AS len FROM {source} WHERE length(content) > {size}),
p AS (
  SELECT doc_id, content, len, 0 AS n, 0 AS s, {cut.format(s="0", size=size)} AS e FROM w
  UNION ALL
  SELECT doc_id, content, len, n + 1, s2, {cut.format(s="s2", size=size)} FROM (SELECT *, greatest(s + 1, e - {overlap}) AS s2 FROM p WHERE {"true" if tail else "e < len"}) WHERE s2 < len)"""


def _last(char: str, low: str, high: str) -> str:
    """Where ``char`` stands last in [low, high) of content, or -1."""
    part = f"substr(content, {low} + 1, {high} - ({low}))"
    n = "1" if char == "' '" else "2"
    return f"(CASE WHEN contains({part}, {char}) THEN {high} - strpos(reverse({part}), {char}) - {n} + 1 ELSE -1 END)"


_END = "least({s} + {size}, len)"
_SPACE_CUT = f"(CASE WHEN {_END} < len AND {_last(chr(39) + ' ' + chr(39), f'greatest({{s}}, {_END} - 100)', _END)} > {{s}} THEN {_last(chr(39) + ' ' + chr(39), f'greatest({{s}}, {_END} - 100)', _END)} ELSE {_END} END)"
_BLANK = _last("chr(10) || chr(10)", "({s} + {size} // 2)", _END)
_SPACE200 = _last("' '", f"greatest({{s}}, {_END} - 200)", _END)
_SLICE_CUT = f"(CASE WHEN {_END} >= len THEN {_END} WHEN {_BLANK} > {{s}} THEN {_BLANK} WHEN {_SPACE200} > {{s}} THEN {_SPACE200} ELSE {_END} END)"
_TRIM = "trim({}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_PIECE = _TRIM.format("substr(content, s + 1, e - s)")

_DOCS = "d AS (SELECT doc_id, text AS content FROM documents WHERE text IS NOT NULL)"
_LEAF_PIECES = f"""
WITH RECURSIVE {_DOCS}, {_walk_sql(500, 100, _SPACE_CUT, False, "d")},
a AS (SELECT doc_id, n, {_PIECE} AS piece FROM p),
o AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS piece_no, piece FROM a WHERE piece <> ''
  UNION ALL SELECT doc_id, 0, content FROM d WHERE length(content) BETWEEN 1 AND 500)"""

_REASON = f"""CASE WHEN length(c) < 100 THEN 'short'
  WHEN {any_hits("l", fixed.CHUNK_PATTERNS)} >= 2 THEN 'patterns'
  WHEN (length(c) - length(replace(c, chr(10), '')))::DOUBLE / length(c) > 0.1 THEN 'newlines'
  WHEN ({any_hits("l", fixed.METADATA_TERMS)} >= 1 AND length(c) < 300) OR {any_hits("l", fixed.METADATA_TERMS)} >= 2 THEN 'metadata'
  WHEN {any_hits("l", fixed.CITATION_TERMS)} >= 2 AND length(c) < 300 THEN 'citations' ELSE 'good' END"""

_LEAVES = f"v AS (SELECT doc_id AS leaf_idx, source, {_TRIM.format('text')} AS content FROM documents WHERE length({_TRIM.format('text')}) >= 50)"
_BALANCED = f"""{_LEAVES},
s AS (SELECT source, sum(greatest(length(content), 100)) AS total, row_number() OVER (ORDER BY min(leaf_idx)) - 1 AS r, count(*) OVER () AS k FROM v GROUP BY source),
b AS (SELECT leaf_idx, v.source, content, CAST(greatest(1, round_even(({QUOTA_TARGET} // k + CAST(r < {QUOTA_TARGET} % k AS INT))::DOUBLE * greatest(length(content), 100) / total, 0)) AS BIGINT) AS quota
  FROM v JOIN s USING (source) WHERE {QUOTA_TARGET} // k + CAST(r < {QUOTA_TARGET} % k AS INT) > 0)"""

_FRONT = [p for p in fixed.FRONT_MATTER if not p.startswith("^")]
_WORD_COUNT = "len(list_filter(regexp_split_to_array(lower(question), '[\\s]+'), lambda x: x <> ''))"

QUERIES = {
    "source_summary": source_summary,
    "leaf_chunks": leaf_chunks,
    "leaf_chunk_counts": leaf_chunk_counts,
    "document_chunks": document_chunks,
    "slice_pieces": slice_pieces,
    "quality_flags": quality_flags,
    "front_matter": front_matter,
    "generic_question": generic_question,
    "question_exact_dedup": question_exact_dedup,
    "question_near_dedup": question_near_dedup,
    "round_robin_quota": round_robin_quota,
    "balanced_quota": balanced_quota,
    "leaf_types": leaf_types,
    "polarity": polarity,
    "html_escape": html_escape,
}

_TYPES = "list_value(" + ", ".join(map(quote, fixed.QA_TYPES)) + ")"
_LEVELS = "list_value(" + ", ".join(map(quote, fixed.DIFFICULTIES)) + ")"

ORACLES = {
    "leaf_chunks": f"{_LEAF_PIECES} SELECT doc_id, piece_no, piece FROM o",
    "leaf_chunk_counts": f"{_LEAF_PIECES} SELECT doc_id, count(*) AS n_pieces, CAST(sum(length(piece)) AS BIGINT) AS n_chars FROM o GROUP BY doc_id",
    "document_chunks": f"""
WITH RECURSIVE {_DOCS}, {_walk_sql(1000, 200, _SPACE_CUT, True, "d")},
a AS (SELECT doc_id, s, e, {_PIECE} AS c FROM p UNION ALL SELECT doc_id, 0, length(content), content FROM d WHERE length(content) <= 1000),
f AS (SELECT *, {_TRIM.format('lower(c)')} AS l FROM a WHERE c <> '')
SELECT row_number() OVER (ORDER BY doc_id, s) - 1 AS chunk_id, doc_id, CAST(s AS BIGINT) AS start_pos, CAST(e AS BIGINT) AS end_pos, c AS piece FROM f WHERE {_REASON} = 'good'""",
    "slice_pieces": f"""
WITH RECURSIVE {_DOCS}, {_walk_sql(12000, 500, _SLICE_CUT, False, "d")},
a AS (SELECT doc_id, n, s, e FROM p WHERE {_PIECE} <> '' UNION ALL SELECT doc_id, 0, 0, length(content) FROM d WHERE length(content) <= 12000)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS piece_no, CAST(s AS BIGINT) AS start_pos, CAST(e AS BIGINT) AS end_pos FROM a""",
    "quality_flags": f"WITH d AS (SELECT doc_id, text AS c, {_TRIM.format('lower(text)')} AS l FROM documents) SELECT doc_id, {_REASON} AS reason FROM d",
    "front_matter": f"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
r AS (SELECT doc_id, text, len(list_filter(lines, lambda x: regexp_matches(x, {quote('(?i)' + '|'.join(_FRONT))}) OR regexp_matches(x, '(?i)^\\d+\\.\\s+\\w+.*\\d+$'))) AS hits, len(list_filter(lines, lambda x: {_TRIM.format('x')} <> '')) AS n FROM d)
SELECT doc_id, CASE WHEN coalesce(length(text), 0) = 0 THEN false WHEN n = 0 THEN true ELSE hits::DOUBLE / n > 0.3 END AS front_matter FROM r""",
    "generic_question": f"""
WITH {QUESTIONS_SQL} SELECT q_id, length(question) < 20
  OR (regexp_matches(lower(question), '^(?:{"|".join(fixed.GENERIC_OPENERS)})') AND {_WORD_COUNT} - 2 < 5)
  OR (({" OR ".join(f"starts_with(lower(question), {quote(p)})" for p in fixed.GENERIC_PHRASES)}) AND length(question) < 50) AS is_generic,
  {_TRIM.format('question')} <> '' AS is_grounded FROM q""",
    "question_exact_dedup": f"WITH {QUESTIONS_SQL}, n AS (SELECT q_id, rtrim({_TRIM.format('lower(question)')}, '?') AS norm FROM q) SELECT min(q_id) AS q_id, norm FROM n GROUP BY norm",
    "question_near_dedup": f"""
WITH RECURSIVE {QUESTIONS_SQL},
p AS (SELECT q_id, ((q_id % 16) + 16) % 16 AS part, question FROM q),
n AS (SELECT part, q_id, rtrim({_TRIM.format('lower(CASE WHEN part % 2 = 0 THEN substr(question, 1, 60) ELSE question END)')}, '?') AS norm FROM p),
c AS (SELECT part, q_id, norm, row_number() OVER (PARTITION BY part ORDER BY q_id) AS k, list_distinct(list_filter(regexp_split_to_array(norm, '[\\s]+'), lambda x: x <> '')) AS w FROM n),
f AS (SELECT part, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS q_id, '' AS norm, false AS ok, CAST([] AS VARCHAR[]) AS seen, CAST([] AS STRUCT(n BIGINT, w VARCHAR[])[]) AS recent FROM c GROUP BY part
  UNION ALL SELECT f.part, c.k, c.q_id, c.norm, x.ok, CASE WHEN x.ok THEN list_append(seen, c.norm) ELSE seen END, CASE WHEN x.ok THEN list_append(recent, {{'n': length(c.norm), 'w': c.w}})[-{filters.RECENT}:] ELSE recent END
  FROM f JOIN c ON c.part = f.part AND c.k = f.k + 1,
  LATERAL (SELECT NOT list_contains(seen, c.norm) AND len(list_filter(recent, lambda r: abs(r.n - length(c.norm)) <= {filters.LENGTH_APART}::DOUBLE * length(c.norm) AND len(list_intersect(c.w, r.w))::DOUBLE / greatest(len(c.w), 1) > {filters.SAME_WORDS}::DOUBLE)) = 0 AS ok) x)
SELECT part, q_id, norm FROM f WHERE ok""",
    "round_robin_quota": f"WITH {_LEAVES}, r AS (SELECT leaf_idx, row_number() OVER (ORDER BY leaf_idx) - 1 AS r, count(*) OVER () AS k FROM v), q AS (SELECT leaf_idx, CAST({QUOTA_TARGET} // k + CAST(r < {QUOTA_TARGET} % k AS INT) AS BIGINT) AS quota FROM r) SELECT leaf_idx, quota FROM q WHERE quota > 0",
    "balanced_quota": f"WITH {_BALANCED} SELECT leaf_idx, source, quota FROM b",
    "source_summary": f"""
WITH RECURSIVE {_BALANCED}, d AS (SELECT leaf_idx AS doc_id, content FROM v), {_walk_sql(500, 100, _SPACE_CUT, False, "d")},
a AS (SELECT doc_id, {_PIECE} AS piece FROM p UNION ALL SELECT doc_id, content FROM d WHERE length(content) <= 500),
c AS (SELECT source, count(*) AS n_pieces, CAST(sum(length(piece)) AS BIGINT) AS n_chars FROM a JOIN v ON leaf_idx = doc_id WHERE piece <> '' GROUP BY source),
s2 AS (SELECT source, count(*) AS n_leaves, CAST(sum(quota) AS BIGINT) AS quota FROM b GROUP BY source)
SELECT source, n_leaves, n_pieces, n_chars, quota FROM s2 JOIN c USING (source)""",
    "leaf_types": f"SELECT doc_id, {_TYPES}[doc_id % 5 + 1] AS type, {_LEVELS}[doc_id % 3 + 1] AS difficulty FROM labels",
    "polarity": f"""
SELECT doc_id, {_TYPES}[doc_id % 5 + 1] = 'true-false' AND starts_with(lower(ltrim((CASE WHEN doc_id % 7 < 3 THEN ' Falso. ' ELSE 'Verdadeiro: ' END) || text)), CASE WHEN doc_id % 2 = 0 THEN 'falso' ELSE 'verdadeiro' END) AS wrong FROM documents""",
    "html_escape": "SELECT page_id, replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped FROM pages",
}
