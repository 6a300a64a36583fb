"""Heading trees, pruning, paths and totals over documents rendered as Markdown."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioquest.functions import fixed, text
from folioquest.operators import tree
from folioquest.plans import tables
from folioquest.plans.text_queries import _TRIM, quote


def _heads(docs: DataFrame) -> DataFrame:
    nodes = tree.heading_nodes(docs)
    return nodes.select("doc_id", F.col("idx").cast("long").alias("idx"), F.coalesce("parent_idx", F.lit(-1)).cast("long").alias("parent_idx"), "name", F.coalesce(F.length("content"), F.lit(0)).cast("long").alias("chars"), F.col("depth").cast("long").alias("depth"), F.array_join(F.col("ancestors.name"), " > ").alias("above"))


def conversation_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _heads(tables.conversations_as_markdown(spark, sf_dir))


def heading_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _heads(tables.documents_as_markdown(spark, sf_dir))


def heading_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final leaves with their whole paths."""
    leaves = tree.topic_path(tree.build(tables.documents_as_markdown(spark, sf_dir))[1])
    return leaves.select("doc_id", F.col("idx").cast("long").alias("idx"), F.array_join("topic_path", " > ").alias("topic_path"), F.length("content").cast("long").alias("chars"))


def survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = tree.build(tables.documents_as_markdown(spark, sf_dir))[0]
    return nodes.select("doc_id", F.col("idx").cast("long").alias("idx"), "is_leaf", F.coalesce(F.length("content"), F.lit(0)).cast("long").alias("chars"))


def subtree_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = tree.subtree_totals(tree.heading_nodes(tables.documents_as_markdown(spark, sf_dir)))
    return totals.select("doc_id", F.col("idx").cast("long").alias("idx"), "total_chars", "n_nodes")


def forest_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The root, the files and all headings."""
    nodes = tree.forest(tree.heading_nodes(tables.documents_as_markdown(spark, sf_dir)))
    return nodes.select("kind", F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), F.coalesce("idx", F.lit(-2)).cast("long").alias("idx"), F.coalesce("parent_idx", F.lit(-2)).cast("long").alias("parent_idx"), "name", F.col("depth").cast("long").alias("depth"), F.col("level").cast("long").alias("level"))


def plain_documents_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without headings: each is one node named after its file, and a leaf if long enough."""
    docs = tables.documents(spark, sf_dir).withColumn("source", F.concat("source", F.lit(".txt")))
    return tree.build(docs)[1].select("doc_id", "name", F.length("content").cast("long").alias("chars"))


def page_title_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as Markdown: the title as heading, paragraphs below."""
    html = F.col("html")
    paragraphs = F.regexp_extract_all(html, F.lit("<p[^>]*>(.*?)</p>"), F.lit(1))
    content = F.concat(F.lit("# "), F.regexp_extract(html, "<h1[^>]*>(.*?)</h1>", 1), F.lit("\n"), F.array_join(paragraphs, "\n"))
    docs = tables.table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), content.alias("content"), F.lit("page.md").alias("source"))
    return _heads(docs)


def file_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.documents(spark, sf_dir)
    name = F.concat("source", F.element_at(F.array(*map(F.lit, (".PDF", ".md", ".txt", ".csv", ""))), (F.col("doc_id") % 5 + 1).cast("int")))
    return docs.select("doc_id", tree.is_file_node(F.when(F.col("doc_id") % 3 == 0, "root").otherwise(F.col("source")), name).alias("is_file"), text.stem(name).alias("stem"))


_T = lambda x: _TRIM.format(x)
_HEAD = r"'^(#{1,6})\s+(.+)$'"


def heads_sql(docs: str) -> str:
    """Nodes ``n`` (doc_id, idx, parent_idx, name, content, lv, anc) of the documents ``t`` (doc_id, content, source)."""
    last = ", ".join(f"max(CASE WHEN lv = {k} THEN idx END) OVER b AS l{k}" for k in range(1, 7))
    chain = ", ".join(f"CASE WHEN lv > {k} AND idx > 0{''.join(f' AND coalesce(l{m} < l{k}, true)' for m in range(1, k))} THEN l{k} END" for k in range(1, 7))
    return f"""{docs},
l AS (SELECT doc_id, source, string_split(content, chr(10)) AS lines FROM t),
x AS (SELECT doc_id, source, lines, unnest(range(1, len(lines) + 1)) AS ln FROM l),
y AS (SELECT doc_id, source, lines, ln, regexp_extract({_T('lines[ln]')}, {_HEAD}, 1) AS marks, {_T(f"regexp_extract({_T('lines[ln]')}, {_HEAD}, 2)")} AS name FROM x),
h AS (SELECT *, length(marks) AS lv, row_number() OVER (PARTITION BY doc_id ORDER BY ln) - 1 AS idx, coalesce(lead(ln) OVER (PARTITION BY doc_id ORDER BY ln), len(lines) + 1) AS nxt, count(*) OVER (PARTITION BY doc_id) AS n_heads FROM y WHERE marks <> ''),
c AS (SELECT doc_id, source, idx, lv, name, n_heads, {_T("array_to_string(lines[ln + 1:nxt - 1], chr(10))")} AS content FROM h),
p AS (SELECT *, {last} FROM c WHERE NOT (n_heads = 1 AND content = '') WINDOW b AS (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
q AS (SELECT doc_id, source, idx, lv, name, nullif(content, '') AS content, CASE WHEN idx = 0 THEN CAST([] AS BIGINT[]) ELSE list_distinct(list_filter([0, {chain}], lambda v: v IS NOT NULL)) END AS anc FROM p),
n AS (SELECT doc_id, source, idx, name, content, list_sort(anc) AS anc FROM q UNION ALL
  SELECT doc_id, source, 0, regexp_replace(source, '\\.[^.]+$', ''), {_T('content')}, CAST([] AS BIGINT[]) FROM t WHERE doc_id NOT IN (SELECT doc_id FROM h))"""


def _above_sql() -> str:
    return """
u AS (SELECT doc_id, idx, unnest(range(1, len(anc) + 1)) AS k, anc FROM n),
ab AS (SELECT u.doc_id, u.idx, string_agg(m.name, ' > ' ORDER BY k) AS above FROM u JOIN n m ON m.doc_id = u.doc_id AND m.idx = u.anc[k] GROUP BY u.doc_id, u.idx)"""


_NODES_OUT = "SELECT n.doc_id, n.idx, CASE WHEN n.idx > 0 THEN n.anc[-1] ELSE -1 END AS parent_idx, n.name, coalesce(length(n.content), 0) AS chars, CAST(greatest(len(n.anc), 1) AS BIGINT) AS depth, coalesce(above, '') AS above FROM n LEFT JOIN ab USING (doc_id, idx)"
_SKIP = quote("(?i)" + "|".join(fixed.SKIP_SECTIONS))
_GOOD = f"""
bad AS (SELECT DISTINCT u.doc_id, u.idx FROM (SELECT doc_id, idx, unnest(list_append(anc, idx)) AS a FROM n) u JOIN n m ON m.doc_id = u.doc_id AND m.idx = u.a WHERE regexp_matches(m.name, {_SKIP})),
good AS (SELECT n.* FROM n LEFT JOIN bad b ON b.doc_id = n.doc_id AND b.idx = n.idx WHERE b.idx IS NULL AND length(n.content) >= 50),
inn AS (SELECT DISTINCT doc_id, unnest(anc) AS idx FROM good)"""
_PAGES = "t AS (SELECT page_id AS doc_id, '# ' || regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1) || chr(10) || array_to_string(regexp_extract_all(html, '<p[^>]*>(.*?)</p>', 1), chr(10)) AS content, 'page.md' AS source FROM pages)"

QUERIES = {
    "conversation_nodes": conversation_nodes,
    "heading_nodes": heading_nodes,
    "heading_leaves": heading_leaves,
    "survivors": survivors,
    "subtree_totals": subtree_totals,
    "forest_nodes": forest_nodes,
    "plain_documents_tree": plain_documents_tree,
    "page_title_nodes": page_title_nodes,
    "file_nodes": file_nodes,
}

ORACLES = {
    "conversation_nodes": f"WITH {heads_sql(tables.CONVERSATIONS_SQL)}, {_above_sql()} {_NODES_OUT}",
    "heading_nodes": f"WITH {heads_sql(tables.DOCUMENTS_SQL)}, {_above_sql()} {_NODES_OUT}",
    "page_title_nodes": f"WITH {heads_sql(_PAGES)}, {_above_sql()} {_NODES_OUT}",
    "heading_leaves": f"""
WITH {heads_sql(tables.DOCUMENTS_SQL)}, {_above_sql()}, {_GOOD}
SELECT g.doc_id, g.idx, '{fixed.ROOT_NAME} > ' || g.source || ' > ' || coalesce(above || ' > ', '') || g.name AS topic_path, length(g.content) AS chars
FROM good g LEFT JOIN ab USING (doc_id, idx) WHERE (g.doc_id, g.idx) NOT IN (SELECT (doc_id, idx) FROM inn)""",
    "survivors": f"""
WITH {heads_sql(tables.DOCUMENTS_SQL)}, {_GOOD}
SELECT n.doc_id, n.idx, i.idx IS NULL AS is_leaf, coalesce(length(n.content), 0) AS chars FROM n LEFT JOIN inn i USING (doc_id, idx) WHERE i.idx IS NOT NULL OR (n.doc_id, n.idx) IN (SELECT (doc_id, idx) FROM good)""",
    "subtree_totals": f"""
WITH {heads_sql(tables.DOCUMENTS_SQL)}, e AS (SELECT doc_id, unnest(list_append(anc, idx)) AS idx, coalesce(length(content), 0) AS chars FROM n)
SELECT doc_id, idx, CAST(sum(chars) AS BIGINT) AS total_chars, count(*) AS n_nodes FROM e GROUP BY doc_id, idx""",
    "forest_nodes": f"""
WITH {heads_sql(tables.DOCUMENTS_SQL)}
SELECT 'root' AS kind, CAST(-1 AS BIGINT) AS doc_id, CAST(-2 AS BIGINT) AS idx, CAST(-2 AS BIGINT) AS parent_idx, '{fixed.ROOT_NAME}' AS name, CAST(0 AS BIGINT) AS depth, CAST(0 AS BIGINT) AS level
UNION ALL SELECT DISTINCT 'file', doc_id, -1, -2, source, 0, 1 FROM n
UNION ALL SELECT 'section', doc_id, idx, CASE WHEN idx > 0 THEN anc[-1] ELSE -1 END, name, greatest(len(anc), 1), len(anc) + 2 FROM n""",
    "plain_documents_tree": f"SELECT doc_id, source AS name, length({_T('text')}) AS chars FROM documents WHERE length({_T('text')}) >= 50 AND NOT regexp_matches(source, {_SKIP})",
    "file_nodes": """
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'root' ELSE source END AS s, source || ['.PDF', '.md', '.txt', '.csv', ''][doc_id % 5 + 1] AS name FROM documents)
SELECT doc_id, s <> 'root' AND regexp_matches(lower(name), '\\.(pdf|txt|md)$') AS is_file, regexp_replace(name, '\\.[^.]+$', '') AS stem FROM d""",
}
