"""The driver's tables as the engine's inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, content, source."""
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"), "source")


def conversations_as_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation as a document with a heading for itself and one for each turn."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat(F.lit("## Turn "), F.col("turn").cast("string"), F.lit(" "), "role", F.lit("\n"), "text").alias("part"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "part"))).alias("parts"))
    head = F.concat(F.lit("# Conversation "), F.col("conv_id").cast("string"), F.lit("\n"))
    return whole.select(F.col("conv_id").alias("doc_id"), F.concat(head, F.array_join(F.col("parts.part"), "\n")).alias("content"), F.concat(F.lit("conv"), F.col("conv_id").cast("string"), F.lit(".md")).alias("source"))


CONVERSATIONS_SQL = """
t AS (SELECT conv_id AS doc_id, '# Conversation ' || conv_id || chr(10) || string_agg('## Turn ' || turn || ' ' || role || chr(10) || text, chr(10) ORDER BY turn) AS content, 'conv' || conv_id || '.md' AS source FROM conversations GROUP BY conv_id)"""


def documents_as_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document under three levels of headings, its language, source and number, and a section of references."""
    d = table(spark, sf_dir, "documents")
    part = lambda mark, *x: F.concat(F.lit(mark), *x, F.lit("\n"))
    content = F.concat(part("# Language ", "lang"), part("## ", "source"), part("### Document ", F.col("doc_id").cast("string")), "text", F.lit("\n"), part("## References"), "text", F.lit("\n"), part("### Annex"), part("# Language ", "lang", F.lit(" again")), "text")
    return d.select("doc_id", content.alias("content"), F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit(".md")).alias("source"))


DOCUMENTS_SQL = """
t AS (SELECT doc_id, '# Language ' || lang || chr(10) || '## ' || source || chr(10) || '### Document ' || doc_id || chr(10) || text || chr(10) || '## References' || chr(10) || text || chr(10) || '### Annex' || chr(10) || '# Language ' || lang || ' again' || chr(10) || text AS content, 'doc' || doc_id || '.md' AS source FROM documents)"""
