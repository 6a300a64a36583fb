"""The whole run: a folder of documents, or a saved tree, to a dataset."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioquest.config import Config
from folioquest.functions import providers
from folioquest.functions.providers import ChatProvider, EmbeddingProvider
from folioquest.functions.storage import checkpoint
from folioquest.operators import embedding, generation, ordering, quota, similarity, slicing, splitting, tree
from folioquest.sources import files, sinks

log = logging.getLogger("folioquest")


def build_tree(docs: DataFrame, config: Config, provider: ChatProvider | None = None) -> DataFrame:
    """Pruned nodes from headings, or the nodes of topic trees. Answers of models are kept in the cache folder, if the settings name one."""
    if not config.use_llm_pipeline:
        return tree.build(docs)[0]
    chat = lambda model: provider or providers.chat_of(model, config.chat_url, config.key_variable)
    cache = lambda kind: f"{config.slicer_cache_dir}/{kind}" if config.slicer_cache_dir else None
    segments = checkpoint(slicing.slice_documents(docs, chat(config.slicer_model), config.max_retries, cache=cache("segments")))
    share = max(config.num_samples // max(1, docs.count()), 1)
    return slicing.topic_nodes(segments, chat(config.topic_model), config.max_retries, share, cache("topics")).drop("used_topics")


def leaves_of(nodes: DataFrame) -> DataFrame:
    """Numbered leaves with their paths."""
    from folioquest.functions import fixed

    leaves = nodes.where(F.col("is_leaf") & (F.col("name") != fixed.OTHER_CONTENT))
    return ordering.dense_ids(tree.topic_path(leaves), ["doc_id", "idx"], "leaf_idx")


def sections(leaves: DataFrame, config: Config, embedder: EmbeddingProvider) -> DataFrame:
    """Leaves with quota, pieces and related contents, in order."""
    shares = quota.balanced(leaves, config.num_samples) if config.balance_per_document else quota.round_robin(leaves, config.num_samples)
    pieces = splitting.leaf_chunks(leaves.select("leaf_idx", "content"), config.chunk_size, config.chunk_overlap)
    chunks = pieces.groupBy("leaf_idx").agg(F.array_sort(F.collect_list(F.struct("piece_no", "piece"))).alias("c")).select("leaf_idx", F.col("c.piece").alias("chunks"))
    titled = embedding.embed(leaves.select("leaf_idx", "source", "name", "content"), "name", embedder)
    related = similarity.related_leaves(titled.select("leaf_idx", "source", "embedding", "content"), config.related_cut, config.related_chunks, config.related_index)
    contents = related.join(leaves.select(F.col("leaf_idx").alias("related_idx"), "content"), "related_idx")
    by_leaf = contents.groupBy("leaf_idx").agg(F.array_sort(F.collect_list(F.struct("rank", "content"))).alias("r")).select("leaf_idx", F.col("r.content").alias("related"))
    joined = shares.join(chunks, "leaf_idx", "left").join(by_leaf, "leaf_idx", "left")
    return joined.select("leaf_idx", "source", "name", "topic_path", "content", "quota", F.coalesce("chunks", F.array().cast("array<string>")).alias("chunks"), F.coalesce("related", F.array().cast("array<string>")).alias("related"))


def _reader(rows: DataFrame) -> Callable[[], Iterator[tuple[generation.Section, int]]]:
    def read():
        for r in rows.orderBy("leaf_idx").toLocalIterator():
            yield generation.Section(r["leaf_idx"], r["source"], r["name"], list(r["topic_path"]), r["content"] or "", list(r["chunks"]), list(r["related"])), r["quota"]

    return read


def run_pipeline(spark: SparkSession, folder: str | None, config: Config, provider: ChatProvider | None = None, embedder: EmbeddingProvider | None = None, qa_only: bool = False, pdf_reader=None, ocr=None) -> list[dict]:
    """Entries of the dataset. ``qa_only`` starts from the saved tree; an empty folder is an error. A provider that is passed answers all calls, else the settings' models do."""
    embedder = embedder or providers.embedder_of(config.embedding_model, config.embedding_url, config.key_variable)
    writer = provider or providers.chat_of(config.model_name, config.chat_url, config.key_variable)
    if qa_only:
        if not sinks.tree_exists(spark, config.tree_path):
            raise FileNotFoundError(f"no saved tree: {config.tree_path}")
        nodes = sinks.load_tree(spark, config.tree_path)
    else:
        loaded = checkpoint(files.load_documents(spark, folder, pdf_reader, config.parsed_path, ocr, config.ocr_lang, config.use_table_recognition))
        for r in loaded.where("error is not null").select("source", "error").toLocalIterator():
            log.error("%s: %s", r["source"], r["error"])
        docs = loaded.where("error is null").select("doc_id", "content", "source")
        if docs.isEmpty():
            raise ValueError(f"no documents in {folder}")
        nodes = checkpoint(build_tree(docs, config, provider))
        sinks.save_tree(nodes, config.tree_path)
    leaves = leaves_of(nodes)
    rows = checkpoint(sections(leaves, config, embedder))
    log.info("%d leaves, %d with a quota", leaves.count(), rows.count())
    return generation.generate(_reader(rows), config, writer, log=log.info)
