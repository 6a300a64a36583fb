"""python -m folioquest FOLDER: documents to a dataset of questions and answers."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from folioquest import config as settings
from folioquest.plans import pipeline
from folioquest.sources import sinks


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="folioquest", description=__doc__)
    p.add_argument("folder")
    for name, kind in (("chunk-size", int), ("chunk-overlap", int), ("num-samples", int), ("model", str), ("output", str), ("temperature", float), ("batch-size", int), ("ocr-lang", str), ("domain", str), ("language", str), ("tree-path", str), ("slicer-model", str), ("topic-model", str), ("embedding-model", str), ("chat-url", str), ("embedding-url", str)):
        p.add_argument(f"--{name}", type=kind)
    for name, what in (("no-llm-pipeline", "trees from headings"), ("no-balance-docs", "questions in turn over all leaves"), ("no-balance-tf", "no balance of true and false"), ("fresh", "delete caches first"), ("qa-only", "start from the saved tree"), ("related-index", "related leaves by an index")):
        p.add_argument(f"--{name}", action="store_true", help=what)
    return p


def config_of(args: argparse.Namespace, env: dict[str, str] | None = None) -> settings.Config:
    """Options that aren't given leave the environment's values."""
    off = lambda given: False if given else None
    return settings.from_env(
        env, chunk_size=args.chunk_size, chunk_overlap=args.chunk_overlap, num_samples=args.num_samples, model_name=args.model, output_path=args.output, temperature=args.temperature, batch_size=args.batch_size, ocr_lang=args.ocr_lang,
        document_domain=args.domain, language=args.language, tree_path=args.tree_path, slicer_model=args.slicer_model, topic_model=args.topic_model, embedding_model=args.embedding_model,
        chat_url=args.chat_url, embedding_url=args.embedding_url, related_index=args.related_index or None,
        use_llm_pipeline=off(args.no_llm_pipeline), balance_per_document=off(args.no_balance_docs), balance_true_false=off(args.no_balance_tf),
    )


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    config = config_of(args)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s", handlers=[logging.StreamHandler(), logging.FileHandler(config.log_path, encoding="utf-8")])
    if args.fresh:
        sinks.wipe(config.slicer_cache_dir, config.tree_path, config.parsed_path)
    spark = SparkSession.builder.appName("folioquest").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        entries = pipeline.run_pipeline(spark, args.folder, config, qa_only=args.qa_only)
        sinks.save_dataset(entries, config.output_path)
        sinks.save_html(entries, config.output_path)
    except Exception:
        logging.getLogger("folioquest").exception("the run failed")
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
