"""Documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and its result is written as Parquet
and read again before the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from folioquest.llm import common, packing, secrets, simhash, suffixes, toxicity


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go; the classifier learns from the labels of those that are here."""
    return toxicity.reject(docs, toxicity.fit(docs, common.table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by similar five-word shingles one document stays, the one with the smallest id."""
    return simhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of strings of 200 bytes are cut out of the texts; no document goes."""
    return suffixes.keep_first(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found secrets are replaced by a mark; no document goes. What is scanned goes through a ledger in the shared folder."""
    return secrets.redact(docs, ledger=f"{common.shared_folder(spark)}/secret-ledger-{uuid.uuid4().hex}")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack),
]

#: SQL can't express a trained classifier, the hashes, the suffix order or the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Intermediate tables lie in the shared folder and go when the next one is written; the last stage stores what it has read before its result is made."""
    folder = f"{common.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = common.documents(spark, sf_dir), None
    for k, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(path := f"{folder}/{k}-{name}")
        if before:
            common.delete(spark, before)
        docs, before = spark.read.parquet(path), path
    out = common.checkpoint(STAGES[-1][1](spark, docs, sf_dir))
    common.delete(spark, folder)
    return out
