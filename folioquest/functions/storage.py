"""Where intermediate rows and kept answers go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage in the folder that ``spark.checkpoint.dir`` names; one of our own only where it names none and all run on one machine."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="folioquest-rows-"))
    return df.checkpoint(eager=True)


def batches(spark: SparkSession, folder: str) -> list[str]:
    """The batches below a folder that were written as a whole."""
    top = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(top)] if fs.exists(top) else []
    return sorted(n for n in names if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS")))


def remembered(asked: DataFrame, folder: str | None, make: Callable[[DataFrame | None], DataFrame]) -> DataFrame:
    """``make`` of (doc_id), or of all without a folder, for what the folder has no answer to; the rest comes from there.

    asked: doc_id and ``ask``, a hash of all that an answer depends on. ``make`` gives rows with doc_id and ``failed``, none
    for a document without results. Answers are kept in batches that count as a whole, one row at least for each
    ask; if any row of a document failed, what it gave is used this time and not kept. Of asks that two runs answered at
    once, the first batch by its name counts.
    """
    if folder is None:
        return make(None).drop("failed")
    spark, known = asked.sparkSession, batches(asked.sparkSession, folder)
    old = None
    if known:
        every = spark.read.parquet(*[f"{folder}/{b}" for b in known])
        old = every.join(every.groupBy("ask").agg(F.min("batch").alias("batch")), ["ask", "batch"]).drop("batch")
    new = asked if old is None else asked.join(old.select("ask").distinct(), "ask", "left_anti")
    one = checkpoint(new.groupBy("ask").agg(F.min("doc_id").alias("doc_id")))
    made = checkpoint(make(one.select("doc_id")).join(one, "doc_id").drop("doc_id"))
    failed = made.where("failed").select("ask").distinct()
    batch = uuid.uuid4().hex
    kept = one.select("ask").join(failed, "ask", "left_anti").join(made.drop("failed").withColumn("found", F.lit(True)), "ask", "left")
    kept.withColumn("batch", F.lit(batch)).write.parquet(f"{folder}/{batch}")
    rows = spark.read.parquet(f"{folder}/{batch}").drop("batch")
    rows = rows if old is None else rows.unionByName(old)
    rows = rows.where("found").drop("found").unionByName(made.join(failed, "ask").drop("failed"))
    return asked.select("doc_id", "ask").join(rows, "ask").drop("ask")
