"""Dense numbers over a global order without a window over all rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioquest.functions import storage


def dense_ids(df: DataFrame, order: list[str], name: str, partitions: int | None = None) -> DataFrame:
    """Numbers from 0 in the given order: rows are dealt by range and stored, each partition is counted, and the sums of the counts before it are its first number. The driver sees one number a partition."""
    df = storage.checkpoint(df)  # dealing by range reads the rows twice, once for its samples
    dealt = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    rows = storage.checkpoint(dealt.sortWithinPartitions(*order)).withColumn("__at", F.monotonically_increasing_id())
    part = F.shiftright("__at", 33)
    counts = sorted(rows.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    first, before = {}, 0
    for p, n in counts:
        first[p] = before
        before += n
    starts = F.create_map(*[F.lit(x) for kv in first.items() for x in kv])[part] if first else F.lit(0)
    return rows.withColumn(name, (starts + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).cast("long")).drop("__at")


def first_numbers(counts: DataFrame, key: str, n: str, name: str, partitions: int | None = None) -> DataFrame:
    """Adds how many rows all keys before a key have together, for rows with a distinct key and a count. Only these rows are stored and dealt by range."""
    dealt = counts.repartitionByRange(partitions, key) if partitions else counts.repartitionByRange(key)
    rows = storage.checkpoint(dealt).withColumn("__part", F.spark_partition_id())
    sums = sorted(rows.groupBy("__part").agg(F.sum(n).alias("n")).collect())  # one row a partition
    first, before = {}, 0
    for p, m in sums:
        first[p] = before
        before += m
    starts = F.create_map(*[F.lit(x) for kv in first.items() for x in kv])[F.col("__part")] if first else F.lit(0)
    upto = F.sum(n).over(Window.partitionBy("__part").orderBy(key).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn(name, (starts + upto - F.col(n)).cast("long")).drop("__part")


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key as a table, from batches in which a key's rows follow each other."""
    held, last = [], None
    for batch in batches:
        keys, start = batch.column(key).to_pylist(), 0
        for k, value in enumerate(keys):
            if (held or k) and value != last:
                if k > start:
                    held.append(batch.slice(start, k - start))
                yield pa.Table.from_batches(held)
                held, start = [], k
            last = value
        if len(keys) > start:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def folded(df: DataFrame, key: str, order: list[str], fold: Callable[[pa.Table], pa.Table], schema, sent: int = 4096) -> DataFrame:
    """``fold`` of the rows of each key in order, nulls first. Keys follow each other in one stream a task; with applyInArrow each small group is a stream of its own, which costs more than most folds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for own in groups(batches, key):
            held.append(fold(own))
            rows += len(own)
            if rows >= sent:
                yield from pa.concat_tables(held).combine_chunks().to_batches()
                held, rows = [], 0
        if held:
            yield from pa.concat_tables(held).combine_chunks().to_batches()

    return df.repartition(key).sortWithinPartitions(key, *order).mapInArrow(run, schema)
