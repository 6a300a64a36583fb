"""How many questions each leaf gets.

Global order is needed only for a remainder smaller than the target or the number of leaves, so it is found by a
top-k, never by a window over all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioquest.functions import fixed

BROADCAST_ROWS = 10_000


def _one_more(rows: DataFrame, first: DataFrame, key: str, n: int, base: int) -> DataFrame:
    """Adds ``quota``: base, and one more for the keys in ``first`` (n rows)."""
    marked = first.select(key).withColumn("more", F.lit(1))
    marked = F.broadcast(marked) if n <= BROADCAST_ROWS else marked
    return rows.join(marked, key, "left").withColumn("quota", (F.lit(base) + F.coalesce("more", F.lit(0))).cast("long")).drop("more")


def round_robin(leaves: DataFrame, target: int, order: str = "leaf_idx") -> DataFrame:
    """Equal shares, one more for the first ``target % leaves``; leaves without a share go. ``order`` names a unique column."""
    n = leaves.count()
    if not n:
        return leaves.withColumn("quota", F.lit(0).cast("long"))
    base, rest = divmod(target, n)
    first = leaves.select(order).orderBy(order).limit(rest)
    return _one_more(leaves, first, order, rest, base).where("quota > 0")


def balanced(leaves: DataFrame, target: int, order: str = "leaf_idx") -> DataFrame:
    """Equal shares for the sources, in order of their first leaf; within one by content length, 100 at least, rounded half to even, and 1 at least. Shares need not add up to the target."""
    weight = F.greatest(F.coalesce(F.length("content"), F.lit(0)), F.lit(100))
    sources = leaves.groupBy("source").agg(F.sum(weight).alias("total_weight"), F.min(order).alias("first_leaf"))
    n = sources.count()
    if not n:
        return leaves.withColumn("quota", F.lit(0).cast("long"))
    base, rest = divmod(target, n)
    shared = _one_more(sources, sources.orderBy("first_leaf").limit(rest), "source", rest, base).where("quota > 0").withColumnRenamed("quota", "source_quota")
    joined = leaves.join(shared, "source")
    return joined.withColumn("quota", F.greatest(F.lit(1), F.bround(F.col("source_quota") * weight / F.col("total_weight"))).cast("long")).drop("total_weight", "first_leaf", "source_quota")


def deal_types(rows: DataFrame, number: str) -> DataFrame:
    """The kind and difficulty for a row's number in its batch."""
    kinds, levels = (F.array(*map(F.lit, x)) for x in (fixed.QA_TYPES, fixed.DIFFICULTIES))
    pick = lambda values, n: F.element_at(values, (F.col(number) % n + 1).cast("int"))
    return rows.withColumns({"type": pick(kinds, len(fixed.QA_TYPES)), "difficulty": pick(levels, len(fixed.DIFFICULTIES))})


def target_leaves(num_samples, n_docs, segments):
    """Leaves to ask for in a document: half again its share of the samples, three a segment at most."""
    share = F.greatest(F.floor(F.lit(num_samples) / n_docs), F.lit(1))
    return F.least(F.greatest(share, F.floor(share * 1.5)), 3 * segments).cast("long")
