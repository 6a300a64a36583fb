"""SimHash near-duplicates with bit-sliced comparison.

Fingerprints are made once for each document and compared once for each distinct value, by bit planes (see ``planes``).
Two that differ in at most three bits agree wholly on at least one of four 16-bit quarters, so only members of such a
bucket meet. A bucket of more than ``HOT`` members is split by the same argument over the bits it hasn't used yet, as
often as it takes: with twelve bits or fewer left no bucket has more. No member and no link is dropped, and links leave
a task as a spanning forest, never as all pairs. Components come from alternating large-star and small-star rounds on the
cluster.

``one_of_each`` works on five-word shingles and a similarity of 0.8 (see ``shingles``): there two 64-bit fingerprints
differ in about ten bits, give or take three, and no part of the bits would be left to look candidates up by. So
candidates share a rare shingle, are compared by the bit planes of 128-bit fingerprints, and what is within that radius
is checked on the whole sets.

Null and empty texts, and texts of white space only, have fingerprint zero and link like any other. Repeated rows stay
rows of their own; a null id takes part but can't name a component. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioquest.llm import common, planes, shingles

RADIUS = 3
SHINGLE = 3
HOT = 4096
LAST_BITS = 12
ROUNDS, FEW = 3, 4
BATCH = 1 << 18
SLICE = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Majority of the shingles' XXH64 (seed 42), as an unsigned number."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    joined, hash_of = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    first, last = starts[:n].tolist(), ends[min(shingle, len(words)) - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, SLICE):
        part = np.array([hash_of(joined[a:b], 42) for a, b in zip(first[lo : lo + SLICE], last[lo : lo + SLICE], strict=True)], "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long."""

    def make():
        def row(doc_id, text):
            fp = fingerprint(text, shingle)
            return doc_id, fp - (fp >> 63 << 64)

        return row

    return common.row_map(common.keyed_text(docs), make, "doc_id long, fp long")


def parts(bits: list[int], n: int = RADIUS + 1) -> list[tuple[int, list[int]]]:
    """The bits in n parts: each part's mask and the bits left beside it."""
    out = []
    for k in range(n):
        own = bits[len(bits) * k // n : len(bits) * (k + 1) // n]
        out.append((sum(1 << b for b in own), [b for b in bits if b not in own]))
    return out


def masks(levels: int) -> list[tuple[int, ...]]:
    """Chains of masks: an entry of length k is a bucket's mask at level k, with those that it was split from before it."""
    level: list[tuple[tuple[int, ...], list[int]]] = [((), list(range(64)))]
    for _ in range(levels):
        level = [((*chain, (chain[-1] if chain else 0) | mask), rest) for chain, bits in level for mask, rest in parts(bits)]
    return [chain for chain, _ in level]


def _signed(x: int) -> int:
    return x - (x >> 63 << 64)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Input: mask, key, fp, sorted by mask and key. Output: links a, b."""
    held: list[np.ndarray] = []

    def links(rows: np.ndarray) -> pa.RecordBatch:
        new = np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))
        values = rows[:, 2].astype(np.int64)
        label = planes.forest(np.cumsum(new), values.view(np.uint64), RADIUS)
        own = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(values[own]), pa.array(values[label[own]])], names=["a", "b"])

    for batch in batches:
        held.append(np.stack([np.asarray(c) for c in batch.columns], axis=1))
        if sum(map(len, held)) >= BATCH:
            rows = np.concatenate(held)
            last = rows[-1, :2]
            cut = len(rows) - 1
            while cut and (rows[cut - 1, :2] == last).all():
                cut -= 1
            if cut:
                yield links(rows[:cut])
            held = [rows[cut:]]
    if held and sum(map(len, held)):
        yield links(np.concatenate(held))


def links(values: DataFrame, hot: int = HOT) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints ``fp``; each bucket's members stay connected as they are under all its links."""
    spark = values.sparkSession

    def bucketed(rows: DataFrame, chains: list[tuple[int, ...]]) -> DataFrame:
        level = len(chains[0])
        if level == 1:
            entries = [F.struct(F.lit(i).alias("mask"), (F.col("fp").bitwiseAND(F.lit(_signed(c[-1])))).alias("key")) for i, c in enumerate(chains)]
            return rows.select("fp", F.explode(F.array(*entries)).alias("e")).select("e.mask", "e.key", "fp")
        fan = RADIUS + 1
        above = F.create_map(*[x for p in range(len(chains) // fan) for x in (F.lit(p), F.array(*[F.lit(_signed(c[-1])) for c in chains[fan * p : fan * p + fan]]))])
        opened = rows.select("mask", "fp", F.posexplode(above[F.col("mask")]).alias("k", "m"))
        return opened.select((F.col("mask") * fan + F.col("k")).alias("mask"), F.col("fp").bitwiseAND(F.col("m")).alias("key"), "fp")

    found, rows, level, done = None, values.select("fp"), 0, False
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while not done:
        level += 1
        chains = masks(level)
        rows = bucketed(rows, chains)
        cold = rows
        # as many values as a bucket can have at all
        done = 1 << 64 - min(c[-1].bit_count() for c in chains) <= max(hot, 1 << LAST_BITS)
        if not done:
            large = common.checkpoint(rows.groupBy("mask", "key").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("mask", "key"))
            if large.isEmpty():
                done = True
            else:
                cold = rows.join(large, ["mask", "key"], "left_anti")
                rows = rows.join(large, ["mask", "key"], "left_semi")
        made = cold.select("mask", "key", "fp").repartition(n, "mask", "key").sortWithinPartitions("mask", "key", "fp").mapInArrow(_compare, "a long, b long")
        found = made if found is None else found.unionByName(made)
    return found


def connected(edges: DataFrame) -> DataFrame:
    """node, root for every node of the edges (a, b); the root is the component's smallest node. Alternates large-star and small-star until nothing changes."""

    def stars(e: DataFrame, small: bool) -> DataFrame:
        both = e.select("a", "b") if small else e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        joined = both.join(low, "a")
        if small:
            moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        else:
            moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.where("a <> b").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())

    now = common.checkpoint(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before, after = None, state(now)
    while before != after and after[0]:
        now = common.checkpoint(stars(stars(now, small=False), small=True))
        before, after = after, state(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def grouped(fps: DataFrame) -> DataFrame:
    """Adds ``root``, one fingerprint for each component, and component_id to rows (doc_id, fp, ...), which should be stored."""
    values = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = connected(links(values))
    known = values.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    smallest = known.groupBy("root").agg(F.min("first").alias("component_id"))
    return fps.join(known.join(smallest, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id reachable over links of at most three bits."""
    return grouped(common.checkpoint(fingerprints(docs, shingle))).select("doc_id", "fp", "component_id")


def linked(shared: DataFrame, sets: DataFrame, rounds: int = ROUNDS, few: int = FEW) -> DataFrame:
    """node, root of the components of two sets or more, from shared members and the sets (s, set).

    First each member is compared with ``shingles.CHOSEN`` of its bucket, which joins large groups without looking at all
    their pairs; again with others while more than ``few`` pairs a member are near each other and still lie in
    different components, but ``rounds`` times at most. Then all pairs are compared that do.
    """
    n, links, tried, rows = shared.count(), None, None, shared.withColumn("root", F.col("s"))
    roots = last = None
    for k in range(rounds + 1):
        last = k == rounds or k > 0 and shingles.near_pairs(rows) <= few * n
        pairs = shingles.candidates(rows, None if last else k)
        pairs = common.checkpoint(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))
        tried = pairs if tried is None else tried.unionByName(pairs)
        whole = pairs.join(sets.select(F.col("s").alias("b"), F.col("set").alias("set_b")), "b").join(sets.select(F.col("s").alias("a"), F.col("set").alias("set_a")), "a")
        new = common.checkpoint(whole.select("a", "b", "set_a", "set_b").mapInArrow(shingles.check, "a long, b long"))
        links = new if links is None else links.unionByName(new)
        if roots is None or not new.isEmpty():
            roots = common.checkpoint(connected(links))
        if last:
            break
        rows = common.checkpoint(shared.join(roots.withColumnRenamed("node", "s"), "s", "left").withColumn("root", F.coalesce("root", "s")))
    return roots


def one_of_each(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row of each group of texts linked by similar sets of five-word shingles, with all its columns: the least by doc_id (nulls first), then by a hash of the text."""
    texts = common.keyed_text(docs)
    made = common.checkpoint(shingles.described(texts))
    # one row a set: copies are summed up where they are read
    rows = made.groupBy("doc_id", "h", "s").agg(F.count("*").alias("n"))
    each = common.checkpoint(rows.groupBy("s").agg(F.min(F.struct("doc_id", "h", "n")).alias("k")).select("s", "k.*"))
    values = made.groupBy("s").agg(*[F.first(c).alias(c) for c in ("size", "prefix", "f0", "f1")])
    found = shingles.shared_members(values.select("s", "size", "prefix"))
    shared = common.checkpoint(found.join(values.select("s", "f0", "f1"), "s"))
    wanted = common.checkpoint(each.join(shared.select("s").distinct(), "s", "left_semi"))
    sets = common.checkpoint(shingles.sets_of(texts, wanted))
    roots = linked(shared, sets, rounds)
    grouped = each.join(roots.withColumnRenamed("node", "s"), "s", "left").withColumn("root", F.coalesce("root", "s"))
    return least_of_each(docs, grouped)


def least_of_each(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of docs that are least by doc_id and h, the text's hash, among those of a root in groups (doc_id, h, n, root)."""
    least = groups.groupBy("root").agg(F.min(F.struct("doc_id", "h", "n")).alias("k"))
    kept = common.checkpoint(least.select("k.*"))
    whole = docs.select(common.whole_row(docs), F.col("doc_id").cast("long").alias("own_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("own_h"))
    rows = whole.join(kept.hint("shuffle_hash"), F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_h") == F.col("h")))
    once = rows.where("n = 1").select("row.*")
    if kept.where("n > 1").isEmpty():
        return once
    return once.unionByName(rows.where("n > 1").dropDuplicates(["own_id", "own_h"]).select("row.*"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(common.documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op10_simhash": op10_simhash}
ORACLES: dict[str, str] = {}
