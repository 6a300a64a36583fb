"""Best-fit packing by exact complements.

The plan is made over the histogram of piece lengths, which has at most ``capacity`` entries at any corpus size.
The lengths that occur and the sums of every two of them are indexed once. Lengths are taken from the longest down. For
each, the gap it leaves is looked up among single lengths, sums of two, and sums of three (one length, and what the
index has for the rest), and every combination that fills the gap exactly is consumed as often as the counts allow.
What remains goes to the tightest open sequences that have room. A plan holds *patterns* (lengths and how often the
pattern is used), so its size follows the number of distinct lengths, not the number of pieces.

Each piece gets a rank among those of its length: a count for each length and hash bucket, running sums over the
buckets, and a row number inside a bucket, so no length is gathered in one task. The rank names its slot in the plan.

Null and empty texts are one token (the end id). Equal pieces may take each other's slots; repeated rows are packed
as rows of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioquest.llm import bpe, common

CAPACITY = 2048
END = 0
BUCKETS = 256
SPECIAL = "<|endoftext|>"

Pattern = tuple[tuple[int, int], ...]


@functools.lru_cache(2)
def tokenizer(name: str):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


def token_ids(text: str) -> list[int]:
    """Ids of byte_bpe_50k.json. Its rank file names the same ids and is several times faster; only the special token's string is known to the tokenizer alone."""
    if SPECIAL in text:
        return tokenizer("byte_bpe_50k.json").encode(text, add_special_tokens=False).ids
    return bpe.encode(bpe.encoding("byte_bpe_50k.tiktoken"), text)


def pieces(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Whole documents of up to ``capacity`` tokens, end id included; longer ones in pieces of ``capacity``, the first of them shorter if need be."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part, rows = batch.slice(lo, 1024), []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    data = np.array([*token_ids(text), END], "<u4").tobytes()
                    n = len(data) // 4
                    ends = range(n % capacity or capacity, n + 1, capacity)
                    start = 0
                    for k, end in enumerate(ends):
                        rows.append((doc_id, k, start, end - start, zlib.crc32(data[4 * start : 4 * end])))
                        start = end
                cols = list(zip(*rows, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return common.keyed_text(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class PairSums:
    """The first parts (not less than the second) of all pairs of lengths, by their sum, longest first."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        at, other = np.tril_indices(len(lengths))
        first, sums = lengths[at], lengths[at] + lengths[other]
        own = np.flatnonzero(sums < capacity)
        own = own[np.lexsort((-first[own], sums[own]))]
        self.first = first[own]
        self.bounds = np.searchsorted(sums[own], np.arange(capacity + 1))

    def __getitem__(self, total: int) -> np.ndarray:
        return self.first[self.bounds[total] : self.bounds[total + 1]]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Patterns ((length, times), ...) and how many sequences use each; all counts are used up."""
    have = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        have[length] = n
    patterns: list[tuple[Pattern, int]] = []
    index = PairSums(np.flatnonzero(have), capacity)

    def take(lengths: list[int]) -> bool:
        need = Counter(lengths)
        times = min(have[x] // k for x, k in need.items())
        if times > 0:
            for x, k in need.items():
                have[x] -= times * k
            patterns.append((tuple(sorted(need.items(), reverse=True)), int(times)))
        return times > 0

    def pairs(total: int, most: int) -> np.ndarray:
        """First parts, longest first, of the available pairs with that sum."""
        first = index[total]
        return first[(first <= most) & (have[first] > 0) & (have[total - first] > 0)]

    left: dict[int, int] = {}
    if have[capacity]:
        take([capacity])
    for length in range(capacity - 1, 0, -1):
        gap = capacity - length
        if have[length] and gap <= length and have[gap]:
            take([length, gap])
        while have[length] and any(take([length, int(a), gap - int(a)]) for a in pairs(gap, length)):
            pass
        for a in range(min(gap - 2, length), 0, -1):
            if not have[length]:
                break
            if have[a]:
                for b in pairs(gap - a, a):
                    take([length, a, int(b), gap - a - int(b)])
                    if not (have[length] and have[a]):
                        break
        if have[length]:
            # nothing among the shorter lengths fills this gap any more; they only get fewer
            left[length] = int(have[length])
            have[length] = 0
    return patterns + _best_fit(left, capacity)


def _best_fit(left: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Longest first, each into the fullest open sequences with room; sequences filled alike are handled as one."""
    open_: dict[int, Counter[Pattern]] = {}
    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            room = min((g for g in open_ if g >= length), default=None)
            if room is None:
                group, times, base = max(1, capacity // length), n, ()
                room = capacity
            else:
                base, times = next(iter(open_[room].items()))
                group = room // length
            group = min(group, n)
            used = min(times, n // group)
            if base or room != capacity:
                open_[room][base] -= used
                if not open_[room][base]:
                    del open_[room][base]
                if not open_[room]:
                    del open_[room]
            gap = room - group * length
            open_.setdefault(gap, Counter())[(*base, (length, group))] += used
            n -= used * group
    return [(p, n) for group in open_.values() for p, n in group.items()]


def slots(patterns: list[tuple[Pattern, int]]) -> dict[str, np.ndarray]:
    """For runs of ranks of one length: the first rank, the pattern's first sequence, pieces a sequence, the first one's offset. Sorted by length and rank."""
    rows, next_rank, sequence = [], Counter(), 0
    for items, times in patterns:
        offset = 0
        for length, k in items:
            rows.append((length, next_rank[length], sequence, k, offset))
            next_rank[length] += times * k
            offset += k * length
        sequence += times
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "sequence", "each", "offset"), columns, strict=True))


def ranked(parts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Adds ``rank``, counted from 0 for each length."""
    keyed = parts.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    sums = keyed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")) - 1
    return keyed.withColumn("within", within).join(sums.select("length", "bucket", before.alias("before")), ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("within")).drop("bucket", "before", "within")


def pack(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence and its place there. Of the corpus, the driver sees only the number of pieces of each length."""
    parts = common.checkpoint(pieces(docs, capacity))
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = slots(plan(counts, capacity))
    key = table["length"] << 44 | table["rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (np.asarray(batch.column(c)) for c in ("length", "rank"))
            at = np.searchsorted(key, length << 44 | rank, "right") - 1
            place = rank - table["rank"][at]
            each = table["each"][at]
            sequence = table["sequence"][at] + place // each
            offset = table["offset"][at] + place % each * length
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    # a million pieces a bucket at most, even if all had one length
    out = ranked(parts, max(BUCKETS, sum(counts.values()) >> 20)).select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return out.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.documents(spark, sf_dir))


QUERIES = {"op4_best_fit_packing": op4_best_fit_packing}
ORACLES: dict[str, str] = {}
