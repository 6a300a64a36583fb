"""Candidates and checks for near copies by word shingles: sets of five-word shingles with a Jaccard similarity of 0.8 or more.

Candidates come from prefixes, which miss none: in any one order of all shingles, the first ``n - ceil(0.8 n) + 1`` of two
sets that are similar enough have a member in common. The order puts rare shingles first, by counts in a table of fixed
size; collisions there cost time only. Sets that share a prefix member meet in its bucket. There their 128-bit
fingerprints are compared by bit planes: of two similar sets a bit differs with a chance of 0.19 at most (4 and 5
shingles; 0.15 for large sets), so more than ``RADIUS`` of 128 differ with a chance under 5e-9; of unrelated ones 64
differ, give or take six. What is left is checked on the whole sets.

Words are those of ``simhash``. A text of less than five words is one shingle; null, empty and blank texts have none and
are copies of each other. Repeated rows are one set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioquest.llm import common, planes, repeats

SHINGLE = 5
#: Similarity as a fraction.
SAME, OF = 4, 5
COUNTER_BITS, COUNTER_RANGES = 20, 64
LARGE, CHOSEN = 64, 2
RADIUS = 54
SLICE = 1 << 16
MARK_BITS = 22
MOST_WORDS = 1 << 20
BATCH = 1 << 18


def shingled(texts: list[str]) -> list[np.ndarray]:
    """Each text's distinct shingles, as sorted 64-bit hashes."""
    (hashes,), sizes = repeats.word_hashes([t.encode().lower() for t in texts])
    # hashes of as many words as a shingle has; those that reach into the next text aren't used
    long = hashes
    for k in range(1, SHINGLE):
        long = repeats.mix(long[: max(0, len(hashes) - k)], hashes[k:])
    out, at = [], 0
    for n in sizes.tolist():
        if n >= SHINGLE:
            out.append(np.unique(long[at : at + n - SHINGLE + 1]))
        else:
            own = hashes[at : at + min(n, 1)]
            for k in range(1, n):
                own = repeats.mix(own, hashes[at + k : at + k + 1])
            out.append(own)
        at += n
    return out


def _range_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def rarity(docs: DataFrame) -> np.ndarray:
    """How many of all shingles of (doc_id, text) fall on each of 2^20 counters."""
    width = (1 << COUNTER_BITS) // COUNTER_RANGES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNTER_BITS, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                found = np.concatenate(shingled(batch.slice(lo, 1024).column("text").to_pylist()))
                counts += np.bincount(_range_of(found), minlength=len(counts))
        parts = np.minimum(counts, 0xFFFFFFFF).astype("<u4").reshape(COUNTER_RANGES, width)
        yield pa.RecordBatch.from_arrays([pa.array(range(COUNTER_RANGES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["part", "n"])

    def merge(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, "<u4").astype(np.int64) for x in table.column("n").to_pylist())
        return pa.table({"part": table.column("part")[:1], "n": pa.array([np.minimum(total, 0xFFFFFFFF).astype("<u4").tobytes()], pa.binary())})

    out = np.zeros((COUNTER_RANGES, width), np.uint32)
    for r in docs.select("text").mapInArrow(run, "part int, n binary").groupBy("part").applyInArrow(merge, "part int, n binary").collect():  # 4 MB
        out[r["part"]] = np.frombuffer(r["n"], "<u4")
    return out.ravel()


def prefix(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The shingles, rarest first, of which any set that is similar enough has one among its own."""
    n = len(shingles)
    return shingles[np.lexsort((shingles, counts[_range_of(shingles)]))[: n - -(-SAME * n // OF) + 1]] if n else shingles


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return OF * both >= SAME * (len(a) + len(b) - both)


def fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    """The set's 128-bit SimHash, as two signed numbers."""
    ones = np.zeros(128, np.int64)
    for lo in range(0, len(shingles), SLICE):
        part = shingles[lo : lo + SLICE]
        both = np.stack([repeats.mix(part), repeats.mix(part ^ np.uint64(0x9E3779B97F4A7C15))], axis=1)
        ones += np.unpackbits(both.view(np.uint8).reshape(len(part), 16), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    a, b = np.packbits(2 * ones > len(shingles), bitorder="little").view("<i8").tolist()
    return a, b


def described(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text), s (hash of the set), size, prefix and fingerprint (f0, f1) of every row."""
    import xxhash

    counts = docs.sparkSession.sparkContext.broadcast(rarity(docs))  # 4 MB
    names = ("doc_id", "h", "s", "size", "prefix", "f0", "f1")
    signed = lambda x: x - (x >> 63 << 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                texts = part.column("text").to_pylist()
                sets = shingled(texts)
                h = [signed(xxhash.xxh64_intdigest(t.encode(), 42)) for t in texts]
                s = [signed(xxhash.xxh64_intdigest(x.tobytes(), 42)) for x in sets]
                prints = np.array([fingerprint(x) for x in sets], np.int64).reshape(-1, 2)
                cols = [part.column("doc_id"), pa.array(h, pa.int64()), pa.array(s, pa.int64()), pa.array(list(map(len, sets)), pa.int64()), pa.array([prefix(x, counts.value).tobytes() for x in sets], pa.binary()), pa.array(prints[:, 0]), pa.array(prints[:, 1])]
                yield pa.RecordBatch.from_arrays(cols, names=list(names))

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, h long, s long, size long, prefix binary, f0 long, f1 long")


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Input: s, size, prefix. Output: a row for each member of the prefix, with its place."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            part = batch.slice(lo, 1024)
            tokens = [np.frombuffer(p, np.int64) for p in part.column("prefix").to_pylist()]
            n = np.array([len(t) for t in tokens])
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            cols = [np.concatenate(tokens), np.repeat(np.asarray(part.column("s")), n), np.repeat(np.asarray(part.column("size")), n), place]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["token", "s", "size", "place"])


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Rows sorted by their first column, in blocks that don't divide a bucket."""
    held: list[np.ndarray] = []
    for batch in batches:
        held.append(np.stack([np.asarray(c) for c in batch.columns], axis=1))
        if sum(map(len, held)) >= BATCH:
            rows = np.concatenate(held)
            if cut := int(np.searchsorted(rows[:, 0], rows[-1, 0])):
                yield rows[:cut]
            held = [rows[cut:]]
    if held and sum(map(len, held)):
        yield np.concatenate(held)


def _can_match(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether pairs of rows (token, s, size, place, ...) of a bucket can be similar enough if the token is the first in common."""
    most = np.minimum(a[:, 2] - a[:, 3], b[:, 2] - b[:, 3])
    return OF * most >= SAME * (a[:, 2] + b[:, 2] - most)


def _open_match(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The same for rows (token, s, size, place, root, f0, f1) of different components."""
    return (a[:, 4] != b[:, 4]) & _can_match(a, b)


def _with_match(rows: np.ndarray) -> np.ndarray:
    """Rows for which another of their bucket can match. In large buckets all that aren't alone stay."""
    first = np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0]))
    sizes = np.diff(np.append(first, len(rows)))
    size_of = np.repeat(sizes, sizes)
    place, keep = np.arange(len(rows)) - np.repeat(first, sizes), size_of > LARGE
    for step in range(1, min(LARGE, int(sizes.max()))):
        at = np.flatnonzero((size_of - place > step) & (size_of <= LARGE))
        at = at[_can_match(rows[at], rows[at + step])]
        keep[at] = keep[at + step] = True
    return keep


def _off_centre(rows: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """In how many bits each fingerprint differs from the majority of its bucket."""
    prints = np.ascontiguousarray(rows[:, 5:7]).view(np.uint8)
    out = np.empty(len(rows), np.int64)
    held = np.zeros((len(first), 128), np.int32)
    bucket = np.repeat(np.arange(len(first)), sizes)
    for lo in range(0, len(rows), SLICE):
        part, own = np.unpackbits(prints[lo : lo + SLICE], axis=1), bucket[lo : lo + SLICE]
        at = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        held[own[at]] += np.add.reduceat(part, at, dtype=np.int32)
    centre = np.packbits(2 * held > sizes[:, None], axis=1)
    for lo in range(0, len(rows), SLICE):
        out[lo : lo + SLICE] = np.bitwise_count(prints[lo : lo + SLICE] ^ centre[bucket[lo : lo + SLICE]]).sum(axis=1)
    return out


def _pairs(rows: np.ndarray, salt: int | None) -> Iterator[np.ndarray]:
    """Pairs of s from whole buckets: all with all if there is no salt, else every member with ``CHOSEN`` of its bucket. With an even salt these are the nearest to the majority of the bucket's fingerprints, as the origin of many copies is, else the first by a salted hash."""
    if salt is None:
        group = np.cumsum(np.append(True, rows[1:, 0] != rows[:-1, 0]))
        for i, j in planes.near_pairs(group, np.ascontiguousarray(rows[:, 5:7]).view(np.uint64), RADIUS):
            yield np.stack([rows[i, 1], rows[j, 1]], axis=1)[_open_match(rows[i], rows[j])]
        return
    first = np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0]))
    sizes = np.diff(np.append(first, len(rows)))
    # with a hash of the member itself, so that buckets with the same members choose alike
    rank = repeats.mix(rows[:, 1].copy().view(np.uint64), np.full(len(rows), salt, np.uint64))
    dealt = rows[np.lexsort((rank, _off_centre(rows, first, sizes), rows[:, 0]) if salt % 2 == 0 else (rank, rows[:, 0]))]
    place = np.arange(len(dealt)) - np.repeat(first, sizes)
    for k in range(CHOSEN):
        at = np.flatnonzero(place > k)
        a, b = dealt[np.repeat(first, sizes)[at] + k], dealt[at]
        near = np.bitwise_count((a[:, 5:7] ^ b[:, 5:7]).view(np.uint64)).sum(axis=1) <= RADIUS
        yield np.stack([a[:, 1], b[:, 1]], axis=1)[near & _open_match(a, b)]


def _distinct(pairs: list[np.ndarray]) -> np.ndarray:
    found = np.sort(np.concatenate(pairs), axis=1)
    return np.unique(found, axis=0) if len(found) else found


def candidates(shared: DataFrame, salt: int | None) -> DataFrame:
    """Distinct pairs (a, b) from the buckets of (token, s, size, place, root, f0, f1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_bucket(batches):
            held: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
            for pairs in _pairs(rows, salt):
                held.append(pairs)
                if sum(map(len, held)) >= BATCH:
                    held = [_distinct(held)]
                    if len(held[0]) >= BATCH // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(held[0][:, k]) for k in (0, 1)], names=["a", "b"])
                        held = [np.zeros((0, 2), np.int64)]
            found = _distinct(held)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, k]) for k in (0, 1)], names=["a", "b"])

    return _bucketed(shared).mapInArrow(run, "a long, b long").distinct()


def _bucketed(shared: DataFrame) -> DataFrame:
    n = int(shared.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return shared.select("token", "s", "size", "place", "root", "f0", "f1").repartition(n, "token").sortWithinPartitions("token")


def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Input: a, b and both sets. Output: the pairs that are similar enough."""
    for batch in batches:
        sets = zip(*(batch.column(c).to_pylist() for c in ("set_a", "set_b")), strict=True)
        own = pa.array([similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in sets], pa.bool_())
        yield batch.select(["a", "b"]).filter(own)


def shared_members(values: DataFrame) -> DataFrame:
    """token, s, size, place of the prefixes of (s, size, prefix), where another set of the token can match."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_bucket(batches):
            rows = rows[_with_match(rows)]
            yield pa.RecordBatch.from_arrays([pa.array(rows[:, k]) for k in range(4)], names=["token", "s", "size", "place"])

    n = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    opened = values.where("size > 0").select("s", "size", "prefix").mapInArrow(_open, "token long, s long, size long, place long")
    return opened.repartition(n, "token").sortWithinPartitions("token").mapInArrow(run, "token long, s long, size long, place long")


def near_pairs(rows: DataFrame) -> int:
    """How many pairs ``candidates`` would find among all, counted in each bucket they share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _by_bucket(batches):
            yield pa.RecordBatch.from_arrays([pa.array([sum(map(len, _pairs(part, None)))], pa.int64())], names=["n"])

    return int(_bucketed(rows).mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """s and set for wanted (s, doc_id, h, n), where n rows of docs have that id and text. A bitmap of fixed size spares most other texts."""
    marks = np.zeros(1 << MARK_BITS, bool)
    marks[wanted.select(F.col("h").bitwiseAND((1 << MARK_BITS) - 1).alias("m")).distinct().toArrow().column("m").to_numpy()] = True  # at most 2^22 rows
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(marks, bitorder="little"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        bits = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part, rows = batch.slice(lo, 1024), []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    h = xxhash.xxh64_intdigest(text.encode(), 42)
                    at = h & (1 << MARK_BITS) - 1
                    if bits[at >> 3] >> (at & 7) & 1:
                        rows.append((doc_id, h - (h >> 63 << 64), text))
                sets = shingled([t for _, _, t in rows])
                cols = [[i for i, _, _ in rows], [h for _, h, _ in rows], [x.tobytes() for x in sets]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["doc_id", "h", "set"])

    found = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, h long, set binary")
    keys = wanted.select("s", F.col("doc_id").alias("__id"), F.col("h").alias("__h"), "n")
    found = found.join(keys, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("__h")))
    if wanted.where("n > 1").isEmpty():
        return found.select("s", "set")
    return found.select("s", "set").dropDuplicates(["s"])
