"""What the exact substring operators and language-model scoring share: blocks of rows, and counting keys that blocks hold.

Rows are dealt to *blocks* of text by a hash of their place in the input, so repeats of one row spread like any others.
A block is worked on as a whole, so its rows in Spark are few: for each range of key values, one row with the block's
distinct keys, sorted. A *bucket* gathers one range from all blocks, finds the keys that occur twice or more anywhere,
and answers each block with one code for each of its keys, in the same order. A key that all texts share reaches its
bucket once a block.

Blocks have ``BLOCK_BYTES`` and buckets take what ``BUCKET_BYTES`` of text send, and from ``SIDE_BYTES`` on both grow with
the square root of the text, so that the rows exchanged, blocks times buckets, grow in proportion to it. At ``MOST_SIDE``
times their first size they stay as they are, which bounds a task's memory, and rows grow faster until each holds one
key.

The blocks' texts are shuffled once; later passes over them read the same shuffle files. Rows must come in the same order
each time a partition of the input is read, as those of a stored table do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioquest.llm import common

BLOCK_BYTES = 1 << 20
BUCKET_BYTES = 4 << 20
SIDE_BYTES, MOST_SIDE = 64 << 20, 16

REPEATED, FIRST = 1, 2

ROWS = "bucket int, block int, kind int, a binary, b binary, flags binary, rank binary"
CODES = "block int, bucket int, kind int, codes binary"
ROWS_ARROW = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("kind", pa.int32()), *[(c, pa.binary()) for c in ("a", "b", "flags", "rank")]])
CODES_ARROW = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("kind", pa.int32()), ("codes", pa.binary())])


def side(total: int) -> float:
    """How many times their first size blocks and buckets have for so many bytes of text."""
    return min(MOST_SIDE, max(1.0, math.sqrt(total / SIDE_BYTES)))


def buckets(total: int, size: int | None = None) -> int:
    return max(1, int(total // ((size or BUCKET_BYTES) * side(total))))


def blocked(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, int]:
    """The rows with their block's number in a last column, whose name is free, and the bytes of text they hold."""
    total = docs.select(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).alias("n")).first()["n"]
    n = max(1, math.ceil(total / (BLOCK_BYTES * side(total))))
    return docs.withColumn(common.free_name(docs, "block"), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int")), total


def packed(values: np.ndarray, width: int = 8) -> bytes:
    """The lower ``width`` bytes of 64-bit values, byte by byte, compressed: differences and small values pack well so."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    return len(values).to_bytes(8, "little") + (pa.compress(planes, "zstd", asbytes=True) if planes else b"")


def unpacked(data: bytes, width: int = 8) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    out = np.zeros((n, 8), np.uint8)
    if n:
        out[:, :width] = np.frombuffer(pa.decompress(data[8:], n * width, "zstd", asbytes=True), np.uint8).reshape(width, n).T
    return out.view("<u8").ravel()


def mix(a: np.ndarray, b: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each value, or of each pair."""
    x = a * np.uint64(0x9E3779B97F4A7C15)
    if b is not None:
        x ^= (b ^ b >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def place_in(keys: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """How far into its bucket each key lies, in ``bits`` bits; in the order of the keys."""
    high = (keys >> np.uint64(32)) * np.uint64(buckets) << np.uint64(32)
    both = high + (keys & np.uint64(0xFFFFFFFF)) * np.uint64(buckets)
    return np.where(both < high, ~np.uint64(0), both) >> np.uint64(64 - bits)


_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def word_hashes(texts: list[bytes], seeds: tuple[int, ...] = (1,)) -> tuple[list[np.ndarray], np.ndarray]:
    """A 64-bit hash of each word for each seed, texts end to end, and the number of words of each text.

    Words are found and hashed for all texts at once, eight bytes at a time.
    """
    data = b"\n".join(texts) + bytes(8)
    buf = np.frombuffer(data, np.uint8)[: len(data) - 8]
    space = (buf == 32) | (buf - np.uint8(9) <= 4)
    edges = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    start, end = edges[::2], edges[1::2]
    length = end - start
    eight = np.lib.stride_tricks.as_strided(np.frombuffer(data, np.uint8)[:8].view("<u8"), (len(data) - 7,), (1,))
    out = [mix(length.astype(np.uint64), np.full(len(start), seed, np.uint64)) for seed in seeds]
    open_, at = np.arange(len(start)), 0
    while len(open_):
        part = eight[start[open_] + at] & _MASKS[np.minimum(length[open_] - at, 8)]
        for h in out:
            h[open_] = mix(h[open_], part)
        at += 8
        open_ = open_[length[open_] > at]
    begins = np.cumsum([0, *[len(t) + 1 for t in texts]])
    return out, np.diff(np.searchsorted(start, begins))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the keys' upper halves: sorted keys have sorted buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


@dataclass
class Keys:
    """A block's distinct keys in order; ``of`` has each occurrence's place among them, ``first`` each key's first occurrence, ``many`` marks keys with two or more."""

    a: np.ndarray
    b: np.ndarray | None
    of: np.ndarray
    first: np.ndarray
    many: np.ndarray

    @staticmethod
    def make(a: np.ndarray, b: np.ndarray | None = None) -> Keys:
        order = np.argsort(a, kind="stable") if b is None else np.lexsort((b, a))
        x = a[order]
        new = np.ones(len(x), bool)
        new[1:] = x[1:] != x[:-1]
        if b is not None:
            y = b[order]
            new[1:] |= y[1:] != y[:-1]
        at = np.flatnonzero(new)
        of = np.empty(len(x), np.int64)
        of[order] = np.cumsum(new) - 1
        return Keys(x[at], None if b is None else y[at], of, order[at], np.diff(np.append(at, len(x))) > 1)

    def rows(self, block: int, buckets: int, kind: int = 0, rank: np.ndarray | None = None) -> Iterator[dict]:
        """One row a bucket. ``rank``: each key's place in the corpus, where the first holder is wanted."""
        bounds = np.searchsorted(bucket_of(self.a, buckets), np.arange(buckets + 1))
        for k in np.flatnonzero(np.diff(bounds)):
            own = slice(bounds[k], bounds[k + 1])
            yield {"bucket": int(k), "block": block, "kind": kind, "a": self.a[own].tobytes(), "b": None if self.b is None else self.b[own].tobytes(), "flags": np.packbits(self.many[own]).tobytes(), "rank": None if rank is None else rank[own].tobytes()}


def table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=schema)


@dataclass
class Gathered:
    """A bucket's rows put together. ``row`` has each key's row."""

    rows: list[dict]
    a: np.ndarray
    b: np.ndarray | None
    many: np.ndarray
    rank: np.ndarray | None
    row: np.ndarray

    @staticmethod
    def make(rows: list[dict]) -> Gathered:
        rows = sorted(rows, key=lambda r: r["block"])
        join = lambda c, kind: np.concatenate([np.frombuffer(r[c], kind) for r in rows])
        sizes = [len(r["a"]) // 8 for r in rows]
        many = np.concatenate([np.unpackbits(np.frombuffer(r["flags"], np.uint8), count=n).astype(bool) for r, n in zip(rows, sizes, strict=True)])
        return Gathered(rows, join("a", np.uint64), join("b", np.uint64) if rows[0]["b"] is not None else None, many, join("rank", np.int64) if rows[0]["rank"] is not None else None, np.repeat(np.arange(len(rows)), sizes))

    def codes(self) -> np.ndarray:
        """REPEATED for keys with two occurrences or more; FIRST for the holder of the lowest rank (then block)."""
        order = [self.row, *([self.rank] if self.rank is not None else []), *([self.b] if self.b is not None else []), self.a]
        at = np.lexsort(order)
        x = self.a[at]
        new = np.ones(len(x), bool)
        new[1:] = x[1:] != x[:-1]
        if self.b is not None:
            y = self.b[at]
            new[1:] |= y[1:] != y[:-1]
        group = np.cumsum(new) - 1
        sizes = np.bincount(group)
        repeated = (sizes > 1) | (np.bincount(group, self.many[at]) > 0)
        out = np.zeros(len(x), np.uint8)
        out[at] = repeated[group] * np.uint8(REPEATED) + new * np.uint8(FIRST)
        return out

    def answers(self, codes: np.ndarray) -> Iterator[dict]:
        bounds = np.searchsorted(self.row, np.arange(len(self.rows) + 1))
        for k, r in enumerate(self.rows):
            yield {"block": r["block"], "bucket": r["bucket"], "kind": r["kind"], "codes": codes[bounds[k] : bounds[k + 1]].tobytes()}


def answered(table_: pa.Table, kind: int, n: int) -> np.ndarray:
    """A block's codes of one kind, for its n distinct keys in order."""
    rows = sorted((r for r in table_.to_pylist() if r["kind"] == kind), key=lambda r: r["bucket"])
    return np.frombuffer(b"".join(r["codes"] for r in rows), np.uint8) if rows else np.zeros(n, np.uint8)


def ordered(rows: pa.Table, id_col: str = "doc_id", text_col: str = "text") -> tuple[pa.Table, list[bytes]]:
    """A block's rows by id (nulls first), then text, and the texts as UTF-8; null texts are empty."""
    texts = [(t or "").encode() for t in rows.column(text_col).to_pylist()]
    ids = [(-(1 << 63) - 1) if i is None else i for i in rows.column(id_col).to_pylist()]
    at = sorted(range(len(ids)), key=lambda k: (ids[k], texts[k]))
    return rows.take(pa.array(at, pa.int64())), [texts[k] for k in at]
