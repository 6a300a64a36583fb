"""Exact removal of repeated word windows by difference-cover anchors.

A set of residues modulo ``PERIOD`` is a difference cover if every distance between two positions is a difference of
two of its members. So wherever a window of 35 words stands twice, some place at the same offset in both falls on the
cover in both texts, within the first ``PERIOD`` words. Only windows of 35 - 21 + 1 words at cover positions, 5 in 21,
are hashed and counted over the corpus: the *anchors*. From every anchor that occurs again the match is extended to all
windows of 35 words that hold it, and those windows alone are counted by a 128-bit hash. Nothing is sampled: a window
without a repeated anchor can't be repeated.

Null and empty texts have no words; texts under 35 words are kept whole. Repeated rows repeat each other's windows.
Windows never cross rows. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from folioquest.llm import common, repeats

WINDOW = 35
PERIOD = 21
COVER = (0, 1, 4, 14, 16)
PART = 1 << 20
ANCHORS, WINDOWS, CANDIDATES = range(3)
BASES = (0x5851F42D4C957F2D, 0x2545F4914F6CDD1D)


def is_cover(cover: tuple[int, ...], period: int) -> bool:
    return {(a - b) % period for a in cover for b in cover} == set(range(period))


def parts_of(data: bytes) -> Iterator[list[bytes]]:
    """The words, in lists of about PART bytes."""
    at = 0
    while len(data) - at > PART:
        end = at + PART
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        yield data[at:end].split()
        at = end
    yield data[at:].split()


class Words:
    """Two hashes of each word of a block's texts, end to end; ``start`` has each text's first place, and one more."""

    def __init__(self, texts: list[bytes]):
        self.hashes, self.sizes = repeats.word_hashes(texts, (1, 2))
        self.start = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.in_text = np.arange(self.start[-1]) - np.repeat(self.start[:-1], self.sizes)
        self.left = np.repeat(self.sizes, self.sizes) - self.in_text
        self._known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __len__(self) -> int:
        return int(self.start[-1])

    def _sums(self, which: int) -> tuple[np.ndarray, np.ndarray]:
        if which in self._known:
            return self._known[which]
        n, base = len(self), BASES[which]
        powers, inverse = (np.full(n + 1, b, np.uint64) for b in (base, pow(base, -1, 1 << 64)))
        powers[0] = inverse[0] = 1
        np.multiply.accumulate(powers, out=powers)
        np.multiply.accumulate(inverse, out=inverse)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.hashes[which] * powers[:n], out=sums[1:])
        self._known[which] = sums, inverse
        return sums, inverse

    def windows(self, at: np.ndarray, length: int, which: int) -> np.ndarray:
        """A hash of the ``length`` words from each place, by the first or the second hash of words."""
        sums, inverse = self._sums(which)
        return repeats.mix((sums[at + length] - sums[at]) * inverse[at])

    def anchors(self, length: int) -> np.ndarray:
        on_cover = np.zeros(PERIOD, bool)
        on_cover[list(COVER)] = True
        return np.flatnonzero(on_cover[self.in_text % PERIOD] & (self.left >= length))

    def around(self, anchors: np.ndarray, window: int) -> np.ndarray:
        """Marks the windows with one of these anchors among their first PERIOD places."""
        n = len(self)
        sums = np.zeros(n + 1, np.int64)
        np.cumsum(np.bincount(anchors, minlength=n), out=sums[1:])
        return (self.left >= window) & (sums[np.minimum(np.arange(n) + PERIOD, n)] > sums[:-1])

    def keys(self, at: np.ndarray, window: int) -> repeats.Keys:
        return repeats.Keys.make(*(self.windows(at, window, b) for b in (0, 1)))


def mark(docs: DataFrame, window: int = WINDOW):
    """The rows in blocks, and for each block the answers that tell which of its windows are repeated."""
    rows, total = repeats.blocked(docs)
    anchor = window - PERIOD + 1
    if anchor < 1:
        raise ValueError(f"a window takes {PERIOD} words at least")
    buckets, block_col = repeats.buckets(total), rows.columns[-1]

    def send_anchors(key, block):
        words = Words(repeats.ordered(block)[1])
        keys = repeats.Keys.make(words.windows(words.anchors(anchor), anchor, 0))
        return repeats.table(list(keys.rows(key[0].as_py(), buckets, ANCHORS)), repeats.ROWS_ARROW)

    def count(_, bucket):
        found = bucket.to_pylist()
        passed = [{"block": r["block"], "bucket": r["bucket"], "kind": CANDIDATES, "codes": r["a"]} for r in found if r["kind"] == CANDIDATES]
        counted = [r for r in found if r["kind"] != CANDIDATES]
        if counted:
            g = repeats.Gathered.make(counted)
            passed += g.answers(g.codes())
        return repeats.table(passed, repeats.CODES_ARROW)

    def send_windows(key, block, answers):
        number = key[0].as_py()
        words = Words(repeats.ordered(block)[1])
        at = words.anchors(anchor)
        keys = repeats.Keys.make(words.windows(at, anchor, 0))
        again = repeats.answered(answers, ANCHORS, len(keys.a)) & repeats.REPEATED
        candidate = words.around(at[again[keys.of] > 0], window)
        out = list(words.keys(np.flatnonzero(candidate), window).rows(number, buckets, WINDOWS))
        # the marks themselves go along, so the last pass needn't find them again
        out.append({"bucket": number % buckets, "block": number, "kind": CANDIDATES, "a": np.packbits(candidate).tobytes(), "b": None, "flags": None, "rank": None})
        return repeats.table(out, repeats.ROWS_ARROW)

    first = rows.groupBy(block_col).applyInArrow(send_anchors, repeats.ROWS).groupBy("bucket").applyInArrow(count, repeats.CODES)
    second = rows.groupBy(block_col).cogroup(first.groupBy("block")).applyInArrow(send_windows, repeats.ROWS)
    return rows, second.groupBy("bucket").applyInArrow(count, repeats.CODES)


def removed_words(words: Words, answers: pa.Table, window: int) -> np.ndarray:
    n = len(words)
    marks = [r["codes"] for r in answers.to_pylist() if r["kind"] == CANDIDATES]
    candidate = np.unpackbits(np.frombuffer(marks[0], np.uint8), count=n).astype(bool) if marks else np.zeros(n, bool)
    at = np.flatnonzero(candidate)
    keys = words.keys(at, window)
    again = repeats.answered(answers, WINDOWS, len(keys.a)) & repeats.REPEATED
    at = at[again[keys.of] > 0]
    cover = np.bincount(at, minlength=n + 1) - np.bincount(at + window, minlength=n + 1)[: n + 1]
    return np.cumsum(cover)[:n] > 0


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, removed (start, end of each run of removed words) and the digest of the kept words, for every row (doc_id, text)."""
    rows, answers = mark(common.keyed_text(docs), window)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_sha256", pa.string())])

    def finish(_, block, answers):
        block, texts = repeats.ordered(block)
        words = Words(texts)
        gone = removed_words(words, answers, window)
        out = []
        for k, (doc_id, data) in enumerate(zip(block.column("doc_id").to_pylist(), texts, strict=True)):
            own = gone[words.start[k] : words.start[k + 1]]
            edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
            digest, at, sep = hashlib.sha256(), 0, b""
            for part in parts_of(data):
                kept = [w for w, g in zip(part, own[at : at + len(part)].tolist(), strict=True) if not g] if len(edges) else part
                at += len(part)
                if kept:
                    digest.update(sep + b" ".join(kept))
                    sep = b" "
            out.append({"doc_id": doc_id, "n_words": len(own), "removed": [{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)], "kept_sha256": digest.hexdigest()})
        return pa.Table.from_pylist(out, schema=schema)

    return rows.groupBy(rows.columns[-1]).cogroup(answers.groupBy("block")).applyInArrow(finish, "doc_id long, n_words long, removed array<struct<start:long,end:long>>, kept_sha256 string")


def op9_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    rows = remove_repeats(common.documents(spark, sf_dir))
    return rows.select("doc_id", "n_words", F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"]).alias("n_removed"), "kept_sha256")


QUERIES = {"op9_difference_cover": op9_difference_cover}
ORACLES = {
    "op9_difference_cover": f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{common.WORD}') AS ws FROM documents),
t AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
k AS (SELECT doc_id, i, ws[i] AS word, CASE WHEN i + {WINDOW - 1} <= len(ws) THEN array_to_string(ws[i:i + {WINDOW - 1}], ' ') END AS win FROM t),
c AS (SELECT doc_id, i, word, win IS NOT NULL AND count(*) OVER (PARTITION BY win) > 1 AS again FROM k),
g AS (SELECT doc_id, i, word, max(CAST(again AS INT)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) AS gone FROM c),
s AS (SELECT doc_id, count(*) AS n_words, CAST(sum(gone) AS BIGINT) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM g GROUP BY doc_id)
SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN s USING (doc_id)"""
}
