"""Exact removal of repeated byte strings by longest-previous-factor arrays.

A string of ``LEAST`` (200) bytes that stands at two places has, in both, its least hash of 16 bytes at the same
offset. Each text falls into *runs* of starting places whose strings share that place, the *anchor*; only runs with
equal anchor hashes can hold equal strings. Runs go by two hashes: the anchor's, and one of all bytes from the first
string of the run to the end of the last. What occurs once in the corpus by the first hash is done with; what occurs
twice by both is repeated throughout. Between runs that share an anchor but not all bytes, a suffix array over the
runs' distinct bytes decides: suffixes are sorted by prefix doubling up to ``LEAST`` bytes, previous and next smaller
places in suffix order give each start its longest earlier match, and a start is repeated if that reaches ``LEAST`` or
if it is the earlier match of one that does. Runs are gathered by anchor; an anchor with over ``HOT`` different runs
(the edges of a passage that many texts hold) isn't gathered: its strings are counted one by one by a 128-bit hash.

``keep="none"`` removes every byte that such a string covers. ``keep="first"`` removes later copies only: what starts
first by id, then by block and place, stays.

Null and empty texts, and texts under 200 bytes, are kept whole. Repeated rows repeat each other. Strings never cross
rows. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioquest.llm import common, repeats

LEAST = 200
SEED = 16
PIECE = 1 << 18
HOT = 64
SORTED_BYTES = 512 << 10
BUCKET_BYTES = 2 << 20
MIXED, TOO_MANY = 4, 8
RUNS, STRINGS, VERDICTS, SEGMENTS = range(4)
_PLACE = np.uint64((1 << 24) - 1)


def _joined(values: np.ndarray, step: int) -> np.ndarray:
    return repeats.mix(values[:-step], values[step:])


@dataclass
class Runs:
    """Runs of string starts with one anchor, over a block's texts laid end to end."""

    low: np.ndarray
    high: np.ndarray
    anchor: np.ndarray
    whole: np.ndarray

    def __len__(self) -> int:
        return len(self.low)


def _piece_runs(buf: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """low, high (inclusive), anchor hash and whole hash of each run among the valid starts. Three hashes of 128 bytes cover a run's bytes, 384 at most."""
    x = buf.astype(np.uint64)
    for shift in (1, 2, 4):
        x = x[:-shift] | x[shift:] << np.uint64(8 * shift)
    seed = _joined(x, 8)
    least = (seed & ~_PLACE) | np.arange(len(seed), dtype=np.uint64)
    width, span = 1, LEAST - SEED + 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    at = np.flatnonzero(valid[: len(least)])
    owner = (least[at] & _PLACE).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    low, high = at[first], at[np.append(first[1:], len(at)) - 1] if len(at) else at
    eight = _joined(_joined(_joined(seed, 16), 32), 64)
    size = high - low + LEAST
    tail = low + size - 128
    whole = repeats.mix(repeats.mix(eight[low], eight[tail]), repeats.mix(eight[low + (size - 128) // 2], size.astype(np.uint64)))
    # least hashes are small; mixed again they spread over all buckets
    return low, high, repeats.mix(seed[owner[first]]), whole


def find_runs(texts: list[bytes], starts: np.ndarray) -> Runs:
    """All runs of texts laid end to end at ``starts``. Long texts are cut into overlapping pieces; a run that a cut divides becomes two."""
    pieces: list[tuple[int, bytes]] = []
    for data, start in zip(texts, starts.tolist(), strict=True):
        pieces += [(start + lo, data[lo : lo + PIECE + LEAST - 1]) for lo in range(0, max(1, len(data) - LEAST + 1), PIECE)]
    found, held, size = [], [], 0

    def flush() -> None:
        buf = np.frombuffer(b"".join(d for _, d in held), np.uint8)
        if len(buf) < LEAST:
            return
        valid, shift = np.zeros(len(buf), bool), np.zeros(len(buf), np.int64)
        at = 0
        for start, data in held:
            valid[at : max(at, at + len(data) - LEAST + 1)] = True
            shift[at : at + len(data)] = start - at
            at += len(data)
        low, high, anchor, whole = _piece_runs(buf, valid)
        found.append((low + shift[low], high + shift[low], anchor, whole))

    for piece in pieces:
        if len(piece[1]) < LEAST:
            continue
        if held and size + len(piece[1]) > 2 * PIECE:
            flush()
            held, size = [], 0
        held.append(piece)
        size += len(piece[1])
    if held:
        flush()
    empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    return Runs(*(np.concatenate(c) for c in zip(empty, *found, strict=True)))


def string_hashes(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the LEAST bytes from each place."""
    words = np.lib.stride_tricks.sliding_window_view(buf, LEAST)
    a, b = (np.zeros(len(at), np.uint64) for _ in range(2))
    for lo in range(0, len(at), 4096):
        rows = np.ascontiguousarray(words[at[lo : lo + 4096]]).view("<u8")
        x, y = (np.full(len(rows), s, np.uint64) for s in (1, 2))
        for k in range(rows.shape[1]):
            x, y = repeats.mix(x, rows[:, k]), repeats.mix(rows[:, k], y)
        a[lo : lo + 4096], b[lo : lo + 4096] = x, y
    return a, b


def _ranked(values: np.ndarray) -> np.ndarray:
    """Dense ranks, in order."""
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


def prefix_ranks(buf: np.ndarray, room: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The places with ``least`` bytes (8 or more) in their text, and the ranks of those bytes, by prefix doubling. ``room``: bytes left in the text."""
    x = np.zeros(len(buf), np.uint64)
    for k in range(8):
        x[: len(buf) - k] |= buf[k:].astype(np.uint64) << np.uint64(8 * (7 - k))
    at, length = np.flatnonzero(room >= 8), 8
    rank = np.zeros(len(buf), np.int64)
    rank[at] = _ranked(x[at])
    while length < least:
        step = min(length, least - length)
        at = np.flatnonzero(room >= length + step)
        rank[at] = _ranked(rank[at] * len(buf) + rank[at + step])
        length += step
    return at, rank[at]


def longest_previous(order: np.ndarray, lcp: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place in ``order`` (places in suffix order): the length it shares with an earlier place, and that place; -1 where it is under ``least``.

    ``lcp[k]`` is what the places k - 1 and k in order share. The best earlier match is the nearest smaller place on
    one side or the other; pointers are followed on both sides until they reach it or share less than ``least``.
    """
    n = len(order)
    best, source = np.full(n, -1), np.full(n, -1)
    for side in (-1, 1):
        place, shared = (order, lcp) if side < 0 else (order[::-1], np.append(lcp[1:], 0)[::-1] if n else lcp)
        to, low = np.arange(n) - 1, shared.copy()
        while True:
            jump = np.flatnonzero((to >= 0) & (low >= least))
            jump = jump[place[to[jump]] > place[jump]]
            if not len(jump):
                break
            over = to[jump]
            low[jump], to[jump] = np.minimum(low[jump], low[over]), to[over]
        ok = (to >= 0) & (low >= least)
        length, match = np.where(ok, low, -1), np.where(ok, place[np.maximum(to, 0)], -1)
        if side > 0:
            length, match = length[::-1], match[::-1]
        better = length > best
        best, source = np.where(better, length, best), np.where(better, match, source)
    return best, source


def repeated_starts(segments: list[bytes | memoryview], least: int, first: bool) -> list[np.ndarray]:
    """For each segment, marks for its starts: those with an equal string of ``least`` bytes anywhere else in the segments, or with ``first`` only earlier."""
    buf = np.frombuffer(b"".join(segments), np.uint8)
    sizes = np.array([len(s) for s in segments])
    ends = np.cumsum(sizes)
    room = np.repeat(ends, sizes) - np.arange(len(buf))
    at, rank = prefix_ranks(buf, room, least)
    by = np.lexsort((at, rank))
    order = at[by]
    same = np.zeros(len(order), np.int64)
    same[1:] = np.where(rank[by][1:] == rank[by][:-1], least, 0)
    length, source = longest_previous(order, same, least)
    marks = np.zeros(len(buf), bool)
    marks[order[length >= least]] = True
    if not first:
        marks[source[length >= least]] = True
    return [marks[e - n : e - least + 1] for e, n in zip(ends, sizes, strict=True)]


def _positions(runs: Runs, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The starts in the chosen runs, and the run of each."""
    sizes = runs.high[which] - runs.low[which] + 1
    run = np.repeat(which, sizes)
    offset = np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return runs.low[run] + offset, run


class Block:
    """A block's rows in order, their bytes end to end, runs, and distinct runs with their rank in the corpus."""

    def __init__(self, rows: pa.Table, ranked: bool):
        self.rows, self.texts = repeats.ordered(rows)
        sizes = np.array([len(t) for t in self.texts], np.int64)
        self.starts = np.cumsum(sizes) - sizes
        self.runs = find_runs(self.texts, self.starts)
        self.keys = repeats.Keys.make(self.runs.anchor, self.runs.whole)
        ids = np.array([-(1 << 63) if i is None else i for i in self.rows.column("doc_id").to_pylist()], np.int64)
        self.rank = ids[self.text_of(self.runs.low[self.keys.first])] if ranked else None
        self.ids = ids
        self.buf = np.frombuffer(b"".join(self.texts), np.uint8)

    def text_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, "right") - 1

    def sent(self, verdict: np.ndarray) -> np.ndarray:
        """The distinct runs that this block sends to be sorted."""
        return np.flatnonzero((verdict & (MIXED | TOO_MANY | repeats.FIRST)) == (MIXED | repeats.FIRST))

    def strings(self, verdict: np.ndarray, ranked: bool) -> tuple[np.ndarray, repeats.Keys, np.ndarray | None]:
        """Starts in the runs of anchors with too many runs, and their keys."""
        chosen = np.flatnonzero((verdict[self.keys.of] & TOO_MANY) > 0)
        at, _ = _positions(self.runs, chosen)
        keys = repeats.Keys.make(*string_hashes(self.buf, at)) if len(at) else repeats.Keys.make(np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        return at, keys, self.ids[self.text_of(at[keys.first])] if ranked else None


SEGMENT_ROWS = repeats.ROWS + ", data binary"
SEGMENT_ARROW = repeats.ROWS_ARROW.append(pa.field("data", pa.binary()))


def _run_verdicts(rows: list[dict]) -> list[dict]:
    """Codes of a bucket's runs: REPEATED and FIRST by both hashes; MIXED if their anchor has other runs, TOO_MANY if over HOT."""
    g = repeats.Gathered.make(rows)
    codes = g.codes()
    # FIRST marks one holder of each distinct run
    anchors, of = np.unique(g.a, return_inverse=True)
    kinds = np.bincount(of, codes & repeats.FIRST > 0, len(anchors))[of]
    codes[kinds > 1] |= MIXED
    codes[kinds > HOT] |= TOO_MANY
    return list(g.answers(codes))


def _segment_verdicts(rows: list[dict], first: bool) -> list[dict]:
    """Answers the blocks that sent segments with a mark for each of their starts, in the order sent. Sorts whole anchors, about SORTED_BYTES at a time."""
    entries = []
    for k, r in enumerate(rows):
        sizes = np.frombuffer(r["b"], np.uint64).astype(np.int64)
        ends = np.cumsum(sizes)
        anchors = np.frombuffer(r["a"], np.uint64)
        rank = np.frombuffer(r["rank"], np.int64)
        place, data = np.frombuffer(r["flags"], np.int64), memoryview(r["data"])
        entries += [(int(anchors[i]), int(rank[i]), r["block"], int(place[i]), k, i, data[ends[i] - sizes[i] : ends[i]]) for i in range(len(sizes))]
    entries.sort(key=lambda e: e[:4])
    marks: list[list[np.ndarray]] = [[None] * (len(r["a"]) // 8) for r in rows]
    lo = 0
    while lo < len(entries):
        hi, size = lo, 0
        while hi < len(entries) and (size < SORTED_BYTES or entries[hi][0] == entries[hi - 1][0]):
            size += len(entries[hi][6])
            hi += 1
        for e, m in zip(entries[lo:hi], repeated_starts([e[6] for e in entries[lo:hi]], LEAST, first), strict=True):
            marks[e[4]][e[5]] = m
        lo = hi
    return [{"block": r["block"], "bucket": r["bucket"], "kind": SEGMENTS, "codes": np.concatenate(m).tobytes()} for r, m in zip(rows, marks, strict=True)]


def mark(docs: DataFrame, first: bool) -> tuple[DataFrame, DataFrame]:
    """The rows in blocks, and the answers to each block."""
    rows, total = repeats.blocked(docs)
    buckets, block_col = repeats.buckets(total, BUCKET_BYTES), rows.columns[-1]

    def send_runs(key, block):
        b = Block(block, first)
        return repeats.table(list(b.keys.rows(key[0].as_py(), buckets, RUNS, b.rank)), repeats.ROWS_ARROW)

    def count_runs(_, bucket):
        return repeats.table(_run_verdicts(bucket.to_pylist()), repeats.CODES_ARROW)

    def send_segments(key, block, answers):
        b, number = Block(block, first), key[0].as_py()
        verdict = repeats.answered(answers, RUNS, len(b.keys.a))
        _, keys, rank = b.strings(verdict, first)
        out = [r | {"data": None} for r in keys.rows(number, buckets, STRINGS, rank)]
        out.append({"bucket": number % buckets, "block": number, "kind": VERDICTS, "a": verdict.tobytes(), "b": None, "flags": None, "rank": None, "data": None})
        sent = b.sent(verdict)
        bounds = np.searchsorted(repeats.bucket_of(b.keys.a[sent], buckets), np.arange(buckets + 1))
        for k in np.flatnonzero(np.diff(bounds)):
            own = sent[bounds[k] : bounds[k + 1]]
            run = b.keys.first[own]
            low, end = b.runs.low[run], b.runs.high[run] + LEAST
            data = b"".join(b.buf[x:y].tobytes() for x, y in zip(low.tolist(), end.tolist(), strict=True))
            out.append({"bucket": int(k), "block": number, "kind": SEGMENTS, "a": b.keys.a[own].tobytes(), "b": (end - low).astype(np.uint64).tobytes(), "flags": low.tobytes(), "rank": (b.rank[own] if first else np.zeros(len(own), np.int64)).tobytes(), "data": data})
        return repeats.table(out, SEGMENT_ARROW)

    def decide(_, bucket):
        found = bucket.to_pylist()
        kind = lambda k: [r for r in found if r["kind"] == k]
        out = [{"block": r["block"], "bucket": r["bucket"], "kind": VERDICTS, "codes": r["a"]} for r in kind(VERDICTS)]
        if own := kind(STRINGS):
            g = repeats.Gathered.make(own)
            out += g.answers(g.codes())
        if own := kind(SEGMENTS):
            out += _segment_verdicts(own, first)
        return repeats.table(out, repeats.CODES_ARROW)

    counted = rows.groupBy(block_col).applyInArrow(send_runs, repeats.ROWS).groupBy("bucket").applyInArrow(count_runs, repeats.CODES)
    sent = rows.groupBy(block_col).cogroup(counted.groupBy("block")).applyInArrow(send_segments, SEGMENT_ROWS)
    return rows, sent.groupBy("bucket").applyInArrow(decide, repeats.CODES)


def removed_bytes(b: Block, answers: pa.Table, first: bool) -> np.ndarray:
    """Marks over the block's bytes."""
    verdict = np.concatenate([np.zeros(0, np.uint8), *[np.frombuffer(r["codes"], np.uint8) for r in answers.to_pylist() if r["kind"] == VERDICTS]])
    verdict = verdict if len(verdict) else np.zeros(len(b.keys.a), np.uint8)
    of = b.keys.of
    whole = (verdict & repeats.REPEATED) > 0
    gone = np.zeros(len(b.runs), bool)
    gone[:] = whole[of]
    holder = np.zeros(len(b.runs), bool)
    holder[b.keys.first] = (verdict & repeats.FIRST) > 0
    if first:
        gone &= ~holder
    hot = (verdict[of] & TOO_MANY) > 0
    gone &= ~(hot & first)
    starts = [np.zeros(0, np.int64)]
    # single strings of anchors with too many runs
    at, keys, _ = b.strings(verdict, first)
    if len(at):
        code = repeats.answered(answers, STRINGS, len(keys.a))
        again = (code[keys.of] & repeats.REPEATED) > 0
        if first:
            own = np.zeros(len(at), bool)
            own[keys.first] = (code & repeats.FIRST) > 0
            again &= ~own
        starts.append(at[again])
    # runs that were sorted among others with their anchor; buckets are ranges, so answers in their order are in the order sent
    sent = b.sent(verdict)
    if len(sent):
        at, _ = _positions(b.runs, b.keys.first[sent])
        starts.append(at[repeats.answered(answers, SEGMENTS, len(at)) > 0])
    single = np.concatenate(starts)
    low, end = np.append(b.runs.low[gone], single), np.append(b.runs.high[gone], single) + LEAST
    cover = np.zeros(len(b.buf) + 1, np.int32)
    np.add.at(cover, low, 1)
    np.add.at(cover, end, -1)
    return np.cumsum(cover, out=cover)[:-1] > 0


def kept_text(data: bytes, gone: np.ndarray) -> str:
    """What is left of a text. A character stays whole unless all its bytes go."""
    buf = np.frombuffer(data, np.uint8)
    lead = np.flatnonzero((buf & 0xC0) != 0x80)
    if not len(lead):
        return ""
    keep = np.logical_or.reduceat(~gone, lead)
    return buf[np.repeat(keep, np.diff(np.append(lead, len(buf))))].tobytes().decode()


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, removed (start, end of each run of removed bytes) and the digest of the kept bytes: every byte of a string that stands twice goes."""
    rows, answers = mark(common.keyed_text(docs), first=False)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_sha256", pa.string())])

    def finish(_, block, answers):
        b, out = Block(block, False), []
        gone = removed_bytes(b, answers, False)
        for doc_id, data, start in zip(b.rows.column("doc_id").to_pylist(), b.texts, b.starts.tolist(), strict=True):
            own = gone[start : start + len(data)]
            edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8))).reshape(-1, 2)
            kept = b.buf[start : start + len(data)][~own].tobytes() if len(edges) else data
            out.append({"doc_id": doc_id, "n_bytes": len(data), "removed": [{"start": int(x), "end": int(y)} for x, y in edges], "kept_sha256": hashlib.sha256(kept).hexdigest()})
        return pa.Table.from_pylist(out, schema=schema)

    return rows.groupBy(rows.columns[-1]).cogroup(answers.groupBy("block")).applyInArrow(finish, "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept_sha256 string")


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows with later copies cut out of ``text``: strings that start earlier, by doc_id, then block and place. ``n_chars``, if there, is counted anew; a text with nothing left is empty."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", common.whole_row(docs.drop("text")))
    rows, answers = mark(keyed, first=True)

    def finish(_, block, answers):
        b = Block(block, True)
        gone = removed_bytes(b, answers, True)
        texts = [t if t is None else kept_text(data, own) if (own := gone[start : start + len(data)]).any() else t for t, data, start in zip(b.rows.column("text").to_pylist(), b.texts, b.starts.tolist(), strict=True)]
        return pa.table([pa.array(texts, pa.string()), b.rows.column("row")], names=["text", "row"])

    out = keyed.select("text", "row").schema
    return common.with_text(rows.groupBy(rows.columns[-1]).cogroup(answers.groupBy("block")).applyInArrow(finish, out), docs, F.col("text"))


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(common.documents(spark, sf_dir))
    return rows.select("doc_id", "n_bytes", F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"]).alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


QUERIES = {"op8_suffix_array": op8_suffix_array}
ORACLES: dict[str, str] = {}
