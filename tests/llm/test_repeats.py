"""Exact repeats in words and bytes against brute force."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from folioquest.llm import cover, repeats, suffixes
from tests.llm.conftest import SCHEMA, extras_unchanged, words


def brute_words(rows, window=35):
    texts = [(r[1] or "").encode().split() for r in rows]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for r, w in zip(rows, texts, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((r[0], len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def gone_bytes(texts, first, least=200):
    seen, place = Counter(), {}
    for k, t in enumerate(texts):
        for i in range(len(t) - least + 1):
            s = t[i : i + least]
            seen[s] += 1
            place.setdefault(s, (k, i))
    out = []
    for k, t in enumerate(texts):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - least + 1):
            s = t[i : i + least]
            if (place[s] != (k, i)) if first else seen[s] > 1:
                gone[i : i + least] = True
        out.append(gone)
    return out


def brute_bytes(rows):
    texts = [(r[1] or "").encode() for r in rows]
    out = []
    for r, t, gone in zip(rows, texts, gone_bytes(texts, False), strict=True):
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out.append((r[0], len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out)


@pytest.fixture(params=["one block", "many blocks"])
def blocks(request, monkeypatch):
    if request.param == "many blocks":
        monkeypatch.setattr(repeats, "BLOCK_BYTES", 2000)
        monkeypatch.setattr(repeats, "BUCKET_BYTES", 9000)
        monkeypatch.setattr(suffixes, "BUCKET_BYTES", 9000)


def test_cover_has_every_difference():
    assert cover.is_cover(cover.COVER, cover.PERIOD) and not cover.is_cover(cover.COVER[1:], cover.PERIOD)


def test_words_against_brute_force(spark, folder, rows, blocks):
    assert sorted(tuple(r) for r in cover.op9_difference_cover(spark, folder).collect()) == brute_words(rows)


def test_bytes_against_brute_force(spark, folder, rows, blocks):
    assert sorted(tuple(r) for r in suffixes.op8_suffix_array(spark, folder).collect()) == brute_bytes(rows)


def fuzz(seed, edges):
    """Few distinct pieces put together in many ways: every kind of overlap; with ``edges``, a passage in many surroundings."""
    rng = random.Random(seed)
    pieces = ["".join(rng.choice("abcd ") for _ in range(rng.choice([1, 60, 150, 260]))) for _ in range(12)]
    passage = "".join(rng.choice("xyz") for _ in range(260))
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 8))) for _ in range(60)]
    if edges:
        texts += ["".join(rng.choice("abcdefgh") for _ in range(150)) + passage + "".join(rng.choice("abcdefgh") for _ in range(150)) for _ in range(30)]
    return [(k, t, "en", "s", len(t)) for k, t in enumerate(texts)]


@pytest.mark.parametrize("hot", [64, 2])
@pytest.mark.parametrize("first", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_blocks_of_bytes(monkeypatch, hot, first, seed):
    """The passes without Spark: blocks, buckets, answers; few runs of an anchor count as too many when ``hot`` is 2."""
    import pyarrow as pa

    monkeypatch.setattr(suffixes, "HOT", hot)
    rows = fuzz(seed, True)
    n_blocks, buckets = 4, 3
    tables = [pa.table({"doc_id": [r[0] for r in rows if r[0] * n_blocks // len(rows) == k], "text": [r[1] for r in rows if r[0] * n_blocks // len(rows) == k]}) for k in range(n_blocks)]
    sent = _Frames(tables, first, buckets)
    want = gone_bytes([r[1].encode() for r in rows], first)
    got = sent.removed()
    assert all((a == b).all() for a, b in zip(want, got, strict=True))


class _Frames:
    """Runs the functions that ``mark`` hands to Spark, by standing in for the DataFrames."""

    def __init__(self, tables, first, buckets):
        self.tables, self.first, self.buckets = tables, first, buckets

    def removed(self):
        import pyarrow as pa
        from unittest import mock

        calls = []

        class Frame:
            columns = ("block",)

            def groupBy(self, *_):
                return self

            def cogroup(self, _):
                return self

            def applyInArrow(self, f, _):
                calls.append(f)
                return self

        with mock.patch.object(repeats, "blocked", lambda docs: (Frame(), self.buckets * suffixes.BUCKET_BYTES)):
            suffixes.mark(None, self.first)
        send_runs, count_runs, send_segments, decide = calls
        key = lambda k: (pa.scalar(k),)

        def by(tables, column):
            whole = pa.concat_tables(tables).to_pylist()
            schema = tables[0].schema
            return {k: pa.Table.from_pylist([r for r in whole if r[column] == k], schema=schema) for k in {r[column] for r in whole}}

        none = pa.Table.from_pylist([], schema=repeats.CODES_ARROW)
        runs = by([send_runs(key(k), t) for k, t in enumerate(self.tables)], "bucket")
        codes = by([count_runs(key(k), t) for k, t in runs.items()], "block")
        segments = by([send_segments(key(k), t, codes.get(k, none)) for k, t in enumerate(self.tables)], "bucket")
        answers = by([decide(key(k), t) for k, t in segments.items()], "block")
        out = {}
        for k, t in enumerate(self.tables):
            b = suffixes.Block(t, self.first)
            gone = suffixes.removed_bytes(b, answers.get(k, none), self.first)
            for doc_id, start, data in zip(b.rows.column("doc_id").to_pylist(), b.starts, b.texts, strict=True):
                out[doc_id] = gone[start : start + len(data)]
        return [out[k] for k in sorted(out)]


def test_keep_first_keeps_one_copy(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 1 << 30)
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdéf") for _ in range(300))
    rows = [(k, f"{k} " * 20 + passage + f" {k}" * 9, "en", "s", 0) for k in range(5)] + [(9, None, "en", "s", None)]
    out = {r["doc_id"]: r for r in suffixes.keep_first(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out[0]["text"] == rows[0][1] and out[9]["text"] is None
    for k in range(1, 5):
        # the spaces around the passage stand in all five, too
        assert out[k]["text"] == (f"{k} " * 20)[:-1] + (f" {k}" * 9)[1:] and out[k]["n_chars"] == len(out[k]["text"])


def test_longest_previous_factors():
    rng = random.Random(5)
    for _ in range(60):
        t = bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 60)))
        order = sorted(range(len(t)), key=lambda i: t[i:])
        shared = lambda i, j: next((k for k in range(len(t)) if t[i + k : i + k + 1] != t[j + k : j + k + 1] or i + k >= len(t) or j + k >= len(t)), len(t))
        lcp = [0, *[shared(a, b) for a, b in zip(order, order[1:], strict=False)]]
        length, source = suffixes.longest_previous(np.array(order), np.array(lcp), 1)
        for k, i in enumerate(order):
            best = max((shared(i, j) for j in range(i)), default=0)
            assert max(length[k], 0) == best
            assert best == 0 or (source[k] < i and shared(i, source[k]) == best)


def test_pieces_of_long_texts(monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 500)
    rows = fuzz(7, False)
    texts = [r[1].encode() for r in rows]
    starts = np.cumsum([0, *map(len, texts)])[:-1]
    runs = suffixes.find_runs(texts, starts)
    covered = sorted(p for a, b in zip(runs.low, runs.high, strict=True) for p in range(a, b + 1))
    assert covered == [s + i for s, t in zip(starts, texts, strict=True) for i in range(len(t) - 199)]


def test_empty_and_clashing(empty, clashing):
    assert cover.remove_repeats(empty).count() == 0 and suffixes.remove_repeats(empty).count() == 0 and suffixes.keep_first(empty).count() == 0
    assert cover.remove_repeats(clashing).count() == 13 and suffixes.remove_repeats(clashing).count() == 13
    kept = suffixes.keep_first(clashing)
    assert kept.columns == clashing.columns and extras_unchanged(kept.collect())


@pytest.mark.parametrize("n", [20_000])
def test_repeats_of_one_row_spread_over_blocks(spark, monkeypatch, n):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 1 << 20)
    text = "the same words again and again " * 12
    docs = spark.createDataFrame([(7, text, "x")] * n, "doc_id long, text string, block string").repartition(4)
    rows, total = repeats.blocked(docs)
    sizes = [r["count"] for r in rows.groupBy(rows.columns[-1]).count().collect()]
    assert total == n * len(text) and len(sizes) > 5 and max(sizes) < 2 * n / len(sizes)
    out = suffixes.keep_first(docs).collect()
    assert len(out) == n and {(r["doc_id"], r["block"]) for r in out} == {(7, "x")} and sum(len(r["text"]) for r in out) < 2 * len(text)
    assert cover.remove_repeats(docs).where("n_words <> removed[0].end - removed[0].start").isEmpty()


def test_blocks_and_buckets_grow_alike():
    """The rows exchanged are blocks times buckets; they grow in proportion to the text."""
    exchanged = lambda total: math.ceil(total / (repeats.BLOCK_BYTES * repeats.side(total))) * repeats.buckets(total)
    for total in (1 << 30, 4 << 30):
        assert exchanged(4 * total) == pytest.approx(4 * exchanged(total), rel=0.02)


def test_bytes_are_packed_and_unpacked():
    values = np.random.default_rng(1).integers(0, 1 << 40, 1000, dtype=np.uint64)
    assert (repeats.unpacked(repeats.packed(values, 5), 5) == values).all()
    assert len(repeats.unpacked(repeats.packed(values[:0], 5), 5)) == 0


def test_places_keep_the_order_in_a_bucket():
    rng = np.random.default_rng(2)
    keys = np.unique(np.concatenate([rng.integers(0, 1 << 63, 20_000, dtype=np.uint64) * np.uint64(2), np.array([0, 1, (1 << 64) - 1, (1 << 63), (1 << 32) - 1], np.uint64)]))
    for buckets in (1, 3, 46, 1000, 1 << 20):
        bucket, place = repeats.bucket_of(keys, buckets), repeats.place_in(keys, buckets, 40)
        assert (np.diff(bucket) >= 0).all() and int(place.max()) < 1 << 40
        assert (np.diff(place.astype(np.int64))[np.diff(bucket) == 0] >= 0).all()


def test_very_long_texts(spark):
    rng = random.Random(8)
    long = words(rng, 120_000, 50_000)
    rows = [(1, long, "en", "s", 0), (2, long[300_000:500_000], "en", "s", 0), (3, "short", "en", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r["doc_id"]: r["removed"] for r in suffixes.remove_repeats(docs).collect()}
    assert [tuple(x) for x in got[1]] == [(300_000, 500_000)] and [tuple(x) for x in got[2]] == [(0, 200_000)] and not got[3]
    got = {r["doc_id"]: sum(x["end"] - x["start"] for x in r["removed"]) for r in cover.remove_repeats(docs).collect()}
    inside = len(rows[1][1].split())
    assert inside - 2 <= got[1] <= inside and inside - 2 <= got[2] <= inside and got[3] == 0
