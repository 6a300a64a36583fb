"""Language-model scores from a log-frequency Bloom filter.

The events are those of the base score: every word of the training texts, the end of a text, and one for all words
that training hasn't seen. Counts of words and of pairs of neighbours are quantised: a count's *level* is its place
among ``THRESHOLDS`` (two an octave; 1, 2 and 3 have levels of their own), and an n-gram of level k is entered under the
levels 1 to k. A level is read back by probing one after the other until one is missing, up to the highest entered.

The filter lies in Spark in slices, one for each range of the n-grams' 64-bit hashes. It grows with the text, so it isn't
broadcast: blocks of texts send the distinct n-grams they hold with their counts in training rows, a slice is filled
from what all blocks send for its range, and probed for each block on the spot (see ``repeats``). Slices have
``BITS`` bits an entry and so the same rate of false positives, under 1e-9, at any size of the corpus; that two n-grams have
the same place of 40 bits in a range, which a range of a million n-grams makes one in a million, comes on top. An n-gram's
bits lie in a small part of its slice, by its place, so that sorted n-grams are probed close to each other.

Unknown words get what Good and Turing leave them, the share of tokens seen once; known ones share the rest by the
middles of their levels. A word after a known one mixes this with the pair's share among the successors of the first:
the least count of the pair's level over the most of the first word's, and what false positives may add to it. Shares of
successors so add up to one at most. The end of a text stands before the first word of the next.

Base scores take exact counts, which ranges of words hold beside their slice. Of the corpus, the driver sees seven sums.

Null and empty texts are one end. Repeated rows all count. Without training rows N and V are 0 and all is unknown.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioquest.llm import common, repeats

PROBES, BITS = 12, 64
BUCKET_BYTES = 2 << 20
#: Bytes of an n-gram's place in its range that are sent, and n-grams in a part of a slice.
WIDTH, PART = 5, 2048
PAIR_SHARE, PAIR_SEEN = 0.4, 20
FOLDS, HELD_OUT = 10, 0
PRIOR = 0.1
WORDS, PAIRS, SUMS = range(3)

#: The least count of each level, from level 1.
THRESHOLDS = np.array([1, *sorted(x for k in range(1, 62) for x in (1 << k, 3 << (k - 1)))], np.int64)
LEAST = np.append(0, THRESHOLDS)
MOST = np.append(0, np.append(THRESHOLDS[1:], (1 << 62)) - 1)
MIDDLE = (LEAST + MOST) / 2

ANSWERS = "block int, bucket int, kind int, levels binary, counts binary, total long, distinct long, once long, mass double, filled long, bits long, pairs long"
ANSWERS_ARROW = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("kind", pa.int32()), ("levels", pa.binary()), ("counts", pa.binary()), *[(c, pa.int64()) for c in ("total", "distinct", "once")], ("mass", pa.float64()), ("filled", pa.int64()), ("bits", pa.int64()), ("pairs", pa.int64())])


#: The hash of a text's end.
END = np.uint64(0x8A5CD789635D2DFF)


class Tokens:
    """A block's rows in order, its tokens end to end, and its distinct words and pairs by their hashes, sorted."""

    def __init__(self, rows: pa.Table):
        self.rows, texts = repeats.ordered(rows)
        (hashes,), n = repeats.word_hashes([t.lower() for t in texts])
        self.sizes = n + 1
        own = np.full(len(hashes) + len(n), END)
        own[np.arange(len(hashes)) + np.repeat(np.arange(len(n)), n)] = hashes
        before = np.append(END, own[:-1])
        self.words, self.word_of = np.unique(own, return_inverse=True)
        # the first token follows the end before it, which is a word of its own
        self.before = np.append(self.word_of[-1:], self.word_of[:-1])
        self.pairs, self.pair_of = np.unique(repeats.mix(before, own), return_inverse=True)

    def counts(self, of: np.ndarray, n: int, trains: np.ndarray) -> np.ndarray:
        return np.bincount(of[np.repeat(trains, self.sizes)], minlength=n)


def messages(block: int, kind: int, keys: np.ndarray, n: np.ndarray, buckets: int) -> Iterator[dict]:
    """A row for each range: the places of the keys in it, as differences, and their counts."""
    bounds = np.searchsorted(repeats.bucket_of(keys, buckets), np.arange(buckets + 1))
    places = repeats.place_in(keys, buckets, 8 * WIDTH)
    for k in np.flatnonzero(np.diff(bounds)):
        own = slice(bounds[k], bounds[k + 1])
        yield {"bucket": int(k), "block": block, "kind": kind, "a": repeats.packed(np.diff(places[own], prepend=np.uint64(0)), WIDTH), "b": repeats.packed(n[own].astype(np.uint64)), "flags": None, "rank": None}


def levels(n: np.ndarray) -> np.ndarray:
    """The level of each count; 0 for none."""
    return np.searchsorted(THRESHOLDS, n, "right")


@dataclass
class Slice:
    """The part of the filter that holds one range of one kind of n-grams, by their places in it. ``top`` is the highest level entered."""

    bits: np.ndarray
    part_bits: int
    top: int

    @staticmethod
    def fill(places: np.ndarray, n: np.ndarray, bits_an_entry: float = BITS) -> Slice:
        level = levels(n)
        top, parts = int(level.max(initial=0)), max(1, len(places) // PART)
        part_bits = max(64, int(level.sum() * bits_an_entry / parts))
        own = Slice(np.zeros(parts * part_bits, bool), part_bits, top)
        for k in range(1, top + 1):
            for at in own.probes(places[level >= k], k):
                own.bits[at] = True
        return own

    def probes(self, places: np.ndarray, level: int) -> Iterator[np.ndarray]:
        """The bits of entries, one array for each probe."""
        parts = len(self.bits) // self.part_bits
        base = (places * np.uint64(parts) >> np.uint64(8 * WIDTH)) * np.uint64(self.part_bits)
        one = repeats.mix(places, np.full(len(places), level, np.uint64))
        two = repeats.mix(one) | np.uint64(1)
        for _ in range(PROBES):
            yield base + ((one >> np.uint64(32)) * np.uint64(self.part_bits) >> np.uint64(32))
            one = one + two

    def has(self, places: np.ndarray, level: int) -> np.ndarray:
        """Which of the n-grams are there under a level."""
        out = np.ones(len(places), bool)
        for at in self.probes(places, level):
            out &= self.bits[at]
        return np.flatnonzero(out)

    def level(self, places: np.ndarray) -> np.ndarray:
        """The highest level up to which all are there."""
        out, open_ = np.zeros(len(places), np.uint8), np.arange(len(places))
        for k in range(1, self.top + 1):
            open_ = open_[self.has(places[open_], k)]
            if not len(open_):
                break
            out[open_] = k
        return out


def answers_of(rows: list[dict]) -> list[dict]:
    """What the blocks that asked about a range get back: levels, for words counts too; and the range's sums."""
    out = []
    for kind in (WORDS, PAIRS):
        own = [r for r in rows if r["kind"] == kind]
        if not own:
            continue
        asked = [np.cumsum(repeats.unpacked(r["a"], WIDTH)) for r in own]
        places, of = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(of, np.concatenate([repeats.unpacked(r["b"]) for r in own]), len(places)).astype(np.int64)
        seen = total > 0
        slice_ = Slice.fill(places[seen], total[seen])
        level, at = slice_.level(places), 0
        for r, a in zip(own, asked, strict=True):
            mine = of[at : at + len(a)]
            at += len(a)
            out.append({"block": r["block"], "bucket": r["bucket"], "kind": kind, "levels": repeats.packed(level[mine].astype(np.uint64), 1), "counts": repeats.packed(total[mine].astype(np.uint64)) if kind == WORDS else None})
        n = total[seen]
        sums = {"total": int(n.sum()), "distinct": len(n), "once": int((n == 1).sum()), "mass": float(MIDDLE[levels(n)].sum())} if kind == WORDS else {"filled": int(slice_.bits.sum()), "bits": len(slice_.bits), "pairs": len(n)}
        out.append({"block": -1, "bucket": rows[0]["bucket"], "kind": SUMS, **sums})
    return out


@dataclass(frozen=True)
class Shares:
    """What scoring knows of the whole corpus: tokens, distinct words, words seen once, the middles of all words' levels, and the rate of false pairs."""

    total: int
    distinct: int
    once: int
    mass: float
    false: float

    @property
    def unknown(self) -> float:
        return min(0.5, (self.once + 1) / (self.total + 2))

    @property
    def chance(self) -> float:
        """How many false successors a word may have, each counted once."""
        return self.false * self.distinct

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + PRIOR) / (self.total + PRIOR * (self.distinct + 1)))

    def score(self, word: np.ndarray, before: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """log10 probabilities from the levels of tokens, of the tokens before them, and of both together."""
        alone = np.where(word > 0, (1 - self.unknown) * MIDDLE[word] / max(1.0, self.mass), self.unknown)
        seen = MOST[before]
        after = np.minimum(LEAST[pair], seen) / np.maximum(seen + self.chance, 1)
        share = PAIR_SHARE * seen / (seen + PAIR_SEEN)
        return np.log10((1 - share) * alone + share * after)


def in_training() -> Column:
    return common.crc_column() % FOLDS != HELD_OUT


def score(docs: DataFrame, trains: Column | None = None) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row (doc_id, text), by a model of the rows of which ``trains`` holds."""
    texts = common.keyed_text(docs)
    rows, total = repeats.blocked(texts.withColumn("trains", F.coalesce(in_training() if trains is None else trains, F.lit(False))))
    buckets = repeats.buckets(total, BUCKET_BYTES)
    block_col = rows.columns[-1]

    def send(key, block):
        t, number = Tokens(block), key[0].as_py()
        own = np.asarray(t.rows.column("trains"))
        out = list(messages(number, WORDS, t.words, t.counts(t.word_of, len(t.words), own), buckets))
        out += messages(number, PAIRS, t.pairs, t.counts(t.pair_of, len(t.pairs), own), buckets)
        return repeats.table(out, repeats.ROWS_ARROW)

    def answer(_, bucket):
        return repeats.table(answers_of(bucket.to_pylist()), ANSWERS_ARROW)

    sent = rows.groupBy(block_col).applyInArrow(send, repeats.ROWS)
    answers = common.checkpoint(sent.groupBy("bucket").applyInArrow(answer, ANSWERS))
    sums = answers.where(F.col("kind") == SUMS).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "distinct", "once", "mass", "filled", "bits", "pairs")]).first().asDict()
    # a pair that training hasn't seen is found by the filter's chance, or has the place of one that it has
    false = ((sums["filled"] / sums["bits"]) ** PROBES if sums["bits"] else 0.0) + sums["pairs"] / buckets / 2.0 ** (8 * WIDTH)
    shares = Shares(sums["total"], sums["distinct"], sums["once"], float(sums["mass"]), false)

    def finish(_, block, answers):
        t = Tokens(block)
        found = sorted(answers.to_pylist(), key=lambda r: (r["kind"], r["bucket"]))
        joined = lambda kind, c, width: np.concatenate([np.zeros(0, np.uint64), *[repeats.unpacked(r[c], width) for r in found if r["kind"] == kind]]).astype(np.int64)
        word, pair, c = joined(WORDS, "levels", 1), joined(PAIRS, "levels", 1), joined(WORDS, "counts", 8)
        starts = np.cumsum(t.sizes) - t.sizes
        total_of = lambda x: np.add.reduceat(x, starts)
        scores = shares.score(word[t.word_of], word[t.before], pair[t.pair_of])
        out = {"doc_id": t.rows.column("doc_id"), "n_tokens": t.sizes, "n_known": total_of((c > 0).astype(np.int64)[t.word_of]), "train_tokens": np.full(len(t.sizes), shares.total), "base_score": total_of(shares.base(c)[t.word_of]), "score": total_of(scores)}
        return pa.table(out, schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
    mine = answers.where(F.col("kind") != SUMS).select("block", "bucket", "kind", "levels", "counts")
    return rows.groupBy(block_col).cogroup(mine.groupBy("block")).applyInArrow(finish, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = score(common.documents(spark, sf_dir))
    return rows.select("doc_id", (~in_training()).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op5_lm_score": op5_lm_score}
ORACLES: dict[str, str] = {}
