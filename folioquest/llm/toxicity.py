"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic rows of the training fold are the positives; the unlabelled set is a draw from all documents of the
fold, with and without labels, whose labels aren't looked at. With class prior ``p``, the risk is
``p R+(P) + max(0, R-(U) - p R-(P))``: when the second part falls below zero the classifier has begun to fit positives
hidden in the unlabelled set, and the step goes the other way. The prior is a parameter; left out, it is estimated
without any negatives, as the least share of unlabelled rows above a cut over the share of positives above it, on rows
that the scoring model hasn't seen.

A text's features are the distinct words in it and the first 4, 5 and 6 bytes of each, all lower-cased, with a second
and third feature where two and three distinct words share such a beginning; nothing else of the row is read. Spark
counts features over the training rows; all that are ``LIFT`` times as frequent among positives as in the rest, with a
likelihood ratio of ``LEAST_G`` for it, enter a linear model without negative weights. Training takes positives
of about ``MAX_POSITIVE`` ids and unlabelled rows of about ``MAX_DRAWN`` at most, drawn by a hash of the id; every row is scored on its whole text.

The place of the 0.7 cut is found on rows that a model hasn't seen: ``PARTS`` models, each trained without one part of
the rows, score that part, and the cut goes where recall and estimated precision (the prior times recall, over the share
of unlabelled rows above the cut) have the best harmonic mean. That needs positives and unlabelled rows only. The
intercept is set so that this place is 0.7.

Null and empty texts score what the intercept gives. Where there are no positives, or nothing sets them apart, nothing can
be learnt and every score is all but 0. Ties in feature choice go by the feature's bytes. Repeated rows are scored alike
and enter training as one row with a weight; an id with conflicting labels counts as toxic.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioquest.llm import common

MAX_POSITIVE, MAX_DRAWN = 20_000, 20_000
#: Bounds of an estimated prior, the prior it is estimated with, and the share of positives a cut must have above it.
LEAST_PRIOR, MOST_PRIOR, FIRST_PRIOR, LEAST_RECALL = 1e-4, 0.9, 0.1, 0.25
LEAST_POSITIVES = 2
LEAST_G, LIFT = 15.0, 2.0
PARTS = 6
FLUSH = 200_000
STEPS = 300
RATE = 0.1
SHRINK = 1e-5
CUT = 0.7
FOLDS, HELD_OUT = 3, 1

_words = re.compile(rb"[a-z\x80-\xff]+").findall


def word_features(word: bytes) -> tuple[bytes, ...]:
    return (word, *[word[:n] + b"*" for n in (4, 5, 6) if len(word) >= n])


def _doubled(counts: Counter[bytes]) -> set[bytes]:
    """The features, and for beginnings that several words share those of the second and the third."""
    found = set(counts)
    for f, n in counts.items():
        if n > 1:
            found.add(f + b"2")
            if n > 2:
                found.add(f + b"3")
    return found


def features(text: str) -> set[bytes]:
    return _doubled(Counter(f for w in set(_words(text.encode().lower())) for f in word_features(w)))


@dataclass
class Model:
    """``weights`` by feature; scores are the logistic function of the intercept and the weights of the features present."""

    bias: float
    weights: dict[bytes, float] = field(default_factory=dict)
    _known: dict[bytes, tuple[bytes, ...]] = field(default_factory=dict, repr=False)

    def __post_init__(self):
        self._roots = {f[:-1] if f[-2:-1] == b"*" else f for f in self.weights}

    def logit(self, found: set[bytes]) -> float:
        return self.bias + sum(self.weights[f] for f in sorted(found & self.weights.keys()))

    def score(self, text: str) -> float:
        found: list[bytes] = []
        known = self._known
        for w in set(_words(text.encode().lower())):
            own = known.get(w)
            if own is None:
                if len(known) > FLUSH:
                    known.clear()
                own = known[w] = tuple(f for f in word_features(w) if f in self._roots)
            if own:
                found += own
        z = self.logit(_doubled(Counter(found)))
        return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


@dataclass
class Rows:
    """A sparse 0/1 matrix, entry by entry, and each row's weight among the positives and among the unlabelled."""

    row: np.ndarray
    column: np.ndarray
    positive: np.ndarray
    unlabelled: np.ndarray

    def __len__(self) -> int:
        return len(self.positive)

    def only(self, keep: np.ndarray) -> Rows:
        own = keep[self.row]
        return Rows((np.cumsum(keep) - 1)[self.row[own]], self.column[own], self.positive[keep], self.unlabelled[keep])

    def margins(self, weights: np.ndarray) -> np.ndarray:
        """Each row's sum of weights; 0 without features."""
        return np.bincount(self.row, weights[self.column], len(self))


def train(data: Rows, n_features: int, prior: float, steps: int = STEPS, rate: float = RATE, shrink: float = SHRINK) -> tuple[float, np.ndarray]:
    """Intercept and weights."""
    bias, weights = math.log(prior / (1 - prior)), np.zeros(n_features)
    share_pos, share_all = data.positive / data.positive.sum(), data.unlabelled / data.unlabelled.sum()
    first, second = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, steps + 1):
        z = bias + data.margins(weights)
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        as_negative = np.logaddexp(0, z)
        rest = as_negative @ share_all - prior * (as_negative @ share_pos)
        up = p * (share_all - prior * share_pos)
        slope = up - prior * (1 - p) * share_pos if rest >= 0 else -up
        grad = np.append(np.bincount(data.column, slope[data.row], n_features) + shrink * weights, slope.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, bias = np.maximum(weights - move[:-1], 0), bias - move[-1]
    return float(bias), weights


def above(z: np.ndarray, data: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of z from the highest down, and the shares of positives and of unlabelled rows that have at least that."""
    order = np.argsort(-z, kind="stable")
    value = z[order]
    last = np.append(value[:-1] > value[1:], True)
    share = lambda w: (np.cumsum(w[order]) / w.sum())[last]
    return value[last], share(data.positive), share(data.unlabelled)


def best_cut(z: np.ndarray, data: Rows, prior: float) -> float:
    """Between two values of z, above the lowest: the cut with the best harmonic mean of recall and estimated precision."""
    value, recall, share = above(z, data)
    if len(value) < 2:
        return float(value[0]) + 1
    at = int(np.argmax((recall / (share + prior))[:-1]))
    return float((value[at] + value[at + 1]) / 2)


def estimated_prior(z: np.ndarray, data: Rows) -> float:
    """How many of the unlabelled rows are positive at most: wherever a cut is laid, the positives among them pass it as often as the confirmed ones do."""
    _, recall, share = above(z, data)
    enough = recall >= LEAST_RECALL
    return float(np.clip((share[enough] / recall[enough]).min(), LEAST_PRIOR, MOST_PRIOR))


def unseen_margins(data: Rows, n_features: int, prior: float) -> np.ndarray | None:
    """Each row's margin by a model of the other parts; None if there are too few rows for that."""
    part, out = np.arange(len(data)) % PARTS, np.zeros(len(data))
    for k in range(PARTS):
        rest = data.only(part != k)
        if not rest.positive.sum() or not rest.unlabelled.sum():
            return None
        out = np.where(part == k, data.margins(train(rest, n_features, prior)[1]), out)
    return out


def train_and_place(data: Rows, n_features: int, prior: float | None) -> tuple[float, np.ndarray]:
    """As ``train``, with an intercept by which ``CUT`` is where unseen rows are told apart best. Rows without features are below it."""
    if prior is None:
        z = unseen_margins(data, n_features, FIRST_PRIOR)
        prior = FIRST_PRIOR if z is None else estimated_prior(z, data)
    bias, weights = train(data, n_features, prior)
    z = unseen_margins(data, n_features, prior)
    return (bias if z is None else math.log(CUT / (1 - CUT)) - best_cut(z, data, prior)), weights


def _drawn(n: int, most: int) -> Column:
    """Whether an id is among about ``most`` of n."""
    return F.lit(True) if n <= most else F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 20)) < int((1 << 20) * most / n)


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MAX_POSITIVE, most_drawn: int = MAX_DRAWN) -> DataFrame:
    """(text, positive, drawn) of the training fold: confirmed toxic rows of about ``most`` ids, and a draw of about ``most_drawn`` from all."""
    fold = common.crc_column() % FOLDS != HELD_OUT
    toxic = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(fold & (F.col("toxic") == 1)).select("doc_id").distinct()
    toxic = toxic.where(_drawn(toxic.count(), most)).withColumn("positive", F.lit(True))
    texts = common.keyed_text(docs).where(fold)
    # about ``most`` ids at most, so they can go to the texts
    rows = texts.withColumn("drawn", _drawn(texts.count(), most_drawn)).join(F.broadcast(toxic), "doc_id", "left")
    return rows.select("text", F.coalesce("positive", F.lit(False)).alias("positive"), "drawn").where("positive or drawn")


def count_features(rows: DataFrame) -> DataFrame:
    """feature, in_positive, in_rest: how many positive rows have the feature, and how many other drawn ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pos: Counter[bytes] = Counter()
        rest: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            keys = [*rest, *(f for f in pos if f not in rest)]
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([pos[f] for f in keys], pa.int64()), pa.array([rest[f] for f in keys], pa.int64())], names=["feature", "in_positive", "in_rest"])

        for batch in batches:
            for text, positive in zip(*(batch.column(c).to_pylist() for c in ("text", "positive")), strict=True):
                found = features(text)
                (pos if positive else rest).update(found)
                if len(rest) + len(pos) > FLUSH:
                    yield out()
                    pos.clear()
                    rest.clear()
        yield out()

    made = rows.mapInArrow(run, "feature binary, in_positive long, in_rest long")
    return made.groupBy("feature").agg(F.sum("in_positive").alias("in_positive"), F.sum("in_rest").alias("in_rest"))


def stands_out(a: Column, n: int, b: Column, m: int) -> Column:
    """Whether a of n rows are significantly more than b of m."""
    part = lambda k, of, share: F.when(k > 0, k * F.log(k / (of * share))).otherwise(0.0)
    both = (a + b) / (n + m)
    g = 2 * (part(a, n, both) + part(n - a, n, 1 - both) + part(b, m, both) + part(m - b, m, 1 - both))
    return (a / n >= LIFT * (b + 1) / (m + 2)) & (g >= LEAST_G)


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_POSITIVE, most_drawn: int = MAX_DRAWN, prior: float | None = None) -> Model:
    rows = common.checkpoint(training_rows(docs, labels, most, most_drawn))
    n, n_pos, n_rest = rows.agg(F.count_if("drawn"), F.count_if("positive"), F.count_if(~F.col("positive"))).first()
    nothing = Model(-40.0)
    if not n or not n_pos or not n_rest:
        return nothing
    out = stands_out(F.col("in_positive"), n_pos, F.col("in_rest"), n_rest)
    # features of at most about ``most`` positive rows
    chosen = sorted(bytes(r["feature"]) for r in count_features(rows).where((F.col("in_positive") >= LEAST_POSITIVES) & out).select("feature").collect())
    if not chosen:
        return nothing
    place = {f: i for i, f in enumerate(chosen)}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.array(sorted(place[f] for f in features(t) if f in place), "<i4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column("positive"), batch.column("drawn")], names=["present", "positive", "drawn"])

    # rows of at most about ``most`` and ``most_drawn`` ids; those with the same features are one row with weights
    encoded = rows.mapInArrow(encode, "present binary, positive boolean, drawn boolean").groupBy("present").agg(F.count_if("positive").alias("p"), F.count_if("drawn").alias("u"))
    matrix = encoded.orderBy(F.xxhash64("present"), "present").toArrow()
    present = [np.frombuffer(x, "<i4") for x in matrix.column("present").to_pylist()]
    data = Rows(np.repeat(np.arange(len(present)), [len(x) for x in present]), np.concatenate(present).astype(np.int64), matrix.column("p").to_numpy().astype(float), matrix.column("u").to_numpy().astype(float))
    bias, weights = train_and_place(data, len(chosen), prior)
    return Model(bias, {f: float(w) for f, w in zip(chosen, weights, strict=True) if w})


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""
    bias, weights = model.bias, model.weights

    def make():
        own = Model(bias, weights)
        return lambda doc_id, text: (doc_id, own.score(text))

    return common.row_map(common.keyed_text(docs), make, "doc_id long, score double")


def reject(docs: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """The rows whose text scores below the cut, with all their columns."""
    bias, weights = model.bias, model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(bias, weights)
        for batch in batches:
            keep = [own.score(t or "") < cut for t in batch.column("row").field("text").to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    rows = docs.select(common.whole_row(docs))
    return rows.mapInArrow(run, rows.schema).select("row.*")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    scored = score_documents(docs, fit(docs, common.table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (common.crc_column() % FOLDS == HELD_OUT).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


QUERIES = {"op7_toxicity": op7_toxicity}
ORACLES: dict[str, str] = {}
