"""Nearest neighbours in blocks, exact or by an index, diversity, and near-duplicate segments.

Exact search: every query meets every row once, in the cells of a grid: queries are dealt to rows of cells and vectors to
columns, so a cell holds at most about ``SIDE`` of each and works by one matrix product. A cell gives each query its best
few; a window with a limit merges them. Nothing is a join of rows with rows. The work is the product of both numbers.

By an index (``Lists``): unit vectors are dealt to the nearest of about the square root of their number of centres, which
are fitted on a bounded sample; every vector is in a list. A query meets only the lists of its nearest centres, each in
cells of the same kind. How many lists that takes depends on how the vectors cluster, so it is measured on the sample:
as many as hold ``RECALL`` of its vectors' nearest ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioquest.functions import text
from folioquest.operators import ordering

SIDE = 8192
#: The most vectors that centres are fitted on, the most centres, and the rounds of fitting.
SAMPLE, MOST_LISTS, ROUNDS = 65_536, 16_384, 12
#: Share of the nearest vectors whose lists are to be looked into, and how many vectors, with how many nearest ones, it is measured on.
RECALL, ASKED, ASKED_FOR = 0.96, 512, 5
CELL_OUT = "q_idx long, idx long, score double"
CELL_ARROW = pa.schema([("q_idx", pa.int64()), ("idx", pa.int64()), ("score", pa.float64())])


def _matrix(table: pa.Table) -> np.ndarray:
    column = table.column("embedding").combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(len(table), -1)


def _best(scores: np.ndarray, idx: np.ndarray, k: int, cut: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k largest of each row, ties to the lower index."""
    order = np.lexsort((np.broadcast_to(idx, scores.shape), -scores), axis=1)[:, :k] if scores.shape[1] <= 4 * k else _two_steps(scores, idx, k)
    rows = np.repeat(np.arange(len(scores)), order.shape[1])
    cols = order.ravel()
    ok = np.isfinite(scores[rows, cols])
    if cut is not None:
        ok &= scores[rows, cols] >= cut
    return rows[ok], cols[ok]


def _two_steps(scores: np.ndarray, idx: np.ndarray, k: int) -> np.ndarray:
    """All that reach the k-th best value are sorted, so ties at the edge are settled by index."""
    edge = _edges(scores, k)
    out = np.empty((len(scores), k), np.int64)
    for r in range(len(scores)):
        at = np.flatnonzero(scores[r] >= edge[r])
        out[r] = at[np.lexsort((idx[at], -scores[r, at]))[:k]]
    return out


def _edges(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest value of each row; for a few, by looking for the largest again and again."""
    if k > 4 or np.isnan(scores).any():
        return -np.partition(-scores, k - 1, axis=1)[:, k - 1]
    left, rows = scores.copy(), np.arange(len(scores))
    for _ in range(k - 1):
        left[rows, left.argmax(axis=1)] = -np.inf
    return left.max(axis=1)


def _numbered(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The sources of both tables as numbers, equal where the sources are; comparing strings took most of a cell's time."""
    both = pa.chunked_array([*left.column("source").chunks, *right.column("source").chunks]).combine_chunks().dictionary_encode()
    codes = both.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    return codes[: len(left)], codes[len(left) :]


def _cell(metric: str, k: int, cut: float | None, other_source: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The best of a cell for each of its queries; ``left_out`` of a query, where it is there, has the rows that don't count."""

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return CELL_ARROW.empty_table()
        right = right.sort_by("idx")
        a, b, idx = _matrix(left), _matrix(right), np.asarray(right.column("idx"))
        q_idx = np.asarray(left.column("q_idx"))
        na, nb = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
        left_out = left.column("left_out").to_pylist() if "left_out" in left.column_names else []
        mine, theirs = _numbered(left, right) if other_source else (None, None)
        out = []
        for lo in range(0, len(a), 512):
            part = slice(lo, lo + 512)
            scores = a[part] @ b.T
            if metric == "l2":
                scores = -np.maximum(na[part, None] ** 2 + nb[None] ** 2 - 2 * scores, 0)
            else:
                with np.errstate(invalid="ignore", divide="ignore"):
                    scores = scores / (na[part, None] * nb[None])
                scores[~np.isfinite(scores)] = -np.inf if metric == "cosine" else 0
            if other_source:
                scores[mine[part, None] == theirs[None]] = -np.inf
                scores[q_idx[part, None] == idx[None]] = -np.inf
            for row, ids in enumerate(left_out[part]):
                if ids:
                    at = np.minimum(np.searchsorted(idx, ids), len(idx) - 1)
                    scores[row, at[idx[at] == ids]] = -np.inf
            i, j = _best(scores, idx, k, cut)
            out.append(pa.table([q_idx[part][i], idx[j], -scores[i, j] if metric == "l2" else scores[i, j]], schema=CELL_ARROW))
        return pa.concat_tables(out)

    return cell


def _merged(found: DataFrame, k: int, metric: str) -> DataFrame:
    best = F.asc("score") if metric == "l2" else F.desc("score")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("q_idx").orderBy(best, "idx")))
    return ranked.where(F.col("rank") <= k)


def top_matches(queries: DataFrame, rows: DataFrame, k: int, metric: str = "cosine", cut: float | None = None, other_source: bool = False, excluded: DataFrame | None = None) -> DataFrame:
    """q_idx, idx, score, rank from 1: the k best rows for each query.

    queries: q_idx, embedding (and source); rows: idx, embedding (and source). ``cosine`` and ``ip`` are best when
    large, ``l2`` (squared) when small. For ``ip`` both sides are normalised first, as the reference's index does; with
    ``cosine`` a zero vector matches nothing. ``other_source`` leaves out rows of the query's own source (and itself),
    ``excluded`` (q_idx, idx) other pairs; both before the best are chosen.
    """
    n_q, n_r = queries.count(), rows.count()
    g_q, g_r = max(1, -(-n_q // SIDE)), max(1, -(-n_r // SIDE))
    source = ["source"] if other_source else []
    column_of = lambda idx: F.pmod(F.xxhash64(idx), F.lit(g_r))
    q = queries.select("q_idx", "embedding", *source, F.pmod(F.xxhash64("q_idx"), F.lit(g_q)).alias("gq"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(g_r - 1).cast("long"))).alias("gr"))
    r = rows.select("idx", "embedding", *source, column_of("idx").alias("gr"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(g_q - 1).cast("long"))).alias("gq"))
    if excluded is not None:
        pairs = excluded.select(F.col("q_idx").cast("long").alias("q_idx"), F.col("idx").cast("long").alias("idx"))
        q = q.join(pairs.groupBy("q_idx", column_of("idx").alias("gr")).agg(F.collect_set("idx").alias("left_out")), ["q_idx", "gr"], "left")
    found = q.groupBy("gq", "gr").cogroup(r.groupBy("gq", "gr")).applyInArrow(_cell(metric, k, cut, other_source), CELL_OUT)
    return _merged(found, k, metric)


@dataclass(frozen=True)
class Lists:
    """Centres of unit vectors, one a row, and how many lists a query looks into."""

    centres: np.ndarray
    probes: int

    @staticmethod
    def fit(rows: DataFrame, seed: int = 0, lists: int | None = None, recall: float = RECALL) -> Lists:
        """Centres of ``rows`` (idx, embedding) by spherical k-means on at most about ``SAMPLE`` of them, drawn by a hash. ``lists``: the square root of their number without it."""
        n = rows.count()
        drawn = rows if n <= SAMPLE else rows.where(F.pmod(F.xxhash64("idx", F.lit(seed)), F.lit(1 << 20)) < int((1 << 20) * SAMPLE / n))
        table = drawn.select("idx", "embedding").toArrow().sort_by("idx")  # about SAMPLE rows
        if not len(table):
            return Lists(np.zeros((1, 1)), 1)
        x = _unit(_matrix(table))
        rng = np.random.default_rng(seed)
        size = min(len(x), MOST_LISTS, lists or max(1, round(n**0.5)))
        centres = x[np.sort(rng.choice(len(x), size, replace=False))]
        for _ in range(ROUNDS):
            own = nearest(x, centres, 1)[:, 0]
            sums = np.zeros_like(centres)
            np.add.at(sums, own, x)
            empty = np.bincount(own, minlength=size) == 0
            sums[empty] = x[rng.integers(0, len(x), int(empty.sum()))]
            centres = _unit(sums)
        return Lists(centres, probes_for(x, centres, recall))


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def nearest(x: np.ndarray, centres: np.ndarray, k: int) -> np.ndarray:
    """The k nearest centres of each row, best first."""
    out = np.empty((len(x), min(k, len(centres))), np.int64)
    for lo in range(0, len(x), 4096):
        scores = x[lo : lo + 4096] @ centres.T
        out[lo : lo + 4096] = np.argsort(-scores, axis=1, kind="stable")[:, : out.shape[1]]
    return out


def probes_for(x: np.ndarray, centres: np.ndarray, recall: float) -> int:
    """The least number of lists that hold the share ``recall`` of the nearest vectors, over some of the vectors."""
    own = nearest(x, centres, 1)[:, 0]
    needed = []
    for i in range(0, len(x), max(1, len(x) // ASKED)):
        scores = x @ x[i]
        scores[i] = -np.inf
        best = np.argpartition(-scores, min(ASKED_FOR, len(x) - 1))[:ASKED_FOR]
        place = np.empty(len(centres), np.int64)
        place[nearest(x[i : i + 1], centres, len(centres))[0]] = np.arange(len(centres))
        needed += (place[own[best[best != i]]] + 1).tolist()
    return int(np.quantile(needed, recall, method="higher")) if needed else 1


def _listed(df: DataFrame, lists: Lists, key: str, k: int) -> DataFrame:
    """A row for each of the k nearest lists of a vector."""
    shared = df.sparkSession.sparkContext.broadcast(lists.centres)  # MOST_LISTS rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = nearest(_unit(_matrix(pa.Table.from_batches([batch.select(["embedding"])]))), shared.value, k)
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(found.tolist(), pa.list_(pa.int64()))], names=["id", "lists"])

    found = df.select(key, "embedding").mapInArrow(run, "id long, lists array<long>")
    return found.select(F.col("id").alias(key), F.explode("lists").alias("list"))


def near_matches(queries: DataFrame, rows: DataFrame, k: int, lists: Lists, metric: str = "cosine", cut: float | None = None, other_source: bool = False) -> DataFrame:
    """As ``top_matches``, over the lists of each query's nearest centres. Lists of many queries or rows are cells of a grid of their own, so a cell has about ``SIDE`` of each."""
    source = ["source"] if other_source else []
    q = _listed(queries, lists, "q_idx", lists.probes).join(queries.select("q_idx", "embedding", *source), "q_idx")
    r = _listed(rows, lists, "idx", 1).join(rows.select("idx", "embedding", *source), "idx")
    sizes = r.groupBy("list").agg(F.count("*").alias("n_r")).join(q.groupBy("list").agg(F.count("*").alias("n_q")), "list")
    grid = sizes.select("list", F.ceil(F.col("n_q") / SIDE).alias("g_q"), F.ceil(F.col("n_r") / SIDE).alias("g_r"))
    q = q.join(F.broadcast(grid), "list")  # MOST_LISTS rows at most
    r = r.join(F.broadcast(grid), "list")
    q = q.select("list", "q_idx", "embedding", *source, F.pmod(F.xxhash64("q_idx"), "g_q").alias("gq"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("g_r") - 1)).alias("gr"))
    r = r.select("list", "idx", "embedding", *source, F.pmod(F.xxhash64("idx"), "g_r").alias("gr"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("g_q") - 1)).alias("gq"))
    found = q.groupBy("list", "gq", "gr").cogroup(r.groupBy("list", "gq", "gr")).applyInArrow(_cell(metric, k, cut, other_source), CELL_OUT)
    return _merged(found, k, metric)


def related_leaves(leaves: DataFrame, cut: float = 0.5, k: int = 3, index: bool = False) -> DataFrame:
    """leaf_idx, related_idx, score, rank: the leaves of other sources most like each leaf's title. Leaves without content are related to nothing else, but may look for relations. Exact without ``index``; with it a few are missed."""
    q = leaves.select(F.col("leaf_idx").alias("q_idx"), "embedding", "source")
    r = leaves.where(F.length("content") > 0).select(F.col("leaf_idx").alias("idx"), "embedding", "source")
    found = near_matches(q, r, k, Lists.fit(r), "cosine", cut, other_source=True) if index else top_matches(q, r, k, "cosine", cut, other_source=True)
    return found.select(F.col("q_idx").alias("leaf_idx"), F.col("idx").alias("related_idx"), "score", "rank")


def _diverse(candidates: Column, k: int) -> Column:
    """Fold in rank order: a candidate stays unless over 0.6 of its words are in one that stayed; without words it stays only as the first."""

    def step(kept: Column, c: Column) -> Column:
        like = F.exists(kept, lambda x: text.overlap(c["words"], x["words"], "candidate") > 0.6)
        too_similar = (F.size(kept) > 0) & (like | (F.size(c["words"]) == 0))
        return F.when((F.size(kept) >= k) | too_similar, kept).otherwise(F.concat(kept, F.array(c)))

    return F.aggregate(candidates, F.filter(candidates, lambda c: F.lit(False)), step)


def search(queries: DataFrame, chunks: DataFrame, k: int = 5, metric: str = "l2", excluded: DataFrame | None = None, n_excluded: int = 0) -> DataFrame:
    """q_idx, idx, score, place: k diverse results for each query out of the ``3 k + n_excluded`` nearest.

    chunks: idx, embedding, content. ``excluded``: rows (q_idx, idx) that are left out after the fetch, as the
    reference does. An empty store is an error.
    """
    if chunks.limit(1).count() == 0:
        raise RuntimeError("the store is empty")
    near = top_matches(queries, chunks, 3 * k + n_excluded, metric)
    if excluded is not None:
        near = near.join(excluded, ["q_idx", "idx"], "left_anti")
    worded = near.join(chunks.select("idx", text.word_set("content").alias("words")), "idx")
    each = worded.groupBy("q_idx").agg(F.array_sort(F.collect_list(F.struct("rank", "idx", "score", "words"))).alias("found"))
    picked = each.select("q_idx", F.posexplode(_diverse(F.col("found"), k)).alias("place", "c"))
    return picked.select("q_idx", F.col("c.idx").alias("idx"), F.col("c.score").alias("score"), (F.col("place") + 1).alias("place"))


class VectorStore:
    """Chunks with their vectors as rows; appending keeps earlier chunks. Vectors are never changed in place: ``unit`` has them normalised."""

    def __init__(self, metric: str = "l2"):
        self.metric, self.rows = metric, None

    def add(self, chunks: DataFrame, embeddings: DataFrame) -> None:
        """chunks: idx, content, ...; embeddings: idx, embedding. Both need the same ids."""
        both = chunks.join(embeddings, "idx")
        n = both.count()
        if n != chunks.count() or n != embeddings.count():
            raise ValueError("chunks and embeddings don't match")
        self.rows = both if self.rows is None else self.rows.unionByName(both)

    def __len__(self) -> int:
        return 0 if self.rows is None else self.rows.count()

    def unit(self) -> DataFrame:
        norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
        return self.rows.withColumn("unit", F.transform("embedding", lambda x: F.when(norm > 0, x / norm).otherwise(x)))

    def search(self, queries: DataFrame, k: int = 5, excluded: DataFrame | None = None, n_excluded: int = 0) -> DataFrame:
        if self.rows is None:
            raise RuntimeError("the store is empty")
        return search(queries, self.rows, k, self.metric, excluded, n_excluded)


def keep_new(word_sets: list[frozenset], most: float = 0.7) -> list[bool]:
    """Fold: a set stays unless it shares over ``most`` of the larger set with one that stayed. Kept sets are found by their words, so sets that share none are never compared."""
    by_word: dict[str, list[int]] = {}
    kept: list[frozenset] = []
    out = []
    for own in word_sets:
        shared: dict[int, int] = {}
        for w in own:
            for k in by_word.get(w, ()):
                shared[k] = shared.get(k, 0) + 1
        new = not any(n / max(len(own), len(kept[k])) > most for k, n in shared.items())
        out.append(new)
        if new:
            for w in own:
                by_word.setdefault(w, []).append(len(kept))
            kept.append(own)
    return out


def new_segments(own: pa.Table, column: str) -> pa.Array:
    """Which of a document's segments, in order, don't mostly repeat an earlier one."""
    return pa.array(keep_new([frozenset((t or "").lower().split()) for t in own.column(column).to_pylist()]), pa.bool_())


def dedup_segments(segments: DataFrame, key: str = "doc_id", order: str = "seg_no", column: str = "content") -> DataFrame:
    """Each document's segments without those that mostly repeat an earlier one. The order within a document decides, so a document is folded as a whole."""
    return ordering.folded(segments, key, [order], lambda own: own.filter(new_segments(own, column)), segments.schema)
