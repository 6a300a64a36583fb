import random

import numpy as np
import pyarrow as pa
import pytest

from folioquest.functions.providers import HashingEmbedder
from folioquest.operators import embedding, similarity


def vectors(spark, values, name="idx", **more):
    return spark.createDataFrame([(k, [float(x) for x in v], *[c[k] for c in more.values()]) for k, v in enumerate(values)], f"{name} long, embedding array<float>" + "".join(f", {c} string" for c in more))


@pytest.mark.parametrize("metric", ["l2", "ip", "cosine"])
@pytest.mark.parametrize("side", [8192, 7])
def test_nearest_against_brute_force(spark, monkeypatch, metric, side):
    monkeypatch.setattr(similarity, "SIDE", side)
    rng = np.random.default_rng(1)
    rows, queries = rng.normal(size=(60, 8)).astype(np.float32), rng.normal(size=(9, 8)).astype(np.float32)
    rows[20] = rows[10]
    got = similarity.top_matches(vectors(spark, queries, "q_idx"), vectors(spark, rows), 4, metric).orderBy("q_idx", "rank").collect()
    a, b = queries.astype(float), rows.astype(float)
    if metric == "l2":
        scores = -((a[:, None] - b[None]) ** 2).sum(axis=2)
    else:
        scores = a @ b.T / np.linalg.norm(a, axis=1)[:, None] / np.linalg.norm(b, axis=1)
    want = [(q, int(i)) for q in range(9) for i in sorted(range(60), key=lambda i: (-scores[q, i], i))[:4]]
    assert [(r["q_idx"], r["idx"]) for r in got] == want
    assert got[0]["score"] == pytest.approx(abs(scores[0, want[0][1]]) if metric == "l2" else scores[0, want[0][1]], rel=1e-5)


@pytest.mark.parametrize("side", [8192, 7])
def test_exclusions_against_brute_force(spark, monkeypatch, side):
    """What is left out doesn't take the place of what comes next, however much there is of it."""
    monkeypatch.setattr(similarity, "SIDE", side)
    rng = np.random.default_rng(4)
    rows, queries = rng.normal(size=(50, 4)), rng.normal(size=(6, 4))
    order = np.argsort(((queries[:, None] - rows[None]) ** 2).sum(axis=2), axis=1)
    left_out = [(q, int(i)) for q in range(5) for i in order[q][: 2 + 11 * q]] + [(0, 999)]
    got = similarity.top_matches(vectors(spark, queries, "q_idx"), vectors(spark, rows), 2, "l2", excluded=spark.createDataFrame(left_out, "q_idx long, idx long")).orderBy("q_idx", "rank").collect()
    want = [(q, int(i)) for q in range(6) for i in [i for i in order[q] if (q, i) not in left_out][:2]]
    assert [(r["q_idx"], r["idx"]) for r in got] == want


@pytest.mark.parametrize("side", [8192, 40])
@pytest.mark.parametrize("clustered", [True, False])
def test_index_recall(spark, monkeypatch, side, clustered):
    monkeypatch.setattr(similarity, "SIDE", side)
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(40, 16))
    rows = (middles[rng.integers(0, 40, 1500)] + 0.3 * rng.normal(size=(1500, 16))) if clustered else rng.normal(size=(1500, 16))
    queries = rows[::20] + 0.1 * rng.normal(size=(75, 16))
    r, q = vectors(spark, rows), vectors(spark, queries, "q_idx")
    lists = similarity.Lists.fit(r)
    assert len(lists.centres) == round(1500**0.5) and lists.probes < (12 if clustered else 39)
    pairs = lambda df: {(x["q_idx"], x["idx"]) for x in df.collect()}
    exact = pairs(similarity.top_matches(q, r, 5))
    found = similarity.near_matches(q, r, 5, lists)
    near = pairs(found)
    assert len(near) == len(exact) and len(near & exact) >= 0.9 * len(exact)
    # with all lists it is exact
    assert pairs(similarity.near_matches(q, r, 5, similarity.Lists(lists.centres, len(lists.centres)))) == exact


def test_index_over_the_test_table(spark):
    import os

    from folioquest.plans import vector_queries

    data = "/root/testdata/sf0.01"
    if not os.path.isdir(data):
        pytest.skip("the driver's tables aren't here")
    pairs = lambda df: {(x["q_idx"], x["idx"]) for x in df.collect()}
    exact, near = pairs(vector_queries.knn_ip(spark, data)), pairs(vector_queries.knn_index(spark, data))
    assert len(near & exact) >= 0.9 * len(exact)


def test_index_of_an_empty_table(spark):
    none = vectors(spark, [[1.0, 0.0]]).limit(0)
    assert similarity.near_matches(vectors(spark, [[1, 0]], "q_idx"), none, 3, similarity.Lists.fit(none)).count() == 0


def test_related_leaves(spark):
    leaves = vectors(spark, [[1, 0], [1, 0.1], [1, 0.2], [0, 1], [0, 0], [1, 0]], "leaf_idx", source=["a", "a", "b", "b", "b", "b"], content=["x", "x", "x", "x", "x", ""])
    got = {(r["leaf_idx"], r["related_idx"]) for r in similarity.related_leaves(leaves).collect()}
    # own source, zero vectors and leaves without content are left out
    assert got == {(0, 2), (1, 2), (2, 0), (2, 1), (5, 0), (5, 1)}
    assert {(r["leaf_idx"], r["related_idx"]) for r in similarity.related_leaves(leaves, index=True).collect()} == got


def test_diverse_search(spark):
    chunks = vectors(spark, [[1, 0], [1, 0.01], [0.5, 0.5]], content=["the same long prefix here one", "the same long prefix here two", "something else"])
    query = vectors(spark, [[1, 0]], "q_idx")
    assert [r["idx"] for r in similarity.search(query, chunks, 2).orderBy("place").collect()] == [0, 2]
    excluded = spark.createDataFrame([(0, 0)], "q_idx long, idx long")
    assert [r["idx"] for r in similarity.search(query, chunks, 2, excluded=excluded, n_excluded=1).orderBy("place").collect()] == [1, 2]


def test_store(spark):
    store = similarity.VectorStore()
    with pytest.raises(RuntimeError):
        store.search(vectors(spark, [[1, 0]], "q_idx"))
    chunks = spark.createDataFrame([(0, "a b"), (1, "c d")], "idx long, content string")
    v = vectors(spark, [[3, 4], [0, 0]])
    with pytest.raises(ValueError):
        store.add(chunks.limit(1), v)
    store.add(chunks, v)
    more = spark.createDataFrame([(2, "e f")], "idx long, content string")
    store.add(more, spark.createDataFrame([(2, [0.0, 2.0])], "idx long, embedding array<float>"))
    assert len(store) == 3
    assert {r["idx"]: [round(x, 6) for x in r["unit"]] for r in store.unit().collect()} == {0: [0.6, 0.8], 1: [0, 0], 2: [0, 1]}


def test_segments_against_a_plain_fold(spark):
    rng = random.Random(2)
    stock = [f"w{k}" for k in range(12)]
    rows = [(d, s, " ".join(rng.choice(stock) for _ in range(rng.randrange(0, 9)))) for d in range(20) for s in range(12)]
    got = {(r["doc_id"], r["seg_no"]) for r in similarity.dedup_segments(spark.createDataFrame(rows, "doc_id int, seg_no int, content string")).collect()}
    want = set()
    for d in range(20):
        kept = []
        for _, s, c in (r for r in rows if r[0] == d):
            own = set(c.lower().split())
            if not any(len(own & k) / max(len(own), len(k), 1) > 0.7 for k in kept):
                kept.append(own)
                want.add((d, s))
    assert got == want


def test_embedding_keeps_order_and_takes_blanks(spark):
    df = spark.createDataFrame([(0, "one two"), (1, " "), (2, None), (3, "one two")], "id int, t string")
    got = {r["id"]: r["embedding"] for r in embedding.embed(df, "t", HashingEmbedder(16), batch=2).collect()}
    assert got[0] == got[3] == pytest.approx(embedding.embed_query("one two", HashingEmbedder(16))) and got[1] == got[2] == [0.0] * 16


def test_sources_are_compared_as_numbers():
    left, right = (pa.table({"source": pa.chunked_array([pa.array(x, pa.string()) for x in parts])}) for parts in ([["a", None], ["b"]], [["b", "c", None], ["a", "a"]]))
    mine, theirs = similarity._numbered(left, right)
    want = [[x == y for y in right.column("source").to_pylist()] for x in left.column("source").to_pylist()]
    assert mine.dtype.kind == "i" and (mine[:, None] == theirs[None]).tolist() == want


@pytest.mark.parametrize("k", [1, 2, 3, 4, 7])
def test_edges_of_the_best(k):
    scores = np.random.default_rng(k).integers(0, 9, (50, 20)).astype(float)
    scores[:9] = -np.inf
    scores[3, 5], scores[20] = 1.0, 4.0
    assert similarity._edges(scores, k).tolist() == np.sort(scores, axis=1)[:, -k].tolist()
