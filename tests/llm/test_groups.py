"""SimHash groups and the whole pipeline against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from folioquest.llm import common, packing, planes, repeats, secrets, simhash, toxicity
from tests.llm.conftest import SCHEMA, extras_unchanged, words
from tests.llm.test_packing import check
from tests.llm.test_repeats import gone_bytes
from tests.llm.test_shingles import brute_groups


def brute_fingerprint(text):
    own = re.findall(common.WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not own:
        return 0
    shingles = [" ".join(own[i : i + 3]) for i in range(len(own) - 2)] or [" ".join(own)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    root = list(range(len(fps)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(k) for k in range(len(fps))]


def test_groups_against_brute_force(spark, folder, rows):
    got = sorted(tuple(r) for r in simhash.op10_simhash(spark, folder).collect())
    fps = [brute_fingerprint(r[1]) for r in rows]
    group = brute_components(fps)
    least = {g: min(r[0] for r, h in zip(rows, group, strict=True) if h == g) for g in set(group)}
    assert got == sorted((r[0], f"{f:016x}", least[g]) for r, f, g in zip(rows, fps, group, strict=True))


@pytest.mark.parametrize(("hot", "last"), [(4096, 12), (3, 36), (3, 28)])
def test_links_with_hot_buckets(spark, monkeypatch, hot, last):
    monkeypatch.setattr(simhash, "LAST_BITS", last)
    rng = random.Random(7)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for f in list(fps)[:10]:
        for _ in range(15):
            for _ in range(rng.randrange(1, 5)):
                f ^= 1 << rng.randrange(64)
            fps.add(f)
    fps = sorted(fps)
    signed = [f - (f >> 63 << 64) for f in fps]
    links = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), hot)
    roots = {r["node"]: r["root"] for r in simhash.connected(links).collect()}
    got, want = {}, {}
    for f, g in zip(signed, brute_components(fps), strict=True):
        got.setdefault(roots.get(f, f), set()).add(f)
        want.setdefault(g, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_bit_slices_against_counting():
    rng = np.random.default_rng(8)
    values = rng.integers(0, 1 << 63, 4, dtype=np.uint64)[rng.integers(0, 4, 500)]
    for _ in range(4):
        values ^= np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)
    bits = planes.planes(values)
    for step in (1, 2, 63, 64, 65, 300):
        valid = np.zeros(bits.shape[1] - 2, np.uint64)
        packed = np.packbits(np.ones(500 - step, np.uint8), bitorder="little")
        valid.view(np.uint8)[: len(packed)] = packed
        valid = valid[: bits.shape[1] - 1 - step // 64]
        for radius in (0, 1, 3, 7, 8, 31, 54):
            near = planes.within_radius(bits, step, valid, radius)
            assert near.tolist() == np.flatnonzero(np.bitwise_count(values[:-step] ^ values[step:]) <= radius).tolist()


@pytest.mark.parametrize("radius", [3, 54])
def test_near_pairs_of_groups(radius):
    rng = np.random.default_rng(9)
    group = np.sort(rng.integers(0, 30, 400))
    values = rng.integers(0, 1 << 63, (6, 2), dtype=np.uint64)[rng.integers(0, 6, 400)] ^ (np.uint64(1) << rng.integers(0, 64, (400, 2)).astype(np.uint64))
    got = {(int(i), int(j)) for a, b in planes.near_pairs(group, values, radius) for i, j in zip(a, b, strict=True)}
    want = {(i, j) for i in range(400) for j in range(i + 1, 400) if group[i] == group[j] and int(np.bitwise_count(values[i] ^ values[j]).sum()) <= radius}
    assert got == want


def test_a_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(1000, 1001)], "a long, b long")
    roots = {r["node"]: r["root"] for r in simhash.connected(edges).collect()}
    assert {roots[k] for k in range(201)} == {0} and roots[1001] == 1000


def test_empty_and_clashing(empty, clashing):
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each(empty).count() == 0
    assert simhash.near_duplicates(clashing).count() == 13
    out = simhash.one_of_each(clashing)
    assert out.columns == clashing.columns and extras_unchanged(out.collect())


def test_one_of_each_with_repeated_rows(spark):
    text = words(random.Random(9), 50, 3000)
    rows = [(5, text), (3, text), (3, text), (8, "something else altogether now"), (None, None), (None, "")]
    out = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or -1) for r in out) == [-1, 3, 8]


def test_stage_names_and_columns(spark, folder, rows):
    assert len(corpus_pipeline.STAGES) == 5
    docs = common.documents(spark, folder)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns


def test_pipeline_against_brute_force(spark, folder, rows, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 1 << 30)
    docs = common.documents(spark, folder)
    model = toxicity.fit(docs, common.table(spark, folder, "labels"))
    own = toxicity.Model(model.bias, model.weights)
    left = [(r[0], r[1]) for r in rows if own.score(r[1] or "") < 0.7]
    group = brute_groups([t for _, t in left])
    one = {}
    for row, g in zip(left, group, strict=True):
        order = (row[0], xxhash.xxh64_intdigest((row[1] or "").encode(), 42))
        one[g] = min(one.get(g, (order, row)), (order, row), key=lambda x: x[0])
    left = sorted((row for _, row in one.values()), key=lambda r: r[0])
    texts = [(t or "").encode() for _, t in left]
    want = []
    for (doc_id, text), data, gone in zip(left, texts, gone_bytes(texts, True), strict=True):
        kept = "".join(c for c, whole in _characters(data, gone) if not whole)
        spans = sorted((m.start(), m.end()) for r in secrets.RULES for m in re.finditer(r.pattern, kept) if len(m[r.group]) >= r.least)
        masked, at = "", 0
        for k, (a, b) in enumerate(spans):
            if a > at or k == 0:
                masked += kept[at:a] + "[SECRET]"
            at = max(at, b)
        masked += kept[at:]
        ids = [*packing.token_ids(masked), 0]
        want.append((doc_id, len(ids)))
    got = corpus_pipeline.run(spark, folder).collect()
    sizes = {}
    for p in got:
        sizes[p["doc_id"]] = sizes.get(p["doc_id"], 0) + p["length"]
    assert sorted(sizes.items()) == sorted(want)
    check(got)


def _characters(data, gone):
    at = 0
    for c in data.decode():
        n = len(c.encode())
        yield c, gone[at : at + n].all()
        at += n


def test_schema_is_kept(spark, folder):
    assert spark.createDataFrame([], SCHEMA).columns == common.documents(spark, folder).columns


def test_pipeline_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_queries_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
