"""Near copies by five-word shingles against brute force."""

import random

import numpy as np
import pytest

import corpus_pipeline
from folioquest.llm import shingles, simhash
from tests.llm.conftest import SCHEMA, extras_unchanged, words


def brute_set(text):
    own = (text or "").encode().lower().split()
    return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set()


def brute_groups(texts):
    sets, root = [brute_set(t) for t in texts], list(range(len(texts)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(k) for k in range(len(texts))]


def brute_kept(rows):
    least = {}
    for (doc_id, _), g in zip(rows, brute_groups([t for _, t in rows]), strict=True):
        least[g] = min(least.get(g, doc_id), doc_id)
    return sorted(least.values())


def changed(rng, text, n):
    own = text.split()
    for at in rng.sample(range(len(own)), n):
        own[at] = f"new{rng.randrange(10**9)}"
    return " ".join(own)


def planted(seed=11):
    """Pairs from 0.7 to 0.97, groups whose members differ by chains of changes, and one common passage."""
    rng, texts = random.Random(seed), ["", None, " \n", "one two", "One  two", "one two three"]
    common_part = words(rng, 30, 5000)
    for n in (40, 100, 300):
        for k in range(12):
            base = words(rng, n, 5000)
            texts += [base, changed(rng, base, 1 + k * n // 400)]
    for _ in range(20):
        texts.append(words(rng, rng.randrange(5, 200), 5000) + " " + common_part)
    large = words(rng, 60, 5000)
    texts += [changed(rng, large, 1 + k % 2) for k in range(60)]
    ids = rng.sample(range(1000), len(texts))
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize("rounds", [2, 0])
def test_kept_against_brute_force(spark, rounds):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(r["doc_id"] for r in simhash.one_of_each(docs, rounds).collect()) == brute_kept(rows)


def test_the_pipeline_drops_near_copies_of_0_8_to_0_97(spark, tmp_path):
    rng = random.Random(12)
    rows = []
    for k in range(20):
        base = words(rng, 300, 5000)
        near = changed(rng, base, 2 + k % 5)
        a, b = brute_set(base), brute_set(near)
        assert 0.8 <= len(a & b) / len(a | b) <= 0.97
        rows += [(2 * k, base, "en", "s", 0), (2 * k + 1, near, "en", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path))
    assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.collect()) == list(range(0, 40, 2))


def test_empty_and_clashing_tables(empty, clashing):
    assert simhash.one_of_each(empty).count() == 0
    out = simhash.one_of_each(clashing)
    assert out.columns == clashing.columns and extras_unchanged(out.collect())


def test_similar_sets_are_within_the_radius():
    """Pairs at the edge of 0.8 differ in far fewer bits than the radius, unrelated ones in more."""
    rng = random.Random(13)
    for n in (9, 24, 100, 400):
        far = 0
        for _ in range(60):
            base = words(rng, n, 50_000)
            own = base.split()
            near = " ".join([*own[: len(own) - n // 10], *words(rng, n // 10, 50_000).split()])
            a, b, c = shingles.shingled([base, near, words(rng, n, 50_000)])
            f, g, h = (shingles.fingerprint(x) for x in (a, b, c))
            bits = lambda x, y: sum(((p ^ q) & (1 << 64) - 1).bit_count() for p, q in zip(x, y, strict=True))
            assert not shingles.similar(a, b) or bits(f, g) <= 45
            far += bits(f, h) > shingles.RADIUS
        assert far > 48


def test_sets_against_brute_force():
    rng = random.Random(15)
    texts = [rng.choice(["", " ", "\t"]).join(words(rng, rng.randrange(0, 14), 6)) if k % 9 == 0 else words(rng, rng.randrange(0, 14), 4) for k in range(120)] + ["", " \n", "é ß É", "longer-than-eight-bytes " * 7, "A b C d E", "a B c D e"]
    sets, want = shingles.shingled(texts), [brute_set(t) for t in texts]
    assert [len(s) for s in sets] == [len(w) for w in want]
    for a, x in zip(sets, want, strict=True):
        for b, y in zip(sets, want, strict=True):
            assert len(np.intersect1d(a, b)) == len(x & y)


def test_a_very_long_text_and_its_near_copy(spark):
    rng = random.Random(14)
    long = words(rng, 60_000, 40_000)
    rows = [(1, long), (2, changed(rng, long, 900)), (3, words(rng, 60_000, 40_000))]
    assert sorted(r["doc_id"] for r in simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == [1, 3]


def test_repeated_rows_and_null_ids(spark):
    text = words(random.Random(9), 50, 3000)
    rows = [(5, text), (3, text), (3, text), (8, "something else altogether now"), (None, None), (None, "")]
    out = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or -1) for r in out) == [-1, 3, 8]
