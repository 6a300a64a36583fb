import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from folioquest.llm import packing


def test_plan_uses_every_piece_and_overfills_nothing():
    rng = random.Random(1)
    for _ in range(200):
        capacity = rng.choice([5, 16, 40])
        counts = {rng.randint(1, capacity): rng.randint(1, 40) for _ in range(rng.randrange(10))}
        used = Counter()
        for items, times in packing.plan(counts, capacity):
            assert times > 0 and sum(x * k for x, k in items) <= capacity
            for x, k in items:
                used[x] += k * times
        assert used == Counter(counts)


def test_exact_complements_are_found():
    assert sum(n for _, n in packing.plan({1500: 4, 548: 4})) == 4
    assert sum(n for _, n in packing.plan({1000: 3, 600: 3, 448: 3})) == 3
    assert sum(n for _, n in packing.plan({1000: 2, 500: 2, 300: 2, 248: 2})) == 2
    assert packing.plan({}) == []


def test_plan_is_near_the_bound():
    rng = random.Random(2)
    counts = Counter(min(2048, int(rng.lognormvariate(6, 1)) + 1) for _ in range(50_000))
    bound = -(-sum(x * n for x, n in counts.items()) // 2048)
    assert sum(n for _, n in packing.plan(counts)) <= 1.001 * bound + 1


def check(pieces):
    placed = defaultdict(list)
    for p in pieces:
        placed[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return len(placed)


def test_pieces_and_places(spark, folder, rows):
    got = packing.op4_best_fit_packing(spark, folder).collect()
    want = []
    for doc_id, text, *_ in rows:
        ids = [*packing.tokenizer("byte_bpe_50k.json").encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        at = 0
        for k, end in enumerate(range(first, len(ids) + 1, 2048)):
            want.append((doc_id, k, at, end - at, zlib.crc32(np.array(ids[at:end], "<u4").tobytes())))
            at = end
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    n = check(got)
    assert n <= -(-sum(r["length"] for r in got) // 2048) + 1


def test_special_strings_as_the_tokenizer_reads_them():
    text = "<|endoftext|>x a<|endoftext|> b"
    assert packing.token_ids(text) == packing.tokenizer("byte_bpe_50k.json").encode(text, add_special_tokens=False).ids


def test_empty_and_clashing(empty, clashing):
    assert packing.pack(empty).count() == 0
    assert check(packing.pack(clashing).collect()) >= 1
