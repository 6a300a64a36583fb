"""Bit-sliced comparison: distances of many fingerprints at once.

Sorted by group, fingerprints lie as vertical bit planes, member i at bit i % 64 of word i // 64. Comparing every member
with the one ``step`` places on is one pass over the planes: carry-save counters hold 64 distances in each word and run
over once a distance exceeds the radius; words in which all have done so are abandoned. Memory is that of the planes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: After so many planes, words without a distance within the radius are dropped.
EVERY = 8


def planes(values: np.ndarray) -> np.ndarray:
    """A row of bits for each bit of (members, words of 64 bits) fingerprints, with two words of zeros at the end."""
    values = values.reshape(len(values), -1)
    words = -(-len(values) // 64) + 2
    out = np.zeros((64 * values.shape[1], words), np.uint64)
    for b in range(len(out)):
        packed = np.packbits((values[:, b // 64] >> np.uint64(b % 64) & np.uint64(1)).astype(np.uint8), bitorder="little")
        out[b].view(np.uint8)[: len(packed)] = packed
    return out


def _ahead(plane: np.ndarray, words: np.ndarray, step: int) -> np.ndarray:
    """The bits ``step`` places on, in some words."""
    skip, r = divmod(step, 64)
    low = plane[words + skip]
    return low >> np.uint64(r) | plane[words + skip + 1] << np.uint64(64 - r) if r else low


def within_radius(bits: np.ndarray, step: int, valid: np.ndarray, radius: int) -> np.ndarray:
    """Members whose distance to the one ``step`` places on is at most ``radius``, where ``valid`` has their bit."""
    live = np.flatnonzero(valid)
    # counters start so that they run over at radius + 1
    start = (1 << radius.bit_length()) - 1 - radius
    counters = [np.full(len(live), np.uint64(0xFFFFFFFFFFFFFFFF) if start >> k & 1 else np.uint64(0)) for k in range(radius.bit_length())]
    over = np.zeros(len(live), np.uint64)
    for b in range(len(bits)):
        carry = bits[b, live] ^ _ahead(bits[b], live, step)
        for k, c in enumerate(counters):
            counters[k], carry = c ^ carry, c & carry
        over |= carry
        if b % EVERY == EVERY - 1:
            keep = (valid[live] & ~over) != 0
            if not keep.all():
                live, over, counters = live[keep], over[keep], [c[keep] for c in counters]
            if not len(live):
                break
    near = np.zeros(len(valid), np.uint64)
    near[live] = valid[live] & ~over
    return np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little"))


def near_pairs(group: np.ndarray, values: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of members of one group within the radius, step by step. ``group`` is sorted."""
    n = len(group)
    sizes = np.diff(np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), n)) if n else np.zeros(0, int)
    size_of, at = np.repeat(sizes, sizes), np.arange(n)
    bits = planes(values)
    for step in range(1, int(sizes.max(initial=1))):
        # members of groups that are done with leave the planes
        if (enough := size_of[at] > step).sum() < 0.7 * len(at):
            at = at[enough]
            bits = planes(values[at])
        own = group[at]
        valid = np.zeros(bits.shape[1] - 2, np.uint64)
        same = np.packbits(own[:-step] == own[step:], bitorder="little")
        valid.view(np.uint8)[: len(same)] = same
        near = within_radius(bits, step, valid[: max(0, bits.shape[1] - 1 - step // 64)], radius)
        if len(near):
            yield at[near], at[near + step]


def components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest reachable index for each of n nodes."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while not np.array_equal(up := label[label], label):
            label = up
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def forest(group: np.ndarray, values: np.ndarray, radius: int) -> np.ndarray:
    """Index of a linked member of the same group for each member, or its own. ``group`` is sorted."""
    n = len(values)
    label, held = np.arange(n), 0
    pending: list[tuple[np.ndarray, np.ndarray]] = []

    def joined() -> np.ndarray:
        a, b = zip(*pending, (np.arange(n), label), strict=True)
        return components(n, np.concatenate(a), np.concatenate(b))

    for pair in near_pairs(group, values, radius):
        pending.append(pair)
        held += len(pair[0])
        if held > 4 * n:
            label, held, pending = joined(), 0, []
    return joined() if pending else label
