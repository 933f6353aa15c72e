"""Pairs of windows at exactly the threshold: how many the fingerprints lose, with and without repeated shingles."""

import random
import resource

import numpy as np
import pytest

from skewkit.llm import decontaminate as dc


def pair(rng, size, repeats):
    """Two windows of ``size`` shingles at similarity 0.8 whose differing part is one shingle ``repeats`` times."""
    differ = max(repeats, 1)
    common = 8 * differ                                     # c / (2 * (c + d) - c) = 0.8
    shared = rng.integers(0, 1 << 63, common, dtype=np.uint64)
    ends = [np.full(differ, rng.integers(0, 1 << 63), np.uint64) if repeats else rng.integers(0, 1 << 63, size, dtype=np.uint64) for _ in "ab"]
    if not repeats:
        shared = rng.integers(0, 1 << 63, 8 * size, dtype=np.uint64)
    return [np.concatenate([shared, e]) for e in ends]


@pytest.mark.parametrize("repeats", [4, 12, 28, 60])
def test_repeated_shingles_lose_nothing(repeats):
    rng = np.random.default_rng(repeats)
    lost = 0
    for _ in range(150):
        a, b = pair(rng, 0, repeats)
        assert abs(dc.ItemIndex._similarity(a, np.unique(b, return_counts=True)) - 0.8) < 1e-12
        prints = dc.simhash(np.stack([a, b]))
        lost += int(np.bitwise_count(prints[0] ^ prints[1])) > dc.RADIUS
    assert lost == 0


@pytest.mark.parametrize("differ", [1, 2, 4, 10])
def test_the_share_that_is_lost_at_the_threshold(differ):
    rng = np.random.default_rng(differ)
    a, b = zip(*[pair(rng, differ, 0) for _ in range(20_000)], strict=True)
    bits = np.bitwise_count(dc.simhash(np.stack(a)) ^ dc.simhash(np.stack(b)))
    assert (bits > dc.RADIUS).mean() < 0.001


def test_the_order_and_the_number_of_occurrences():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 5, (50, 12), dtype=np.uint64)
    mixed = rng.permuted(rows, axis=1)
    assert np.array_equal(dc.simhash(rows), dc.simhash(mixed))
    once, thrice = np.array([[1, 2, 3, 4, 5]], np.uint64), np.array([[1, 1, 1, 4, 5]], np.uint64)
    assert dc.simhash(once) != dc.simhash(thrice)


def test_an_index_takes_a_bounded_multiple_of_its_text():
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(80)) for _ in range(4000)]
    size = sum(map(len, texts))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    index = dc.ItemIndex(texts)
    grown = (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) * 1024
    assert len(index.weights) == 4000 and grown < 40 * size + (64 << 20)
