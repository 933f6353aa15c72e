"""The range coder: work per id, and round trips over all stretches between set-ups."""

import numpy as np
import pytest

from skewkit.llm import rangecoder


def test_set_ups_of_a_block_are_few(monkeypatch):
    calls = []
    plain = rangecoder._OrderZero.set_up
    monkeypatch.setattr(rangecoder._OrderZero, "set_up", lambda self: (calls.append(1), plain(self)))
    block = np.random.default_rng(1).zipf(1.3, rangecoder.LONGEST) % 40_000
    coded = rangecoder.encode_blocks([block])
    assert len(calls) <= 28
    assert (rangecoder.decode_blocks(coded)[0] == block).all()


def test_stretches_cover_a_block():
    for steps in (1, 15, 16, 17, 100, 4095, rangecoder.LONGEST):
        parts = rangecoder._segments(steps)
        assert parts[0][0] == 0 and parts[-1][1] == steps
        assert all(a < b for a, b in parts) and all(x[1] == y[0] for x, y in zip(parts, parts[1:], strict=False))


@pytest.mark.parametrize("seed", range(4))
def test_many_lengths_round_trip(seed):
    rng = np.random.default_rng(seed)
    blocks = [rng.zipf(1 + rng.random(), n).clip(0, 10 ** 9) % high for n, high in
              zip(rng.integers(0, rangecoder.LONGEST + 1, 60), rng.choice([1, 2, 9, 500, 49_408, 1 << 20], 60), strict=True)]
    coded = rangecoder.encode_blocks(blocks)
    assert all((a == b).all() for a, b in zip(blocks, rangecoder.decode_blocks(coded), strict=True))
    some = int(rng.integers(60))
    assert coded[some] == rangecoder.encode_blocks([blocks[some]])[0]


def test_contexts_are_used():
    rng = np.random.default_rng(9)
    pairs = rng.integers(0, 40_000, (60, 2))
    by_one = rng.permutation(40_000)            # the id before tells the next one
    chain = [5]
    while len(chain) < rangecoder.LONGEST:
        chain.append(int(by_one[chain[-1]]) % 50 if rng.random() > 0.01 else int(rng.integers(50)))
    mixed = np.concatenate([pairs[i] for i in rng.integers(0, 60, rangecoder.LONGEST // 2)])
    noise = rng.integers(0, 50, rangecoder.LONGEST)
    sizes = [len(c) for c in rangecoder.encode_blocks([np.array(chain), mixed, noise])]
    assert sizes[0] < sizes[2] / 3 and sizes[1] < sizes[2]


def test_a_blocks_ids_are_listed_once():
    # new ids cost their place in a list, not 20 bits and an escape each; half the set-ups do
    ids = np.random.default_rng(3).permutation(49_408)[:rangecoder.LONGEST]
    assert len(rangecoder.encode_blocks([ids])[0]) < 19 * len(ids) // 8
    assert len(rangecoder._segments(rangecoder.LONGEST)) <= 16
    for listed in ([0], [(1 << 20) - 1], [0, 1, 2], sorted({*map(int, ids)}), [5, 1 << 19, (1 << 19) + 1]):
        assert rangecoder._unpack_list(rangecoder._pack_list(np.array(listed)), len(listed)).tolist() == listed
