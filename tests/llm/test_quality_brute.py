"""The classifier against naive Bayes ratios from counters, and its fit against a plain minimiser of the same loss."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from skewkit.llm import quality


def plain_ratios(sets, labels):
    n = Counter(labels)
    seen = {1: Counter(), 0: Counter()}
    for s, y in zip(sets, labels, strict=True):
        seen[y].update(s)
    return {f: math.log((seen[1][f] + 1) / (n[1] + 2)) - math.log((seen[0][f] + 1) / (n[0] + 2)) for f in set(seen[1]) | set(seen[0])}


def plain_rows(sets, ratios):
    """Scaled indicators of length 1, as dictionaries."""
    out = []
    for s in sets:
        norm = math.sqrt(sum(ratios[f] ** 2 for f in s))
        out.append({f: ratios[f] / norm for f in s} if norm else {})
    return out


def loss(w, bias, rows, labels):
    share = sum(labels) / len(labels)
    total = 0.5 * (sum(x * x for x in w.values()) + bias * bias)
    for r, y in zip(rows, labels, strict=True):
        c = 0.5 * quality.COST / (share if y else 1 - share)
        total += c * max(0.0, 1 - (1 if y else -1) * (sum(v * w.get(f, 0.0) for f, v in r.items()) + bias))
    return total


def least_loss(rows, labels, features):
    """The dual by projected gradient steps on a dense matrix, far beyond what the classifier does."""
    at = {f: i for i, f in enumerate(sorted(features))}
    x = np.zeros((len(rows), len(at) + 1))
    for i, r in enumerate(rows):
        for f, v in r.items():
            x[i, at[f]] = v
    x[:, -1] = 1.0
    y = np.where(np.array(labels) == 1, 1.0, -1.0)
    share = sum(labels) / len(labels)
    top = np.where(y > 0, 0.5 * quality.COST / share, 0.5 * quality.COST / (1 - share))
    q = (x * y[:, None]) @ (x * y[:, None]).T
    alpha, step = np.zeros(len(rows)), 1.0 / np.linalg.eigvalsh(q)[-1]
    for _ in range(20_000):
        alpha = np.clip(alpha - step * (q @ alpha - 1.0), 0.0, top)
    return float(alpha.sum() - 0.5 * alpha @ q @ alpha)          # of the dual: equal to the primal's least


@pytest.mark.parametrize("seed", range(4))
def test_the_fit_is_near_the_least_loss(seed):
    rng = random.Random(seed)
    labels = [int(rng.random() < 0.7) for _ in range(60)]
    sets = [sorted({rng.randrange(40 if y else 60) for _ in range(rng.randint(1, 15))}) for y in labels]
    model = quality.fit([np.array(s, np.int32) for s in sets], np.array(labels))
    ratios = plain_ratios(sets, labels)
    assert all(abs(model.ratio[f] - r) < 1e-12 for f, r in ratios.items())
    rows = plain_rows(sets, ratios)
    w = {f: model.weights[f] for f in ratios}
    mine, least = loss(w, model.weights[-1], rows, labels), least_loss(rows, labels, ratios)
    assert least - 1e-6 <= mine <= 1.02 * least
    for s, r in zip(sets, rows, strict=True):
        assert abs(model.margin(np.array(s, np.int32)) - (sum(v * w[f] for f, v in r.items()) + model.weights[-1])) < 1e-9


def plain_features(text):
    """Byte 1- to 3-grams with digits as one, and equality patterns of 2 to 4 neighbouring words."""
    data = bytes(48 if 48 <= b < 58 else b for b in text.encode())
    grams = {data[i:i + n] for n in (1, 2, 3) for i in range(len(data) - n + 1)}
    words = text.lower().split(" ")
    words = [w for w in words if w]
    patterns = {(n, tuple(words[i + a] == words[i + b] for a in range(n) for b in range(a))) for n in (2, 3, 4) for i in range(len(words) - n + 1)}
    return len(grams) + len(patterns)


def test_features_are_the_grams_and_patterns():
    from skewkit.llm.common import utf8
    import pyarrow as pa
    texts = ["", "a", "ab 12", "the the the cat", "x y x y z", "Some words 2024, and some more words."]
    for text, idx in zip(texts, quality.row_features(*utf8(pa.array(texts))), strict=True):
        assert len(set(idx.tolist())) == len(idx)
        assert plain_features(text) - 2 <= len(idx) <= plain_features(text)      # hashed: a collision or two at most
