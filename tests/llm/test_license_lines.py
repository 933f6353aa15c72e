"""SPDX lines, titles, short forms and negations; alignment against a quadratic longest common subsequence."""

import random

import pytest

from skewkit.llm.licenses import Scanner, _longest_increasing, _unique_places, align

SCANNER = Scanner()


def names(text):
    return [f[0] for f in SCANNER.scan(text)]


@pytest.mark.parametrize("text,found", [
    ("// SPDX-License-Identifier: MIT\nint main;", ["MIT"]), ("# SPDX-License-Identifier: Apache-2.0", ["Apache-2.0"]),
    ("/* SPDX-License-Identifier: GPL-2.0-or-later */", ["GPL-2.0-or-later"]), ("SPDX-License-Identifier: GPL-2.0 x", ["GPL-2.0"]),
    ("SPDX-License-Identifier: MIT-0", ["MIT-0"]), ("SPDX-License-Identifier: MIT-Modern-Variant", []),
    ("SPDX-License-Identifier: Own-1.0", []), ("SPDX-License-Identifier:", []),
    ("MIT License\n\nCopyright (c) 2020 Someone\n\nand more words", ["MIT"]), ("We like the MIT License. Copyright law is old.", []),
    ("It is licensed under GPLv3 and later.", ["GPL-3.0"]), ("Licensed under the LGPL v2.1.", ["LGPL-2.1"]), ("It was GPLv3 once.", []),
    ("Not released under the MIT License.", []), ("It is no longer released under the MIT License.", []),
    ("This isn't licensed under GPLv3.", []), ("It is never released under the MIT License", []),
    ("It was not easy. Released under the MIT License.", ["MIT"]), ("Whether or not you like it, released under the MIT License.", ["MIT"]),
    ("Released under the MIT License.", ["MIT"])])
def test_lines(text, found):
    assert names(text) == found


def quadratic(left, right):
    """Length of a longest common subsequence."""
    row = [0] * (len(right) + 1)
    for x in left:
        before = 0
        for j, y in enumerate(right, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def patience(left, right):
    """Patience alignment by its definition: a recursion over slices, its anchors by a quadratic search."""
    out = []
    a = 0
    while a < min(len(left), len(right)) and left[a] == right[a]:
        out.append((a, a))
        a += 1
    m, n = len(left), len(right)
    tail = []
    while m > a and n > a and left[m - 1] == right[n - 1]:
        m, n = m - 1, n - 1
        tail.append((m, n))
    mine, theirs = left[a:m], right[a:n]
    pairs = [(i, theirs.index(w)) for i, w in enumerate(mine) if mine.count(w) == 1 and theirs.count(w) == 1]
    best = []
    for k, (_, j) in enumerate(pairs):
        longest = max((best[q] for q in range(k) if pairs[q][1] < j), key=len, default=[])
        best.append([*longest, pairs[k]])
    anchors = max(best, key=len, default=[])
    if anchors:
        bounds = [(-1, -1), *anchors, (len(mine), len(theirs))]
        out += [(a + i, a + j) for i, j in anchors]
        for (i, j), (k, q) in zip(bounds, bounds[1:], strict=False):
            out += [(a + i + 1 + x, a + j + 1 + y) for x, y in patience(mine[i + 1:k], theirs[j + 1:q])]
    return sorted(out + tail)


def test_alignment_against_its_definition():
    rng = random.Random(3)
    for _ in range(400):
        left = rng.choices("abcdefghijklmnop", k=rng.randint(0, 25))
        right = [w for w in left if rng.random() < 0.8] if rng.random() < 0.6 else rng.choices("abcdefghijklmnop", k=rng.randint(0, 25))
        for _ in range(rng.randint(0, 3)):
            right.insert(rng.randint(0, len(right)), rng.choice("abcxyz"))
        pairs = align(left, right)
        assert all(left[i] == right[j] for i, j in pairs)
        assert all(x < y and u < v for (x, u), (y, v) in zip(pairs, pairs[1:], strict=False))
        assert len(pairs) <= quadratic(left, right)
        if len(set(left)) == len(left) and len(set(right)) == len(right):
            assert len(pairs) == quadratic(left, right)          # all words unique: the anchors are a longest subsequence
        assert len(pairs) == len(patience(left, right)) or len(_unique_places(left, 0, len(left))) < len(left)


def test_longest_increasing_against_all_subsequences():
    rng = random.Random(4)
    for _ in range(200):
        pairs = [(i, j) for i, j in enumerate(rng.sample(range(30), rng.randint(0, 12)))]
        best = []
        for i, (_, y) in enumerate(pairs):
            best.append(1 + max((best[j] for j in range(i) if pairs[j][1] < y), default=0))
        got = _longest_increasing(pairs)
        assert len(got) == max(best, default=0) and all(a[1] < b[1] for a, b in zip(got, got[1:], strict=False))
