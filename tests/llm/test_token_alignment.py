"""Token alignment against whole-text encodings and quadratic overlap, and its galloping search against numpy's."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_data import DOCS, odd_texts, prose, rows

from skewkit.llm import token_alignment as ta

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabularies():
    return ta.Vocabularies(A, B)


def spans(ids, names):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(names[i]), i))
        at += len(names[i])
    return out


def plain(v, text):
    """Tokens of both, as the libraries encode the whole text."""
    if not text:
        return [], []
    a = v.a.encode(" " + text, add_special_tokens=False).ids
    b = v.b.encode(text)
    whole = (" " + text).encode()
    if b"".join(v.bytes_a[i] for i in a) != whole or b"".join(v.bytes_b[i] for i in b) != whole:
        return [], []
    return spans(a, v.bytes_a), spans(b, v.bytes_b)


def brute(v, texts):
    tokens = [plain(v, t) for t in texts]
    links = [[(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]] if len(a) * len(b) < 10 ** 7 else None for a, b in tokens]
    held, best = defaultdict(int), defaultdict(int)
    for pairs in links:
        for p in set(pairs):
            held[p] += 1
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    out = []
    for (a, b), pairs in zip(tokens, links, strict=True):
        cuts = sorted({x[1] for x in a} & {x[1] for x in b})
        groups, low = [], 0
        for high in cuts:
            groups.append("|".join(",".join(str(i) for s, e, i in side if low <= s and e <= high) for side in (a, b)))
            low = high
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append((len(a), len(b), len(cuts), len(pairs), sum(held[p] == best[p[0]] for p in pairs),
                    sum(held[p] for p in pairs), digest))
    return out


def odd():
    return ["a", " a", "a ", "  ", "a  b", "a\n b", "a \n b\n", "\t", "▁x", "x ▁", "<s> a </s><|endoftext|> <unk> <0x41>",
            "1234567 12 3.14", "café naïve 你好 \U0001f600\U0001f600 é", "a b 　c", "a\x00b", "it's they'll WE'RE",
            "don 't", "x" * 300, "\r\n\r\n  code:\n    x = 1\n\n", "ﬁ İstanbul ǅ", "." * 70 + " " * 40 + "!"]


def test_pieces_encode_as_whole_texts(vocabularies):
    rng = random.Random(2)
    alphabet = list("ab1 .,'\n\té你") + ["  ", "the", " and", "▁", "<s>"]
    texts = odd() + ["".join(rng.choices(alphabet, k=rng.randint(1, 40))) for _ in range(1500)]
    ids_a, ids_b, first_a, first_b = vocabularies.encode(texts)
    for i, t in enumerate(texts):
        a, b = plain(vocabularies, t)
        assert ids_a[first_a[i]:first_a[i + 1]].tolist() == [x[2] for x in a], t
        assert ids_b[first_b[i]:first_b[i + 1]].tolist() == [x[2] for x in b], t


def test_a_small_cache_changes_nothing():
    rng = random.Random(3)
    small, large = ta.Vocabularies(A, B, limit=50), ta.Vocabularies(A, B)
    for _ in range(5):
        texts = [prose(rng) for _ in range(10)]
        for x, y in zip(small.encode(texts), large.encode(texts), strict=True):
            assert np.array_equal(x, y)


def test_galloping_finds_what_binary_search_finds():
    rng = np.random.default_rng(4)
    for _ in range(200):
        longer = np.unique(rng.integers(0, 3000, rng.integers(1, 2500)))
        driver = np.unique(rng.integers(0, 3000, rng.integers(1, 2500)))
        place, common = ta.intersect(driver, longer, np.array([0, len(driver)]), np.array([0, len(longer)]))
        assert np.array_equal(place, np.searchsorted(longer, driver))
        assert np.array_equal(common, np.isin(driver, longer))


def test_equals_brute_force(spark, vocabularies):
    rng = random.Random(7)
    texts = [prose(rng, lang, words=rng.randint(1, 60)) for lang in ("en", "de", "fr") for _ in range(12)]
    texts += odd() + [None, "", texts[0], texts[0], "word " * 500]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows(texts)], DOCS + ", slice long, n_a string").repartition(5)
    got = {r["doc_id"]: tuple(r)[1:] for r in ta.align_tokens(docs, A, B).collect()}
    for i, expected in enumerate(brute(vocabularies, texts)):
        assert got[i] == expected, texts[i]


def test_odd_and_very_long_texts(spark, vocabularies):
    texts = odd_texts()
    docs = spark.createDataFrame(rows(texts) + [(None, "a b", "en", "s", 3), (2, "a b", "en", "s", 3)], DOCS)
    got = ta.align_tokens(docs, A, B).collect()
    assert len(got) == len(texts) + 2
    long = next(r for r in got if r["doc_id"] == 6)
    a, b = plain(vocabularies, texts[6])
    assert (long["n_a"], long["n_b"]) == (len(a), len(b))
    assert long["n_groups"] == len({x[1] for x in a} & {x[1] for x in b})
    assert {(r["n_a"], r["n_links"], r["groups_sha256"]) for r in got if r["doc_id"] in (0, 1)} == {(0, 0, "")}
    assert sum(r["doc_id"] is None for r in got) == 1
    assert ta.align_tokens(spark.createDataFrame([], DOCS), A, B).collect() == []
