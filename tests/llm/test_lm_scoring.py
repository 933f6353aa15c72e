"""Trie levels against sorted arrays, and scores against counters of whole n-grams in plain Python."""

import random
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pyarrow as pa
import pytest
from llm_data import DOCS, odd_texts, prose, rows
from test_pairs import split

from skewkit.llm import lm_scoring
from skewkit.llm.ngram_trie import EliasFano, Trie, quantise

D = lm_scoring.DISCOUNT


@pytest.mark.parametrize("top", [1, 5, 300, 1 << 20, 1 << 40, (1 << 64) - 1])
def test_elias_fano_reads_and_finds(top):
    rng = np.random.default_rng(top % 1000)
    for n in (0, 1, 2, 64, 65, 1000):
        values = np.sort(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
        ef = EliasFano(b"\0" * 8 + EliasFano.encode(values), 8)
        assert ef.n == n
        assert np.array_equal(ef.get(np.arange(n)), values) and np.array_equal(ef.values(), values)
        wanted = np.concatenate([values, values + np.uint64(1), rng.integers(0, top, 200, dtype=np.uint64, endpoint=True),
                                 np.array([0, top], np.uint64)])
        assert np.array_equal(ef.successor(wanted), np.searchsorted(values, wanted, "left"))


def test_quantised_values():
    rng = np.random.default_rng(1)
    few = np.log10(rng.integers(1, 100, 5000) / 200)
    codes, book = quantise(few)
    assert np.allclose(book[codes], few)
    many = rng.normal(size=20_000)
    codes, book = quantise(many)
    assert np.abs(book[codes] - many).mean() < 0.02


def test_trie_of_random_ngrams(tmp_path):
    rng = np.random.default_rng(2)
    grams = np.unique(rng.integers(1, 40, (4000, 3)), axis=0)
    words, n = np.unique(grams[:, 0], return_counts=True)
    second, first_of = np.unique(grams[:, :2], axis=0, return_inverse=True)
    parent = np.searchsorted(words, second[:, 0])
    p2, p3 = -rng.integers(1, 50, len(second)) / 8.0, -rng.integers(1, 50, len(grams)) / 8.0
    b1, b2 = -rng.integers(1, 50, len(words)) / 8.0, -rng.integers(1, 50, len(second)) / 8.0
    data = Trie.encode(words.astype(np.uint64), n, [(parent, second[:, 1].astype(np.uint32)), (first_of.ravel(), grams[:, 2].astype(np.uint32))],
                       [p2, p3], [b1, b2])
    path = tmp_path / "trie"
    path.write_bytes(data)
    trie = Trie.open(str(path))
    asked = rng.integers(0, 45, (5000, 3))
    a = trie.word(asked[:, 0].astype(np.uint64))
    b = trie.lookup(1, a, asked[:, 1])
    c = trie.lookup(2, b, asked[:, 2])
    at2 = {tuple(x): i for i, x in enumerate(second.tolist())}
    at3 = {tuple(x): i for i, x in enumerate(grams.tolist())}
    for i, g in enumerate(asked.tolist()):
        assert b[i] == at2.get(tuple(g[:2]), -1) and c[i] == at3.get(tuple(g), -1)
    counts = dict(zip(words.tolist(), n.tolist(), strict=True))
    assert trie.count(a).tolist() == [counts.get(g[0], 0) for g in asked.tolist()]
    hit = c >= 0
    assert np.allclose(trie.probability(2, c)[hit], p3[c[hit]]) and np.isnan(trie.probability(2, c)[~hit]).all()
    assert np.allclose(trie.backoff(1, b), np.where(b >= 0, b2[b], 0.0))


def fold(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def brute(docs):
    """Each text's figures from counters of tuples of words."""
    sequences = [["<begin>", *split(t), "<end>"] for _, t in docs]
    c1, c2, c3, next1, next2 = Counter(), Counter(), Counter(), defaultdict(set), defaultdict(set)
    for (i, _), s in zip(docs, sequences, strict=True):
        if fold(i):
            continue
        c1.update(s)
        for a, b in zip(s, s[1:], strict=False):
            c2[a, b] += 1
            next1[a].add(b)
        for a, b, c in zip(s, s[1:], s[2:], strict=False):
            c3[a, b, c] += 1
            next2[a, b].add(c)
    tokens = sum(n for w, n in c1.items() if w != "<begin>")
    whole = tokens + 0.1 * (len([w for w in c1 if w != "<begin>"]) + 1)

    def one(w):
        return log10((c1[w] + 0.1) / whole)

    def two(v, w):
        if c2[v, w]:
            return log10((c2[v, w] - D) / c1[v])
        return one(w) + (log10(D * len(next1[v]) / c1[v]) if next1[v] else 0.0)

    def three(u, v, w):
        if c3[u, v, w]:
            return log10((c3[u, v, w] - D) / c2[u, v])
        return two(v, w) + (log10(D * len(next2[u, v]) / c2[u, v]) if next2[u, v] else 0.0)

    out = []
    for (i, _), s in zip(docs, sequences, strict=True):
        score = two(s[0], s[1]) + sum(three(*g) for g in zip(s, s[1:], s[2:], strict=False))
        out.append((fold(i), len(s) - 1, sum(c1[w] > 0 for w in s[1:]), tokens, sum(map(one, s[1:])), score))
    return out


def check(spark, docs, frame, **options):
    got = lm_scoring.score_texts(frame, **options).collect()
    expected = brute(docs)
    assert len(got) == len(docs)
    key = {}
    for (i, _), e in zip(docs, expected, strict=True):
        key.setdefault(i, []).append(e)
    for r in got:
        near = [e for e in key[r["doc_id"]] if tuple(r)[1:5] == e[:4] and abs(r["base_score"] - e[4]) < 1e-6
                and abs(r["score"] - e[5]) < 1e-3 * max(1, r["n_tokens"])]
        assert near, (tuple(r), key[r["doc_id"]])


def corpus(n=160):
    rng = random.Random(11)
    words = [prose(rng, words=1).lower() for _ in range(150)]
    texts = [" ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(150)], k=rng.randint(0, 90))) for _ in range(n)]
    return texts + odd_texts()[:6] + odd_texts()[7:] + [texts[3].upper()] * 5


def test_equals_counters(spark):
    docs = list(enumerate(corpus()))
    frame = spark.createDataFrame([(*r, 1, 2.0) for r in rows([t for _, t in docs])], DOCS + ", shard int, score double")
    check(spark, docs, frame.repartition(7))


def test_hot_words_pairs_and_triples_are_cut(spark):
    rng = random.Random(12)
    texts = corpus(60) + ["hot " * rng.randint(1, 60) for _ in range(60)] + ["hot pair " * rng.randint(1, 40) + rng.choice("abcdefgh") for _ in range(60)]
    docs = list(enumerate(texts)) + [(None, "hot hot hot"), (5, "hot pair x"), (5, "hot pair x")]
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCS).repartition(9)
    cut = lm_scoring.Ranges(lm_scoring._sample(frame.withColumn("held_out", frame["doc_id"] < 0).na.fill(False), 32, 10_000), 32)
    assert all(cut.hot)
    check(spark, docs, frame, shard_bytes=300)


def test_one_very_long_text_and_empty_tables(spark):
    long = odd_texts()[6]
    docs = [(1, long), (2, long[:5000]), (25, long[3000:9000])]
    check(spark, docs, spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCS))
    assert lm_scoring.score_texts(spark.createDataFrame([], DOCS)).collect() == []
    held = next(i for i in range(100) if fold(i))
    check(spark, [(held, "nothing to learn from")], spark.createDataFrame([(held, "nothing to learn from", "en", "s", 0)], DOCS))


def test_probabilities_of_a_context_sum_up_to_one_at_most(spark):
    docs = list(enumerate(corpus(40)))
    shard = lm_scoring.Texts(pa.record_batch({"text": pa.array([t for _, t in docs]), "held_out": pa.array([fold(i) for i, _ in docs])}))
    built = lm_scoring.Shard(shard.u, shard.v, shard.w, shard.is_held(), {}, D)
    for v in list(built.words[:50]):
        at = built.trie.word(np.array([v], np.uint64))
        ids = np.unique(shard.v[shard.u == v])
        p = 10.0 ** built.trie.probability(1, built.trie.lookup(1, np.repeat(at, len(ids)), ids))
        left = 10.0 ** built.trie.backoff(0, at)[0] if at[0] >= 0 and (ids != 0).any() else 0.0
        assert np.nansum(p) + (left if np.isfinite(p).any() else 0.0) <= 1.0 + 1e-6
