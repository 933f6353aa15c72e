"""Near-duplicate join, connected components and decontamination against brute force."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_data import DOCS, extra_columns, odd_texts, prose, rows

from skewkit.llm import common, decontaminate, jaccard_join
from skewkit.llm.components import connected_components


def split(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    out, word = [], ""
    for ch in lower + " ":
        if ch in "\t\n\x0b\x0c\r ":
            if word:
                out.append(word)
            word = ""
        else:
            word += ch
    return out


def shingles(text, k=5):
    w = split(text)
    return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else ([tuple(w)] if w else [])


def brute_classes(texts, threshold=0.8):
    sets = [set(shingles(t)) for t in texts]
    label = list(range(len(texts)))
    links = [0] * len(texts)

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= threshold * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(texts))], links


def changed(rng, text, n):
    w = text.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = "changed" + str(rng.randrange(1000))
    return " ".join(w)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    texts = [prose(rng, words=rng.randint(3, 120)) for _ in range(60)]
    base = prose(rng, words=120)
    texts += [changed(rng, base, rng.randint(0, 4)) for _ in range(60)]     # near and exact copies around the threshold
    texts += [texts[5]] * 12 + [texts[70]] * 9
    return texts + odd_texts()


def test_join_equals_brute_force(spark, corpus):
    found = {r["doc_id"]: r for r in jaccard_join.join_near_duplicates(spark.createDataFrame(rows(corpus), DOCS)).collect()}
    classes, links = brute_classes(corpus)
    assert len(found) == len(corpus)
    assert [found[i]["class_id"] for i in range(len(corpus))] == classes
    assert [found[i]["n_links"] for i in range(len(corpus))] == links


def test_blocks_of_a_large_group_lose_no_link(spark, corpus, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", 7)
    found = {r["doc_id"]: r for r in jaccard_join.join_near_duplicates(spark.createDataFrame(rows(corpus), DOCS)).collect()}
    classes, links = brute_classes(corpus)
    assert [found[i]["class_id"] for i in range(len(corpus))] == classes
    assert [found[i]["n_links"] for i in range(len(corpus))] == links


def test_dense_and_single_verification_agree():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 40, 30).astype(np.uint64)) for _ in range(30)]
    left, right = np.triu_indices(30, 1)
    assert (jaccard_join._common_dense(sets, left, right) == jaccard_join._common_each(sets, left, right)).all()


def test_pruning_keeps_the_likely(spark):
    for n, least in jaccard_join.least_matches().items():
        assert least < n * 0.8        # what a pair at the threshold shows on average is never dropped


def test_one_of_each_keeps_columns_and_one_row_a_class(spark):
    texts = ["one two three four five six"] * 3 + ["other words are here in this text"] + odd_texts()
    docs = extra_columns(spark, texts)
    kept = jaccard_join.one_of_each(docs.unionAll(docs.limit(1)))
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect())
    assert ids == [i for i in range(len(texts)) if i not in (1, 2, len(texts) - 1)]


def test_join_of_nothing_and_null_ids(spark):
    assert jaccard_join.join_near_duplicates(spark.createDataFrame([], DOCS)).collect() == []
    text = "one two three four five six"
    docs = spark.createDataFrame([(None, text, None, None, None), (4, text, None, None, None), (None, None, None, None, None)], DOCS)
    got = sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard_join.join_near_duplicates(docs).collect()), key=str)
    assert got == [(4, 4, 1), (None, 4, 1), (None, None, 0)]


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)]
    edges += [(2000, i) for i in range(2001, 2200)]
    label = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    lone = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert found == {k: v for k, v in label.items() if k not in lone}


def test_word_and_shingle_hashes_are_those_of_their_text():
    texts = ["The the A  bc\n d", " a B c d e f", "", "x", "b c d e f g", " ", "the\tend"] * 3
    data, offsets = common.utf8(pa.array(texts))
    words, first = common.word_hashes(data, offsets)
    plain = [w for t in texts for w in split(t)]
    assert len({(a, int(b)) for a, b in zip(plain, words, strict=True)}) == len(set(plain)) == len(set(words.tolist()))
    hashes, begin = common.shingle_hashes(words, first, 5)
    plain = [s for t in texts for s in shingles(t)]
    assert len({(a, int(b)) for a, b in zip(plain, hashes, strict=True)}) == len(set(plain)) == len(set(hashes.tolist()))
    alone, _ = common.word_hashes(*common.utf8(pa.array(["zzz yy the"])))
    assert alone[2] == words[0]                                  # whatever else is in the slice


def brute_leaks(texts, items, threshold=0.8):
    out = {}
    for d, text in enumerate(texts):
        words = split(text)
        for i, item in enumerate(items):
            size = len(split(item))
            wanted = Counter(shingles(item))
            own = shingles(text) if size >= 5 else [tuple(words[a:a + size]) for a in range(len(words) - size + 1)]
            n, best = sum(wanted.values()), 0.0
            if not wanted.keys() & set(own):
                continue
            for a in range(max(1, len(own) - n + 1)):
                window = Counter(own[a:a + n])
                both = sum((window & wanted).values())
                best = max(best, both / max(1, sum(window.values()) + n - both))
            if n and best >= threshold - 1e-12:
                out[d, i] = best
    return out


def test_leaks_equal_brute_force(spark, monkeypatch):
    rng = random.Random(11)
    items = [prose(rng, words=rng.randint(5, 50)) for _ in range(25)] + ["tiny item", None, "", "  "]
    texts = [prose(rng, words=80) for _ in range(20)] + odd_texts()
    for item in items[:26]:
        w = item.split(" ")
        for edits in (0, 1, 2):
            v = list(w)
            for _ in range(edits):
                v[rng.choice([0, len(v) - 1, rng.randrange(len(v))])] = "zzz"
            texts.append(prose(rng, words=20) + " " + " ".join(v).upper() + " " + prose(rng, words=rng.randint(1, 20)))
        texts.append(" ".join(w[1:]))
    docs = spark.createDataFrame(rows(texts), DOCS)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    wanted = brute_leaks(texts, [i or "" for i in items])
    found = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.find_leaks(docs, bench).collect()}
    assert found == pytest.approx(wanted) and len(found) > 40
    clean = decontaminate.clean_documents(docs, bench)
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(set(range(len(texts))) - {d for d, _ in wanted})
    # a larger benchmark is compared chunk by chunk
    monkeypatch.setattr(decontaminate.item_chunks, "__defaults__", (300,))
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, bench).collect()} == set(wanted)


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(2)
    items = rng.integers(0, 1 << 63, 50).astype(np.uint64)
    flips = [np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, n, replace=False).astype(np.uint64)) for n in
             rng.integers(1, 30, 400)]
    windows = items[rng.integers(0, 50, 400)] ^ np.array(flips)
    got = set(zip(*(x.tolist() for x in decontaminate._SizeClass(list(range(50)), items, 20).within(windows)), strict=True))
    assert got == {(w, i) for w in range(400) for i in range(50) if int(windows[w] ^ items[i]).bit_count() <= 20}


def test_leaks_of_empty_tables(spark):
    docs, none = spark.createDataFrame(rows(["a b c d e f"]), DOCS), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_leaks(docs, none).collect() == []
    assert decontaminate.clean_documents(docs, none).count() == 1
    assert decontaminate.find_leaks(spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b")], "item_id long, text string")) \
        .collect() == []
    kept = decontaminate.clean_documents(extra_columns(spark, odd_texts()), spark.createDataFrame([(1, "Word")], "item_id long, text string"))
    assert kept.count() == len(odd_texts()) - 1 and kept.columns[-1] == "_c0"
