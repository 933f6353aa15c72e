"""Language id and quality classifier: exact code lengths, held-out accuracy, edge cases."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
from llm_data import DOCS, SYLLABLES, extra_columns, odd_texts, prose, rows

from skewkit.llm import langid, quality
from skewkit.llm.common import utf8


def corpus(n=240):
    rng = random.Random(7)
    return [(i, prose(rng, lang, rng.randint(20, 60)), lang, "s", 0) for i in range(n) for lang in [rng.choice(list(SYLLABLES))]]


def test_held_out_languages(spark):
    data = corpus()
    out = {r["doc_id"]: r for r in langid.identify(spark.createDataFrame(data, DOCS)).collect()}
    assert len(out) == len(data)
    for i, _, lang, *_ in data:
        assert out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert out[i]["lang_pred"] == lang and 0 <= out[i]["score"] <= 1


def plain_bits(texts, rank, text):
    """PPM code length of ``text`` under the counts of ``texts``, position by position."""
    counts = {}

    def codes(t):
        return [0] * langid.MAX_ORDER + [int(rank[langid._fold[b]]) for b in t.encode()]
    for t in texts:
        c = codes(t)
        for at in range(langid.MAX_ORDER, len(c)):
            for order in range(langid.MAX_ORDER + 1):
                seen = counts.setdefault(tuple(c[at - order:at]), {})
                seen[c[at]] = seen.get(c[at], 0) + 1
    bits, c = 0.0, codes(text)
    for at in range(langid.MAX_ORDER, len(c)):
        chance = 1.0
        for order in range(langid.MAX_ORDER, -1, -1):
            seen = counts.get(tuple(c[at - order:at]))
            if not seen:
                continue
            total, distinct = sum(seen.values()), len(seen)
            if c[at] in seen:
                chance *= seen[c[at]] / (total + distinct)
                break
            chance *= distinct / (total + distinct)
        else:
            chance /= 256
        bits -= math.log2(chance)
        if c[at] == 0:
            bits += 8
    return bits


def test_code_lengths_are_exact(spark):
    data = [r for r in corpus(60)]
    model = langid.train(spark.createDataFrame(data, DOCS), train_docs=10_000)
    learned = {lang: [t for i, t, g, *_ in data if g == lang and zlib.crc32(str(i).encode()) % 3 != 1] for lang in model.languages}
    texts = [data[0][1], "Zqx 77 été!\n~", "th"]
    got = model.bits(*utf8(pa.array(texts)))
    for row, text in zip(got, texts, strict=True):
        for value, lang in zip(row, model.languages, strict=True):
            assert math.isclose(value, plain_bits(learned[lang], model.rank, text), rel_tol=1e-4)


def test_languages_of_odd_texts(spark):
    texts = odd_texts()
    docs = spark.createDataFrame(corpus(90) + [(1000 + i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    out = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    for i in (0, 1, 2, 3):
        assert (out[1000 + i]["lang_pred"], out[1000 + i]["score"]) == ("und", 0.0)
    assert out[1006]["lang_pred"] == "en" and out[1007]["lang_pred"] == out[1008]["lang_pred"]
    kept = langid.accepted_documents(docs)
    assert kept.columns == docs.columns and {1000, 1001, 1002, 1003}.isdisjoint(r["doc_id"] for r in kept.collect())
    assert kept.filter("doc_id < 1000").count() == 90
    clash = extra_columns(spark, ["the thing ertion"] * 9)
    assert langid.accepted_documents(clash).columns == clash.columns


def test_letters_are_unicode_letters(spark):
    texts = ["½ ² Ⅷ _", "ä", "漢"]
    docs = spark.createDataFrame(corpus(30) + [(1000 + i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    out = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs).collect()}
    assert [out[1000 + i] == "und" for i in range(3)] == [True, False, False]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some words", None, None, None), (None, None, None, None, None)], DOCS)
    assert {(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify(docs).collect()} == {(1, "und", 0.0), (None, "und", 0.0)}
    assert langid.identify(spark.createDataFrame([], DOCS)).collect() == []


def junk(rng):
    words = prose(rng, words=40).split(" ")
    kind = rng.randrange(3)
    return " | ".join(words) if kind == 0 else " ".join(w.upper() + "!!" for w in words) if kind == 1 else " ".join(words[:3] * 30)


def labelled(n=400):
    rng = random.Random(9)
    good = [rng.random() < 0.7 for _ in range(n)]
    return [prose(rng, words=60) if g else junk(rng) for g in good], [int(g) for g in good]


def test_held_out_quality(spark):
    texts, marks = labelled()
    docs = spark.createDataFrame(rows(texts), DOCS)
    labels = spark.createDataFrame([(i, q, 0) for i, q in enumerate(marks)] + [(3, None, None), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in quality.score_quality(docs, labels).collect()}
    held = [i for i in out if out[i]["held_out"]]
    assert sorted(held) == [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([out[i]["predicted"] == marks[i] for i in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in out.values())
    kept = {r["doc_id"] for r in quality.accepted_documents(docs, labels).collect()}
    assert kept == {i for i in out if out[i]["predicted"]}


def test_labels_of_held_out_rows_change_nothing(spark):
    texts, marks = labelled(120)
    docs = spark.createDataFrame(rows(texts), DOCS)

    def scores(flip):
        data = [(i, 1 - q if flip and zlib.crc32(str(i).encode()) % 5 == 0 else q, 0) for i, q in enumerate(marks)]
        return sorted(tuple(r) for r in quality.score_quality(docs, spark.createDataFrame(data, "doc_id long, quality int, toxic int")).collect())
    assert scores(False) == scores(True)


def test_indicators_are_sets():
    data, offsets = utf8(pa.array(["abab abab abab", "", "a", "x y x y x"]))
    for idx in quality.row_features(data, offsets):
        assert len(set(idx.tolist())) == len(idx)


def test_dual_coordinate_descent_separates():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 200)
    found = [np.concatenate([rng.choice(1000, 20, replace=False), [2000 + c]]).astype(np.int32) for c in y]
    model = quality.fit(found, y)
    assert ((model.score(np.array([model.margin(f) for f in found])) > 0.5) == (y == 1)).all()


def test_quality_edges(spark):
    docs = extra_columns(spark, odd_texts())
    one_class = spark.createDataFrame([(i, 1, 0) for i in range(9)], "doc_id long, quality int, toxic int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r["score"] > 0.9 for r in quality.score_quality(docs, one_class).collect())
    assert {r["score"] for r in quality.score_quality(docs, none).collect()} == {0.5}
    assert quality.accepted_documents(docs, none).columns == docs.columns
    assert quality.score_quality(spark.createDataFrame([], DOCS), none).collect() == []
