"""The models are learned from all labelled rows, however many there are."""

import random
import zlib

import numpy as np
import pyarrow as pa
from llm_data import DOCS, SYLLABLES, prose
from test_quality_brute import plain_ratios

from skewkit.llm import langid, quality
from skewkit.llm.common import utf8


def held_out(i, modulus):
    return zlib.crc32(str(i).encode()) % modulus


def labelled(spark, n):
    rng = random.Random(3)
    good = [int(rng.random() < 0.6) for _ in range(n)]
    texts = [" ".join(rng.choices("plain words of calm prose".split() if y else "buy now win cash 99".split(), k=4)) + f" q{i % 97}" for i, y in enumerate(good)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    return docs, spark.createDataFrame(list(enumerate(good)), "doc_id long, quality int"), texts, good


def test_ratios_count_all_labelled_rows(spark):
    docs, labels, texts, good = labelled(spark, 9000)
    kept = [i for i in range(9000) if held_out(i, 5)]
    sets = [idx.tolist() for idx in quality.row_features(*utf8(pa.array([texts[i] for i in kept])))]
    ratios = plain_ratios(sets, [good[i] for i in kept])
    model = quality.train(docs, labels)
    assert all(abs(model.ratio[f] - r) < 1e-9 for f, r in ratios.items())


def test_blocks_of_the_fit_read_every_row(spark):
    docs, labels, texts, good = labelled(spark, 400)
    whole, blocks = quality.train(docs, labels), quality.train(docs, labels, block_docs=60)
    assert np.array_equal(whole.ratio, blocks.ratio)
    found = list(quality.row_features(*utf8(pa.array(texts))))
    for model in (whole, blocks):
        scores = model.score(np.array([model.margin(idx) for idx in found]))
        assert ((scores > 0.5) == (np.array(good) == 1)).mean() > 0.99
    copies = docs.limit(1).selectExpr("explode(array_repeat(struct(*), 500)) as r").select("r.*").unionByName(docs)
    assert np.isfinite(quality.train(copies, labels, block_docs=60).weights).all()


def test_languages_learn_and_are_bounded_by_all_rows(spark):
    rng = random.Random(5)
    data = [(i, prose(rng, lang, 6), lang, "s", 0) for i in range(7000) for lang in [rng.choice(["en", "de"])]]
    docs = spark.createDataFrame(data, DOCS)
    assert langid.training_rows(docs).count() == sum(held_out(i, 3) != 1 for i in range(7000))
    model = langid.train(docs)
    _, typical = model.bits_and_typical(*utf8(pa.array([r[1] for r in data])), typical=True)
    got = {r["lang"]: r for r in langid._bounds(docs, model).collect()}
    out = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, model=model).collect()}
    for lang in ("en", "de"):
        middles = [typical[i][0] for i, _, own, *_ in data if own == lang == out[i] and held_out(i, 3) == 1]
        assert len(middles) > 800 and abs(got[lang]["typical"] - np.median(middles)) <= 1 / langid.BIT_CELLS


def test_shorter_grams_are_counted_from_the_longest():
    texts = [prose(random.Random(i), lang, 20) for i, lang in enumerate(SYLLABLES)]
    data, offsets = utf8(pa.array([*texts, "a", "é"]))
    rank = np.arange(256, dtype=np.uint8) % langid.ALPHABET
    codes = langid._codes(data, rank)
    keys, n = np.unique(langid._grams(codes, offsets, langid.MAX_ORDER), return_counts=True)
    for order, (own, counts) in langid._all_orders(keys, n.astype(float)).items():
        plain, times = np.unique(langid._grams(codes, offsets, order), return_counts=True)
        assert own.tolist() == plain.tolist() and counts.tolist() == times.tolist()
