"""Strings of special tokens in texts: the ids of a plain encode(text, add_special_tokens=False)."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_data import DOCS, rows
from tokenizers import Tokenizer

import corpus_pipeline
from skewkit.llm import queries, tokens

PATHS = {n: public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")}
E, S = "<|endoftext|>", "<|startoftext|>"
TEXTS = [E, S, f"a {E} b", f"a{E}b", f"a  {E}  b", f" {E} ", f"{E}{E} {S}", f"x,{E}. y!", f"a\n{E}\t b", f"é{E}́x", f"<|endoftext|{E}", "<|ENDOFTEXT|> x",
         f"don't{E}'s", f"word.{E} {E}word, {E}", f"\u3000{E}\u00a0{S}\u2003 x", f"a {E}abc. {E}abc"]


def plain(name, text):
    return Tokenizer.from_file(PATHS[name]).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", PATHS)
@pytest.mark.parametrize("size", [3, 10_000])
def test_ids_of_special_strings(name, size):
    rng = random.Random(6)
    bits = [E, S, " ", "  ", "\n", "\t ", ".", ",", "'s", "ab", "É", "é ́", "7", "<|", "|>", "!?"]
    found = TEXTS + ["".join(rng.choices(bits, k=rng.randint(1, 14))) for _ in range(400)]
    one = Tokenizer.from_file(PATHS[name])
    encoder = tokens.CachedEncoder(PATHS[name], size, special_tokens=True)
    for _ in range(2):
        for text, ids in zip(found, encoder.encode(found), strict=True):
            assert ids.tolist() == one.encode(text, add_special_tokens=False).ids, text


def test_queries_use_the_librarys_encoding(spark, monkeypatch):
    docs = spark.createDataFrame(rows(TEXTS), DOCS)
    monkeypatch.setattr(queries, "read_table", lambda *_: docs)
    word = [[*plain("word_bpe_49k.json", t), queries.WORD_BPE_END] for t in TEXTS]
    got = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in queries.op8_token_ids(spark, "").collect()}
    assert got == {i: (len(w), zlib.crc32(np.array(w, "<u4").tobytes())) for i, w in enumerate(word)}
    byte = {i: len(plain("byte_bpe_50k.json", t)) + 1 for i, t in enumerate(TEXTS)}
    for packed in (queries.op10_packing(spark, ""), corpus_pipeline.packing_stage(spark, docs, "")):
        assert {r["doc_id"]: r["doc_tokens"] for r in packed.collect()} == byte
