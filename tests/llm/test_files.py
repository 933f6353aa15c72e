"""Tokens, range coder, token files, packing and fingerprints: exact round trips and brute force."""

import functools
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_data import DOCS, extra_columns, odd_texts, prose, rows
from tokenizers import Tokenizer

from skewkit.llm import fuzzyhash, packing, rangecoder, token_files, tokens
from skewkit.session import scratch_path

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def texts():
    rng = random.Random(2)
    return [prose(rng, rng.choice(["en", "de", "fr"]), rng.randint(1, 90)) for _ in range(40)] + odd_texts() + [
        "  a  b\n\n  c,", "don't!  \t x \n y's, 's", "<|endoftext|> hi <|startoftext|>.", "é ́x", "ΑΣ, ΑΣ. x!!! y?.; z:"]


@functools.cache
def plain(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def plain_ids(path, text, end):
    return np.array([*plain(path).encode(text or "", add_special_tokens=False).ids, end], "<u4")


@pytest.mark.parametrize("path", [WORD, BYTE])
@pytest.mark.parametrize("size", [20, 10_000])
def test_cached_ids_are_the_tokenizers(path, size):
    encoder = tokens.CachedEncoder(path, size)
    for _ in range(2):
        for text, ids in zip(texts(), encoder.encode([t or "" for t in texts()]), strict=True):
            assert ids.tolist() == plain_ids(path, text, 0)[:-1].tolist()


def test_blocks_round_trip():
    rng = np.random.default_rng(0)
    blocks = [rng.integers(0, high, size) for high, size in
              ((1, 5), (2, 1000), (70_000, 300), (16, 0), (49_408, 777), (1 << 20, 4096), (3, 1), (50, 4096))]
    blocks.append(np.tile([7, 8, 9, 49_407], 500))
    coded = rangecoder.encode_blocks(blocks)
    assert all((a == b).all() for a, b in zip(blocks, rangecoder.decode_blocks(coded), strict=True))
    # each block stands alone, in any order, and repetition is cheap
    assert all((rangecoder.decode_blocks([c])[0] == b).all() for c, b in zip(coded[::-1], blocks[::-1], strict=True))
    assert len(coded[-1]) < len(blocks[-1]) / 4
    assert coded[4] == rangecoder.encode_blocks([blocks[4]])[0]


def test_damage_is_noticed():
    coded = rangecoder.encode_blocks([np.arange(500)])[0]
    for at in (0, 5, 13, 17, len(coded) - 1):
        bad = coded[:at] + bytes([coded[at] ^ 1]) + coded[at + 1:]
        with pytest.raises(ValueError):
            rangecoder.decode_blocks([bad])
    with pytest.raises(ValueError):
        rangecoder.decode_blocks([coded[:-2]])
    with pytest.raises(ValueError):
        rangecoder.encode_blocks([np.zeros(rangecoder.LONGEST + 1)])


def test_crcs_combine():
    a, b = b"some bytes", b"and others" * 7
    def crcs(*texts):
        return np.array([zlib.crc32(t) for t in texts], np.uint32)
    assert token_files.combined_crcs(crcs(a), crcs(b), np.array([len(b)])).tolist() == [zlib.crc32(a + b)]
    assert token_files.combined_crcs(crcs(a), crcs(b""), np.array([0])).tolist() == [zlib.crc32(a)]
    # lists of byte strings of any number and length, joined in pairs
    rng = random.Random(3)
    lists = [[rng.randbytes(rng.choice([0, 1, 4, 300, 16384])) for _ in range(rng.choice([1, 2, 3, 7, 64]))] for _ in range(40)]
    joined = token_files.joined_crcs(crcs(*[x for ls in lists for x in ls]), np.array([len(x) for ls in lists for x in ls]),
                                     np.array([len(ls) for ls in lists]))
    assert joined.tolist() == [zlib.crc32(b"".join(ls)) for ls in lists]


def test_token_files(spark):
    docs = spark.createDataFrame(rows(texts())[::-1], DOCS)
    path = scratch_path(spark, "test-ids")
    token_files.write_ids(docs, path, WORD, 2)
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.read_digests(spark, path).collect())
    start, wanted = 0, []
    for i, t in enumerate(texts()):
        ids = plain_ids(WORD, t, 2)
        wanted.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == wanted
    pieces = sorted(((r["doc_id"], r["first"], r["ids"]) for r in token_files.read_pieces(spark, path, with_ids=True).collect()))
    assert [x for _, _, ids in pieces for x in ids] == [int(x) for t in texts() for x in plain_ids(WORD, t, 2)]


def test_token_files_of_odd_tables(spark):
    path = scratch_path(spark, "test-ids")
    token_files.write_ids(spark.createDataFrame([], DOCS), path, WORD, 2)
    assert token_files.read_digests(spark, path).collect() == []
    token_files.write_ids(extra_columns(spark, ["a", "a"]).selectExpr("null as doc_id", "text", "score").unionAll(
        spark.createDataFrame([(5, None, 0.0), (5, "b", 0.0)], "doc_id long, text string, score double")), path, WORD, 2)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"]) for r in token_files.read_digests(spark, path).collect())
    assert got == [(0, None, 2), (2, None, 2), (4, 5, 1), (5, 5, 2)]


def test_binary_lengths():
    for n in (1, 2, 3, 553, 2047, 2048, 2049, 10_000):
        sizes = packing.binary_lengths(n)
        assert sum(sizes) == n and all(s & (s - 1) == 0 and s <= 2048 for s in sizes)
        assert len(set(sizes) - {2048}) == len([s for s in sizes if s != 2048]) and sizes == sorted(sizes, reverse=True)


def test_packing_round_trip(spark):
    docs = spark.createDataFrame(rows(texts())[::-1], DOCS)
    got = packing.pack(docs, BYTE, 1, with_ids=True).collect()
    assert sorted(r["sequence_id"] for r in got) == list(range(len(got)))
    by_doc = {}
    for r in sorted(got, key=lambda r: (r["doc_id"], r["start"])):
        assert r["offset"] == 0 and r["length"] == 1 << r["bucket"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        assert r["start"] == len(by_doc.setdefault(r["doc_id"], []))
        by_doc[r["doc_id"]] += r["ids"]
        assert r["doc_tokens"] == len(plain_ids(BYTE, texts()[r["doc_id"]], 1))
    assert by_doc == {i: plain_ids(BYTE, t, 1).tolist() for i, t in enumerate(texts())}


def test_packing_edges(spark):
    assert packing.pack(spark.createDataFrame([], DOCS), BYTE, 1).collect() == []
    docs = extra_columns(spark, ["same", "same"]).selectExpr("null as doc_id", "text", "k")
    assert sorted(r["sequence_id"] for r in packing.pack(docs.unionAll(docs), BYTE, 1).collect()) == list(range(4))
    with pytest.raises(ValueError):
        packing.pack(docs, BYTE, 1, context=1000)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_edit_distances():
    rng = random.Random(1)
    a, b = (["".join(rng.choices("abc", k=rng.randint(0, 30))) for _ in range(200)] for _ in range(2))
    assert fuzzyhash.edit_distances(a, b).tolist() == [levenshtein(x, y) for x, y in zip(a, b, strict=True)]


def test_fingerprints_depend_on_the_text_alone():
    all_texts = [t or "" for t in texts()]
    together = fuzzyhash.fingerprints(all_texts)
    assert [fuzzyhash.fingerprints([t])[0] for t in all_texts] == together
    assert together[40] == "4::"


def test_fingerprints_survive_edits():
    rng = random.Random(4)
    for words in (100, 1000, 5000):
        a, b = prose(rng, words=words), prose(rng, "de", words)
        inserted = a[:len(a) // 2] + " something new in the middle " + a[len(a) // 2:]
        x, y, z = fuzzyhash.fingerprints([a, inserted, b])
        near = fuzzyhash.likeness([x, x, x], [x, y, z])
        assert near[0] == 1.0 and near[1] > 0.8 and near[2] < 0.3


@pytest.mark.parametrize("order", [1, -1])
def test_edited_texts(spark, order):
    data = texts()
    got = {r["doc_id"]: r for r in fuzzyhash.fingerprint_edits(spark.createDataFrame(rows(data)[::order], DOCS)).collect()}
    assert sorted(got) == list(range(len(data)))
    for i, t in enumerate(data):
        t, following = t or "", data[(i + 1) % len(data)] or ""
        n = len(t) // 4
        new = t[:len(t) - n] + following[:n]
        a, b, c = fuzzyhash.fingerprints([t, new, following])
        r = got[i]
        assert (r["n_chars"], r["fingerprint"], r["edited_fingerprint"]) == (len(t), a, b)
        assert r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert [r["near_edited"], r["near_next"]] == fuzzyhash.likeness([a, a], [b, c]).tolist()


def test_edited_edges(spark):
    assert fuzzyhash.fingerprint_edits(spark.createDataFrame([], DOCS)).collect() == []
    (r,) = fuzzyhash.fingerprint_edits(spark.createDataFrame(rows(["only one"]), DOCS)).collect()
    assert r["near_next"] == 1.0
    docs = spark.createDataFrame([(None, "first", None, None, None), (7, "b", None, None, None), (7, "a", None, None, None)], DOCS)
    assert fuzzyhash.fingerprint_edits(docs).count() == 3
