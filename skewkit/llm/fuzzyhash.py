"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of the last ``WINDOW`` bytes ends a piece wherever its low ``k`` bits are
all ones, so pieces have ``2 ** k`` bytes on average (the block size) and a local edit
moves only nearby boundaries. Each piece gives one of 64 signature characters;
runs of more than three equal characters are cut to three. A fingerprint is
``<block size>:<signature>:<signature at twice the block size>``. ``k`` starts at
the size that gives about 64 pieces, and moves down while the signature has fewer
than ``FEW`` characters or up while it has more than ``MANY``.

Two fingerprints are compared at compatible block sizes (equal, or one twice the
other): one minus the edit distance over the longer signature, and 0 unless
they share a run of ``COMMON`` characters (of 2, if one has fewer than ``SHORT``). Equal fingerprints are at 1.0.

Whole texts are read. A null text counts as an empty one, whose fingerprint is
``4::``. Rows are dealt into ranges of doc_id; each range also gets the first row of the
next one (the last range: of the first), so that every row sees its
successor. Rows of one doc_id follow each other by text; a null doc_id sorts first; a lone
row is its own successor. An empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.llm.common import SLICE_BYTES, arrow_map, mix64, span_hashes
from skewkit.llm.ordering import default_parts, range_index, range_splits

WINDOW = 7
LEAST_K = 2
FEW, MANY = 24, 96
COMMON, SHORT = 4, 12
#: The signature alphabet (base 64).
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"

_letters = np.frombuffer(ALPHABET.encode(), np.uint8)
_factor = np.uint64(0x100000001B3)


def boundary_levels(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte how many low bits of the rolling hash are ones; a window stays in its row."""
    n = len(data)
    value = np.zeros(n, np.uint64)
    since = np.arange(n) - np.repeat(offsets[:-1], np.diff(offsets))
    with np.errstate(over="ignore"):
        scale = np.uint64(1)
        for j in range(min(WINDOW, n)):
            seen = data[:n - j].astype(np.uint64) + np.uint64(1)
            value[j:] += np.where(since[j:] >= j, seen * scale, np.uint64(0))
            scale = scale * _factor
    zeros = ~mix64(value)
    lowest = zeros & (np.uint64(0) - zeros)
    return np.where(zeros == 0, 64, np.log2(np.maximum(lowest, np.uint64(1)).astype(np.float64))).astype(np.uint8)


def _signature(prefix, begin: int, end: int, levels: np.ndarray, k: int) -> np.ndarray:
    ends = np.flatnonzero(levels[begin:end] >= k) + begin + 1
    if not len(ends) or ends[-1] != end:
        ends = np.append(ends, end)
    codes = prefix(np.concatenate([[begin], ends[:-1]]), ends)
    if len(codes) > 3:
        run = (codes[3:] == codes[2:-1]) & (codes[2:-1] == codes[1:-2]) & (codes[1:-2] == codes[:-3])
        codes = codes[np.concatenate([[True] * 3, ~run])]
    return codes


def fingerprints(texts: list[str]) -> list[str]:
    """The fingerprint of each text."""
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    levels = boundary_levels(data, offsets)
    out = []
    for i, r in enumerate(raw):
        a, e = int(offsets[i]), int(offsets[i + 1])
        if a == e:
            out.append(f"{1 << LEAST_K}::")
            continue
        piece = _PieceCodes(data[a:e])
        level = levels[a:e]
        size = e - a
        k = max(LEAST_K, (max(size - 1, 1) // 64).bit_length())
        sig = _signature(piece, 0, size, level, k)
        while len(sig) > MANY:
            k += 1
            sig = _signature(piece, 0, size, level, k)
        while len(sig) < FEW and k > LEAST_K:
            finer = _signature(piece, 0, size, level, k - 1)
            if len(finer) > MANY:
                break
            k, sig = k - 1, finer
        double = _signature(piece, 0, size, level, k + 1)
        out.append(f"{1 << k}:{_letters[sig].tobytes().decode()}:{_letters[double].tobytes().decode()}")
    return out


class _PieceCodes:
    """Codes 0 to 63 of byte spans of one text; the content alone decides."""

    def __init__(self, data: np.ndarray):
        self.data = data

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (span_hashes(self.data, starts, ends) >> np.uint64(58)).astype(np.int64)


def edit_distances(left: list[str], right: list[str]) -> np.ndarray:
    """Levenshtein distances of the pairs, all pairs a step at a time."""
    n = len(left)
    if not n:
        return np.zeros(0, np.int64)
    a_len = np.array([len(x) for x in left])
    b_len = np.array([len(x) for x in right])
    a, b = _padded(left, 1), _padded(right, 2)
    width = b.shape[1]
    steps = np.arange(width + 1, dtype=np.int16)
    row = np.broadcast_to(steps, (n, width + 1)).copy()
    found = row[np.arange(n), b_len].astype(np.int64)      # of pairs with an empty left side
    for i in range(a.shape[1]):
        moved = np.empty_like(row)
        moved[:, 0] = i + 1
        np.minimum(row[:, 1:] + 1, row[:, :-1] + (b != a[:, i:i + 1]), out=moved[:, 1:])
        # insertions: the least of all earlier cells plus the steps since
        row = np.minimum.accumulate(moved - steps, axis=1) + steps
        done = np.flatnonzero(a_len == i + 1)
        found[done] = row[done, b_len[done]]
    return found


def _padded(texts: list[str], filler: int) -> np.ndarray:
    width = max(map(len, texts), default=0)
    joined = "".join(t.ljust(width, chr(filler)) for t in texts).encode()
    return np.frombuffer(joined, np.uint8).reshape(len(texts), width)


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """Likeness (0 to 1) of each pair of fingerprints."""
    out = np.zeros(len(left))
    pairs, a, b = [], [], []
    for i, (x, y) in enumerate(zip(left, right, strict=True)):
        if x == y:
            out[i] = 1.0
            continue
        size_x, one_x, two_x = x.split(":")
        size_y, one_y, two_y = y.split(":")
        size_x, size_y = int(size_x), int(size_y)
        if size_x == size_y:
            shared = [(one_x, one_y), (two_x, two_y)]
        elif size_x == 2 * size_y:
            shared = [(one_x, two_y)]
        elif size_y == 2 * size_x:
            shared = [(two_x, one_y)]
        else:
            continue
        for s, t in shared:
            if _common_run(s, t):
                pairs.append(i)
                a.append(s)
                b.append(t)
    for start in range(0, len(pairs), 512):
        cut = slice(start, start + 512)
        longest = np.array([max(len(s), len(t)) for s, t in zip(a[cut], b[cut], strict=True)])
        np.maximum.at(out, pairs[cut], 1.0 - edit_distances(a[cut], b[cut]) / longest)
    return out


def _common_run(s: str, t: str) -> bool:
    n = COMMON if min(len(s), len(t)) >= SHORT else 2
    grams = {s[i:i + n] for i in range(len(s) - n + 1)}
    return any(t[i:i + n] in grams for i in range(len(t) - n + 1))


def with_fingerprints(df: DataFrame, column: str = "text") -> DataFrame:
    """``df`` with the column ``fingerprint`` of its text column."""
    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(fingerprints(list(texts.fillna(""))))

    return df.withColumn("fingerprint", of(F.col(column)))


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as many first code points of ``following``, or all."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def _with_successors(docs: DataFrame, parts: int) -> DataFrame:
    """Partitions of ``_range, _extra, doc_id, text`` sorted by range and id; each range ends with its successor row."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    splits = range_splits(rows, "doc_id", parts)
    dealt = rows.select(range_index("doc_id", splits).alias("_range"), "doc_id", "text")
    key = F.coalesce("doc_id", F.lit(-(2 ** 63)).cast("long"))
    # one smallest id per range: at most ``parts`` rows
    least = sorted((r["_range"], r["k"]) for r in dealt.groupBy("_range").agg(F.min(key).alias("k")).collect())
    heads = [(k, least[i - 1][0]) for i, (_, k) in enumerate(least)]
    wanted = spark.createDataFrame(heads, "_head long, _to int")
    extra = (rows.join(F.broadcast(wanted), key == F.col("_head"))
             .groupBy("_to", "doc_id").agg(F.min("text").alias("text"))
             .select(F.col("_to").alias("_range"), "doc_id", "text"))
    both = dealt.withColumn("_extra", F.lit(False)).unionByName(extra.withColumn("_extra", F.lit(True)))
    return (both.repartition(default_parts(spark), "_range")
            .sortWithinPartitions("_range", "_extra", F.col("doc_id").asc_nulls_first(), "text")
            .select("_range", "_extra", "doc_id", "text"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of each row."""
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        ids, texts, following = zip(*rows, strict=True)
        changed = [edited(t, f) for t, f in zip(texts, following, strict=True)]
        # rows follow each other, so most successors are rows of this group too
        prints = dict(zip(unique := list(dict.fromkeys([*texts, *following])), fingerprints(unique), strict=True))
        own, new = [prints[t] for t in texts], fingerprints(changed)
        return pa.record_batch({
            "doc_id": pa.array(ids, pa.int64()), "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed]),
            "fingerprint": pa.array(own), "edited_fingerprint": pa.array(new),
            "near_edited": pa.array(likeness(own, new)),
            "near_next": pa.array(likeness(own, [prints[f] for f in following]))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[tuple] = []
        size, before = 0, None
        for b in batches:
            for at in range(b.num_rows):
                part, extra, doc_id, text = (b.column(c)[at].as_py() for c in range(4))
                if before is not None and before[0] == part:
                    ready.append((before[1], before[2], text))
                    size += 2 * len(before[2]) + len(text)
                before = None if extra else (part, doc_id, text)
                if size > SLICE_BYTES:
                    yield batch(ready)
                    ready, size = [], 0
        if ready:
            yield batch(ready)

    return arrow_map(_with_successors(docs, 4 * default_parts(docs.sparkSession)), run, schema)
