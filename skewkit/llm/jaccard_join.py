"""Near-duplicate self join: Jaccard similarity of word 5-shingles, pruned by Bayesian tests on MinHash values.

Words are runs without ASCII white space, ASCII letters in lower case. A text's shingles
are its distinct runs of ``SHINGLE`` words; a shorter text has one shingle of all its words.

1. Texts with the same shingles are one *class representative*, so exact copies cost
   one row however many there are. Each representative has ``HASHES`` MinHash values.
2. Values are banded; representatives that agree on a whole band are candidates. A pair at
   the threshold misses all ``BANDS`` bands with probability ``(1 - 0.8 ** 5) ** 36``, below 1e-6.
   Buckets are never expanded into pairs: each one gives a star of edges to its least
   member, and the connected components of the stars are the candidate groups.
3. A group is dealt into blocks of bounded rows and shingles, and every pair of blocks is a
   unit of work of its own. In it, pairs that share a band are compared ``STEP`` MinHash values
   at a time. With a uniform prior the similarity after ``m`` matches of ``n`` is
   Beta(m + 1, n - m + 1); a pair is dropped as soon as its chance of reaching
   the threshold falls below ``TOLERANCE``. All the rest are verified exactly on their shingles.
4. A unit returns one row per member: how many documents it is linked to there, and the least
   member it is connected with. Sums give the number of links, components of
   these few edges the classes. Pairs themselves are never emitted.

Results: one row per document. ``class_id`` is the least doc_id of its class (documents
connected by links), ``n_links`` the number of other rows at ``THRESHOLD`` or more,
copies included. Null and wordless texts have no shingles: no links, a class each.
A null doc_id ranks last (a class of such rows only has a null class_id). Repeated
rows are copies of each other. Only doc_id and text are read, whatever other columns hold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.llm.common import arrow_map, map_slices, mix64, shingle_hashes, staged, utf8, word_hashes
from skewkit.llm.components import connected_components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 36, 5
HASHES = BANDS * ROWS
STEP = 15
TOLERANCE = 1e-7
BLOCK_ROWS = 1024
BLOCK_SHINGLES = 1 << 20
_LAST = (1 << 63) - 1

_factors = mix64(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def distinct_shingles(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, and where each row's begin."""
    found, begin = shingle_hashes(*word_hashes(data, offsets), k)
    rows = [np.unique(found[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]
    sizes = [len(r) for r in rows]
    return (np.concatenate(rows) if rows else found), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def minhashes(shingles: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """MinHash values of each row (uint32, ``HASHES`` columns); all ones for a row without shingles."""
    out = np.full((len(begin) - 1, HASHES), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(begin))
    if len(full):
        starts = begin[:-1][full]
        with np.errstate(over="ignore"):
            for j in range(HASHES):
                out[full, j] = np.minimum.reduceat(shingles * _factors[j], starts) >> np.uint64(32)
    return out


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For each number of compared values the fewest matches that keep a pair.

    P(similarity >= t | m of n) is P(Binomial(n + 1, t) <= m) under the uniform prior.
    """
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        chance, m = 0.0, -1
        while chance < tolerance:
            m += 1
            chance += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per row and band."""
    keys = np.empty((len(signatures), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for b in range(BANDS):
            h = np.full(len(signatures), b + 1, np.uint64)
            for j in range(b * ROWS, (b + 1) * ROWS):
                h = mix64(h * np.uint64(0xD6E8FEB86659FD93) + signatures[:, j].astype(np.uint64))
            keys[:, b] = h
    return keys


def _signed(docs: DataFrame) -> DataFrame:
    """``k, th, set_key, n, sig`` of each row: its place among ids, text hash, shingle set, set size and MinHash values."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("k"),
                       F.xxhash64("text").alias("th"), "text")

    def sign(part: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = utf8(part.column("text"))
        shingles, begin = distinct_shingles(data, offsets)
        signatures = minhashes(shingles, begin)
        keys = []
        with np.errstate(over="ignore"):
            for a, b in zip(begin[:-1], begin[1:], strict=True):
                s = shingles[a:b]
                keys.append(np.array([s.sum(dtype=np.uint64), mix64(s).sum(dtype=np.uint64)], np.uint64).tobytes())
        return pa.record_batch({"k": part.column("k"), "th": part.column("th"), "set_key": pa.array(keys, pa.binary()),
                                "n": pa.array(np.diff(begin)), "sig": pa.array([s.tobytes() for s in signatures],
                                                                               pa.binary())})

    return map_slices(rows, sign, "k long, th long, set_key binary, n long, sig binary", limit=1 << 19)


def _bands(reps: DataFrame) -> DataFrame:
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sig = _signatures(batch.column("sig"))
                yield pa.record_batch({"band": pa.array(band_keys(sig).astype(np.int64).ravel()),
                                       "rid": pa.array(np.repeat(batch.column("rid").to_numpy(), BANDS))})
    return arrow_map(reps.select("rid", "sig"), keys, "band long, rid long")


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), HASHES)


def linked_pairs(signatures: np.ndarray, shingles: list[np.ndarray], split: int | None = None,
                 threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs ``i < j`` at the threshold or more; with ``split`` only pairs across it."""
    m = len(shingles)
    sizes = np.array([len(s) for s in shingles])
    left, right = _candidates(band_keys(signatures), split)
    # a set can't reach the threshold with one that is smaller by more than it
    near = np.minimum(sizes[left], sizes[right]) >= threshold * np.maximum(sizes[left], sizes[right]) - 1e-9
    left, right = left[near], right[near]
    matches = np.zeros(len(left), np.int32)
    for n, least in least_matches(threshold).items():
        for start in range(0, len(left), 1 << 17):
            cut = slice(start, start + (1 << 17))
            matches[cut] += (signatures[left[cut], n - STEP:n] == signatures[right[cut], n - STEP:n]).sum(axis=1)
        keep = matches >= least
        left, right, matches = left[keep], right[keep], matches[keep]
    if not len(left):
        return left, right
    common = (_common_dense if len(left) > 8 * m else _common_each)(shingles, left, right)
    ok = common >= threshold * (sizes[left] + sizes[right] - common) - 1e-9
    return left[ok], right[ok]


def _candidates(keys: np.ndarray, split: int | None) -> tuple[np.ndarray, np.ndarray]:
    rows = len(keys) if split is None else split
    others = keys if split is None else keys[split:]
    found_i, found_j = [], []
    for start in range(0, rows, 64):
        own = keys[start:min(start + 64, rows)]
        hit = np.zeros((len(own), len(others)), bool)
        for b in range(BANDS):
            hit |= own[:, b:b + 1] == others[None, :, b]
        i, j = np.nonzero(hit)
        i, j = i + start, j + (0 if split is None else split)
        found_i.append(i[i < j])
        found_j.append(j[i < j])
    if not found_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


def _common_each(shingles: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.array([len(np.intersect1d(shingles[i], shingles[j], assume_unique=True))
                     for i, j in zip(left, right, strict=True)], np.int64)


def _common_dense(shingles: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections, from products of membership matrices, some shingles at a time."""
    rows = np.repeat(np.arange(len(shingles)), [len(s) for s in shingles])
    _, column, count = np.unique(np.concatenate(shingles), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count > 1)
    place = np.full(len(count), -1)
    place[shared] = np.arange(len(shared))
    column = place[column]
    rows, column = rows[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    common = np.zeros((len(shingles), len(shingles)), np.float32)
    for start in range(0, len(shared), 4096):
        a, b = np.searchsorted(column, [start, start + 4096])
        member = np.zeros((len(shingles), min(4096, len(shared) - start)), np.float32)
        member[rows[a:b], column[a:b] - start] = 1
        common += member @ member.T
    return common[left, right].astype(np.int64)


def _least_connected(m: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    label = np.arange(m)
    while True:
        low = np.minimum(label[left], label[right])
        after = label.copy()
        np.minimum.at(after, left, low)
        np.minimum.at(after, right, low)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def _unit(key: tuple | None, rows: list[tuple]) -> tuple[list[int], list[int], list[int]]:
    """Of one pair of blocks (or one block): members, linked documents, least connected member.

    ``key``: component and both blocks; ``rows``: side, rid, copies, signature, shingles.
    """
    sides = sorted(r[0] for r in rows)
    if len(rows) < 2 or (key[1] != key[2] and sides[0] == sides[-1]):
        return [], [], []
    rows.sort(key=lambda r: (r[0], r[1]))
    split = sides.index(1) if key[1] != key[2] else None
    rid = np.array([r[1] for r in rows])
    copies = np.array([r[2] for r in rows])
    signatures = np.frombuffer(b"".join(r[3] for r in rows), np.uint32).reshape(len(rows), HASHES)
    left, right = linked_pairs(signatures, [np.frombuffer(r[4], np.uint64) for r in rows], split)
    links = np.zeros(len(rows), np.int64)
    np.add.at(links, left, copies[right])
    np.add.at(links, right, copies[left])
    # labels by least rid, not by least place
    order = np.argsort(rid)
    place = np.empty(len(rid), np.int64)
    place[order] = np.arange(len(rid))
    label = rid[order][_least_connected(len(rid), place[left], place[right])][place]
    linked = np.flatnonzero(links)
    return rid[linked].tolist(), links[linked].tolist(), label[linked].tolist()


def _verified(units: DataFrame) -> DataFrame:
    """``rid, links, label`` of the members of each unit that have a link there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out = None, [], ([], [], [])
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r[:3] != key:
                    for column, values in zip(out, _unit(key, rows), strict=True):
                        column.extend(values)
                    key, rows = r[:3], []
                    if len(out[0]) > 10_000:
                        yield _member_rows(out)
                        out = ([], [], [])
                rows.append(r[3:])
        for column, values in zip(out, _unit(key, rows), strict=True):
            column.extend(values)
        yield _member_rows(out)

    return arrow_map(units, run, "rid long, links long, label long")


def _member_rows(out: tuple) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, pa.int64()) for c in out], ["rid", "links", "label"])


def _with_shingles(docs: DataFrame, members: DataFrame) -> DataFrame:
    """``members`` (``k, th`` and more) with the shingles of their texts."""
    rows = (docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("k"),
                        F.xxhash64("text").alias("th"), "text")
            .join(members, ["k", "th"]).dropDuplicates(["rid"])
            .select("rid", "component", "copies", "sig", "n", "text"))

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        shingles, begin = distinct_shingles(*utf8(part.column("text")))
        sets = [shingles[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:], strict=True)]
        return pa.record_batch([*[part.column(c) for c in ("rid", "component", "copies", "sig", "n")],
                                pa.array(sets, pa.binary())], ["rid", "component", "copies", "sig", "n", "shingles"])

    return map_slices(rows, cut, "rid long, component long, copies long, sig binary, n long, shingles binary")


def _units(members: DataFrame) -> DataFrame:
    """Members replicated to the pairs of blocks of their component they take part in, pairs together."""
    blocks = members.groupBy("component").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    dealt = members.join(blocks, "component").withColumn(
        "own", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return (other.select("component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                         (F.col("own") > F.col("other")).cast("int").alias("side"),
                         "rid", "copies", "sig", "shingles")
            .repartition("component", "i", "j").sortWithinPartitions("component", "i", "j"))


def classes(docs: DataFrame) -> DataFrame:
    """``k, th, links, class_k, class_th`` of each row of ``docs``: its links, and the least row of its class."""
    spark = docs.sparkSession
    signed = staged(spark, _signed(docs), "signed")
    reps = staged(spark, signed.filter("n > 0").groupBy("set_key", "n").agg(
        F.min(F.struct("k", "th")).alias("least"), F.count("*").alias("copies"), F.first("sig").alias("sig"))
        .select(F.monotonically_increasing_id().alias("rid"), "set_key", "n", "copies", "least", "sig"), "reps")
    bands = _bands(reps)
    buckets = bands.groupBy("band").agg(F.min("rid").alias("v"), F.count("*").alias("size")).filter("size > 1")
    stars = bands.join(buckets.select("band", "v"), "band").select(F.col("rid").alias("u"), "v")
    groups = connected_components(stars)
    members = reps.join(groups.withColumnRenamed("node", "rid"), "rid").select(
        "rid", "component", "copies", "n", "sig", F.col("least.k").alias("k"), F.col("least.th").alias("th"))
    found = staged(spark, _verified(_units(staged(spark, _with_shingles(docs, members), "members"))), "links")
    joined = connected_components(found.select(F.col("rid").alias("u"), F.col("label").alias("v")))
    links = found.groupBy("rid").agg(F.sum("links").alias("links"))
    per_rep = (reps.select("rid", "set_key", "n", "copies", "least")
               .join(links, "rid", "left").join(joined.withColumnRenamed("node", "rid"), "rid", "left")
               .withColumn("component", F.coalesce("component", "rid")))
    heads = per_rep.groupBy("component").agg(F.min("least").alias("head"))
    per_rep = staged(spark, per_rep.join(heads, "component").select(
        "set_key", "n", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "head"), "classes")
    return (signed.select("k", "th", "set_key", "n").join(per_rep, ["set_key", "n"], "left")
            .select("k", "th", F.coalesce("links", F.lit(0)).cast("long").alias("links"),
                    F.coalesce("head.k", "k").alias("class_k"), F.coalesce("head.th", "th").alias("class_th")))


def join_near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, n_links`` of each row of ``docs``."""
    def as_id(column: str):
        return F.when(F.col(column) != _LAST, F.col(column))
    return classes(docs).select(as_id("k").alias("doc_id"), as_id("class_k").alias("class_id"),
                                F.col("links").alias("n_links"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are the least of their class; of rows with the
    same doc_id and text one stays."""
    kept = (classes(docs).filter((F.col("k") == F.col("class_k")) & (F.col("th") == F.col("class_th")))
            .select("k", "th").distinct())
    names = [f"_c{i}" for i in range(len(docs.columns))]
    doc_id, text = names[docs.columns.index("doc_id")], names[docs.columns.index("text")]
    rows = docs.toDF(*names).select("*", F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)).alias("k"),
                                    F.xxhash64(text).alias("th"))
    return rows.join(kept, ["k", "th"], "left_semi").dropDuplicates(["k", "th"]).select(*names).toDF(*docs.columns)
