"""Benchmark decontamination: SimHash of item-sized windows, a multi-index of Hamming blocks, exact verification.

Words are runs without ASCII white space, ASCII letters in lower case; shingles are
runs of ``SHINGLE`` words (of all its words, for a shorter item). A document is
compared with an item over windows of as many words as the item has (over the whole
document, if that is shorter). Similarity is the weighted Jaccard
similarity of both shingle multisets, a shingle weighing as often as it occurs:
sum of minima over sum of maxima. ``THRESHOLD`` or more is a leak.

A window's SimHash has 64 bits. Each occurrence of a shingle votes by a hash of the shingle and of its number among the window's
equal ones, so that the votes are a set whose Jaccard similarity is the windows' weighted one: a repeated shingle
has no more votes of one kind than any other. Fingerprints are cut into ``RADIUS + 1`` blocks; two that
differ in at most ``RADIUS`` bits agree on some block, so the index of the items' blocks finds
every item of the window's size within the radius. All found are verified exactly.
Two windows of similarity 0.8 differ in each bit with a probability of about 0.15, in about 10 bits, and in more than ``RADIUS`` in
about 1 case in 20,000, whether shingles repeat or not (measured in the tests); such pairs are lost.

Not every window needs a fingerprint. Similarity above 0 needs a common shingle, and moving
a window right up to the next shingle that the item has loses none, so the best
window of an item starts at a shingle of the item or ends with the document. Only
those are looked at, which changes no result.

The index of the items is broadcast, at most ``CHUNK_BYTES`` of item text at a time (its arrays take about ten times that); a larger
benchmark is compared chunk by chunk, each in a pass of its own. Documents are never shuffled. Extra columns of the input are
not read by ``find_leaks`` and come along in ``clean_documents``, whatever their names.

Results: a null or wordless text or item never matches. Repeated rows and items match
each by itself, null ids stay null. An empty benchmark leaves all documents clean.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.llm.common import annotate, map_slices, mix64, restored, shingle_hashes, utf8, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 22
CHUNK_BYTES = 8 << 20
_FILTER_BITS = 20
#: Values in a matrix of windows.
_MATRIX = 1 << 20
_NUMBERS = np.uint64(0xA24BAED4963EE407)     # odd: tells the occurrences of a shingle apart

_bit = np.arange(64, dtype=np.uint64)


def simhash(windows: np.ndarray) -> np.ndarray:
    """Fingerprint of each row of shingle hashes; the n-th occurrence of a shingle in it votes on all bits by its own hash."""
    out = np.zeros(len(windows), np.uint64)
    ordered = np.sort(windows, axis=1)
    again = ordered[:, 1:] == ordered[:, :-1]
    some = np.flatnonzero(again.any(axis=1))
    if len(some):
        rows = ordered[some]
        place = np.broadcast_to(np.arange(rows.shape[1]), rows.shape)
        first = np.maximum.accumulate(np.where(np.pad(again[some], ((0, 0), (1, 0))), 0, place), axis=1)
        number = (place - first).astype(np.uint64)
        with np.errstate(over="ignore"):
            ordered[some] = np.where(number > 0, mix64(rows + number * _NUMBERS), rows)
    windows = ordered
    for b in _bit:
        ones = ((windows >> b) & np.uint64(1)).sum(axis=1, dtype=np.int64)
        out |= (2 * ones > windows.shape[1]).astype(np.uint64) << b
    return out


def simhash_of(items: list[np.ndarray]) -> np.ndarray:
    """Fingerprints of items of one size, a bounded matrix of them at a time."""
    step = max(1, _MATRIX // len(items[0]))
    return np.concatenate([simhash(np.array(items[i:i + step])) for i in range(0, len(items), step)])


def _blocks(fingerprints: np.ndarray, radius: int) -> list[np.ndarray]:
    edges = np.linspace(0, 64, radius + 2).astype(np.int64)
    return [(fingerprints >> np.uint64(a)) & np.uint64((1 << int(b - a)) - 1)
            for a, b in zip(edges[:-1], edges[1:], strict=True)]


class _SizeClass:
    """The multi-index over the fingerprints of the items of one size."""

    def __init__(self, items: list[int], fingerprints: np.ndarray, radius: int):
        self.items, self.fingerprints, self.radius = np.array(items), fingerprints, radius
        self.index = []
        for values in _blocks(fingerprints, radius):
            order = np.argsort(values, kind="stable")
            self.index.append((values[order], order))

    def within(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(window, item)`` pairs whose fingerprints differ in at most ``radius`` bits."""
        pairs = []
        for (values, order), wanted in zip(self.index, _blocks(windows, self.radius), strict=True):
            low, high = np.searchsorted(values, wanted, "left"), np.searchsorted(values, wanted, "right")
            n = high - low
            window = np.repeat(np.arange(len(windows)), n)
            at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
            pairs.append(window * len(order) + order[at])
        window, item = np.divmod(np.unique(np.concatenate(pairs)), len(self.items))
        near = np.bitwise_count(windows[window] ^ self.fingerprints[item]) <= self.radius
        return window[near], self.items[item[near]]


class ItemIndex:
    """Shingles and fingerprints of benchmark items; ``matches`` compares texts with them."""

    def __init__(self, texts: list[str | None], threshold: float = THRESHOLD, radius: int = RADIUS):
        self.threshold = threshold
        data, offsets = utf8(pa.array(texts, pa.string()))
        words, first = word_hashes(data, offsets)
        shingles, begin = shingle_hashes(words, first, SHINGLE)
        counts = np.diff(first)
        by_size: dict[tuple[int, int], list[int]] = defaultdict(list)
        #: each item's distinct shingles, in order, and how often it has them
        self.weights: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for i in np.flatnonzero(np.diff(begin)).tolist():
            self.weights[i] = np.unique(shingles[begin[i]:begin[i + 1]], return_counts=True)
            # items of fewer words than a shingle: their run of words is the shingle
            by_size[min(int(counts[i]), SHINGLE), int(begin[i + 1] - begin[i])].append(i)
        self.classes = {size: _SizeClass(items, simhash_of([shingles[begin[i]:begin[i + 1]] for i in items]), radius)
                        for size, items in by_size.items()}
        self.lookup = {}
        for k in sorted({k for k, _ in by_size}):
            held = [(self.weights[i][0], length) for (own, length), items in by_size.items() if own == k for i in items]
            keys = np.concatenate([x for x, _ in held])
            lengths = np.repeat([n for _, n in held], [len(x) for x, _ in held])
            order = np.lexsort((lengths, keys))
            keys, lengths = keys[order], lengths[order]
            new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (lengths[1:] != lengths[:-1])])
            keys, lengths = keys[new], lengths[new]
            start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            coarse = np.zeros(1 << _FILTER_BITS, bool)
            coarse[keys >> np.uint64(64 - _FILTER_BITS)] = True
            # distinct shingles, and the sizes of the items that hold the i-th: from start[i] to start[i + 1]
            self.lookup[k] = (keys[start], np.append(start, len(keys)), lengths, coarse)

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, float, int, int, int]]:
        """``row, item, similarity, first word, words, differing bits`` of each leak's best window."""
        words, first = word_hashes(data, offsets)
        for k, (keys, start, lengths, coarse) in self.lookup.items():
            shingles, begin = shingle_hashes(words, first, k)
            at = np.flatnonzero(coarse[shingles >> np.uint64(64 - _FILTER_BITS)])
            place = np.minimum(np.searchsorted(keys, shingles[at]), len(keys) - 1)
            hit = keys[place] == shingles[at]
            at, place = at[hit], place[hit]
            rows = np.searchsorted(begin, at, side="right") - 1
            starts: dict[tuple[int, int], set[int]] = defaultdict(set)
            for row, pos, key in zip(rows.tolist(), at.tolist(), place.tolist(), strict=True):
                size = int(begin[row + 1] - begin[row])
                for length in lengths[start[key]:start[key + 1]].tolist():
                    starts[row, length].add(min(pos - int(begin[row]), max(size - length, 0)))
            for (row, length), found in starts.items():
                own = shingles[begin[row]:begin[row + 1]]
                yield from ((row, *m) for m in self._best(own, k, length, np.array(sorted(found))))

    def _best(self, own: np.ndarray, k: int, length: int, starts: np.ndarray) -> list[tuple]:
        size = min(length, len(own))
        best: dict[int, tuple] = {}
        step = max(1, _MATRIX // size)
        for cut in range(0, len(starts), step):
            begin = starts[cut:cut + step]
            windows = own[begin[:, None] + np.arange(size)]
            prints = simhash(windows)
            cls = self.classes[k, length]
            for w, item in zip(*(x.tolist() for x in cls.within(prints)), strict=True):
                similarity = self._similarity(windows[w], self.weights[item])
                if similarity >= self.threshold - 1e-12 and similarity > best.get(item, (0.0,))[0]:
                    differ = int(np.bitwise_count(prints[w] ^ cls.fingerprints[cls.items == item][0]))
                    best[item] = (similarity, int(begin[w]), size + k - 1, differ)
        return [(item, *m) for item, m in best.items()]

    @staticmethod
    def _similarity(window: np.ndarray, weights: tuple[np.ndarray, np.ndarray]) -> float:
        keys, counts = np.unique(window, return_counts=True)
        own, times = weights
        at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
        common = int(np.where(own[at] == keys, np.minimum(counts, times[at]), 0).sum())
        return common / (len(window) + int(times.sum()) - common)


def item_chunks(benchmark: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[list, ItemIndex]]:
    """Ids and index of the items, at most about ``chunk_bytes`` of text at a time; never an empty chunk."""
    ids, texts, size = [], [], 0
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null")
    for row in rows.sort("item_id", "text").toLocalIterator():
        ids.append(row["item_id"])
        texts.append(row["text"])
        size += len(row["text"].encode())
        if size >= chunk_bytes:
            yield ids, ItemIndex(texts)
            ids, texts, size = [], [], 0
    if ids:
        yield ids, ItemIndex(texts)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, similarity, start_word, n_words, differing_bits``: each leak's best (first) window."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, similarity double, start_word long, n_words long, differing_bits int"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = spark.createDataFrame([], schema)
    for ids, index in item_chunks(benchmark):
        shared = spark.sparkContext.broadcast((ids, index))

        def find(part: pa.RecordBatch, shared=shared) -> pa.RecordBatch | None:
            ids, index = shared.value
            found = list(index.matches(*utf8(part.column("text"))))
            if not found:
                return None
            row, item, *rest = zip(*found, strict=True)
            kinds = (pa.float64(), pa.int64(), pa.int64(), pa.int32())
            return pa.record_batch([part.column("doc_id").take(pa.array(row)),
                                    pa.array([ids[i] for i in item], pa.int64()),
                                    *[pa.array(x, t) for x, t in zip(rest, kinds, strict=True)]],
                                   ["doc_id", "item_id", "similarity", "start_word", "n_words", "differing_bits"])

        out = out.unionByName(map_slices(rows, find, schema))
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no passage of the benchmark."""
    columns = docs.columns
    for _, index in item_chunks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def leaks(text: pa.Array, shared=shared) -> list[pa.Array]:
            hit = np.zeros(len(text), bool)
            for row, *_ in shared.value.matches(*utf8(text)):
                hit[row] = True
            return [pa.array(hit)]

        docs = restored(annotate(docs, leaks, "leak boolean").filter("not leak"), columns)
    return docs
