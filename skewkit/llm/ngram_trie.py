"""N-gram tries with Elias-Fano levels.

Level 0 holds the words, level k the words that follow each context of k words. A level's ids are relative to their
context: the ids of one context's children rise, and adding the last value of the context before makes the whole
level one monotone sequence, which Elias-Fano coding stores in little more than the logarithm of the mean
gap. A child is found by successor search: its context's pointers bound its place, the context's base
is added to its id, and the first element that is not below is looked up and compared. Pointers are
monotone sequences as well, and so are the cumulated counts of the words. Probabilities and back-off weights are
8-bit codes of a code book for each level.

A trie is one block of bytes and is used where it lies: ``Trie.open`` maps a file, ``Trie.mapped`` an anonymous
map, which goes back to the system as a whole when it is dropped. All calls take arrays of queries.
"""

from __future__ import annotations

import mmap

import numpy as np

#: Codes of a quantised level.
CODES = 256


class EliasFano:
    """A non-decreasing sequence of unsigned 64-bit integers. Low parts are whole bytes; high parts are the gaps
    between the ones of a bit vector, read by counts of ones to the end of each 64-bit word."""

    HEADER = 4

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        values = np.ascontiguousarray(values, np.uint64)
        n = len(values)
        base = values[0] if n else np.uint64(0)
        values = values - base
        spread = int(values[-1]) // n if n else 0
        low_bytes = (spread.bit_length() + 7) // 8
        high = (values >> np.uint64(8 * low_bytes)).astype(np.int64) if low_bytes < 8 else np.zeros(n, np.int64)
        bits = np.zeros(((int(high[-1]) if n else 0) + n + 2 + 63) // 64 * 64, bool)
        bits[high + np.arange(n)] = True
        low = values.view(np.uint8).reshape(n, 8)[:, :low_bytes].tobytes()
        words = np.packbits(bits, bitorder="little").tobytes()
        header = np.array([n, low_bytes, base, len(words) // 8], np.uint64).tobytes()
        return header + words + low + b"\0" * (-len(low) % 8)

    def __init__(self, buffer, at: int = 0):
        """Reads the sequence that starts at byte ``at``; ``end`` is the byte after it."""
        n, low_bytes, base, words = (int(x) for x in np.frombuffer(buffer, np.uint64, self.HEADER, at))
        self.n, self.low_bytes, self.base = n, low_bytes, np.uint64(base)
        at += 8 * self.HEADER
        self.words = np.frombuffer(buffer, np.uint64, words, at)
        at += 8 * words
        self.low = np.frombuffer(buffer, np.uint8, n * low_bytes, at).reshape(n, low_bytes)
        self.end = at + (n * low_bytes + 7) // 8 * 8
        self.ones = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)
        self.zeros = 64 * np.arange(1, words + 1) - self.ones

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Position of the k-th one (zero) of the bit vector, counted from 0."""
        counts = self.ones if one else self.zeros
        at = np.searchsorted(counts, k, side="right")
        rest = k - np.where(at > 0, counts[np.maximum(at - 1, 0)], 0)
        word = self.words[at] if one else ~self.words[at]
        place = at * 64
        for width in (32, 16, 8, 4, 2, 1):
            part = word & np.uint64((1 << width) - 1)
            count = np.bitwise_count(part).astype(np.int64)
            beyond = rest >= count
            rest = np.where(beyond, rest - count, rest)
            word = np.where(beyond, word >> np.uint64(width), part)
            place = place + np.where(beyond, width, 0)
        return place

    def _low(self, at: np.ndarray | slice) -> np.ndarray:
        low = self.low[at]
        out = np.zeros((len(low), 8), np.uint8)
        out[:, :self.low_bytes] = low
        return out.view(np.uint64)[:, 0]

    def get(self, at: np.ndarray) -> np.ndarray:
        high = (self._select(at, True) - at).astype(np.uint64)
        if self.low_bytes < 8:
            high = high << np.uint64(8 * self.low_bytes)
        return self.base + (high | self._low(at))

    def values(self) -> np.ndarray:
        """All elements, in order."""
        high = np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little"))[:self.n] - np.arange(self.n)
        high = high.astype(np.uint64)
        if self.low_bytes < 8:
            high = high << np.uint64(8 * self.low_bytes)
        return self.base + (high | self._low(slice(None)))

    def successor(self, wanted: np.ndarray) -> np.ndarray:
        """Place of the first element that is not below each wanted value (``n``: none)."""
        wanted = wanted.astype(np.uint64)
        if not self.n:
            return np.zeros(len(wanted), np.int64)
        below = wanted <= self.base
        rest = np.where(below, np.uint64(0), wanted - self.base)
        bucket = rest >> np.uint64(8 * self.low_bytes) if self.low_bytes < 8 else np.zeros(len(rest), np.uint64)
        beyond = bucket >= np.uint64(self.zeros[-1])
        bucket = np.where(beyond, np.uint64(0), bucket).astype(np.int64)
        begin = np.where(bucket > 0, self._select(np.maximum(bucket - 1, 0), False) - (bucket - 1), 0)
        end = self._select(bucket, False) - bucket
        part = rest & np.uint64((1 << 8 * self.low_bytes) - 1)
        active = np.flatnonzero((begin < end) & ~beyond)
        while len(active):
            middle = (begin[active] + end[active]) // 2
            less = self._low(middle) < part[active]
            begin[active[less]] = middle[less] + 1
            end[active[~less]] = middle[~less]
            active = active[begin[active] < end[active]]
        return np.where(beyond, self.n, np.where(below, 0, begin))


def quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """8-bit codes and their code book: each distinct value has a code if there are few, else codes hold
    equal numbers of values and stand for their mean."""
    ordered = np.sort(values)
    edges = ordered[np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))] if len(ordered) else np.zeros(1)
    if len(edges) > CODES:
        edges = np.unique(ordered[np.arange(CODES) * len(ordered) // CODES])
    codes = (np.searchsorted(edges, values, side="right") - 1).astype(np.uint8)
    n = np.maximum(np.bincount(codes, minlength=len(edges)), 1)
    book = np.zeros(CODES)
    book[:len(edges)] = np.bincount(codes, values, len(edges)) / n
    return codes, book


def _section(array: np.ndarray) -> bytes:
    raw = array.tobytes()
    return np.array([len(raw)], np.uint64).tobytes() + raw + b"\0" * (-len(raw) % 8)


class Trie:
    """``lookup`` walks down one level; ``count``, ``probability`` and ``backoff`` read a node's values."""

    @staticmethod
    def encode(words: np.ndarray, counts: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]],
               probabilities: list[np.ndarray], backoffs: list[np.ndarray]) -> bytes:
        """``words``: rising ids of level 0 with their ``counts``. ``levels[k]``: parent's place and own id of the nodes of
        level ``k + 1``, by parent and id. ``probabilities[k]``: of those nodes. ``backoffs[k]``: of the nodes of level ``k``."""
        out = [np.array([len(levels) + 1], np.uint64).tobytes(), EliasFano.encode(words),
               EliasFano.encode(np.concatenate([[0], np.cumsum(counts)]))]
        above = len(words)
        for (parent, child), probability in zip(levels, probabilities, strict=True):
            first = np.searchsorted(parent, np.arange(above + 1))
            last = np.where(np.diff(first) > 0, child[np.maximum(first[1:] - 1, 0)] if len(child) else 0, 0).astype(np.uint64)
            base = np.concatenate([np.zeros(1, np.uint64), np.cumsum(last, dtype=np.uint64)[:-1]]) if above else last
            codes, book = quantise(probability)
            out += [EliasFano.encode(first), EliasFano.encode(child.astype(np.uint64) + base[parent]), _section(codes), _section(book)]
            above = len(child)
        for backoff in backoffs:
            codes, book = quantise(backoff)
            out += [_section(codes), _section(book)]
        return b"".join(out)

    def __init__(self, buffer):
        self.buffer = buffer
        levels = int(np.frombuffer(buffer, np.uint64, 1)[0])
        self.words = EliasFano(buffer, 8)
        self.counts = EliasFano(buffer, self.words.end)
        at = self.counts.end
        self.pointers, self.children, self.probabilities, self.backoffs = [], [], [], []
        for _ in range(levels - 1):
            self.pointers.append(EliasFano(buffer, at))
            self.children.append(EliasFano(buffer, self.pointers[-1].end))
            codes, at = self._read(self.children[-1].end, np.uint8)
            book, at = self._read(at, np.float64)
            self.probabilities.append((codes, book))
        for _ in range(levels - 1):
            codes, at = self._read(at, np.uint8)
            book, at = self._read(at, np.float64)
            self.backoffs.append((codes, book))

    def _read(self, at: int, dtype) -> tuple[np.ndarray, int]:
        size = int(np.frombuffer(self.buffer, np.uint64, 1, at)[0])
        return np.frombuffer(self.buffer, dtype, size // np.dtype(dtype).itemsize, at + 8), at + 8 + (size + 7) // 8 * 8

    @classmethod
    def open(cls, path: str) -> Trie:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    @classmethod
    def mapped(cls, data: bytes) -> Trie:
        area = mmap.mmap(-1, len(data))
        area.write(data)
        return cls(area)

    def word(self, ids: np.ndarray) -> np.ndarray:
        """Places of words at level 0, -1 where there is none."""
        at = self.words.successor(ids)
        near = np.minimum(at, max(self.words.n - 1, 0))
        return np.where((at < self.words.n) & (self.words.get(near) == ids), at, -1) if self.words.n else np.full(len(ids), -1)

    def lookup(self, level: int, parent: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Places at ``level`` of children ``ids`` of nodes ``parent`` of the level above; -1 where either is missing."""
        found = np.full(len(parent), -1)
        at = np.flatnonzero(parent >= 0)
        children = self.children[level - 1]
        if not len(at) or not children.n:
            return found
        begin = self.pointers[level - 1].get(parent[at]).astype(np.int64)
        end = self.pointers[level - 1].get(parent[at] + 1).astype(np.int64)
        base = np.where(begin > 0, children.get(np.maximum(begin - 1, 0)), np.uint64(0))
        wanted = base + ids[at].astype(np.uint64)
        place = children.successor(wanted)
        hit = (place >= begin) & (place < end)
        hit &= children.get(np.where(hit, place, 0)) == wanted
        found[at[hit]] = place[hit]
        return found

    def count(self, place: np.ndarray) -> np.ndarray:
        known = np.maximum(place, 0)
        if not self.words.n:
            return np.zeros(len(place), np.int64)
        return np.where(place >= 0, (self.counts.get(known + 1) - self.counts.get(known)).astype(np.int64), 0)

    @staticmethod
    def _value(table: tuple[np.ndarray, np.ndarray], place: np.ndarray, missing: float) -> np.ndarray:
        codes, book = table
        return np.where(place >= 0, book[codes[np.maximum(place, 0)]] if len(codes) else missing, missing)

    def probability(self, level: int, place: np.ndarray) -> np.ndarray:
        return self._value(self.probabilities[level - 1], place, np.nan)

    def backoff(self, level: int, place: np.ndarray) -> np.ndarray:
        """Weight of what a context leaves to shorter ones; 0 (a factor of 1) for a context that is not there."""
        return self._value(self.backoffs[level], place, 0.0)
