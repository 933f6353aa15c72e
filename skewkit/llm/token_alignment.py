"""Alignment of two tokenizers' tokens over the same bytes, and statistics of the linked id pairs.

Tokens A (byte-level BPE, of a space and the text) and B (sentencepiece, which puts that space itself) cut the same
bytes. The byte offsets where tokens of both end are found by a galloping intersection of the two lists of
ends: in each document the shorter list drives, and each of its ends is looked up in the longer one from a
cursor, first in doubling steps, then by binary search (``gallop``; all cursors of a slice of documents step
together in numpy). The common ends cut both token lists into groups. A driver token's rank among the longer
list's ends, and that of its predecessor, bound the longer list's tokens that its bytes overlap: its links.

Jobs:

1. Each slice of documents is encoded, aligned and reduced to figures, a digest, and per document its distinct
   linked pairs with their numbers of links. The distinct pairs of a slice, with the number of its documents that
   hold them, leave in blocks by A id. Pairs that a slice holds often leave once, so a hot pair is one entry a slice.
2. A block's shard holds all pairs of its A ids: it adds up the documents of each pair and marks an A id's highest. The
   answers go back by slice.
3. A slice's documents add up the counts and highest marks of their links.

Nothing is broadcast but file names, and no table of all pairs is held in one place.

Defined results: null and empty texts, and texts whose joined A or B bytes differ from a space and the text (those with
U+2581), have no tokens: zeros and an empty digest. Strings of special tokens are plain text. Rows that repeat an id are
documents of their own; an empty table gives no rows; a null id stays null; extra columns are not read. Texts are never cut: a
longer text than a slice is a slice of its own. The same table must read alike if a task runs again, as files do.
"""

from __future__ import annotations

import hashlib
import os
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.llm.common import arrow_map, kept_in_worker, slices
from skewkit.llm.ordering import default_parts
from skewkit.llm.tokens import pieces
from skewkit.session import scratch_path

#: Text bytes of a slice: its tokens, links and distinct pairs are held at once.
SLICE_BYTES = 3 << 20
#: Pieces of texts that a worker keeps encoded.
CACHE_PIECES = 300_000
SPACE = "▁"
KIND = "token alignment"
ROWS = "slice long, place int, payload binary"
RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def packed(value) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(value, protocol=5))


def unpacked(payload: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(payload))


# ---------------------------------------------------------------- tokens

def byte_level_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters stand for
    themselves, the other bytes, in order, for the characters from U+0100 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def _piece_bytes(piece: str) -> bytes:
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(SPACE, " ").encode()


def units(text: str) -> list[str]:
    """``pieces`` of a space and the text, without that space: each follows a space that a non-space or nothing precedes."""
    if text.startswith(" "):
        first, *rest = pieces("." + text)[1:]
        return [" " + first, *rest]
    return pieces(text)


def _ragged(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``start .. start + length - 1`` of every run, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class Vocabularies:
    """Both tokenizers with a bounded cache of pieces: a text's pieces, each with the space before it, are encoded
    alone, as neither tokenizer has tokens that go on across such a space (A: see ``tokens``; B: checked here)."""

    def __init__(self, byte_level: str, piece_model: str, limit: int = CACHE_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=piece_model)
        of_char = byte_level_characters()
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.bytes_a = [bytes(of_char.get(c, 0) for c in n) for n in names]
        own = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(SPACE in p.lstrip(SPACE) for p in own):
            raise ValueError("a piece goes on across a space: texts can't be cut there")
        self.bytes_b = [_piece_bytes(p) for p in own]
        self.len_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.len_b = np.array([len(t) for t in self.bytes_b], np.int64)
        self.limit = limit
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = {"a": np.zeros(0, np.int32), "b": np.zeros(0, np.int32)}
        self.first = {"a": np.zeros(1, np.int64), "b": np.zeros(1, np.int64)}
        self.same = np.zeros(0, bool)

    def _encode_a(self, some: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch([" " + p for p in some], add_special_tokens=False)]

    def _encode_b(self, some: list[str]) -> list[list[int]]:
        # an empty piece is a space alone, which the library would not encode without a text after it
        lone = self.b.piece_to_id(SPACE)
        return [ids if p else [lone] for p, ids in zip(some, self.b.encode(some, num_threads=1), strict=True)]

    def _in_runs(self, new: list[str], encode, lengths: np.ndarray) -> list[list[int]]:
        """Ids of each piece; plain pieces are encoded many to a text and cut at their byte lengths."""
        out: dict[str, list[int]] = {}
        plain = [p for p in new if p and p[0] > " " and p[-1] > " " and not p[-1].isspace() and SPACE not in p]
        runs = [plain[i:i + 200] for i in range(0, len(plain), 200)]
        for run, ids in zip(runs, encode([" ".join(r) for r in runs]) if runs else [], strict=True):
            token_ends = np.cumsum(lengths[ids])
            piece_ends = np.cumsum([len(p.encode()) + 1 for p in run])
            cut = np.searchsorted(token_ends, piece_ends, side="left")
            if cut[-1] < len(ids) and (token_ends[cut] == piece_ends).all():
                at = 0
                for p, c in zip(run, (cut + 1).tolist(), strict=True):
                    out[p] = ids[at:c]
                    at = c
        alone = [p for p in new if p not in out]
        out.update(zip(alone, encode(alone) if alone else [], strict=True))
        return [out[p] for p in new]

    def _learn(self, new: list[str]) -> None:
        a, b = self._in_runs(new, self._encode_a, self.len_a), self._in_runs(new, self._encode_b, self.len_b)
        whole = [" ".encode() + p.encode() for p in new]
        same = [b"".join(map(self.bytes_a.__getitem__, x)) == w == b"".join(map(self.bytes_b.__getitem__, y))
                for x, y, w in zip(a, b, whole, strict=True)]
        self.same = np.concatenate([self.same, np.array(same, bool)])
        for side, found in (("a", a), ("b", b)):
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            self.first[side] = np.concatenate([self.first[side], self.first[side][-1] + np.cumsum(sizes)])
            self.ids[side] = np.concatenate([self.ids[side], np.fromiter((i for x in found for i in x), np.int32, sizes.sum())])
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids A and ids B of all texts and the ``n + 1`` first tokens of the texts in them."""
        cut = [units(t) if t else [] for t in texts]
        new = set().union(*cut).difference(self.index)
        if len(self.index) > self.limit and new:
            self._forget()
            new = set().union(*cut)
        if new:
            self._learn(sorted(new))
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        codes = np.fromiter((i for c in cut for i in map(self.index.__getitem__, c)), np.int64, sizes.sum())
        row = np.repeat(np.arange(len(cut)), sizes)
        bad = np.bincount(row[~self.same[codes]], minlength=len(cut)) > 0
        keep = ~bad[row]
        codes, row = codes[keep], row[keep]
        out = []
        for side in "ab":
            starts = self.first[side][codes]
            n = self.first[side][codes + 1] - starts
            out += [self.ids[side][_ragged(n, starts)],
                    np.concatenate([[0], np.cumsum(np.bincount(row, n, len(cut)).astype(np.int64))])]
        return out[0], out[2], out[1], out[3]


# ------------------------------------------------------------- alignment

def gallop(longer: np.ndarray, wanted: np.ndarray, cursor: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """For each wanted value the first place of ``[cursor, stop)`` in ``longer`` that is not below it: doubling steps
    from the cursor until a value is not below, then binary search in the last step."""
    low = cursor.copy()                       # all before ``low`` is below the wanted value
    high = stop.copy()                        # ``high`` is not below it, or the end
    active = np.flatnonzero(low < high)
    step = 1
    while len(active):
        probe = np.minimum(low[active] + step, stop[active]) - 1
        below = longer[probe] < wanted[active]
        high[active[~below]] = probe[~below]
        active, probe = active[below], probe[below]
        low[active] = probe + 1
        active = active[low[active] < stop[active]]
        step *= 2
    active = np.flatnonzero(low < high)
    while len(active):
        middle = (low[active] + high[active]) // 2
        below = longer[middle] < wanted[active]
        low[active[below]] = middle[below] + 1
        high[active[~below]] = middle[~below]
        active = active[low[active] < high[active]]
    return low


#: Every STRIDES[i]-th end of a document gallops from the place of the coarser stride's end before it.
STRIDES = (4096, 512, 64, 8, 1)


def intersect(driver: np.ndarray, longer: np.ndarray, first_d: np.ndarray, first_l: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each driver value in ``longer`` (the first not below it, inside its document) and whether it is there.
    Both lists rise inside each document; ``first_*``: the documents' first places."""
    sizes = np.diff(first_d)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    rank = np.arange(len(driver)) - np.repeat(first_d[:-1], sizes)
    place = np.zeros(len(driver), np.int64)
    for i, stride in enumerate(STRIDES):
        at = np.flatnonzero((rank & (stride - 1)) == 0)
        if i:
            at = at[(rank[at] & (STRIDES[i - 1] - 1)) != 0]
            cursor = place[at - (rank[at] & (STRIDES[i - 1] - 1))]
        else:
            cursor = first_l[doc[at]]
        place[at] = gallop(longer, driver[at], cursor, first_l[doc[at] + 1])
    inside = place < first_l[doc + 1]
    return place, inside & (longer[np.minimum(place, max(len(longer) - 1, 0))] == driver)


class Alignment:
    """Groups and links of a slice of documents. ``ids_a``, ``ids_b``: all tokens; ``first_*``: the documents' first ones."""

    def __init__(self, ids_a, ids_b, first_a, first_b, len_a, len_b):
        self.ids, self.first = (ids_a, ids_b), (first_a, first_b)
        ends = (np.cumsum(len_a[ids_a]), np.cumsum(len_b[ids_b]))
        self.docs = len(first_a) - 1
        n_a, n_b = np.diff(first_a), np.diff(first_b)
        self.groups = np.zeros(self.docs, np.int64)
        self.links = np.zeros(self.docs, np.int64)
        self.last_of_group = [np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)]
        link_docs, link_a, link_b = [], [], []
        for side, mine in ((0, (n_a <= n_b) & (n_a > 0)), (1, n_b < n_a)):
            if not mine.any():
                continue
            d, a, b = self._driven(side, np.flatnonzero(mine), ends)
            link_docs.append(d)
            link_a.append(a)
            link_b.append(b)
        empty = np.zeros(0, np.int64)
        self.link_docs = np.concatenate([empty, *link_docs])
        self.link_a, self.link_b = np.concatenate([empty, *link_a]), np.concatenate([empty, *link_b])

    def _driven(self, side: int, docs: np.ndarray, ends) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The documents whose list ``side`` is the shorter one and drives."""
        sizes = [np.diff(f)[docs] for f in self.first]
        at = [_ragged(n, f[docs]) for n, f in zip(sizes, self.first, strict=True)]
        first = [np.concatenate([[0], np.cumsum(n)]) for n in sizes]
        d, longer = side, 1 - side
        place, common = intersect(ends[d][at[d]], ends[longer][at[longer]], first[d], first[longer])
        doc = np.repeat(np.arange(len(docs)), sizes[d])
        self.groups[docs] = np.bincount(doc, common, len(docs)).astype(np.int64)
        self.last_of_group[d][at[d][common]] = True
        self.last_of_group[longer][at[longer][place[common]]] = True
        # rank differences: the longer list's tokens from the one after the previous end up to the one that holds this end
        low = np.empty_like(place)
        low[1:] = place[:-1] + common[:-1]
        low[first[d][:-1]] = first[longer][:-1]
        n = place - low + 1
        self.links[docs] = np.bincount(doc, n, len(docs)).astype(np.int64)
        mine, other = np.repeat(at[d], n), at[longer][_ragged(n, low)]
        pair = (mine, other) if side == 0 else (other, mine)
        return np.repeat(docs[doc], n), self.ids[0][pair[0]].astype(np.int64), self.ids[1][pair[1]].astype(np.int64)

    def written_groups(self, names: list[str]) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each document; ``names[3 * id + s]``: an id's digits and its separator."""
        last_a, last_b = self.last_of_group
        n_a, n_b = len(last_a), len(last_b)
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        size_a, size_b = np.bincount(group_a, minlength=1), np.bincount(group_b, minlength=1)
        before_b = np.concatenate([[0], np.cumsum(size_b)])
        up_to_a = np.cumsum(size_a)
        order = np.empty(n_a + n_b, np.int64)
        if n_a:
            order[np.arange(n_a) + before_b[group_a]] = 3 * self.ids[0] + last_a
            order[np.arange(n_b) + up_to_a[group_b]] = 3 * self.ids[1] + 2 * last_b
        cuts = self.first[0] + self.first[1]
        of = names.__getitem__
        return ["".join(map(of, order[s:e].tolist()))[:-1] for s, e in zip(cuts[:-1], cuts[1:], strict=True)]


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array and how often each occurs."""
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
    return ordered[starts], np.diff(np.concatenate([starts, [len(ordered)]]))


# ------------------------------------------------------------------ jobs

def _aligned_slices(docs: DataFrame, byte_level: str, piece_model: str, shards: int) -> DataFrame:
    """Rows of each slice: its documents (place -1) and its distinct pairs in blocks (place: the shard of their A ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        made = 0
        v = kept_in_worker(KIND, (byte_level, piece_model), lambda: Vocabularies(byte_level, piece_model))
        names = [f"{i}{s}" for i in range(max(len(v.len_a), len(v.len_b))) for s in ",|;"]
        width = np.uint64(len(v.len_b))
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                ids_a, ids_b, first_a, first_b = v.encode(part.column("text").to_pylist())
                al = Alignment(ids_a, ids_b, first_a, first_b, v.len_a, v.len_b)
                digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in al.written_groups(names)]
                pair = al.link_a.astype(np.uint64) * width + al.link_b.astype(np.uint64)
                keys, times = _runs(np.sort((al.link_docs.astype(np.uint64) << np.uint64(32)) | pair))
                pair = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                held, documents = _runs(np.sort(pair))
                n = al.docs
                figures = {"doc_id": part.column("doc_id").cast(pa.int64()).to_pylist(), "digest": digests,
                           "n_a": np.diff(first_a), "n_b": np.diff(first_b), "n_groups": al.groups, "n_links": al.links,
                           "width": int(width), "held": held, "pairs": np.bincount((keys >> np.uint64(32)).astype(np.int64), minlength=n),
                           "pair": np.searchsorted(held, pair).astype(np.uint32), "times": times.astype(np.uint32)}
                name = (task << 32) + made
                made += 1
                rows = [(name, -1, packed(figures))]
                shard = (held // np.uint32(width)) % np.uint32(shards)
                order = np.argsort(shard, kind="stable")
                cut = np.searchsorted(shard[order], np.arange(shards + 1))
                for s in np.flatnonzero(np.diff(cut)):
                    at = order[cut[s]:cut[s + 1]]
                    rows.append((name, int(s), packed((held[at], documents[at].astype(np.uint32)))))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.binary()),
                                                                      strict=True)], ["slice", "place", "payload"])
    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, ROWS, keeps=KIND)


def _groups_of(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[tuple[int, int, bytes]]]]:
    """Consecutive rows with the same key; rows of a partition come sorted by it."""
    now, rows = None, []
    for batch in batches:
        for s, p, x in zip(*(batch.column(c).to_pylist() for c in ("slice", "place", "payload")), strict=True):
            k = s if key == "slice" else p
            if rows and k != now:
                yield now, rows
                rows = []
            now = k
            rows.append((s, p, x))
    if rows:
        yield now, rows


def _count_pairs(blocks: DataFrame, width: int, shards: int) -> DataFrame:
    """For each block its pairs' counts of documents everywhere, and whether that is the A id's highest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups_of(batches, "place"):
            asked = [unpacked(x) for _, _, x in rows]
            pair = np.concatenate([p for p, _ in asked])
            order = np.argsort(pair, kind="stable")
            distinct, n = _runs(pair[order])
            counts = np.add.reduceat(np.concatenate([c for _, c in asked]).astype(np.int64)[order], np.cumsum(n) - n)
            of_a, size = _runs(distinct // np.uint32(width))
            highest = np.repeat(np.maximum.reduceat(counts, np.cumsum(size) - size), size)
            for (s, p, _), (wanted, _) in zip(rows, asked, strict=True):
                at = np.searchsorted(distinct, wanted)
                yield pa.record_batch([pa.array([s], pa.int64()), pa.array([p], pa.int32()), pa.array(
                    [packed((counts[at], counts[at] == highest[at]))], pa.binary())], ["slice", "place", "payload"])
    dealt = blocks.repartition(shards, "place").sortWithinPartitions("place", "slice")
    return arrow_map(dealt, run, ROWS, keeps=KIND)


def _finished(figures: DataFrame, answers: DataFrame, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups_of(batches, "slice"):
            f = unpacked(rows[0][2])
            shard = (f["held"] // np.uint32(f["width"])) % np.uint32(shards)
            counts, best = np.zeros(len(shard), np.int64), np.zeros(len(shard), np.int64)
            for _, place, x in rows[1:]:
                at = np.flatnonzero(shard == place)
                counts[at], best[at] = unpacked(x)
            doc = np.repeat(np.arange(len(f["n_a"])), f["pairs"])
            times = f["times"].astype(np.int64)
            sums = []
            for value in (best, counts):
                s = np.zeros(len(f["n_a"]), np.int64)
                np.add.at(s, doc, times * value[f["pair"]])
                sums.append(s)
            yield pa.record_batch([pa.array(f["doc_id"], pa.int64()), *[pa.array(f[c], pa.int64()) for c in (
                "n_a", "n_b", "n_groups", "n_links")], pa.array(sums[0]), pa.array(sums[1]), pa.array(f["digest"], pa.string())],
                [c.split(" ")[0] for c in RESULT.split(", ")])
    dealt = figures.unionByName(answers).repartition(shards, "slice").sortWithinPartitions("slice", "place")
    return arrow_map(dealt, run, RESULT, keeps=KIND)


def align_tokens(docs: DataFrame, byte_level: str, piece_model: str) -> DataFrame:
    """One row for each document, see ``RESULT``. ``byte_level``, ``piece_model``: the vocabulary files."""
    from sentencepiece import SentencePieceProcessor
    spark = docs.sparkSession
    shards = default_parts(spark)
    path = scratch_path(spark, "llm-token-alignment")
    _aligned_slices(docs, byte_level, piece_model, shards).withColumn("figures", F.col("place") < 0) \
        .write.partitionBy("figures").parquet(path)
    made = spark.read.schema(ROWS + ", figures boolean").parquet(path)
    width = SentencePieceProcessor(model_file=piece_model).get_piece_size()
    figures = made.filter("figures").drop("figures")
    return _finished(figures, _count_pairs(made.filter("not figures").drop("figures"), width, shards), shards)
